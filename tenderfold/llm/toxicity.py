"""Toxicity by a weighted finite-state grammar over clauses.

Words are read as classes: insult, threat, target, negation, reported speech
or other. Small transducers read the same clause (a stretch between sentence
marks) and are composed into one machine: a negation is in reach for the next
words; reported speech stays open once a report verb was read; a target was
named; and insults and threats wait, each under what was in reach when it was
read (negated, reported). Nothing is given out for a word: at the end of the
clause the machine accepts, and gives out every waiting insult or threat as a
match whose pattern also says whether the clause named a target, before it or
after it. An insult in a clause without a target is a pattern of its own, whose
weight starts low and is fitted like the others, so it may be nothing.

The insult words are learnt: whole words and stems whose documents are
toxic far more often than not, in a bounded sample of labelled documents, with
their log-odds as weight. The score is a logistic function of the weighted
matches per 100 words and pattern; its pattern weights are fitted on the same
sample and drawn towards set ones (a negated or reported insult counts less,
an aimed one more), so patterns that the sample lacks keep those.

Defined results: NULL or empty text has no match and gets the score of that.
Very long texts are read whole. Equal texts get equal scores. An empty table
gives no rows. Columns other than doc_id and text are not read, whatever their names. Without labelled
rows of both classes the set weights and the seed words alone are used.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import product
from math import log

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tenderfold.llm.labelled import training_texts

TRAIN_PER_CLASS = 3_000     # bound of the training sample
TRAIN_MAX_CHARS = 20_000    # longer texts are not used for training
MIN_TOXIC_DOCS = 4          # a learnt word or stem occurs in so many different toxic documents
MIN_LOG_ODDS = 3.0
STEM_LENGTHS = (4, 5, 6)
NEGATION_REACH = 3          # words

# Seed words of the classes (a few common ones in four languages).
INSULTS = ["idiot", "moron", "stupid", "loser", "worthless", "pathetic", "disgusting", "scum", "trash"]
THREATS = ["kill", "hurt", "destroy", "beat", "shoot", "stab", "strangle", "murder", "töten", "umbringen", "tuer",
           "frapper", "matar", "golpear"]
TARGETS = ["you", "your", "you're", "yourself", "u", "ya", "him", "her", "them", "dich", "dir", "du", "euch", "toi",
           "vous", "tu", "te", "ti", "usted", "ustedes"]
NEGATIONS = ["not", "never", "no", "isn't", "aren't", "wasn't", "don't", "doesn't", "nicht", "kein", "keine", "nie", "pas",
             "jamais", "nunca", "jamás"]
REPORTS = ["said", "says", "wrote", "writes", "quoted", "called", "claimed", "reported", "sagte", "schrieb", "dit",
           "écrit", "dijo", "escribió"]
SEED_WEIGHT = 4.0

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
PATTERNS = [(kind, *flags) for kind in ("insult", "threat") for flags in product((0, 1), repeat=3)]
CLAUSE_END = re.compile(r"[.!?;\n\r]")
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


def _negation(state: int, word: int) -> int:
    """Words still in reach of a negation."""
    return NEGATION_REACH if word == NEGATION else max(0, state - 1)


def _report(state: int, word: int) -> int:
    """1 once reported speech was opened in the clause."""
    return 1 if word == REPORT else state


def _target(state: int, word: int) -> int:
    """1 once somebody was named in the clause."""
    return 1 if word == TARGET else state


def _waiting(state: int, word: int, kind: int, negated: int, reported: int) -> int:
    """The contexts, as a bit set, under which insults or threats wait for the end of the clause."""
    return state | 1 << (2 * negated + reported) if word == kind else state


class Grammar:
    """The composed machine.

    ``next`` gives for each state and word class the state after it and the
    context (kind, negated, reported) under which the word waits; ``accepted``
    gives for each state the patterns that the end of the clause gives out.
    """

    context = (_negation, _report, _target)
    kinds = (("insult", INSULT), ("threat", THREAT))

    def __init__(self):
        start = (0, 0, 0, 0, 0)
        numbers, todo = {start: 0}, [start]
        self.next: dict[tuple[int, int], tuple[int, tuple | None]] = {}
        self.accepted: dict[int, dict[tuple, tuple]] = {}
        while todo:
            state = todo.pop()
            self.accepted[numbers[state]] = {
                (kind, negated, reported): (kind, negated, reported, state[2])
                for (kind, _), held in zip(self.kinds, state[3:]) for negated, reported in product((0, 1), repeat=2)
                if held >> (2 * negated + reported) & 1}
            for word in range(6):
                reach, reported, named = (p(x, word) for p, x in zip(self.context, state))
                held = tuple(_waiting(x, word, code, int(reach > 0), reported) for x, (_, code) in zip(state[3:], self.kinds))
                after = (reach, reported, named, *held)
                if after not in numbers:
                    numbers[after] = len(numbers)
                    todo.append(after)
                waits = next(((kind, int(reach > 0), reported) for kind, code in self.kinds if word == code), None)
                self.next[numbers[state], word] = (numbers[after], waits)

    def matches(self, classes: list[int]) -> list[tuple[int, str, int, int, int]]:
        """(position, kind, negated, reported, aimed) of what a clause gives out at its end."""
        state, waiting = 0, []
        for i, word in enumerate(classes):
            state, waits = self.next[state, word]
            if waits:
                waiting.append((i, waits))
        accepted = self.accepted[state]
        return [(i, *accepted[waits]) for i, waits in waiting]


@lru_cache(maxsize=1)
def grammar() -> Grammar:
    return Grammar()


@dataclass
class Model:
    words: dict[str, float]      # whole insult words and their weights
    stems: dict[str, float]      # beginnings of insult words
    weights: list[float]         # one per pattern
    bias: float


class Scorer:
    """Match counts and score of a text."""

    def __init__(self, model: Model):
        self.model, self.grammar = model, grammar()
        self.function = {w: c for c, ws in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}
        self.threats = set(THREATS)
        self.at = {p: i for i, p in enumerate(PATTERNS)}
        self.find = ahocorasick.Automaton()
        for w in {*model.words, *model.stems, *THREATS}:
            self.find.add_word(w, len(w))
        if len(self.find):
            self.find.make_automaton()

    def insult_weight(self, word: str) -> float:
        best = self.model.words.get(word, 0.0)
        if len(word) >= STEM_LENGTHS[0]:
            for n in STEM_LENGTHS:
                best = max(best, self.model.stems.get(word[:n], 0.0))
        return best

    def _clause(self, clause: str, sums: np.ndarray) -> None:
        words = WORD.findall(clause)
        weights = [self.insult_weight(w) for w in words]
        classes = [INSULT if v else THREAT if w in self.threats else self.function.get(w, OTHER) for w, v in zip(words, weights)]
        for i, kind, negated, reported, aimed in self.grammar.matches(classes):
            sums[self.at[kind, negated, reported, aimed]] += weights[i] or SEED_WEIGHT

    def features(self, text: str | None) -> np.ndarray:
        """Logarithm of the weighted matches per 100 words, for each pattern."""
        low, sums, done = (text or "").lower(), np.zeros(len(PATTERNS)), -1
        if len(self.find):
            for end, n in self.find.iter(low):
                start = end - n + 1
                # only the beginning of a word counts, and each clause is read once
                if start <= done or start and low[start - 1].isalpha():
                    continue
                stop = CLAUSE_END.search(low, start)
                stop = stop.start() if stop else len(low)
                begin = max((low.rfind(c, 0, start) for c in ".!?;\n\r"), default=-1) + 1
                self._clause(low[max(begin, done + 1):stop], sums)
                done = stop
        return np.log1p(100.0 * sums / (low.count(" ") + 10.0)) if sums.any() else sums

    def score(self, text: str | None) -> float:
        z = float(self.features(text) @ np.asarray(self.model.weights)) + self.model.bias
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


def _set_weights() -> np.ndarray:
    """Pattern weights before training: negation and report lower a match, and so does a clause without a target."""
    return np.array([5.0 * 0.4 ** negated * 0.5 ** reported * 0.4 ** (1 - aimed) * (1.0 if kind == "insult" else 0.5)
                     for kind, negated, reported, aimed in PATTERNS])


def _different(texts: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """One text of each group of near copies (same least shingle hash), so that copies don't vote again and again."""
    seen, out = set(), []
    for text, label in texts:
        w = text.lower().split()
        key = min((xxhash.xxh64_intdigest(" ".join(w[i:i + 5])) for i in range(max(1, len(w) - 4))), default=0)
        if (key, label) not in seen:
            seen.add((key, label))
            out.append((text, label))
    return out


def learn_words(texts: list[tuple[str, int]]) -> tuple[dict[str, float], dict[str, float]]:
    """Whole words and stems with the log-odds of toxic against clean documents, where they stand out."""
    toxic, clean = Counter(), Counter()
    totals = [0, 0]
    for text, label in _different(texts):
        totals[label] += 1
        words = set(WORD.findall(text.lower()))
        grams = {(w, 0) for w in words} | {(w[:n], n) for w in words for n in STEM_LENGTHS if len(w) >= n}
        (toxic if label else clean).update(grams)
    chosen = {}
    for gram, n in toxic.items():
        odds = log((n + 0.5) / (totals[1] + 1)) - log((clean[gram] + 0.5) / (totals[0] + 1))
        if n >= MIN_TOXIC_DOCS and odds >= MIN_LOG_ODDS:
            chosen[gram] = odds
    # a stem gives way to longer ones, or to whole words, that tell more; else it covers them
    best: dict[tuple[str, int], float] = {}
    for (g, k), o in chosen.items():
        for n in STEM_LENGTHS:
            if n < (k or len(g) + 1):
                best[g[:n], n] = max(o, best.get((g[:n], n), 0.0))
    stems: dict[str, float] = {}
    for n in STEM_LENGTHS:
        stems |= {g: o for (g, k), o in chosen.items() if k == n and o >= best.get((g, n), 0.0) - 0.5
                  and not any(g[:m] in stems for m in STEM_LENGTHS if m < n)}
    words = {g: o for (g, k), o in chosen.items() if k == 0 and not any(g[:m] in stems for m in STEM_LENGTHS)}
    return words, stems


def train(texts: list[tuple[str, int]]) -> Model:
    """Learn the words and then the pattern weights."""
    seeds = {w: SEED_WEIGHT for w in INSULTS}
    if len({label for _, label in texts}) < 2:
        return Model(seeds, {}, _set_weights().tolist(), -4.0)
    words, stems = learn_words(texts)
    model = Model({**{w: o for w, o in seeds.items() if not any(w[:n] in stems for n in STEM_LENGTHS)}, **words},
                  stems, _set_weights().tolist(), -4.0)
    scorer = Scorer(model)
    x = np.array([scorer.features(t) for t, _ in texts])
    y = np.array([label for _, label in texts], float)
    prior = np.append(_set_weights(), -4.0)
    theta, x1 = prior.copy(), np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * 200.0

    def loss(th: np.ndarray) -> float:
        z = x1 @ th
        return float((weight * (np.logaddexp(0.0, z) - y * z)).sum() + 0.25 * ((th - prior) ** 2).sum())

    for _ in range(25):                          # Newton steps of the regularised logistic loss, halved until they help
        p = 1.0 / (1.0 + np.exp(-np.clip(x1 @ theta, -30, 30)))
        grad = x1.T @ (weight * (p - y)) + 0.5 * (theta - prior)
        step = np.linalg.solve((x1 * (weight * p * (1 - p))[:, None]).T @ x1 + 0.5 * np.eye(len(theta)), grad)
        now, size = loss(theta), 1.0
        while loss(theta - size * step) > now and size > 1e-6:
            size /= 2
        theta = theta - size * step
    model.weights, model.bias = np.maximum(theta[:-1], 0.0).tolist(), float(theta[-1])
    return model


def _score_task(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            scores = [scorer.score(batch.column(1)[i].as_py()) for i in range(batch.num_rows)]
            yield pa.record_batch([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])
    return run


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, score and predicted (1 from the threshold on) for every whole text."""
    model = train(training_texts(docs, labels, "toxic", TRAIN_PER_CLASS, TRAIN_MAX_CHARS))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_score_task(model), "doc_id long, score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
