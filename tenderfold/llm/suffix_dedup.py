"""Substring dedup by prefix-partitioned suffix trees over words.

A window is ``size`` consecutive words of one document. A word goes if a window
that covers it also starts in a document with a smaller doc_id (windows are
judged on the input). Words are runs without ASCII white space, unchanged.

(1) Equal texts form a class. In every document of a class but the one with
the least doc_id all windows repeat, so only that one takes part below.
(2) A window can only repeat if its least n-gram (of 2/5 of its words, by hash)
does, so the distinct least n-grams of each document, about one for every
sixteen words, are counted over all documents. Windows whose least n-gram is
in one document alone are unique and make no suffix. This loses nothing.
(3) Every other window is the start of a suffix, which is written as symbols:
the hashes of the runs of SYMBOL_WORDS words that make it up. Suffixes are
split into groups by prefixes of variable length: one symbol, and one more for
as long as the prefix has more suffixes than a group may hold. So a frequent
phrase is spread by what follows it. How many prefixes are that heavy is
bounded (see ``heavy_bound``), so their list may be broadcast.
(4) A task gets its groups sorted, which is the leaf order of their suffix
trees; the depth at which two neighbours part gives the internal nodes. A run
of neighbours that part at no depth below ``size`` words lies under one deep
internal node: its leaves are the places of one repeat. All leaves of a larger
doc_id than the first are marked. The task holds one leaf and its node between
batches, whatever the size of a group.
(5) A prefix that is still heavy at full depth is one deep node by itself: its
least doc_id is a map-side combined minimum, and its leaves are marked where
they are, so a passage that a third of all documents share is in no one task.
(6) The marks of a document, consecutive ones merged into maximal repeats, are
applied to its words.

Defined results: NULL or empty text has no words; texts of fewer than ``size``
words lose none. A row with a NULL doc_id is neither smaller nor larger than
another and loses none. Rows of one doc_id are judged each by its own text and
take nothing from each other. An empty table gives no rows. Other columns are
not read, whatever their names. Very long texts are handled whole, one at a time. Texts are compared by
128-bit hashes, windows by 64 + 32 * 4 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tenderfold.llm.common import HEAVY_KEYS, HEAVY_LEAST, heavy_bound, join_heavy, staged

WINDOW_WORDS = 50
SYMBOL_WORDS = 10           # words of a symbol of the suffix trees
BATCH_SUFFIXES = 200_000    # suffixes that leave a task at once
SLICE_ROWS = 128            # texts taken from a batch at once

_EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes in their order."""
    h = (a * _MIX2 ^ (a >> np.uint64(29))) + b
    h = (h ^ (h >> np.uint64(33))) * _MIX1
    return h ^ (h >> np.uint64(32))


def words_of(text: bytes) -> list[bytes]:
    return text.split()             # bytes.split() parts at exactly \x20 and \x09-\x0D


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def gram_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` words at each place, joined from runs of powers of two."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    runs, size = {1: h}, 1
    while size * 2 <= width:
        runs[size * 2] = _joined(runs[size][:-size], runs[size][size:])
        size *= 2
    out, at = runs[size][:n], size
    while at < width:
        while at + size > width:
            size //= 2
        out = _joined(out, runs[size][at:at + n])
        at += size
    return out


def least_grams(h: np.ndarray, size: int) -> np.ndarray:
    """The least n-gram hash inside the window at each place."""
    width = max(1, size * 2 // 5)
    least, span, want = gram_hashes(h, width), 1, size - width + 1
    while span < want:
        step = min(span, want - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    return least


def symbol_places(size: int) -> list[int]:
    """Offsets of the symbols of a window; the last one may overlap the one before."""
    width = min(SYMBOL_WORDS, size)
    return [*range(0, size - width, width), size - width]


def symbols(h: np.ndarray, at: np.ndarray, size: int) -> list[np.ndarray]:
    """The symbols of the windows at the places ``at``, first symbol first."""
    grams = gram_hashes(h, min(SYMBOL_WORDS, size))
    return [grams[at + offset] for offset in symbol_places(size)]


def parting_depths(leaves: list[np.ndarray]) -> np.ndarray:
    """For sorted leaves, the symbols that each but the first shares with the one before (the inner nodes of their tree)."""
    depth, same = np.zeros(len(leaves[0]) - 1, np.int64), np.ones(len(leaves[0]) - 1, bool)
    for s in leaves:
        same &= s[1:] == s[:-1]
        depth += same
    return depth


def _texts(batches: Iterator[pa.RecordBatch], *columns: int) -> Iterator[tuple]:
    for batch in batches:
        for first in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(first, SLICE_ROWS)
            yield from zip(*(part.column(c).to_pylist() for c in columns))


def _profile_task(size: int):
    """Per document: words, hash of its words joined by a space, distinct least n-grams of its windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(first, SLICE_ROWS)
                n, sha, grams = [], [], []
                for text in part.column(1).to_pylist():
                    words = words_of(text)
                    n.append(len(words))
                    sha.append(hashlib.sha256(b" ".join(words)).digest())
                    grams.append(np.unique(least_grams(word_hashes(words), size)).view(np.int64) if len(words) >= size else None)
                yield pa.record_batch(
                    [part.column(0), part.column(2), pa.array(n, pa.int64()), pa.array(sha, pa.binary()),
                     pa.array(grams, pa.list_(pa.int64()))], names=["doc_id", "key", "n_words", "sha", "grams"])
    return run


def _suffixes_task(size: int):
    """One row per window whose least n-gram is among the row's open ones."""
    names = [f"p{i}" for i in range(len(symbol_places(size)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = 0, []

        def flush() -> pa.RecordBatch:
            joined = [np.concatenate(c) for c in zip(*rows)]
            first, *others = joined[3:]
            return pa.record_batch(
                [*(pa.array(c) for c in joined[:3]), pa.array(first.view(np.int64)),
                 *(pa.array((c & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)) for c in others)],
                names=["doc_id", "node", "pos", *names])

        for doc_id, node, text, open_ in _texts(batches, 0, 1, 2, 3):
            h = word_hashes(words_of(text))
            at = np.flatnonzero(np.isin(least_grams(h, size), np.array(open_, np.int64).view(np.uint64)))
            rows.append((np.full(len(at), doc_id), np.full(len(at), node), at.astype(np.int32), *symbols(h, at, size)))
            held += len(at)
            if held >= BATCH_SUFFIXES:
                yield flush()
                held, rows = 0, []
        if held:
            yield flush()
    return run


def _subtrees_task(depth: int):
    """From leaves in tree order, equal ones by doc_id: (doc_id, node, pos) of those under a deep node of a smaller doc_id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, owner = None, None                # the last leaf, and the first doc_id under its deep node
        for batch in batches:
            if not batch.num_rows:
                continue
            doc_id, node, pos, *leaves = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3 + depth))
            before = last if last is not None else [leaves[0][:1] + 1, *(s[:1] for s in leaves[1:])]
            deep = parting_depths([np.concatenate([b, s]) for b, s in zip(before, leaves)]) == depth
            first = np.flatnonzero(~deep)       # the first leaves of their nodes
            owners = doc_id[first]
            if deep[0]:
                first, owners = np.append(0, first), np.append(owner, owners)
            own = np.repeat(owners, np.diff(np.append(first, len(deep))))
            last, owner = [s[-1:] for s in leaves], own[-1]
            marked = doc_id > own
            yield pa.record_batch([pa.array(c[marked]) for c in (doc_id, node, pos)], names=["doc_id", "node", "pos"])
    return run


def covered(starts: list[int] | np.ndarray, size: int) -> list[tuple[int, int]]:
    """(first word, end) of the maximal stretches that the windows at ``starts`` cover."""
    at = np.unique(np.asarray(starts, np.int64))
    new = np.flatnonzero(np.diff(at, prepend=-size - 1) > size)
    return [(int(at[i]), int(at[j - 1]) + size) for i, j in zip(new, np.append(new[1:], len(at)))]


def _cut_task(size: int):
    """Apply the marks of a document to its words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, key, text, starts in _texts(batches, 0, 1, 2, 3):
            words = words_of(text)
            spans = covered(starts, size)
            for lo, hi in reversed(spans):
                del words[lo:hi]
            kept = b" ".join(words)
            yield pa.record_batch(
                [pa.array([doc_id], pa.int64()), pa.array([key], pa.binary()), pa.array([sum(hi - lo for lo, hi in spans)], pa.int64()),
                 pa.array([hashlib.sha256(kept).digest()], pa.binary()), pa.array([kept], pa.binary()),
                 pa.array([[{"first": lo, "end": hi} for lo, hi in spans]], pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "key", "n_removed", "sha", "kept", "spans"])
    return run


class SubstringDedup:
    """One run over ``docs`` (doc_id, text)."""

    def __init__(self, docs: DataFrame, size: int = WINDOW_WORDS):
        self.size, self.depth = size, len(symbol_places(size))
        self.symbols = [f"p{i}" for i in range(self.depth)]
        text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn(
            "key", F.unhex(F.md5("text")))
        self.rows = staged(self.docs.mapInArrow(
            _profile_task(size), "doc_id long, key binary, n_words long, sha binary, grams array<long>"), "profiles")
        # documents that have windows, and their classes
        self.windowed = self.rows.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= size))
        self.total = self.windowed.count()
        self.classes = staged(self.windowed.groupBy("key").agg(
            F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.first("grams").alias("grams")), "classes")

    def open_grams(self) -> DataFrame:
        """key, least, open: the least n-grams of each class that other classes have too (classes without any are left out)."""
        each = staged(self.classes.select("key", "least", F.explode("grams").alias("gram")), "grams")
        shared = staged(each.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "shared")
        return join_heavy(each, shared, ["gram"], "n", each.count()).groupBy("key", "least").agg(
            F.collect_list("gram").alias("open"))

    def heavy_prefixes(self, suffixes: DataFrame, bound: int) -> list[DataFrame]:
        """The prefixes of one, two, ... symbols that have at least ``bound`` suffixes, with their least doc_id, as far as there are any."""
        out, under = [], suffixes.withColumn("_under", F.lit(True))
        for depth in range(1, self.depth + 1):
            prefix = self.symbols[:depth]
            # suffixes under no heavy prefix are one group of NULLs, combined within each task
            named = [F.when(F.col("_under"), F.col(p)).alias(p) for p in prefix]
            counted = staged(under.groupBy(*named).agg(F.count("*").alias("n"), F.min("doc_id").alias("owner")).where(
                F.col("n") >= bound), "heavy")
            heavy = counted.where("p0 is not null").select(*prefix, "owner")
            if heavy.isEmpty():
                break
            out.append(heavy)
            under = suffixes.join(F.broadcast(heavy.select(*prefix, F.lit(True).alias("_under"))), prefix, "left")
        return out

    def marked(self, suffixes: DataFrame) -> DataFrame:
        """(doc_id, node, pos) of the windows that also start in a smaller doc_id."""
        # so many prefixes of a length at most, as no two of them share a suffix
        heavy = self.heavy_prefixes(suffixes, heavy_bound(suffixes.count(), HEAVY_KEYS, HEAVY_LEAST))
        leaves, length = suffixes, F.lit(1)
        for depth, names in enumerate(heavy[:self.depth - 1], 1):
            flag = F.broadcast(names.select(*self.symbols[:depth], F.lit(1).alias(f"_h{depth}")))
            leaves = leaves.join(flag, self.symbols[:depth], "left")
            length = length + F.coalesce(F.col(f"_h{depth}"), F.lit(0))
        whole = None
        if len(heavy) == self.depth:                    # prefixes of full depth: deep nodes by themselves
            leaves = leaves.join(F.broadcast(heavy[-1]), self.symbols, "left")
            whole = leaves.where("doc_id > coalesce(owner, doc_id)").select("doc_id", "node", "pos")
            leaves = leaves.where("owner is null")
        parts = [F.when(F.lit(i) < F.col("_length"), F.col(p)).otherwise(F.lit(0)) for i, p in enumerate(self.symbols)]
        groups = leaves.withColumn("_length", length).withColumn("_group", F.xxhash64("_length", *parts))
        trees = groups.repartition("_group").sortWithinPartitions(*self.symbols, "doc_id").select(
            "doc_id", "node", "pos", *self.symbols)
        found = trees.mapInArrow(_subtrees_task(self.depth), "doc_id long, node long, pos int")
        return found if whole is None else found.unionByName(whole)

    def cut(self) -> DataFrame:
        """doc_id, key, n_removed, sha, kept, spans of the first documents of classes that lose words."""
        open_ = self.open_grams()
        texts = self.docs.join(open_.select(F.col("least").alias("doc_id"), "key", "open"), ["doc_id", "key"])
        texts = staged(texts.dropDuplicates(["doc_id", "key"]).withColumn("node", F.xxhash64("key")), "texts")
        schema = "doc_id long, node long, pos int, p0 long" + "".join(f", {p} int" for p in self.symbols[1:])
        suffixes = staged(texts.select("doc_id", "node", "text", "open").mapInArrow(_suffixes_task(self.size), schema), "suffixes")
        marks = self.marked(suffixes).groupBy("doc_id", "node").agg(F.collect_list("pos").alias("starts"))
        rows = texts.select("doc_id", "node", "key", "text").join(marks, ["doc_id", "node"]).select("doc_id", "key", "text", "starts")
        return rows.mapInArrow(_cut_task(self.size), "doc_id long, key binary, n_removed long, sha binary, kept binary, "
                                                     "spans array<struct<first: long, end: long>>")

    def verdicts(self, kept: bool = False) -> DataFrame:
        """doc_id, key, n_words, n_removed, sha, spans (and kept, for rows that lost words) for every row of the input."""
        cut = staged(self.cut().select("doc_id", "key", "n_removed", "sha", "spans", *["kept"] * kept), "cut")
        none = [F.lit(None).cast("binary").alias("kept")] * kept
        no_spans = F.array().cast("array<struct<first: long, end: long>>")
        base = self.rows.select("doc_id", "key", "n_words", "sha")
        windowed = F.col("doc_id").isNotNull() & (F.col("n_words") >= self.size)
        short = base.where(~F.coalesce(windowed, F.lit(False))).select(
            "doc_id", "key", "n_words", F.lit(0).cast("long").alias("n_removed"), "sha", no_spans.alias("spans"), *none)
        named = join_heavy(base.where(windowed), self.classes.select("key", "least", "copies"), ["key"], "copies", self.total)
        copies = named.where("doc_id > least").select(
            "doc_id", "key", "n_words", F.col("n_words").alias("n_removed"), F.unhex(F.lit(_EMPTY_SHA)).alias("sha"),
            F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_words").alias("end"))).alias("spans"),
            *[F.lit(b"").cast("binary").alias("kept")] * kept)
        firsts = named.where("doc_id = least").drop("least", "copies").withColumnRenamed("sha", "whole").join(
            cut, ["doc_id", "key"], "left").select(
            "doc_id", "key", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
            F.coalesce("sha", "whole").alias("sha"), F.coalesce("spans", no_spans).alias("spans"), *["kept"] * kept)
        return short.unionByName(copies).unionByName(firsts)


def removals(docs: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and spans (removed stretches of words) for every row of ``docs``."""
    return SubstringDedup(docs, size).verdicts().select(
        "doc_id", "n_words", "n_removed", F.lower(F.hex("sha")).alias("kept_sha256"), "spans")


def deduplicated(docs: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """doc_id and the text that is left (words joined by one space) for every row of ``docs``."""
    run = SubstringDedup(docs, size)
    changed = run.verdicts(kept=True).where("n_removed > 0").select("doc_id", "key", "kept").dropDuplicates(["doc_id", "key"])
    whole = F.array_join(F.filter(F.split(F.col("text").cast("string"), r"[\x20\x09-\x0D]+", -1), lambda w: w != ""), " ")
    return run.docs.join(staged(changed, "changed"), ["doc_id", "key"], "left").select(
        "doc_id", F.coalesce(F.col("kept").cast("string"), whole).alias("text"))
