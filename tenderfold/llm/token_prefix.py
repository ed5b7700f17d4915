"""Token counts at every prefix of a text, by dynamic programming over prefixes.

In byte-pair encoding the encoding of a prefix ends in exactly one token, and
a token may follow another one only if encoding the two together gives those
two back. So, within one piece of the splitter, the last token and the count
of every prefix follow from shorter prefixes: try the vocabulary's tokens that
end here, and take the one that may follow the last token of the prefix before
it. That is linear in the piece, and never encodes anything twice.

Pieces repeat, so each worker keeps the counts of the pieces it has seen (a
bounded memo). A text's table joins its pieces' counts. Where the splitter
cuts a prefix otherwise than the whole text the table follows the prefix:
inside and at the end of white space, inside a contraction, and inside the
text of a special token.

The table answers any later question without encoding again: the count of the
whole text or of any prefix, and the longest prefix within a budget. Counts
may fall from one prefix to the next (a longer token replaces several).

Defined results: NULL or empty text has the table [0]. Repeated rows get equal
results. Tables hold one 32-bit count per code point and one for the empty
prefix, for texts of any length. An empty table gives no rows. Columns other
than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tenderfold.llm.word_bpe import _byte_letters

MEMO_ENTRIES = 700_000      # pieces kept per worker; the memo starts anew beyond that
MEMO_PIECE = 64             # longer pieces are computed but not kept
MEMO_PAIRS = 2_000_000      # token pairs kept per worker

# Fixed value: the public splitter pattern of byte-level vocabularies.
SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_WORKER: dict[str, "PrefixCounter"] = {}


class PrefixCounter:
    """Prefix tables for one byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {c: b for b, c in enumerate(_byte_letters())}
        special = {t["content"] for t in spec["added_tokens"]}
        self.special = max(special, key=len) if len(special) == 1 else None
        if len(special) > 1:
            raise ValueError("one special token at most")
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.ids = {bytes(back[c] for c in t): i for t, i in vocab.items()}
        self.bytes_of = {i: b for b, i in self.ids.items()}
        # a token that ends in these three bytes is at most so long
        self.reach: dict[bytes, int] = {}
        for b in self.ids:
            if len(b) > 2:
                self.reach[b[-3:]] = max(len(b), self.reach.get(b[-3:], 0))
        self.merges = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.byte_ids = [self.ids[bytes([b])] for b in range(256)]
        self.split = regex.compile(SPLITTER)
        self.spaces = regex.compile(r"\s{2,}(?=\S)")
        self.contraction = regex.compile(r"'(?:re|ve|ll)")
        self.pairs: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, bytes] = {}

    def _merged(self, data: bytes) -> list[int]:
        """Plain merging of a short byte string; only asked for pairs of tokens and single tokens."""
        ids = [self.byte_ids[b] for b in data]
        while len(ids) > 1:
            best = min(((self.merges.get(p, (1 << 30, 0)), p) for p in zip(ids, ids[1:])))
            (rank, new), pair = best
            if rank == 1 << 30:
                break
            out, i = [], 0
            while i < len(ids):
                if i + 1 < len(ids) and (ids[i], ids[i + 1]) == pair:
                    out.append(new)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def _may_follow(self, last: int, token: int) -> bool:
        known = self.pairs.get((last, token))
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            before = self.bytes_of[last] if last >= 0 else b""
            known = self._merged(before + self.bytes_of[token]) == ([last, token] if last >= 0 else [token])
            self.pairs[last, token] = known
        return known

    def _piece(self, piece: str) -> bytes:
        """Counts at every code point prefix of one splitter piece (32-bit)."""
        data = piece.encode("utf-8", "surrogatepass")
        n = len(data)
        last, count = [-1] * (n + 1), [0] * (n + 1)
        ids_of, pair_of, reach = self.ids.get, self.pairs.get, self.reach.get
        for end in range(1, n + 1):
            first = end - reach(data[end - 3:end], 2) if end > 2 else 0
            for start in range(first if first > 0 else 0, end):      # longest token first
                token = ids_of(data[start:end])
                if token is not None:
                    before = last[start]
                    ok = pair_of((before, token))
                    if ok is None:
                        ok = self._may_follow(before, token)
                    if ok:
                        last[end], count[end] = token, count[start] + 1
                        break
        if n != len(piece):                                          # keep the ends of whole code points
            ends = [i + 1 for i in range(n) if i + 1 == n or data[i + 1] & 0xC0 != 0x80]
            return np.array([count[e] for e in ends], np.int32).tobytes()
        return np.array(count[1:], np.int32).tobytes()

    def _of(self, piece: str) -> bytes:
        got = self.memo.get(piece)
        if got is None:
            got = self._piece(piece)
            if len(piece) <= MEMO_PIECE:
                if len(self.memo) >= MEMO_ENTRIES:
                    self.memo.clear()
                self.memo[piece] = got
        return got

    def _plain(self, text: str) -> np.ndarray:
        """Table of a text that holds no special token."""
        pieces = self.split.findall(text)
        if not pieces:
            return np.zeros(1, np.int64)
        get = self.memo.get
        parts = [get(p) for p in pieces]
        if None in parts:
            parts = [self._of(p) if c is None else c for p, c in zip(pieces, parts)]
        within = np.frombuffer(b"".join(parts), np.int32)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(lengths)
        totals = np.cumsum(within[ends - 1], dtype=np.int64)
        table = np.zeros(len(text) + 1, np.int64)
        table[1:] = within + np.repeat(totals - within[ends - 1], lengths)
        # a prefix that ends with a run of white space has the whole run as one piece
        for m in self.spaces.finditer(text):
            run = np.frombuffer(self._of(m.group()), np.int32)
            table[m.end()] = table[m.start()] + run[-1]
        # a prefix that ends inside a long contraction is an apostrophe and a letter
        if "'" in text:
            starts = ends - lengths
            for k, p in enumerate(pieces):
                if len(p) == 3 and p[0] == "'" and self.contraction.fullmatch(p):
                    table[starts[k] + 2] = table[starts[k]] + 2
        return table

    def table(self, text: str | None) -> np.ndarray:
        """Token count of every code point prefix, from the empty one to the whole text."""
        text = text or ""
        if self.special is None or self.special not in text:
            return self._plain(text)
        out, base = [np.zeros(1, np.int64)], 0
        segments = text.split(self.special)
        for segment in segments[:-1]:
            inside = self._plain(segment + self.special[:-1])        # unfinished, it is plain text
            whole = inside[len(segment)] + 1
            out += [inside[1:] + base, np.array([whole + base])]
            base += whole
        out.append(self._plain(segments[-1])[1:] + base)
        return np.concatenate(out)


def counter(path: str) -> PrefixCounter:
    """The worker's counter of one tokenizer file (loaded once, kept between tasks)."""
    if path not in _WORKER:
        _WORKER[path] = PrefixCounter(path)
    return _WORKER[path]


def fitting(table: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    return int(np.flatnonzero(table <= budget)[-1]) if budget >= 0 else 0


def _tables_task(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                tables = [count.table(t).astype("<i4").tobytes() for t in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(tables, pa.binary())], names=["doc_id", "prefix_tokens"])
    return run


def prefix_tables(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and prefix_tokens, the stored table (32-bit little endian counts) of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_tables_task(path), "doc_id long, prefix_tokens binary")


def _budget_task(path: str, budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            texts = (batch.column(1)[i].as_py() or "" for i in range(batch.num_rows))
            rows = []
            for t in texts:
                table = count.table(t)
                rows.append((len(t.encode("utf-8", "surrogatepass")), int(table[-1]),
                             len(t) if table[-1] <= budget else fitting(table, budget)))
            n_bytes, n_tokens, fit = zip(*rows) if rows else ((), (), ())
            yield pa.record_batch([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                                   pa.array(fit, pa.int64())], names=["doc_id", "n_bytes", "n_tokens", "fit_chars"])
    return run


def budget_answers(docs: DataFrame, path: str, budget: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and fit_chars (code points of the longest prefix within the budget).

    The tables are asked where they are made, so only the answers leave the task.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_budget_task(path, budget), "doc_id long, n_bytes long, n_tokens long, fit_chars long").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > budget).alias("over_limit"), "fit_chars")
