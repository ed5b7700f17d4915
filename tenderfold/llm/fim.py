"""Fill-in-middle transformation with SWAR rank and select over UTF-8 bytes.

A text is cut into units (lines or code points). Its prefix ends after the
smaller of two hashed numbers of units, its middle after the larger one, its
suffix is the rest; the three parts are then written in one of two orders:

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle

All texts of a batch lie one after the other in one buffer, which is viewed as
64-bit words. The bytes that end a unit are marked by arithmetic on whole words
(one high bit per byte), ``bitwise_count`` gives the marks of each word, and
their running sum answers

* rank: marks before a byte (the running sum, and the count of one masked word);
* select: the byte of the k-th mark. A binary search in the running sum finds
  the word; in the word, one multiplication gives every byte the number of marks
  up to it, one subtraction compares all eight with the wanted one, and the
  number of bytes that fall short is the place.

So the cuts of all texts of a batch are found by a few array operations, and
the code points of a part are a difference of two ranks.

Defined results: a NULL text is the empty text; empty texts, texts that
contain a sentinel, and texts beyond ``rate`` percent stay as they are (form
plain, part lengths NULL). A last line without line feed is a unit. Repeated
rows are transformed each. A NULL doc_id is hashed as the empty string. An
empty table gives no rows. Other columns are not read, whatever their names.
A batch is worked off in slices of SLICE_BYTES (a longer text is a slice of
its own), so memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tenderfold.llm.common import let

# The sentinels.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

SLICE_BYTES = 4 << 20

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_FEEDS = np.uint64(0x0A0A0A0A0A0A0A0A)

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"


def line_ends(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is a line feed."""
    x = words ^ _FEEDS                                    # a line feed is now a zero byte
    return ~(((x & _LOW7) + _LOW7) | x) & _HIGH           # no carry leaves a byte, so only zero bytes stay unmarked before ~


def char_ends(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte after which a new code point starts (the last word is followed by one)."""
    starts = (~words | (words << np.uint64(1))) & _HIGH   # every byte but 10xxxxxx
    after = np.append(starts[1:], _HIGH)
    return (starts >> np.uint64(8)) | (after << np.uint64(56))


UNITS = {"line": line_ends, "char": char_ends}


class UnitIndex:
    """Rank and select over the bytes that end a unit."""

    def __init__(self, words: np.ndarray, unit: str):
        self.marks = np.append(UNITS[unit](words), np.uint64(0))
        self.before = np.zeros(len(self.marks), np.int64)
        np.cumsum(np.bitwise_count(self.marks[:-1]), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes before each place."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        below = (np.uint64(1) << (byte << np.uint64(3))) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The place of the k-th marked byte, k from 1; there must be so many."""
        word = np.searchsorted(self.before, k, side="left") - 1
        wanted = (k - self.before[word]).astype(np.uint64)
        up_to = (self.marks[word] >> np.uint64(7)) * _ONES            # byte i: marks in the bytes 0 to i
        reached = ((up_to | _HIGH) - wanted * _ONES) & _HIGH
        return (word << 3) + 8 - np.bitwise_count(reached)


class Batch:
    """Texts that lie one after the other in one byte buffer; ``edges`` are their ends, 0 first."""

    def __init__(self, data: np.ndarray, edges: np.ndarray, unit: str):
        padded = np.zeros(-(-len(data) // 8) * 8, np.uint8)
        padded[:len(data)] = data
        words = padded.view("<u8")
        self.units, self.chars = UnitIndex(words, unit), UnitIndex(words, "char")
        self.start, self.end = edges[:-1], edges[1:]
        self.skipped = self.units.rank(self.start)
        self.whole = self.units.rank(self.end) - self.skipped
        # a text that goes on after its last mark ends with an open unit
        last = np.maximum(self.end - 1, 0)
        closed = self.units.rank(self.end) - self.units.rank(last) > 0
        self.n = self.whole + ((self.end > self.start) & ~closed)

    def after(self, k: np.ndarray) -> np.ndarray:
        """The place after the first k units of each text."""
        inside = (k > 0) & (k <= self.whole)
        out = np.where(k > self.whole, self.end, self.start)
        out[inside] = self.units.select(self.skipped[inside] + k[inside]) + 1
        return out

    def code_points(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return self.chars.rank(hi) - self.chars.rank(lo)


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of the batch of about SLICE_BYTES of text."""
    offsets = np.frombuffer(batch.column(column).buffers()[1], np.int32)[batch.column(column).offset:][:batch.num_rows + 1]
    first = 0
    while first < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        end = max(first + 1, min(end, batch.num_rows))
        yield batch.slice(first, end - first)
        first = end


def _transform_task(unit: str, rate: int, spm_percent: int):
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, 1) if whole.num_rows else ():
                texts = batch.column(1)
                edges = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:][:batch.num_rows + 1].astype(np.int64)
                held = texts.buffers()[2]
                data = np.frombuffer(held, np.uint8)[edges[0]:edges[-1]] if held is not None else np.empty(0, np.uint8)
                edges -= edges[0]
                cut = Batch(data, edges, unit)
                h1, h2, h3, h4 = (batch.column(2 + i).to_numpy(zero_copy_only=False) for i in range(4))
                a, b = h1 % (cut.n + 1), h2 % (cut.n + 1)
                first, second = cut.after(np.minimum(a, b)), cut.after(np.maximum(a, b))
                chars = cut.code_points(cut.start, first), cut.code_points(first, second)
                plain = (cut.n == 0) | (h3 % 100 >= rate)
                spm = h4 % 100 < spm_percent
                view, forms, outputs = memoryview(data), [], []
                for i, (lo, x, y, hi) in enumerate(zip(*(e.tolist() for e in (cut.start, first, second, cut.end)))):
                    text = bytes(view[lo:hi])
                    if plain[i] or p in text or s in text or m in text:
                        plain[i] = True
                        forms.append("plain")
                        outputs.append(text)
                        continue
                    prefix, middle, suffix = text[:x - lo], text[x - lo:y - lo], text[y - lo:]
                    forms.append("spm" if spm[i] else "psm")
                    outputs.append(b"".join((s, suffix, p, prefix, m, middle) if spm[i] else (p, prefix, s, suffix, m, middle)))
                yield pa.record_batch(
                    [batch.column(0), pa.array(cut.n), pa.array(forms, pa.string()), pa.array(chars[0], mask=plain),
                     pa.array(chars[1], mask=plain), pa.array(outputs, pa.binary())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def transform(docs: DataFrame, seed: int, rate: int = 100, spm_percent: int = 50, unit: str = "line") -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output (string) for every row of ``docs`` (doc_id, text).

    The four hashes of a document are the first four 8-digit groups of the hex
    sha256 of ``seed:doc_id``; ``rate`` percent of the documents are
    transformed, ``spm_percent`` percent of these in the order spm.
    """
    doc_id = F.col("doc_id").cast("long")
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
                       F.sha2(named.cast("binary"), 256).alias("_hex"))
    groups = [F.conv(F.substring("_hex", 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    made = rows.select("doc_id", "text", *groups).mapInArrow(_transform_task(unit, rate, spm_percent), SCHEMA)
    return made.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of.

    The text holds no sentinel and none can arise across the edge of a part,
    so the sentinels split an output into an empty string and its three parts.
    """
    sentinels = "|".join((PREFIX, SUFFIX, MIDDLE))
    whole = let(F.split(output, sentinels, -1), lambda x: F.when(
        form == "psm", F.concat(x[1], x[3], x[2])).otherwise(F.concat(x[2], x[3], x[1])))
    return F.when(form == "plain", output).otherwise(whole)
