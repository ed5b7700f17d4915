"""Token-id files: one concatenated id array per shard, document boundaries in Elias-Fano code.

Shard file, little endian: a header of eight 64-bit integers (magic, bytes per
id, documents, ids, low bits per boundary, upper words, select samples, flag
whether a document number is missing), the document numbers (64 bits each), a
byte per document for missing numbers (only with the flag), the low bits of
the boundaries packed without gaps, the upper bits as 64-bit words, for every
512th one-bit its word and the one-bits before that word, and the ids. ``n + 1`` boundaries of
``m`` ids take about ``n * (2 + log2(m / n))`` bits. ``Shard.select`` finds
the boundaries of a batch of documents: from the sampled word before each it
counts one-bits word by word, then resolves the bit in its word. Reading goes
through it, READ_DOCS documents at a time; ``Shard.document`` slices one
document's ids without touching the others.

Writing: rows are dealt into ranges of doc_id (ties by text hash), sorted, and
each task encodes its rows and writes shard files under a deterministic final
name (written aside, then moved), so a task that runs again after a lost
executor replaces its files by equal ones. A manifest (one row per file)
holds document and id counts; the sum of the files before gives each file's
first position in the whole array.

Defined results: NULL or empty text is a document with the end id alone. Rows
with a NULL doc_id come first. Repeated rows are all written; rows of one
doc_id with different texts follow each other in the order of their texts'
hashes. A text longer than a shard makes a longer shard. An empty table makes no
file and gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tenderfold.llm.common import shared_path, staged
from tenderfold.llm.word_bpe import encoder

MAGIC = 0x31464554          # "TEF1"
SHARD_IDS = 4_000_000       # a file is closed once it holds so many ids
SAMPLE = 512                # one-bits per select sample
READ_DOCS = 8_192           # documents whose boundaries are selected at once


def ef_encode(values: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Elias-Fano code of ascending non-negative integers: (low bits, packed lows, upper words, select samples)."""
    values = np.asarray(values, np.uint64)
    n, top = len(values), int(values[-1]) if len(values) else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    bits = (values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
    lows = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
    at = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    upper = np.zeros(((int(at[-1]) if n else 0) // 64 + 1) * 64, np.uint8)
    upper[at] = 1
    words = np.packbits(upper, bitorder="little").view("<u8")
    ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
    word = at[::SAMPLE] // 64
    return low, lows, words, np.stack([word, ones[word]], axis=1).astype("<i8")


class Shard:
    """One shard file in memory (or mapped)."""

    def __init__(self, data: bytes):
        head = np.frombuffer(data, "<i8", 8)
        if head[0] != MAGIC:
            raise ValueError("not a token shard")
        _, self.width, self.docs, self.n_ids, self.low, n_words, n_samples, missing = (int(x) for x in head)
        at = 64

        def take(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype, count, at)
            at += out.nbytes
            return out

        self.doc_ids = take("<i8", self.docs)
        self.no_id = take("u1", self.docs).astype(bool) if missing else np.zeros(self.docs, bool)
        self._lows = take("u1", ((self.docs + 1) * self.low + 7) // 8)
        self._words = take("<u8", n_words)
        self._samples = take("<i8", 2 * n_samples).reshape(-1, 2)
        self.ids = take(f"<u{self.width}", self.n_ids)

    def _lows_of(self, i: np.ndarray) -> np.ndarray:
        got = np.zeros(len(i), np.int64)
        for k in range(self.low):
            bit = i * self.low + k
            got |= (self._lows[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(np.int64) << k
        return got

    def select(self, i: np.ndarray) -> np.ndarray:
        """Positions where the documents i start (i = docs: where the last one ends), by select on the upper bits."""
        i = np.asarray(i, np.int64)
        word, left = self._samples[i // SAMPLE, 0].copy(), i - self._samples[i // SAMPLE, 1]
        while True:                                       # on to the word that holds the wanted one-bit
            ones = np.bitwise_count(self._words[word])
            on = np.flatnonzero(left >= ones)
            if not len(on):
                break
            left[on] -= ones[on]
            word[on] += 1
        w = self._words[word].copy()
        for k in range(int(left.max(initial=0))):         # the lower one-bits of that word go
            more = left > k
            w[more] &= w[more] - np.uint64(1)
        place = np.bitwise_count((w & (~w + np.uint64(1))) - np.uint64(1))
        return ((word * 64 + place - i) << self.low) | self._lows_of(i)

    def boundary(self, i: int) -> int:
        return int(self.select(np.array([i]))[0])

    def boundaries(self) -> np.ndarray:
        """All boundaries at once, by unpacking every bit."""
        ones = np.flatnonzero(np.unpackbits(self._words.view(np.uint8), bitorder="little"))[:self.docs + 1]
        out = (ones - np.arange(self.docs + 1)).astype(np.uint64) << np.uint64(self.low)
        if self.low:
            bits = np.unpackbits(self._lows, count=(self.docs + 1) * self.low, bitorder="little")
            out |= (bits.reshape(-1, self.low).astype(np.uint64) << np.arange(self.low, dtype=np.uint64)).sum(
                axis=1, dtype=np.uint64)
        return out.astype(np.int64)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.boundary(i):self.boundary(i + 1)]


def shard_bytes(doc_ids: list[int | None], ids: list[np.ndarray], width: int) -> bytes:
    """The file of some documents in their order."""
    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
    low, lows, words, samples = ef_encode(ends)
    missing = np.array([d is None for d in doc_ids], np.uint8)
    head = np.array([MAGIC, width, len(ids), int(ends[-1]), low, len(words), len(samples), int(missing.any())], "<i8")
    parts = [head, np.array([0 if d is None else d for d in doc_ids], "<i8")]
    parts += [missing] if missing.any() else []
    parts += [lows, words, samples, np.concatenate(ids).astype(f"<u{width}")]
    return b"".join(p.tobytes() for p in parts)


def _write_task(path: str, tokenizer: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        files, root = pafs.FileSystem.from_uri(path)
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.width)
        doc_ids, ids, held, number = [], [], 0, 0

        def close() -> pa.RecordBatch:
            name = f"shard-{part:06d}-{number:06d}.tef"
            aside = f"{root}/_{name}.{uuid.uuid4().hex}"
            with files.open_output_stream(aside) as out:
                out.write(shard_bytes(doc_ids, ids, np.dtype(enc.width).itemsize))
            files.move(aside, f"{root}/{name}")
            return pa.record_batch([pa.array([name]), pa.array([len(ids)], pa.int64()), pa.array([held], pa.int64())],
                                   names=["file", "n_docs", "n_ids"])

        for batch in batches:
            for i in range(batch.num_rows):
                doc_ids.append(batch.column(0)[i].as_py())
                ids.append(np.concatenate([enc.encode(batch.column(1)[i].as_py()), end]))
                held += len(ids[-1])
                if held >= shard_ids:
                    yield close()
                    doc_ids, ids, held, number = [], [], 0, number + 1
        if ids:
            yield close()
    return run


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the shard files of ``docs`` (doc_id, text) under ``path``; the manifest, with each file's first position."""
    files, root = pafs.FileSystem.from_uri(path)
    files.create_dir(root, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    dealt = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    manifest = staged(dealt.mapInArrow(_write_task(path, tokenizer, end_id, shard_ids),
                                       "file string, n_docs long, n_ids long"), "manifest")
    # one row per file: small beside the ids by the size of a shard
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn(
        "base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def _read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            shard = Shard(batch.column(1)[i].as_buffer().to_pybytes())
            for first in range(0, shard.docs, READ_DOCS):
                last = min(first + READ_DOCS, shard.docs)
                b = shard.select(np.arange(first, last + 1))
                crc = [zlib.crc32(shard.ids[s:e].astype("<u4").tobytes()) for s, e in zip(b[:-1], b[1:])]
                yield pa.record_batch(
                    [pa.array([batch.column(0)[i].as_py()] * (last - first), pa.string()),
                     pa.array(shard.doc_ids[first:last], pa.int64(), mask=shard.no_id[first:last]), pa.array(b[:-1]), pa.array(np.diff(b)),
                     pa.array(crc, pa.int64())], names=["file", "doc_id", "at", "n_tokens", "ids_crc32"])


def read(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.tef").load(path)
    found = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").mapInArrow(
        _read_task, "file string, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(manifest.select("file", "base"), "file").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the files into the shared folder and read them back."""
    path = shared_path(docs.sparkSession, "token-store")
    manifest = write(docs, path, tokenizer, end_id)
    if manifest.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read(docs.sparkSession, path, manifest)
