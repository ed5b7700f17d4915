"""Best-fit packing planned on the length histogram.

Texts are encoded, closed by an end id, and only texts longer than a sequence
are cut into full pieces and a last shorter one. The plan works on counts per
length, never on documents: lengths from long to short, each taking the open
sequences with the least room that still fits, whole runs of equal sequences
at a time. A plan row says: the ranks ``rank_lo`` to ``rank_hi`` of this
length fill ``copies`` slots in each of a run of sequences. Documents then
take their slots by joining on (length, rank within the length).

The histogram and the plan have a size bound that does not depend on the
data: at most ``capacity`` lengths, and a few plan rows for each (every length
splits at most one run twice). Ranks are counted in two levels, within
(length, chunk of rows) and over the chunks' counts, so a length that a third
of all rows share is spread over its chunks.

Defined results: NULL or empty text is the end id alone. Repeated rows are
packed one by one. Rows with a NULL doc_id are packed like others. An empty
table gives no rows. ``pack_documents`` reads doc_id and text alone; other
columns of ``pack`` pass through unless they are named rank, rank_lo, rank_hi,
copies, first, at, or with a leading underscore.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tenderfold.llm.common import staged
from tenderfold.llm.word_bpe import encoder

CAPACITY = 2048
CHUNK_ROWS = 2_000          # rows per chunk of the two-level rank, on average
BATCH_PIECES = 20_000

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces_task(tokenizer: str, end_id: int, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.width)
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            doc, piece, start, length, crc, ids = zip(*rows)
            columns = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
                names.append("ids")
            return pa.record_batch(columns, names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.concatenate([enc.encode(batch.column(1)[i].as_py()), end]).astype("<u4")
                doc_id = batch.column(0)[i].as_py()
                for piece, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at:at + capacity].tobytes()
                    rows.append((doc_id, piece, at, len(part) // 4, zlib.crc32(part), part if with_ids else None))
                if len(rows) >= BATCH_PIECES:
                    yield flush()
                    rows = []
        if rows:
            yield flush()
    return run


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32 (and ids, 32-bit little endian, if wanted)."""
    schema = PIECE_SCHEMA + (", ids binary" if with_ids else "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_pieces_task(tokenizer, end_id, capacity, with_ids), schema)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, rank_lo, rank_hi, copies, first sequence, first offset)."""
    rows, rooms = [], []                       # rooms: sorted distinct room sizes of open runs
    runs: dict[int, list[tuple[int, int]]] = {}  # room -> runs (first sequence, number of sequences)
    sequences = 0

    def give(room: int, first: int, number: int) -> None:
        if room and number:
            if room not in runs:
                runs[room] = []
                insort(rooms, room)
            runs[room].append((first, number))

    for length in sorted(histogram, reverse=True):
        rank, end = 0, histogram[length]
        while rank < end:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = runs[room].pop()
                if not runs[room]:
                    del runs[room]
                    rooms.pop(at)
            else:                              # as many new sequences as the rest of this length needs
                room, first = capacity, sequences
                number = -(-(end - rank) // (capacity // length))
                sequences += number
            copies = room // length
            full = min(number, (end - rank) // copies)
            if full:
                rows.append((length, rank, rank + full * copies, copies, first, capacity - room))
                rank += full * copies
                give(room - copies * length, first, full)
            first, number = first + full, number - full
            if number and rank < end:          # fewer are left than one sequence could take
                last = end - rank
                rows.append((length, rank, end, last, first, capacity - room))
                rank = end
                give(room - last * length, first, 1)
                first, number = first + 1, number - 1
            give(room, first, number)
    return rows


def ranked(parts: DataFrame, n_rows: int) -> DataFrame:
    """Add rank (from 0) within the length, counted in two levels."""
    chunks = max(1, -(-n_rows // CHUNK_ROWS))
    keyed = parts.withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(chunks)))
    order = Window.partitionBy("length", "_chunk").orderBy("doc_id", "piece", "ids_crc32")
    local = keyed.withColumn("_local", F.row_number().over(order) - 1)
    before = Window.partitionBy("length").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = keyed.groupBy("length", "_chunk").agg(F.count("*").alias("_n")).select(
        "length", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return local.join(base, ["length", "_chunk"]).withColumn("rank", F.col("_base") + F.col("_local")).drop(
        "_chunk", "_local", "_base")


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to every piece (columns doc_id, piece, length, ids_crc32 and any others)."""
    spark = parts.sparkSession
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.createDataFrame(
        plan(counts, capacity), "length long, rank_lo long, rank_hi long, copies long, first long, at long")
    placed = ranked(parts, sum(counts.values())).join(
        # a few rows per length of at most `capacity` lengths, whatever the data
        F.broadcast(slots.withColumnRenamed("length", "_length")),
        (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("rank_lo")) & (F.col("rank") < F.col("rank_hi")))
    return placed.withColumns({
        "sequence_id": F.expr("first + (rank - rank_lo) div copies"),
        "offset": F.expr("at + (rank - rank_lo) % copies * length")}).drop(
        "rank", "_length", "rank_lo", "rank_hi", "copies", "first", "at")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY,
                   with_ids: bool = False) -> DataFrame:
    """Encode, cut and pack whole documents."""
    return pack(staged(pieces(docs, tokenizer, end_id, capacity, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (32-bit little endian); needs pieces with their ids."""
    return packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_p")).select(
        "sequence_id", F.aggregate("_p", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"])).alias("ids"))
