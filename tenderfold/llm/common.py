"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tenderfold.session import ensure_checkpoint_dir

# The white space that separates words in every operator here.
WORD_SPACE = " \t\n\x0b\x0c\r"
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it inside ``body``.

    A lambda variable is bound once, whereas a plain column expression used
    inside a higher-order function would be evaluated again for each element.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a non-NULL text: runs without ASCII white space."""
    return let(F.btrim(text, F.lit(WORD_SPACE)), lambda t: (
        F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, WORD_SPLIT))))


def held_out(doc_id: Column) -> Column:
    """True for the documents whose labels are never learnt from (crc32 of the id as text, modulo 5, is 0)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor costs only the tasks that read the
    written files, and columns that a reader drops are not read at all.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def heavy_bound(total: int, most: int, least: int) -> int:
    """Rows from which a key counts as heavy: ``most`` keys at most can reach it among ``total`` rows."""
    return max(least, -(-total // most))


HEAVY_LEAST = 2_000         # rows of a key below which it is never heavy
HEAVY_KEYS = 100_000        # heavy keys that a broadcast list may hold


def join_heavy(rows: DataFrame, side: DataFrame, on: list[str], weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``side`` (one row per key; ``weight``: about how many of the ``total`` rows have it).

    Rows of heavy keys stay where they are: those keys are broadcast, HEAVY_KEYS
    at most by the bound on their weight. All other rows are shuffled by key.
    """
    bound = heavy_bound(total, HEAVY_KEYS, HEAVY_LEAST)
    heavy = F.broadcast(side.where(F.col(weight) >= bound))
    light = rows.join(heavy.select(on), on, "left_anti").join(side.where(F.col(weight) < bound), on)
    return rows.join(heavy, on).unionByName(light)
