"""Integrity checks, reported as rows instead of failed transactions.

Each check returns ``(table, rule, key, detail)`` rows. Failed conversions and
values wider than their column are reported by the folds themselves.
All checks are anti joins or grouped counts - nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _key_text(cols: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in cols])


def fk_orphans(child: DataFrame, child_cols: Sequence[str], parent: DataFrame, parent_cols: Sequence[str],
               table: str, rule: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent row."""
    p = parent.select(*[F.col(pc).alias(cc) for pc, cc in zip(parent_cols, child_cols)]).distinct()
    c = child.where(reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in child_cols]))
    return (c.join(p, list(child_cols), "left_anti")
            .select(F.lit(table).alias("table"), F.lit(rule).alias("rule"),
                    _key_text(child_cols).alias("key"), F.lit(None).cast("string").alias("detail")))


def duplicate_keys(df: DataFrame, key_cols: Sequence[str], table: str) -> DataFrame:
    return (df.groupBy(*key_cols).count().where(F.col("count") > 1)
            .select(F.lit(table).alias("table"), F.lit("duplicate_key").alias("rule"),
                    _key_text(key_cols).alias("key"), F.col("count").cast("string").alias("detail")))
