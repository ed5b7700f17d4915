"""Keyed upsert with history, as a set-based fold of a version log.

Every loader emits, per target table, rows ``(key..., seq, kind, payload...)``:

* ``seq``  - a sortable value (often a struct: file period, file name, position
  in file, stage, element position) giving the order the reference applies
  the writes in;
* ``kind`` - ``'upsert'`` (insert or overwrite) or ``'ins_if_absent'`` (insert
  only when the key does not exist yet, e.g. placeholder awards, name-only
  parties, role links).

The reference applies these row by row against a keyed table whose update
trigger copies the old row to ``<table>_history`` on *every* update (even a
no-change one). The same outcome as sets:

* an ``ins_if_absent`` event is applied iff it is the first event of its key
  (no deletes exist, so any earlier event created the key);
* the applied events of a key, in ``seq`` order, are its versions;
* the last version is the current row, every earlier one a history row.

Plan: one grouped aggregate per key (``min(seq)`` and ``max(seq)`` over
upserts, combined map-side, so a hot key never gathers in one task), joined
back to the log on the key. The log is shuffled once; AQE's skew-join split
handles a key that holds a large share of rows. There is no window; the struct
minimum and maximum are sort-based aggregates.

``classify_within`` gives the same states by a window over rows that the caller
has partitioned, for keys that it knows to be of bounded size (stored state:
``streaming/state.py`` counts first, and sends hot keys through ``classify``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPSERT = "upsert"
INS_IF_ABSENT = "ins_if_absent"

CURRENT = "current"
HISTORY = "history"
SKIPPED = "skipped"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join on keys treating NULL = NULL (reference keys like related_lot IS NULL)."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond).drop(*[f"__r_{k}" for k in keys])


def classify(log: DataFrame, key: str | Sequence[str], seq: str = "seq", kind: str | None = "kind",
             null_safe: bool = False) -> DataFrame:
    """Add ``state`` in {current, history, skipped} to every log row.

    ``null_safe`` makes NULL key parts equal to each other (F6).
    """
    keys = _keys(key)
    stats = [what.alias(name) for name, what in _stats(seq, kind).items()]
    per_key = log.groupBy(*keys).agg(*stats)
    joined = _null_safe_join(log, per_key, keys) if null_safe else log.join(per_key, keys)
    return _with_state(joined, seq, kind)


def _stats(seq: str, kind: str | None) -> dict[str, Column]:
    """What must be known of a key: its last event if every event is kept, else its first one and its last upsert."""
    if kind is None:
        return {"__last": F.max(seq)}
    return {"__first": F.min(seq), "__last_upsert": F.max(F.when(F.col(kind) == UPSERT, F.col(seq)))}


def _with_state(log: DataFrame, seq: str, kind: str | None) -> DataFrame:
    if kind is None:
        return log.withColumn("state", F.when(F.col(seq) == F.col("__last"), CURRENT).otherwise(HISTORY)).drop("__last")
    last_kept = F.when(F.col("__last_upsert").isNull(), F.col("__first")) \
        .otherwise(F.greatest(F.col("__first"), F.col("__last_upsert")))
    kept = (F.col(kind) == UPSERT) | (F.col(seq) == F.col("__first"))
    state = (F.when(~kept, F.lit(SKIPPED))
             .when(F.col(seq) == last_kept, F.lit(CURRENT))
             .otherwise(F.lit(HISTORY)))
    return log.withColumn("state", state).drop("__first", "__last_upsert")


def classify_within(log: DataFrame, key: str | Sequence[str], within: str, seq: str = "seq", kind: str | None = "kind",
                    null_safe: bool = False) -> DataFrame:
    """``classify`` for a log that is partitioned by ``within``, a column that is the same for all rows of a key.

    Rows are compared where they are: one sort, no aggregate to join back. All
    rows of a key go through one task, so the caller keeps hot keys out.
    """
    keys = _keys(key)
    rows = log if null_safe else log.dropna(subset=keys)            # as a join on the key leaves them out
    w = Window.partitionBy(within, *keys)
    return _with_state(rows.withColumns({name: what.over(w) for name, what in _stats(seq, kind).items()}), seq, kind)


def latest(log: DataFrame, key: str | Sequence[str], seq: str = "seq", null_safe: bool = False) -> DataFrame:
    """W3 where every event is an upsert: the row with the greatest ``seq`` of each key.

    One scan and one exchange: whole rows are compared within each task before
    the shuffle, so a hot key sends one row per task. ``seq`` tells the versions
    of a key apart (of rows that share it, one stays). Rows with a NULL key part
    are left out, as a join on the key leaves them out, unless ``null_safe``.
    """
    keys = _keys(key)
    rows = log if null_safe else log.dropna(subset=keys)
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*log.columns), seq).alias("__row")).select("__row.*")


def current(log: DataFrame, key, seq: str = "seq", kind: str | None = "kind", null_safe: bool = False) -> DataFrame:
    """What the keyed upserts leave in the table."""
    if kind is None:
        return latest(log, key, seq, null_safe)
    return classify(log, key, seq, kind, null_safe).where(F.col("state") == CURRENT).drop("state")


def history(log: DataFrame, key, seq: str = "seq", kind: str | None = "kind", null_safe: bool = False) -> DataFrame:
    """Every superseded version (one row per update, even a no-change one)."""
    return classify(log, key, seq, kind, null_safe).where(F.col("state") == HISTORY).drop("state")


def fold_increment(state_current: DataFrame, batch_log: DataFrame, key, seq: str = "seq",
                   kind: str | None = "kind", null_safe: bool = False, materialize=None) -> tuple[DataFrame, DataFrame]:
    """ST2: fold one batch into the persisted current table.

    ``materialize(df, name) -> df`` (optional) writes the classified rows and
    reads them back, so a later fold does not contain this one's plan.

    The stored current rows re-enter the log as upserts at their own ``seq``;
    the result is (new current, history delta of this batch). Folding in two
    batches equals folding once, because the stored current row is the only
    earlier version that can still be superseded or block an insert-if-absent.
    """
    prev = state_current
    if kind is not None:
        prev = prev.withColumn(kind, F.lit(UPSERT))
    both = prev.unionByName(batch_log)
    cls = classify(both, key, seq, kind, null_safe)
    if materialize is not None:
        cls = materialize(cls, "classified")
    return (cls.where(F.col("state") == CURRENT).drop("state"),
            cls.where(F.col("state") == HISTORY).drop("state"))


def replace_child_set(children: DataFrame, parents: DataFrame, key, seq: str = "seq") -> DataFrame:
    """Delete-then-insert of a parent's children, per key.

    The surviving children are those written by the parent's last occurrence;
    the max is computed over parents, not over children, so a last parent
    without children leaves none.
    """
    keys = _keys(key)
    last = parents.groupBy(*keys).agg(F.max(seq).alias("__last"))
    return (children.join(last, keys)
            .where(F.col(seq) == F.col("__last"))
            .drop("__last"))


def append_only(*logs: DataFrame) -> DataFrame:
    """Append load, duplicates kept."""
    out = logs[0]
    for d in logs[1:]:
        out = out.unionByName(d)
    return out
