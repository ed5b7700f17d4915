"""Bounded training samples from the labels table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenderfold.llm.common import held_out


def training_texts(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int) -> list[tuple[str, int]]:
    """(text, label) of at most ``per_class`` rows of each class, lowest hashes of the doc_id first.

    Held-out documents, NULL labels and NULL texts are left out. Only training
    is bounded (rows, and ``max_chars`` per text so that the driver's memory
    is); scoring reads every whole text.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(
        "doc_id", F.col(label).cast("int").alias("_label"))
    picked = None
    for value in (0, 1):
        # twice the rows, since some labelled documents are too long or missing
        part = usable.where(F.col("_label") == value).dropDuplicates(["doc_id"]).orderBy(
            F.xxhash64("doc_id"), "doc_id").limit(2 * per_class)
        picked = part if picked is None else picked.unionByName(part)
    # broadcast: at most 4 * per_class ids by construction
    rows = docs.where(F.length("text").between(1, max_chars)).join(F.broadcast(picked), "doc_id").select(
        "doc_id", "text", "_label")
    out = []
    for value in (0, 1):
        best = rows.where(F.col("_label") == value).orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(per_class)
        out += [(r["text"], value) for r in best.collect()]
    return out
