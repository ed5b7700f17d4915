"""Corpus pipeline: documents through five stages of ``tenderfold.llm`` operators.

1. quality rules: rejected documents go, failing lines leave the texts;
2. n-gram Jaccard join: of each group of near copies (5-word shingles,
   similarity 0.8 or more, linked directly or through others) the document
   with the least doc_id stays;
3. benchmark decontamination: documents that leak an item go;
4. personal data: every span found is replaced by its kind;
5. best-fit packing: the remaining texts as pieces with their places.

Each stage takes (spark, docs, sf_dir), where docs are the rows that the stage
before kept, and returns a DataFrame; all but the last return the columns of
documents, with ``text`` and ``n_chars`` brought up to date. ``run`` writes each
stage as Parquet into the shared folder and reads it back for the next one.

Defined results: empty tables give empty results. Rows with a NULL text fail
the quality rules. Rows with a NULL doc_id are no near copies of anything and
stay in stage 2. Other columns of documents pass through unchanged, whatever
their names. Of rows that repeat both doc_id and text, stage 2 keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenderfold.llm import decontam, line_rules, packing, partenum, pii_crf
from tenderfold.llm.common import staged
from tenderfold.llm.queries import tokenizer_path

NEAR_WORDS = 5
NEAR_PERCENT = 80


def _sized(docs: DataFrame) -> DataFrame:
    """n_chars brought up to date, if the table has it."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(F.struct("*").alias("_row"), "text")
    judged = line_rules.judge(rows).select(F.struct("_row", "clean_text", "kept").alias("j"))
    # a generator between the verdict and the filter: else the optimizer judges each text twice, for both of them
    kept = judged.select(F.explode(F.array("j")).alias("j")).where("j.kept").select("j.*")
    return _sized(kept.select(F.col("_row").withField("text", F.col("clean_text")).alias("_row")).select("_row.*"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return partenum.representatives(docs, NEAR_WORDS, NEAR_PERCENT)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(pii_crf.mask(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), end_id=0).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", benchmark_leaks),
    ("pii", personal_data),
    ("best_fit_packing", packed),
]

ORACLE_SQL = None       # encoding and CRF spans are not SQL; tests compare every stage with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
