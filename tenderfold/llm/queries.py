"""Registered queries of the training-data operators (one ``opN_`` per operator)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenderfold.llm.common import held_out
from tenderfold.llm import (centroids, decontam, fim, line_rules, packing, partenum, pii_crf, quality_cnn, suffix_dedup,
                            token_prefix, token_store, toxicity, url_gbt)

TOKENIZERS = "/opt/tokenizers"        # where the public tokenizer files lie, unless the package that holds them is installed

QUERIES = {}
ORACLE_SQL = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn
    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Path of a public tokenizer file (the same on every executor)."""
    try:
        import public_tokenizers
    except ModuleNotFoundError:
        return f"{TOKENIZERS}/{name}"
    return str(public_tokenizers.path(name))


@register("op7_line_rules")
def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines_removed", "lost_chars")


@register("op2_url_gbt")
def op2_url_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_gbt.judge(pages).select("page_id", "host", "path", "rule", "verdict", "score")


@register("op6_partenum_join")
def op6_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_components(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op5_token_store")
def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_store.write_and_read(docs, tokenizer_path("word_bpe_49k.json"), end_id=1)


@register("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), end_id=0).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register("op4_prefix_token_counts")
def op4_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_prefix.budget_answers(docs, tokenizer_path("byte_bpe_50k.json"), budget=1024)


@register("op1_toxicity_grammar")
def op1_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@register("op3_quality_cnn")
def op3_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_cnn.score(docs, _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@register("op10_pii_crf")
def op10_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.spans(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op9_cgk_decontamination")
def op9_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))


_FIM_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || doc_id) AS x FROM documents),
hashed AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
         ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM units),
cut AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b, u,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM hashed),
parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts"""


@register("op11_fim_swar", _FIM_SQL)
def op11_fim_swar(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(_table(spark, sf_dir, "documents").select("doc_id", "text"), seed=7, rate=100, spm_percent=50)
    back = fim.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


_WINDOWS_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS MATERIALIZED (
  SELECT doc_id, s, sha256(array_to_string(w[s:s + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50)),
first AS (SELECT h, min(doc_id) AS least FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS place FROM windows JOIN first USING (h) WHERE doc_id > least),
cut AS (SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
         CASE WHEN places IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(places, i)) END AS k
  FROM d LEFT JOIN cut USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256 FROM kept"""


@register("op12_suffix_dedup", _WINDOWS_SQL)
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.removals(docs, size=50).select("doc_id", "n_words", "n_removed", "kept_sha256")


def _centroids_sql(clusters: int = 8, rounds: int = 10) -> str:
    """The rounds one after the other, over one row per vector and component."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
e AS MATERIALIZED (SELECT r, unnest(v) AS x, unnest(range(64)) AS i FROM kept),
seeds AS (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c, v FROM kept QUALIFY c < {clusters}),
c0 AS MATERIALIZED (SELECT c, unnest(v) AS x, unnest(range(64)) AS i FROM seeds)"""]
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (
  SELECT r, (m % {clusters})::INT AS c, (m // {clusters})::BIGINT AS d FROM (
    SELECT r, min(d * {clusters} + c) AS m FROM (
      SELECT e.r, c{k}.c, sum((e.x - c{k}.x) * (e.x - c{k}.x)) AS d FROM e JOIN c{k} ON e.i = c{k}.i GROUP BY e.r, c{k}.c)
    GROUP BY r))""")
        if k < rounds:
            steps.append(f"""
c{k + 1} AS MATERIALIZED (
  SELECT c, ((s - ((s % n) + n) % n) // n)::BIGINT AS x, i
  FROM (SELECT a{k}.c, e.i, sum(e.x) AS s, count(*) AS n FROM e JOIN a{k} USING (r) GROUP BY a{k}.c, e.i)
  UNION ALL SELECT c, x, i FROM c{k} WHERE c NOT IN (SELECT c FROM a{k}))""")
    return "WITH" + ",".join(steps) + f"""
SELECT vec_id, a.c AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} a JOIN kept USING (r)
JOIN (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c) h ON h.c = a.c"""


@register("op13_centroid_expressions", _centroids_sql())
def op13_centroid_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
