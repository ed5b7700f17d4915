"""Registered queries that run the whole release-JSON fold on documents built
from the driver tables (P21 -> SRC1 -> P1-P14 -> U1-U3, U10, J10, U12).

Each order is published twice: a weekly file dated at the order date carries
its 'F' lines, and a file one week later carries its 'O' lines. Every
publication holds the release (title = line status), the buyer party, one
award per line (with its supplier, a name-only party) and one contract whose
id is the order key. The later publication therefore supersedes the release
and the contract, and the earlier one goes to history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderfold.operators.release_fold import fold_release_events
from tenderfold.plans.queries import register
from tenderfold.session import staged
from tenderfold.sources import release_json as RJ

def _line_key() -> F.Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_name, value): one release document per (order, line status)."""
    rd = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    orders, li, cust, sup = rd("orders"), rd("lineitem"), rd("customer"), rd("supplier")
    lines = li.join(sup, li.l_suppkey == sup.s_suppkey).select(
        "l_orderkey", "l_linestatus", _line_key().alias("award_id"),
        F.col("l_extendedprice").cast("decimal(15,2)").alias("amount"),
        F.struct(F.concat(F.lit("FO-"), F.col("l_suppkey").cast("string")).alias("id"),
                 F.col("s_name").alias("name")).alias("supplier"))
    award = F.struct(F.col("award_id").alias("id"), F.lit("active").alias("status"),
                     F.struct(F.col("amount").alias("amount"), F.lit("CAD").alias("currency")).alias("value"),
                     F.array("supplier").alias("suppliers"))
    per_doc = (lines.groupBy("l_orderkey", "l_linestatus")      # one publication's lines: a bounded group
               .agg(F.collect_list(award).alias("awards"), F.sum("amount").alias("total"),
                    F.min("award_id").alias("first_award")))
    o = orders.join(cust, orders.o_custkey == cust.c_custkey).select(
        "o_orderkey", "o_orderdate", F.concat(F.lit("OP-"), F.col("o_custkey").cast("string")).alias("buyer"),
        "c_name")
    d = per_doc.join(o, per_doc.l_orderkey == o.o_orderkey)
    start = F.when(F.col("l_linestatus") == "O", F.date_add("o_orderdate", 7)).otherwise(F.to_date("o_orderdate"))
    ocid = F.col("o_orderkey").cast("string")
    release = F.struct(
        ocid.alias("ocid"), F.concat(ocid, F.lit("-"), F.col("l_linestatus")).alias("id"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("date"),
        F.struct(F.col("l_linestatus").alias("title"),
                 F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("startDate")).alias("tenderPeriod"))
        .alias("tender"),
        F.array(F.struct(F.col("buyer").alias("id"), F.col("c_name").alias("name"),
                         F.array(F.lit("buyer")).alias("roles"))).alias("parties"),
        F.col("awards").alias("awards"),
        F.array(F.struct(ocid.alias("id"), F.col("first_award").alias("awardID"),
                         F.struct(F.col("total").alias("amount"), F.lit("CAD").alias("currency")).alias("value")))
        .alias("contracts"))
    # the order key keeps file names unique; the period regex needs '.json' right
    # after the dates, so the key goes in front of them
    name = F.concat(F.lit("hebdo_"), ocid, F.lit("_"), F.date_format(start, "yyyyMMdd"), F.lit("_"),
                    F.date_format(F.date_add(start, 6), "yyyyMMdd"), F.lit(".json"))
    return d.select(name.alias("file_name"), F.to_json(F.struct(F.array(release).alias("releases"))).alias("value"))


def _fold(spark: SparkSession, sf_dir: str):
    """Parse once, stage every table's events once, then fold.

    Parsed rows are written once, as Parquet in the session's shared
    ``spark.checkpoint.dir``, and so is the outcome of each rejection round, so
    a lost executor only recomputes from the last of them. The per-table events
    are projections/explodes of the staged rows, which read only their own
    columns, and are re-derived rather than staged.
    """
    rows = staged(RJ.batch_rows(RJ.releases_from_text(publications(spark, sf_dir))), "release_rows")
    rejected = rows.where(F.col("reason").isNotNull()).select("file_name", "reason").distinct()
    events = RJ.release_events(RJ.batch_releases(rows))
    tables, _ = fold_release_events(events, batch_ts="2024-01-01 00:00:00", file_rejects=rejected, materialize=staged)
    return tables


def _with_state(cur: DataFrame, hist: DataFrame, cols) -> DataFrame:
    return (cur.select(*cols, F.lit("current").alias("state"))
            .unionByName(hist.select(*cols, F.lit("history").alias("state"))))


_DOCS_SQL = """
WITH d AS (SELECT l_orderkey, l_linestatus, sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS total,
                  min(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS first_award
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey, l_linestatus),
p AS (SELECT d.*, o_orderdate,
             lead(l_linestatus) OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END)
               AS nxt
      FROM d JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
"""


@register("release_fold_contracts", _DOCS_SQL + """
SELECT CAST(l_orderkey AS VARCHAR) AS contract_id, CAST(l_orderkey AS VARCHAR) AS ocid, first_award AS award_id,
       CAST(total AS DECIMAL(15,2)) AS value_amount, 'CAD' AS value_currency,
       CASE WHEN nxt IS NULL THEN 'current' ELSE 'history' END AS state
FROM p
""")
def q_release_fold_contracts(spark, sf_dir):
    """Contracts folded over two publications per order: later wins, earlier is history."""
    cur, hist = _fold(spark, sf_dir)["contracts"]
    return _with_state(cur, hist, ["contract_id", "ocid", "award_id", "value_amount", "value_currency"])


@register("release_fold_releases", _DOCS_SQL + """
SELECT CAST(l_orderkey AS VARCHAR) AS ocid, CAST(l_orderkey AS VARCHAR) || '-' || l_linestatus AS release_id,
       l_linestatus AS tender_title, o_orderdate AS tender_start_date, o_orderdate AS date,
       CASE WHEN nxt IS NULL THEN 'current' ELSE 'history' END AS state
FROM p
""")
def q_release_fold_releases(spark, sf_dir):
    """Releases folded over two publications per order."""
    cur, hist = _fold(spark, sf_dir)["releases"]
    return _with_state(cur, hist, ["ocid", "release_id", "tender_title", "tender_start_date", "date"])


@register("release_fold_parties", """
SELECT 'OP-' || CAST(c_custkey AS VARCHAR) AS party_id, c_name AS name, 'current' AS state
FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders o WHERE EXISTS
      (SELECT 1 FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey WHERE l.l_orderkey = o.o_orderkey))
UNION ALL
SELECT DISTINCT 'FO-' || CAST(s_suppkey AS VARCHAR), s_name, 'current'
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
""")
def q_release_fold_parties(spark, sf_dir):
    """Buyers (upserts) and award suppliers (name-only, insert-if-absent) after the fold."""
    cur, _ = _fold(spark, sf_dir)["parties"]
    return cur.select("party_id", "name", F.lit("current").alias("state"))
