"""Release-schema views over the driver's TPC-H-like tables.

The analytic and fold operators are written against the release schema; this
module maps the driver tables onto it so every operator gets a query whose
work grows with the given tables, and a DuckDB oracle with the same CTEs.

Mapping (one definition, used by Spark and by the SQL oracle):

==================  ==========================================================
releases            one per order: ocid = o_orderkey, method details =
                    o_orderpriority, tender start = o_orderdate, tender end =
                    first ship date of the order's lines, buyer = 'OP-'+custkey
parties             customers ('OP-'+c_custkey, c_name) and suppliers
                    ('FO-'+s_suppkey, s_name)
release_parties     (order, buyer, 'buyer') and distinct (order, line supplier,
                    'supplier')
contracts           one per order: value = o_totalprice, signed = o_orderdate,
                    period end = last ship date of the order's lines
awards              one per line: award_id = 'orderkey-linenumber-partkey-suppkey'
bids                lines with l_linestatus = 'F', party = line supplier,
                    insertion order = (linenumber, partkey, suppkey, price, shipdate)
contract_transactions  lines with l_returnflag = 'R'
==================  ==========================================================

Amounts are cast to DECIMAL(15,2) per operand before any arithmetic, so sums
do not depend on addition order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(15,2)"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _line_key() -> F.Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lazily built release-schema frames; nothing is materialised here."""
    orders = read(spark, sf_dir, "orders")
    lineitem = read(spark, sf_dir, "lineitem")
    customer = read(spark, sf_dir, "customer")
    supplier = read(spark, sf_dir, "supplier")

    ship = (lineitem.groupBy("l_orderkey")
            .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")))
    o = orders.join(ship, orders.o_orderkey == ship.l_orderkey, "left")

    releases = o.select(
        F.col("o_orderkey").alias("ocid"),
        F.col("o_orderkey").alias("release_id"),
        F.col("o_orderstatus").alias("tender_status"),
        F.col("o_orderpriority").alias("tender_procurement_method_details"),
        F.concat(F.lit("OP-"), F.col("o_custkey").cast("string")).alias("tender_procuring_entity_id"),
        F.col("o_orderdate").alias("tender_start_date"),
        F.col("first_ship").alias("tender_end_date"),
    )
    contracts = o.select(
        F.col("o_orderkey").cast("string").alias("contract_id"),
        F.col("o_orderkey").alias("ocid"),
        F.col("o_totalprice").cast(MONEY).alias("value_amount"),
        F.col("o_orderdate").alias("date_signed"),
        F.col("last_ship").alias("period_end_date"),
    )
    parties = (customer.select(F.concat(F.lit("OP-"), F.col("c_custkey").cast("string")).alias("party_id"),
                               F.col("c_name").alias("name"))
               .unionByName(supplier.select(F.concat(F.lit("FO-"), F.col("s_suppkey").cast("string")).alias("party_id"),
                                            F.col("s_name").alias("name"))))
    release_parties = (orders.select(F.col("o_orderkey").alias("ocid"),
                                     F.concat(F.lit("OP-"), F.col("o_custkey").cast("string")).alias("party_id"),
                                     F.lit("buyer").alias("role"))
                       .unionByName(lineitem.select(F.col("l_orderkey").alias("ocid"),
                                                    F.concat(F.lit("FO-"), F.col("l_suppkey").cast("string")).alias("party_id"),
                                                    F.lit("supplier").alias("role")).distinct()))
    awards = lineitem.select(_line_key().alias("award_id"), F.col("l_orderkey").alias("ocid"),
                             F.col("l_extendedprice").cast(MONEY).alias("value_amount"))
    bids = (lineitem.where(F.col("l_linestatus") == "F")
            .select(F.concat(F.lit("FO-"), F.col("l_suppkey").cast("string")).alias("party_id"),
                    F.col("l_orderkey").alias("ocid"),
                    F.col("l_extendedprice").cast(MONEY).alias("value"),
                    F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
                    .alias("bid_row_id")))
    transactions = (lineitem.where(F.col("l_returnflag") == "R")
                    .select(F.col("l_orderkey").alias("ocid"), _line_key().alias("transaction_id"),
                            F.col("l_extendedprice").cast(MONEY).alias("value_amount")))
    return {"releases": releases, "contracts": contracts, "parties": parties,
            "release_parties": release_parties, "awards": awards, "bids": bids,
            "contract_transactions": transactions}


# The same model for DuckDB. Each oracle query starts with ``WITH`` + this text.
MODEL_SQL = """
m_ship AS (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
           FROM lineitem GROUP BY l_orderkey),
m_o AS (SELECT * FROM orders LEFT JOIN m_ship ON o_orderkey = l_orderkey),
m_releases AS (SELECT o_orderkey AS ocid, o_orderkey AS release_id, o_orderstatus AS tender_status,
                      o_orderpriority AS tender_procurement_method_details,
                      'OP-' || CAST(o_custkey AS VARCHAR) AS tender_procuring_entity_id,
                      o_orderdate AS tender_start_date, first_ship AS tender_end_date FROM m_o),
m_contracts AS (SELECT CAST(o_orderkey AS VARCHAR) AS contract_id, o_orderkey AS ocid,
                       CAST(o_totalprice AS DECIMAL(15,2)) AS value_amount,
                       o_orderdate AS date_signed, last_ship AS period_end_date FROM m_o),
m_parties AS (SELECT 'OP-' || CAST(c_custkey AS VARCHAR) AS party_id, c_name AS name FROM customer
              UNION ALL SELECT 'FO-' || CAST(s_suppkey AS VARCHAR), s_name FROM supplier),
m_release_parties AS (SELECT o_orderkey AS ocid, 'OP-' || CAST(o_custkey AS VARCHAR) AS party_id, 'buyer' AS role
                      FROM orders
                      UNION ALL SELECT DISTINCT l_orderkey, 'FO-' || CAST(l_suppkey AS VARCHAR), 'supplier'
                      FROM lineitem),
m_awards AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS award_id,
                    l_orderkey AS ocid, CAST(l_extendedprice AS DECIMAL(15,2)) AS value_amount FROM lineitem),
m_bids AS (SELECT 'FO-' || CAST(l_suppkey AS VARCHAR) AS party_id, l_orderkey AS ocid,
                  CAST(l_extendedprice AS DECIMAL(15,2)) AS value,
                  l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate
           FROM lineitem WHERE l_linestatus = 'F'),
m_transactions AS (SELECT l_orderkey AS ocid,
                          concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS transaction_id,
                          CAST(l_extendedprice AS DECIMAL(15,2)) AS value_amount
                   FROM lineitem WHERE l_returnflag = 'R')
"""


def with_model(sql_body: str, extra_ctes: str = "") -> str:
    """Prefix a query with the model CTEs (and optional further CTEs)."""
    ctes = MODEL_SQL.strip()
    if extra_ctes:
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{sql_body.strip()}"
