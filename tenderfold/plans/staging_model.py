"""Staging-schema (notice / contract / expense / supplier) views over the driver tables.

==============  ================================================================
avis            orders not pending (o_orderstatus <> 'P'): numeroseao = o_orderkey,
                categorieseao from the order priority through a small code map
                (two construction categories, one notice-only misspelling)
contrats        lines with l_linestatus = 'O' (numero = l_linenumber)
depenses        lines with l_returnflag = 'R'
avis_fournisseurs  every line: (l_orderkey, l_suppkey as neq)
fournisseurs    supplier (neq = s_suppkey)
==============  ================================================================

Pending orders have no notice, so their lines are orphan contracts/expenses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# priority -> category (FIXED VALUES used only to shape the driver data)
PRIORITY_CATEGORY = {
    "1-URGENT": "C01 - Bâtiments",
    "2-HIGH": "G25 - Constructions préfabriqués",
    "3-MEDIUM": "S5 - Services environnementaux",
}


def _category(col: str) -> F.Column:
    expr = F.col(col)
    out = None
    for k, v in PRIORITY_CATEGORY.items():
        out = (F.when(F.col(col) == k, F.lit(v)) if out is None else out.when(F.col(col) == k, F.lit(v)))
    return out.otherwise(expr)


def staging(spark: SparkSession, sf_dir: str, pending: bool = False) -> dict[str, DataFrame]:
    """The staging tables. Pending orders are no notices (so that contracts and
    expenses without a notice exist) unless ``pending`` asks for all."""
    none = lambda *names: [F.lit(None).cast("string").alias(c) for c in names]
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    avis = (orders.where(F.lit(pending) | (F.col("o_orderstatus") != "P"))
            .select(F.col("o_orderkey").alias("numeroseao"), F.col("o_orderkey").alias("numero"),
                    F.col("o_custkey").alias("organisme_key"), _category("o_orderpriority").alias("categorieseao"),
                    F.col("o_orderdate").alias("datepublication"), F.col("o_orderpriority").alias("titre"),
                    F.substring("o_orderpriority", 1, 1).alias("type"),
                    *[F.lit(None).cast("string").alias(c) for c in
                      ("nature", "precision", "hyperlienseao", "unspscprincipale", "disposition", "adresse1", "adresse2",
                       "ville", "province", "codepostal", "pays")],
                    F.concat(F.lit("Client "), F.col("o_custkey").cast("string")).alias("organisme"),
                    F.lit(0).alias("municipal"),
                    F.lit(None).cast("timestamp_ntz").alias("datefermeture")))
    contrats = (li.where(F.col("l_linestatus") == "O")
                .select(F.col("l_orderkey").alias("numeroseao"), F.col("l_linenumber").alias("numero"),
                        F.col("l_shipdate").alias("datefinale"),
                        F.col("l_extendedprice").cast("decimal(18,2)").alias("montantfinal"),
                        F.lit(None).cast("timestamp_ntz").alias("datepublicationfinale")))
    depenses = (li.where(F.col("l_returnflag") == "R")
                .select(F.col("l_orderkey").alias("numeroseao"), F.col("l_linenumber").alias("numero"),
                        F.col("l_shipdate").alias("datedepense"), F.lit("ligne").alias("description"),
                        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("depense_id"),
                        F.col("l_extendedprice").cast("decimal(18,2)").alias("montantdepense")))
    links = li.select(F.col("l_orderkey").alias("numeroseao"), F.col("l_suppkey").alias("neq"),
                      F.col("l_linenumber").alias("link_pos"),
                      F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("admissible"),
                      F.when(F.col("l_returnflag") == "N", 1).otherwise(0).alias("conforme"),
                      F.col("l_extendedprice").cast("decimal(18,2)").alias("montantsoumis"),
                      F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("adjudicataire"),
                      F.col("l_extendedprice").cast("decimal(18,2)").alias("montantcontrat"),
                      F.col("l_extendedprice").cast("decimal(18,2)").alias("montanttotalcontrat"),
                      F.lit(None).cast("string").alias("montantssoumisunite"))
    fournisseurs = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        F.col("s_suppkey").alias("neq"), F.col("s_name").alias("nomorganisation"),
        *none("adresse1", "adresse2", "ville", "province", "pays", "codepostal"))
    return {"avis": avis, "contrats": contrats, "depenses": depenses,
            "avis_fournisseurs": links, "fournisseurs": fournisseurs}


def _sql_case() -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY_CATEGORY.items())
    return f"CASE o_orderpriority {whens} ELSE o_orderpriority END"


STAGING_SQL = f"""
s_avis AS (SELECT o_orderkey AS numeroseao, o_orderkey AS numero, o_custkey AS organisme_key,
                  {_sql_case()} AS categorieseao, o_orderdate AS datepublication,
                  o_orderpriority AS titre, substr(o_orderpriority, 1, 1) AS type
           FROM orders WHERE o_orderstatus <> 'P'),
s_contrats AS (SELECT l_orderkey AS numeroseao, l_linenumber AS numero, l_shipdate AS datefinale,
                      CAST(l_extendedprice AS DECIMAL(18,2)) AS montantfinal
               FROM lineitem WHERE l_linestatus = 'O'),
s_depenses AS (SELECT l_orderkey AS numeroseao, l_linenumber AS numero, l_shipdate AS datedepense,
                      CAST(l_extendedprice AS DECIMAL(18,2)) AS montantdepense
               FROM lineitem WHERE l_returnflag = 'R'),
s_links AS (SELECT l_orderkey AS numeroseao, l_suppkey AS neq, l_linenumber AS link_pos,
                   CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS admissible,
                   CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS conforme,
                   CAST(l_extendedprice AS DECIMAL(18,2)) AS montantsoumis FROM lineitem),
s_fournisseurs AS (SELECT s_suppkey AS neq, s_name AS nomorganisation FROM supplier)
"""


def with_staging(body: str, extra: str = "", pending: bool = False) -> str:
    ctes = STAGING_SQL.strip()
    if pending:
        ctes = ctes.replace("FROM orders WHERE o_orderstatus <> 'P'", "FROM orders")
    if extra:
        ctes += ",\n" + extra.strip()
    return f"WITH {ctes}\n{body.strip()}"


def sql_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"
