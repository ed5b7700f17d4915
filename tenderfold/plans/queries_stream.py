"""Registered queries of the incremental fold: publications that arrive in batches, folded into a bucketed state.

Batches follow each other as a file stream delivers them, and a later batch may
hold older files (the reference applies files as they arrive). The oracles state
in SQL what one fold in the order (batch, period, file) leaves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderfold.plans.publications import release_publications, xml_publications
from tenderfold.plans.queries import register
from tenderfold.session import shared_path
from tenderfold.streaming import incremental as INC
from tenderfold.streaming import xml_incremental as XI
from tenderfold.streaming.state import BucketedState

STAMP = "2024-01-01 00:00:00"
BATCHES = 3


def _deliver(spark: SparkSession, docs: DataFrame, batch, start) -> None:
    """Hand the documents over in batches: all are written once, and each batch's files move into the folder that the stream takes in."""
    folder = shared_path(spark, "publications")
    docs.withColumn("batch", batch).write.partitionBy("batch").parquet(f"{folder}/all")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for k in range(BATCHES):
        fs.mkdirs(path(f"{folder}/inbox"))
        written, place = path(f"{folder}/all/batch={k}"), path(f"{folder}/inbox/n={k}")
        if fs.exists(written):
            if not fs.rename(written, place):
                raise RuntimeError(f"batch {k} of {folder} could not be delivered")
        else:                                           # a batch without documents
            spark.createDataFrame([], "file_name string, value string").write.parquet(f"{folder}/inbox/n={k}")
        source = spark.readStream.schema("file_name string, value string").parquet(f"{folder}/inbox/n=*")
        query = start(source, f"{folder}/checkpoint")
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()


def _rows(table: str, df: DataFrame, state: str, key1, key2=None, text=None, amount=None) -> DataFrame:
    col = lambda c: F.lit(None).cast("string") if c is None else (F.col(c) if isinstance(c, str) else c).cast("string")
    return df.select(F.lit(table).alias("table_name"), col(key1).alias("key1"), col(key2).alias("key2"), col(text).alias("text"),
                     (F.lit(None) if amount is None else F.col(amount)).cast("decimal(15,2)").alias("amount"),
                     F.lit(state).alias("state"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _release_view() -> dict[str, tuple]:
    """How the rows of a table are shown: key1, key2, text, amount."""
    return {
        "releases": ("ocid", "release_id", "tag", None), "lots": ("lot_id", "ocid", "title", None),
        "release_parties": ("ocid", "party_id", "role", None),
        "bids": ("party_id", F.concat_ws("/", "ocid", "related_lot"), F.concat_ws("/", "admissible", "conform", "value_unit"), "value"),
        "awards": ("award_id", "ocid", "status", "value_amount"), "suppliers_awards": ("award_id", "supplier_id", "supplier_ocid", None),
        "contracts": ("contract_id", "ocid", "award_id", "value_amount"),
        "contract_amendments": ("amendment_id", "contract_id", "rationale", None),
        "contract_transactions": ("transaction_id", "contract_id", "source", "value_amount"),
        "related_processes": ("id", "identifier", "relationship", None),
    }


_BATCH_SQL = "CASE WHEN status = 'O' THEN 2 WHEN o_orderpriority <= '2-HIGH' THEN 1 ELSE 0 END"

PUBLICATIONS_SQL = f"""
WITH lines AS (
  SELECT l.*, s_name, s_nationkey, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS line,
         CAST(l_extendedprice AS DECIMAL(15,2)) AS amt FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey),
pubs AS (
  SELECT o.*, c_name, coalesce(l_linestatus, 'N') AS status, CAST(o_orderkey AS VARCHAR) AS ocid,
         o_orderdate + CASE WHEN l_linestatus = 'O' THEN INTERVAL 7 DAY ELSE INTERVAL 0 DAY END AS began
  FROM orders o JOIN customer ON o_custkey = c_custkey
  LEFT JOIN (SELECT DISTINCT l_orderkey, l_linestatus FROM lines) x ON l_orderkey = o_orderkey),
p AS (
  SELECT *, row_number() OVER (ORDER BY {_BATCH_SQL}, strftime(began, '%Y%m%d'), 'hebdo_' || ocid || '_' || strftime(began, '%Y%m%d')) AS f
  FROM pubs),
pl AS (SELECT p.*, l.* EXCLUDE (l_orderkey), row_number() OVER (PARTITION BY f ORDER BY line) AS pos
       FROM p JOIN lines l ON l_orderkey = o_orderkey AND l_linestatus = status)"""


@register("stream_fold", PUBLICATIONS_SQL + """,
known AS (           -- first file of each party: as a listed party (before the file's bids), or by any award
  SELECT l_suppkey, min(CASE WHEN l_returnflag = 'A' THEN f END) AS listed, min(f) AS awarded FROM pl GROUP BY l_suppkey),
bid_events AS (
  SELECT pl.*, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE line END AS lot, q
  FROM pl JOIN known USING (l_suppkey) CROSS JOIN (SELECT unnest([0, 1]) AS q)
  WHERE (q = 0 OR l_linenumber % 3 = 2) AND (listed <= f OR awarded < f)),
party_events AS (
  SELECT 'OP-' || o_custkey AS party_id, c_name AS name, o_orderpriority AS street, f, 0 AS pos, true AS upsert FROM p
  UNION ALL SELECT 'FO-' || l_suppkey, s_name, 'N' || s_nationkey, f, pos, true FROM pl WHERE l_returnflag = 'A'
  UNION ALL SELECT 'FO-' || l_suppkey, s_name, NULL, f, 100000 + pos, false FROM pl),
party_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY party_id ORDER BY f, pos) AS nth FROM party_events),
party_versions AS (
  SELECT *, row_number() OVER (PARTITION BY party_id ORDER BY f DESC, pos DESC) AS last FROM party_ranked WHERE upsert OR nth = 1)
SELECT 'releases' AS table_name, ocid AS key1, ocid || '-' || status AS key2, status || ',' || o_orderpriority AS text,
       CAST(NULL AS DECIMAL(15,2)) AS amount,
       CASE WHEN row_number() OVER (PARTITION BY ocid ORDER BY f DESC) = 1 THEN 'current' ELSE 'history' END AS state FROM p
UNION ALL SELECT 'lots', line, ocid, l_returnflag, NULL, 'current' FROM pl
UNION ALL SELECT 'parties', party_id, name, street, NULL, CASE WHEN last = 1 THEN 'current' ELSE 'history' END FROM party_versions
UNION ALL SELECT DISTINCT 'release_parties', ocid, 'OP-' || o_custkey, unnest(['buyer', 'procuringEntity']), NULL::DECIMAL(15,2), 'current' FROM p
UNION ALL SELECT DISTINCT 'release_parties', ocid, 'FO-' || l_suppkey, 'supplier', NULL::DECIMAL(15,2), 'current' FROM pl WHERE l_returnflag = 'A'
UNION ALL SELECT 'bids', 'FO-' || l_suppkey, concat_ws('/', ocid, lot), CASE WHEN l_returnflag = 'N' THEN '1/1' ELSE '0/1' END, amt,
       CASE WHEN row_number() OVER (PARTITION BY l_suppkey, ocid, lot ORDER BY f DESC, pos DESC, q DESC) = 1 THEN 'current' ELSE 'history' END
       FROM bid_events
UNION ALL SELECT 'awards', line, ocid, 'active', amt, 'current' FROM pl
UNION ALL SELECT DISTINCT 'awards', 'PH-' || ocid, ocid, 'placeholder', NULL::DECIMAL(15,2), 'current' FROM pl WHERE o_orderpriority = '5-LOW'
UNION ALL SELECT 'suppliers_awards', line, 'FO-' || l_suppkey, ocid, NULL, 'current' FROM pl
UNION ALL SELECT 'contracts', ocid, ocid, CASE WHEN o_orderpriority = '5-LOW' THEN 'PH-' || ocid ELSE min(line) END,
       CAST(sum(amt) AS DECIMAL(15,2)),
       CASE WHEN row_number() OVER (PARTITION BY ocid ORDER BY f DESC) = 1 THEN 'current' ELSE 'history' END
       FROM pl GROUP BY ocid, f, o_orderpriority
UNION ALL SELECT 'contract_amendments', line, ocid, l_returnflag, NULL, 'current' FROM pl
UNION ALL SELECT 'contract_transactions', line, ocid, 'lines', amt, 'current' FROM pl WHERE l_returnflag = 'R'
UNION ALL SELECT 'related_processes', 'RP-' || ocid || '-' || status, ocid, 'planning,' || o_orderpriority, NULL, 'current' FROM p
""")
def q_stream_fold(spark, sf_dir):
    """ST1/ST2, P1-P14, J10, U10, F1, F6: release documents in three micro-batches, folded on touched buckets; every table."""
    root = shared_path(spark, "release_state")
    batch = F.when(F.col("status") == "O", 2).when(F.col("o_orderpriority") <= "2-HIGH", 1).otherwise(0)
    _deliver(spark, release_publications(spark, sf_dir), batch, lambda source, checkpoint: INC.stream_releases(
        source.select("file_name", "value"), root, checkpoint, batch_ts=STAMP))
    current, superseded = INC.current_tables(spark, root), INC.history_tables(spark, root)
    parts = []
    for state, rows in (("current", current), ("history", superseded)):
        parts += [_rows(t, rows[t], state, *view) for t, view in _release_view().items() if t in rows]
        parts.append(_rows("parties", rows["parties"], state, "party_id", "name", "street_address"))
    return _union(parts)


XML_SQL = """
WITH lines AS (
  SELECT l.*, s_name, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS line,
         CAST(l_extendedprice AS DECIMAL(15,2)) AS amt,
         s_name || CASE WHEN l_linestatus = 'O' THEN ' inc' ELSE '' END AS named FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey),
p AS (
  SELECT o.*, coalesce(l_linestatus, 'N') AS status, CAST(o_orderkey AS VARCHAR) AS num,
         strftime(o_orderdate + CASE WHEN l_linestatus = 'O' THEN INTERVAL 7 DAY ELSE INTERVAL 0 DAY END, '%Y%m%d') AS began,
         CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS batch
  FROM orders o JOIN customer ON o_custkey = c_custkey
  LEFT JOIN (SELECT DISTINCT l_orderkey, l_linestatus FROM lines) x ON l_orderkey = o_orderkey),
pl AS (SELECT p.*, l.* EXCLUDE (l_orderkey), row_number() OVER (PARTITION BY o_orderkey, status ORDER BY line) AS pos
       FROM p JOIN lines l ON l_orderkey = o_orderkey AND l_linestatus = status),
writes AS (
  SELECT CASE WHEN l_linenumber % 2 = 1 THEN 'neq:' || l_suppkey ELSE 'name:' || named END AS supplier_key,
         CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_suppkey AS VARCHAR) END AS neq, named, batch, began,
         'avis_' || num || '_' || began AS file, pos FROM pl),
versions AS (
  SELECT *, lag(named) OVER (PARTITION BY supplier_key ORDER BY batch, began, file, pos) AS stored,
         row_number() OVER (PARTITION BY supplier_key ORDER BY batch DESC, began DESC, file DESC, pos DESC) AS last FROM writes)"""


@register("xml_stream_fold", XML_SQL + """
SELECT 'avis' AS table_name, num AS key1, num || '-' || status AS key2,
       concat_ws('/', 'Client ' || o_custkey || ' & Fils', CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 1 WHEN '2' THEN 0 WHEN '5' THEN 1 END,
                 strftime(o_orderdate, '%Y-%m-%d')) AS text, CAST(NULL AS DECIMAL(15,2)) AS amount,
       CASE WHEN row_number() OVER (PARTITION BY num ORDER BY batch DESC) = 1 THEN 'current' ELSE 'history' END AS state FROM p
UNION ALL SELECT 'fournisseurs', supplier_key, CASE WHEN stored <> named THEN neq END, named, NULL,
       CASE WHEN last = 1 THEN 'current' ELSE 'history' END FROM versions
UNION ALL SELECT 'avis_fournisseurs', num, CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_suppkey AS VARCHAR) END,
       concat_ws('/', named, CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END), amt, 'current'
       FROM pl WHERE batch = (SELECT max(batch) FROM p q WHERE q.o_orderkey = pl.o_orderkey)
UNION ALL SELECT 'contrats', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
       strftime(l_shipdate, '%Y-%m-%d') || '/' || l_suppkey, amt,
       CASE WHEN row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY line DESC) = 1 THEN 'current' ELSE 'history' END
       FROM lines WHERE l_linestatus = 'O'
UNION ALL SELECT 'depenses', CAST(l_orderkey AS VARCHAR), CAST(l_orderkey AS VARCHAR), line, amt, 'current' FROM lines WHERE l_returnflag = 'R'
""")
def q_xml_stream_fold(spark, sf_dir):
    """ST1/ST2, SRC2-SRC5, U4-U6, U8, X15: notice, contract and expense files in three micro-batches, supplier identity carried over."""
    root = shared_path(spark, "staging_state")
    batch = (F.when(F.col("kind") == "avis", F.when(F.col("status") == "O", 1).otherwise(0))
             .when((F.col("kind") == "contrats") & (F.col("o_orderpriority") <= "2-HIGH"), 1).otherwise(2))
    _deliver(spark, xml_publications(spark, sf_dir), batch, lambda source, checkpoint: XI.stream_notices(
        source.select("file_name", "value"), root, checkpoint, batch_ts=STAMP))
    view = {
        "avis": ("numeroseao", "numero", F.concat_ws("/", "organisme", "municipal", F.date_format("datepublication", "yyyy-MM-dd")), None),
        "fournisseurs": ("supplier_key", "existing_neq", "nomorganisation", None),
        "avis_fournisseurs": ("numeroseao", "neq", F.concat_ws("/", "nomorganisation", "admissible"), "montantsoumis"),
        "contrats": ("numeroseao", "numero", F.concat_ws("/", F.date_format("datefinale", "yyyy-MM-dd"), "neqcontractant"), "montantfinal"),
        "depenses": ("numeroseao", "numero", "description", "montantdepense"),
    }
    current, superseded = XI.staging_tables(spark, root), XI.staging_histories(spark, root)
    return _union([_rows(t, rows[t], state, *view[t]) for state, rows in (("current", current), ("history", superseded))
                   for t in view if t in rows])


@register("history_append", PUBLICATIONS_SQL + """
SELECT ocid AS contract_id, CASE WHEN o_orderpriority = '5-LOW' THEN 'PH-' || ocid ELSE min(line) END AS award_id,
       CAST(sum(amt) AS DECIMAL(15,2)) AS value_amount,
       CASE WHEN lead(f) OVER (PARTITION BY ocid ORDER BY f) IS NOT NULL THEN 'load-2' END AS superseded_by
FROM pl GROUP BY ocid, f, o_orderpriority
""")
def q_history_append(spark, sf_dir):
    """SNK1/SNK2, U3: a load, a second load onto the stored tables, and the second one started again; contracts and their history."""
    root = shared_path(spark, "loaded")
    docs = release_publications(spark, sf_dir)
    for run, batch in (("load-1", docs.where("status != 'O'")), ("load-2", docs.where("status = 'O'")),
                       ("load-2", docs.where("status = 'O'"))):
        state = INC.release_state(spark, root)
        INC.fold_releases(batch.select("file_name", "value"), run, state, batch_ts=STAMP)
    cols = ["contract_id", "award_id", "value_amount"]
    current, superseded = INC.current_tables(spark, root)["contracts"], INC.history_tables(spark, root)["contracts"]
    return current.select(*cols, F.lit(None).cast("string").alias("superseded_by")).unionByName(
        superseded.select(*cols, F.col("run").alias("superseded_by")))
