"""Registered queries for migration selection, stubs, checks, counts, backfill,
file order and JSON extraction (staging model over the driver tables)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderfold import codes
from tenderfold.operators import checks as C
from tenderfold.operators import policies as P
from tenderfold.plans.queries import METHODS, code_case, register
from tenderfold.plans.staging_model import sql_list, staging, with_staging
from tenderfold.session import ensure_checkpoint_dir, spread
from tenderfold.sources import files as SF

_NOTICE_CATS = sql_list(codes.CONSTRUCTION_NOTICE_CATEGORIES)
_CONTRACT_CATS = sql_list(codes.CONSTRUCTION_CONTRACT_CATEGORIES)


def _selected(spark, sf_dir, policy):
    s = staging(spark, sf_dir)
    return P.select_staging(policy, s["avis"], s["contrats"], s["depenses"])


def _tagged(n, c, d):
    return (n.select(F.lit("notice").alias("tbl"), "numeroseao", F.col("numero").cast("bigint").alias("numero"))
            .unionByName(c.select(F.lit("contract").alias("tbl"), "numeroseao",
                                  F.col("numero").cast("bigint").alias("numero")))
            .unionByName(d.select(F.lit("expense").alias("tbl"), "numeroseao",
                                  F.col("numero").cast("bigint").alias("numero"))))


@register("select_exists", with_staging(f"""
SELECT a.numeroseao, a.categorieseao FROM s_avis a
WHERE a.categorieseao IN {_NOTICE_CATS}
  AND EXISTS (SELECT 1 FROM s_contrats c WHERE c.numeroseao = a.numeroseao)
"""))
def q_select_exists(spark, sf_dir):
    """Notices in a construction category with a contract (first script)."""
    n, _, _ = _selected(spark, sf_dir, P.CONSTRUCTION_WITH_CONTRACTS)
    return n.select("numeroseao", "categorieseao")


@register("select_in", with_staging(f"""
SELECT c.numeroseao, c.numero, c.montantfinal FROM s_contrats c
WHERE c.numeroseao IN (SELECT a.numeroseao FROM s_avis a WHERE a.categorieseao IN {_CONTRACT_CATS})
"""))
def q_select_in(spark, sf_dir):
    """Contracts whose notice is in a category (IN subquery)."""
    _, c, _ = _selected(spark, sf_dir, P.CONSTRUCTION_WITH_CONTRACTS)
    return c.select("numeroseao", "numero", "montantfinal")


@register("select_nested", with_staging(f"""
SELECT d.numeroseao, d.numero, d.montantdepense FROM s_depenses d
WHERE d.numeroseao IN (SELECT a.numeroseao FROM s_avis a WHERE a.categorieseao IN {_CONTRACT_CATS}
                       AND EXISTS (SELECT 1 FROM s_contrats c WHERE c.numeroseao = a.numeroseao))
"""))
def q_select_nested(spark, sf_dir):
    """Expenses whose notice is in a category and has a contract."""
    _, _, d = _selected(spark, sf_dir, P.CONSTRUCTION_WITH_CONTRACTS)
    return d.select("numeroseao", "numero", "montantdepense")


@register("select_or", with_staging(f"""
SELECT 'notice' AS tbl, a.numeroseao, CAST(a.numero AS BIGINT) AS numero FROM s_avis a
WHERE a.categorieseao IN {_CONTRACT_CATS}
  AND (EXISTS (SELECT 1 FROM s_contrats c WHERE c.numeroseao = a.numeroseao)
       OR EXISTS (SELECT 1 FROM s_depenses d WHERE d.numeroseao = a.numeroseao))
UNION ALL
SELECT 'contract', c.numeroseao, CAST(c.numero AS BIGINT) FROM s_contrats c
WHERE EXISTS (SELECT 1 FROM s_avis a WHERE a.numeroseao = c.numeroseao AND a.categorieseao IN {_CONTRACT_CATS})
   OR EXISTS (SELECT 1 FROM s_depenses d WHERE d.numeroseao = c.numeroseao)
UNION ALL
SELECT 'expense', d.numeroseao, CAST(d.numero AS BIGINT) FROM s_depenses d
WHERE EXISTS (SELECT 1 FROM s_avis a WHERE a.numeroseao = d.numeroseao AND a.categorieseao IN {_CONTRACT_CATS})
   OR EXISTS (SELECT 1 FROM s_contrats c WHERE c.numeroseao = d.numeroseao)
"""))
def q_select_or(spark, sf_dir):
    """The 'contract or expense' policy, all three tables."""
    return _tagged(*_selected(spark, sf_dir, P.CONSTRUCTION_CONTRACT_OR_EXPENSE))


@register("select_related", with_staging("""
SELECT 'notice' AS tbl, a.numeroseao, CAST(a.numero AS BIGINT) AS numero FROM s_avis a
WHERE EXISTS (SELECT 1 FROM s_contrats c WHERE c.numeroseao = a.numeroseao)
   OR EXISTS (SELECT 1 FROM s_depenses d WHERE d.numeroseao = a.numeroseao)
UNION ALL
SELECT 'contract', c.numeroseao, CAST(c.numero AS BIGINT) FROM s_contrats c
WHERE EXISTS (SELECT 1 FROM s_avis a WHERE a.numeroseao = c.numeroseao)
   OR EXISTS (SELECT 1 FROM s_depenses d WHERE d.numeroseao = c.numeroseao)
UNION ALL
SELECT 'expense', d.numeroseao, CAST(d.numero AS BIGINT) FROM s_depenses d
WHERE EXISTS (SELECT 1 FROM s_avis a WHERE a.numeroseao = d.numeroseao)
   OR EXISTS (SELECT 1 FROM s_contrats c WHERE c.numeroseao = d.numeroseao)
"""))
def q_select_related(spark, sf_dir):
    """The 'related notices and contracts only' policy."""
    return _tagged(*_selected(spark, sf_dir, P.RELATED_ONLY))


@register("stub_releases", with_staging("""
SELECT 'ocds-ec9k95-' || CAST(k.numeroseao AS VARCHAR) AS ocid,
       'ocds-ec9k95-' || CAST(k.numeroseao AS VARCHAR) AS release_id, k.tag
FROM (SELECT numeroseao, min(tag) AS tag FROM (
        SELECT numeroseao, 'contrat' AS tag FROM s_contrats
        UNION ALL SELECT numeroseao, 'depense' FROM s_depenses) x
      WHERE numeroseao NOT IN (SELECT numeroseao FROM s_avis)
      GROUP BY numeroseao) k
"""))
def q_stub_releases(spark, sf_dir):
    """P20: bare releases for orphan contracts/expenses (all-data policy)."""
    n, c, d = _selected(spark, sf_dir, P.ALL_DATA)
    return P.stub_releases(n, c, d)


@register("orphans_check", with_staging("""
SELECT 'contrats' AS "table", 'fk_notice' AS rule, CAST(c.numeroseao AS VARCHAR) AS "key",
       CAST(NULL AS VARCHAR) AS detail
FROM s_contrats c WHERE NOT EXISTS (SELECT 1 FROM s_avis a WHERE a.numeroseao = c.numeroseao)
UNION ALL
SELECT 'contrats', 'duplicate_key', CAST(numeroseao AS VARCHAR) || '|' || CAST(numero AS VARCHAR),
       CAST(count(*) AS VARCHAR)
FROM s_contrats GROUP BY numeroseao, numero HAVING count(*) > 1
UNION ALL
SELECT 'avis_fournisseurs', 'fk_supplier', CAST(l.numeroseao AS VARCHAR), NULL
FROM s_links l WHERE NOT EXISTS (SELECT 1 FROM s_avis a WHERE a.numeroseao = l.numeroseao)
"""))
def q_orphans_check(spark, sf_dir):
    """Orphan keys and duplicate keys as reject rows."""
    s = staging(spark, sf_dir)
    # all checks are by notice: each table is parted once into tasks of bounded rows
    rows = s["avis_fournisseurs"].count()
    s = {t: spread(s[t].select(*cols), rows, "numeroseao") for t, cols in {
        "avis": ["numeroseao"], "contrats": ["numeroseao", "numero"], "avis_fournisseurs": ["numeroseao"]}.items()}
    return (C.fk_orphans(s["contrats"], ["numeroseao"], s["avis"], ["numeroseao"], "contrats", "fk_notice")
            .unionByName(C.duplicate_keys(s["contrats"], ["numeroseao", "numero"], "contrats"))
            .unionByName(C.fk_orphans(s["avis_fournisseurs"], ["numeroseao"], s["avis"], ["numeroseao"],
                                      "avis_fournisseurs", "fk_supplier")))


# ------------------------------------------------------- P15-P19 migration (all-data policy)
def _migrated(spark, sf_dir):
    from tenderfold.operators.migrate import migrate
    s = staging(spark, sf_dir, pending=True)
    text = {k: s[k].withColumn("neq", F.col("neq").cast("string")) for k in ("avis_fournisseurs", "fournisseurs")}
    return migrate(P.ALL_DATA, s["avis"], text["avis_fournisseurs"], text["fournisseurs"], s["contrats"], s["depenses"])[0]


def _both(tables, name, cols):
    """Current rows and the migration's own superseded versions."""
    return (tables[name].select(*cols, F.lit("current").alias("state"))
            .unionByName(tables[f"{name}_history"].select(*cols, F.lit("history").alias("state"))))


@register("tenderer_count", with_staging("""
SELECT 'ocds-ec9k95-' || CAST(a.numeroseao AS VARCHAR) AS ocid,
       CAST(COALESCE(t.n, 0) AS INTEGER) AS tender_number_of_tenderers
FROM s_avis a LEFT JOIN (SELECT l.numeroseao, count(*) AS n
                         FROM s_links l JOIN s_fournisseurs f ON l.neq = f.neq
                         GROUP BY l.numeroseao) t ON a.numeroseao = t.numeroseao
""", pending=True))
def q_tenderer_count(spark, sf_dir):
    """A4 + J1 + P15: the migrated releases' number of supplier links that join a supplier."""
    return _migrated(spark, sf_dir)["releases"].select("ocid", "tender_number_of_tenderers")


@register("migrate_releases", with_staging(f"""
SELECT 'ocds-ec9k95-' || CAST(numeroseao AS VARCHAR) AS ocid, CAST(numero AS VARCHAR) AS release_id,
       datepublication AS date, 'avis' AS tag,
       {code_case("type", METHODS, codes.METHOD_DEFAULT, True)} AS tender_procurement_method,
       {code_case("type", codes.METHOD_DETAILS, codes.METHOD_DETAILS_DEFAULT, True)} AS tender_procurement_method_details,
       trim(split_part(categorieseao, '-', 1)) AS tender_item_id, titre AS tender_title,
       'OP-' || min(CAST(numeroseao AS VARCHAR)) OVER (PARTITION BY organisme_key) AS tender_procuring_entity_id
FROM s_avis
""", pending=True))
def q_migrate_releases(spark, sf_dir):
    """P15 + P16 + U9: notices as releases; the buyer's id is the first one its name got."""
    return _migrated(spark, sf_dir)["releases"].select(
        "ocid", "release_id", "date", "tag", "tender_procurement_method", "tender_procurement_method_details",
        "tender_item_id", "tender_title", "tender_procuring_entity_id")


@register("migrate_bids", with_staging("""
, w AS (SELECT 'FO-' || CAST(l.neq AS VARCHAR) AS party_id, 'ocds-ec9k95-' || CAST(l.numeroseao AS VARCHAR) AS ocid,
               l.admissible, l.conforme AS conform, CAST(l.montantsoumis AS DECIMAL(15,2)) AS value, 'CAD' AS value_unit,
               rank() OVER (PARTITION BY l.neq, l.numeroseao ORDER BY l.link_pos DESC) AS rk
        FROM s_links l JOIN s_avis a ON l.numeroseao = a.numeroseao JOIN s_fournisseurs f ON l.neq = f.neq)
SELECT party_id, ocid, admissible, conform, value, value_unit, CASE WHEN rk = 1 THEN 'current' ELSE 'history' END AS state FROM w
""", pending=True).replace(")\n, w AS", "),\nw AS"))
def q_migrate_bids(spark, sf_dir):
    """P17 + U1 + U3: one bid per supplier and release; earlier links of the pair are history."""
    return _both(_migrated(spark, sf_dir), "bids", ["party_id", "ocid", "admissible", "conform", "value", "value_unit"])


@register("migrate_contracts", with_staging("""
, w AS (SELECT CAST(numero AS VARCHAR) AS contract_id, 'ocds-ec9k95-' || CAST(numeroseao AS VARCHAR) AS ocid, 'active' AS status,
               datefinale AS period_end_date, CAST(montantfinal AS DECIMAL(15,2)) AS value_amount,
               rank() OVER (PARTITION BY numero ORDER BY CAST(numeroseao AS VARCHAR) DESC) AS rk
        FROM s_contrats)
SELECT contract_id, ocid, status, period_end_date, value_amount, CASE WHEN rk = 1 THEN 'current' ELSE 'history' END AS state FROM w
""", pending=True).replace(")\n, w AS", "),\nw AS"))
def q_migrate_contracts(spark, sf_dir):
    """P18 + U3: contract numbers repeat across notices; the last notice's stays, the others are history."""
    return _both(_migrated(spark, sf_dir), "contracts", ["contract_id", "ocid", "status", "period_end_date", "value_amount"])


@register("migrate_transactions", with_staging("""
SELECT 'ocds-ec9k95-' || CAST(l_orderkey AS VARCHAR) AS ocid,
       'txn-' || concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS transaction_id,
       'ligne' AS source, l_shipdate AS date, CAST(l_extendedprice AS DECIMAL(15,2)) AS value_amount, 'CAD' AS value_currency
FROM lineitem WHERE l_returnflag = 'R'
""", pending=True))
def q_migrate_transactions(spark, sf_dir):
    """P19 + A7 text: expenses as transactions."""
    return _migrated(spark, sf_dir)["contract_transactions"].select(
        "ocid", "transaction_id", "source", "date", "value_amount", "value_currency")


@register("history_backfill", with_staging("""
SELECT 'FO-' || CAST(f.neq AS VARCHAR) AS party_id, f.nomorganisation AS name, t.n AS multiplicity
FROM s_fournisseurs f JOIN (SELECT l.neq, count(*) AS n FROM s_links l JOIN s_avis a ON l.numeroseao = a.numeroseao
                            GROUP BY l.neq) t ON t.neq = f.neq
""", pending=True))
def q_history_backfill(spark, sf_dir):
    """U11e + J12: archived supplier versions with the number of links that name them."""
    s = staging(spark, sf_dir, pending=True)
    text = {k: s[k].withColumn("neq", F.col("neq").cast("string")) for k in ("avis_fournisseurs", "fournisseurs")}
    h = BF.parties_history(_backfill_keys(s), text["avis_fournisseurs"], text["fournisseurs"], text["fournisseurs"], _mod())
    return h.select("party_id", "name", "multiplicity")


@register("file_period_order", """
WITH f AS (SELECT CASE o_orderstatus WHEN 'O' THEN 'avis' WHEN 'F' THEN 'contrats' ELSE 'depenses' END
                  || (CASE WHEN o_orderpriority = '1-URGENT' THEN '_revisions' ELSE '' END)
                  || '_' || strftime(o_orderdate, '%Y%m%d') || '_' || strftime(o_orderdate + INTERVAL 6 DAY, '%Y%m%d')
                  || '.xml' AS file_name,
                  o_orderstatus, o_orderpriority, o_orderdate FROM orders)
SELECT file_name, strftime(o_orderdate, '%Y%m%d') AS period_start,
       strftime(o_orderdate + INTERVAL 6 DAY, '%Y%m%d') AS period_end,
       o_orderpriority = '1-URGENT' AS is_revision,
       CASE o_orderstatus WHEN 'O' THEN 'avis' WHEN 'F' THEN 'contrats' ELSE 'depenses' END AS route
FROM f
""")
def q_file_period_order(spark, sf_dir):
    """SRC6/SRC7: an XML file name per order (status picks the kind, urgent = revision);
    period, revision flag and route parsed back from the name."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderdate", "o_orderstatus", "o_orderpriority")
    kind = (F.when(F.col("o_orderstatus") == "O", F.lit("avis"))
            .when(F.col("o_orderstatus") == "F", F.lit("contrats")).otherwise(F.lit("depenses")))
    name = F.concat(kind, F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("_revisions")).otherwise(F.lit("")),
                    F.lit("_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"),
                    F.date_format(F.date_add("o_orderdate", 6), "yyyyMMdd"), F.lit(".xml"))
    named = o.select(name.alias("file_name"))
    seq = SF.file_seq("file_name", kind="xml")
    return named.select("file_name", seq["start"].alias("period_start"), seq["end"].alias("period_end"),
                        seq["revision"].alias("is_revision"), SF.route("file_name").alias("route"))


@register("json_extract", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       '{"k":' || json_extract_string(props, '$.k') || '}' AS details
FROM events
""")
def q_json_extract(spark, sf_dir):
    """SRC1/X18: JSON text read with a declared schema, and written back compactly."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "props")
    parsed = F.from_json("props", "k int")
    return ev.select("event_id", parsed["k"].alias("k"), F.to_json(parsed).alias("details"))


# ------------------------------------------------------- round trips (P21, SRC1-SRC3)
from tenderfold.plans.documents import contract_documents, notice_xml_documents  # noqa: E402
from tenderfold.sources import notice_xml as NX  # noqa: E402
from tenderfold.sources import release_json as RJ  # noqa: E402


@register("json_roundtrip", """
SELECT CAST(l_orderkey AS VARCHAR) AS ocid,
       concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS contract_id,
       CAST(l_extendedprice AS DECIMAL(15,2)) AS value_amount, 'CAD' AS value_currency,
       l_shipdate AS date_signed
FROM lineitem
""")
def q_json_roundtrip(spark, sf_dir):
    """Lines -> nested release JSON per order (P21) -> release reader -> contract rows."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    flat = li.select(F.col("l_orderkey").cast("string").alias("ocid"),
                     F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("contract_id"),
                     F.lit("").alias("award_id"),
                     F.col("l_extendedprice").cast("decimal(15,2)").alias("value_amount"),
                     F.lit("CAD").alias("currency"),
                     F.concat(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00")).alias("date_signed"))
    docs = contract_documents(flat)
    rel = RJ.explode_releases(RJ.releases_from_text(docs))
    c = RJ.release_events(rel)["contracts"]
    return c.select("ocid", "contract_id", "value_amount", "value_currency", "date_signed")


@register("xml_roundtrip", """
SELECT CAST(l_orderkey AS VARCHAR) AS numeroseao, CAST(l_suppkey AS VARCHAR) AS neq,
       s_name AS nomorganisation, CAST(l_extendedprice AS DECIMAL(18,2)) AS montantsoumis,
       CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS adjudicataire,
       'Client ' || CAST(o_custkey AS VARCHAR) || ' & Fils' AS organisme
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey
""")
def q_xml_roundtrip(spark, sf_dir):
    """Orders + lines -> notice XML with suppliers (bare '&' in names) -> XML reader -> link rows."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    notices = o.select(F.col("o_orderkey").alias("numeroseao"),
                       F.concat(F.lit("Client "), F.col("o_custkey").cast("string"), F.lit(" & Fils")).alias("organisme"))
    links = li.join(sup, li.l_suppkey == sup.s_suppkey).select(
        F.col("l_orderkey").alias("numeroseao"), F.col("l_suppkey").alias("neq"), F.col("s_name").alias("nomorganisation"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("montantsoumis"),
        F.when(F.col("l_linestatus") == "F", F.lit(1)).otherwise(F.lit(0)).alias("adjudicataire"))
    docs = notice_xml_documents(notices, links)
    files = docs.select("file_name", F.lit(None).cast("struct<start:string>").alias("file_seq"),
                        F.lit("avis").alias("route"), F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")).alias("text"))
    ts = F.lit(None).cast("timestamp_ntz")
    ensure_checkpoint_dir(spark)
    parsed = NX.avis_rows(files).checkpoint()        # one parse feeds notices and links
    n, _, l = NX.avis_events(files, ts, rows=parsed)
    org = n.select("numeroseao", F.col("organisme"))
    return (l.join(org, "numeroseao")
            .select("numeroseao", "neq", "nomorganisation", "montantsoumis", "adjudicataire", "organisme"))


# ------------------------------------------------------- U11 backfill (library functions)
from tenderfold.operators import backfill as BF  # noqa: E402

def _mod():
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")


def _backfill_keys(s):
    """Every notice is a migrated release; its own rows play the archived versions."""
    return BF.migrated_keys(s["avis"].select(X_ocid(F.col("numeroseao")).alias("ocid")))


def X_ocid(c):
    return F.concat(F.lit(codes.OCID_PREFIX), c.cast("string"))


@register("backfill_releases_history", with_staging(f"""
SELECT 'ocds-ec9k95-' || CAST(numeroseao AS VARCHAR) AS ocid, CAST(numero AS VARCHAR) AS release_id,
       datepublication AS date, 'avis_history' AS tag,
       {code_case("type", METHODS, codes.METHOD_DEFAULT, True)} AS tender_procurement_method,
       {code_case("type", codes.METHOD_DETAILS, codes.METHOD_DETAILS_DEFAULT, True)} AS tender_procurement_method_details,
       '{codes.MAIN_CATEGORY_DEFAULT}' AS tender_main_procurement_category, '' AS tender_additional_procurement_categories,
       'OP-' || CAST(numeroseao AS VARCHAR) AS tender_procuring_entity_id,
       trim(split_part(categorieseao, '-', 1)) AS tender_item_id, titre AS tender_title
FROM s_avis
""", pending=True))
def q_backfill_releases_history(spark, sf_dir):
    """U11a + J11: archived notices of migrated releases become release versions."""
    s = staging(spark, sf_dir, pending=True)
    h = BF.releases_history(_backfill_keys(s), s["avis"], _mod())
    return h.select("ocid", "release_id", "date", "tag", "tender_procurement_method",
                    "tender_procurement_method_details", "tender_main_procurement_category",
                    "tender_additional_procurement_categories", "tender_procuring_entity_id",
                    "tender_item_id", "tender_title")


@register("backfill_bids_history", with_staging("""
SELECT 'FO-' || CAST(l.neq AS VARCHAR) AS party_id, 'ocds-ec9k95-' || CAST(l.numeroseao AS VARCHAR) AS ocid,
       l.admissible, l.conforme AS conform, CAST(l.montantsoumis AS DECIMAL(15,2)) AS value, 'CAD' AS value_unit
FROM s_links l JOIN s_avis a ON l.numeroseao = a.numeroseao
JOIN (SELECT DISTINCT neq FROM s_fournisseurs) f ON l.neq = f.neq
""", pending=True))
def q_backfill_bids_history(spark, sf_dir):
    """U11b + J1: one bid version per link row of a migrated notice."""
    s = staging(spark, sf_dir, pending=True)
    links = s["avis_fournisseurs"].withColumn("neq", F.col("neq").cast("string"))
    four = s["fournisseurs"].withColumn("neq", F.col("neq").cast("string"))
    return BF.bids_history(_backfill_keys(s), links, four, _mod()).drop("modified_date", "related_lot")


@register("backfill_contracts_history", with_staging("""
SELECT CAST(c.numero AS VARCHAR) AS contract_id, 'ocds-ec9k95-' || CAST(c.numeroseao AS VARCHAR) AS ocid,
       'active' AS status, CAST(NULL AS TIMESTAMP) AS period_end_date,
       CAST(c.montantfinal AS DECIMAL(15,2)) AS value_amount, c.datefinale AS date_signed
FROM s_contrats c JOIN s_avis a ON c.numeroseao = a.numeroseao
""", pending=True))
def q_backfill_contracts_history(spark, sf_dir):
    """U11c + J11: archived contracts of migrated notices (swapped dates)."""
    s = staging(spark, sf_dir, pending=True)
    return BF.contracts_history(_backfill_keys(s), s["contrats"], _mod()).drop("modified_date")
