"""Registered queries over the driver tables, and their DuckDB oracles.

Each query is a callable ``(spark, sf_dir) -> DataFrame``; ``ORACLE_SQL`` holds
the equivalent SQL over the driver's pre-registered views. Column names match
one-for-one (snake case everywhere).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tenderfold.plans import analytics as A
from tenderfold.plans.driver_model import tables, with_model

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def _days_sql(start: str, end: str) -> str:
    return f"date_diff('day', CAST({start} AS DATE), CAST({end} AS DATE))"


# Duration oracles: days and counts are summed per release (AQ1, AQ2) or per
# party (AQ6) first, types and names are joined to the sums.
_ENDED_SQL = f"""(SELECT ocid, count(DISTINCT contract_id) AS ids, count(*) AS n,
             sum({_days_sql('date_signed', 'period_end_date')}) AS days
      FROM m_contracts WHERE date_signed IS NOT NULL AND period_end_date IS NOT NULL GROUP BY ocid)"""
_OPEN_SQL = f"""(SELECT *, {_days_sql('tender_start_date', 'tender_end_date')} AS days FROM m_releases
      WHERE tender_start_date IS NOT NULL AND tender_end_date IS NOT NULL)"""


# --------------------------------------------------------------------- AQ1-AQ6
@register("contract_duration_by_type", with_model(f"""
SELECT kind AS contract_type, CAST(trunc(sum(days) / sum(n)) AS BIGINT) AS average_duration_days
FROM {_ENDED_SQL} ended JOIN (SELECT ocid, tender_procurement_method_details AS kind FROM m_releases) USING (ocid)
GROUP BY kind
"""))
def q_contract_duration_by_type(spark, sf_dir):
    t = tables(spark, sf_dir)
    return A.contract_duration_by_type(t["contracts"], t["releases"])


@register("contract_duration_by_supplier", with_model(f"""
SELECT party_id, name AS supplier_name, CAST(ids AS BIGINT) AS number_of_contracts,
       CAST(trunc(days / n) AS BIGINT) AS average_duration_days
FROM (SELECT party_id, sum(ids) AS ids, sum(n) AS n, sum(days) AS days
      FROM (SELECT ocid, party_id FROM m_release_parties WHERE role = 'supplier' AND ocid IN (SELECT ocid FROM m_releases))
           JOIN {_ENDED_SQL} ended USING (ocid) GROUP BY party_id)
     JOIN m_parties USING (party_id)
"""))
def q_contract_duration_by_supplier(spark, sf_dir):
    t = tables(spark, sf_dir)
    return A.contract_duration_by_supplier(t["contracts"], t["releases"], t["release_parties"], t["parties"])


# Growth oracles: the opening amount of a release is the least of its (award or
# bid) rows in key order; what was spent on it is one sum per release.
_SPENT_SQL = "(SELECT ocid, coalesce(sum(value_amount), 0) AS total FROM m_transactions GROUP BY ocid)"


def _growth_sql(opening: str, holder: str, holder_name: str, amount: str, extra: str, name_join: str) -> str:
    money = "CAST({} AS DECIMAL(18,2))".format
    return f"""
SELECT DISTINCT k.ocid, o.head.who AS {holder}, who.name AS {holder_name}, {money('o.head.amount')} AS {amount},
       {money('spent.total')} AS additional_expenses, {money('o.head.amount + spent.total')} AS expected_final_contract,
       {money('k.value_amount')} AS final_contract{extra}
FROM m_contracts k
     LEFT JOIN ({opening}) o USING (ocid)
     LEFT JOIN {_SPENT_SQL} spent USING (ocid)
     LEFT JOIN m_parties who ON who.party_id = o.head.who{name_join}
"""


_FIRST_AWARD_SQL = """SELECT w.ocid, min({'k': w.award_id, 'who': b.party_id, 'amount': w.value_amount}) AS head
      FROM m_awards w JOIN m_release_parties b ON b.ocid = w.ocid AND b.role = 'buyer' GROUP BY w.ocid"""
_FIRST_BID_SQL = """SELECT w.ocid, min({'a': w.l_linenumber, 'b': w.l_partkey, 'c': w.l_suppkey, 'd': w.l_extendedprice,
                                      'e': w.l_shipdate, 'who': s.party_id, 'amount': w.value}) AS head
      FROM m_bids w JOIN m_release_parties s ON s.ocid = w.ocid AND s.party_id = w.party_id AND s.role = 'supplier'
      GROUP BY w.ocid"""


@register("growth_first_award", with_model(_growth_sql(
    _FIRST_AWARD_SQL, "buyer_id", "buyer_name", "initial_award",
    ", CAST(k.value_amount - o.head.amount AS DECIMAL(18,2)) AS growth", " AND spent.total IS NOT NULL")))
def q_growth_first_award(spark, sf_dir):
    t = tables(spark, sf_dir)
    return A.growth_first_award(t["contracts"], t["awards"], t["release_parties"], t["parties"],
                                t["contract_transactions"])


@register("growth_first_bid", with_model(_growth_sql(
    _FIRST_BID_SQL, "supplier_id", "supplier_name", "initial_bid", "", "")))
def q_growth_first_bid(spark, sf_dir):
    t = tables(spark, sf_dir)
    return A.growth_first_bid(t["contracts"], t["bids"], t["release_parties"], t["parties"],
                              t["contract_transactions"])


@register("tender_duration_by_type", with_model(f"""
SELECT tender_procurement_method_details AS tender_type, CAST(trunc(sum(days) / count(*)) AS BIGINT) AS average_tender_duration_days
FROM {_OPEN_SQL} GROUP BY tender_procurement_method_details
"""))
def q_tender_duration_by_type(spark, sf_dir):
    return A.tender_duration_by_type(tables(spark, sf_dir)["releases"])


@register("tender_duration_by_buyer", with_model(f"""
SELECT name AS client_name, CAST(sum(ids) AS BIGINT) AS number_of_tenders,
       CAST(trunc(sum(days) / sum(n)) AS BIGINT) AS average_tender_duration_days
FROM (SELECT party_id, count(DISTINCT release_id) AS ids, count(*) AS n, sum(days) AS days
      FROM {_OPEN_SQL} JOIN (SELECT ocid, party_id FROM m_release_parties WHERE role = 'buyer') USING (ocid) GROUP BY party_id)
     JOIN m_parties USING (party_id)
GROUP BY name
"""))
def q_tender_duration_by_buyer(spark, sf_dir):
    t = tables(spark, sf_dir)
    return A.tender_duration_by_buyer(t["releases"], t["release_parties"], t["parties"])


# ------------------------------------------------------- version log
# events = one upsert log: key user_id, write order (ts, event_id);
# event_type 'error' plays the insert-if-absent writer (placeholders, links).
from pyspark.sql import functions as F  # noqa: E402

from tenderfold.operators import versionlog as V  # noqa: E402
from tenderfold.operators.aliases import party_aliases  # noqa: E402
from tenderfold.operators.identity import resolve_by_name, supplier_versions  # noqa: E402
from tenderfold.operators.ordered import range_bucket  # noqa: E402
from tenderfold.session import spread, staged  # noqa: E402

_EV_COLS = ["user_id", "event_id", "ts", "event_type", "value"]


def _event_log(spark, sf_dir, kinds=False):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select(*_EV_COLS)
    ev = ev.withColumn("seq", F.struct("ts", "event_id"))
    if kinds:
        ev = ev.withColumn("kind", F.when(F.col("event_type") == "error", F.lit(V.INS_IF_ABSENT))
                           .otherwise(F.lit(V.UPSERT)))
    return ev


_LEAD = "lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id)"


@register("events_current", f"""
SELECT user_id, event_id, ts, event_type, value
FROM (SELECT *, {_LEAD} AS nx FROM events) WHERE nx IS NULL
""")
def q_events_current(spark, sf_dir):
    return V.current(_event_log(spark, sf_dir), "user_id", kind=None).select(*_EV_COLS)


@register("events_history", f"""
SELECT user_id, event_id, ts, event_type, value
FROM (SELECT *, {_LEAD} AS nx FROM events) WHERE nx IS NOT NULL
""")
def q_events_history(spark, sf_dir):
    return V.history(_event_log(spark, sf_dir), "user_id", kind=None).select(*_EV_COLS)


_INS_IF_ABSENT_SQL = f"""
WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
k AS (SELECT * FROM e WHERE event_type <> 'error' OR rn = 1),
s AS (SELECT *, {_LEAD} AS nx FROM k)
SELECT user_id, event_id, ts, event_type, value,
       CASE WHEN nx IS NULL THEN 'current' ELSE 'history' END AS state
FROM s
"""


@register("events_insert_if_absent", _INS_IF_ABSENT_SQL)
def q_events_insert_if_absent(spark, sf_dir):
    cls = V.classify(_event_log(spark, sf_dir, kinds=True), "user_id")
    return cls.where(F.col("state") != V.SKIPPED).select(*_EV_COLS, "state")


@register("events_two_batch_fold", _INS_IF_ABSENT_SQL)
def q_events_two_batch_fold(spark, sf_dir):
    """ST2: fold the log in two batches (each user's log is cut some days after its start); same result as one."""
    log = _event_log(spark, sf_dir, kinds=True)
    rows = log.count()
    cut = log.groupBy("user_id").agg(F.date_add(F.min("ts"), (F.pmod("user_id", F.lit(20)) + 1).cast("int")).alias("cut"))
    log = staged(log.join(cut, "user_id").withColumn("early", F.to_date("ts") < F.col("cut")).drop("cut"), "event_batches")
    # each batch is parted by user into tasks of bounded rows; a fold is written before the next one reads it, so that
    # no task holds the sorts of both
    b1, b2 = (spread(log.where(taken).drop("early"), rows, "user_id") for taken in ("early", "not early"))
    cur1, hist1 = V.fold_increment(log.limit(0).drop("kind", "early"), b1, "user_id", materialize=staged)
    cur2, hist2 = V.fold_increment(spread(cur1.drop("kind"), rows, "user_id"), b2, "user_id", materialize=staged)
    return (cur2.select(*_EV_COLS).withColumn("state", F.lit(V.CURRENT))
            .unionByName(hist1.select(*_EV_COLS).withColumn("state", F.lit(V.HISTORY)))
            .unionByName(hist2.select(*_EV_COLS).withColumn("state", F.lit(V.HISTORY))))


@register("replace_children", """
SELECT e.user_id, e.event_id, e.ts, e.event_type, e.value
FROM events e
JOIN (SELECT user_id, max(CAST(ts AS DATE)) AS d FROM events GROUP BY user_id) m
  ON e.user_id = m.user_id AND CAST(e.ts AS DATE) = m.d
""")
def q_replace_children(spark, sf_dir):
    """A user's day is a notice version; its events are the child set."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select(*_EV_COLS) \
        .withColumn("seq", F.to_date("ts"))
    parents = ev.select("user_id", "seq")
    return V.replace_child_set(ev, parents, "user_id").select(*_EV_COLS)


@register("party_aliases", """
WITH e AS (SELECT user_id, ts, event_id, event_type AS core,
                  lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
ch AS (SELECT * FROM e WHERE prev IS NOT NULL AND core <> prev),
f AS (SELECT *, row_number() OVER (PARTITION BY user_id, core ORDER BY ts, event_id) AS rn FROM ch),
a AS (SELECT user_id, string_agg(core, ',' ORDER BY ts, event_id) AS alias_parties
      FROM f WHERE rn = 1 GROUP BY user_id)
SELECT u.user_id, a.alias_parties
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN a ON u.user_id = a.user_id
""")
def q_party_aliases(spark, sf_dir):
    """core = event_type; hot users are split by day for the lag."""
    ev = _event_log(spark, sf_dir)
    return party_aliases(ev, "user_id", "seq", "event_type", bucket=F.to_date("ts"))


@register("party_aliases_commas", """
WITH w AS (SELECT CASE WHEN o_orderstatus = 'O' THEN 'hot' ELSE 'OP-' || o_custkey END AS party_id, o_orderdate AS d, o_orderkey AS k,
                  CASE o_orderkey % 4 WHEN 0 THEN o_orderpriority WHEN 1 THEN o_orderpriority || ',' || o_orderstatus
                       WHEN 2 THEN o_orderstatus ELSE 'x' || o_custkey % 50 || ',' || o_orderpriority END AS core FROM orders),
e AS (SELECT *, lag(core) OVER (PARTITION BY party_id ORDER BY d, k) AS prev,
             row_number() OVER (PARTITION BY party_id ORDER BY d, k) AS n FROM w),
ch AS (SELECT * FROM e WHERE prev <> core),
fragments AS (SELECT party_id, part, min(n) AS n FROM (SELECT party_id, n, unnest(string_split(core, ',')) AS part FROM ch
              WHERE contains(core, ',')) GROUP BY party_id, part),
firsts AS (SELECT party_id, core, min(n) AS n FROM ch WHERE NOT contains(core, ',') GROUP BY party_id, core),
entries AS (
  SELECT party_id, core, n FROM ch WHERE contains(core, ',')
  UNION ALL SELECT f.party_id, f.core, f.n FROM firsts f LEFT JOIN fragments g ON g.party_id = f.party_id AND g.part = f.core
  WHERE g.n IS NULL OR f.n < g.n)
SELECT p.party_id, alias_parties FROM (SELECT DISTINCT party_id FROM w) p
LEFT JOIN (SELECT party_id, string_agg(core, ',' ORDER BY n) AS alias_parties FROM entries GROUP BY party_id) a ON a.party_id = p.party_id
""")
def q_party_aliases_commas(spark, sf_dir):
    """Cores with commas, whose fragments hide later plain cores; one party holds the publications of all open orders."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    kind = F.col("o_orderkey") % 4
    core = (F.when(kind == 0, F.col("o_orderpriority")).when(kind == 1, F.concat_ws(",", "o_orderpriority", "o_orderstatus"))
            .when(kind == 2, F.col("o_orderstatus"))
            .otherwise(F.concat(F.lit("x"), (F.col("o_custkey") % 50).cast("string"), F.lit(","), F.col("o_orderpriority"))))
    writes = o.select(
        F.when(F.col("o_orderstatus") == "O", F.lit("hot")).otherwise(F.concat(F.lit("OP-"), F.col("o_custkey").cast("string"))).alias("party_id"),
        F.struct("o_orderdate", "o_orderkey").alias("seq"), core.alias("core"))
    return party_aliases(writes, "party_id", "seq", "core", bucket=F.col("seq.o_orderdate"))


@register("party_resolution", """
SELECT p_partkey, p_name,
       first_value(p_partkey) OVER (PARTITION BY p_name ORDER BY p_partkey) AS party_id,
       last_value(p_brand) OVER (PARTITION BY p_name ORDER BY p_partkey
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_p_brand
FROM part
""")
def q_party_resolution(spark, sf_dir):
    """Parts are party writes by name; the first id of a name wins."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_brand")
    resolved, _ = resolve_by_name(part.withColumn("seq", F.col("p_partkey")), "p_name", "p_partkey", "seq",
                                  last_writer_cols=["p_brand"])
    return resolved.select("p_partkey", "p_name", "party_id", "last_p_brand")


@register("party_id_conflicts", """
WITH firsts AS (SELECT p_name, min(p_partkey) AS first_seq, arg_min(p_size, p_partkey) AS cand FROM part GROUP BY p_name),
owner AS (SELECT cand, min(first_seq) AS owner_seq FROM firsts GROUP BY cand)
SELECT f.p_name, f.cand AS party_id, f.first_seq AS seq
FROM firsts f JOIN owner o ON f.cand = o.cand WHERE f.first_seq > o.owner_seq
""")
def q_party_id_conflicts(spark, sf_dir):
    """U9 conflicts (§1.4-22): candidate id = p_size, so names compete for ids."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_size")
    _, conflicts = resolve_by_name(part.withColumn("seq", F.col("p_partkey")), "p_name", "p_size", "seq")
    return conflicts


@register("supplier_identity", """
WITH v AS (SELECT p_brand AS neq, p_name AS nomorganisation, p_partkey AS seq,
                  lag(p_name) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS prev_name FROM part),
x AS (SELECT *, CASE WHEN prev_name IS NOT NULL AND prev_name <> nomorganisation THEN neq END AS existing_neq,
             lead(seq) OVER (PARTITION BY neq ORDER BY seq) AS nx FROM v)
SELECT 'neq:' || neq AS supplier_key, neq, nomorganisation, existing_neq, seq,
       CASE WHEN nx IS NULL THEN 'current' ELSE 'history' END AS state
FROM x
""")
def q_supplier_identity(spark, sf_dir):
    """U8: parts as supplier writes, neq = brand; current + history versions."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_brand").alias("neq"), F.col("p_name").alias("nomorganisation"), F.col("p_partkey").alias("seq"))
    v = supplier_versions(part, "seq", bucket=range_bucket(part, "seq"))
    cls = V.classify(v, "supplier_key", kind=None)
    return cls.select("supplier_key", "neq", "nomorganisation", "existing_neq", "seq", "state")


# ------------------------------------------------------- scalars, picks (X*, P2, P4)
from tenderfold import codes  # noqa: E402
from tenderfold.functions import scalars as X  # noqa: E402
from tenderfold.functions.items import pick_classification, pick_item  # noqa: E402


def code_case(column: str, mapping: dict, default: str, quote_code: bool = False) -> str:
    """CASE expression of a code map (the texts live in codes.py only)."""
    text = lambda v: "'" + v.replace("'", "''") + "'"
    whens = " ".join(f"WHEN {text(str(k)) if quote_code else k} THEN {text(v)}" for k, v in mapping.items())
    return f"CASE {column} {whens} ELSE {text(default)} END"


METHODS = {**{c: "open" for c in codes.METHOD_OPEN_TYPES}, **{c: "direct" for c in codes.METHOD_DIRECT_TYPES},
           **{c: "limited" for c in codes.METHOD_LIMITED_TYPES}}


@register("code_maps", f"""
SELECT p_partkey, p_size AS code,
       {code_case("p_size", METHODS, codes.METHOD_DEFAULT)} AS tender_procurement_method,
       {code_case("p_size", codes.METHOD_DETAILS, codes.METHOD_DETAILS_DEFAULT)} AS tender_procurement_method_details,
       {code_case("p_size", codes.MAIN_CATEGORY, codes.MAIN_CATEGORY_DEFAULT)} AS tender_main_procurement_category,
       {code_case("p_size", codes.ADDITIONAL_CATEGORY, "")} AS tender_additional_procurement_categories
FROM part
""")
def q_code_maps(spark, sf_dir):
    """p_size plays the notice type / precision / nature code."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_size")
    code = X.safe_int(F.col("p_size").cast("string"))
    return part.select("p_partkey", F.col("p_size").alias("code"),
                       X.procurement_method(code).alias("tender_procurement_method"),
                       X.procurement_method_details(code).alias("tender_procurement_method_details"),
                       X.main_category(code).alias("tender_main_procurement_category"),
                       X.additional_categories(code).alias("tender_additional_procurement_categories"))


_CLEAN_SQL = ("replace(replace(regexp_replace(replace(replace(text, chr(13), ''), chr(10), ' '), "
              "'[\\x00-\\x1F]+', ' ', 'g'), '’', ''''), '‘', '''')")


_TEXT_CLEAN_SQL = f"""
WITH t AS (SELECT doc_id, text,
  replace(replace(replace(replace({_CLEAN_SQL}, 'ʼ', ''''), '‛', ''''), '“', '"'), '”', '"') AS c
  FROM documents)
SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN NULL ELSE md5(c) END AS text_md5,
       CASE WHEN text IS NULL OR text = '' THEN NULL ELSE length(c) END AS n_chars_clean
FROM t
"""


@register("text_clean", _TEXT_CLEAN_SQL)
def q_text_clean(spark, sf_dir):
    """X12 without NFKC: control characters and quotes, whole texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    c = X.clean_text(F.col("text"), normalize=False)
    return docs.select("doc_id", F.md5(c).alias("text_md5"), F.length(c).cast("bigint").alias("n_chars_clean"))


@register("text_clean_nfkc", _TEXT_CLEAN_SQL)
def q_text_clean_nfkc(spark, sf_dir):
    """X12 with NFKC: some letters of each text are swapped for compatibility
    forms (full-width letters, a ligature) that NFKC turns back, so the oracle
    is the plain cleaned text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = F.replace(F.translate(F.col("text"), "aeotz", "ａｅｏｔｚ"), F.lit("fi"), F.lit("ﬁ"))
    c = X.clean_text(odd, normalize=True)
    return docs.select("doc_id", F.md5(c).alias("text_md5"), F.length(c).cast("bigint").alias("n_chars_clean"))


@register("number_rejects", """
SELECT event_id, CASE WHEN event_id % 5 IN (0, 1) THEN CAST(event_id AS INTEGER) WHEN event_id % 5 = 2 THEN 2147483647 END AS safe_int,
       CASE WHEN event_id % 5 IN (0, 1, 2) THEN NULL WHEN event_id % 5 = 3 THEN 'duration_not_a_number'
            ELSE 'duration_not_a_number' END AS reason
FROM events
""")
def q_number_rejects(spark, sf_dir):
    """X5 + U12: plain, padded, longest, too long and wordy number texts; what does not convert is reported."""
    from tenderfold.sources.release_json import faults
    e = F.col("event_id")
    text = (F.when(e % 5 == 0, e.cast("string")).when(e % 5 == 1, F.concat(F.lit("\t\u00a0"), e.cast("string"), F.lit("\n")))
            .when(e % 5 == 2, F.lit("2147483647")).when(e % 5 == 3, F.concat(F.lit("99999999999"), e.cast("string")))
            .otherwise(F.concat(e.cast("string"), F.lit(" days"))))
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", text.alias("v"))
    number = X.safe_int("v", default=None)
    return ev.select("event_id", number.alias("safe_int"),
                     F.get(faults(("duration_not_a_number", F.col("v"), number, False)), F.lit(0))["reason"].alias("reason"))


@register("date_parse", """
SELECT event_id,
       date_trunc('second', ts) AS iso_with_offset,
       date_trunc('second', ts) AS iso_zulu,
       date_trunc('day', ts) AS iso_date_only,
       date_trunc('day', ts) AS iso_date_garbage_time,
       CAST(NULL AS TIMESTAMP) AS garbage,
       date_trunc('minute', ts) AS xml_minutes,
       date_trunc('second', ts) AS xml_seconds,
       CAST(NULL AS TIMESTAMP) AS xml_iso_rejected,
       date_trunc('second', ts) AS strict_seconds
FROM events
""")
def q_date_parse(spark, sf_dir):
    """X1-X3 on text forms of events.ts (offset, Z, date-only, junk, XML forms)."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return ev.select(
        "event_id",
        X.parse_iso_ts(F.concat(iso, F.lit("-05:00"))).alias("iso_with_offset"),
        X.parse_iso_ts(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).alias("iso_zulu"),
        X.parse_iso_ts(F.date_format("ts", "yyyy-MM-dd")).alias("iso_date_only"),
        X.parse_iso_ts(F.concat(F.date_format("ts", "yyyy-MM-dd'T'"), F.lit("late"))).alias("iso_date_garbage_time"),
        X.parse_iso_ts(F.concat(F.lit("x"), iso)).alias("garbage"),
        X.parse_xml_date(F.date_format("ts", "yyyy-M-d H:m")).alias("xml_minutes"),
        X.parse_xml_date(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("xml_seconds"),
        X.parse_xml_date(iso).alias("xml_iso_rejected"),
        X.strict_ts(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("strict_seconds"),
    )


@register("prefix_split", """
SELECT o_orderkey, trim(split_part(o_orderpriority, '-', 1)) AS item_id,
       'ocds-ec9k95-' || CAST(o_orderkey AS VARCHAR) AS ocid,
       CAST(o_orderkey AS VARCHAR) AS numeroseao
FROM orders
""")
def q_prefix_split(spark, sf_dir):
    """Category prefix and ocid build/strip."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderpriority")
    ocid = X.build_ocid(F.col("o_orderkey").cast("string"))
    return o.select("o_orderkey", X.prefix_before_dash("o_orderpriority").alias("item_id"),
                    ocid.alias("ocid"), X.strip_ocid(ocid).alias("numeroseao"))


_ITEM_ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate"
_ITEMS_SQL = f"""
it AS (SELECT l_orderkey AS ocid,
              row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ITEM_ORDER}) AS pos,
              CAST(l_linenumber AS VARCHAR) AS item_id,
              CASE WHEN l_returnflag = 'R' THEN 'Classification UNSPSC principale' ELSE 'Ligne ' || l_returnflag END
                AS description,
              CASE WHEN l_linestatus = 'F' THEN 'F' || CAST(l_linenumber AS VARCHAR)
                   ELSE CAST(l_partkey AS VARCHAR) END AS class_id
       FROM lineitem),
n AS (SELECT ocid, count(*) AS n FROM it GROUP BY ocid)
"""


def _items(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    item = F.struct(
        F.col("l_linenumber").cast("string").alias("id"),
        F.when(F.col("l_returnflag") == "R", F.lit("Classification UNSPSC principale"))
        .otherwise(F.concat(F.lit("Ligne "), F.col("l_returnflag"))).alias("description"),
        F.struct(F.when(F.col("l_linestatus") == "F", F.concat(F.lit("F"), F.col("l_linenumber").cast("string")))
                 .otherwise(F.col("l_partkey").cast("string")).alias("id")).alias("classification"))
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    # an order's lines are a small bounded group: the tender's item array
    return (li.groupBy(F.col("l_orderkey").alias("ocid"))
            .agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), item.alias("it")))).alias("l"))
            .select("ocid", F.transform("l", lambda e: e["it"]).alias("items")))


@register("item_pick", f"""
WITH {_ITEMS_SQL},
f AS (SELECT it.*, n.n FROM it JOIN n ON it.ocid = n.ocid
      WHERE n.n = 1 OR strpos(description, 'Classification UNSPSC principale') = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY ocid ORDER BY
        CASE WHEN regexp_matches(class_id, '\\p{{L}}') AND regexp_matches(class_id, '\\p{{Nd}}') THEN 0 ELSE 1 END,
        pos) AS rk FROM f)
SELECT ocid, item_id AS tender_item_id, description AS tender_item_description,
       class_id AS tender_item_classification_id
FROM r WHERE rk = 1
""")
def q_item_pick(spark, sf_dir):
    """One item per tender."""
    it = _items(spark, sf_dir).select("ocid", pick_item("items").alias("p")).where(F.col("p").isNotNull())
    return it.select("ocid", F.col("p.id").alias("tender_item_id"),
                     F.col("p.description").alias("tender_item_description"),
                     F.col("p.classification.id").alias("tender_item_classification_id"))


@register("classification_pick", f"""
WITH {_ITEMS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY ocid ORDER BY
        CASE WHEN regexp_matches(class_id, '\\p{{L}}') AND regexp_matches(class_id, '\\p{{Nd}}') THEN 0 ELSE 1 END,
        pos) AS rk FROM it)
SELECT ocid, class_id AS tender_item_additional_id FROM r WHERE rk = 1
""")
def q_classification_pick(spark, sf_dir):
    """The order's lines' classifications play the additional classifications."""
    it = _items(spark, sf_dir)
    cls = F.transform("items", lambda e: e["classification"])
    return it.select("ocid", pick_classification(cls)["id"].alias("tender_item_additional_id"))
