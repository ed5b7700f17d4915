"""Scalar functions against small literal tables and Python restatements of the reference rules."""

import datetime as dt
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tenderfold.functions import items as I
from tenderfold.functions import scalars as X


def _col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def py_iso(s):
    """The reference rule, restated (extended ISO only)."""
    if not s:
        return None
    s = s.strip()
    m = re.match(r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}):(\d{2})(?::(\d{2})(?:\.\d{1,6})?)?)?"
                 r"(?:Z|[+-]\d{2}:\d{2}(?::\d{2})?)?$", s)
    if m:
        try:
            return dt.datetime.strptime(f"{m[1]} {m[2] or '00'}:{m[3] or '00'}:{m[4] or '00'}", "%Y-%m-%d %H:%M:%S")
        except ValueError:
            pass
    d = s.split("T")[0]
    if re.fullmatch(r"\d{4}-\d{2}-\d{2}", d):
        try:
            return dt.datetime.strptime(d, "%Y-%m-%d")
        except ValueError:
            return None
    return None


def test_iso_dates(spark):
    vals = ["2021-03-01T10:00:00-05:00", "2021-03-01T10:00:00Z", "2021-03-01T10:00:00.987654", "2021-03-01",
            "2021-03-01T10:00", "2021-03-01 10:00:05", "garbage", "", None, "2021-02-30", "2021-03-01T25:00:00",
            "2021-03-01Tlate", "2021-3-1", "2021", " 2021-03-01T01:02:03+01:00 ", "2021-03-01T10:00:00+05:30"]
    assert _col(spark, vals, X.parse_iso_ts) == [py_iso(v) for v in vals]


def test_xml_dates(spark):
    vals = ["2021-1-5 9:5", "2021-01-05 09:05:07", "2021-01-05", "2021-01-05T09:05", "x", "", None]
    exp = [dt.datetime(2021, 1, 5, 9, 5), dt.datetime(2021, 1, 5, 9, 5, 7), dt.datetime(2021, 1, 5),
           None, None, None, None]
    assert _col(spark, vals, X.parse_xml_date) == exp


def test_ints_bits_codes(spark):
    assert _col(spark, [" 5 ", "x", None, "+7", "5.0"], X.safe_int) == [5, 0, 0, 7, 0]
    assert _col(spark, ["1234567890", "2147483647", "-0000000000012", "2147483648"], X.safe_int) == [
        1234567890, 2147483647, -12, 0]
    assert _col(spark, ["1", "0", " 1 ", "2", None], X.parse_bit) == [1, 0, 1, None, None]
    assert _col(spark, ["12", "1a", "", None], X.municipal_flag) == [1, None, None, None]
    assert _col(spark, ["00", "1", "12345678901"], X.municipal_flag) == [0, 1, 1]


def test_strip_removes_all_white_space(spark):
    texts = ["\t a b\n", "\u00a0x\u2003", " ", "y", None, "\x1f\r z"]
    assert _col(spark, texts, X.strip) == [t if t is None else t.strip() for t in texts]


@pytest.mark.parametrize("zone", ["UTC", "America/Toronto"])
def test_dates_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        want = dt.datetime(2021, 3, 14, 2, 30)
        assert _col(spark, ["2021-03-14T02:30:00-05:00", "2021-03-14T02:30", "2021-03-01T10:00:00.1234567Z"],
                    X.parse_iso_ts) == [want, want, dt.datetime(2021, 3, 1, 10)]
        assert _col(spark, ["2021-3-14 2:30", "2021-03-14 02:30:00"], X.parse_xml_date) == [want, want]
        assert _col(spark, ["2021-03-14 02:30:00"], X.strict_ts) == [want]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert _col(spark, ["S3", "300", "Ab", "é9", None], X.has_letter_and_digit) == [True, False, False, True, False]
    assert _col(spark, ["S7 - Services", "  C01-x ", "", None, "nodash"], X.prefix_before_dash) == \
        ["S7", "C01", "", "", "nodash"]
    assert _col(spark, [3, 9, 6, 4, None], X.procurement_method, "int") == ["open", "direct", "limited", "open", "open"]
    assert _col(spark, [4, 3], X.additional_categories, "int") == ["", "Travaux de construction"]


def py_clean(t):
    if not t:
        return None
    t = t.replace("\r", "").replace("\n", " ")
    t = re.sub(r"[\x00-\x1F]+", " ", t)
    for a, b in [("’", "'"), ("‘", "'"), ("ʼ", "'"), ("‛", "'"), ("“", '"'), ("”", '"')]:
        t = t.replace(a, b)
    return unicodedata.normalize("NFKC", t)


def test_clean_text(spark):
    vals = ["a\r\nb\tc\x01\x02d", "l’été “x”", "ﬁ ２ ²  x", "", None, "plain"]
    assert _col(spark, vals, X.clean_text) == [py_clean(v) for v in vals]


def test_clean_text_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = docs.select("text", X.clean_text("text").alias("c")).collect()
    assert all(r.c == py_clean(r.text) for r in got)


def test_item_pick(spark):
    schema = ("items array<struct<id:string, description:string, classification:struct<id:string>,"
              " additionalClassifications:array<struct<scheme:string,id:string,description:string>>>>")
    it = lambda i, d, c: (i, d, (c,), [])
    rows = [([it("a", "Classification UNSPSC principale", "S3")],),
            ([it("a", "Classification UNSPSC principale", "S3"), it("b", "x", "100"), it("c", "y", "C1")],),
            ([it("a", "Classification UNSPSC principale", "S3"), it("b", "x", "100")],),
            ([it("a", "Classification UNSPSC principale", "S3"), it("b", "Classification UNSPSC principale", "1")],),
            ([],), (None,)]
    df = spark.createDataFrame(rows, schema)
    got = [r.p for r in df.select(I.pick_item("items")["id"].alias("p")).collect()]
    assert got == ["a", "c", "b", None, None, None]


def test_construction_item(spark):
    schema = ("items array<struct<id:string, description:string, classification:struct<id:string>,"
              " additionalClassifications:array<struct<scheme:string,id:string,description:string>>>>")
    rows = [([("a", "autre", ("1",), [("s", "1", "C01 - Bâtiments")]), ("b", "C01 - Bâtiments", ("2",), [])],),
            ([("a", "autre", ("1",), None)],)]
    df = spark.createDataFrame(rows, schema)
    assert [r.p for r in df.select(I.pick_construction_item("items")["id"].alias("p")).collect()] == ["a", None]
