"""Column functions X1-X23 (all JVM-side built-ins, except NFKC).

Each returns a ``Column``; none pulls rows to Python except ``nfkc`` (a
batch-wise Arrow UDF; Spark has no Unicode normalisation built-in).
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderfold import codes


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- white space
# FIXED VALUES: the Unicode white space that a string strip removes.
WHITE_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
               "\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip(x: str | Column) -> Column:
    """The text without white space at both ends (all Unicode white space, not U+0020 alone)."""
    return F.btrim(_c(x), F.lit(WHITE_SPACE))


# ---------------------------------------------------------------- dates
# Dates are read as TIMESTAMP_NTZ text by a cast: no session time zone is involved.
_ISO = (r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}):(\d{2})(?::(\d{2})(?:\.\d+)?)?)?"
        r"(?:Z|[+-]\d{2}:\d{2}(?::\d{2})?)?$")


def _ntz(c: Column) -> Column:
    return c.try_cast("timestamp_ntz")


def parse_iso_ts(x: str | Column) -> Column:
    """Extended ISO 8601 -> TIMESTAMP_NTZ, offset dropped (not converted),
    fraction of any length truncated; a valid date part before 'T' alone ->
    midnight; else NULL.

    One ``rlike`` validates; after it every part has its place, so date, time and
    seconds are cut out by position, and 'YYYY-MM-DD[ HH:MM:SS]' is cast.
    """
    s = strip(x)
    date, time, seconds = F.substring(s, 1, 10), F.substring(s, 12, 5), F.substring(s, 17, 3)
    full = F.when(F.substring(s, 11, 1).isin("T", " "), F.concat(
        date, F.lit(" "), time, F.when(seconds.startswith(":"), seconds).otherwise(F.lit(":00")))).otherwise(date)
    date_only = F.substring_index(s, "T", 1)
    return F.coalesce(F.when(s.rlike(_ISO), _ntz(full)),
                      F.when(date_only.rlike(r"^\d{4}-\d{2}-\d{2}$"), _ntz(date_only)))


def parse_xml_date(x: str | Column) -> Column:
    """X2: 'Y-M-D H:M', 'Y-M-D H:M:S' or 'Y-M-D' (one-digit parts allowed), else NULL."""
    s = strip(x)
    full = F.when(s.rlike(r" \d{1,2}:\d{1,2}$"), F.concat(s, F.lit(":00"))).otherwise(s)
    return F.when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}(?: \d{1,2}:\d{1,2}(?::\d{1,2})?)?$"), _ntz(full))


def strict_ts(x: str | Column) -> Column:
    """Only 'YYYY-MM-DD HH:MM:SS' survives (a timestamp with a fraction does not)."""
    s = _c(x).cast("string")
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"), _ntz(s))


# ---------------------------------------------------------------- numbers / codes
def safe_int(x: str | Column, default: int | None = 0) -> Column:
    """Int of the stripped text (any number of digits that an INT holds), else ``default``."""
    s = strip(_c(x).cast("string"))
    v = F.when(s.rlike(r"^[+-]?\d+$"), s.try_cast("int"))
    return v if default is None else F.coalesce(v, F.lit(default))


def _lookup(code: Column, mapping: dict, default) -> Column:
    m = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    got = F.element_at(m, code)
    return got if default is None else F.coalesce(got, F.lit(default))


def procurement_method(type_code: Column) -> Column:
    """X6."""
    mapping = {c: "open" for c in codes.METHOD_OPEN_TYPES}
    mapping.update({c: "direct" for c in codes.METHOD_DIRECT_TYPES})
    mapping.update({c: "limited" for c in codes.METHOD_LIMITED_TYPES})
    return _lookup(type_code, mapping, codes.METHOD_DEFAULT)


def procurement_method_details(type_code: Column) -> Column:
    """X7."""
    return _lookup(type_code, codes.METHOD_DETAILS, codes.METHOD_DETAILS_DEFAULT)


def main_category(precision_code: Column) -> Column:
    """X8."""
    return _lookup(precision_code, codes.MAIN_CATEGORY, codes.MAIN_CATEGORY_DEFAULT)


def additional_categories(nature_code: Column) -> Column:
    """Comma-joined list (one element or empty)."""
    return F.coalesce(_lookup(nature_code, codes.ADDITIONAL_CATEGORY, None), F.lit(""))


def prefix_before_dash(x: str | Column) -> Column:
    """Text before the first '-', trimmed; '' for empty."""
    return F.coalesce(strip(F.split(strip(x), "-", 2).getItem(0)), F.lit(""))


def build_ocid(numeroseao: str | Column) -> Column:
    """X11."""
    return F.concat(F.lit(codes.OCID_PREFIX), F.coalesce(strip(numeroseao), F.lit("")))


def strip_ocid(ocid: str | Column) -> Column:
    return F.regexp_replace(_c(ocid), "^" + codes.OCID_PREFIX.replace("-", r"\-"), "")


# ---------------------------------------------------------------- text
@F.arrow_udf(T.StringType())
def nfkc(a: pa.Array) -> pa.Array:
    """NFKC normalisation per Arrow batch (Python's ``unicodedata``; pyarrow's
    ``utf8_normalize`` was found to leave NFKC text decomposed).

    The batch is normalised as one text with a separator that takes part in no
    composition; only if that separator occurs in the data, value by value.
    """
    values = a.to_pylist()
    joined = "\x1e".join(v or "" for v in values)
    if joined.isascii():
        return a
    if joined.count("\x1e") == len(values) - 1:
        done = unicodedata.normalize("NFKC", joined).split("\x1e")
    else:
        done = [unicodedata.normalize("NFKC", v or "") for v in values]
    return pa.array([None if v is None else d for v, d in zip(values, done)], pa.string())


# FIXED VALUES: quotes that become straight ones, and what each becomes.
QUOTES, STRAIGHT_QUOTES = "’‘ʼ‛“”", "''''\"\""


def clean_text_basic(x: str | Column) -> Column:
    """X12 without NFKC: CR dropped, LF and control runs -> one space,
    curly quotes -> straight."""
    t = F.regexp_replace(_c(x), "\r", "")
    t = F.regexp_replace(t, "\n", " ")
    t = F.regexp_replace(t, r"[\x00-\x1F]+", " ")
    t = F.translate(t, QUOTES, STRAIGHT_QUOTES)
    return t


def clean_text(x: str | Column, normalize: bool = True) -> Column:
    """Empty -> NULL, else cleaned (and NFKC-normalised)."""
    c = _c(x)
    t = clean_text_basic(c)
    if normalize:
        t = nfkc(t)
    return F.when(c.isNotNull() & (c != ""), t)


def parse_bit(x: str | Column) -> Column:
    """X14: '1' -> 1, '0' -> 0, else NULL."""
    s = strip(_c(x).cast("string"))
    return F.when(s == "1", F.lit(1)).when(s == "0", F.lit(0))


def truthy_bit(x: str | Column) -> Column:
    """Python truthiness of a staging BIT -> 1/0 (NULL -> 0)."""
    return F.when(_c(x).cast("int") == 1, F.lit(1)).otherwise(F.lit(0))


def municipal_flag(x: str | Column) -> Column:
    """Digits only, else NULL; stored in a BIT column, so any number but 0 is 1."""
    s = strip(x)
    return F.when(s.rlike(r"^[0-9]+$"), F.when(s.rlike("[1-9]"), F.lit(1)).otherwise(F.lit(0)))


def has_letter_and_digit(x: str | Column) -> Column:
    """X16."""
    s = F.coalesce(_c(x), F.lit(""))
    return s.rlike(r"\p{L}") & s.rlike(r"\p{Nd}")


def bid_unit(x: str | Column, blank_is_missing: bool = True) -> Column:
    """Unit of a bid; missing (and, if wanted, blank or 0) is the default currency."""
    s = _c(x).cast("string")
    if not blank_is_missing:
        return F.coalesce(s, F.lit(codes.DEFAULT_CURRENCY))
    return F.when(F.coalesce(strip(s), F.lit("")).isin("", "0"), F.lit(codes.DEFAULT_CURRENCY)).otherwise(s)


def contract_status(datepublicationfinale: str | Column) -> Column:
    """X20: 'active' without a final publication date, else 'terminated'."""
    return F.when(_c(datepublicationfinale).isNull(), F.lit("active")).otherwise(F.lit("terminated"))


def url_list(documents: str | Column) -> Column:
    """Comma-joined urls of the documents that have one."""
    d = _c(documents)
    return F.coalesce(F.array_join(F.transform(F.filter(d, lambda e: e["url"].isNotNull()), lambda e: e["url"]), ","),
                      F.lit(""))


def join_list(arr: str | Column) -> Column:
    """List -> comma text ('' for missing)."""
    return F.coalesce(F.array_join(_c(arr), ","), F.lit(""))
