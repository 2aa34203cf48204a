"""Scalar column functions: cleaning, typing, identity. All are built-in expressions without Python UDFs.

Absent stays absent: a value that can't be read becomes null, never an empty string, zero or false.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefix of every identifier that this library makes.
URN = "urn:holdfast"

# Fixed values
TRUE_WORDS = ["Y", "YES", "TRUE", "1", "판매중"]
FALSE_WORDS = ["N", "NO", "FALSE", "0", "판매완료"]
UNUSABLE_IDENTIFIERS = ["n/a", "na", "none", "null", "not applicable", "-", "--", ""]
ISIN_SHAPE = "^[A-Z]{2}[A-Z0-9]{9}[0-9]$"

#: What Python's strip() takes as white space: as characters to trim, and as a pattern.
_BLANKS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"
_NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def text(c: Column) -> Column:
    """Without white space at the ends; empty is null."""
    return F.nullif(F.btrim(c.cast("string"), F.lit(_BLANKS)), F.lit(""))


def number(c: Column) -> Column:
    """A finite double, else null."""
    return number_of(text(c))


def number_of(t: Column) -> Column:
    """``number`` of a cleaned text. What has its shape is a number, but may be too large."""
    value = t.try_cast("double")
    return F.when(t.rlike(_NUMBER) & (F.abs(value) < float("inf")), value)


def integer(c: Column) -> Column:
    """A whole number, else null."""
    n = number(c)
    return F.when((n == F.floor(n)) & (F.abs(n) < 2.0**63), n.cast("long"))


def boolean(c: Column) -> Column:
    """True, false or null for any other word."""
    return boolean_of(text(c))


def boolean_of(t: Column) -> Column:
    t = F.upper(t)
    return F.when(t.isin(TRUE_WORDS), True).when(t.isin(FALSE_WORDS), False)


def parsed_date(c: Column) -> Column:
    """Eight digits with or without hyphens; days that don't exist are null."""
    return date_of(text(c))


def date_of(t: Column) -> Column:
    t = F.replace(t, F.lit("-"), F.lit(""))
    return F.when(t.rlike(r"^[0-9]{8}$"), F.try_to_timestamp(t, F.lit("yyyyMMdd")).cast("date"))


def multi_date(c: Column) -> Column:
    """A date written with hyphens, dots or slashes, or the day of an ISO date and time."""
    t = text(c)
    day = F.translate(F.regexp_extract(t, r"^([0-9]{4}[-./][0-9]{1,2}[-./][0-9]{1,2})([T ].*)?$", 1), "./", "--")
    plain = F.when(t.rlike(r"^[0-9]{8}$"), F.try_to_timestamp(t, F.lit("yyyyMMdd")).cast("date"))
    return F.coalesce(plain, F.when(day != "", F.try_to_timestamp(day, F.lit("yyyy-M-d")).cast("date")))


def is_isin(c: Column) -> Column:
    """Whether it has the shape of an ISIN; no check digit."""
    return is_isin_of(text(c))


def is_isin_of(t: Column) -> Column:
    return F.coalesce(F.upper(t).rlike(ISIN_SHAPE), F.lit(False))


def is_source_key(c: Column) -> Column:
    """Twelve letters or digits that begin with KR."""
    return is_source_key_of(text(c))


def is_source_key_of(t: Column) -> Column:
    return F.coalesce(t.rlike(r"^[Kk][Rr][\p{L}\p{N}]{10}$"), F.lit(False))


def is_placeholder(c: Column) -> Column:
    """Null or nothing but zeros."""
    return is_placeholder_of(text(c))


def is_placeholder_of(t: Column) -> Column:
    return t.isNull() | t.rlike("^0+$")


def uri_component(c: Column) -> Column:
    """Percent-encoded, with nothing but letters, digits and ``_.-~`` left as they are."""
    e = F.url_encode(c)
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        e = F.replace(e, F.lit(a), F.lit(b))
    return F.when(c.rlike(r"^[A-Za-z0-9_.~-]*$"), c).otherwise(e)


def hash_id(c: Column) -> Column:
    """The first 24 hex digits of the SHA-256 of the lower-cased text."""
    return F.substring(F.sha2(F.lower(c).cast("binary"), 256), 1, 24)


def percent_number(c: Column) -> Column:
    """A number that may have thousands separators and a percent sign."""
    return number(F.regexp_replace(c, "[,%]", ""))


def usable_identifier(c: Column) -> Column:
    t = text(c)
    return F.when(~F.lower(t).isin(UNUSABLE_IDENTIFIERS), t)


def header_key(c: Column) -> Column:
    """A header as it is compared: without white space, lower-cased."""
    return F.lower(F.regexp_replace(c, _SPACE, ""))


def cell_text(c: Column, kind: str) -> Column:
    """A typed cell as text: dates as ISO days, whole floating numbers without a fraction."""
    if kind in ("double", "float"):
        return F.when((c == F.floor(c)) & (F.abs(c) < 2.0**63), c.cast("long").cast("string")).otherwise(c.cast("string"))
    return F.date_format(c, "yyyy-MM-dd") if kind in ("date", "timestamp", "timestamp_ntz") else c.cast("string")


def camel(name: str) -> str:
    """A snake-case name in camel case."""
    first, *rest = name.split("_")
    return first + "".join(w.capitalize() for w in rest)


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts joined by bars; nulls count as empty."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"), 256)


def first_of(*choices: Column) -> Column:
    """The first choice whose text isn't blank."""
    return F.coalesce(*[text(c) for c in choices])


def redact(c: Column) -> Column:
    """An error text without credentials and secret parameters, printable, 500 characters at most."""
    c = F.regexp_replace(c, r"(?i)([a-z][a-z0-9+.-]*://)[^/@\s]+@", "$1***@")
    c = F.regexp_replace(c, r"(?i)\b(api[_-]?key|token|secret|password|passwd|authorization)(\s*[=:]\s*)[^\s&;,]+", "$1$2***")
    return F.left(F.regexp_replace(c, r"[^\p{Print}\p{L}\p{N}]", " "), F.lit(500))


def uri(kind: str, *parts: Column) -> Column:
    """An identifier of a kind from its encoded parts; null if any part is."""
    return F.concat(F.lit(f"{URN}:{kind}"), *[x for p in parts for x in (F.lit(":"), uri_component(p))])


def security_uri(isin: Column, fallback: Column) -> Column:
    return security_uri_of(text(isin), fallback)


def security_uri_of(t: Column, fallback: Column) -> Column:
    return F.when(is_isin_of(t), F.concat(F.lit(f"{URN}:isin:"), F.upper(t))).otherwise(fallback)


def organization_uri(scheme: str, name: Column) -> Column:
    return organization_uri_of(scheme, text(name))


def organization_uri_of(scheme: str, t: Column) -> Column:
    return F.when(~is_placeholder_of(t), F.concat(F.lit(f"{URN}:organization:{scheme}:"), hash_id(t)))


def identifier_uri(scheme: Column, value: Column) -> Column:
    t = text(value)
    shown = F.when(F.upper(scheme) == "ISIN", F.upper(t)).otherwise(t)
    return F.when(~is_placeholder_of(t), F.concat(F.lit(f"{URN}:identifier:"), F.lower(scheme), F.lit(":"), uri_component(shown)))


def identifier_uri_of(scheme: str, t: Column) -> Column:
    return F.when(~is_placeholder_of(t), F.concat(F.lit(f"{URN}:identifier:{scheme.lower()}:"), uri_component(F.upper(t) if scheme == "ISIN" else t)))


def benchmark_uri(name: Column, english: Column) -> Column:
    return benchmark_uri_of(text(name), text(english))


def benchmark_uri_of(name: Column, english: Column) -> Column:
    return F.concat(F.lit(f"{URN}:benchmark:"), hash_id(F.coalesce(name, english)))


def classification_uri(scheme: Column, value: Column) -> Column:
    return F.concat(F.lit(f"{URN}:classification:"), scheme, F.lit(":"), uri_component(text(value)))


def classification_uri_of(scheme: str, t: Column) -> Column:
    return F.concat(F.lit(f"{URN}:classification:{scheme}:"), uri_component(t))


def source_uri(dataset: Column, stamp: Column, row_number: Column) -> Column:
    return F.concat_ws(":", F.lit(f"{URN}:source-record"), dataset, F.coalesce(stamp.cast("string"), F.lit("undated")), row_number.cast("string"))


def observation_uri(owner: Column, as_of: Column) -> Column:
    """One observation for each owner and day; the whole owner's identifier takes part."""
    return F.concat(F.lit(f"{URN}:observation:"), uri_component(owner), F.lit(":"), F.coalesce(as_of.cast("string"), F.lit("undated")))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
