from datetime import date

import pytest
from pyspark.sql import functions as F

from holdfast.functions import scalars as S


def values(spark, f, inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


CASES = [
    (S.text, ["  a b ", "　x ", "", " \t", None], ["a b", "x", None, None, None]),
    (S.number, ["1.5", " -2 ", "1e3", "nan", "inf", "1d", "", None, "1e999", "."], [1.5, -2.0, 1000.0, None, None, None, None, None, None, None]),
    (S.integer, ["3.0", "3.5", "x"], [3, None, None]),
    (S.boolean, ["y", "판매중", "0", "판매완료", "maybe", None], [True, True, False, False, None, None]),
    (S.parsed_date, ["20260711", "2026-07-11", "20260231", "2026-7-1", None], [date(2026, 7, 11), date(2026, 7, 11), None, None, None]),
    (S.multi_date, ["2026.06.30", "2026/06/30", "2026-06-30T10:00:00Z", "20260630", "x"], [date(2026, 6, 30)] * 4 + [None]),
    (S.is_isin, ["kr7005380008", "KR700538000X", "KR70", None], [True, False, False, False]),
    (S.is_source_key, ["kr1234567890", "KR12345678가나", "US1234567890", "KR1"], [True, True, False, False]),
    (S.is_placeholder, ["000", "0a", None, ""], [True, False, True, True]),
    (S.uri_component, ["a b*~/é"], ["a%20b%2A~%2F%C3%A9"]),
    (S.percent_number, ["32.5%", "1,000", "-50", "", "x%"], [32.5, 1000.0, -50.0, None, None]),
    (S.usable_identifier, [" N/A ", "--", "none", "123"], [None, None, None, "123"]),
    (S.header_key, [" As Of　"], ["asof"]),
    (S.redact, ["ftp://a:b@h?api_key=s&x=1"], ["ftp://***@h?api_key=***&x=1"]),
]


@pytest.mark.parametrize(("f", "inputs", "expected"), CASES, ids=[c[0].__name__ for c in CASES])
def test_scalar(spark, f, inputs, expected):
    assert values(spark, f, inputs) == expected


def test_uris(spark):
    df = spark.createDataFrame([("us0378331005", "Acme"), ("bad", "000")], "isin string, org string")
    got = df.select(S.security_uri(F.col("isin"), F.lit("other")), S.organization_uri("name", F.col("org"))).collect()
    assert got[0][0].endswith(":isin:US0378331005") and got[1][0] == "other"
    assert len(got[0][1].rsplit(":", 1)[1]) == 24 and got[1][1] is None


def test_camel():
    assert S.camel("local_key_type") == "localKeyType"
