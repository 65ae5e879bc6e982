from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from facetmill.functions import (
    blank_to_null,
    corner_value,
    first_result,
    label_id,
    label_name,
    normalise_strings,
    price_bucket,
    price_fallback,
    row_text,
    strip_newlines,
    strip_parenthetical,
)
from facetmill.sources import read_table, write_table

ODD_TEXTS = [
    None, "", " ", "\t\r ", "plain", " lead", "trail ", "\x01both\x1f", "é", " é ", " kept ", " kept",
    'say "hi"', 'ends with "', '"', "a;b", "back\\slash", "back\\", '\\"', "#hash", "null", "in\rside", "\x7f", "~",
]


def _one(spark, column, **values):
    schema = ", ".join(f"{name} string" for name in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("v")).first()["v"]


def _clean(text):
    return re.sub(r"\(.*?\)", "", text.replace("\n", " "))


def test_normalise_equals_a_real_csv_round_trip(spark, rows, tmp_path):
    df = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "id int, text string")
    path = str(tmp_path / "t.csv")
    write_table(df, path, "csv")
    back = read_table(spark, path, "csv")
    assert dict(back.dtypes) == {"id": "string", "text": "string"}
    want = rows(normalise_strings(df.withColumn("id", F.col("id").cast("string"))))
    assert rows(back) == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet="a() \n\té\x01", max_size=12), min_size=1, max_size=40))
def test_cleaning_equals_brute_force(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    cleaned = strip_parenthetical(strip_newlines(F.col("t")))
    got = df.select("t", cleaned.alias("c"), blank_to_null(cleaned).alias("n")).collect()
    low = "".join(map(chr, range(33)))
    for row in got:
        assert row.c == _clean(row.t)
        assert row.n == (_clean(row.t).strip(low) or None)


def test_nested_parentheses_leave_a_tail(spark):
    assert _one(spark, strip_parenthetical(F.col("t")), t="a (b (c) d) e") == "a  d) e"


def test_corner_value(spark):
    value = corner_value(*[F.col(c) for c in ("p", "t", "l", "d")])
    cases = [
        (("1", "2", "3", "4"), "1/2"), (("1", None, "3", "4"), "3"), ((None, "2", None, "4"), "4"),
        ((None, None, None, None), None), (("*", "1+*", None, None), "*/1+*"),
    ]
    for (p, t, l, d), want in cases:
        assert _one(spark, value, p=p, t=t, l=l, d=d) == want


def test_price_fallback_and_bucket(spark):
    fallback = price_fallback(F.col("u"), F.col("f"))
    assert [_one(spark, fallback, u=u, f=f) for u, f in [("1", "2"), (None, "2"), (None, None)]] == ["1", "2", None]
    bucket = price_bucket(F.col("p"))
    prices = ["3", "3.00", "2.99", "2.99999999", None, "", "n/a", "1e3"]
    # 2.99999999 rounds to 3 in 32 bits.
    assert [_one(spark, bucket, p=p) for p in prices] == [1, 1, 0, 1, 0, 0, 0, 1]


def test_labels(spark):
    df = spark.createDataFrame([(0,), (1,)], "i int").withColumn("name", label_name(F.col("i")))
    assert [tuple(r) for r in df.withColumn("back", label_id(F.col("name"))).collect()] == [
        (0, "Below_3", 0), (1, "Above_3", 1),
    ]


def test_row_text_prints_nulls(spark):
    assert _one(spark, row_text([F.col("a"), F.col("b"), F.col("c")]), a="x", b=None, c="") == "x None "


def test_first_result(spark):
    results = "array(named_struct('label','A','score',0.5D), named_struct('label','B','score',0.1D))"
    df = spark.sql(f"select {results} r, cast(array() as array<struct<label:string,score:double>>) e")
    row = df.select(first_result(F.col("r"), "label"), first_result(F.col("r"), "score"), first_result(F.col("e"), "label")).first()
    assert tuple(row) == ("A", 0.5, None)


def test_cleaning_looks_at_bytes(spark):
    """texts are neither taken apart character by character nor counted to look at their ends."""
    texts = [*ODD_TEXTS, "  ", " \t x \x01 ", "\x01 x", "x \x85", "\xa0x\xa0", "🎴 ", " 🎴", "a\n\nb\n", "\n", "\x7f ", "é\t"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    cleaned = df.select("t", strip_newlines(F.col("t")).alias("s"), blank_to_null(F.col("t")).alias("n"))
    low = "".join(map(chr, range(33)))
    for row in cleaned.collect():
        assert row.s == (None if row.t is None else row.t.replace("\n", " "))
        assert row.n == (None if row.t is None else row.t.strip(low) or None)
    plan = cleaned._jdf.queryExecution().analyzed().toString()
    assert "translate" not in plan and "substring(t" not in plan
