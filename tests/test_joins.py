from __future__ import annotations

import pytest

from facetmill.operators import full_outer_using

LEFT = [("a", 1, "l1"), ("a", 1, "l2"), ("b", 2, "l3"), (None, 3, "l4"), ("hot", 9, "x"), ("hot", 9, "x")]
RIGHT = [("a", 1, "r1"), ("c", 2, "r2"), (None, 3, "r3"), ("hot", 9, "y"), ("hot", 9, "y"), ("hot", 9, "z")]


def test_equals_native_full_outer_join(spark, rows):
    left = spark.createDataFrame(LEFT * 3, "k string, n int, l string")
    right = spark.createDataFrame(RIGHT * 2, "k string, n int, r string")
    assert rows(full_outer_using(left, right)) == rows(left.join(right, ["k", "n"], "outer"))


def test_all_columns_shared(spark, rows):
    left = spark.createDataFrame(LEFT, "k string, n int, l string")
    right = spark.createDataFrame([*LEFT[:2], ("new", 1, None)], "k string, n int, l string")
    assert rows(full_outer_using(left, right)) == rows(left.join(right, left.columns, "outer"))


def test_one_native_join(spark):
    left = spark.createDataFrame(LEFT, "k string, n int, l string")
    right = spark.createDataFrame(RIGHT, "k string, n int, r string")
    plan = full_outer_using(left, right)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1


def test_no_shared_column(spark):
    with pytest.raises(ValueError):
        full_outer_using(spark.range(1), spark.range(1).toDF("other"))
