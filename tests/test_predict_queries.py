"""The queries that train and predict, on tables of a few rows."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from facetmill.plans import queries


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Lines of which some come twice, lack their order or part, or hold nulls."""
    folder = str(tmp_path_factory.mktemp("tables"))
    k = F.col("id")
    lines = spark.range(120).select(
        (k / 3).cast("long").alias("l_orderkey"),
        F.when(k % 17 != 5, k % 9).alias("l_partkey"),
        (k % 3 + 1).cast("int").alias("l_linenumber"),
        (k % 50 + 1).cast("double").alias("l_quantity"),
        F.when(k % 13 != 4, (k % 11) / 100).alias("l_discount"),
        ((k % 9) / 100).alias("l_tax"),
        F.element_at(F.array(*map(F.lit, "NRA")), (k % 3 + 1).cast("int")).alias("l_returnflag"),
        F.when(k % 2 == 0, "F").otherwise("O").alias("l_linestatus"),
    )
    lines.union(lines.limit(5)).write.parquet(f"{folder}/lineitem.parquet")
    orders = spark.range(38).select(
        k.alias("o_orderkey"),
        F.when(k % 3 == 0, "F").otherwise("O").alias("o_orderstatus"),
        F.lit(datetime(1998, 1, 2)).alias("o_orderdate"),
        F.lit("5-LOW").alias("o_orderpriority"),
    )
    orders.write.parquet(f"{folder}/orders.parquet")
    parts = spark.range(8).select(
        k.alias("p_partkey"),
        F.concat(F.lit("ÉTÉ ring "), k.cast("string")).alias("p_name"),
        F.concat(F.lit("Brand#"), k.cast("string")).alias("p_brand"),
        F.lit("STANDARD  Σ").alias("p_type"),
        (k + 1).cast("int").alias("p_size"),
    )
    parts.write.parquet(f"{folder}/part.parquet")
    return folder


@pytest.mark.parametrize("name", ["e2e_predict", "e2e_predict_tokens"])
def test_tables_are_joined_once_for_both_zones(spark, tables, monkeypatch, name):
    """the predict zone gets the records that the train zone was given."""
    made = []

    def counted(session, sf_dir, make=queries.bronze_records):
        made.append(sf_dir)
        return make(session, sf_dir)

    monkeypatch.setattr(queries, "bronze_records", counted)
    got = queries.QUERIES[name](spark, tables).collect()
    assert made == [tables]
    # Null parts leave names empty, not rows out.
    assert len(got) == 120 and {r.oracle_id for r in got} == {f"{k // 3}-{k % 3 + 1}" for k in range(120)}
    assert all(r.label_is_likelier and r.score_is_recomputed for r in got)
