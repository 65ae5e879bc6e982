from __future__ import annotations

import json

import pytest
from cards import CARDS, bronze, card, face
from pyspark.sql import functions as F

from facetmill.operators import (
    explode_faces,
    flat_cards,
    join_faces,
    multi_faces,
    select_faces,
    select_or_null,
    single_faces,
    union_faces,
)
from facetmill.schemas import face_columns

ODD_CARDS = CARDS + [
    card(None, "1", name="no id", type_line="x"),
    card("empty", "1", name="no faces", faces=[]),
    card("three", "1", faces=[face(name=n, type_line=n) for n in "xyz"]),
    card("hole", "1", faces=[None, face(name="second", type_line="s")]),
]


@pytest.mark.parametrize("mode", ["train", "predict", "test"])
def test_one_pass_equals_union_and_join(spark, rows, mode):
    records = bronze(spark, ODD_CARDS)
    one_pass = rows(select_faces(mode, records))
    assert one_pass == rows(union_faces(mode, records)) == rows(join_faces(mode, records))
    assert len(one_pass) == 4 + 2 + 1 + 0 + 3 + 2
    assert list(one_pass[0]) == ["oracle_id", "card_face_number", *face_columns(mode), "usd", "usd_foil"]


def test_split_is_complementary(spark):
    records = bronze(spark, ODD_CARDS)
    assert single_faces("train", records).count() == 5
    assert multi_faces("train", records).count() == 7


def test_explode_keeps_position_and_price(spark, rows):
    faces = explode_faces(bronze(spark)).select("oracle_id", "card_face_number", "face.name", "usd", "usd_foil")
    assert rows(faces) == [
        {"oracle_id": "e", "card_face_number": 0, "name": "Desk", "usd": "5.80", "usd_foil": None},
        {"oracle_id": "e", "card_face_number": 1, "name": "Shelf", "usd": "5.80", "usd_foil": None},
    ]


def test_no_face_column_means_face_zero(spark, rows):
    flat = bronze(spark).drop("card_faces", "loyalty")
    got = rows(select_faces("train", flat), "oracle_id", "card_face_number", "loyalty")
    assert got == [{"oracle_id": i, "card_face_number": "0", "loyalty": None} for i in "abcde"]
    assert rows(flat_cards("train", flat)) == rows(select_faces("train", flat))
    assert multi_faces("train", flat).count() == 0


def test_inferred_schema_with_missing_fields(spark, rows, tmp_path):
    """Fields absent from the card, from the face, and from both become typed nulls."""
    records = [
        {"oracle_id": "a", "mana_cost": "{1}", "prices": {"usd": "1"}, "image_uris": {"small": "a.jpg"}},
        {"oracle_id": "b", "prices": {"usd": "2"}, "card_faces": [{"type_line": "t0"}, {"type_line": "t1", "power": "3"}]},
    ]
    path = tmp_path / "records.json"
    path.write_text(json.dumps(records))
    inferred = spark.read.json(str(path))
    assert inferred.count() == 2
    got = rows(
        select_faces("predict", inferred), "oracle_id", "card_face_number", "image_link", "mana_cost", "type_line", "power", "defense", "usd"
    )
    assert got == rows(union_faces("predict", inferred).select(*got[0]))
    assert [tuple(r.values()) for r in got] == [
        ("a", "0", "a.jpg", "{1}", None, None, None, "1"),
        ("b", "0", None, None, "t0", None, None, "2"),
        ("b", "1", None, None, "t1", "3", None, "2"),
    ]
    assert {t for _, t in select_faces("predict", inferred).dtypes} == {"string"}


def test_face_array_of_unknown_type_counts_as_absent(spark):
    untyped = bronze(spark).withColumn("card_faces", F.lit(None).cast("string"))
    assert select_faces("train", untyped).count() == 5


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        select_faces("", bronze(spark))


def test_train_scan_skips_display_fields(spark, tmp_path):
    path = str(tmp_path / "bronze")
    bronze(spark).write.parquet(path)
    faces = select_faces("train", spark.read.parquet(path))
    plan = faces._jdf.queryExecution().executedPlan().toString()
    assert "image_uris" not in plan and "Exchange" not in plan
    assert plan.count("FileScan") == 1


def test_join_merges_a_card_and_a_face_that_agree_in_every_column(spark):
    same = dict(
        mana_cost="m", type_line="t", oracle_text="o", power="p", toughness="q", loyalty="l", defense="d"
    )
    records = bronze(spark, [card("z", "1", "2", **same), card("z", "1", "2", faces=[face(**same)])])
    assert union_faces("train", records).count() == 2
    assert join_faces("train", records).count() == 1


def test_select_or_null(spark, rows):
    df = spark.range(1).select(F.lit(7).alias("a"))
    assert rows(select_or_null(df, ["b", "a"])) == [{"b": None, "a": "7"}]


def test_join_leaves_out_fields_that_one_side_lacks(spark, rows):
    """A card and a face that agree in all fields both have become one row, whatever only one has."""
    from pyspark.sql import functions as F

    from facetmill.operators import join_faces

    same = dict(name="Desk", mana_cost="m", type_line="t", oracle_text="o", power="1", toughness="2", defense="3", loyalty="4")
    records = bronze(spark, [card("e", "1", "2", **same), card("e", "1", "2", faces=[face(**same)])])
    faces = F.transform("card_faces", lambda f: f.dropFields("loyalty"))
    joined = join_faces("train", records.withColumn("card_faces", faces))
    assert [(r["oracle_id"], r["loyalty"]) for r in rows(joined)] == [("e", "4")]
    both = join_faces("train", records.drop("loyalty").withColumn("card_faces", faces))
    assert [(r["oracle_id"], r["loyalty"]) for r in rows(both)] == [("e", None)]
