from __future__ import annotations

import pytest
from cards import CARDS, bronze, card, face
from pyspark.sql import functions as F

from facetmill import gold_transform, silver_transform
from facetmill.functions import normalise_strings
from facetmill.operators import first_per_group, pivot_faces
from facetmill.schemas import gold_columns, silver_columns

SILVER_TRAIN = "oracle_id string, card_face_number string, mana_cost string, type_line string, oracle_text string, bottomright_value string, price string"


def test_silver_values(spark, rows):
    silver = silver_transform("train", bronze(spark))
    assert silver.columns == silver_columns("train")
    got = {(r["oracle_id"], r["card_face_number"]): r for r in rows(silver)}
    assert got["a", "0"]["oracle_text"] == "Hang it high "
    assert got["b", "0"]["oracle_text"] == ""
    assert got["e", "1"]["oracle_text"] == "Lower  board"
    assert {k: r["bottomright_value"] for k, r in got.items()} == {
        ("a", "0"): None, ("b", "0"): "40/30", ("c", "0"): "6", ("d", "0"): "5", ("e", "0"): "8", ("e", "1"): "3",
    }
    assert {k[0]: r["price"] for k, r in got.items()} == {"a": "1.49", "b": "7.20", "c": "3.5", "d": None, "e": "5.80"}


def test_silver_predict_columns(spark, rows):
    silver = silver_transform("predict", bronze(spark))
    assert silver.columns == silver_columns("predict")
    links = {(r["name"], r["image_link"]) for r in rows(silver)}
    assert links == {("Lamp", "a.jpg"), ("Stool", None), ("Clock", None), ("Rug", None), ("Desk", "e0.jpg"), ("Shelf", "e1.jpg")}


def test_silver_test_mode_uses_train_columns(spark):
    assert silver_transform("test", bronze(spark)).columns == silver_columns("train")


@pytest.mark.parametrize("combine", ["union", "join"])
def test_silver_combinations_agree(spark, rows, combine):
    assert rows(silver_transform("predict", bronze(spark), combine)) == rows(silver_transform("predict", bronze(spark)))


def test_gold_values(spark, rows):
    gold = gold_transform("predict", normalise_strings(silver_transform("predict", bronze(spark))))
    assert gold.columns == gold_columns("predict")
    got = {r["oracle_id"]: r for r in rows(gold)}
    assert len(got) == 5
    assert got["e"] == {
        "oracle_id": "e", "name": "Desk", "image_link": "e0.jpg", "mana_cost": "4 parts",
        "type_line": "Table", "oracle_text": "Upper board", "bottomright_value": "8",
        "second_name": "Shelf", "second_image_link": "e1.jpg", "second_mana_cost": "6 parts",
        "second_type_line": "Rack", "second_oracle_text": "Lower  board",
        "second_bottomright_value": "3", "price": "5.80",
    }
    # Text that is empty after cleaning becomes the token; display columns and price stay null.
    assert got["d"]["oracle_text"] == "[Null]" and got["d"]["price"] is None
    assert got["b"]["image_link"] is None and got["b"]["second_name"] is None
    assert got["b"]["second_oracle_text"] == "[Null]"


def _silver(spark, *data):
    return spark.createDataFrame([(i, n, "m", "t", text, None, price) for i, n, text, price in data], SILVER_TRAIN)


def test_whole_input_decides_between_pivot_and_padding(spark):
    two = _silver(spark, ("a", "0", "x", "1"), ("a", "0", "y", "2"), ("b", "1", "z", None))
    assert gold_transform("train", two).count() == 2
    for extra in ([], [("c", "1", "q", None), ("c", "2", "r", None)]):
        other = _silver(spark, ("a", "0", "x", "1"), ("a", "0", "y", "2"), *extra)
        padded = gold_transform("train", other)
        assert padded.count() == 2 + len(extra)
        assert padded.columns == gold_columns("train")
        assert padded.filter("second_type_line <> '[Null]'").count() == 0
    assert gold_transform("train", two, widen="pad").count() == 3


@pytest.mark.parametrize("numbers", [("1", "2"), ("0", "2"), ("0", None)])
def test_two_numbers_must_be_zero_and_one(spark, numbers):
    silver = _silver(spark, *[("a", n, "x", "1") for n in numbers])
    with pytest.raises(ValueError, match="not 0 and 1"):
        gold_transform("train", silver)


@pytest.mark.parametrize("number", ["2", None])
def test_pivot_drops_no_face(spark, number):
    silver = _silver(spark, ("a", "0", "x", "1"), ("a", "1", "y", "2"), ("a", number, "z", "3"))
    with pytest.raises(Exception, match="no columns for face number"):
        pivot_faces("train", silver).collect()


def test_first_row_wins_as_a_whole(spark, rows):
    silver = _silver(spark, ("a", "0", "b", "9"), ("a", "0", "a", "8"), ("a", "0", None, "7"), ("a", "1", "s", "1"))
    assert rows(pivot_faces("train", silver), "oracle_text", "second_oracle_text", "price") == [
        {"oracle_text": None, "second_oracle_text": "s", "price": "7"}
    ]
    by_price = pivot_faces("train", silver.withColumn("seq", -F.col("price").cast("int")), order_by=["seq"])
    assert rows(by_price, "oracle_text", "price") == [{"oracle_text": "b", "price": "9"}]


def test_null_ids_form_one_group(spark):
    silver = _silver(spark, (None, "0", "x", "1"), (None, "1", "y", "2"), (None, "0", "z", "3"))
    assert pivot_faces("train", silver).count() == 1


def test_result_does_not_depend_on_row_order_or_partitions(spark, rows):
    records = CARDS + [card("e", "7", faces=[face(name="Desk", oracle_text=t), face(name="Shelf")]) for t in "zyxw"]
    want = rows(gold_transform("predict", silver_transform("predict", bronze(spark, records))))
    shuffled = bronze(spark, records[::-1]).repartition(7)
    assert rows(gold_transform("predict", silver_transform("predict", shuffled))) == want


def test_hot_group_is_reduced_before_the_shuffle(spark):
    plan = pivot_faces("train", _silver(spark, ("a", "0", "x", "1")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_min" in plan


def test_item_with_a_third_of_all_rows(spark, rows):
    """Every row of a hot item is considered, and the others keep theirs."""
    hot = [("hot", str(i % 2), f"t{i:05d}", str(i)) for i in range(3000, 0, -1)]
    cold = [(f"c{i}", str(k), f"x{k}", str(i)) for i in range(3000) for k in (0, 1)]
    gold = rows(gold_transform("train", _silver(spark, *hot, *cold).repartition(16)))
    assert len(gold) == 3001
    (row,) = [r for r in gold if r["oracle_id"] == "hot"]
    assert (row["oracle_text"], row["price"], row["second_oracle_text"]) == ("t00002", "2", "t00001")


def test_first_per_group(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 5, None)], "k string, o int, v string")
    assert rows(first_per_group(df, ["k"], ["v"], ["o"])) == [{"k": "a", "v": "y"}, {"k": "b", "v": None}]
