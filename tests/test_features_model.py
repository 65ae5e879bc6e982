from __future__ import annotations

import hashlib
import re
from collections import Counter
from math import log

import numpy as np
import pytest
from pyspark.sql import functions as F

from facetmill.operators import (
    build_vocabulary,
    confusion_counts,
    each_text,
    encode_tokens,
    encoded_training_set,
    evaluate,
    fit_classifier,
    hash_split,
    log_loss,
    score_with,
    score_with_model,
    select_results,
    training_set,
    unpack_results,
    with_row_text,
)
from facetmill.schemas import gold_columns, string_schema

TEXTS = [
    "The red ring, the RED ring",
    "",
    None,
    "  spaced\tout\n\nwords  ",
    "the " * 12,
    "é É ring " + "x" * 101 + " " + "y" * 100,
]


def _words(text):
    return [w for w in re.split(r"[\x09-\x0D ]+", (text or "").lower()) if w]


def _vocabulary(texts, size):
    counts = Counter(w for t in texts for w in _words(t))
    ranked = sorted(counts.items(), key=lambda item: (-item[1], item[0].encode()))[:size]
    return {word: (n, i + 2) for i, (word, n) in enumerate(ranked)}


def _texts(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(3)


@pytest.mark.parametrize("size", [4, 1000, None])
def test_vocabulary_equals_brute_force(spark, size):
    got = {r.token: (r.n, r.token_id) for r in build_vocabulary(_texts(spark), "t", size).collect()}
    assert got == _vocabulary(TEXTS, size)


def test_vocabulary_keeps_all_words_by_default(spark):
    texts = [" ".join(f"w{i * k}" for i in range(900)) for k in range(1, 60)] + ["x" * 5000]
    got = {r.token: (r.n, r.token_id) for r in build_vocabulary(_texts(spark, texts), "t").collect()}
    assert got == _vocabulary(texts, None) and len(got) > 20_000


def test_vocabulary_drops_rare_words_exactly(spark):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in range(1, 60)]
    for size in (1, 2, 17, 40, 59, 60):
        got = {r.token: (r.n, r.token_id) for r in build_vocabulary(_texts(spark, texts), "t", size).collect()}
        assert got == _vocabulary(texts, size)


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
@pytest.mark.parametrize("truncate", [False, True])
def test_encoding_equals_brute_force(spark, truncate, broadcast_bytes):
    known = _vocabulary(TEXTS, 5)
    df = _texts(spark)
    encoded = encode_tokens(df, "t", build_vocabulary(df, "t", 5), 8, truncate, broadcast_bytes)
    assert encoded.columns == ["id", "t", "input_ids", "attention_mask"]
    for row in encoded.collect():
        ids = [known[w][1] if w in known else 1 for w in _words(TEXTS[row.id])]
        ids = ids[:8] if truncate else ids
        padding = [0] * (8 - len(ids))
        assert row.input_ids == ids + padding
        assert row.attention_mask == [1] * len(ids) + padding


def test_encoding_does_not_shuffle(spark):
    df = spark.createDataFrame([(0, "a")], "id int, t string")
    encoded = encode_tokens(df, "t", build_vocabulary(df, "t"))
    assert "Exchange" not in encoded._jdf.queryExecution().executedPlan().toString()


def _gold(spark, *data):
    filler = {c: "[Null]" for c in gold_columns("train")}
    full = [{**filler, "price": None, **d} for d in data]
    return spark.createDataFrame([tuple(d[c] for c in gold_columns("train")) for d in full], string_schema(gold_columns("train")))


def test_training_set(spark, rows):
    gold = _gold(
        spark,
        dict(oracle_id="t", mana_cost="12 kg", type_line="Shelf — oak", bottomright_value="80/30", price="1.49"),
        dict(oracle_id="u", second_oracle_text=None, price="3"),
    )
    training = training_set(gold)
    assert training.dtypes == [("gameplay_text", "string"), ("price", "int")]
    assert rows(training) == [
        {"gameplay_text": "12 kg Shelf — oak [Null] 80/30 [Null] [Null] [Null] [Null]", "price": 0},
        {"gameplay_text": "[Null] [Null] [Null] [Null] [Null] [Null] None [Null]", "price": 1},
    ]
    encoded = encoded_training_set(training, build_vocabulary(training, "gameplay_text"))
    assert encoded.dtypes == [("input_ids", "array<int>"), ("attention_mask", "array<int>"), ("label", "int")]
    assert all(len(r.input_ids) == len(r.attention_mask) == 194 for r in encoded.collect())


def test_hash_split(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).cast("string").alias("k"))
    train, test = hash_split(df, ["id"], 0.2)
    picked = {r.id for r in test.collect()}
    assert picked == {i for i in range(5000) if hashlib.md5(str(i).encode()).hexdigest()[:8] < "33333333"}
    assert train.count() + test.count() == 5000
    assert picked == {r.id for r in hash_split(df.repartition(5), ["id"], 0.2)[1].collect()}


def test_hash_split_edges(spark):
    df = spark.createDataFrame([(None, "x"), ("a", None)], "k string, v string")
    for size, count in [(0.0, 0), (1.0, 2)]:
        train, test = hash_split(df, ["k", "v"], size)
        assert (train.count(), test.count()) == (2 - count, count)
    with pytest.raises(ValueError):
        hash_split(df, ["k"], 1.5)


def test_log_loss_and_confusion(spark, rows):
    df = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, 0.0)], "y int, p double")
    want = -(log(0.9) + log(0.8) + log(1e-15)) / 3
    assert df.agg(log_loss(F.col("y"), F.col("p")).alias("l")).first()["l"] == pytest.approx(want)
    guessed = df.withColumn("g", (F.col("p") > 0.5).cast("int"))
    assert rows(confusion_counts(guessed, "y", "g")) == [
        {"y": 0, "g": 0, "n": 1}, {"y": 1, "g": 0, "n": 1}, {"y": 1, "g": 1, "n": 1},
    ]


@pytest.fixture(scope="module")
def learned(spark):
    gold = _gold(
        spark,
        *[dict(oracle_id=f"d{i}", oracle_text=f"dear word{i % 7}", price="9") for i in range(40)],
        *[dict(oracle_id=f"c{i}", oracle_text=f"cheap word{i % 7}", price="1") for i in range(40)],
    )
    return fit_classifier(training_set(gold), num_features=256), gold


def test_classifier_separates_words(learned):
    model, gold = learned
    metrics = evaluate(model, training_set(gold))
    assert metrics["eval_accuracy"] == 1.0 and metrics["eval_loss"] < 0.5
    assert metrics["eval_true_1_predicted_1"] == metrics["eval_true_0_predicted_0"] == 40
    scored = score_with_model(model, with_row_text(gold))
    for row in scored.collect():
        assert row.label == ("Above_3" if row.oracle_id.startswith("d") else "Below_3")
        assert 0.5 < row.score <= 1.0


def test_evaluate_without_rows(learned):
    model, gold = learned
    metrics = evaluate(model, training_set(gold).filter("price = 7"))
    assert metrics["eval_rows"] == 0 and "eval_loss" not in metrics


def test_any_scorer(spark, rows):
    loads = spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)
        return lambda texts: [[] if t is None else [{"label": t.upper(), "score": len(t) / 2}] for t in texts]

    df = spark.createDataFrame([("ab",), ("c",), (None,)], "t string").coalesce(1)
    scored = unpack_results(score_with(df, "t", load))
    assert rows(scored) == [
        {"t": "ab", "label": "AB", "score": 1.0},
        {"t": "c", "label": "C", "score": 0.5},
        {"t": None, "label": None, "score": None},
    ]
    assert loads.value == 1


def test_scorer_of_single_texts(spark):
    df = spark.createDataFrame([("ab",), ("c",)], "t string")
    load = each_text(lambda: lambda text: [{"label": text, "score": 1.0}])
    assert {r.label for r in unpack_results(score_with(df, "t", load)).collect()} == {"ab", "c"}


def test_results_are_strings(spark):
    df = spark.sql("select 1 oracle_id, 'n' name, 'i' image_link, 'L' label, 0.85D score, '2' price, 'x' other")
    results = select_results(df)
    assert tuple(results.first()) == ("1", "n", "i", "L", "0.85", "2")
    assert {t for _, t in results.dtypes} == {"string"}


def test_results_of_scorers_stay_in_arrow(spark, monkeypatch):
    """results become columns once, not by way of pandas objects."""
    monkeypatch.setattr(F, "pandas_udf", None)
    load = each_text(lambda: lambda text: [] if text is None else [{"label": text, "score": np.float64(len(text))}, {"score": 1}])
    df = spark.createDataFrame([("ab",), (None,), ("",)], "t string")
    got = [tuple(r) for r in unpack_results(score_with(df, "t", load)).select("t", "label", "score").collect()]
    assert sorted(got, key=repr) == sorted([("ab", "ab", 2.0), (None, None, None), ("", "", 0.0)], key=repr)


def test_texts_are_hashed_once_for_a_fit(spark, tmp_path):
    """all passes of a fit read the counts that one pass has written."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    rows = [(f"{'good' if k % 2 else 'bad'} word{k % 5}", k % 2) for k in range(40)]
    df = spark.createDataFrame(rows, "gameplay_text string, price int")
    fit_classifier(df.withColumn("gameplay_text", counted("gameplay_text")), num_features=64, max_iter=3)
    assert seen.value == 40
