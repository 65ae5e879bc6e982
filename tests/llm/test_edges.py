"""Nulls, empty and very long texts, repeated rows, empty tables and clashing extra columns, for every operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from facetmill.llm import bpe, decontamination, extraction, fingerprints, langid, licenses, manifest, neardup, packing, runs, secrets, toxicity, urls

SCHEMA = "doc_id long, text string, lang string, source string, n_words long, score double, kept boolean, digests string, host string"
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards mix potions at night "
LONG = PROSE * 3000
ROWS = [
    (1, None, "en", "s", 7, 0.5, True, "d", "h"),
    (2, "", "en", None, 7, 0.5, None, "d", "h"),
    (3, "...  \n\t !!", None, "s", 7, 0.5, True, "d", "h"),
    (4, PROSE, "en", "s", None, 0.5, True, None, "h"),
    (5, PROSE, "en", "s", 7, None, True, "d", None),
    (5, PROSE, "en", "s", 7, None, True, "d", None),
    (6, LONG, "de", "s", 7, 0.5, True, "d", "h"),
    (None, "a text without a number", "de", "s", 7, 0.5, True, "d", "h"),
    (8, "été 日本 ÀÉ \U0001f600 x", None, "s", 7, 0.5, True, "d", "h"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, PROSE), (2, None), (3, ""), (None, "potions at night"), (5, "wizards")], "item_id long, text string")


def _cost():
    import numpy as np

    return toxicity.costs(np.ones(toxicity.CHARS**3, np.int64))


def _operators(spark, benchmark):
    field = langid.Field(["de", "en"]).fit([PROSE, "der schnelle braune fuchs springt"], ["en", "de"])
    scorer = toxicity.Scorer(_cost(), 0.1, {"wizards": 0.9})
    weights = [0.0] * urls.BUCKETS + [-1.0]
    return {
        "scan_documents": lambda d: decontamination.scan_documents(d, benchmark),
        "identify": lambda d: langid.identify(d, field),
        "secrets": secrets.scan,
        "redact": secrets.redact,
        "toxicity": lambda d: toxicity.score(d, scorer),
        "licenses": licenses.scan,
        "fingerprint": fingerprints.fingerprint,
        "extract": lambda d: extraction.extract(d, html="text"),
        "urls": lambda d: urls.judge(d.withColumnRenamed("text", "url"), weights),
        "cut": lambda d: decontamination.cut_contaminated(d, benchmark),
        "encode": bpe.encode,
        "decode": lambda d: bpe.decode(bpe.encode(d)),
        "collapse_runs": runs.collapse_runs,
    }


NAMES = ["scan_documents", "identify", "secrets", "redact", "toxicity", "licenses", "fingerprint", "extract", "urls", "cut", "encode", "decode", "collapse_runs"]


@pytest.mark.parametrize("name", NAMES)
def test_rows_and_columns_survive(spark, docs, empty, benchmark, name):
    operator = _operators(spark, benchmark)[name]
    out = operator(docs)
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    rows = out.collect()
    assert len(rows) == len(ROWS)
    assert operator(empty).collect() == []
    # Repeated rows get equal results.
    twice = [r for r in rows if r["doc_id"] == 5]
    assert len(twice) == 2 and twice[0] == twice[1]
    # Extra columns pass through unless an added one has their name.
    assert {r["source"] for r in rows} == {"s", None}


def test_filters_keep_columns(spark, docs, empty, benchmark):
    field = langid.Field(["de", "en"]).fit([PROSE, "der schnelle braune fuchs springt"], ["en", "de"])
    clean = decontamination.drop_contaminated(docs, benchmark)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect() if r["doc_id"]) == [1, 2, 3, 8]
    kept = langid.keep_identified(docs, field)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 4, 5, 5, 6, 8]
    one = neardup.drop_duplicates(docs)
    assert one.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in one.collect()) == [0, 1, 2, 3, 4, 6, 8]
    for f in (lambda d: decontamination.drop_contaminated(d, benchmark), lambda d: langid.keep_identified(d, field), neardup.drop_duplicates):
        assert f(empty).collect() == []


def test_values_of_odd_texts(spark, docs, benchmark):
    hits = {r["doc_id"]: r for r in decontamination.scan_documents(docs, benchmark).collect()}
    assert hits[1]["n_words"] == 0 and hits[2]["hit_spans"] == [] and hits[4]["hit_spans"] == [0, 16]
    assert hits[4]["hit_items"] == ["1", "5"]
    classes = {r["doc_id"]: r for r in neardup.near_duplicate_classes(docs).collect()}
    assert classes[1]["n_shingles"] == 0 and classes[2]["component_id"] == 2 and classes[3]["n_shingles"] == 1
    assert classes[5]["component_id"] == 4 and not classes[5]["kept"] and classes[None]["kept"]
    found = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert found[1]["n_words"] == 0 and found[1]["labels"] == [] and found[1]["score"] == 0.0
    prints = {r["doc_id"]: r for r in fingerprints.fingerprint(docs).collect()}
    assert prints[1]["fingerprint"] == prints[2]["fingerprint"] and prints[4]["fingerprint"] == prints[5]["fingerprint"]


def test_manifest_of_odd_rows(spark, docs, empty):
    fields = ("doc_id", "text", "lang", "source", "n_words", "score", "kept", "digests", "host")
    built = manifest.verified(manifest.build(manifest.leaves_of(docs, fields))).collect()
    assert len(built) == len(ROWS) and all(r["verified"] for r in built)
    assert len({r["root"] for r in built}) == 1 and len({r["subroot"] for r in built}) == 3
    assert manifest.build(manifest.leaves_of(empty, fields)).collect() == []


def test_packing_of_odd_texts(spark, docs, empty):
    pieces = packing.pack_documents(docs)
    rows = pieces.collect()
    assert sum(r["length"] for r in rows if r["doc_id"] in (1, 2)) == 2
    assert {r["doc_id"] for r in rows} == {r[0] for r in ROWS}
    taken = {}
    for r in rows:
        taken.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in taken.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= packing.SIZE
    assert packing.pack_documents(empty).collect() == []


def test_training_without_rows(spark, empty):
    field = langid.train(empty.select("doc_id", "text", "lang"))
    assert field.labels == []
    scorer = toxicity.learn(empty, empty.select("doc_id", F.lit(1).alias("toxic")), _cost())
    assert scorer.score("anything") == 0.0
    counts, total = licenses.word_counts(empty)
    assert (counts, total) == ({}, 0)
