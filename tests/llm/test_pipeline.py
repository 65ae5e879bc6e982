"""The pipeline stage by stage on a small corpus, against plain Python; the queries against their SQL and contracts."""

from __future__ import annotations

import os
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from compare import connect, difference
from facetmill.llm import decontamination, neardup, packing, secrets
from facetmill.llm.oracles import ORACLE_SQL
from facetmill.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _corpus():
    r = random.Random(11)
    kinds = {"x": ["ka", "lo", "mi"], "y": ["sch", "ung", "eit"]}
    prose = lambda k, n: " ".join("".join(r.choice(kinds[k]) for _ in range(4)) for _ in range(n))
    rows = [(i, prose(k, r.randrange(20, 60)), k) for i, k in enumerate("xy" * 30)]
    rows += [(100, rows[0][1] + " tail", "x"), (101, rows[0][1], "x"), (102, None, "x"), (103, "", "y"), (104, "123 456 --", "y")]
    passage = prose("x", 14)
    rows += [(105, prose("x", 30) + " " + passage + " " + prose("x", 30), "x"), (106, prose("y", 40) + ' token = "0123456789abcdef0123456789abcdef" ' + prose("y", 5), None)]
    docs = [(i, t, k, "s", None if t is None else len(t)) for i, t, k in rows]
    return docs, [(1, passage), (2, prose("y", 12))]


def test_stages_keep_and_drop_what_they_should(spark, tmp_path):
    docs, items = _corpus()
    sf_dir = str(tmp_path)
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        frame = stage(spark, frame, sf_dir)
        frame.write.parquet(out := f"{sf_dir}/out-{k}")
        frame = spark.read.parquet(out)
        seen.append((name, {r["doc_id"] for r in frame.collect()}))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert frame.schema.names == spark.read.parquet(f"{sf_dir}/documents.parquet").schema.names
    everyone = {d[0] for d in docs}
    want = everyone - {102, 103, 104}
    assert seen[0] == ("language_id", want)
    want -= {100, 101}
    assert seen[1] == ("near_dedup", want)
    want -= {105}
    assert seen[2] == ("decontamination", want)
    assert seen[3] == ("secrets", want) and seen[4] == ("packing", want)
    kept = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/out-3").collect()}
    texts = {d[0]: d[1] for d in docs}
    assert kept[106]["text"] == re.sub(r'"[0-9a-f]+"', f'"{secrets.PLACEHOLDER}"', texts[106])
    assert kept[106]["n_chars"] == len(kept[106]["text"])
    assert all(kept[i]["text"] == texts[i] for i in want - {106})
    run = corpus_pipeline.run(spark, sf_dir).collect()
    path = packing.tokenizer_path()
    got = {(r["doc_id"], r["piece"]): (r["length"], r["ids_crc32"]) for r in run}
    for i, r in kept.items():
        ids = np.append(packing.encode(path, r["text"]), np.uint32(packing.END_ID)).astype("<u4")
        assert got[i, 0] == (len(ids), zlib.crc32(ids.tobytes()))
    assert len(got) == len(kept)


def test_stages_hand_on_columns_that_are_named_like_their_own(spark, tmp_path):
    """Extra columns with the names that operators add, repeated rows, nulls in every column."""
    docs, items = _corpus()
    extra = ["hit_spans", "hit_items", "n_words", "lang_pred", "score", "spans", "kept", "component_id", "n_shingles", "__row"]
    rows = [(*d, *[f"{name} {d[0]}" for name in extra]) for d in [*docs, docs[5]]]
    rows.append((None, docs[7][1] + " own end", None, None, None, *[None] * len(extra)))
    frame = spark.createDataFrame(rows, f"{SCHEMA}, " + ", ".join(f"{name} string" for name in extra))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = frame.columns
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == before
        frame.write.parquet(out := f"{tmp_path}/out-{k}")
        frame = spark.read.parquet(out)
    left = frame.collect()
    assert sum(r["doc_id"] == docs[5][0] for r in left) == 1
    assert all(r[name] == f"{name} {r['doc_id']}" for r in left if r["doc_id"] is not None for name in extra)
    assert {r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path)).collect()} == {r["doc_id"] for r in left}


def test_pipeline_over_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_one_document_of_each_group_stays(spark):
    docs = [(3, "a b c d e f g"), (1, "a b c d e f g"), (2, "other words here all the way"), (2, "other words here all the way"), (None, "x y z")]
    kept = neardup.drop_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] or 0 for r in kept) == [0, 1, 2]


def test_a_long_benchmark_takes_several_passes(spark):
    docs = spark.createDataFrame([(i, f"w{i} a b c d e f g h i j") for i in range(20)], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"w{i} a b c d e f g h i") for i in range(0, 20, 2)], "item_id long, text string")
    one = decontamination.scan_documents(docs, items).collect()
    many = decontamination.scan_documents(docs, items, block_bytes=150).collect()
    key = lambda r: r["doc_id"]
    assert sorted(one, key=key) == sorted(many, key=key)
    assert sum(bool(r["hit_items"]) for r in one) == 10


@tables
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    only_spark, only_sql, count = difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE_SQL[name])
    assert not only_spark and not only_sql and count > 0


COLUMNS = {
    "op2_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op3_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op4_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op5_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op6_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op7_document_fingerprint": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op8_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op10_html_extraction": ["page_id", "url", "text", "n_chars"],
}


@tables
@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_has_its_columns_for_every_row(spark, name):
    out = QUERIES[name](spark, SF_DIR)
    assert out.columns[: len(COLUMNS[name])] == COLUMNS[name]
    source, key = ("pages", "page_id") if "page_id" in COLUMNS[name] else ("documents", "doc_id")
    ids = [r[key] for r in out.select(key).collect()]
    all_ids = {r[key] for r in spark.read.parquet(f"{SF_DIR}/{source}.parquet").select(key).collect()}
    assert set(ids) == all_ids and (name == "op3_best_fit_packing" or len(ids) == len(all_ids))


@tables
def test_held_out_languages_are_predicted(spark):
    found = QUERIES["op8_language_id"](spark, SF_DIR).filter("held_out").join(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in found) / len(found) > 0.95


@tables
def test_edited_texts_are_near_and_next_ones_are_not(spark):
    import hashlib

    rows = {r["doc_id"]: r for r in QUERIES["op7_document_fingerprint"](spark, SF_DIR).collect()}
    texts = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    for (i, text), (_, after) in zip(texts, texts[1:] + texts[:1]):
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and rows[i]["n_chars"] == len(text)
    near = [r["near_edited"] for r in rows.values()]
    other = [r["near_next"] for r in rows.values()]
    assert sum(near) / len(near) > 0.5 > 0.1 > sum(other) / len(other)
