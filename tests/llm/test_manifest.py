"""The Merkle manifest against trees built in plain Python."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from facetmill.llm import manifest

FIELDS = ("doc_id", "lang", "text")
SCHEMA = "doc_id long, lang string, text string, at long, path string, n long, grp string"


def _hash(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(row):
    return _hash("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:3]))


def _tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_hash("".join(levels[-1][k : k + 8])) for k in range(0, len(levels[-1]), 8)])
    return levels


def _path(levels, at):
    for level in levels[:-1]:
        first = at // 8 * 8
        yield "".join(level[first:at]), "".join(level[at + 1 : first + 8])
        at //= 8


def _expected(rows):
    """(id, leaf, subroot, root, proof) of every row; ids ascend with null first, equal ones by leaf."""
    groups = {}
    for row in rows:
        groups.setdefault("" if row[1] is None else "=" + row[1], []).append((row[0] is not None, row[0] or 0, _leaf(row), row[0]))
    names = sorted(groups, key=str.encode)
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: r[:3])
        trees[name] = _tree([leaf for _, _, leaf, _ in groups[name]])
    above = _tree([trees[name][-1][0] for name in names])
    out = []
    for k, name in enumerate(names):
        for at, (_, _, leaf, own) in enumerate(groups[name]):
            path = [*_path(trees[name], at), *_path(above, k)]
            out.append((own, leaf, trees[name][-1][0], above[-1][0], "".join(a + b for a, b in path)))
    return sorted(out, key=repr)


def _built(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "p", 2, "g") for r in rows], SCHEMA)
    built = manifest.verified(manifest.build(manifest.leaves_of(docs, FIELDS)))
    held = built.select("id", "leaf", "subroot", "root", manifest.proof(F.col("path")).alias("proof"), "verified").collect()
    assert all(r["verified"] for r in held)
    return sorted((tuple(r)[:5] for r in held), key=repr)


def test_two_rounds_many_groups_and_scattered_ids(spark):
    pick = random.Random(5)
    ids = [pick.randrange(1000, 2**63 - 1) * pick.choice((1, -1)) for _ in range(300)] + list(range(-40, 900)) + [-(2**63), 2**63 - 1]
    rows = [(i, "big" if pick.random() < 0.8 else f"lang {pick.randrange(75)}", f"text {i}") for i in ids]
    rows += [(7, "é", "x"), (8, "z", "y"), (9, None, "z"), (10, "", "")]
    assert sum(r[1] == "big" for r in rows) > manifest.BLOCK
    assert _built(spark, rows) == _expected(rows)


def test_repeated_and_missing_ids(spark, monkeypatch):
    monkeypatch.setattr(manifest, "COPIES", 3)
    rows = [(i, "en", "t") for i in range(20)] + [(5, "en", "t")] * 10 + [(5, "en", f"other {k}") for k in range(40)]
    rows += [(None, "en", "t")] * 4 + [(None, "en", None), (None, None, None), (None, None, None), (64, "en", "t"), (64, "en", "t")]
    assert _built(spark, rows) == _expected(rows)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 512, 513])
def test_sizes_of_a_single_group(spark, n):
    rows = [(i * 3, "en", "text " * (i % 5)) for i in range(n)]
    assert _built(spark, rows) == _expected(rows)


def test_empty_table_has_no_leaves(spark):
    assert _built(spark, []) == []


def test_changed_leaf_does_not_fold_to_the_root(spark):
    docs = spark.createDataFrame([(i, "en", "text", 1, "p", 2, "g") for i in range(30)], SCHEMA)
    built = manifest.build(manifest.leaves_of(docs, FIELDS)).withColumn("found", F.when(F.col("id") == 3, F.sha2(F.lit("x"), 256)).otherwise(F.col("leaf")))
    assert {r["id"] for r in manifest.verified(built, "found").filter("not verified").collect()} == {3}


def test_ids_must_be_whole_numbers(spark):
    with pytest.raises(TypeError):
        manifest.leaves_of(spark.createDataFrame([("a", "en", "t")], "doc_id string, lang string, text string"), FIELDS)
