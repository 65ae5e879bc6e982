from __future__ import annotations

import random
import re

import pytest

from facetmill.llm import components, neardup


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, percent):
    """doc_id -> (n_shingles, component)."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed):
    """Chains and large groups of near copies, a passage many texts share, texts made of it, short ones and copies."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    prose = lambda n: [word() for _ in range(n)]

    def edited(words, n):
        words = list(words)
        for _ in range(n):
            words[r.randrange(len(words))] = word()
        return words

    texts = []
    base = prose(160)
    texts += [edited(base, r.randrange(0, 5)) for _ in range(60)]  # more than a short list holds
    chain = prose(120)
    for _ in range(12):
        chain = edited(chain, 2)
        texts.append(chain)
    passage = prose(70)
    texts += [prose(r.randrange(0, 60)) + passage + prose(r.randrange(0, 60)) for _ in range(50)]
    texts += [passage + prose(r.randrange(1, 6)) for _ in range(30)]
    texts += [prose(r.randrange(1, 9)) for _ in range(20)]
    texts += [prose(40)] * 9
    out = [" ".join(t) for t in texts] + [None, "", "  ", "One", "one", "ONE  two"]
    r.shuffle(out)
    return [(3 * i + 1, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("seed,percent", [(1, 85), (2, 80)])
def test_classes_match_brute_force(spark, seed, percent):
    rows = corpus(seed)
    out = neardup.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == brute(rows, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)
    assert len(out) == len(rows)


def test_long_lists_lose_no_link(spark, monkeypatch):
    """With lists that count as long from five rows on, and stars that lead nowhere, the last comparison finds every link."""
    monkeypatch.setattr(neardup, "LIST_ROWS", 4)
    monkeypatch.setattr(neardup, "_starred", lambda rows, percent: rows.select(rows.doc.alias("a"), rows.doc.alias("b")).limit(0))
    rows = corpus(3)
    out = neardup.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string"), percent=85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == brute(rows, 85)


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {x["node"]: x["component"] for x in components.connect(spark.createDataFrame(edges, "a long, b long")).collect()}
    moved = {i for a, b in edges if a != b for i in (a, b)}
    assert got == {i: root(i) for i in moved}
    assert components.connect(spark.createDataFrame([], "a long, b long")).collect() == []


def test_verified_pairs_are_written_before_they_are_connected(spark, monkeypatch):
    """Verifying and contracting are Python steps: in one task they are two workers for each core."""
    plans, contracted = [], components._contracted

    def seen(edges):
        plans.append(edges._jdf.queryExecution().toString())
        return contracted(edges)

    monkeypatch.setattr(components, "_contracted", seen)
    texts = [" ".join(f"w{k}x{n}" for n in range(40)) + f" end{copy}" for k in range(3) for copy in range(2)]
    got = neardup.near_duplicate_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 4}
    assert plans and not any("MapInArrow" in plan for plan in plans)
