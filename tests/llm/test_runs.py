"""Periodic runs against a search over all periods and places."""

from __future__ import annotations

import random

import numpy as np
import pytest

from facetmill.llm import queries, runs


def _brute(words):
    """All maximal runs, from the definition."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            stretch = words[i : i + length]
            if length >= max(6, 4 * q) and not any(stretch[d:] == stretch[: length - d] for d in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def _words(pick):
    """Words with planted repeats of all kinds of periods, some of them broken."""
    letters, out = pick.choice([1, 2, 3, 5, 60]), []
    for _ in range(pick.randint(1, 6)):
        if pick.random() < 0.4:
            out += [pick.randrange(letters) for _ in range(pick.randrange(30))]
            continue
        period = [pick.randrange(letters) for _ in range(pick.choice([1, 2, 5, 8, 9, 10, 13, 14, 15, 23, 24, 36, 37, 56, 57, 70]))]
        if pick.random() < 0.3:
            period = period * pick.randint(2, 4) + [pick.randrange(letters)]
        part = period * pick.choice([3, 4, 4, 4, 5, 9])
        part = part[: len(part) - pick.randint(0, len(period))]
        if part and pick.random() < 0.2:
            part[pick.randrange(len(part))] = 99
        out += part
    return [b"w%d" % x for x in out]


def _found(texts):
    at = np.cumsum([0, *map(len, texts)])
    start, end, period = runs.find_runs(runs._numbered(texts), at)
    row = np.searchsorted(at, start, "right") - 1
    out = [[] for _ in texts]
    for a, b, q, r in zip(start, end, period, row):
        out[r].append((int(a - at[r]), int(b - a), int(q)))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_several_texts(seed):
    pick = random.Random(seed)
    for _ in range(25):
        texts = [_words(pick) for _ in range(pick.randint(1, 6))]
        assert _found(texts) == [_brute(t) for t in texts]


@pytest.mark.parametrize("period", [1, 8, 9, 100, 631, 2500])
def test_exactly_four_periods_in_noise(period):
    """The shortest run of a period, at the start, in the middle and at the end."""
    pick = random.Random(period)
    noise = lambda n: [b"n%d" % pick.randrange(10**9) for _ in range(n)]
    repeated = noise(period) * 4 if period > 1 else noise(1) * 6
    for before, after in ((0, 0), (0, 777), (1234, 0), (777, 1234)):
        assert _found([noise(before) + repeated + noise(after)]) == [[(before, len(repeated), period)]]
    short = (noise(period) * 4)[:-1] if period > 1 else noise(1) * 5
    assert _found([noise(50) + short + noise(50)]) == [[]]


def test_scales_leave_no_period_out():
    served = [q for low, k in runs.scales(100_000) for q in range(low, k + 1)]
    assert served[: 25_000 - runs.SHORT] == list(range(runs.SHORT + 1, 25_001))
    assert all(3 * low + 1 >= 2 * k for low, k in runs.scales(100_000))


def test_collapsed_texts_and_edges(spark):
    texts = [None, "", " \n", "a", "x " * 7, "a b c d e f g h i j " * 5, "one two one two one two one two three", "p q " * 3, "k " * 6 + "l " * 6]
    docs = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, collapsed string")
    got = {r["doc_id"]: ([tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.collapse_runs(docs).collect()}
    assert got == {
        0: ([], ""),
        1: ([], ""),
        2: ([], ""),
        3: ([], "a"),
        4: ([(0, 7, 1)], "x"),
        5: ([(0, 50, 10)], "a b c d e f g h i j"),
        6: ([(0, 8, 2)], "one two three"),
        7: ([], "p q p q p q"),
        8: ([(0, 6, 1), (6, 6, 1)], "k l"),
    }


def test_words_are_cut_at_ascii_space_only(spark):
    text = "a a a a a\x1ca a\x0ba\x0ca\ta\na\ra"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = runs.collapse_runs(docs).first()
    assert [tuple(x) for x in row["runs"]] == [(3, 6, 1)]
    assert row["collapsed"] == "a a a a a\x1ca a"


def test_query_plants_and_digests(spark, tmp_path):
    """The whole query against its definition in plain Python."""
    import hashlib
    import zlib

    pick = random.Random(3)
    rows = [(i, " ".join(f"w{pick.randrange(40)}" for _ in range(pick.randrange(0, 300)))) for i in range(60)] + [(None, "a b"), (61, None)]
    rows += [(i, "x") for i in range(100, 130)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op13_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    sha, expected, planted = lambda s: hashlib.sha256(s.encode()).hexdigest(), [], 0
    for doc_id, text in rows:
        words = (text or "").split()
        n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words, planted = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)], planted + 1
        own = _brute(words)
        dropped = {i for s, length, q in own for i in range(s + q, s + length)}
        best = min(((-length, s, q) for s, length, q in own), default=None)
        first = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in own)
        expected.append((doc_id, len(own), *first, sha(listed), sha(" ".join(w for i, w in enumerate(words) if i not in dropped))))
    assert planted > 5
    assert got == sorted(expected, key=repr)
