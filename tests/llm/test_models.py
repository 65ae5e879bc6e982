"""Language field, toxicity channel, fingerprints and packing against plain Python."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa

from facetmill.llm import fingerprints, langid, packing, toxicity
from facetmill.llm.batches import ALPHANUMERIC, SPACED, Words


def test_words_match_patterns():
    r = random.Random(1)
    texts = ["".join(r.choice("aB9 \t\n\x0b.é日-_") for _ in range(r.randrange(0, 40))) for _ in range(300)] + ["", None]
    for member, pattern in ((SPACED, r"[^\x20\x09-\x0D]+"), (ALPHANUMERIC, "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")):
        got = Words(pa.array(texts, pa.string()), member)
        want = [re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
        assert got.counts.tolist() == [len(w) for w in want]
        flat = [w for own in want for w in own]
        assert [got.text(i, 1).decode() for i in range(len(flat))] == flat
        known = {}
        for w, h in zip(flat, got.hashes.tolist()):
            assert known.setdefault(w, h) == h
        assert len(set(known.values())) == len(known)


def test_marginals_match_plain_forward_backward():
    rng = np.random.default_rng(1)
    field = langid.Field(["a", "b", "c"])
    field.transition = rng.normal(size=(3, 3))
    counts = np.array([3 * langid.SEGMENT + 5, 3, 0, 1, langid.SEGMENT])
    scores = rng.normal(size=(counts.sum(), 3))
    got, expected = field.marginals(scores, counts)
    move, at, sums = np.exp(field.transition), 0, np.zeros((3, 3))
    for n in counts:
        f = np.exp(scores[at : at + n])
        if n:
            a, b = np.zeros((n, 3)), np.ones((n, 3))
            a[0] = f[0] / f[0].sum()
            for i in range(1, n):
                a[i] = (a[i - 1] @ move) * f[i]
                a[i] /= a[i].sum()
            for i in range(n - 2, -1, -1):
                b[i] = move @ (f[i + 1] * b[i + 1])
                b[i] /= b[i].sum()
            for i in range(1, n):
                joint = a[i - 1][:, None] * move * (f[i] * b[i])
                sums += joint / joint.sum()
            both = a * b
            np.testing.assert_allclose(got[at : at + n], both / both.sum(1, keepdims=True), atol=1e-9)
        at += n
    np.testing.assert_allclose(expected, sums, atol=1e-6)


def test_code_switched_words_are_labelled_apart():
    en, de = "the house and the garden were quiet that evening", "das haus und der garten waren an diesem abend still"
    field = langid.Field(["de", "en"]).fit([en] * 3 + [de] * 3, ["en"] * 3 + ["de"] * 3)
    words = Words(pa.array([f"{en} {de}"]), ALPHANUMERIC)
    scores, which, _ = field.emissions(words)
    marginal, _ = field.marginals(scores[which], words.counts)
    best = marginal.argmax(1).tolist()
    assert best[:7] == [1] * 7 and best[-7:] == [0] * 7


def test_training_is_bounded_and_accurate(spark):
    r = random.Random(2)
    kinds = {"x": ["ka", "lo", "mi"], "y": ["sch", "ung", "eit"], "z": ["ción", "ado", "que"]}
    rows = [(i, " ".join("".join(r.choice(kinds[k]) for _ in range(3)) for _ in range(20)), k) for i, k in enumerate(r.choices("xyz", [8, 1, 1], k=600))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    field = langid.train(docs, sample_rows=30)
    out = langid.identify(docs, field).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in out) / len(out) > 0.98


def test_viterbi_restores_words(spark):
    text = "you idiot what a moron and a loser this is pathetic and stupid " * 20
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    counts = toxicity.trigram_counts(docs)
    codes = [0, *(toxicity._code(c) for c in text), 0]
    want = np.zeros_like(counts)
    for k in zip(codes, codes[1:], codes[2:]):
        want[(k[0] * toxicity.CHARS + k[1]) * toxicity.CHARS + k[2]] += 1
    inner = counts.copy()
    inner[want > 0] -= want[want > 0]
    assert inner.sum() <= 6  # windows of breaks at the ends
    cost = toxicity.costs(counts)
    for written, word in [("1d10t", "idiot"), ("i d i o t", "idiot"), ("m.0.r.0.n", "moron"), ("looooser", "loser"), ("p4th3t1c", "pathetic"), ("$tup1d", "stupid")]:
        assert toxicity.decode(written, cost) == word
    scorer = toxicity.Scorer(cost, 0.1, {"idiot": 0.95})
    assert scorer.score("such an 1d10t!") == 0.95 and scorer.score("i d i o t") == 0.95 and scorer.score("all fine") == 0.1 and scorer.score(None) == 0.1


def test_toxic_words_are_learned(spark):
    r = random.Random(4)
    base = ["ka", "lo", "mi", "ne", "su", "ta"]
    rows = []
    for i in range(900):
        toxic = i % 6 == 0
        w = ["".join(r.choice(base) for _ in range(3)) for _ in range(30)] + (["zzgrr"] if toxic else [])
        r.shuffle(w)
        rows.append((i, " ".join(w), int(toxic)))
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scorer = toxicity.learn(labelled, labelled, toxicity.costs(toxicity.trigram_counts(labelled)))
    scores = [(scorer.score(t), y) for _, t, y in rows]
    assert min(s for s, y in scores if y) >= 0.7 > max(s for s, y in scores if not y)


def test_differences_are_recovered(spark):
    r = random.Random(6)
    cases = []
    for n in (0, 1, 3, 20, 90, 300):
        for cut in (0.0, 0.3, 1.0):
            a = [f"line {r.random()}" for _ in range(n)]
            b = [f"other {r.random()}" if r.random() < cut else x for x in a] + ([f"new {n}"] if n % 2 else [])
            cases.append((len(cases), "\n".join(a), "\n".join(b)))
    frame = spark.createDataFrame(cases, "id long, a string, b string")
    frame = frame.select("id", "a", "b", fingerprints.digests(frame.a).alias("x"), fingerprints.digests(frame.b).alias("y"))
    out = frame.select("id", "a", "b", "x", "y", fingerprints.difference(frame.x, frame.y).alias("d"), fingerprints.likeness(frame.x, frame.y).alias("near")).collect()
    for row in out:
        x, y = set(row["x"]), set(row["y"])
        assert {(d["digest"], d["side"]) for d in row["d"]} == {(k, 1) for k in x - y} | {(k, -1) for k in y - x}
        a, b = set(row["a"].split("\n")) - {""}, set(row["b"].split("\n")) - {""}
        assert abs(row["near"] - (1 - len(a ^ b) / (len(a) + len(b)) if a or b else 1.0)) < 1e-9


def test_long_lines_of_any_script_stay_alike(spark):
    """Most of a text is kept: a changed end, some changed characters, words without any sentence."""
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghijklmnoprstu") for _ in range(r.randint(2, 9)))
    line = " ".join(word() for _ in range(140))[:787]
    chinese = "".join(chr(r.randrange(0x4E00, 0x5400)) + ("。" if r.random() < 0.03 else "") for _ in range(3000))
    changed = list(chinese)
    for k in r.sample(range(3000), 10):
        changed[k] = "x"
    unparted = "".join(chr(r.randrange(0x0E01, 0x0E2E)) for _ in range(2000))
    pairs = [(line, line[:590] + " " + " ".join(word() for _ in range(35))), (chinese, "".join(changed)), (unparted, unparted[:1500] + unparted[:500]), (line, " ".join(word() for _ in range(140)))]
    frame = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "id long, a string, b string")
    frame = frame.select("id", fingerprints.digests(frame.a).alias("x"), fingerprints.digests(frame.b).alias("y"))
    near = {x["id"]: x["near"] for x in frame.select("id", fingerprints.likeness(frame.x, frame.y).alias("near")).collect()}
    assert near[0] > 0.3 and near[1] > 0.8 and near[2] > 0.5 and near[3] == 0


def test_many_lines_and_texts_of_different_length(spark):
    """Thousands of classes, and sketches of 4,096 classes against those of one."""
    lines = [f"line {k}" for k in range(30_000)]
    cases = [("\n".join(lines), "\n".join(lines[:22_500] + ["x"])), ("\n".join(lines), "\n".join(lines[:5])), ("\n".join(lines[:40]), "\n".join(lines[20:3000]))]
    frame = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "id long, a string, b string")
    frame = frame.select("id", "a", "b", fingerprints.digests(frame.a).alias("x"), fingerprints.digests(frame.b).alias("y"))
    for row in frame.select("*", fingerprints.likeness(frame.x, frame.y).alias("near")).collect():
        a, b = set(row["a"].split("\n")), set(row["b"].split("\n"))
        assert abs(row["near"] - (1 - len(a ^ b) / (len(a) + len(b)))) < 1e-12


def test_next_keys(spark):
    ids = random.Random(7).sample(range(10**6), 500)
    got = {r["doc_id"]: r["next"] for r in fingerprints.with_next(spark.createDataFrame([(i,) for i in [*ids, None, ids[0]]], "doc_id long")).collect()}
    order = sorted(ids)
    assert got == dict(zip(order, order[1:] + order[:1]))


def test_plans_use_every_piece_once_and_fill_well():
    rng = np.random.default_rng(3)
    for size, lengths in ((1024, rng.integers(1, 1025, 20_000)), (64, rng.integers(1, 65, 500)), (64, np.full(50, 40)), (64, np.zeros(0, int))):
        counts = np.bincount(lengths, minlength=size + 1)
        plan = packing.plan_packing(counts, size)
        used = np.zeros(size + 1, int)
        for pattern, repeats in plan:
            assert sum(pattern) <= size and repeats > 0
            for n in pattern:
                used[n] += repeats
        assert (used == counts).all()
        total = sum(r for _, r in plan)
        assert total >= -(-int((counts * np.arange(size + 1)).sum()) // size)
        assert total <= sum(r for _, r in packing.best_fit(counts, size)) * 1.002 + 1


def test_lengths_that_fit_exactly_waste_nothing():
    counts = np.zeros(101, int)
    for a in range(20, 50):
        counts[a] += 7
        counts[100 - a] += 7
    assert sum(r for _, r in packing.plan_packing(counts, 100)) == 7 * 30


def test_fast_ids_equal_the_tokenizer():
    path = packing.tokenizer_path()
    exact = packing._exact(path)
    r = random.Random(8)
    texts = ["".join(r.choice("ab Zé日\n\t'0\u00a0\u2028.<|endoftext|>") for _ in range(200)) for _ in range(50)] + ["<|endoftext|> x", "", " " * 3000, "a" * 3000]
    for t in texts:
        assert packing.encode(path, t).tolist() == exact.encode(t, add_special_tokens=False).ids


def test_packed_ids_give_back_the_documents(spark):
    r = random.Random(9)
    rows = [(i, " ".join(r.choice(["alpha", "beta", "naïve", "x"]) for _ in range(r.randrange(0, 400)))) for i in range(60)]
    out = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), size=128).collect()
    exact = packing._exact(packing.tokenizer_path())
    for i, text in rows:
        own = sorted((p for p in out if p["doc_id"] == i), key=lambda p: p["piece"])
        ids = [x for p in own for x in np.frombuffer(p["ids"], "<u4").tolist()]
        assert ids == exact.encode(text, add_special_tokens=False).ids + [packing.END_ID]
        assert [p["start"] for p in own] == np.cumsum([0] + [p["length"] for p in own[:-1]]).tolist()
        assert all(p["length"] == 128 for p in own[1:])
    fill = {}
    for p in out:
        fill.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for own in fill.values():
        own.sort()
        assert own[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:])) and own[-1][0] + own[-1][1] <= 128


def _labels(field, texts):
    return field.label(pa.array(texts, pa.string()))[0].to_pylist()


def test_inner_parts_of_long_words_are_read():
    r = random.Random(5)
    kinds = {"x": ["ka", "lo", "mi", "ru"], "y": ["sch", "ung", "eit", "ftp"]}
    make = lambda k: "donaudampfsch" + "".join(r.choice(kinds[k]) for _ in range(5)) + "kapitan"
    known = [(make(k), k) for k in "xy" * 40]
    field = langid.Field(["x", "y"]).fit([t for t, _ in known], [k for _, k in known])
    new = [(make(k), k) for k in "xy" * 20]
    assert _labels(field, [t for t, _ in new]) == [k for _, k in new]


def test_scripts_without_spaces_have_a_place_for_each_character():
    text = "日本語のテキスト、ok ภาษาไทย 𠀀𠀁 déjà"
    got = langid.words_of(pa.array([text, None, "語"]))
    assert [got.text(i, 1).decode() for i in range(len(got.starts))] == [*"日本語のテキスト、", "ok", *"ภาษาไทย", *"𠀀𠀁", "déjà", "語"]
    r = random.Random(6)
    kinds = {"ja": "のはがをにとたてしい日本語学校", "zh": "的是了在有不这个们说中国语学校"}
    make = lambda k: "学校" + "".join(r.choice(kinds[k]) for _ in range(40)) + "学校"
    known = [(make(k), k) for k in ("ja", "zh") * 20]
    field = langid.Field(["ja", "zh"]).fit([t for t, _ in known], [k for _, k in known])
    new = [(make(k), k) for k in ("ja", "zh") * 20]
    assert _labels(field, [t for t, _ in new]) == [k for _, k in new]


def test_no_language_is_out_of_reach(spark):
    names = [chr(97 + k // 10) * 3 + "bcdfghjklm"[k % 10] for k in range(80)]
    rows = [(f"{w}a {w}o {w}ei {w}un", f"l{k:02}") for k, w in enumerate(names) for _ in range(2 if k < 70 else 1)]
    field = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    assert _labels(field, [t for t, _ in rows]) == [k for _, k in rows]
