"""Toxicity scores over text restored from obfuscation by a noisy channel.

A character language model (trigram counts over every document) is the source; the
channel writes letters as look-alike digits and signs, puts separators between
them and repeats them. Each suspicious token is a lattice of what each of its
characters can stand for, and Viterbi decoding finds the most likely word. Texts
are scored on their words and the restored ones.

What marks a toxic text is learned from a bounded sample of labelled texts, at most
``SAMPLE_ROWS`` of each label: words and word beginnings whose counts differ
between the labels beyond chance over all features tried. A feature's weight is
the share of toxic texts among those that have it, less its error; a text's score is
its largest weight, or the overall share.

Defined cases: null and empty texts, and those without words, score the overall
share; without labelled rows every score is 0; of equally likely readings of a token
one is taken, the same for all rows; repeated rows get equal results; a table without
rows gives none;
extra columns pass through, and input columns named like an added one are replaced.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetmill.session import materialise

from .batches import add_columns, column, slices, utf8

SAMPLE_ROWS = 4_000
PREFIXES = (4, 5, 6, 7)
# Rows that a feature counts as having of the overall share.
SHRINK = 1.0
# Standard errors taken off a feature's share.
ERRORS = 2.0
# Weight from which a word stands for itself; less certain ones count by their beginnings.
KNOWN = 0.8

ADDED = T.StructType([T.StructField("toxicity", T.DoubleType())])

# Characters of the language model: a-z, other letters as one, and all else as a break.
CHARS = 28
_OTHER = 27
_CODE = np.array([b - 96 if 97 <= b <= 122 else b - 64 if 65 <= b <= 90 else _OTHER if b >= 128 else 0 for b in range(256)], np.int64)

# What a sign can stand for.
_LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i",
    "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "€": "e", "£": "l", "¡": "i", "§": "s",
}
_SEPARATORS = frozenset(" .-_*~^'`,/\\=#:;%&")
_LOOK_COST, _BREAK_COST, _SKIP_COST, _REPEAT_COST = 0.7, 8.0, 0.3, 1.5

_WORD = re.compile(r"[^\W\d_]+")
_SPACED = re.compile(r"(?<!\S)(?:\S ){2,}\S(?!\S)")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_EDGE = " .,;:!?\"'()[]{}<>*#%&$-_~"


def _code(letter: str) -> int:
    return ord(letter) - 96 if "a" <= letter <= "z" else _OTHER if letter.isalpha() else 0


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """How often each three characters of the model follow each other in all texts."""
    schema = "gram int, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CHARS**3, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = utf8(part.column("text"))
                # A break before and after each text.
                codes = np.zeros(len(data) + 2 * len(offsets), np.int64)
                codes[np.arange(len(data)) + 2 * np.repeat(np.arange(1, len(offsets)), np.diff(offsets))] = _CODE[data]
                if len(codes) > 2:
                    total += np.bincount((codes[:-2] * CHARS + codes[1:-1]) * CHARS + codes[2:], minlength=CHARS**3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["gram", "n"])

    out = np.zeros(CHARS**3, np.int64)
    for r in docs.select(column("text")).mapInArrow(count, schema).groupBy("gram").agg(F.sum("n").alias("n")).collect():
        out[r["gram"]] = r["n"]
    return out


def costs(counts: np.ndarray) -> list[list[list[float]]]:
    """-log P(third | first two), smoothed by shorter contexts."""
    three = counts.reshape(CHARS, CHARS, CHARS).astype(float)
    one = (three.sum((0, 1)) + 1) / (three.sum() + CHARS)
    two = (three.sum(0) + 10 * one) / (three.sum((0, 2))[:, None] + 10)
    full = (three + 10 * two) / (three.sum(2, keepdims=True) + 10)
    return (-np.log(full)).tolist()


def decode(token: str, cost: list[list[list[float]]]) -> str:
    """The most likely word, or words, that the channel wrote as ``token``."""
    # By the last two characters: cost, and what was written as (all before, last).
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    before = ""
    for ch in token.lower():
        if ch.isalpha():
            options = [(ch, 0.0)] + ([("", _REPEAT_COST / 3)] if ch == before else [])
        elif ch in _LOOKS:
            options = [(x, _LOOK_COST) for x in _LOOKS[ch]] + [(" ", _BREAK_COST)] + ([("", _SKIP_COST)] if ch == before else [])
        elif ch in _SEPARATORS:
            options = [("", _SKIP_COST), (" ", _BREAK_COST)]
        else:
            options = [(" ", 0.0)]
        new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (c, out) in best.items():
            for x, extra in options:
                if not x:
                    key, total, written = (a, b), c + extra, out
                else:
                    k = _code(x)
                    key, total, written = (b, k), c + extra + cost[a][b][k], (out, x)
                if key not in new or total < new[key][0]:
                    new[key] = total, written
        best, before = new, ch
    (a, b), (_, node) = min(best.items(), key=lambda item: item[1][0] + cost[item[0][0]][item[0][1]][0])
    letters = []
    while node:
        node, x = node
        letters.append(x)
    return "".join(reversed(letters)).strip()


def suspicious(text: str) -> set[str]:
    """Tokens that may hide a word: signs among letters, letters set apart, letters repeated."""
    found = set()
    for token in set(text.split()):
        core = token.strip(_EDGE)
        if core.isalpha():
            if _TRIPLE.search(core):
                found.add(core)
        elif any(map(str.isalpha, core)):
            # A sign at the end is a letter or a mark: both readings are tried.
            found.update((core, token.strip(".,;:?\"'()[]{}<>")))
    if m := [m[0] for m in _SPACED.finditer(text)]:
        found.update(m)
    return found


@dataclass
class Scorer:
    """Language model costs, weights of features and the overall share."""

    cost: list[list[list[float]]]
    share: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self._decoded = functools.lru_cache(1 << 16)(lambda token: tuple(_WORD.findall(decode(token, self.cost))))
        self._words = {f for f in self.weights if not f.endswith("^")}
        self._starts = {n: {f[:-1] for f in self.weights if f.endswith("^") and len(f) == n + 1} for n in PREFIXES}

    def __reduce__(self):
        return Scorer, (self.cost, self.share, self.weights)

    def words(self, text: str) -> set[str]:
        """Words of the text, and those restored from its suspicious tokens."""
        own = set(_WORD.findall(text.lower()))
        for token in suspicious(text):
            own.update(self._decoded(token))
        return own

    def starts(self, words: set[str]) -> set[str]:
        """Beginnings of those words that have no weight themselves."""
        rest = words - self._words
        return {f"{w[:n]}^" for n in PREFIXES for w in rest if len(w) > n}

    def score(self, text: str | None) -> float:
        if not text or not self.weights:
            return self.share
        own = self.words(text)
        found = [self.weights[w] for w in own & self._words]
        rest = own - self._words
        for n, starts in self._starts.items():
            if starts:
                found += [self.weights[f"{s}^"] for s in {w[:n] for w in rest if len(w) > n} & starts]
        return max(found, default=self.share)


def _sampled(labels: DataFrame, sample_rows: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``sample_rows`` rows of each label (0, 1), and how many rows there are of each."""
    rows = labels.filter("toxic in (0, 1) and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1e6
    wanted = F.lit(0.0)
    for label, n in counts.items():
        # A margin below the bound: the draw is by hash, so its size varies a little.
        wanted = F.when(F.col("toxic") == label, F.lit(min(1.0, (sample_rows - 4 * math.sqrt(sample_rows)) / n))).otherwise(wanted)
    return rows.filter(draw < wanted), counts


def learn(docs: DataFrame, labels: DataFrame, cost: list[list[list[float]]], sample_rows: int = SAMPLE_ROWS) -> Scorer:
    """A scorer from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic): words first, then beginnings of all other words."""
    drawn, totals = _sampled(labels, sample_rows)
    if not totals.get(1):
        return Scorer(cost)
    # The draw has a bounded number of short rows, so it is sent to the texts.
    sample = materialise(docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("text", "toxic"), "toxicity-sample")
    share = totals[1] / (totals[1] + totals.get(0, 0))
    by_word = _weights(sample, Scorer(cost), totals, share, starts=False)
    # A beginning must not live off words that are known already.
    known = {w: x for w, x in by_word.items() if x >= KNOWN}
    return Scorer(cost, share, known | _weights(sample, Scorer(cost, share, known), totals, share, starts=True))


def _weights(sample: DataFrame, reader: Scorer, totals: dict[int, int], share: float, starts: bool) -> dict[str, float]:
    """Weights of the words of the sample, or of beginnings of words."""
    shared = sample.sparkSession.sparkContext.broadcast(reader)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Partial counts of one slice of rows: memory follows the slice.
        reader = shared.value
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                seen = (Counter(), Counter())
                for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                    own = reader.words(text or "")
                    seen[toxic].update(reader.starts(own) if starts else own)
                    seen[toxic][""] += 1  # counts the rows
                names = list(seen[0].keys() | seen[1].keys())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), *(pa.array([s[f] for f in names], pa.int64()) for s in seen)], ["feature", "clean", "toxic"]
                )

    counted = sample.mapInArrow(count, "feature string, clean long, toxic long")
    sums = materialise(counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter("clean + toxic >= 3"), "toxicity-features")
    clean_rows, toxic_rows = next(((r["clean"], r["toxic"]) for r in sums.filter("feature = ''").collect()), (0, 0))
    if not toxic_rows:
        return {}
    tried = max(2, sums.count())
    clean, toxic = F.col("clean").cast("double"), F.col("toxic").cast("double")
    rate = (toxic + clean) / (toxic_rows + clean_rows)

    def part(k, n):
        inside = F.when(k > 0, k * F.log(k / n / rate)).otherwise(F.lit(0.0))
        return inside + F.when(k < n, (n - k) * F.log((1 - k / n) / (1 - rate))).otherwise(F.lit(0.0))

    stat = 2 * (part(toxic, float(toxic_rows)) + part(clean, float(max(clean_rows, 1))))
    # Counts of the sample stand for those of all rows of their label.
    scale = (totals.get(0, 0) / max(clean_rows, 1)) / (totals[1] / toxic_rows)
    rows = toxic + clean * scale + SHRINK
    mean = (toxic + SHRINK * share) / rows
    # Lower end of the Wilson interval: a share from few rows counts for less.
    z = ERRORS
    low = (mean + z * z / (2 * rows) - z * F.sqrt(mean * (1 - mean) / rows + z * z / (4 * rows * rows))) / (1 + z * z / rows)
    picked = sums.filter("feature != ''").filter((rate < 1) & (stat >= 2 * math.log(tried))).select("feature", low.alias("weight"))
    # Each weight over the overall share needs its count of toxic rows, so this table is bounded by the sample.
    return {r["feature"]: r["weight"] for r in picked.filter(F.col("weight") > share).collect()}


def score(docs: DataFrame, scorer: Scorer, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``toxicity`` from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    return add_columns(docs, "text", ADDED, lambda texts: [pa.array([shared.value.score(t) for t in texts.to_pylist()], pa.float64())], keep)
