"""Language identification with a linear-chain conditional random field over words.

Each word of a text gets a probability for every language: its affixes, all its
n-grams of bytes and its entry in a lexicon score the languages, learned transitions
tie neighbouring words together, and forward-backward gives the marginals. The
language of a text is the one with the most probability over all its words. In
scripts that are written without spaces (Han, kana, Thai and others), every
character is a word.

The field is fitted on a bounded sample of labelled texts: at most
``SAMPLE_ROWS`` of each language, chosen by a hash of the whole row. Lexicon and
weights come from that sample, all else reads every row. Every language that labels a
text is learned; weights take a quarter of a MB of each task for a language, and time
follows the square of their number.

Texts are worked on in segments of equal length, all segments of a slice at once.
The chain is not cut there: a first pass gives each segment's transfer matrix,
and their products hand the state on from one segment to the next.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
ties take the first language by name; repeated rows get equal results; without
labelled rows every text is ``und``; extra columns pass through, and input columns
named like an added one are replaced.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import ALPHANUMERIC, Words, add_columns, mix, set_aside

SAMPLE_ROWS = 250
FEATURES = 1 << 16
SEGMENT = 128
# Languages up to which texts are worked on in segments.
SEGMENTED = 32
RESCALE = 8
UNDETERMINED = "und"

ADDED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

# Bytes of a word's n-grams, of which all are taken.
GRAM_SIZES = (2, 3)

# Scores held at once, features times languages or words times languages.
HELD = 1 << 22

# First and last code points of scripts without spaces between words, with their punctuation.
_UNSPACED = np.array(
    [
        (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x2E80, 0x312F),
        (0x31A0, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFE30, 0xFE4F), (0xFF01, 0xFF9F),
        (0x16FE0, 0x18DFF), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFF),
    ]
)


def _characters(data: np.ndarray) -> np.ndarray:
    """Where characters of scripts without spaces begin and end."""
    out = []
    for n, low in ((3, 0xE0), (4, 0xF0)):
        at = np.flatnonzero((data >= low) & (data < low + (16 if n == 3 else 8)))
        at = at[at + n <= len(data)]
        point = data[at].astype(np.int64) & (15 if n == 3 else 7)
        for k in range(1, n):
            point = point << 6 | data[at + k] & 63
        range_ = np.searchsorted(_UNSPACED[:, 0], point, "right") - 1
        at = at[(range_ >= 0) & (point <= _UNSPACED[range_, 1])]
        out += [at, at + n]
    return np.concatenate(out)


def words_of(texts: pa.Array) -> Words:
    return Words(texts, ALPHANUMERIC, _characters)


def _kind(k: int) -> np.uint64:
    """Sets the hashes of one kind of feature apart from those of the others."""
    return np.uint64(k * 0x5BD1E9955BD1E995 % (1 << 64))


def _features(words: Words, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of the words at ``first``, word after word, and how many each has: lexicon entry, affixes of 1 to 3 bytes, n-grams.

    The lexicon has the upper half of the numbers, by the hash of the word.
    """
    starts, length = words.starts[first], words.ends[first] - words.starts[first]
    data = np.concatenate([words.data | np.where((words.data >= 65) & (words.data <= 90), 32, 0).astype(np.uint8), np.zeros(4, np.uint8)]).astype(np.uint64)
    gram = {1: data[:-4]}
    for n in (2, 3):
        gram[n] = gram[n - 1] * np.uint64(257) + data[n - 1 : len(data) - 4 + n - 1]
    half = np.uint64(FEATURES // 2)
    grams = {n: np.maximum(length - n + 1, 0) for n in GRAM_SIZES}
    counts = 1 + 2 * np.minimum(length, 3) + sum(grams.values())
    at = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.int32)

    def put(places: np.ndarray, grams: np.ndarray, kind: np.uint64) -> None:
        out[places] = (mix(grams + kind) % half).astype(np.int32)

    out[at] = (words.hashes[first] % half + half).astype(np.int32)
    at = at + 1
    for n in (1, 2, 3):
        ok = length >= n
        for begin, kind in ((starts, 11), (starts + length - n, 12)):
            put(at[ok], gram[n][begin[ok]], _kind(kind * 1000 + n))
            at = at + ok
    for n in GRAM_SIZES:
        nth = np.arange(int(grams[n].sum())) - np.repeat(np.cumsum(grams[n]) - grams[n], grams[n])
        put(np.repeat(at, grams[n]) + nth, gram[n][np.repeat(starts, grams[n]) + nth], _kind(n))
        at = at + grams[n]
    return out, counts


def _blocks(counts: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Consecutive texts of at most ``limit`` words together, one text at least."""
    ends, out, first = np.cumsum(counts), [], 0
    while first < len(counts):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + limit, "right")))
        out.append((first, last))
        first = last
    return out


class Field:
    """Weights of a linear chain over words: ``emission[feature, label]`` and ``transition[from, to]``."""

    def __init__(self, labels: list[str]):
        self.labels = labels
        n = len(labels)
        self.emission = np.zeros((FEATURES, n))
        self.transition = np.zeros((n, n))

    def emissions(self, words: Words) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """Scores of each different word, which of them each word is, and their features with how many each has."""
        _, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
        features, counts = _features(words, first)
        return self._scores(features, counts), which, (features, counts)

    def _scores(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sums of the weights of each word's features, over a bounded number of features at once."""
        out = np.zeros((len(counts), self.emission.shape[1]))
        begins = np.cumsum(counts) - counts
        step = max(1, HELD // max(1, out.shape[1]))
        for a in range(0, len(features), step):
            b = min(a + step, len(features))
            own = np.arange(np.searchsorted(begins, a, "right") - 1, np.searchsorted(begins, b, "left"))
            out[own] += np.add.reduceat(self.emission[features[a:b]], np.maximum(begins[own] - a, 0), axis=0, dtype=np.float64)
        return out

    def marginals(self, scores: np.ndarray, counts: np.ndarray, transitions: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Marginal of each label at each word, for texts of ``counts`` words on end; the expected transitions if asked for.

        Weights are scaled every few steps: a step shrinks the largest by no more
        than the smallest move.
        """
        total, n = scores.shape
        if not total:
            return np.zeros((0, n)), np.zeros((n, n))
        factor = np.exp(scores - scores.max(1, keepdims=True))
        move = np.exp(self.transition - self.transition.max())
        counts = counts[counts > 0]
        # A transfer matrix takes the cube of the number of languages: with many of them texts are walked through whole.
        segment = SEGMENT if n <= SEGMENTED else int(counts.max())
        pieces = -(-counts // segment)
        text = np.repeat(np.arange(len(counts)), pieces)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begins = (np.cumsum(counts) - counts)[text] + nth * segment
        length = np.minimum(counts[text] - nth * segment, segment)
        order = np.argsort(-length, kind="stable")  # step k works on a head of this order
        live = [int(np.searchsorted(-length[order], -k, "left")) for k in range(segment)]

        # Transfer matrix of each segment: weight of leaving it in state j when the word before it was i.
        transfer = np.broadcast_to(np.eye(n), (len(text) if pieces.max() > 1 else 0, n, n)).copy()
        for k in range(int(length.max()) if len(transfer) else 0):
            own = order[: live[k]]
            m = (transfer[own] @ move) * factor[begins[own] + k][:, None, :]
            transfer[own] = m / m.max((1, 2), keepdims=True) if k % RESCALE == 0 else m

        # The state before each segment and the weight of all that follows it.
        start, end = np.ones((len(text), n)), np.ones((len(text), n))
        for k in range(1, int(pieces.max())):
            at = np.flatnonzero(nth == k)
            if k == 1:
                first = factor[begins[at - 1]]
            v = (start[at - 1][:, None, :] @ transfer[at - 1])[:, 0]
            start[at] = v / v.max(1, keepdims=True)
        last = np.cumsum(pieces) - 1
        left = np.repeat(pieces, pieces) - 1 - nth
        for k in range(1, int(pieces.max())):
            at = np.flatnonzero(left == k)
            v = (transfer[at + 1] @ end[at + 1][:, :, None])[:, :, 0]
            end[at] = v / v.max(1, keepdims=True)

        alpha = np.empty((total, n))
        state = start
        for k in range(int(length.max())):
            own = order[: live[k]]
            at = begins[own] + k
            v = (state[own] @ move) * factor[at]
            if k == 0:
                fresh = nth[own] == 0
                v[fresh] = factor[at[fresh]]
            if k % RESCALE == 0:
                v /= v.max(1, keepdims=True)
            state[own] = v
            alpha[at] = v
        beta = np.empty((total, n))
        state = end
        expected = np.zeros((n, n))
        for k in range(int(length.max()) - 1, -1, -1):
            own = order[: live[k]]
            at = begins[own] + k
            beta[at] = state[own]
            v = factor[at] * state[own]
            if transitions and len(inner := at[(k > 0) | (nth[own] > 0)]):
                w = v if len(inner) == len(at) else v[(k > 0) | (nth[own] > 0)]
                joint = alpha[inner - 1][:, :, None] * move * w[:, None, :]
                expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            v = v @ move.T
            state[own] = v / v.max(1, keepdims=True) if k % RESCALE == 0 else v
        both = alpha * beta
        return both / both.sum(1, keepdims=True), expected

    def fit(self, texts: list[str], labels: list[str], steps: int = 20, rate: float = 0.3, decay: float = 1e-4) -> Field:
        """Gradient ascent on the conditional likelihood, every word of a text labelled as the text."""
        n = len(self.labels)
        number = {x: k for k, x in enumerate(self.labels)}
        texts_ = pa.array(texts, pa.string())
        owns = np.array([number[x] for x in labels], np.int64)
        counts = words_of(texts_).counts
        total = int(counts.sum())
        if not total:
            return self
        blocks = _blocks(counts, max(1, HELD // n))

        def read(a: int, b: int) -> tuple:
            """Words of some texts: how many each text has, which is which, features, and how often words and moves have each label."""
            words = words_of(texts_.slice(a, b - a))
            gold = owns[a:b][words.row]
            same = words.row[1:] == words.row[:-1]
            moved = np.bincount(gold[:-1][same] * n + gold[1:][same], minlength=n * n).reshape(n, n)
            _, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
            features, sizes = _features(words, first)
            truth = np.bincount(which * n + gold, minlength=len(first) * n).reshape(len(first), n)
            return words.counts, which, features, sizes, truth, moved

        # Read once where one block holds all texts, else at each step, so memory does not follow the sample.
        held = read(*blocks[0]) if len(blocks) == 1 else None
        squares, squares_t = np.full_like(self.emission, 1e-8), np.full_like(self.transition, 1e-8)
        for _ in range(steps):
            gradient, gradient_t = np.zeros_like(self.emission), np.zeros_like(self.transition)
            for block in blocks:
                own, which, features, sizes, truth, moved = held or read(*block)
                marginal, expected = self.marginals(self._scores(features, sizes)[which], own)
                for k in range(n):
                    missing = truth[:, k] - np.bincount(which, marginal[:, k], len(sizes))
                    gradient[:, k] += np.bincount(features, np.repeat(missing, sizes), FEATURES)
                gradient_t += moved - expected
            gradient = gradient / total - decay * self.emission / FEATURES
            gradient_t = gradient_t / total - decay * self.transition
            squares += gradient**2
            squares_t += gradient_t**2
            self.emission += rate * gradient / np.sqrt(squares)
            self.transition = np.clip(self.transition + rate * gradient_t / np.sqrt(squares_t), -20, 20)
        return self

    def label(self, texts: pa.Array) -> list[pa.Array]:
        words = words_of(texts)
        n = len(self.labels)
        names, score = [UNDETERMINED] * words.rows, np.zeros(words.rows)
        if n and len(words.hashes):
            scores, which, _ = self.emissions(words)
            sums = np.zeros((words.rows, n))
            for a, b in _blocks(words.counts, HELD // n):
                own = slice(words.firsts[a], words.firsts[b])
                marginal, _ = self.marginals(scores[which[own]], words.counts[a:b], transitions=False)
                sums[a:b] = np.stack([np.bincount(words.row[own] - a, marginal[:, k], b - a) for k in range(n)], 1)
            best = sums.argmax(1)
            lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            for row in np.flatnonzero((words.counts > 0) & lettered).tolist():
                names[row] = self.labels[best[row]]
                score[row] = sums[row, best[row]] / words.counts[row]
        return [pa.array(names, pa.string()), pa.array(np.clip(score, 0, 1))]


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Field:
    """A field fitted on at most ``sample_rows`` texts of each language of ``labelled`` (text, lang, any others)."""
    rows = labelled.filter("text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Field([])
    # Drawn by a hash of the row, so large groups of copies are thinned like all others.
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, (1.5 * sample_rows + 40) / n))])
    draw = F.pmod(F.xxhash64(*labelled.columns), F.lit(1_000_000)) / 1e6
    drawn = rows.filter(draw < share[F.col("lang")])
    order = Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")
    sample = drawn.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= sample_rows).orderBy("lang", "n").collect()
    return Field(sorted(counts)).fit([r["text"] for r in sample], [r["lang"] for r in sample])


def identify(docs: DataFrame, field: Field, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with lang_pred and score."""
    slim = Field(field.labels)
    slim.emission, slim.transition = field.emission.astype(np.float32), field.transition
    packed = docs.sparkSession.sparkContext.broadcast(pickle.dumps(slim))
    loaded: list[Field] = []

    def work(texts: pa.Array) -> list[pa.Array]:
        if not loaded:
            loaded.append(pickle.loads(packed.value))
        return loaded[0].label(texts)

    return add_columns(docs, "text", ADDED, work, keep)


def keep_identified(docs: DataFrame, field: Field, min_score: float = 0.3) -> DataFrame:
    """Rows of ``docs`` whose text has a language, with at least ``min_score`` of its words' probability."""
    docs, back = set_aside(docs, ADDED.names)
    found = identify(docs, field)
    return back(found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score)))
