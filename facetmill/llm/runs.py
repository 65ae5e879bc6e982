"""Periodic runs of words: stretches that repeat a period at least four times, found whole and exactly.

A run is a stretch with smallest period q (words q apart are identical), at least
``max(6, 4 q)`` words long, that no neighbouring word extends.

Periods up to ``SHORT`` are read off directly: words equal to those q places before.
Longer ones go by scales. The scale k takes the minimizers of all words' k-word hashes
over windows of k places, the leftmost of equal ones. It serves the periods q with
(2 k - 1) / 3 <= q <= k. Inside a run of such a period a window holds each of the
period's hashes; equal hashes stand a multiple of q apart, since k >= q; and the run's
4 q words leave places for windows that start on either side of a minimizer. So two
neighbouring minimizers inside the run have equal hashes and stand q apart: they are a
seed, and the lag between them is compared word by word to both sides. Scales follow
each other without a gap in the periods. Hashes only propose; what counts are the
words, as numbers that are equal for equal words only. (Two of the hashes of one run
being equal by chance, 2^-64 a pair, could hide it.)

A stretch found with a multiple of its period has the same ends, and the smallest
period counts. The texts of a slice are worked on end to end, each word of another
text being different, and a scale reads only the texts that are long enough for it:
work and memory follow the slice's words times the logarithm of its longest text.

Defined cases: null and empty texts have no words, no runs and collapse to the empty
string; overlapping runs are all listed, ordered by start and period (two runs with
both equal cannot be); very long texts are read whole; repeated rows get equal
results; a table without rows gives none; an input column with the name of an added
one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .batches import add_columns, mix, utf8

# Periods that are compared directly.
SHORT = 8
LEAST_WORDS = 6
LEAST_PERIODS = 4

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
ADDED = T.StructType([T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())])

# Odd, with its inverse modulo 2^64: hashes of neighbouring words are added up once for all lengths.
_FACTOR = 0xD1342543DE82EF95
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def scales(longest: int) -> Iterator[tuple[int, int]]:
    """(smallest period, k) of each scale, for periods over ``SHORT`` of texts of ``longest`` words."""
    period = SHORT + 1
    while LEAST_PERIODS * period <= longest:
        k = (3 * period + 1) // 2
        yield period, k
        period = k + 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each ``k`` neighbouring words."""
    n = len(words)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(words.astype(np.uint64) + np.uint64(1)) * _powers(_FACTOR, n), out=total[1:])
    return mix((total[k:] - total[:-k]) * _powers(_INVERSE, n - k + 1))


def minimizers(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest hash in each window, the leftmost of equal ones."""
    order = np.argsort(hashes, kind="stable")
    least = np.empty(len(hashes), np.int64)
    least[order] = np.arange(len(hashes))
    width = 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        least = np.minimum(least[: len(least) - (window - width)], least[window - width :])
    return order[least[np.flatnonzero(np.diff(least, prepend=-1))]]


def _reach(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many places from ``at`` on, forwards or backwards, equal those ``lag`` further."""
    far, size, n = 0, 64, len(words)
    while True:
        if step > 0:
            a, b = at + far, min(at + far + size, n - lag)
            equal = words[a:b] == words[a + lag : b + lag]
        else:
            a, b = max(at - far - size + 1, 0), at - far + 1
            equal = (words[a:b] == words[a + lag : b + lag])[::-1]
        wrong = np.flatnonzero(~equal)
        if len(wrong):
            return far + int(wrong[0])
        far += len(equal)
        if len(equal) < size:
            return far
        size *= 2


def _stretches(words: np.ndarray, lag: int) -> Iterator[tuple[int, int]]:
    """Ends of all stretches of period ``lag`` that are long enough."""
    edges = np.flatnonzero(np.diff(words[lag:] == words[:-lag], prepend=False, append=False))
    first, last = edges[::2], edges[1::2] + lag
    long = last - first >= max(LEAST_WORDS, LEAST_PERIODS * lag)
    yield from zip(first[long].tolist(), last[long].tolist())


def _seeded(words: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(first, end, lag) of the long enough stretches around the seeds of scale ``k``."""
    hashes = window_hashes(words, k)
    if len(hashes) < k:
        return
    place = minimizers(hashes, k)
    lag = np.diff(place)
    seeds = np.flatnonzero((hashes[place[1:]] == hashes[place[:-1]]) & (lag <= k))
    # Up to where each lag has been compared: the seeds of one run are compared once.
    done: dict[int, int] = {}
    for at, d in zip(place[seeds].tolist(), lag[seeds].tolist()):
        if at < done.get(d, 0):
            continue
        first = at + 1 - _reach(words, at, d, -1)
        end = at + _reach(words, at, d, 1) + d
        done[d] = end - d
        if end - first >= LEAST_PERIODS * d:
            yield first, end, d


def find_runs(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and periods of all runs in texts set end to end, by start and period.

    ``words`` are numbers, equal for equal words of one text and different for two
    texts; text i has those from ``offsets[i]`` to ``offsets[i + 1]``.
    """
    found: dict[tuple[int, int], int] = {}
    for lag in range(1, min(SHORT, len(words) - 1) + 1):
        for stretch in _stretches(words, lag):
            found.setdefault(stretch, lag)
    counts = np.diff(offsets)
    place = np.arange(len(words))
    for period, k in scales(int(counts.max(initial=0))):
        # Only texts that can hold such a run; they get fewer with every scale.
        long = np.repeat(counts >= LEAST_PERIODS * period, counts)
        if not long.all():
            words, place, counts = words[long], place[long], counts[counts >= LEAST_PERIODS * period]
        for first, end, lag in _seeded(words, k):
            stretch = int(place[first]), int(place[first]) + end - first
            found[stretch] = min(lag, found.get(stretch, lag))
    runs = np.array(sorted((first, period, end) for (first, end), period in found.items()), np.int64).reshape(-1, 3)
    return runs[:, 0], runs[:, 2], runs[:, 1]


def _numbered(texts: Sequence[list[bytes]]) -> np.ndarray:
    """Words as numbers, those of each text from where the last one's ended."""
    out: list[int] = []
    used = 0
    for words in texts:
        number: dict[bytes, int] = {}
        out.extend([number.setdefault(w, used + len(number)) for w in words])
        used += len(number)
    return np.array(out, np.int64)


def collapse_runs(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with ``runs`` (start, length and period in words) and ``collapsed``, the text with one period left of each."""

    def work(texts: pa.Array) -> list[pa.Array]:
        data, offsets = utf8(texts)
        # bytes.split() cuts at 09-0D and 20, and nowhere else.
        held = [data[a:b].tobytes().split() for a, b in zip(offsets, offsets[1:])]
        at = np.cumsum([0, *map(len, held)])
        words = _numbered(held)
        start, end, period = find_runs(words, at)
        row = np.searchsorted(at, start, "right") - 1
        # Words behind a run's first period, as steps up and down.
        steps = np.zeros(len(words) + 1, np.int64)
        np.add.at(steps, start + period, 1)
        np.add.at(steps, end, -1)
        kept = np.cumsum(steps[:-1]) == 0
        hit = np.zeros(len(held), bool)
        hit[row] = True
        collapsed = [b" ".join([w for w, k in zip(own, kept[a : a + len(own)].tolist()) if k] if cut else own) for own, a, cut in zip(held, at.tolist(), hit.tolist())]
        values = [pa.array(x) for x in (start - at[row], end - start, period)]
        lists = np.cumsum([0, *np.bincount(row, minlength=len(held))]).astype(np.int32)
        runs = pa.StructArray.from_arrays(values, RUN.names)
        return [pa.ListArray.from_arrays(pa.array(lists), runs), pa.array(collapsed, pa.binary()).cast(pa.string())]

    return add_columns(docs, text, ADDED, work, keep)
