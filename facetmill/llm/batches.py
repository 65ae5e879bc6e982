"""Row-wise work on Arrow batches, and word scanning with numpy.

A batch is worked on in slices of a bounded number of text bytes, so memory
follows the longest single text and not the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text bytes worked on at once.
SLICE_BYTES = 1 << 19

Work = Callable[..., Sequence[pa.Array]]


def column(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that stands in the plan, and is computed, once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def others(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Columns of ``df`` that no name of ``names`` replaces."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of at most ``limit`` bytes of text (or of a list's numbers), one row at least."""
    if not batch.num_rows:
        return
    held = batch.column(text)
    size = pc.multiply(pc.list_value_length(held), 4) if pa.types.is_list(held.type) else pc.binary_length(held)
    size = pc.fill_null(size, 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(first, last - first)
        first = last


def add_columns(
    df: DataFrame, text: str, adds: T.StructType, work: Work, keep: Sequence[str] | None = None, needs: Sequence[str] = ()
) -> DataFrame:
    """``df`` with the columns that ``work(text, *needs)`` gives for each slice.

    ``keep`` names the input columns that stay (all by default); an input column
    with the name of an added one is replaced.
    """
    kept = others(df.select(*map(column, df.columns if keep is None else keep)), adds.names)
    used = list(dict.fromkeys([*kept, text, *needs]))
    schema = T.StructType([df.schema[c] for c in kept] + adds.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                new = work(part.column(text), *(part.column(c) for c in needs))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *new], [*kept, *adds.names])

    return df.select(*map(column, used)).mapInArrow(run, schema)


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside hand at most ``rows`` rows at once to Python: for rows that each hold whole sets."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts on end, and where each begins and the last ends; null is empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _table(member: Callable[[int], bool]) -> np.ndarray:
    return np.array([member(b) for b in range(256)])


# [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z, on UTF-8 bytes.
SPACED = _table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
ALPHANUMERIC = _table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint64)
_LETTER = mix((_LOWER + np.uint64(1)) * np.uint64(_BASE))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    for k, base in enumerate((_BASE, _INVERSE)):
        if len(_powers[k]) < n:
            steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


class Words:
    """Words of a slice of texts: byte places, 64-bit hashes of their lower-case form, rows.

    ``cuts``, given the bytes of all texts on end, says at which of them words are cut besides.
    """

    def __init__(self, texts: pa.Array, member: np.ndarray, cuts: Callable[[np.ndarray], np.ndarray] | None = None):
        self.data, self.offsets = utf8(texts)
        self.rows = len(texts)
        inside = member[self.data]
        n = len(inside)
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        at = self.offsets[1:-1] if cuts is None else np.concatenate([self.offsets[1:-1], cuts(self.data)])
        before[at[at < n]] = False
        after[at[at > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.row = np.searchsorted(self.offsets, self.starts, "right") - 1
        self.counts = np.bincount(self.row, minlength=self.rows)
        self.firsts = np.concatenate([[0], np.cumsum(self.counts)])
        power, inverse = _power(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_LETTER[self.data] * power[:n], out=total[1:])
        own = (total[self.ends] - total[self.starts]) * inverse[self.starts]
        self.hashes = mix(own + (self.ends - self.starts).astype(np.uint64) * _STEP)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each window of ``n`` words inside one row, and the window's first word."""
        m = len(self.hashes) - n + 1
        if m <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.zeros(m, np.uint64)
        for k in range(n):
            total = total * _STEP + self.hashes[k : k + m]
        first = np.flatnonzero(self.row[:m] == self.row[n - 1 :])
        return mix(total[first] + np.uint64(n)), first

    def text(self, first: int, n: int) -> bytes:
        """``n`` words from ``first`` on, lower-cased and joined by one space."""
        return b" ".join(self.data[s:e].tobytes().lower() for s, e in zip(self.starts[first : first + n], self.ends[first : first + n]))


def set_aside(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with columns named like one of ``names`` renamed, and the way back to the columns of ``df``."""
    taken = {n.lower() for n in names}
    moved = {c: f"__aside_{k}" for k, c in enumerate(df.columns) if c.lower() in taken}

    def back(out: DataFrame) -> DataFrame:
        return out.select(*[column(moved.get(c, c)).alias(c) for c in df.columns])

    return df.withColumnsRenamed(moved), back
