"""Benchmark decontamination: documents are scanned for windows of benchmark words.

The benchmark is read in blocks of bounded size. The windows of a block are sent to
every task as one sorted table of hashes, flat arrays beside the block's text; a
document's windows are looked up there, and every hit is verified on its words. With
several blocks, the rows are numbered in a written table, each block's hits are
written and its table is given up before the next block is read, and the hits are
united per row at the end: a benchmark of any size takes more passes and not more
memory.

Defined cases: null and empty texts have no words and are never hit; an item
without words matches nothing; an item shorter than the window is one window; a window
that several items share is a hit of each; items without an id are passed over;
repeated rows get equal results; extra columns pass through, and input columns
named like an added one are replaced. A benchmark without rows hits nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetmill.session import materialise

from .batches import ALPHANUMERIC, Words, add_columns, column, set_aside

WINDOW = 10
# Text bytes of the benchmark that one pass sends to the tasks.
BLOCK_BYTES = 16 << 20

ADDED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_spans", T.ArrayType(T.LongType())),
        T.StructField("hit_items", T.ArrayType(T.StringType())),
    ]
)


class WindowTable:
    """Windows of benchmark items, by length: sorted hashes, and the first word of each."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.names = [name for name, _ in items]
        self.words = Words(pa.array([text for _, text in items], pa.string()), ALPHANUMERIC)
        lengths = np.minimum(self.words.counts, window)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        # One bit for each of the lower 20 bits of a hash: most windows end here.
        self.bits: dict[int, np.ndarray] = {}
        for length in np.unique(lengths[lengths > 0]).tolist():
            hashes, firsts = self.words.windows(length)
            own = lengths[self.words.row[firsts]] == length
            order = np.argsort(hashes[own], kind="stable")
            self.by_length[length] = hashes[own][order], firsts[own][order].astype(np.int32)
            self.bits[length] = np.zeros(1 << 20, bool)
            self.bits[length][(hashes[own] & np.uint64(0xFFFFF)).astype(np.int64)] = True
        # What a scan reads, in small numbers: the text, and its words' places and rows.
        self.words.starts, self.words.ends = self.words.starts.astype(np.int32), self.words.ends.astype(np.int32)
        self.words.row, self.words.data = self.words.row.astype(np.int32), self.words.data.copy()
        del self.words.hashes, self.words.firsts, self.words.counts, self.words.offsets

    def _items(self, length: int, low: int, high: int, text: bytes) -> frozenset[int]:
        """Rows of the items whose window, one of those from ``low`` to ``high``, reads ``text``."""
        firsts = self.by_length[length][1][low:high].tolist()
        return frozenset(int(self.words.row[f]) for f in firsts if self.words.text(f, length) == text)

    def scan(self, texts: pa.Array) -> list[pa.Array]:
        words = Words(texts, ALPHANUMERIC)
        spans: dict[int, list[tuple[int, int]]] = {}
        hits: dict[int, set[frozenset[int]]] = {}
        for length, (hashes, _) in self.by_length.items():
            own, firsts = words.windows(length)
            maybe = np.flatnonzero(self.bits[length][(own & np.uint64(0xFFFFF)).astype(np.int64)])
            low, high = np.searchsorted(hashes, own[maybe]), np.searchsorted(hashes, own[maybe], "right")
            found: dict[bytes, frozenset[int]] = {}
            for f, a, b in zip(firsts[maybe][high > low].tolist(), low[high > low].tolist(), high[high > low].tolist()):
                text = words.text(f, length)
                if text not in found:
                    found[text] = self._items(length, a, b, text)
                if found[text]:
                    row = int(words.row[f])
                    start = f - int(words.firsts[row])
                    spans.setdefault(row, []).append((start, start + length))
                    hits.setdefault(row, set()).add(found[text])
        items = {row: sorted({self.names[i] for i in frozenset().union(*sets)}) for row, sets in hits.items()}
        return [
            pa.array(words.counts.astype(np.int64)),
            pa.array([_united(spans.get(r, [])) for r in range(words.rows)], pa.list_(pa.int64())),
            pa.array([items.get(r, []) for r in range(words.rows)], pa.list_(pa.string())),
        ]


def _united(spans: list[tuple[int, int]]) -> list[int]:
    """Starts and ends of the united spans, in turn."""
    out: list[int] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _blocks(benchmark: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The items in parts of about ``block_bytes`` of text; one part where all fit."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("item_id is not null")
    size = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64).alias("b")).first()["b"] or 0
    parts = -(-size // block_bytes)
    return [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k) for k in range(parts)]


def scan_documents(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: list[str] | None = None, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` with n_words, hit_spans (word places: start, end, start, end, ...) and hit_items."""
    blocks = _blocks(benchmark, block_bytes)
    if len(blocks) <= 1:
        return _scan_block(docs, blocks, window, keep)[0]
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ADDED.names]
    numbered = docs.select(*map(column, dict.fromkeys([*kept, "text"])), F.monotonically_increasing_id().alias("__row"))
    rows = materialise(numbered, "numbered-documents")
    parts = []
    for k, block in enumerate(blocks):
        found, table = _scan_block(rows.select("__row", "text"), [block], window, ["__row"])
        # The first pass says how many words each row has; the others only what they hit.
        parts.append(materialise(found if k == 0 else found.filter(F.size("hit_spans") > 0), "benchmark-hits"))
        table.unpersist()
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    united = hits.groupBy("__row").agg(
        F.max("n_words").alias("n_words"),
        _unite(F.flatten(F.collect_list(_pairs(F.col("hit_spans"))))).alias("hit_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_items")))).alias("hit_items"),
    )
    return rows.join(united, "__row").select(*map(column, kept), *ADDED.names)


def _pairs(spans: Column) -> Column:
    """Spans as (start, end), from starts and ends in turn."""
    starts = F.filter(F.transform(spans, lambda x, i: F.struct(x.alias("s"), F.get(spans, i + 1).alias("e"), (i % 2 == 0).alias("first"))), lambda p: p["first"])
    return F.transform(starts, lambda p: F.struct(p["s"].alias("s"), p["e"].alias("e")))


def _unite(pairs: Column) -> Column:
    """Starts and ends of the united spans, in turn."""
    empty = F.array().cast("array<bigint>")
    add = lambda acc, x: F.when(
        (F.size(acc) > 0) & (x["s"] <= F.element_at(acc, -1)),
        F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.greatest(F.element_at(acc, -1), x["e"]))),
    ).otherwise(F.concat(acc, F.array(x["s"], x["e"])))
    return F.aggregate(F.array_sort(pairs), empty, add)


def _scan_block(docs: DataFrame, blocks: list[DataFrame], window: int, keep) -> tuple[DataFrame, Broadcast]:
    items = [(r.item_id, r.text) for b in blocks for r in b.collect()]
    table = docs.sparkSession.sparkContext.broadcast(WindowTable(items, window))
    return add_columns(docs, "text", ADDED, lambda texts: table.value.scan(texts), keep), table


def hit_words(spans="hit_spans"):
    """Number of words inside the spans."""
    c = F.col(spans)
    return F.aggregate(
        F.transform(c, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("bigint"), lambda a, x: a + x
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, columns as they are."""
    docs, back = set_aside(docs, ADDED.names)
    return back(scan_documents(docs, benchmark, window).filter(F.size("hit_spans") == 0))


def cut_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the text from the first to the last word of each hit span taken out."""

    def cut(texts: pa.Array, spans: pa.Array) -> list[pa.Array]:
        words, out = Words(texts, ALPHANUMERIC), []
        for row, (text, own) in enumerate(zip(texts.to_pylist(), spans.to_pylist())):
            if own:
                raw, base, first, at = text.encode(), words.offsets[row], words.firsts[row], 0
                parts = []
                for s, e in zip(own[::2], own[1::2]):
                    parts.append(raw[at : words.starts[first + s] - base])
                    at = words.ends[first + e - 1] - base
                text = (b"".join(parts) + raw[at:]).decode()
            out.append(text)
        return [pa.array(out, pa.string())]

    docs, back = set_aside(docs, ADDED.names)
    text = T.StructType([T.StructField("text", T.StringType())])
    return back(add_columns(scan_documents(docs, benchmark, window), "text", text, cut, needs=["hit_spans"]))
