"""Near duplicates by bottom-k sketches of word shingles.

One hash function orders all shingles. A document's sketch is its ``SKETCH``
smallest hashes; the first ``LISTED`` of them go into inverted lists, from which
pairs that share retained values come. A pair is estimated on the bottom-k of the
union of its two sketches, and confirmed on the full sets.

* Documents with equal sets are one class before anything is paired.
* Two sets at the threshold share ``SHARED`` of their ``LISTED`` smallest values but
  for a chance below 1e-5, more similar ones far more surely. Each document
  therefore goes only into the lists of its rarest values.
* A list of at most ``LIST_ROWS`` documents gives all its pairs. A longer one gives
  a star: each document is paired with one leader, drawn anew for each list, within
  a band of set sizes. Only documents most of whose values are in long lists can
  meet nowhere else, and only they take part.
* Links become components; what is already connected is not compared again. The
  stars join most of a large group. Last, documents that take part are compared
  across components wherever they share one of their ``KEYED``
  smallest values. There the union sketch of ``DEEP`` values is compared within
  the join, so that pairs of a large group that are not quite similar enough
  never leave it.
* A pair that joins nothing new is never verified: first comes the best partner of
  each document, then whatever is still open.

Nothing is collected to the driver but counts and a filter of fixed size. Tables
between the steps are written to the shared scratch folder.

Defined cases: texts without words, empty and null texts have an empty set and are
linked with nothing; a row without doc_id has no component and is kept; repeated
rows of one doc_id are one document; of the documents of a group the one with the
smallest doc_id stays, so there are no ties; a table without rows gives none; extra
columns pass through ``drop_duplicates``.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetmill.session import materialise

from .batches import SPACED, Words, add_columns, batch_rows, column, let, mix, set_aside, slices
from .components import extend

WORDS = 5
PERCENT = 80
SKETCH, LISTED, SHARED, KEYED, DEEP = 64, 32, 15, 8, 256
LIST_ROWS = 24
# Bits of the filter of documents whose full sets are wanted, for each of them and at most.
FILTER_BITS, FILTER_MOST = 16, 1 << 28
# Rows handed to Python at once: some hold two full sets.
BATCH_ROWS = 1_000
# Standard errors by which an estimate may fall short of the threshold.
SLACK = 4.5

_SETS = T.StructType([T.StructField("shingles", T.BinaryType())])
_SKETCHES = T.StructType(
    [T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("sketch", T.BinaryType())]
)


def _sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted different shingle hashes of each text."""
    words = Words(texts, SPACED)
    hashes, first = words.windows(size)
    row = words.row[first]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        extra = []
        for r in short:
            own, base = words.hashes[words.firsts[r] : words.firsts[r + 1]], np.uint64(0)
            for h in own:
                base = mix(np.array([base ^ h]))[0]
            extra.append(mix(np.array([base ^ np.uint64(len(own))]))[0])
        hashes, row = np.concatenate([hashes, np.array(extra, np.uint64)]), np.concatenate([row, short])
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    hashes, row = hashes[new], row[new]
    return np.split(hashes, np.cumsum(np.bincount(row, minlength=words.rows))[:-1])


def _top(x: np.ndarray) -> bytes:
    """The upper halves of sorted 64-bit numbers: they keep the order."""
    return (x >> np.uint64(32)).astype("<u4").tobytes()


def sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, a digest of the set, and its bottom-k sketch."""

    def work(texts: pa.Array) -> list[pa.Array]:
        sets = _sets(texts, words)
        return [
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
            pa.array([_top(s[:SKETCH]) for s in sets], pa.binary()),
        ]

    return add_columns(docs, "text", _SKETCHES, work, keep=["doc_id"])


def shingle_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and the full set as sorted 64-bit numbers."""
    return add_columns(
        docs, "text", _SETS, lambda texts: [pa.array([s.tobytes() for s in _sets(texts, words)], pa.binary())], keep=["doc_id"]
    )


def _lists(reps: DataFrame) -> DataFrame:
    """(value, rows, doc, n, hot, listed) for the rarest values of each document that others have as well."""

    def explode(batches):
        for batch in batches:
            rows, values = [], []
            for row, raw in enumerate(batch.column("sketch").to_pylist()):
                own = np.frombuffer(raw, "<u4")[:LISTED]
                rows.append(np.full(len(own), row)), values.append(own)
            take = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
            value = np.concatenate(values).astype(np.int64) if values else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(take), batch.column("n").take(take), pa.array(value)], ["doc", "n", "value"])

    entries = reps.select("doc", "n", "sketch").mapInArrow(explode, T.StructType([reps.schema["doc"], T.StructField("n", T.LongType()), T.StructField("value", T.LongType())]))
    entries = entries.repartition("value")  # dealt once, for both uses
    shared = entries.groupBy("value").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    met = entries.join(shared, "value")
    # Per document at most LISTED entries: where all SHARED of them must be shared, the rarest suffice.
    own = met.groupBy("doc", "n").agg(F.array_sort(F.collect_list(F.struct("rows", "value"))).alias("own"))
    listed = F.least(F.col("n"), F.lit(LISTED))
    single = listed - F.size("own")  # values that nobody else has count as rarest
    wanted = listed - F.floor(listed * SHARED / LISTED) + 1 - single
    own = own.withColumn("hot", F.size(F.filter("own", lambda x: x["rows"] > LIST_ROWS)) / listed)
    picked = F.slice("own", F.lit(1), F.greatest(wanted, F.lit(0)).cast("int"))
    return own.select("doc", "n", "hot", F.explode(picked).alias("x")).select("x.value", "x.rows", "doc", "n", "hot")


def _near(percent: int, a: str = "na", b: str = "nb"):
    """Sizes that a similarity over the threshold allows."""
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent) & (F.col(a) > 0)


def _estimated(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) with an estimate on union sketches, without those clearly below the threshold."""
    side = lambda c: reps.select(F.col("doc").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").filter(_near(percent))
    goal = percent / 100
    schema = T.StructType([joined.schema["a"], joined.schema["b"], T.StructField("estimate", T.DoubleType())])

    def estimate(batches):
        for batch in batches:
            out = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist()):
                x, y = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
                union = np.sort(np.concatenate([x, y]))
                twice = union[1:] == union[:-1]
                # The k smallest of the union are known from two sketches of k values.
                first = np.concatenate([[True], ~twice])
                k = min(SKETCH, int(first.sum()))
                limit = union[first][k - 1]
                out.append(float((twice & (union[1:] <= limit)).sum()) / k)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], schema.names)

    least = goal - SLACK * math.sqrt(goal * (1 - goal) / SKETCH)
    return joined.select("a", "b", "sa", "sb").mapInArrow(estimate, schema).filter(F.col("estimate") >= least)


def _wanted(ids: DataFrame) -> tuple[int, np.ndarray]:
    """A filter of the documents ``ids`` (id): bits by hash, a bounded number of them. It may let others through."""
    bits = 1 << min(max(16, (FILTER_BITS * ids.count()).bit_length()), FILTER_MOST.bit_length() - 1)
    place = F.pmod(F.xxhash64("id"), F.lit(bits))
    words = ids.select((place / 64).cast("long").alias("word"), (place % 64).cast("int").alias("bit"))
    words = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    table = np.zeros(bits // 64, np.int64)
    got = words.toArrow()
    table[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return bits, table


def _sets_of(ids: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """Full sets of the documents ``ids`` (id); texts of all others are passed over where they are read."""
    bits, table = _wanted(ids)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    placed = docs.filter("doc_id is not null").select("doc_id", "text", place.alias("place"))
    schema = T.StructType([docs.schema["doc_id"], *_SETS.fields])

    def work(batches):
        for batch in batches:
            at = batch.column("place").to_numpy()
            wanted = (shared.value[at >> 6] >> (at & 63)) & 1
            for part in slices(batch.filter(pa.array(wanted.astype(bool))), "text"):
                sets = pa.array([s.tobytes() for s in _sets(part.column("text"), words)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), sets], schema.names)

    return placed.mapInArrow(work, schema).dropDuplicates(["doc_id"])


def _verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    sets = materialise(_sets_of(ids, docs, words), "shingle-sets")
    side = lambda c: sets.select(F.col("doc_id").alias(c), F.col("shingles").alias(f"s{c}"))
    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    schema = T.StructType([joined.schema["a"], joined.schema["b"]])

    def verify(batches):
        for batch in batches:
            for part in slices(batch, "sa"):
                ok = []
                for x, y in zip(part.column("sa").to_pylist(), part.column("sb").to_pylist()):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = np.sort(np.concatenate([x, y]))
                    common = int((both[1:] == both[:-1]).sum())
                    ok.append(100 * common >= percent * (len(both) - common) > 0)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], schema.names).filter(pa.array(ok, pa.bool_()))

    return materialise(joined.select("a", "b", "sa", "sb").mapInArrow(verify, schema), "links")


def _open(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are not yet in one component."""
    side = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    joined = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return joined.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).drop("ca", "cb")


def _banded(rows: DataFrame, percent: int) -> DataFrame:
    """``rows`` once in the band of their size and once in the next: sizes that may match share a band."""
    own = F.floor(F.log(F.col("n").cast("double")) / -math.log(percent / 100)).cast("long")
    return rows.withColumn("own_band", own).withColumn("band", F.explode(F.array("own_band", F.col("own_band") + 1)))


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))


def _unjoined(rows: DataFrame) -> DataFrame:
    """``rows`` (labelled) of lists that hold more than one component."""
    several = rows.groupBy("value", "band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high")
    return rows.join(several.select("value", "band"), ["value", "band"], "left_semi")


def _ordered(met: DataFrame) -> DataFrame:
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _starred(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of each document of a list with the list's leader, drawn anew for each list."""
    draw = F.struct(F.xxhash64("value", "band", "doc"), F.col("doc"))
    leaders = rows.groupBy("value", "band").agg(F.min_by(F.struct("doc", "n"), draw).alias("lead"))
    met = rows.join(leaders, ["value", "band"]).filter(F.col("doc") != F.col("lead.doc"))
    met = met.select(F.col("doc").alias("x"), F.col("n").alias("na"), F.col("lead.doc").alias("y"), F.col("lead.n").alias("nb"))
    return _ordered(met.filter(_near(percent)))


def _similar(x: str, y: str, sizes: tuple[str, str], percent: int):
    """Whether two bottom-k sketches (sorted arrays) may be those of similar sets: the estimate on their union's bottom-k.

    Where the union holds both sets in full the estimate is exact and needs no slack.
    """
    goal = percent / 100
    slack = SLACK * math.sqrt(goal * (1 - goal) / DEEP)

    def judged(union):
        k = F.least(F.size(union), F.lit(DEEP))
        common = F.size(F.filter(F.array_intersect(x, y), lambda v: v <= F.element_at(union, k)))
        whole = (F.size(union) <= DEEP) & (F.greatest(*sizes) <= DEEP)
        return common / k >= F.when(whole, F.lit(goal - 1e-9)).otherwise(F.lit(goal - slack))

    return let(F.sort_array(F.array_union(x, y)), judged)


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components of a list whose union sketch is similar enough.

    A pair of documents meets in several lists; it is judged in one of them, drawn
    by the pair, so that the work of a large group is spread over its lists.
    """
    side = lambda c: rows.select("value", "band", *[F.col(k).alias(f"{k}_{c}") for k in ("doc", "n", "component", "own_band", "top")])
    smallest = lambda c: F.slice(f"top_{c}", 1, KEYED)
    drawn = lambda common: F.element_at(common, F.pmod(F.hash("doc_x", "doc_y"), F.size(common)) + 1)
    # A cheap look at part of the sketches first: far below the threshold they share little.
    some = F.size(F.array_intersect(F.slice("top_x", 1, LISTED), F.slice("top_y", 1, LISTED)))
    met = side("x").join(side("y"), ["value", "band"]).filter(
        (F.col("doc_x") < F.col("doc_y"))
        & (F.col("component_x") != F.col("component_y"))
        & (F.col("band") == F.greatest("own_band_x", "own_band_y"))
        & _near(percent, "n_x", "n_y")
        & (F.col("value") == let(F.array_intersect(smallest("x"), smallest("y")), drawn))
        & (some >= F.floor(F.least("n_x", "n_y", F.lit(LISTED)) * SHARED / LISTED))
        & _similar("top_x", "top_y", ("n_x", "n_y"), percent)
    )
    return met.select(F.col("doc_x").alias("a"), F.col("doc_y").alias("b"))


def _deep(ids: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """doc, n and the DEEP smallest values as a sorted array for the documents ``ids`` (id)."""
    sets = _sets_of(ids, docs, words)
    schema = T.StructType([T.StructField("doc", docs.schema["doc_id"].dataType), T.StructField("n", T.LongType()), T.StructField("top", T.ArrayType(T.LongType()))])

    def work(batches):
        for batch in batches:
            sets = [np.frombuffer(s, np.uint64) for s in batch.column("shingles").to_pylist()]
            tops = pa.array([np.frombuffer(_top(s[:DEEP]), "<u4").tolist() for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), tops], schema.names)

    return sets.mapInArrow(work, schema).join(ids.withColumnRenamed("id", "doc"), "doc", "left_semi")


def near_duplicate_classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs`` (doc_id, text).

    Two documents are linked if 100 * intersection >= percent * union of their
    sets; component_id is the smallest doc_id reachable over links.
    """
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        return _classes(docs, words, percent)


def _classes(docs: DataFrame, words: int, percent: int) -> DataFrame:
    known = materialise(sketches(docs, words), "sketches")
    filled = known.filter("n_shingles > 0 and doc_id is not null")
    classes = filled.groupBy("digest").agg(
        F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("copies")
    )
    classes = materialise(classes, "classes")
    reps = classes.select("doc", "n", "sketch")
    lists = materialise(_lists(reps), "lists")

    side = lambda c: lists.filter(F.col("rows") <= LIST_ROWS).select("value", F.col("doc").alias(c), F.col("n").alias(f"n{c}"))
    short = side("a").join(side("b"), "value").filter((F.col("a") < F.col("b")) & _near(percent)).select("a", "b").distinct()
    dense = lists.filter((F.col("rows") > LIST_ROWS) & (F.col("hot") >= SHARED / LISTED))
    dense = materialise(_banded(dense.select("value", "doc", "n"), percent), "dense-lists")
    first = _starred(dense, percent)
    pairs = materialise(_estimated(short.unionByName(first), reps, percent), "estimates")

    # The best partner of each document joins most; the rest is verified only where it still matters.
    best = materialise(pairs.groupBy("b").agg(F.max_by("a", F.struct("estimate", -F.col("a"))).alias("a")).select("a", "b"), "best-pairs")
    labels = extend(None, _verified(best, docs, words, percent))
    rest = materialise(_open(pairs.select("a", "b"), labels), "open-pairs")
    labels = extend(labels, _verified(rest, docs, words, percent))

    # Across components: every document that may meet others in long lists only.
    several = _unjoined(_labelled(dense, labels)).select(F.col("doc").alias("id")).distinct()
    deep = materialise(_labelled(_deep(materialise(several, "open-documents"), docs, words), labels), "deep-sketches")
    keyed = _banded(deep, percent).withColumn("value", F.explode(F.slice("top", 1, KEYED)))
    last = materialise(_across(keyed, percent), "last-pairs")
    labels = extend(labels, _verified(last, docs, words, percent))

    # Only documents that are not their own component are told so.
    told = classes.select("digest", "doc", "copies").join(labels.withColumnRenamed("node", "doc"), "doc", "left")
    told = told.select("digest", F.coalesce("component", "doc").alias("component"), "doc", "copies").filter((F.col("copies") > 1) | (F.col("component") != F.col("doc")))
    joined = known.withColumn("digest", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("digest"))).join(told.select("digest", "component"), "digest", "left")
    out = joined.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each component of ``docs``, the one with the smallest doc_id; columns as they are."""
    docs, back = set_aside(docs, ["component_id", "n_shingles", "kept"])
    labels = near_duplicate_classes(docs, words, percent)
    gone = labels.filter(~F.col("kept")).select("doc_id").distinct()
    stay = docs.join(gone, "doc_id", "left_anti")
    # Repeated rows of one document: one of them stays.
    again = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("doc_id")
    if not again.take(1):
        return back(stay)
    order = Window.partitionBy("doc_id").orderBy(*[column(c) for c in docs.columns])
    one = stay.join(again, "doc_id", "left_semi").withColumn("__nth", F.row_number().over(order)).filter("__nth = 1").drop("__nth")
    return back(stay.join(again, "doc_id", "left_anti").unionByName(one))
