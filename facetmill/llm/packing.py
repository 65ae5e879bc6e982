"""Best-fit packing: documents become token sequences of a fixed size, with as few sequences as possible.

A document is its token ids and an end id; one longer than a sequence is cut into
full pieces behind a first, shorter one. Only the histogram of piece lengths (at
most ``size`` numbers) goes to the driver. There, patterns of two and three
lengths that fill a sequence exactly are fitted to the histogram by non-negative
least squares, repeat counts are rounded down, and what is left is packed best
fit, again as counts of lengths. The plan that comes back is a table of slots:
"pieces number a to b of length l go to sequences from s on, at place o". A
piece's number among those of its length comes from counts per hash bucket, so no
task sees all pieces of a length.

Defined cases: null and empty texts are one piece of the end id alone; repeated
rows are packed once each; pieces of equal length are numbered by doc_id and piece,
those of repeated rows in either order; a table without rows gives none; extra columns are not
part of the result.
"""

from __future__ import annotations

import base64
import functools
import json
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetmill.session import materialise

from .batches import column, slices

SIZE = 1024
END_ID = 2
# Pieces for each hash bucket in which they are numbered.
BUCKET_ROWS = 20_000

PIECES = [
    T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids", T.BinaryType()),
]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def _exact(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def _fast(path: str):
    """A faster encoder of the file's vocabulary, where there is one, and the strings of its special tokens."""
    with open(path) as file:
        special = [token["content"] for token in json.load(file).get("added_tokens", ())]
    try:
        import public_tokenizers
        import tiktoken

        with open(path.removesuffix(".json") + ".tiktoken", "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    except (ImportError, FileNotFoundError):
        fast = None
    return fast, special


def encode(path: str, text: str) -> np.ndarray:
    """Ids as the tokenizer of the file gives them, without special tokens of its own."""
    fast, special = _fast(path)
    if fast is None or any(s in text for s in special):
        return np.array(_exact(path).encode(text, add_special_tokens=False).ids, np.uint32)
    return np.array(fast.encode_ordinary(text), np.uint32)


def token_pieces(docs: DataFrame, path: str | None = None, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length and ids (little-endian unsigned 32-bit numbers)."""
    path = path or tokenizer_path()
    schema = T.StructType([docs.schema["doc_id"], *PIECES])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                rows, piece, start, length, ids = [], [], [], [], []
                for row, text in enumerate(part.column("text").to_pylist()):
                    own = np.append(encode(path, text or ""), np.uint32(end_id)).astype("<u4")
                    cuts = [0, *range(len(own) % size or size, len(own) + 1, size)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        rows.append(row), piece.append(k), start.append(a), length.append(b - a), ids.append(own[a:b].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                    schema.names,
                )

    return docs.select(column("doc_id"), column("text")).mapInArrow(run, schema)


def exact_patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """All pairs and triples of the lengths that fill a sequence; a row has three lengths, 0 for none."""
    have = np.zeros(size + 1, bool)
    have[lengths] = True
    out = [np.array([[size, 0, 0]])] if have[size] else []
    for a in lengths[::-1]:
        b = lengths[lengths <= min(a, size - a)]
        c = size - a - b
        ok = (c <= b) & ((c == 0) | have[c])
        if ok.any():
            out.append(np.stack([np.full(ok.sum(), a), b[ok], c[ok]], 1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def fit_repeats(patterns: np.ndarray, counts: np.ndarray, steps: int = 300) -> np.ndarray:
    """Repeats x >= 0 that minimise |A x - counts|^2, by accelerated projected gradient.

    A has a column for each pattern: how often it holds each length.
    """
    target = counts.astype(float)
    used = np.bincount(patterns.ravel(), minlength=len(counts)).astype(float)
    # Each column scaled by how many patterns want its lengths: otherwise the middle lengths rule the step.
    step = 1 / (3 * np.maximum(used, 1)[patterns].max(1))
    forward = lambda x: np.bincount(patterns.ravel(), np.repeat(x, 3), minlength=len(counts)) * nonzero
    nonzero = np.ones(len(counts))
    nonzero[0] = 0
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(steps):
        gradient = (forward(y) - target * nonzero)[patterns].sum(1)
        new = np.maximum(y - step * gradient, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


# Ways to fit: share of the histogram that patterns are fitted to, and whether pieces
# over half a sequence, which need one of their own, are filled first.
VARIANTS = ((1.0, False), (0.7, False), (0.5, False))

Plan = list[tuple[tuple[int, ...], int]]


def plan_packing(counts: np.ndarray, size: int = SIZE) -> Plan:
    """Sequences as (lengths in order, repeats) for ``counts[length]`` pieces of each length: the best variant's."""
    plans = (_fitted(counts, size, share, large) for share, large in VARIANTS)
    return min(plans, key=lambda p: sum(r for _, r in p))


def _fitted(counts: np.ndarray, size: int, share: float, large: bool, rounds: int = 6) -> Plan:
    left = counts.astype(np.int64).copy()
    target = np.floor(left * share).astype(np.int64)
    plan: Plan = []

    def take(pattern: tuple[int, ...], repeats: int) -> int:
        need: dict[int, int] = defaultdict(int)
        for n in pattern:
            need[n] += 1
        repeats = min([repeats, *(int(target[n]) // k for n, k in need.items())])
        if repeats > 0:
            for n, k in need.items():
                target[n] -= repeats * k
                left[n] -= repeats * k
            plan.append((pattern, repeats))
        return max(repeats, 0)

    for smallest in (size // 2, 0) if large else (0,):
        for _ in range(rounds):
            patterns = exact_patterns(np.flatnonzero(target), size)
            patterns = patterns[patterns[:, 0] > smallest]
            x, taken = fit_repeats(patterns, target), 0
            for k in np.argsort(-x, kind="stable"):
                whole = int(x[k] + 1e-9)
                if not whole:
                    break
                taken += take(tuple(int(n) for n in patterns[k] if n), whole)
            if taken <= 0.01 * target.sum():
                break
    return plan + best_fit(left, size)


def best_fit(counts: np.ndarray, size: int) -> Plan:
    """Best fit, longest first, on counts: equal sequences are kept as one entry with a number."""
    by_free: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    open_free = np.zeros(size + 1, bool)
    for n in np.flatnonzero(counts)[::-1].tolist():
        c = int(counts[n])
        while c:
            fits = np.flatnonzero(open_free[n:])
            if not len(fits):
                by_free[size].append(((), c))
                open_free[size] = True
                continue
            free = n + int(fits[0])
            content, many = by_free[free].pop()
            each = min(free // n, c)
            use = min(many, c // each)
            if many > use:
                by_free[free].append((content, many - use))
            open_free[free] = bool(by_free[free])
            by_free[free - each * n].append((content + (n,) * each, use))
            open_free[free - each * n] = True
            c -= use * each
    return [(content, many) for entries in by_free.values() for content, many in entries if content]


def slots(plan: Plan) -> dict[str, np.ndarray]:
    """The plan by length: from which number on pieces go to which sequences at which place."""
    rows, seen, sequence = [], defaultdict(int), 0
    for pattern, repeats in plan:
        place = 0
        for n in pattern:
            rows.append((n, seen[n], sequence, place))
            seen[n] += repeats
            place += n
        sequence += repeats
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"key": (table[:, 0] << 44) + table[:, 1], "sequence": table[:, 2] - table[:, 1], "offset": table[:, 3]}


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``pieces`` (doc_id, piece, length, any others) with sequence_id and offset.

    ``pieces`` is read three times: hand over a written table.
    """
    context = pieces.sparkSession.sparkContext
    rows = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(size + 1, np.int64)
    for r in rows:
        counts[r["length"]] = r["n"]
    table = context.broadcast(slots(plan_packing(counts, size)))
    buckets = max(1, int(counts.sum()) // BUCKET_ROWS)

    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets))
    dealt = pieces.withColumn("__bucket", bucket)
    before = dealt.groupBy("length", "__bucket").agg(F.count(F.lit(1)).alias("n"))
    before = before.select(
        "length", "__bucket", (F.sum("n").over(_window("length").orderBy("__bucket")) - F.col("n")).alias("__before")
    )
    numbered = (
        dealt.withColumn("__own", F.row_number().over(_window("__bucket", "length").orderBy("doc_id", "piece")))
        .join(before, ["length", "__bucket"])
        .withColumn("__number", F.col("__before") + F.col("__own") - 1)
    )
    names = pieces.columns
    schema = T.StructType([pieces.schema[c] for c in names] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches):
        t = table.value
        for batch in batches:
            number = batch.column("__number").to_numpy(zero_copy_only=False)
            at = np.searchsorted(t["key"], (batch.column("length").to_numpy(zero_copy_only=False) << 44) + number, "right") - 1
            new = [pa.array(t["sequence"][at] + number), pa.array(t["offset"][at])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *new], schema.names)

    return numbered.select(*map(column, names), "__number").mapInArrow(place, schema)


def _window(*columns: str):
    from pyspark.sql import Window

    return Window.partitionBy(*columns)


def pack_documents(docs: DataFrame, path: str | None = None, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Every piece of ``docs`` with its ids, sequence and place: sort by sequence_id and offset to get the sequences."""
    pieces = materialise(token_pieces(docs, path, size, end_id), "token-pieces")
    return pack(pieces, size)
