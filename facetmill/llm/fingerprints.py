"""Document fingerprints as invertible Bloom lookup sketches, in DataFrame functions only.

A text is a set of paragraphs, each with a 64-bit digest. A paragraph is a line; a
longer line is cut into sentences of any script, and a longer sentence behind words
that their own hash picks (behind characters, where nothing parts the words), so a
change moves no cut but those next to it.

The sketch has cells of a count, the exclusive or of digests, and that of their
checks; a digest is put into one cell of each of three parts. Sketches of two texts
are subtracted cell by cell: what both have cancels out, and peeling cells with a
single digest recovers the differing ones. Texts of many paragraphs have several
sketches, one for each class of digests by their leading bits. Digests are kept in
order, so a class is a stretch of them that is found by halving: the work for a
paragraph follows the logarithm of the text's length. Where peeling a class gets
stuck, its digests are sketched again with more cells, up to more than all of them
need. Two texts are compared by as many classes as the longer one has, so what is
subtracted are sketches of the digests, the fingerprints themselves where both have
equally many.

Defined cases: null and empty texts have no paragraphs; two texts without any are
alike (1), one without any and one with some are not (0); repeated paragraphs of a
text count once; repeated rows have equal fingerprints; ties do not occur, as digests
are a set; extra columns pass through ``fingerprint``, and input columns named like an
added one are replaced; a table without rows gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetmill.session import materialise

from .batches import column, let, others

# Cells of a sketch, and how many paragraphs one sketch is meant for.
CELLS, LOAD = 36, 12
# Characters from which a line is cut into sentences, and a sentence into pieces.
LONG = 600
# One word (or pair of characters) of so many is followed by a cut.
PIECE = 8
# Characters of a word from which it is taken for a text of a script without spaces.
LONG_WORD = 60
ROUNDS = 12

ADDED = ["digests", "fingerprint"]

_KEYS = "array<struct<digest:bigint,side:int>>"


def _cut_behind(parts: Column, picked: Column, between: str) -> Column:
    """``parts`` joined again, but for the places behind those that are picked."""
    marked = F.transform(F.arrays_zip(parts.alias("part"), picked.alias("picked")), lambda x: F.concat(x["part"], F.when(x["picked"], F.lit("\n")).otherwise(F.lit(between))))
    return F.filter(F.split(F.array_join(marked, ""), "\n"), lambda x: F.trim(x) != "")


def _picked(value: Column) -> Column:
    return F.pmod(F.xxhash64(value, F.lit("cut")), F.lit(PIECE).cast("bigint")) == 0


def _pieces(sentence: Column) -> Column:
    def of_word(word: Column) -> Column:
        pairs = lambda chars: F.transform(chars, lambda c, i: _picked(F.concat(F.coalesce(F.get(chars, i - 1), F.lit("")), c)))
        cut = let(F.split(word, ""), lambda chars: _cut_behind(chars, pairs(chars), ""))
        return F.when(F.char_length(word) > LONG_WORD, cut).otherwise(F.array(word))

    words = F.flatten(F.transform(F.split(sentence, " "), of_word))
    return let(words, lambda w: _cut_behind(w, F.transform(w, _picked), " "))


def paragraphs(text: Column) -> Column:
    """The text's paragraphs in order."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x != "")
    sentences = lambda line: F.filter(F.split(line, "(?<=[.!?\u3002\uff01\uff1f\u061f\u06d4\u0964]) *"), lambda x: F.trim(x) != "")
    cut = lambda line: F.flatten(F.transform(sentences(line), lambda s: F.when(F.char_length(s) > LONG, _pieces(s)).otherwise(F.array(s))))
    return F.flatten(F.transform(lines, lambda x: F.when(F.char_length(x) > LONG, cut(x)).otherwise(F.array(x))))


def digests(text: Column) -> Column:
    """Different 64-bit digests of the text's paragraphs, sorted."""
    return F.sort_array(F.array_distinct(F.transform(paragraphs(text), lambda x: F.xxhash64(x))))


def classes(own: Column) -> Column:
    """Number of sketches for a set of digests: a power of two."""
    return F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.size(own) / LOAD, F.lit(1.0))))).cast("int")


def _first_from(own: Column, limit: Column) -> Column:
    """Number of sorted digests below ``limit``, by halving."""
    size = F.size(own)
    start = F.struct(F.lit(0).alias("low"), size.alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        below = F.coalesce(F.get(own, middle) < limit, F.lit(False))
        narrowed = F.struct(F.when(below, middle + 1).otherwise(s["low"]).alias("low"), F.when(below, s["high"]).otherwise(middle).alias("high"))
        return let(narrowed, lambda new: F.when(s["low"] < s["high"], new).otherwise(s))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(size + 1)).cast("int"))
    return F.aggregate(steps, start, halve, lambda s: s["low"])


def _limit(k: Column, n: Column) -> Column:
    """The smallest digest of class ``k`` of ``n`` (not for class 0 and beyond the last)."""
    bits = F.round(F.log2(n)).cast("int")
    return F.call_function("shiftleft", k.cast("bigint") - F.floor(n / 2).cast("bigint"), F.lit(64) - bits)


def _of_class(own: Column, k: Column, n: Column) -> Column:
    """The digests whose leading bits are ``k``, of ``n`` classes: a stretch of the sorted digests."""
    first = F.when(k == 0, F.lit(0)).otherwise(_first_from(own, _limit(k, n)))
    end = F.when(k >= n - 1, F.size(own)).otherwise(_first_from(own, _limit(k + 1, n)))
    return let(first, lambda f: F.slice(own, f + 1, end - f))


def _check(digest: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(digest, F.lit("check")), 32)


def _place(digest: Column, part: int, third: Column) -> Column:
    return (F.pmod(F.xxhash64(digest, F.lit(part)), third.cast("bigint")) + third * part).cast("int")


def _entry(digest: Column, n: Column, third: Column) -> Column:
    return F.struct(n.alias("n"), digest.alias("key"), _check(digest).alias("check"), *[_place(digest, p, third).alias(f"c{p}") for p in range(3)])


def sketch(own: Column, third: Column) -> Column:
    """Cells (n, key, check) of a set of digests; ``third`` is a third of their number."""
    empty = F.struct(F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("key"), F.lit(0).cast("bigint").alias("check"))
    put = lambda c, e: F.struct((c["n"] + e["n"]).alias("n"), c["key"].bitwiseXOR(e["key"]).alias("key"), c["check"].bitwiseXOR(e["check"]).alias("check"))

    def part(entries: Column, p: int) -> Column:
        return F.transform(F.sequence(third * p, third * (p + 1) - 1), lambda j: F.aggregate(F.filter(entries, lambda e: e[f"c{p}"] == j), empty, put))

    entries = F.transform(own, lambda d: _entry(d, F.lit(1), third))
    return let(entries, lambda e: F.concat(*[part(e, p) for p in range(3)]))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(
        a, b,
        lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["key"].bitwiseXOR(y["key"]).alias("key"), x["check"].bitwiseXOR(y["check"]).alias("check")),
    )


def peel(cells: Column, third: Column) -> Column:
    """(digest, side) of what the cells hold; null where peeling gets stuck."""

    def pure(now: Column) -> Column:
        alone = F.filter(now, lambda c: (F.abs(c["n"]) == 1) & (c["check"] == _check(c["key"])))
        return F.array_distinct(F.transform(alone, lambda c: _entry(c["key"], c["n"], third)))

    take = lambda x, e: F.struct((x["n"] - e["n"]).alias("n"), x["key"].bitwiseXOR(e["key"]).alias("key"), x["check"].bitwiseXOR(e["check"]).alias("check"))

    def without(now: Column, gone: Column, p: int) -> Column:
        """The cells of one part without what is gone."""
        here = lambda j: F.filter(gone, lambda e: e[f"c{p}"] == j + third * p)
        return F.transform(F.slice(now, third * p + 1, third), lambda c, j: F.aggregate(here(j), c, take))

    def step(state: Column, _: Column) -> Column:
        def peeled(gone: Column) -> Column:
            found = F.transform(gone, lambda e: F.struct(e["key"].alias("digest"), e["n"].alias("side")))
            left = F.concat(*[without(state["cells"], gone, p) for p in range(3)])
            return F.struct(left.alias("cells"), F.concat(state["keys"], found).alias("keys"), (F.size(gone) == 0).alias("ended"))

        return F.when(state["ended"], state).otherwise(let(pure(state["cells"]), peeled))

    start = F.struct(cells.alias("cells"), F.array().cast(_KEYS).alias("keys"), F.lit(False).alias("ended"))
    done = lambda s: F.when(~F.exists(s["cells"], lambda c: (c["n"] != 0) | (c["key"] != 0)), s["keys"])
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, done)


def difference(a: Column, b: Column) -> Column:
    """(digest, side) of what only one of two sets of digests has: side 1 for ``a``, -1 for ``b``."""

    def at_size(x: Column, y: Column, third: Column) -> Column:
        return peel(subtract(sketch(x, third), sketch(y, third)), third)

    def exact(x: Column, y: Column) -> Column:
        only = lambda p, q, side: F.transform(F.array_except(p, q), lambda d: F.struct(d.alias("digest"), F.lit(side).alias("side")))
        return F.concat(only(x, y, 1), only(y, x, -1))

    def of_class(x: Column, y: Column) -> Column:
        ample = (F.size(x) + F.size(y)) + CELLS // 3
        # The last is reached only if two sets differ where even ample sketches get stuck.
        return F.coalesce(at_size(x, y, F.lit(CELLS // 3)), at_size(x, y, F.lit(CELLS)), at_size(x, y, ample), exact(x, y))

    n = F.greatest(classes(a), classes(b))

    def all_classes(n: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda k: let(F.struct(_of_class(a, k, n).alias("x"), _of_class(b, k, n).alias("y")), lambda s: of_class(s["x"], s["y"])),
        )
        return F.flatten(each)

    return let(n, all_classes)


def likeness(a: Column, b: Column) -> Column:
    """Share of paragraphs that two sets of digests have in common: 1 equal, 0 nothing."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(1.0 - F.size(difference(a, b)) / both)


def as_text(own: Column) -> Column:
    """The sketches of a set of digests: their number, then all cells, empty ones left blank."""
    third = F.lit(CELLS // 3)

    def shown(n: Column) -> Column:
        cells = F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda k: sketch(_of_class(own, k, n), third)))
        texts = F.transform(cells, lambda c: F.when(c["n"] == 0, F.lit("")).otherwise(F.concat_ws(".", c["n"], F.hex(c["key"]), F.hex(c["check"]))))
        return F.concat(n, F.lit(":"), F.array_join(texts, ","))

    return let(classes(own), shown)


def fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with digests and fingerprint."""
    out = docs.select(*map(column, others(docs, ADDED)), digests(column(text)).alias("digests"))
    return out.withColumn("fingerprint", as_text(F.col("digests")))


def with_next(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Each different non-null ``key`` with the next larger one, the largest with the smallest.

    Keys are dealt by range and ordered within their range; only the ends of the
    ranges are looked at together.
    """
    ranged = docs.select(F.col(key).alias("key")).filter("key is not null").distinct().repartitionByRange("key")
    ids = materialise(ranged.withColumn("part", F.spark_partition_id()), "ordered-keys")
    inside = ids.withColumn("next", F.lead("key").over(Window.partitionBy("part").orderBy("key")))
    ends = ids.groupBy("part").agg(F.min("key").alias("low"))
    order = Window.orderBy("part")
    ends = ends.select("part", F.coalesce(F.lead("low").over(order), F.min("low").over(Window.partitionBy())).alias("follows"))
    return inside.join(F.broadcast(ends), "part").select(F.col("key").alias(key), F.coalesce("next", "follows").alias("next"))
