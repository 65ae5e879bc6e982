"""Merkle manifest of a table: each row a leaf, each group of rows a tree, the groups' roots a tree above them.

A leaf's place is its rank among the ids of its group. Ranks come from bitmaps and
not from sorting: ids are set as bits of 64-bit words, the non-empty words of a group
are merged (``bit_or``, map-side first) and kept as a directory that says for each
word how many rows stand before it. A row asks for its word and counts the bits below
its own. The counts in front of a word are added up over three levels of the id's
high bits, so no task sees more than 65,536 words or parts of one group.

Leaves are then dealt out by place: ``BLOCK`` consecutive ones make an array of
slots, in which three levels of the tree are reduced at once; the blocks' digests are
the slots of the next round. On the way back every block hands its siblings down, so
a proof is put together where its leaf is. Nothing is collected but the size of the
largest group.

Defined cases: a null field is hashed as ``-``; a null group is a group of its own and
the first; a null id stands before all others. Rows with equal ids are ordered by
their leaf's digest, and equal rows take places one after another (they are
interchangeable). Ids must be whole numbers, of any sign. Very long texts are hashed
in place and leave only their digest. A table without rows has no leaves. Only the
columns that are named are read, so further ones may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetmill.session import materialise

from .batches import column

ARITY = 8
# Slots of an array: three levels of the tree.
LEVELS = 3
BLOCK = ARITY**LEVELS

WORD_BITS = 6
# The id's bits above a word's, in the steps in which the rows before a word are counted.
STEPS = (10, 16, 16)

STEP = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def field(value: Column) -> Column:
    """A field as it is hashed: its length in bytes and its value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return digest(F.concat(*map(field, values)))


def group_key(value: Column) -> Column:
    """A group as a text that is never null and in the order of its bytes, null first."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def _before(size: str, parts: Sequence[str], order: Sequence[str]) -> Column:
    """Sum of ``size`` over the rows in front within ``parts``."""
    window = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(size).over(window), F.lit(0)).cast("long")


def word_directory(leaves: DataFrame) -> DataFrame:
    """The bitmaps of all groups: for each non-empty word its bits, rows and the rows before it.

    Takes ``grp`` and ``id``; gives ``grp``, ``word`` (null for null ids), ``bits``, ``n``, ``before``.
    """
    word = F.shiftright("id", WORD_BITS)
    bit = F.expr("shiftleft(1L, cast(id & 63 as int))")
    words = leaves.groupBy("grp", word.alias("word")).agg(F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("n"))
    words = materialise(words, "manifest-words")
    # Parts of the directory from fine to coarse: the rows of a part before each of its children.
    shifts = [sum(STEPS[: k + 1]) for k in range(len(STEPS))]
    child, counted = "word", words
    for k, shift in enumerate(shifts):
        part = f"part{k}"
        counted = counted.withColumn(part, F.shiftright("word", shift))
        sums = counted.groupBy("grp", child, part).agg(F.sum("n").alias("n"), F.min("word").alias("word")) if k else counted
        placed = sums.withColumn(f"before{k}", _before("n", ["grp", part], [child]))
        if k:
            here = placed.select(F.col("grp").alias("g"), F.col(child).alias("c"), f"before{k}", part)
            directory = directory.join(here, (F.col("grp") == F.col("g")) & F.col(child).eqNullSafe(F.col("c"))).drop("g", "c")
        else:
            directory = placed.select("grp", "word", "bits", "n", part, "before0")
        counted, child = sums, part
    # Above the last step, a group has few parts; null ids are one in front of them.
    top = counted.groupBy("grp", child).agg(F.sum("n").alias("n")).withColumn("base", _before("n", ["grp"], [child]))
    top = top.select(F.col("grp").alias("g"), F.col(child).alias("c"), "base")
    directory = directory.join(top, (F.col("grp") == F.col("g")) & F.col(child).eqNullSafe(F.col("c")))
    total = F.col("base") + sum(F.col(f"before{k}") for k in range(len(shifts)))
    return directory.select("grp", "word", "bits", "n", total.alias("before"))


def _repeated() -> Column:
    return F.col("word").isNull() | (F.col("n") > F.bit_count("bits"))


def with_places(leaves: DataFrame, directory: DataFrame) -> DataFrame:
    """``leaves`` (``grp``, ``id``, ``leaf``, any others) with ``at``, their number within the group.

    Both tables are read more than once: hand over written ones.
    """
    names = leaves.columns
    found = directory.select(F.col("grp").alias("g"), "word", "bits", "n", "before")
    plain = leaves.join(found, (F.col("grp") == F.col("g")) & (F.shiftright("id", WORD_BITS) == F.col("word")))
    below = F.expr("bit_count(bits & ~shiftleft(-1L, cast(id & 63 as int)))")
    placed = plain.filter(~_repeated()).select(*names, (F.col("before") + below).cast("long").alias("at"))
    if directory.filter(_repeated()).isEmpty():
        return placed
    return placed.unionByName(_repeated_places(leaves, directory.filter(_repeated())))


# Copies of one row that are made at once.
COPIES = 4096


def _repeated_places(leaves: DataFrame, words: DataFrame) -> DataFrame:
    """Places of the rows whose word holds an id more than once, and of rows without id.

    Equal rows are counted map-side; different ones are told apart by the first four
    digits of their digest first, so rows of one id do not meet in one task.
    """
    names = leaves.columns
    found = words.select(F.col("grp").alias("g"), "word", "before")
    same_word = F.shiftright("id", WORD_BITS).eqNullSafe(F.col("word"))
    rows = leaves.join(found, (F.col("grp") == F.col("g")) & same_word).drop("g")
    rows = rows.groupBy(*names, "word", "before").agg(F.count(F.lit(1)).alias("n"))
    rows = materialise(rows.withColumn("head", F.substring("leaf", 1, 4)), "manifest-repeated")
    heads = rows.groupBy("grp", "word", "id", "head").agg(F.sum("n").alias("n"))
    heads = heads.select(
        F.col("grp").alias("g"), F.col("id").alias("i"), F.col("head").alias("h"), _before("n", ["grp", "word"], ["id", "head"]).alias("ahead")
    )
    same = (F.col("grp") == F.col("g")) & F.col("id").eqNullSafe(F.col("i")) & (F.col("head") == F.col("h"))
    first = rows.withColumn("within", _before("n", ["grp", "word", "id", "head"], ["leaf"])).join(heads, same)
    first = first.select(*names, "n", (F.col("before") + F.col("ahead") + F.col("within")).alias("first"))
    runs = first.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES)))).withColumn("start", F.col("run") * COPIES)
    ends = F.least(F.col("start") + COPIES, F.col("n")) - 1
    copies = runs.repartition("grp", "id", "leaf", "run").withColumn("copy", F.explode(F.sequence("start", ends)))
    return copies.select(*names, (F.col("first") + F.col("copy")).alias("at"))


def _reduced(level: Column) -> Column:
    """Every ``ARITY`` consecutive digests become theirs; the last may be fewer."""
    starts = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / ARITY).cast("int"))
    return F.transform(starts, lambda k: digest(F.array_join(F.slice(level, k * ARITY + 1, ARITY), "")))


def blocks(nodes: DataFrame, carried: Sequence[str], label: str) -> DataFrame:
    """Slot arrays of ``nodes`` (``grp``, ``at``, ``of`` nodes on this level of the group, ``node``, carried columns).

    Gives ``grp``, ``block``, ``of``, the items' carried columns in order, the digests
    of each level (``level0`` on) and ``top``, the block's own.
    """
    slot = F.struct((F.col("at") % BLOCK).cast("int").alias("slot"), "node", *carried)
    dealt = nodes.groupBy("grp", F.floor(F.col("at") / BLOCK).cast("long").alias("block"), "of").agg(F.array_sort(F.collect_list(slot)).alias("slots"))
    out = dealt.withColumn("level0", F.col("slots.node"))
    for k in range(LEVELS):
        level = F.col(f"level{k}")
        out = out.withColumn(f"level{k + 1}", F.when(F.col("of") > ARITY**k, _reduced(level)).otherwise(level))
    items = F.transform("slots", lambda s: F.struct(F.lit(True).alias("item"), *[s[c].alias(c) for c in carried]))
    levels = [f"level{k}" for k in range(LEVELS)]
    return materialise(out.select("grp", "block", "of", items.alias("items"), *levels, F.get(f"level{LEVELS}", F.lit(0)).alias("top")), label)


def climb(nodes: DataFrame, carried: Sequence[str], largest: int, label: str) -> list[DataFrame]:
    """Rounds of :func:`blocks` until each group of at most ``largest`` nodes is one block."""
    rounds = [blocks(nodes, carried, f"{label}-0")]
    while largest > BLOCK:
        largest = -(-largest // BLOCK)
        above = rounds[-1].select("grp", F.col("block").alias("at"), F.ceil(F.col("of") / BLOCK).cast("long").alias("of"), F.col("top").alias("node"))
        rounds.append(blocks(above, [], f"{label}-{len(rounds)}"))
    return rounds


def _siblings(slot: Column) -> Column:
    """Of a slot: its run's other digests, left and right of it, on every level that is reduced."""
    steps = []
    for k in range(LEVELS):
        level, own = F.col(f"level{k}"), F.shiftright(slot, 3 * k)
        first = own - own % ARITY
        left = F.array_join(F.slice(level, first + 1, own - first), "")
        right = F.array_join(F.slice(level, own + 2, ARITY - 1 - (own - first)), "")
        steps.append(F.when(F.col("of") > ARITY**k, F.struct(left.alias("left"), right.alias("right"))))
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def descend(rounds: Sequence[DataFrame], tops: DataFrame) -> DataFrame:
    """The nodes of the first round with their carried columns, ``node``, ``at`` and ``path``, siblings up to the root.

    ``tops`` has for each group its ``path`` above the group's root and any columns to hand down.
    """
    paths, handed = tops.withColumn("block", F.lit(0).cast("long")), [c for c in tops.columns if c not in ("grp", "path")]
    for held in reversed(rounds):
        slots = F.transform("items", lambda item, s: F.struct(item.alias("item"), F.get("level0", s).alias("node"), (F.col("block") * BLOCK + s).alias("at"), _siblings(s).alias("own")))
        below = held.select("grp", "block", F.explode(slots).alias("slot")).join(paths, ["grp", "block"])
        carried = [F.col(f"slot.item.{c}").alias(c) for c in held.schema["items"].dataType.elementType.names if c != "item"]
        paths = below.select("grp", *carried, "slot.node", F.col("slot.at").alias("block"), F.concat("slot.own", "path").alias("path"), *handed)
    return paths.withColumnRenamed("block", "at")


def proof(path: Column) -> Column:
    """All siblings of a path as one text, in order."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def folded(node: Column, path: Column) -> Column:
    """The root that a node and its siblings give."""
    return F.aggregate(path, node, lambda own, s: digest(F.concat(s["left"], own, s["right"])))


def numbered_groups(groups: DataFrame) -> DataFrame:
    """``groups`` (``grp``, one row each, any others) with ``at``, their number in the order of their bytes.

    Dealt out by range; only the ranges' sizes are added up together.
    """
    ranged = materialise(groups.repartitionByRange("grp").withColumn("range", F.spark_partition_id()), "manifest-groups")
    sizes = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).withColumn("ahead", _before("n", [], ["range"]))
    within = F.row_number().over(Window.partitionBy("range").orderBy("grp")) - 1
    return ranged.withColumn("own", within).join(sizes.drop("n"), "range").select(*groups.columns, (F.col("ahead") + F.col("own")).cast("long").alias("at"))


def build(leaves: DataFrame) -> DataFrame:
    """Every leaf of ``leaves`` (``grp``, ``id``, ``leaf``, any others) with its place and its path.

    Adds ``at``, ``subroot``, ``root`` and ``path``: array of ``left`` and ``right``,
    the siblings' digests on end, from the leaf's run up to the root's.
    """
    leaves = materialise(leaves, "manifest-leaves")
    carried = [c for c in leaves.columns if c not in ("grp", "leaf")]
    directory = materialise(word_directory(leaves), "manifest-directory")
    sizes = materialise(directory.groupBy("grp").agg(F.sum("n").alias("of")), "manifest-sizes")
    totals = sizes.agg(F.count(F.lit(1)).alias("groups"), F.max("of").alias("largest")).first()
    placed = with_places(leaves, directory).join(sizes, "grp").withColumnRenamed("leaf", "node")
    rounds = climb(placed, carried, totals["largest"] or 0, "manifest-blocks")
    # The groups' roots are the leaves of the tree above; their group takes the place of an item.
    subroots = numbered_groups(rounds[-1].select("grp", F.col("top").alias("node")))
    upper = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "at", F.lit(totals["groups"]).cast("long").alias("of"), "node")
    above = climb(upper, ["name"], totals["groups"], "manifest-roots")
    root = above[-1].select("grp", F.array().cast(STEP).alias("path"), F.col("top").alias("root"))
    tops = materialise(descend(above, root).select(F.col("name").alias("grp"), "path", F.col("node").alias("subroot"), "root"), "manifest-tops")
    return descend(rounds, tops).withColumnRenamed("node", "leaf")


def leaves_of(docs: DataFrame, fields: Sequence[str], id_column: str = "doc_id", group: str = "lang", **extra: Column) -> DataFrame:
    """One row per row of ``docs``: group, id, the digest of its ``fields``, and ``extra`` columns."""
    if not isinstance(docs.schema[id_column].dataType, T.IntegralType):
        raise TypeError(f"{id_column} must be a whole number")
    hashed = leaf_digest([column(c) for c in fields])
    return docs.select(group_key(column(group)).alias("grp"), column(id_column).cast("long").alias("id"), hashed.alias("leaf"), *[v.alias(k) for k, v in extra.items()])


def verified(manifest: DataFrame, leaf: str = "leaf") -> DataFrame:
    """``manifest`` with ``folded_root``, what ``leaf`` and the path give, and ``verified``: that it is the root."""
    return manifest.withColumn("folded_root", folded(column(leaf), F.col("path"))).withColumn("verified", F.col("folded_root") == F.col("root"))
