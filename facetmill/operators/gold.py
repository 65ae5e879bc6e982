"""Face rows to one wide row per item."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import MODEL_TEXT_COLUMNS, NULL_TOKEN, gold_targets


def distinct_faces(silver: DataFrame) -> DataFrame:
    """The face numbers that occur; a null counts as one."""
    return silver.select("card_face_number").distinct()


def observe_faces(silver: DataFrame, into: Observation) -> DataFrame:
    """``silver``, whose face numbers are counted into ``into`` when it is computed.

    Five small values: how often 0, 1, other numbers and none occur, and whether the
    others are one. A task that runs twice may count twice; only what is zero matters.
    """
    number = F.col("card_face_number")
    other = F.when(~number.isin("0", "1"), number)
    return silver.observe(
        into,
        F.count_if(number == "0").alias("faces_0"),
        F.count_if(number == "1").alias("faces_1"),
        F.count_if(number.isNull()).alias("faces_null"),
        F.min(other).alias("faces_other_min"),
        F.max(other).alias("faces_other_max"),
    )


def observed_faces(seen: Mapping[str, object]) -> list[str | None]:
    """Up to five of the different face numbers behind observed values (or their texts): all of them if under three."""
    found: list[str | None] = [n for n in ("0", "1") if int(seen[f"faces_{n}"])]
    found += [None] * bool(int(seen["faces_null"]))
    others = {seen["faces_other_min"], seen["faces_other_max"]} - {None, "None"}
    return found + sorted(map(str, others))


def first_per_group(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """One row per group: the first by ``order_by``, then by the values themselves.

    A single ordered minimum, so groups reduce map-side and one row wins as a
    whole, whatever order rows arrive in. Nulls sort first.
    """
    ranked = F.min(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)], *columns))
    return df.groupBy(*keys).agg(ranked.alias("first")).select(*keys, *[f"first.{c}" for c in columns])


def pivot_faces(mode: str, silver: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """One row per ``oracle_id``: face 0 as is, face 1 with prefix ``second_``.

    Where several rows share item and face, the first by ``order_by`` and then
    by value is taken. The two face numbers are fixed, and a hot item reduces
    map-side. Rows of any other number fail the job that reads the result: they
    have no columns to go to.
    """
    number = F.coalesce("card_face_number", F.lit("null"))
    targets = gold_targets(mode)
    columns = [*targets, "price"]
    ranked = F.struct(
        *[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)],
        *[F.col(c).cast("string").alias(c) for c in columns],
    )
    faces = silver.groupBy("oracle_id").agg(
        F.min(F.when(number == "0", ranked)).alias("front"),
        F.min(F.when(number == "1", ranked)).alias("back"),
        F.min(F.when(~number.isin("0", "1"), number)).alias("stray"),
    )
    message = F.concat(F.lit("no columns for face number "), "stray")
    return faces.filter(F.assert_true(F.col("stray").isNull(), message).isNull()).select(
        "oracle_id",
        *[F.col(f"front.{c}").alias(c) for c in targets],
        *[F.col(f"back.{c}").alias(f"second_{c}") for c in targets],
        F.col("front.price").alias("price"),
    )


def pad_second_face(mode: str, silver: DataFrame) -> DataFrame:
    """Every row as it is, with empty ``second_`` columns."""
    targets = gold_targets(mode)
    return silver.select(
        "oracle_id",
        *targets,
        *[F.lit(None).cast("string").alias(f"second_{c}") for c in targets],
        "price",
    )


def fill_null_token(df: DataFrame) -> DataFrame:
    """Nulls of the model's text columns become the null token; others stay null."""
    return df.fillna({c: NULL_TOKEN for c in MODEL_TEXT_COLUMNS if c in df.columns})


def gold_transform(
    mode: str,
    silver: DataFrame,
    widen: str = "auto",
    order_by: Sequence[str] = (),
    numbers: Sequence[str | None] | None = None,
) -> DataFrame:
    """One row per item, ready for the model.

    With ``widen="auto"`` the whole input decides: exactly two face numbers
    pivot, anything else is padded row by row. That test reads one column and
    fetches at most three values; ``numbers``, if they are known, spare it. ``pivot``
    and ``pad`` skip it. Two numbers other than 0 and 1 are an error.
    """
    if widen == "auto":
        if numbers is None:
            numbers = [row[0] for row in distinct_faces(silver).limit(3).collect()]
        if len(numbers) == 2 and set(numbers) != {"0", "1"}:
            raise ValueError(f"two face numbers, but not 0 and 1: {sorted(map(str, numbers))}")
        widen = "pivot" if len(numbers) == 2 else "pad"
    if widen == "pivot":
        gold = pivot_faces(mode, silver, order_by)
    elif widen == "pad":
        gold = pad_second_face(mode, silver)
    else:
        raise ValueError(f"unknown widen {widen!r}, expected auto, pivot or pad")
    return fill_null_token(gold)
