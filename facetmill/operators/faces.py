"""Cards to faces: one row per card and face.

A card either carries its own face values (``card_faces`` is null) or an array
of faces. :func:`select_faces` shapes both kinds in one pass over the input
without a shuffle; :func:`union_faces` and :func:`join_faces` combine the two
kinds after splitting them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..schemas import FACE_PATHS, face_columns, field_or_null, has_field
from .joins import full_outer_using, select_or_null

ONLY_FACE = "0"


def _face_type(bronze: DataFrame) -> StructType | None:
    """Element type of ``card_faces``, if the input has faces at all."""
    if "card_faces" not in bronze.columns:
        return None
    dtype = bronze.schema["card_faces"].dataType
    if isinstance(dtype, ArrayType) and isinstance(dtype.elementType, StructType):
        return dtype.elementType
    return None


def _values(schema: StructType, mode: str, under: str = "", dtype: str = "string") -> dict[str, Column]:
    return {name: field_or_null(schema, FACE_PATHS.get(name, name), under, dtype) for name in face_columns(mode)}


def _prices(bronze: DataFrame) -> list[Column]:
    return [field_or_null(bronze.schema, f"prices.{name}").alias(name) for name in ("usd", "usd_foil")]


def _columns(values: dict[str, Column]) -> list[Column]:
    return [value.alias(name) for name, value in values.items()]


def flat_cards(mode: str, bronze: DataFrame) -> DataFrame:
    """One row per card from its own values, face ``0``."""
    return bronze.select(
        "oracle_id",
        F.lit(ONLY_FACE).alias("card_face_number"),
        *_columns(_values(bronze.schema, mode)),
        *_prices(bronze),
    )


def single_faces(mode: str, bronze: DataFrame) -> DataFrame:
    """Cards without a face array."""
    if _face_type(bronze) is None:
        return flat_cards(mode, bronze)
    return flat_cards(mode, bronze.filter(F.col("card_faces").isNull()))


def explode_faces(bronze: DataFrame) -> DataFrame:
    """One row per array element with its position; card prices are repeated."""
    return bronze.filter(F.col("card_faces").isNotNull()).select(
        "oracle_id", F.posexplode("card_faces").alias("card_face_number", "face"), *_prices(bronze)
    )


def multi_faces(mode: str, bronze: DataFrame) -> DataFrame:
    """Faces of the cards that have a face array."""
    face = _face_type(bronze)
    if face is None:
        return flat_cards(mode, bronze).limit(0)
    return explode_faces(bronze).select(
        "oracle_id",
        F.col("card_face_number").cast("string").alias("card_face_number"),
        *_columns(_values(face, mode, "face")),
        "usd",
        "usd_foil",
    )


def union_faces(mode: str, bronze: DataFrame) -> DataFrame:
    """Both kinds by union: the two filters are complementary, so nothing can match."""
    return single_faces(mode, bronze).unionByName(multi_faces(mode, bronze))


def join_faces(mode: str, bronze: DataFrame) -> DataFrame:
    """Both kinds by full outer join on the columns that both really have.

    A field that cards or faces lack takes no part in the join; where both lack
    it, it is added as a typed null afterwards. Differs from the union only
    where a card and a face agree in every shared column and none of them is
    null: those two rows become one.
    """
    face = _face_type(bronze)
    single, multi = single_faces(mode, bronze), multi_faces(mode, bronze)
    if face is None:
        return single
    paths = {name: FACE_PATHS.get(name, name) for name in face_columns(mode)}
    of_card = [name for name, path in paths.items() if not has_field(bronze.schema, path)]
    of_face = [name for name, path in paths.items() if not has_field(face, path)]
    # Prices come from the card on both sides.
    joined = full_outer_using(single.drop(*of_card), multi.drop(*of_face))
    return select_or_null(joined, single.columns)


def select_faces(mode: str, bronze: DataFrame) -> DataFrame:
    """Both kinds in a single pass; an empty face array yields no row.

    Only the wanted face fields are zipped into the exploded array, so the scan
    skips the others, and the whole array is not repeated for every face.
    """
    face = _face_type(bronze)
    if face is None:
        return flat_cards(mode, bronze)
    names = face_columns(mode)
    own = _values(bronze.schema, mode)
    present = {
        name: value.alias(name)
        for name, value in _values(face, mode, "card_faces", "array<string>").items()
        if has_field(face, FACE_PATHS.get(name, name))
    }
    zipped = F.arrays_zip(*present.values()) if present else F.col("card_faces")
    cards = bronze.select(
        "oracle_id",
        F.col("card_faces").isNull().alias("is_single"),
        zipped.alias("faces"),
        *[own[name].alias(f"own_{name}") for name in names],
        *_prices(bronze),
    )
    opened = cards.select(
        *[c for c in cards.columns if c != "faces"], F.posexplode_outer("faces").alias("position", "face")
    ).filter(F.col("is_single") | F.col("position").isNotNull())

    def picked(name: str) -> Column:
        own_value = F.when(F.col("is_single"), F.col(f"own_{name}"))
        return own_value.otherwise(F.col(f"face.{name}")) if name in present else own_value

    return opened.select(
        "oracle_id",
        F.coalesce(F.col("position").cast("string"), F.lit(ONLY_FACE)).alias("card_face_number"),
        *[picked(name).alias(name) for name in names],
        "usd",
        "usd_foil",
    )
