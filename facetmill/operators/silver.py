"""Bronze records to cleaned face rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import corner_value, price_fallback, strip_newlines, strip_parenthetical
from ..schemas import silver_columns
from .faces import join_faces, select_faces, union_faces

_COMBINE = {"explode": select_faces, "union": union_faces, "join": join_faces}


def silver_transform(mode: str, bronze: DataFrame, combine: str = "explode") -> DataFrame:
    """One cleaned row per card and face.

    ``combine`` selects how cards with and without a face array come together:
    ``explode`` (one pass), ``union``, or ``join`` (full outer join).
    """
    columns = silver_columns(mode)
    if combine not in _COMBINE:
        raise ValueError(f"unknown combine {combine!r}, expected one of {', '.join(_COMBINE)}")
    faces = _COMBINE[combine](mode, bronze)
    return faces.withColumns(
        {
            "oracle_text": strip_parenthetical(strip_newlines(F.col("oracle_text"))),
            "bottomright_value": corner_value(
                F.col("power"), F.col("toughness"), F.col("loyalty"), F.col("defense")
            ),
            "price": price_fallback(F.col("usd"), F.col("usd_foil")),
        }
    ).select(*columns)
