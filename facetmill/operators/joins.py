"""Combining frames whose columns differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..schemas import field_or_null


def select_or_null(df: DataFrame, columns: Sequence[str], dtype: str = "string") -> DataFrame:
    """``columns`` in order, each cast to ``dtype`` or a typed null where ``df`` lacks it."""
    return df.select(*[field_or_null(df.schema, name, dtype=dtype).alias(name) for name in columns])


def full_outer_using(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer equi-join on every column both sides have.

    Adaptive execution does not split a full outer join where one key is hot; the
    default path of the jobs uses none.
    """
    keys = [c for c in left.columns if c in right.columns]
    if not keys:
        raise ValueError("the two sides share no column")
    return left.join(right, keys, "outer")
