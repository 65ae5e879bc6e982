"""Text cleaning and derived face values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Characters a CSV round trip trims from both ends of a value.
_TRIMMED = "".join(chr(code) for code in range(0x21))


def strip_newlines(text: Column) -> Column:
    """Each newline becomes one space; a text without one is not copied."""
    return F.replace(text, F.lit("\n"), F.lit(" "))


def strip_parenthetical(text: Column) -> Column:
    """Remove every shortest ``( ... )`` run; run after :func:`strip_newlines`.

    Texts without a parenthesis skip the pattern.
    """
    return F.when(text.contains("("), F.regexp_replace(text, r"\(.*?\)", "")).otherwise(text)


def corner_value(power: Column, toughness: Column, loyalty: Column, defense: Column) -> Column:
    """``power/toughness`` when both are known, else loyalty, else defense."""
    both = F.when(power.isNotNull() & toughness.isNotNull(), F.concat_ws("/", power, toughness))
    return F.coalesce(both, loyalty, defense)


def price_fallback(usd: Column, usd_foil: Column) -> Column:
    return F.coalesce(usd, usd_foil)


def _visible(text: Column) -> Column:
    """Whether a text starts and ends with a visible character.

    The end is looked at as a byte, which takes no counting of characters: all bytes of
    characters beyond ASCII are greater.
    """
    return (text >= "!") & (F.substring(text.cast("binary"), -1, 1) >= F.lit(b"!"))


def blank_to_null(text: Column) -> Column:
    """The value a delimited-file round trip returns: trimmed, and empty as null.

    Most values start and end with a visible character and pass unchanged, or do so
    without the spaces around them; only others are searched for each trimmed character.
    """
    spaceless = F.btrim(text)
    others = F.nullif(F.btrim(text, F.lit(_TRIMMED)), F.lit(""))
    return F.when(_visible(text), text).when(_visible(spaceless), spaceless).otherwise(others)


def normalise_strings(df: DataFrame) -> DataFrame:
    """:func:`blank_to_null` on every string column."""
    return df.select(
        *[
            blank_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
