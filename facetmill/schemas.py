"""Record layouts, column lists and modes shared by every step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# Modes, face columns and tokens that results depend on.
MODES = ("train", "predict", "test")
FACE_TEXT_COLUMNS = ["mana_cost", "type_line", "oracle_text"]
FACE_STAT_COLUMNS = ["power", "toughness", "loyalty", "defense"]
DISPLAY_COLUMNS = ["name", "image_link"]
TARGET_COLUMNS = ["mana_cost", "type_line", "oracle_text", "bottomright_value"]
MODEL_TEXT_COLUMNS = TARGET_COLUMNS + [f"second_{c}" for c in TARGET_COLUMNS]
RESULT_COLUMNS = ["oracle_id", "name", "image_link", "label", "score", "price"]
NULL_TOKEN = "[Null]"

# Where a face column lives inside a card or a face struct.
FACE_PATHS = {"image_link": "image_uris.small"}


def _strings(*names: str) -> list[StructField]:
    return [StructField(name, StringType()) for name in names]


IMAGE_URIS = StructType(_strings("small"))

FACE_SCHEMA = StructType(
    _strings("name", *FACE_TEXT_COLUMNS, *FACE_STAT_COLUMNS) + [StructField("image_uris", IMAGE_URIS)]
)

BRONZE_SCHEMA = StructType(
    _strings("oracle_id")
    + FACE_SCHEMA.fields
    + [
        StructField("prices", StructType(_strings("usd", "usd_foil"))),
        StructField("card_faces", ArrayType(FACE_SCHEMA)),
        StructField("released_at", DateType()),
        StructField("reprint", BooleanType()),
        StructField("digital", BooleanType()),
        StructField("legalities", StructType(_strings("legacy"))),
    ]
)


def page_schema(record: StructType = BRONZE_SCHEMA) -> StructType:
    """Envelope of one landed result page around ``record`` rows."""
    return StructType(
        [
            StructField("request_id", StringType()),
            StructField("page_no", IntegerType()),
            StructField("object", StringType()),
            StructField("data", ArrayType(record)),
            StructField("has_more", BooleanType()),
            *_strings("next_page", "code", "status"),
        ]
    )


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {', '.join(MODES)}")
    return mode


def display_columns(mode: str) -> list[str]:
    """Columns that only the predict mode carries along."""
    return DISPLAY_COLUMNS if check_mode(mode) == "predict" else []


def face_columns(mode: str) -> list[str]:
    return display_columns(mode) + FACE_TEXT_COLUMNS + FACE_STAT_COLUMNS


def silver_columns(mode: str) -> list[str]:
    return ["oracle_id", *display_columns(mode), "card_face_number", *TARGET_COLUMNS, "price"]


def gold_targets(mode: str) -> list[str]:
    return display_columns(mode) + TARGET_COLUMNS


def gold_columns(mode: str) -> list[str]:
    targets = gold_targets(mode)
    return ["oracle_id", *targets, *[f"second_{c}" for c in targets], "price"]


def string_schema(columns: list[str]) -> StructType:
    return StructType(_strings(*columns))


def widened(declared: DataType, found: DataType) -> DataType:
    """``declared`` with all further fields of ``found``, at any depth."""
    if isinstance(declared, StructType) and isinstance(found, StructType):
        more = {f.name: f for f in found.fields}
        fields = [
            StructField(f.name, widened(f.dataType, more[f.name].dataType)) if f.name in more else f for f in declared.fields
        ]
        return StructType(fields + [f for f in found.fields if f.name not in declared.fieldNames()])
    if isinstance(declared, ArrayType) and isinstance(found, ArrayType):
        return ArrayType(widened(declared.elementType, found.elementType), declared.containsNull)
    return declared


def merged(first: DataType, second: DataType) -> DataType:
    """A type that holds the values of both: all fields of both at any depth, strings where types differ.

    Fields whose names differ only in case are one, under the first name.
    """
    if isinstance(first, StructType) and isinstance(second, StructType):
        more = {f.name.lower(): f for f in second.fields}
        fields = []
        for f in first.fields:
            other = more.pop(f.name.lower(), None)
            fields.append(StructField(f.name, merged(f.dataType, other.dataType)) if other else f)
        return StructType([*fields, *more.values()])
    if isinstance(first, ArrayType) and isinstance(second, ArrayType):
        return ArrayType(merged(first.elementType, second.elementType))
    return first if first == second else StringType()


def as_stored(wanted: DataType, stored: DataType | None) -> DataType:
    """``wanted`` with the types that ``stored`` has: what a reader of the stored table is to be given."""
    if stored is None:
        return wanted
    if isinstance(wanted, StructType) and isinstance(stored, StructType):
        own = {f.name.lower(): f.dataType for f in stored.fields}
        return StructType([StructField(f.name, as_stored(f.dataType, own.get(f.name.lower()))) for f in wanted.fields])
    if isinstance(wanted, ArrayType) and isinstance(stored, ArrayType):
        return ArrayType(as_stored(wanted.elementType, stored.elementType))
    return stored


def has_field(schema: DataType, path: str) -> bool:
    """Whether struct type ``schema`` holds the dotted ``path``."""
    for part in path.split("."):
        if not isinstance(schema, StructType) or part not in schema.fieldNames():
            return False
        schema = schema[part].dataType
    return True


def field_or_null(schema: DataType, path: str, under: str = "", dtype: str = "string") -> Column:
    """``path`` below column ``under`` as ``dtype``, or a typed null when ``schema`` lacks it."""
    if not has_field(schema, path):
        return F.lit(None).cast(dtype)
    return F.col(f"{under}.{path}" if under else path).cast(dtype)
