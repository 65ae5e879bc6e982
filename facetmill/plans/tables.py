"""Bronze records, pages and runs derived from the star-schema test tables.

A line item stands for one printing of a card. Its order gives date, flags and
price source, its part gives the texts. Printings of one order line share an
``oracle_id``; returned lines have two faces, the others carry their values on
the card. Nothing is grouped: every record comes from its own line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _money(value: Column) -> Column:
    return value.cast("decimal(12,2)").cast("string")


def _image(side: str) -> Column:
    return F.struct(F.concat(F.lit(f"https://img.example.com/{side}/"), _text("l_partkey"), F.lit(".jpg")).alias("small"))


def _front() -> dict[str, Column]:
    reminder = F.when(F.col("l_linenumber") > 4, " (reminder\ntext)").otherwise("")
    text = F.concat("p_name", F.lit("\nGain ("), "l_returnflag", F.lit(") "), "l_linestatus", reminder)
    return {
        "name": F.col("p_name"),
        "mana_cost": F.concat(F.lit("{"), _text("l_linenumber"), F.lit("}")),
        "type_line": F.concat_ws(" ", "p_type", "p_brand"),
        "oracle_text": F.when(F.col("p_size") < 5, " (plain) ").otherwise(text),
        "power": F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("int").cast("string")),
        "toughness": F.when(F.col("l_returnflag") != "N", _text("p_size")),
        "loyalty": F.when(F.col("l_returnflag") == "N", _text("p_size")),
        "defense": F.when(F.col("l_discount") >= 0.05, _text("p_size")),
        "image_uris": _image("front"),
    }


def _back() -> dict[str, Column]:
    missing = F.lit(None).cast("string")
    return {
        "name": F.col("p_brand"),
        "mana_cost": F.when(F.col("l_linenumber") > 3, F.concat(F.lit("{"), _text("p_size"), F.lit("}"))),
        "type_line": F.concat_ws(" ", "p_brand", "l_linestatus"),
        "oracle_text": F.concat(F.lit("Back of\n"), "p_name", F.lit(" (see front)")),
        "power": missing,
        "toughness": _text("l_linenumber"),
        "loyalty": F.when(F.col("l_linenumber") != 2, _text("l_linenumber")),
        "defense": missing,
        "image_uris": _image("back"),
    }


def _struct(values: dict[str, Column]) -> Column:
    return F.struct(*[value.alias(name) for name, value in values.items()])


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders, parts = (table(spark, sf_dir, name) for name in ("lineitem", "orders", "part"))
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left").join(
        parts, lines.l_partkey == parts.p_partkey, "left"
    )


def _record() -> list[Column]:
    two_faced = F.col("l_returnflag") == "R"
    front, back = _front(), _back()
    return [
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("oracle_id"),
        F.when(two_faced, F.concat_ws(" // ", "p_name", "p_brand")).otherwise(F.col("p_name")).alias("name"),
        *[F.when(~two_faced, value).alias(name) for name, value in front.items() if name != "name"],
        F.struct(
            F.when(F.col("o_orderstatus") == "F", _money(F.col("l_discount") * 100)).alias("usd"),
            F.when(F.col("o_orderstatus") == "O", _money(F.col("l_tax") * 100)).alias("usd_foil"),
        ).alias("prices"),
        F.when(two_faced, F.array(_struct(front), _struct(back))).alias("card_faces"),
        F.col("o_orderdate").cast("date").alias("released_at"),
        (F.col("l_tax") > 0.02).alias("reprint"),
        (F.col("o_orderpriority") == "5-LOW").alias("digital"),
        F.struct(
            F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "not_legal").otherwise("legal").alias("legacy")
        ).alias("legalities"),
    ]


def bronze_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested record per line item."""
    return _lines(spark, sf_dir).select(*_record())


def record_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per line item: an order is a request, its line numbers are the pages."""
    lines = _lines(spark, sf_dir)
    record = F.struct(*_record())
    return lines.select(
        _text("l_orderkey").alias("request_id"),
        F.col("l_linenumber").alias("page_no"),
        F.when(F.col("l_quantity") > 49, "error").otherwise("list").alias("object"),
        F.when(F.col("l_quantity") > 2, F.array(record)).alias("data"),
        (F.col("l_linenumber") < 7).alias("has_more"),
    )


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per turn: long assistant turns are errors, very short turns hold no list."""
    length = F.char_length("text")
    elements = F.array(F.struct("role", length.alias("chars")), F.struct("role", (length + 1).alias("chars")))
    assistant = F.col("role") == "assistant"
    return table(spark, sf_dir, "conversations").select(
        _text("conv_id").alias("request_id"),
        F.col("turn").cast("int").alias("page_no"),
        F.when(assistant & (length > 1500), "error").otherwise("list").alias("object"),
        F.when(length >= 30, elements).alias("data"),
        F.when(assistant & (length < 600), False).when(~assistant | (length < 1200), True).alias("has_more"),
    )
