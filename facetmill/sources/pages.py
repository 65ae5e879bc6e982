"""Landed result pages: envelopes that each hold an array of records.

A request's pages count up to its end: pages after the first unusable one, or
after the one that says nothing follows, do not belong to the result.

Bodies are parsed once. :func:`stage_pages` opens every page and writes one narrow row
for it, next to the records a caller wants of it. How requests ended is then read from
the narrow columns alone, and the wanted records from the staged table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import BRONZE_SCHEMA, page_schema, widened
from ..session import materialise

# In-memory bytes of request ends below which they are sent to every task.
BROADCAST_BYTES = 64 * 1024 * 1024
# What a hashed row of a string and a number takes besides twice its key.
ROW_BYTES = 120

# The text of a landed line that was not read in full; null for whole pages.
MALFORMED = "malformed_line"


def read_pages(spark: SparkSession, path: str, record: StructType = BRONZE_SCHEMA, keep_all: bool = True) -> DataFrame:
    """Landed pages with ``record`` rows.

    With ``keep_all`` every other field that the pages hold is kept as well, with
    its inferred type; that takes one more pass over them. A line that cannot be
    read in full is kept as text in ``malformed_line``, next to what was read of it.
    """
    declared = page_schema(record)
    reader = spark.read.option("columnNameOfCorruptRecord", MALFORMED)
    if keep_all:
        declared = widened(declared, reader.json(path).schema)
    if MALFORMED not in declared.fieldNames():
        declared = StructType([*declared.fields, StructField(MALFORMED, StringType())])
    return reader.schema(declared).json(path)


def _line(pages: DataFrame) -> Column:
    return F.col(MALFORMED) if MALFORMED in pages.columns else F.lit(None).cast("string")


def _unusable(pages: DataFrame) -> Column:
    """Why a page cannot be used, null for one that can.

    A line of which some fields were read is a page with the others null, as far as
    it goes; one of which nothing was read is malformed.
    """
    nothing = F.coalesce("request_id", F.col("page_no").cast("string"), "object").isNull() & F.col("data").isNull()
    return (
        F.when(_line(pages).isNotNull() & nothing, "malformed")
        .when(F.coalesce(F.col("object") == "error", F.lit(False)), "error")
        .when(F.col("data").isNull(), "invalid")
    )


def _flags(pages: DataFrame) -> dict[str, Column]:
    """What of a page's envelope says how its request ended."""
    return {
        "request_id": F.col("request_id"),
        "page_no": F.col("page_no"),
        "unusable": _unusable(pages),
        "last": ~F.coalesce("has_more", F.lit(False)),
    }


def _narrow(pages: DataFrame) -> DataFrame:
    return pages.select(*[value.alias(name) for name, value in _flags(pages).items()])


def _end_of_request() -> Column:
    """Number of the last page to keep, null when no page marks an end."""
    return F.min(F.when(F.col("unusable").isNotNull(), F.col("page_no") - 1).when(F.col("last"), F.col("page_no")))


def _status() -> Column:
    """Where two pages have the number at which a request ended, an unusable one decides."""
    ends = F.struct("page_no", F.col("unusable").isNull().alias("usable"), F.coalesce("unusable", F.lit("complete")).alias("status"))
    return F.coalesce(F.min(F.when(F.col("unusable").isNotNull() | F.col("last"), ends))["status"], F.lit("open"))


def page_status(pages: DataFrame) -> DataFrame:
    """How every request ended: ``complete``, ``error``, ``invalid``, ``malformed`` or ``open``."""
    return _narrow(pages).groupBy("request_id").agg(_status().alias("status"), _end_of_request().alias("last_page"))


def _load_status(narrow: DataFrame) -> DataFrame:
    return narrow.groupBy("request_id").agg(
        _status().alias("status"),
        _end_of_request().alias("last_page"),
        F.count("*").alias("pages"),
        F.count_if(F.col("page_no").isNull()).alias("unnumbered_pages"),
    )


def load_status(pages: DataFrame) -> DataFrame:
    """:func:`page_status` with the number of pages, and of those without ``page_no``, of every request.

    A page without a number counts only in a request that no page ends. Malformed
    lines of which no request can be read are a row without ``request_id``.
    """
    return _load_status(_narrow(pages))


def stage_pages(pages: DataFrame, wanted: Column | None = None) -> DataFrame:
    """One row per page, and one per record that is ``wanted`` (all by default), written to the scratch folder.

    ``wanted`` is a condition on the records' fields. A page's own row is that of its
    first record, which is kept whether wanted or not. Records stand in ``record``, so their fields may have any name.
    """
    flags = _flags(pages)
    envelope = [value.alias(f"page_{name}") for name, value in flags.items()]
    record = pages.schema["data"].dataType.elementType
    opened = pages.select(*envelope, _line(pages).alias("page_line"), F.posexplode_outer("data").alias("page_position", "page_record"))
    own = [F.col("page_record")[f.name].alias(f.name) for f in record.fields]
    # Conditions name the records' fields; the page's stand aside under a name that none of them has.
    aside = "page"
    while aside in {f.name.lower() for f in record.fields}:
        aside += "_"
    page = F.col(aside)
    held = [c for c in opened.columns if c != "page_record"]
    spread = opened.select(F.struct(*held, "page_record").alias(aside), *own)
    chosen = page["page_position"].isNotNull() & page["page_unusable"].isNull()
    if wanted is not None:
        chosen = chosen & F.coalesce(wanted, F.lit(False))
    first = F.coalesce(page["page_position"], F.lit(0)) == 0
    marked = spread.select(page.alias("page"), chosen.alias("wanted"), first.alias("first")).filter("wanted or first")
    return materialise(
        marked.select(
            *[F.col(f"page.page_{name}").alias(name) for name in flags],
            F.col("page.page_line").alias(MALFORMED),
            "first",
            "wanted",
            F.when(F.col("wanted"), F.col("page.page_record")).alias("record"),
        ),
        "staged-pages",
    )


def staged_status(staged: DataFrame) -> DataFrame:
    """:func:`load_status` of staged pages."""
    return _load_status(staged.filter("first"))


def quarantined_lines(staged: DataFrame) -> DataFrame:
    """The lines that were not read in full, with what was read of their envelope."""
    return staged.filter(F.col("first") & F.col(MALFORMED).isNotNull()).select("request_id", "page_no", MALFORMED)


def page_records(staged: DataFrame, status: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The wanted records of the pages that count, as ``request_id``, ``page_no`` and ``record``.

    ``status`` has the end of every request. It is measured, and broadcast when it
    fits, so that records do not move. When it does not fit, records and ends join on
    the request; a request that holds most of the records is on the left side, where
    adaptive execution splits it.
    """
    ends = status.filter("last_page is not null").select(F.col("request_id").alias("ended_request"), "last_page")
    held = F.coalesce(F.octet_length("ended_request"), F.lit(0)) * 2 + ROW_BYTES
    size = ends.agg(F.sum(held).alias("bytes")).first()["bytes"] or 0
    same_request = F.col("request_id").eqNullSafe(F.col("ended_request"))
    records = staged.filter("wanted").select("request_id", "page_no", "record")
    if size <= broadcast_bytes:
        joined = records.join(F.broadcast(ends), same_request, "left")
    else:
        joined = records.hint("merge").join(ends, same_request, "left")
    kept = joined.filter(F.col("last_page").isNull() | (F.col("page_no") <= F.col("last_page")))
    return kept.select("request_id", "page_no", "record")


def flatten_pages(pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per record of the pages that count, with ``request_id`` and ``page_no``.

    A record's field with one of these two names gives way to the page's; the jobs
    use :func:`page_records`, where it does not.
    """
    staged = stage_pages(pages)
    status = materialise(staged_status(staged), "request-ends")
    taken = {"request_id", "page_no"}
    fields = [f.name for f in staged.schema["record"].dataType.fields if f.name.lower() not in taken]
    records = page_records(staged, status, broadcast_bytes)
    return records.select("request_id", "page_no", *[F.col("record")[name].alias(name) for name in fields])
