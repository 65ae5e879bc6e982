"""Zone-addressed tables: ``{root}/{zone}/{mode}/{mode}_{zone}_{identifier}.{format}``."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import normalise_strings, strip_newlines
from ..schemas import BRONZE_SCHEMA, as_stored, check_mode, gold_columns, merged, silver_columns, string_schema
from ..session import filesystem, folder_names, remove_folder

# Storage format by zone. "text" keeps row files that people can open; "columnar"
# keeps nested types, prunes columns and pushes filters. "bucketed" also deals silver out
# by item when it is written, so that what is grouped by item reads it without a shuffle.
LAYOUTS = {
    "bucketed": {"bronze": "parquet", "silver": "parquet", "gold": "parquet"},
    "columnar": {"bronze": "parquet", "silver": "parquet", "gold": "parquet"},
    "text": {"bronze": "json", "silver": "csv", "gold": "csv"},
}

# What buckets go by.
ITEM = "oracle_id"

# A fixed line separator keeps carriage returns inside values from splitting rows.
_OPTIONS = {"csv": {"sep": ";", "header": "true", "lineSep": "\n"}}

# Row files repeat every field's name or marks in every row, so they are compressed. Such
# a file is read by one task: it holds a bounded number of rows.
_COMPRESSED = {"compression": "gzip", "maxRecordsPerFile": "500000"}


def read_table(
    spark: SparkSession, path: str, fmt: str, schema: StructType | None = None, malformed: str | None = None
) -> DataFrame:
    """Read a table; without ``schema`` JSON is inferred and every CSV column is a string.

    ``malformed`` names a column for the text of JSON lines that cannot be read in
    full (null for others); without it such lines are rows of nulls.
    """
    reader = spark.read.format(fmt).options(**_OPTIONS.get(fmt, {}))
    if malformed is not None:
        reader = reader.option("columnNameOfCorruptRecord", malformed)
        if schema is None:
            schema = reader.load(path).schema
        if malformed not in schema.fieldNames():
            schema = StructType([*schema.fields, StructField(malformed, StringType())])
    if schema is not None:
        # A CSV header that does not name these columns in this order is an error.
        reader = reader.schema(schema).option("enforceSchema", "false")
    return reader.load(path)


def write_table(df: DataFrame, path: str, fmt: str) -> None:
    """Overwrite a table; in CSV, newlines inside values become spaces so that rows stay whole."""
    if fmt == "csv":
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
        df = df.withColumns({name: strip_newlines(F.col(name)) for name in texts})
    packed = _COMPRESSED if fmt in ("json", "csv") else {}
    df.write.format(fmt).options(**_OPTIONS.get(fmt, {}), **packed).mode("overwrite").save(path)


@dataclass(frozen=True)
class ZoneStore:
    """Reads and writes the zone tables of one mode below one root."""

    spark: SparkSession
    root_dir: str
    mode: str
    layout: str = "columnar"
    buckets: int | None = None

    def __post_init__(self) -> None:
        check_mode(self.mode)
        if self.layout not in LAYOUTS:
            raise ValueError(f"unknown layout {self.layout!r}, expected one of {', '.join(LAYOUTS)}")

    def format(self, zone: str) -> str:
        try:
            return LAYOUTS[self.layout][zone]
        except KeyError:
            raise ValueError(f"unknown zone {zone!r}") from None

    def path(self, zone: str, identifier: str) -> str:
        fmt = self.format(zone)
        if self._bucketed(zone):
            # The number is part of the name: read with another one, the table is not there.
            fmt = f"{self.bucket_count}-buckets.{fmt}"
        return f"{self.root_dir.rstrip('/')}/{zone}/{self.mode}/{self.mode}_{zone}_{identifier}.{fmt}"

    @property
    def bucket_count(self) -> int:
        return self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _bucketed(self, zone: str) -> bool:
        return self.layout == "bucketed" and zone == "silver"

    def schema(self, zone: str) -> StructType:
        if zone == "bronze":
            return BRONZE_SCHEMA
        return string_schema(silver_columns(self.mode) if zone == "silver" else gold_columns(self.mode))

    def read(self, zone: str, identifier: str, infer: bool = False) -> DataFrame:
        """Read a zone table with its declared schema, or let the source infer it."""
        schema = None if infer else self.schema(zone)
        if self._bucketed(zone):
            return self._read_buckets(zone, identifier)
        return read_table(self.spark, self.path(zone, identifier), self.format(zone), schema)

    def read_runs(self, zone: str, schemas: Mapping[str, StructType]) -> DataFrame:
        """The tables of several runs as one, with ``run_identifier``; ``schemas`` has what each was written with.

        Fields that a run lacks are null, and fields of different types are strings.
        Runs of the same schema are read together, so the plan follows the number of
        different schemas.
        """
        whole = reduce(merged, schemas.values())
        groups: dict[str, list[str]] = {}
        for identifier, schema in sorted(schemas.items()):
            groups.setdefault(schema.json(), []).append(identifier)
        parts = []
        for identifiers in groups.values():
            stored = as_stored(whole, schemas[identifiers[0]])
            reader = self.spark.read.format(self.format(zone)).options(**_OPTIONS.get(self.format(zone), {})).schema(stored)
            df = reader.load([self.path(zone, i) for i in identifiers])
            name = F.regexp_extract("_metadata.file_path", rf"/{self.mode}_{zone}_(\w+)\.[^/]*/[^/]*$", 1)
            parts.append(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in whole.fields], name.alias("run_identifier")))
        return reduce(DataFrame.unionByName, parts)

    def prepared(self, df: DataFrame, zone: str) -> DataFrame:
        """``df`` as ``zone`` holds it: text of silver and gold normalised, so all layouts hand on the same values."""
        return df if zone == "bronze" else normalise_strings(df)

    def write_prepared(self, df: DataFrame, zone: str, identifier: str) -> None:
        if self._bucketed(zone):
            self._write_buckets(df, zone, identifier)
        else:
            write_table(df, self.path(zone, identifier), self.format(zone))

    def _bucket_table(self, zone: str, identifier: str) -> tuple[str, str]:
        """Path of a bucketed zone table and a name under which the catalog knows it for a moment."""
        path = self.path(zone, identifier)
        return path, f"zone_{hashlib.md5(path.encode()).hexdigest()}_{uuid.uuid4().hex[:8]}"

    def _write_buckets(self, df: DataFrame, zone: str, identifier: str) -> None:
        """One file per bucket, sorted by item: rows are dealt out by the buckets' own hash first."""
        path, name = self._bucket_table(zone, identifier)
        dealt = df.repartition(self.bucket_count, ITEM)
        writer = dealt.write.format(self.format(zone)).bucketBy(self.bucket_count, ITEM).sortBy(ITEM)
        writer.option("path", path).mode("overwrite").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")

    def _read_buckets(self, zone: str, identifier: str) -> DataFrame:
        """The files with their buckets. The frame keeps them after its name has left the catalog."""
        path, name = self._bucket_table(zone, identifier)
        system, place = filesystem(self.spark, path)
        if not system.exists(place):
            raise FileNotFoundError(f"no table in {path}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema(zone))
        clustered = f"CLUSTERED BY ({ITEM}) SORTED BY ({ITEM}) INTO {self.bucket_count} BUCKETS"
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING {self.format(zone)} {clustered} LOCATION '{path}'")
        df = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return df

    def write(self, df: DataFrame, zone: str, identifier: str) -> None:
        """Overwrite a zone table."""
        self.write_prepared(self.prepared(df, zone), zone, identifier)


def write_results_table(
    df: DataFrame, table: str = "results", fmt: str = "parquet", path: str | None = None, keep: int = 1
) -> None:
    """Replace the rows of catalog table ``table``, whose files are below ``path`` (by default in the warehouse).

    Each call writes a version in a folder of its own, in full, and then points the
    table at it in one catalog step, so every reader sees one whole version and the
    table never goes. The ``keep`` versions before the new one stay for readers that
    have begun; older ones are removed. Where the columns or the format have changed,
    the table has to be dropped and made anew. Two writers at a time: the last to
    finish wins whole; set ``keep`` to the number of writers.
    """
    spark = df.sparkSession
    base = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table.replace('.', '/')}_versions"
    version = f"version-{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex}"
    folder = f"{base.rstrip('/')}/{version}"
    df.write.format(fmt).save(folder)
    if spark.catalog.tableExists(table) and _same_layout(spark, table, df, fmt):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path=folder, source=fmt, schema=spark.read.format(fmt).load(folder).schema)
    spark.catalog.refreshTable(table)
    versions = [name for name in folder_names(spark, base) if name.startswith("version-")]
    for old in versions[: max(versions.index(version) - keep, 0)]:
        remove_folder(spark, f"{base.rstrip('/')}/{old}")


def _same_layout(spark: SparkSession, table: str, df: DataFrame, fmt: str) -> bool:
    """Whether ``table`` is an external one of the same columns and format."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    columns = [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema]
    same = columns == [(f.name, f.dataType.simpleString()) for f in df.schema]
    return same and told.get("Type") == "EXTERNAL" and told.get("Provider", "").lower() == fmt.lower()


def record_path(root_dir: str, kind: str, mode: str, identifier: str) -> str:
    """Where a table about a run is kept, such as the load status of bronze."""
    return f"{root_dir.rstrip('/')}/{kind}/{mode}/{mode}_{kind}_{identifier}.parquet"
