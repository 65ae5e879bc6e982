"""Run tables: the steps of batch runs by mode, and tracked model runs by experiment.

Both are append-only Parquet logs, so a retried or concurrent job never rewrites what
another one recorded. A log is cut into slots of time, and who asks for the latest
entry reads the newest slots first: what is read follows the runs of an hour (of a
day for models) and not all runs ever made.

A step of a run is recorded when it starts and when it is through, and counts from
then on: a step that failed or was cut off leaves the run before it as the current one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import check_mode
from ..session import filesystem, folder_names

STEPS = ("bronze", "silver", "gold")
STARTED, COMPLETE, FAILED = "started", "complete", "failed"

RUN_SCHEMA = "mode string, identifier string, step string, state string, recorded_at timestamp, details map<string,string>"
MODEL_RUN_SCHEMA = (
    "run_id string, experiment string, start_time timestamp, "
    "params map<string,string>, metrics map<string,double>, model_path string"
)

# The leading digits of a run identifier that name a log's slot: its hour.
SLOT_DIGITS = 8


class Log:
    """An append-only table below ``path``, in slots that are read newest first."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def append(self, row: tuple, slot: str) -> None:
        self.spark.createDataFrame([row], self.schema).coalesce(1).write.mode("append").parquet(f"{self.path}/slot={slot}")

    def slots(self) -> list[str]:
        return [n.removeprefix("slot=") for n in folder_names(self.spark, self.path) if n.startswith("slot=")]

    def read(self, slots: list[str] | None = None) -> DataFrame:
        slots = self.slots() if slots is None else slots
        if not slots:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/slot={slot}" for slot in slots])

    def newest_first(self) -> Iterator[DataFrame]:
        """The entries of the newest slot, then of twice as many before it, and so on."""
        slots, size = self.slots(), 1
        while slots:
            yield self.read(slots[-size:])
            slots, size = slots[:-size], size * 2


def run_log(spark: SparkSession, root_dir: str, mode: str) -> Log:
    return Log(spark, f"{root_dir.rstrip('/')}/runs/{check_mode(mode)}", RUN_SCHEMA)


def run_identifier(created_at: Column) -> Column:
    """Twelve-digit run id of a point in time, in the session's time zone."""
    return F.date_format(created_at, "yyMMddHHmmss")


def latest_runs(runs: DataFrame) -> DataFrame:
    """The most recent identifier of every mode."""
    latest = F.max(F.struct("created_at", "identifier"))
    return runs.groupBy("mode").agg(latest["identifier"].alias("identifier"))


def current_runs(log: DataFrame) -> DataFrame:
    """For every mode and step the last run that completed it."""
    complete = log.filter(F.col("state") == COMPLETE)
    return complete.groupBy("mode", "step").agg(F.max("identifier").alias("identifier"))


def run_states(log: DataFrame) -> DataFrame:
    """How far every step of every run has come: the last state recorded of it."""
    last = F.max(F.struct("recorded_at", "state"))
    return log.groupBy("mode", "identifier", "step").agg(last["state"].alias("state"))


def _claimed(spark: SparkSession, root_dir: str, mode: str, identifier: str) -> bool:
    """Whether this call is the first to take ``identifier``; the file system decides."""
    system, place = filesystem(spark, f"{root_dir.rstrip('/')}/run_claims/{mode}/{identifier[:SLOT_DIGITS]}/{identifier}")
    system.mkdirs(place.getParent())
    folder = system.resolvePath(place.getParent()).toUri()
    if folder.getScheme() == "file":
        # Hadoop's local file system looks first and creates then, so two could both be first.
        try:
            open(f"{folder.getPath()}/{identifier}", "x").close()
        except FileExistsError:
            return False
        return True
    try:
        system.create(place, False).close()
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName() or system.exists(place):
            return False
        raise
    return True


def new_run(spark: SparkSession, root_dir: str, mode: str, now: datetime | None = None) -> str:
    """A new identifier of ``mode``; where the second is taken, the next free one.

    Nothing is recorded yet: the run shows up with its first step.
    """
    check_mode(mode)
    second = int((now or datetime.now(timezone.utc)).timestamp())
    while True:
        named = spark.range(1).select(run_identifier(F.timestamp_seconds(F.lit(second))).alias("identifier"))
        identifier = named.first()["identifier"]
        if _claimed(spark, root_dir, mode, identifier):
            return identifier
        second += 1


def record_step(
    spark: SparkSession,
    root_dir: str,
    mode: str,
    identifier: str,
    step: str,
    state: str,
    details: Mapping[str, object] | None = None,
) -> None:
    if step not in STEPS:
        raise ValueError(f"unknown step {step!r}, expected one of {', '.join(STEPS)}")
    texts = {key: str(value) for key, value in (details or {}).items()}
    row = (mode, identifier, step, state, datetime.now(timezone.utc), texts)
    run_log(spark, root_dir, mode).append(row, identifier[:SLOT_DIGITS])


def read_runs(spark: SparkSession, root_dir: str, mode: str) -> DataFrame:
    """Everything recorded of a mode's runs."""
    return run_log(spark, root_dir, mode).read()


def current_run(spark: SparkSession, root_dir: str, mode: str, step: str = "bronze") -> str:
    """Identifier of the last run of ``mode`` that completed ``step``."""
    for part in run_log(spark, root_dir, mode).newest_first():
        row = current_runs(part.filter(F.col("step") == step)).first()
        if row is not None:
            return row["identifier"]
    raise LookupError(f"no run of mode {mode!r} with complete {step} below {root_dir}")


def step_details(spark: SparkSession, root_dir: str, mode: str, identifier: str, step: str) -> dict[str, str]:
    """What was recorded when ``step`` of a run was completed last."""
    part = run_log(spark, root_dir, mode).read([identifier[:SLOT_DIGITS]])
    own = part.filter((F.col("identifier") == identifier) & (F.col("step") == step) & (F.col("state") == COMPLETE))
    row = own.agg(F.max_by("details", "recorded_at").alias("details")).first()
    return row["details"] or {}


def _model_log(spark: SparkSession, root_dir: str, experiment: str) -> Log:
    name = hashlib.sha256(experiment.encode()).hexdigest()
    return Log(spark, f"{root_dir.rstrip('/')}/model_runs/{name}", MODEL_RUN_SCHEMA)


def append_model_run(
    spark: SparkSession,
    root_dir: str,
    run_id: str,
    experiment: str,
    start_time: datetime,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    model_path: str,
) -> None:
    row = (
        run_id,
        experiment,
        start_time,
        {key: str(value) for key, value in params.items()},
        {key: float(value) for key, value in metrics.items()},
        model_path,
    )
    slot = start_time.astimezone(timezone.utc).strftime("%Y%m%d")
    _model_log(spark, root_dir, experiment).append(row, slot)


def read_model_runs(spark: SparkSession, root_dir: str) -> DataFrame:
    """The runs of all experiments."""
    base = f"{root_dir.rstrip('/')}/model_runs"
    parts = [Log(spark, f"{base}/{name}", MODEL_RUN_SCHEMA) for name in folder_names(spark, base)]
    paths = [f"{log.path}/slot={slot}" for log in parts for slot in log.slots()]
    return spark.read.schema(MODEL_RUN_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], MODEL_RUN_SCHEMA)


def latest_model_runs(runs: DataFrame) -> DataFrame:
    """The run started last in every experiment."""
    latest = F.max(F.struct("start_time", "run_id", "model_path"))
    return (
        runs.groupBy("experiment")
        .agg(latest.alias("latest"))
        .select("experiment", "latest.run_id", "latest.model_path")
    )


def latest_model_run(spark: SparkSession, root_dir: str, experiment: str) -> tuple[str, str]:
    """Run id and model path of the run started last in ``experiment``."""
    for part in _model_log(spark, root_dir, experiment).newest_first():
        row = latest_model_runs(part).first()
        if row is not None:
            return row["run_id"], row["model_path"]
    raise LookupError(f"no model run of {experiment!r} below {root_dir}")
