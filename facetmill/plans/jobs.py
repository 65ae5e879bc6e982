"""The five jobs: bronze, silver, gold, then train or predict.

Each job starts from the last run of its mode that completed the step before, and
hands its table to the next one through a zone. A failed job restarts without redoing
the others, and never takes the place of an earlier run that is whole.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, fields, replace
from datetime import date, datetime, timezone
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import price_bucket
from ..operators import (
    TokenModel,
    build_vocabulary,
    encode_tokens,
    evaluate,
    evaluate_scored,
    fit_classifier,
    fit_token_model,
    gold_transform,
    hash_split,
    observe_faces,
    observed_faces,
    score_with,
    score_with_model,
    score_with_token_model,
    select_results,
    silver_transform,
    unpack_results,
    with_row_text,
    with_token_probability,
)
from ..operators.features import FIRST_TOKEN_ID
from ..operators.model import Scorer
from ..session import folder_names, scratch, sibling_session
from ..sources import (
    ZoneStore,
    append_model_run,
    cohort,
    current_run,
    latest_model_run,
    new_run,
    page_records,
    quarantined_lines,
    read_runs,
    record_path,
    record_step,
    stage_pages,
    staged_status,
    step_details,
    write_results_table,
)
from ..sources.runs import COMPLETE, FAILED, STARTED


@dataclass(frozen=True)
class Workspace:
    """Where one mode's tables live."""

    spark: SparkSession
    root_dir: str
    mode: str
    layout: str = "columnar"

    @cached_property
    def zones(self) -> ZoneStore:
        return ZoneStore(self.spark, self.root_dir, self.mode, self.layout)

    def new_run(self, now: datetime | None = None) -> str:
        return new_run(self.spark, self.root_dir, self.mode, now)

    def current_run(self, step: str = "bronze") -> str:
        """The last run that completed ``step``."""
        return current_run(self.spark, self.root_dir, self.mode, step)

    @contextmanager
    def step(self, step: str, identifier: str) -> Iterator[dict[str, object]]:
        """Records that a step of a run starts, and that it is complete or has failed when the block ends.

        What the block puts into the yielded mapping is recorded with a complete step.
        """

        def record(state: str, details: Mapping[str, object] | None = None) -> None:
            record_step(self.spark, self.root_dir, self.mode, identifier, step, state, details)

        record(STARTED)
        details: dict[str, object] = {}
        try:
            with scratch(self.spark):
                yield details
        except BaseException as error:
            record(FAILED, {"error": f"{type(error).__name__}: {error}"[:1000]})
            raise
        record(COMPLETE, details)

    def step_details(self, step: str, identifier: str) -> dict[str, str]:
        return step_details(self.spark, self.root_dir, self.mode, identifier, step)

    def runs(self) -> DataFrame:
        """Everything recorded of this mode's runs."""
        return read_runs(self.spark, self.root_dir, self.mode)

    def record_path(self, kind: str, identifier: str) -> str:
        return record_path(self.root_dir, kind, self.mode, identifier)


@dataclass(frozen=True)
class TrainingConfig:
    model_name: str = "prices"
    experiment_path: str = "/experiments"
    test_size: float = 0.2
    num_features: int = 1 << 18
    max_iter: int = 20
    reg_param: float = 0.01
    # "hashed" words in a logistic regression, or "tokens": a model on padded token ids.
    classifier: str = "hashed"
    max_length: int = 194
    vocabulary_size: int = 1 << 16
    dims: int = 16
    hidden: int = 16
    epochs: int = 3
    batches: int = 8
    learning_rate: float = 0.02
    weight_decay: float = 0.01

    def __post_init__(self) -> None:
        if self.classifier not in ("hashed", "tokens"):
            raise ValueError(f"unknown classifier {self.classifier!r}, expected hashed or tokens")

    @property
    def experiment(self) -> str:
        return f"{self.experiment_path}/{self.model_name}"

    @classmethod
    def of(cls, config: Mapping[str, object] | TrainingConfig) -> TrainingConfig:
        """From a mapping; keys that do not concern this trainer are ignored."""
        if isinstance(config, cls):
            return config
        known = {f.name for f in fields(cls)}
        return cls(**{key: value for key, value in config.items() if key in known})


class IncompleteLoadError(RuntimeError):
    """Some requests did not end with a page that says nothing follows."""


def bronze_job(
    work: Workspace,
    pages: DataFrame,
    as_of: date | None = None,
    now: datetime | None = None,
    require_complete: bool = False,
    **cohort_options,
) -> str:
    """Start a run: open landed pages, keep the mode's cohort, write bronze and how each request ended.

    Three tables are written: the load status (see :func:`read_load_status`), the
    lines that are no pages (see :func:`read_quarantine`), and bronze. With
    ``require_complete`` a request that ended in an error, with an unusable page or
    not at all fails the job before bronze is written; the run before it then stays
    the current one, and the first two tables of the failed run can be read.
    """
    identifier = work.new_run(now)
    with work.step("bronze", identifier) as details:
        staged = stage_pages(pages, cohort(work.mode, as_of, **cohort_options))
        staged_status(staged).write.mode("overwrite").parquet(work.record_path("load_status", identifier))
        quarantined_lines(staged).write.mode("overwrite").parquet(work.record_path("quarantine", identifier))
        status = read_load_status(work, identifier)
        counts = status.groupBy("status").agg(F.count("*").alias("n")).collect()
        details.update({f"requests_{r['status']}": r["n"] for r in counts})
        if require_complete:
            broken = status.filter((F.col("status") != "complete") | (F.col("unnumbered_pages") > 0))
            if example := broken.first():
                raise IncompleteLoadError(f"{broken.count()} requests are incomplete, such as {example.asDict()}")
        records = page_records(staged, status).select("record.*")
        work.zones.write(records, "bronze", identifier)
        details["schema"] = records.schema.json()
    return identifier


def read_bronze_history(work: Workspace) -> DataFrame:
    """Bronze of all complete runs as one table, with ``run_identifier``: all fields that any of them held.

    Runs whose schema was not recorded count as having the declared one.
    """
    complete = work.runs().filter((F.col("step") == "bronze") & (F.col("state") == COMPLETE))
    last = complete.groupBy("identifier").agg(F.max_by(F.col("details")["schema"], "recorded_at").alias("schema"))
    schemas = {
        r["identifier"]: StructType.fromJson(json.loads(r["schema"])) if r["schema"] else work.zones.schema("bronze") for r in last.collect()
    }
    if not schemas:
        raise LookupError(f"no complete bronze of mode {work.mode!r} below {work.root_dir}")
    return work.zones.read_runs("bronze", schemas)


def read_load_status(work: Workspace, identifier: str | None = None) -> DataFrame:
    """How each request of a run ended, with its pages; the current run by default."""
    return work.spark.read.parquet(work.record_path("load_status", identifier or work.current_run()))


def read_quarantine(work: Workspace, identifier: str | None = None) -> DataFrame:
    """The landed lines of a run that are not whole pages; the current run by default."""
    return work.spark.read.parquet(work.record_path("quarantine", identifier or work.current_run()))


def silver_job(work: Workspace, infer: bool = False, **options) -> str:
    """Silver of the last run with complete bronze.

    ``infer`` takes bronze as it is stored: fields it lacks become nulls. Which face
    numbers occur is observed while silver is written, and recorded for the gold job.
    """
    identifier = work.current_run("bronze")
    zones = replace(work, spark=sibling_session(work.spark)).zones
    with work.step("silver", identifier) as details:
        seen = Observation("faces")
        silver = silver_transform(work.mode, zones.read("bronze", identifier, infer), **options)
        zones.write_prepared(observe_faces(zones.prepared(silver, "silver"), seen), "silver", identifier)
        details.update(seen.get)
    return identifier


def gold_job(work: Workspace, **options) -> str:
    """Gold of the last run with complete silver; the recorded face numbers spare a scan."""
    identifier = work.current_run("silver")
    silver = work.zones.read("silver", identifier)
    observed = work.step_details("silver", identifier)
    with work.step("gold", identifier):
        if observed:
            options = {"numbers": observed_faces(observed), **options}
        work.zones.write(gold_transform(work.mode, silver, **options), "gold", identifier)
    return identifier


def labelled_gold(gold: DataFrame) -> DataFrame:
    """Item, row text and class id of every gold row."""
    return with_row_text(gold).select("oracle_id", "gameplay_text", price_bucket(F.col("price")).alias("price"))


def training_split(gold: DataFrame, config: Mapping[str, object] | TrainingConfig) -> tuple[DataFrame, DataFrame]:
    """The labelled rows that a job trains on, and those it holds out.

    The split goes by whole rows, so the shares hold even when one item has most of them.
    """
    labelled = labelled_gold(gold)
    return hash_split(labelled, labelled.columns, TrainingConfig.of(config).test_size)


def train_model(gold: DataFrame, config: Mapping[str, object] | TrainingConfig, root_dir: str) -> str:
    """Fit on a reproducible part of ``gold``, evaluate on the rest, record the run.

    Returns the run id.
    """
    config = TrainingConfig.of(config)
    spark = gold.sparkSession
    start_time = datetime.now(timezone.utc)
    run_id = uuid.uuid4().hex
    train, test = training_split(gold, config)
    model_path = f"{root_dir.rstrip('/')}/models/{run_id}"
    params = {"model_name": config.model_name, "test_size": config.test_size}
    with scratch(spark):
        if config.classifier == "tokens":
            metrics = _train_tokens(train, test, config, model_path)
            names = ("max_length", "vocabulary_size", "dims", "hidden", "epochs", "batches", "learning_rate", "weight_decay")
            params["model"] = "word vectors averaged under the mask"
        else:
            metrics = _train_hashed(train, test, config, model_path)
            names = ("max_iter", "num_features", "reg_param")
            params["model"] = "logistic regression on hashed words"
    params.update({name: getattr(config, name) for name in names})
    append_model_run(spark, root_dir, run_id, config.experiment, start_time, params, metrics, model_path)
    return run_id


def _train_hashed(train: DataFrame, test: DataFrame, config: TrainingConfig, model_path: str) -> dict[str, float]:
    model = fit_classifier(
        train, num_features=config.num_features, max_iter=config.max_iter, reg_param=config.reg_param
    )
    metrics = evaluate(model, test)
    model.write().save(model_path)
    return metrics


def _train_tokens(train: DataFrame, test: DataFrame, config: TrainingConfig, model_path: str) -> dict[str, float]:
    """Vocabulary and model are kept together: ids mean nothing without it."""
    spark = train.sparkSession
    build_vocabulary(train, "gameplay_text", config.vocabulary_size).write.parquet(f"{model_path}/vocabulary")
    vocabulary = spark.read.parquet(f"{model_path}/vocabulary")
    words = FIRST_TOKEN_ID + vocabulary.count()

    def encoded(rows: DataFrame) -> DataFrame:
        return encode_tokens(rows, "gameplay_text", vocabulary, config.max_length, truncate=True)

    model = fit_token_model(
        encoded(train), words, "price", config.dims, config.hidden, config.epochs, config.batches, config.learning_rate, config.weight_decay
    )
    probability = F.col("probability")
    metrics = evaluate_scored(with_token_probability(encoded(test), model), probability, (probability > 0.5).cast("int"))
    model.save(spark, model_path)
    return metrics


def load_latest_model(
    spark: SparkSession, config: Mapping[str, object] | TrainingConfig, root_dir: str
) -> PipelineModel | TokenModel:
    return _load_model(spark, latest_model_path(spark, config, root_dir))


def latest_model_path(spark: SparkSession, config: Mapping[str, object] | TrainingConfig, root_dir: str) -> str:
    return latest_model_run(spark, root_dir, TrainingConfig.of(config).experiment)[1]


def _load_model(spark: SparkSession, path: str) -> PipelineModel | TokenModel:
    return TokenModel.load(spark, path) if "vectors" in folder_names(spark, path) else PipelineModel.load(path)


def predict_df(
    gold: DataFrame,
    config: Mapping[str, object] | TrainingConfig,
    root_dir: str,
    scorer: Callable[[], Scorer] | None = None,
) -> DataFrame:
    """``gold`` with ``label`` and ``score`` from the experiment's latest model, of either kind.

    ``scorer`` replaces the model: a function that loads any text scorer, run
    once per task.
    """
    texts, config = with_row_text(gold), TrainingConfig.of(config)
    if scorer is not None:
        return unpack_results(score_with(texts, "gameplay_text", scorer)).drop("gameplay_text")
    path = latest_model_path(gold.sparkSession, config, root_dir)
    model = _load_model(gold.sparkSession, path)
    if isinstance(model, TokenModel):
        return score_with_token_model(token_rows(texts, path, config.max_length), model).drop("gameplay_text")
    return score_with_model(model, texts).drop("gameplay_text")


def token_rows(texts: DataFrame, model_path: str, max_length: int = TrainingConfig.max_length) -> DataFrame:
    """``texts`` with the token ids and masks of a stored model's vocabulary."""
    vocabulary = texts.sparkSession.read.parquet(f"{model_path}/vocabulary")
    return encode_tokens(texts, "gameplay_text", vocabulary, max_length, truncate=True)


def write_predict_results(
    gold: DataFrame,
    config: Mapping[str, object] | TrainingConfig,
    root_dir: str,
    table: str = "results",
    fmt: str = "parquet",
    path: str | None = None,
    scorer: Callable[[], Scorer] | None = None,
) -> None:
    """Score ``gold`` and replace the results table."""
    with scratch(gold.sparkSession):
        write_results_table(select_results(predict_df(gold, config, root_dir, scorer)), table, fmt, path)


def train_job(work: Workspace, config: Mapping[str, object] | TrainingConfig) -> str:
    return train_model(work.zones.read("gold", work.current_run("gold")), config, work.root_dir)


def predict_job(work: Workspace, config: Mapping[str, object] | TrainingConfig, **options) -> None:
    write_predict_results(work.zones.read("gold", work.current_run("gold")), config, work.root_dir, **options)
