"""One query per operator over the test tables, each on whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from .. import operators as op
from .. import sources as src
from ..operators.model import Scorer
from ..schemas import BRONZE_SCHEMA, MODEL_TEXT_COLUMNS, field_or_null
from ..session import materialise, scratch_path
from ..sources.runs import COMPLETE, FAILED, STARTED, STEPS
from .jobs import (
    IncompleteLoadError,
    TrainingConfig,
    Workspace,
    bronze_job,
    gold_job,
    latest_model_path,
    load_latest_model,
    predict_df,
    predict_job,
    read_bronze_history,
    read_load_status,
    silver_job,
    token_rows,
    train_job,
    training_split,
)
from .tables import bronze_records, conversation_pages, record_pages, table

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2001, 8, 1)
SINCE_YEAR = 1996
NOW = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
CONFIG = TrainingConfig(num_features=1 << 14, max_iter=10)

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _flat_record(bronze: DataFrame) -> DataFrame:
    """Nested records as plain columns."""
    return bronze.select(
        "oracle_id",
        "name",
        "oracle_text",
        "prices.usd",
        "prices.usd_foil",
        "released_at",
        F.when(F.col("card_faces").isNotNull(), F.size("card_faces")).alias("n_faces"),
        F.get("card_faces", F.lit(1))["image_uris"]["small"].alias("back_image"),
    )


def _cleaned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = fn.strip_parenthetical(fn.strip_newlines(F.col("text")))
    return table(spark, sf_dir, "documents").withColumn("text", text)


# --- sources and sinks -------------------------------------------------------


@query
def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as JSON lines, read with an inferred schema."""
    path = scratch_path(spark, "events")
    events = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int").alias("props"))
    src.write_table(events, path, "json")
    read = src.read_table(spark, path, "json")
    return read.select("event_id", field_or_null(read.schema, "props.k", dtype="int").alias("k"))


@query
def json_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as JSON lines of which some broke off: the others' values, and the broken lines as they are."""
    path = scratch_path(spark, "event-lines")
    line = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"props":'), "props", F.lit("}"))
    cut = F.when(F.col("event_id") % 11 == 3, F.substr(line, F.lit(1), F.char_length(line) - 2)).otherwise(line)
    table(spark, sf_dir, "events").select(cut.alias("value")).write.text(path)
    read = src.read_table(spark, path, "json", malformed="line")
    return read.select("event_id", field_or_null(read.schema, "props.k", dtype="int").alias("k"), "line")


@query
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    src.write_table(bronze_records(spark, sf_dir), path, "json")
    return _flat_record(src.read_table(spark, path, "json", BRONZE_SCHEMA))


@query
def csv_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn.normalise_strings(_cleaned_documents(spark, sf_dir).select("doc_id", "text"))


@query
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    src.write_table(_cleaned_documents(spark, sf_dir).select("doc_id", "text", "lang"), path, "csv")
    return src.read_table(spark, path, "csv")


@query
def run_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", src.run_identifier(F.col("ts")).alias("identifier"))


@query
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("mode"),
        F.col("ts").alias("created_at"),
        src.run_identifier(F.col("ts")).alias("identifier"),
    )
    return src.latest_runs(runs)


@query
def latest_model_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("experiment"),
        F.col("ts").alias("start_time"),
        F.col("event_id").cast("string").alias("run_id"),
        F.concat(F.lit("models/"), F.col("event_id").cast("string")).alias("model_path"),
    )
    return src.latest_model_runs(runs)


def _recorded_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as entries of a run log: a run a day, three steps, three states."""
    names = lambda column, *values: F.element_at(F.array(*map(F.lit, values)), (F.col(column) % 3 + 1).cast("int"))
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("mode"),
        src.run_identifier(F.date_trunc("day", "ts")).alias("identifier"),
        names("user_id", *STEPS).alias("step"),
        names("event_id", STARTED, COMPLETE, FAILED).alias("state"),
        F.col("ts").alias("recorded_at"),
    )


@query
def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.run_states(_recorded_steps(spark, sf_dir))


@query
def current_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.current_runs(_recorded_steps(spark, sf_dir))


@query
def flatten_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.flatten_pages(conversation_pages(spark, sf_dir))


@query
def page_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.page_status(conversation_pages(spark, sf_dir))


@query
def cohort_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_records(spark, sf_dir).filter(src.predict_cohort(AS_OF)).select("oracle_id", "name", "released_at")


@query
def cohort_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = bronze_records(spark, sf_dir).filter(src.train_cohort(AS_OF, since_year=SINCE_YEAR))
    return chosen.select("oracle_id", "prices.usd", "released_at")


@query
def cohort_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_records(spark, sf_dir).filter(src.name_cohort("ring")).select("oracle_id", "name")


# --- projections and generators ----------------------------------------------


@query
def split_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.single_faces("train", bronze_records(spark, sf_dir))


@query
def split_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.multi_faces("train", bronze_records(spark, sf_dir))


@query
def nested_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_records(spark, sf_dir).withColumn("second", F.get("card_faces", F.lit(1)))
    paths = {"usd": "prices.usd", "usd_foil": "prices.usd_foil", "image_link": "image_uris.small", "second_name": "second.name"}
    return bronze.select("oracle_id", *[field_or_null(bronze.schema, path).alias(name) for name, path in paths.items()])


@query
def select_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.select_or_null(table(spark, sf_dir, "lineitem"), ["l_orderkey", "loyalty", "l_returnflag", "defense"])


@query
def flat_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.select_faces("train", bronze_records(spark, sf_dir).drop("card_faces"))


@query
def explode_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    faces = op.explode_faces(bronze_records(spark, sf_dir))
    return faces.select("oracle_id", "card_face_number", "face.name", "usd", "usd_foil")


# --- joins -------------------------------------------------------------------


@query
def faces_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.union_faces("train", bronze_records(spark, sf_dir))


@query
def faces_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.select_faces("predict", bronze_records(spark, sf_dir))


@query
def faces_outer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.join_faces("train", bronze_records(spark, sf_dir))


@query
def full_outer_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("card"), F.col("o_orderstatus").alias("status"), "o_totalprice"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("card"), F.col("l_linestatus").alias("status"), "l_suppkey", "l_linenumber"
    )
    return op.full_outer_using(orders, lines)


# --- aggregations ------------------------------------------------------------


def _conversation_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as faces of a conversation: more than two face numbers."""
    length = F.char_length("text")
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("oracle_id"),
        F.col("turn").cast("string").alias("card_face_number"),
        F.col("role").alias("mana_cost"),
        length.cast("string").alias("type_line"),
        F.col("text").alias("oracle_text"),
        F.lit(None).cast("string").alias("bottomright_value"),
        (length > 300).cast("string").alias("price"),
    )


@query
def distinct_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.distinct_faces(op.select_faces("train", bronze_records(spark, sf_dir)))


@query
def first_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount"]
    return op.first_per_group(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], values, ["l_shipdate"]
    )


def _paired_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two turns in a row as the two faces of an item: every row has a place."""
    turn = F.col("card_face_number").cast("int")
    return _conversation_faces(spark, sf_dir).withColumns(
        {
            "oracle_id": F.concat_ws("-", "oracle_id", F.floor(turn / 2).cast("string")),
            "card_face_number": (turn % 2).cast("string"),
        }
    )


@query
def pivot_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.pivot_faces("train", _paired_turns(spark, sf_dir))


@query
def gold_auto_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More than two face numbers: the transform decides to pad."""
    return op.gold_transform("train", _conversation_faces(spark, sf_dir))


@query
def gold_auto_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly two face numbers: the transform decides to pivot."""
    return op.gold_transform("train", _paired_turns(spark, sf_dir))


@query
def pad_second_face(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.pad_second_face("train", _conversation_faces(spark, sf_dir))


@query
def null_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.fill_null_token(op.pivot_faces("train", _paired_turns(spark, sf_dir)))


# --- scalar functions --------------------------------------------------------


@query
def strip_newlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", fn.strip_newlines(F.col("text")).alias("text"))


@query
def strip_parenthetical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned_documents(spark, sf_dir).select("doc_id", "text")


@query
def corner_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    faces = op.select_faces("train", bronze_records(spark, sf_dir))
    value = fn.corner_value(F.col("power"), F.col("toughness"), F.col("loyalty"), F.col("defense"))
    return faces.select("oracle_id", "card_face_number", value.alias("bottomright_value"))


@query
def price_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    faces = op.select_faces("train", bronze_records(spark, sf_dir))
    return faces.select(
        "oracle_id", "card_face_number", fn.price_fallback(F.col("usd"), F.col("usd_foil")).alias("price")
    )


@query
def price_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", fn.price_bucket(F.col("value")).alias("price"))


@query
def label_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fn.label_name(fn.price_bucket(F.col("value")))
    named = table(spark, sf_dir, "events").select("event_id", name.alias("label"))
    return named.withColumn("label_id", fn.label_id(F.col("label")))


@query
def row_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before the null token is filled in, so that nulls print."""
    silver = fn.normalise_strings(op.silver_transform("train", bronze_records(spark, sf_dir)))
    wide = op.pivot_faces("train", silver)
    return wide.select("oracle_id", fn.row_text([F.col(c) for c in MODEL_TEXT_COLUMNS]).alias("gameplay_text"))


@query
def score_unpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = F.struct(F.col("event_type").alias("label"), F.col("value").alias("score"))
    other = F.struct(F.lit("other").alias("label"), F.lit(0.0).alias("score"))
    scored = table(spark, sf_dir, "events").select("event_id", F.array(best, other).alias("results"))
    return op.unpack_results(scored)


# --- features and model ------------------------------------------------------


def _gold(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    silver = fn.normalise_strings(op.silver_transform(mode, bronze_records(spark, sf_dir)))
    return op.gold_transform(mode, silver, widen="pivot")


@query
def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.training_set(_gold(spark, sf_dir, "train"))


@query
def token_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.build_vocabulary(table(spark, sf_dir, "documents"), "text")


@query
def encoded_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = op.encode_tokens(documents, "text", op.build_vocabulary(documents, "text"))
    return encoded.select(
        "doc_id",
        *[F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in ("input_ids", "attention_mask")],
    )


@query
def encoded_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training set as token ids under its own vocabulary."""
    training = materialise(op.training_set(_gold(spark, sf_dir, "train")), "training-set")
    encoded = op.encoded_training_set(training, op.build_vocabulary(training, "gameplay_text"), max_length=32)
    return encoded.select(
        *[F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in ("input_ids", "attention_mask")], "label"
    )


@query
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(op.is_test_row(["event_id"], 0.2), "test").otherwise("train")
    return table(spark, sf_dir, "events").select("event_id", part.alias("part"))


def _judged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    probability = F.col("n_chars") / (F.col("n_chars") + 2000.0)
    return labels.join(documents, "doc_id").select(F.col("quality").alias("label"), probability.alias("probability"))


@query
def eval_log_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    loss = op.log_loss(F.col("label"), F.col("probability"))
    return _judged_documents(spark, sf_dir).agg(F.round(loss, 6).alias("eval_loss"))


@query
def eval_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = F.when(F.col("probability") >= 0.5, 1).otherwise(0)
    judged = _judged_documents(spark, sf_dir).withColumn("predicted", predicted)
    return op.confusion_counts(judged, "label", "predicted")


def _length_scorer(limit: int) -> Callable[[], Scorer]:
    """A stand-in scorer: long texts are expected to be worth more."""

    def load() -> Scorer:
        above, below = [{"label": "Above_3", "score": 0.75}], [{"label": "Below_3", "score": 0.5}]
        return lambda texts: [above if len(text) >= limit else below for text in texts]

    return load


@query
def udf_scorer(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op.unpack_results(op.score_with(documents, "text", _length_scorer(1000))).drop("text")


@query
def result_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold scored on its row text by a scorer of the caller's."""
    gold = _gold(spark, sf_dir, "predict")
    return op.select_results(predict_df(gold, CONFIG, "", scorer=_length_scorer(110)))


# --- jobs --------------------------------------------------------------------


def _landed(spark: SparkSession, sf_dir: str, mode: str, layout: str = "columnar") -> Workspace:
    """A workspace whose bronze zone holds every record."""
    work = Workspace(spark, scratch_path(spark, f"lake-{mode}"), mode, layout)
    _land(work, bronze_records(spark, sf_dir))
    return work


def _land(work: Workspace, records: DataFrame) -> None:
    """A run whose bronze holds ``records``."""
    identifier = work.new_run(NOW)
    with work.step("bronze", identifier) as details:
        work.zones.write(records, "bronze", identifier)
        details["schema"] = records.schema.json()


def _refined(spark: SparkSession, sf_dir: str, mode: str, layout: str = "columnar") -> Workspace:
    work = _landed(spark, sf_dir, mode, layout)
    silver_job(work)
    gold_job(work)
    return work


@query
def e2e_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land pages as JSON files, then run the bronze job on them."""
    landed = scratch_path(spark, "landed")
    src.write_table(record_pages(spark, sf_dir), landed, "json")
    work = Workspace(spark, scratch_path(spark, "lake-bronze"), "train")
    identifier = bronze_job(work, src.read_pages(spark, landed), AS_OF, NOW, since_year=SINCE_YEAR)
    return _flat_record(work.zones.read("bronze", identifier))


@query
def bronze_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the requests of a bronze run ended, as the job wrote it."""
    work = Workspace(spark, scratch_path(spark, "lake-bronze"), "train")
    bronze_job(work, record_pages(spark, sf_dir), AS_OF, NOW, since_year=SINCE_YEAR)
    return read_load_status(work)


@query
def silver_after_failed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load whose requests all break off fails its run; silver then goes on from the load before."""
    work = Workspace(spark, scratch_path(spark, "lake-failed"), "train")
    pages = record_pages(spark, sf_dir)
    whole = bronze_job(work, pages, AS_OF, NOW, since_year=SINCE_YEAR)
    broken = pages.withColumn("object", F.when(F.col("page_no") > 1, "error").otherwise(F.col("object")))
    try:
        bronze_job(work, broken, AS_OF, NOW, require_complete=True, since_year=SINCE_YEAR)
    except IncompleteLoadError:
        pass
    states = src.run_states(work.runs()).filter("step = 'bronze'").groupBy().pivot("state", ["complete", "failed"]).count()
    silver = work.zones.read("silver", silver_job(work))
    return silver.withColumn("is_of_whole_load", F.lit(work.current_run("silver") == whole)).crossJoin(F.broadcast(states))


@query
def bronze_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads that differ in fields, in a field's type and in a name's case, read as one."""
    work = Workspace(spark, scratch_path(spark, "lake-history"), "train")
    records = bronze_records(spark, sf_dir)
    size = F.char_length("name")
    _land(work, records.drop("loyalty").withColumns({"Weight": size, "prices": F.col("prices").dropFields("usd_foil")}))
    _land(work, records.drop("defense").withColumns({"weight": size.cast("string"), "colour": F.lit("red")}))
    columns = ["oracle_id", "loyalty", "defense", "weight", "colour", "prices.usd", "prices.usd_foil", "run_identifier"]
    return read_bronze_history(work).select(*columns)


@query
def malformed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages of which every seventh line broke off: how the requests ended, and the lines that are no pages."""
    landed = scratch_path(spark, "landed-lines")
    pages = conversation_pages(spark, sf_dir)
    line, broken = F.to_json(F.struct(*pages.columns)), (F.col("page_no") + F.col("request_id").cast("int")) % 7 == 0
    cut = F.when(broken, F.substr(line, F.lit(1), F.char_length(line) - 5)).otherwise(line)
    pages.select(cut.alias("value")).write.text(landed)
    record = pages.schema["data"].dataType.elementType
    staged = src.stage_pages(src.read_pages(spark, landed, record))
    lines = src.quarantined_lines(staged).agg(F.count("malformed_line").alias("quarantined"))
    return src.staged_status(staged).crossJoin(F.broadcast(lines))


@query
def e2e_silver_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze stored without some fields, read as it is: they become nulls."""
    work = Workspace(spark, scratch_path(spark, "lake-inferred"), "train")
    partial = bronze_records(spark, sf_dir).drop("card_faces", "loyalty", "legalities")
    _land(work, partial)
    return work.zones.read("silver", silver_job(work, infer=True))


def _silver(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    work = _landed(spark, sf_dir, mode)
    return work.zones.read("silver", silver_job(work))


@query
def e2e_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir, "train")


@query
def e2e_silver_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir, "predict")


@query
def e2e_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = _refined(spark, sf_dir, "train")
    return work.zones.read("gold", work.current_run("gold"))


@query
def e2e_gold_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = _refined(spark, sf_dir, "predict")
    return work.zones.read("gold", work.current_run("gold"))


@query
def e2e_gold_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with silver in buckets by item: gold groups without a shuffle."""
    work = _refined(spark, sf_dir, "train", "bucketed")
    return work.zones.read("gold", work.current_run("gold"))


@query
def e2e_gold_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through JSON and CSV zones."""
    work = _refined(spark, sf_dir, "train", "text")
    return work.zones.read("gold", work.current_run("gold"))


def _trained(spark: SparkSession, sf_dir: str) -> Workspace:
    work = _refined(spark, sf_dir, "train")
    train_job(work, CONFIG)
    return work


# A fit counts as one if what is left of the gradient at the best constant is under this share.
SMALL_GRADIENT = 0.05


def _is_fitted(work: Workspace) -> Column:
    """Whether the stored weights are near the optimum of the rows they were fitted to."""
    gold = work.zones.read("gold", work.current_run("gold"))
    train, _ = training_split(gold, CONFIG)
    model = load_latest_model(work.spark, CONFIG, work.root_dir)
    return F.lit(op.gradient_share(model, train) < SMALL_GRADIENT)


@query
def e2e_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the train job recorded: exact counts, and what must hold of a fit."""
    metric = {name: F.col("metrics")[name] for name in ("eval_loss", "eval_accuracy", "eval_rows")}
    truth = {t: sum(F.col("metrics")[f"eval_true_{t}_predicted_{p}"] for p in (0, 1)) for t in (0, 1)}
    right = sum(F.col("metrics")[f"eval_true_{t}_predicted_{t}"] for t in (0, 1))
    work = _trained(spark, sf_dir)
    return src.read_model_runs(spark, work.root_dir).select(
        "experiment",
        metric["eval_rows"].cast("long").alias("eval_rows"),
        *[truth[t].cast("long").alias(f"eval_true_{t}") for t in (0, 1)],
        ((metric["eval_loss"] > 0) & (metric["eval_loss"] < 10)).alias("loss_is_finite"),
        (F.abs(metric["eval_accuracy"] * metric["eval_rows"] - right) < 0.5).alias("accuracy_is_share_of_right"),
        _is_fitted(work).alias("weights_are_fitted"),
    )


@query
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recorded run: experiment, parameters and names of metrics."""
    runs = src.read_model_runs(spark, _trained(spark, sf_dir).root_dir)
    return runs.select(
        "experiment",
        F.array_join(F.array_sort(F.transform(F.map_entries("params"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ";").alias("params"),
        F.array_join(F.array_sort(F.map_keys("metrics")), ";").alias("metric_names"),
        F.endswith("model_path", F.concat(F.lit("/models/"), F.col("run_id"))).alias("model_is_kept"),
    )


def _predicted(records: DataFrame, root_dir: str, table: str, config: TrainingConfig = CONFIG, **options) -> DataFrame:
    """Results table of a predict job over a new predict zone below ``root_dir`` whose bronze holds ``records``."""
    spark = records.sparkSession
    work = Workspace(spark, root_dir, "predict")
    _land(work, records)
    silver_job(work)
    gold_job(work)
    predict_job(work, config, table=table, path=scratch_path(spark, table), **options)
    return spark.table(table)


def _checked(results: DataFrame, recomputed: DataFrame) -> DataFrame:
    """The results, and whether label and score are those that the stored weights give."""
    one = F.col("recomputed")
    chosen = F.when(F.col("label") == "Above_3", one).when(F.col("label") == "Below_3", 1 - one)
    # Both sides have a row for each item: neither is to go through the driver.
    return results.hint("merge").join(recomputed, "oracle_id", "left").select(
        "oracle_id",
        "name",
        "image_link",
        "price",
        F.coalesce(chosen >= 0.5, F.lit(False)).alias("label_is_likelier"),
        F.coalesce(F.abs(F.col("score").cast("double") - chosen) < 1e-9, F.lit(False)).alias("score_is_recomputed"),
    )


def _landed_records(work: Workspace) -> DataFrame:
    """The records of the bronze zone, to be landed in another one: their tables are joined once."""
    return work.zones.read("bronze", work.current_run())


def _predict_gold(spark: SparkSession, root_dir: str) -> DataFrame:
    work = Workspace(spark, root_dir, "predict")
    return op.with_row_text(work.zones.read("gold", work.current_run("gold")))


@query
def e2e_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, then score the predict zone of the same lake; every score again from the stored weights."""
    work = _trained(spark, sf_dir)
    results = _predicted(_landed_records(work), work.root_dir, "results")
    model = load_latest_model(spark, CONFIG, work.root_dir)
    checked = _checked(results, op.recomputed_scores(model, _predict_gold(spark, work.root_dir)))
    return checked.withColumn("weights_are_fitted", _is_fitted(work))


@query
def e2e_predict_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a model on token ids."""
    config = replace(CONFIG, classifier="tokens", max_length=32, batches=4)
    work = _refined(spark, sf_dir, "train")
    train_job(work, config)
    results = _predicted(_landed_records(work), work.root_dir, "results_tokens", config)
    path = latest_model_path(spark, config, work.root_dir)
    rows = token_rows(_predict_gold(spark, work.root_dir), path, config.max_length)
    return _checked(results, op.recomputed_token_scores(path, rows))


@query
def e2e_predict_scorer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predict job with a scorer of the caller's."""
    root_dir = scratch_path(spark, "lake-predict")
    return _predicted(bronze_records(spark, sf_dir), root_dir, "results_scorer", scorer=_length_scorer(110))
