from __future__ import annotations

import json
import os
from datetime import date, datetime, timezone

import pytest
from cards import CARDS, bronze, card
from pyspark.sql import Window
from pyspark.sql import functions as F

from facetmill import IncompleteLoadError, Workspace, bronze_job, gold_job, predict_df, predict_job, read_bronze_history, read_load_status, silver_job, train_job
from facetmill.plans import TrainingConfig
from facetmill.plans.jobs import load_latest_model
from facetmill.schemas import RESULT_COLUMNS, gold_columns
from facetmill.session import materialise, scratch, scratch_path
from facetmill.operators import distinct_faces, gold_transform, observed_faces
from facetmill.sources import ZoneStore, read_model_runs, read_pages, run_states

CONFIG = {"model_name": "m", "experiment_path": "/e", "num_features": 64, "max_iter": 3, "unknown": 1}
AS_OF = date(2020, 1, 20)


def _pages(records):
    return records.select(
        F.lit("r").alias("request_id"),
        F.row_number().over(Window.orderBy("oracle_id")).alias("page_no"),
        F.lit("list").alias("object"),
        F.array(F.struct(*records.columns)).alias("data"),
        F.lit(True).alias("has_more"),
    )


def _run(spark, root, mode, layout="columnar", records=None):
    work = Workspace(spark, root, mode, layout)
    identifier = bronze_job(work, _pages(bronze(spark, records)), AS_OF, term="amber")
    assert silver_job(work) == gold_job(work) == identifier == work.current_run()
    return work


@pytest.mark.parametrize("mode", ["predict", "test"])
def test_layouts_agree(spark, rows, tmp_path, mode):
    records = CARDS + [card("f", name="Amber", oracle_text=" (only) \r ", mana_cost='"1 part;', type_line="a\\")]
    if mode == "test":
        records = [{**r, "name": f"amber {r['name']}"} for r in records]
    got = {}
    for layout in ("columnar", "text"):
        work = _run(spark, str(tmp_path / layout), mode, layout, records)
        got[layout] = rows(work.zones.read("gold", work.current_run()))
    assert got["columnar"] == got["text"]
    assert len(got["text"]) == 6 and set(got["text"][0]) == set(gold_columns(mode))


def test_train_then_predict(spark, tmp_path):
    root = str(tmp_path)
    priced = [
        card(f"t{i}", str(i % 7), legacy="legal", released_at=date(2015, 1, 1), oracle_text=f"word{i % 7} more")
        for i in range(60)
    ]
    run_id = train_job(_run(spark, root, "train", records=priced), CONFIG)
    (run,) = read_model_runs(spark, root).collect()
    assert run.run_id == run_id and run.experiment == "/e/m"
    assert run.params["max_iter"] == "3" and run.metrics["eval_rows"] > 0

    work = _run(spark, root, "predict")
    predict_job(work, CONFIG, table="results_job", path=str(tmp_path / "results"))
    results = spark.table("results_job")
    assert results.columns == RESULT_COLUMNS and results.count() == len(CARDS)
    assert {r.label for r in results.collect()} <= {"Below_3", "Above_3"}

    gold = work.zones.read("gold", work.current_run())
    assert predict_df(gold, CONFIG, root).columns == [*gold_columns("predict"), "label", "score"]
    fixed = predict_df(gold, CONFIG, root, scorer=lambda: lambda texts: [[{"label": "Above_3", "score": 0.85}]] * len(texts))
    assert {(r.label, r.score) for r in fixed.collect()} == {("Above_3", 0.85)}
    with pytest.raises(LookupError):
        load_latest_model(spark, {"model_name": "other"}, root)


def test_jobs_pick_the_current_run(spark, tmp_path):
    work = Workspace(spark, str(tmp_path), "predict")
    for hour, records in [(1, CARDS), (2, CARDS[:2])]:
        bronze_job(work, _pages(bronze(spark, records)), AS_OF, datetime(2024, 1, 1, hour, tzinfo=timezone.utc))
    silver_job(work)
    assert work.zones.read("silver", "240101020000").count() == 2


def test_bronze_records_how_requests_ended(spark, tmp_path):
    good = _pages(bronze(spark))
    bad = good.limit(1).withColumns({"request_id": F.lit("bad"), "object": F.lit("error"), "page_no": F.lit(None).cast("int")})
    pages = good.withColumn("has_more", F.col("page_no") < len(CARDS)).unionByName(bad)
    work = Workspace(spark, str(tmp_path), "predict")
    bronze_job(work, pages, AS_OF)
    got = {r.request_id: (r.status, r.last_page, r.pages, r.unnumbered_pages) for r in read_load_status(work).collect()}
    assert got == {"r": ("complete", len(CARDS), len(CARDS), 0), "bad": ("error", None, 1, 1)}
    with pytest.raises(IncompleteLoadError, match="bad"):
        bronze_job(work, pages, AS_OF, require_complete=True)
    whole = bronze_job(work, pages.filter("request_id = 'r'"), AS_OF, require_complete=True)
    assert work.current_run() == whole


def test_bronze_keeps_every_field_of_a_record(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    record = {"oracle_id": "x", "name": "Lamp", "reprint": False, "digital": False, "released_at": "2020-01-19", "colour": "red", "prices": {"usd": "1", "eur": "2"}}
    (landed / "p.json").write_text(json.dumps({"request_id": "r", "page_no": 0, "object": "list", "data": [record]}))
    work = Workspace(spark, str(tmp_path / "lake"), "predict")
    identifier = bronze_job(work, read_pages(spark, str(landed)), AS_OF)
    kept = work.zones.read("bronze", identifier, infer=True).first()
    assert kept.colour == "red" and kept.prices.eur == "2" and kept.oracle_id == "x"
    silver_job(work)
    assert work.zones.read("silver", identifier).count() == 1


@pytest.mark.parametrize("layout", ["columnar", "text"])
def test_loads_with_different_fields_read_as_one(spark, tmp_path, layout):
    work = Workspace(spark, str(tmp_path / "lake"), "predict", layout)
    base = {"name": "Lamp", "reprint": False, "digital": False, "released_at": "2020-01-19"}
    loads = [{"oracle_id": "x", "size": 4, "prices": {"usd": "1", "eur": "2"}}, {"oracle_id": "y", "size": "large", "parts": [{"n": 1}]}]
    runs = []
    for k, own in enumerate(loads):
        landed = tmp_path / f"landed{k}"
        landed.mkdir()
        (landed / "p.json").write_text(json.dumps({"request_id": "r", "page_no": 0, "object": "list", "data": [base | own]}))
        runs.append(bronze_job(work, read_pages(spark, str(landed)), AS_OF))
    got = {r.run_identifier: r for r in read_bronze_history(work).collect()}
    assert [got[i].size for i in runs] == ["4", "large"] and [got[i].oracle_id for i in runs] == ["x", "y"]
    assert got[runs[0]].prices.eur == "2" and got[runs[1]].prices is None
    assert got[runs[0]].parts is None and got[runs[1]].parts[0].n == 1
    with pytest.raises(LookupError):
        read_bronze_history(Workspace(spark, str(tmp_path / "other"), "predict", layout))


def test_silver_on_inferred_bronze(spark, tmp_path):
    work = Workspace(spark, str(tmp_path), "train")
    with work.step("bronze", identifier := work.new_run()):
        work.zones.write(bronze(spark).drop("card_faces", "loyalty"), "bronze", identifier)
    got = {r.oracle_id: r for r in work.zones.read("silver", silver_job(work, infer=True)).collect()}
    assert len(got) == len(CARDS) and got["c"].bottomright_value is None and got["b"].bottomright_value == "40/30"


def test_scratch_is_removed_with_its_job(spark):
    with scratch(spark):
        df = materialise(spark.range(3), "kept")
        folder = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(folder) and df.count() == 3
    assert not os.path.exists(folder)


def test_threads_keep_their_scratch_folders_apart(spark):
    from concurrent.futures import ThreadPoolExecutor

    with scratch(spark):
        own = materialise(spark.range(3), "own")
        with ThreadPoolExecutor(1) as pool:
            def other():
                with scratch(spark):
                    return materialise(spark.range(4), "other").inputFiles()[0].removeprefix("file://")

            gone = pool.submit(other).result()
        assert not os.path.exists(gone) and own.count() == 3


def test_failed_steps_leave_the_run_before_current(spark, tmp_path):
    """A failed load, a failed silver and a failed gold: each job goes on from the last whole run."""
    work = Workspace(spark, str(tmp_path), "predict")
    pages = _pages(bronze(spark)).withColumn("has_more", F.col("page_no") < len(CARDS))
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    first = bronze_job(work, pages, AS_OF, at, require_complete=True)
    with pytest.raises(IncompleteLoadError):
        bronze_job(work, pages.withColumn("has_more", F.lit(True)), AS_OF, at, require_complete=True)
    assert work.current_run() == first
    assert silver_job(work) == gold_job(work) == first
    second = bronze_job(work, pages, AS_OF, at)
    with pytest.raises(ValueError):
        silver_job(work, combine="none such")
    assert work.current_run() == second and gold_job(work) == first
    assert silver_job(work) == second
    with pytest.raises(ValueError):
        gold_job(work, widen="none such")
    assert work.current_run("gold") == first
    assert first == "240101000000" and second == "240101000002"
    states = {(r.identifier, r.step): r.state for r in run_states(work.runs()).collect()}
    assert states == {
        (first, "bronze"): "complete",
        (first, "silver"): "complete",
        (first, "gold"): "complete",
        ("240101000001", "bronze"): "failed",
        (second, "bronze"): "complete",
        (second, "silver"): "complete",
        (second, "gold"): "failed",
    }
    assert "IncompleteLoadError" in work.runs().filter("state = 'failed' and step = 'bronze'").first().details["error"]


def test_gold_reads_silver_once_and_decides_as_a_scan_would(spark, tmp_path):
    for name, records in [("two", CARDS), ("one", [c for c in CARDS if c["card_faces"] is None])]:
        work = Workspace(spark, str(tmp_path / name), "predict")
        bronze_job(work, _pages(bronze(spark, records)), AS_OF)
        identifier = silver_job(work)
        silver = work.zones.read("silver", identifier)
        numbers = observed_faces(work.step_details("silver", identifier))
        assert sorted(numbers) == sorted(r[0] for r in distinct_faces(silver).collect())
        tracked = spark.sparkContext.statusTracker()
        before = len(tracked.getJobIdsForGroup(None))
        gold = gold_transform("predict", silver, numbers=numbers)
        assert len(tracked.getJobIdsForGroup(None)) == before
        assert sorted(map(repr, gold.collect())) == sorted(map(repr, gold_transform("predict", silver).collect()))


@pytest.mark.parametrize("seen,numbers", [((2, 0, 0, None, None), ["0"]), ((1, 1, 0, None, None), ["0", "1"]), ((0, 0, 3, "7", "7"), [None, "7"]), ((1, 0, 0, "2", "5"), ["0", "2", "5"]), ((0, 0, 0, None, None), [])])
def test_observed_faces(spark, seen, numbers):
    names = ("faces_0", "faces_1", "faces_null", "faces_other_min", "faces_other_max")
    assert observed_faces(dict(zip(names, seen))) == numbers
    assert observed_faces({k: str(v) for k, v in zip(names, seen)}) == numbers


def test_bucketed_silver_is_grouped_without_an_exchange(spark, rows, tmp_path):
    got = {}
    for layout in ("columnar", "bucketed"):
        work = _run(spark, str(tmp_path / layout), "predict", layout)
        got[layout] = rows(work.zones.read("gold", work.current_run("gold")))
        silver = work.zones.read("silver", work.current_run("silver"))
        plan = gold_transform("predict", silver, widen="pivot")._jdf.queryExecution().executedPlan().toString()
        assert ("Exchange" in plan) == (layout == "columnar")
    assert got["columnar"] == got["bucketed"]
    with pytest.raises(FileNotFoundError):
        ZoneStore(spark, str(tmp_path / "bucketed"), "predict", "bucketed", buckets=3).read("silver", work.current_run("silver")).count()


def test_config_from_mapping():
    config = TrainingConfig.of(CONFIG)
    assert config.experiment == "/e/m" and config.test_size == 0.2
    assert TrainingConfig.of(config) is config


def test_scratch_paths_are_fresh_and_follow_the_session(spark):
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert base is None or one.startswith(base)
