from __future__ import annotations

import os
import random
import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta, timezone

import pytest
from cards import CARDS, bronze, card
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from facetmill.schemas import page_schema, string_schema
from facetmill.sources import (
    ZoneStore,
    append_model_run,
    cohort,
    current_run,
    flatten_pages,
    latest_model_runs,
    new_run,
    page_records,
    page_status,
    quarantined_lines,
    read_model_runs,
    read_pages,
    read_runs,
    read_table,
    record_step,
    run_states,
    stage_pages,
    staged_status,
    step_details,
    write_results_table,
    write_table,
    zones,
)
from facetmill.sources.runs import RUN_SCHEMA, _claimed, run_log

RECORD = string_schema(["v"])


# --- zones -------------------------------------------------------------------


def test_zone_paths(spark):
    assert ZoneStore(spark, "/lake/", "train").path("silver", "7") == "/lake/silver/train/train_silver_7.parquet"
    text = ZoneStore(spark, "/lake", "predict", "text")
    assert text.path("bronze", "7") == "/lake/bronze/predict/predict_bronze_7.json"
    assert text.path("gold", "7") == "/lake/gold/predict/predict_gold_7.csv"


def test_zone_checks(spark):
    for bad in (dict(mode="other"), dict(mode="train", layout="xml")):
        with pytest.raises(ValueError):
            ZoneStore(spark, "/lake", **bad)
    with pytest.raises(ValueError):
        ZoneStore(spark, "/lake", "train").path("copper", "7")


@pytest.mark.parametrize("layout", ["columnar", "text"])
def test_bronze_survives_a_zone(spark, rows, tmp_path, layout):
    zones = ZoneStore(spark, str(tmp_path), "train", layout)
    zones.write(bronze(spark), "bronze", "1")
    zones.write(bronze(spark), "bronze", "1")
    assert rows(zones.read("bronze", "1")) == rows(bronze(spark))
    assert zones.read("bronze", "1", infer=True).count() == len(CARDS)


def test_one_line_array_is_one_row_per_element(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('[{"oracle_id": "a"}, {"oracle_id": "b"}]')
    assert [r.oracle_id for r in read_table(spark, str(path), "json").collect()] == ["a", "b"]


def test_csv_rows_stay_whole(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([("a\nb", "1\n"), ("c", "2")], "a string, b string"), path, "csv")
    assert rows(read_table(spark, path, "csv")) == [{"a": "a b", "b": "1"}, {"a": "c", "b": "2"}]


def test_csv_header_must_match(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([("1", "2")], "a string, b string"), path, "csv")
    assert read_table(spark, path, "csv", string_schema(["a", "b"])).first()["b"] == "2"
    with pytest.raises(Exception, match="header"):
        read_table(spark, path, "csv", string_schema(["b", "a"])).collect()


def test_results_table_is_overwritten(spark, tmp_path):
    for n in (3, 2):
        write_results_table(spark.range(n), "results_test", path=str(tmp_path / "results"))
        assert spark.table("results_test").count() == n
    write_results_table(spark.range(1), "results_managed")
    write_results_table(spark.range(4), "results_managed")
    assert spark.table("results_managed").count() == 4


def test_readers_see_whole_versions_while_results_are_replaced(spark, tmp_path):
    path, seen, done = str(tmp_path / "results"), [], threading.Event()
    version = lambda k: spark.range(0, 2000, 1, 3).withColumn("version", F.lit(k))
    write_results_table(version(0), "results_read", path=path, keep=2)

    def read():
        while not done.is_set():
            row = spark.table("results_read").agg(F.count("*"), F.min("version"), F.max("version")).first()
            seen.append(tuple(row))

    with ThreadPoolExecutor(1) as pool:
        reader = pool.submit(read)
        for k in range(1, 6):
            write_results_table(version(k), "results_read", path=path, keep=2)
        done.set()
        reader.result()
    assert len(seen) > 2 and all(n == 2000 and low == high for n, low, high in seen)
    assert spark.table("results_read").agg(F.min("version")).first()[0] == 5
    assert len(os.listdir(path)) == 3
    write_results_table(spark.range(2).toDF("other"), "results_read", path=path)
    assert spark.table("results_read").columns == ["other"]


# --- runs --------------------------------------------------------------------


def _complete(spark, root, mode, identifier, step="bronze"):
    record_step(spark, root, mode, identifier, step, "started")
    record_step(spark, root, mode, identifier, step, "complete", {"rows": 3})


def test_current_run_is_the_last_complete_one_of_its_mode(spark, tmp_path):
    root = str(tmp_path)
    at = datetime(2024, 7, 18, 9, 5, 3, tzinfo=timezone.utc)
    assert new_run(spark, root, "train", at) == "240718090503"
    with pytest.raises(LookupError):
        current_run(spark, root, "train")
    for mode, identifier in [("train", "240718090503"), ("predict", "250101000000"), ("train", "200101000000")]:
        _complete(spark, root, mode, identifier)
    record_step(spark, root, "train", "240718100000", "bronze", "started")
    record_step(spark, root, "train", "240718110000", "bronze", "failed", {"error": "x"})
    assert current_run(spark, root, "train") == "240718090503"
    assert current_run(spark, root, "predict") == "250101000000"
    with pytest.raises(LookupError):
        current_run(spark, root, "train", "silver")
    _complete(spark, root, "train", "200101000000", "silver")
    assert current_run(spark, root, "train", "silver") == "200101000000"
    assert step_details(spark, root, "train", "200101000000", "silver") == {"rows": "3"}
    with pytest.raises(LookupError):
        current_run(spark, root, "test")
    with pytest.raises(ValueError):
        new_run(spark, root, "other")
    with pytest.raises(ValueError):
        record_step(spark, root, "train", "1", "copper", "started")
    assert len(new_run(spark, root, "test")) == 12


def test_runs_of_one_second_have_their_own_identifiers(spark, tmp_path):
    at = datetime(2024, 7, 18, 9, 59, 59, tzinfo=timezone.utc)
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda _: new_run(spark, str(tmp_path), "train", at), range(6)))
    assert sorted(got) == ["240718095959", *[f"24071810000{k}" for k in range(5)]]


def test_one_of_many_at_a_time_claims_an_identifier(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        for k in range(40):
            claimed = list(pool.map(lambda _: _claimed(spark, f"file://{tmp_path}", "train", f"2407181000{k:02d}"), range(8)))
            assert sum(claimed) == 1


def test_latest_run_is_found_in_few_files_among_many(spark, tmp_path):
    """Ten thousand runs: only the newest hours are read, even if their runs all failed."""
    root, rows = str(tmp_path), []
    for k in range(10_000):
        hour, own = divmod(k, 20)
        identifier = f"{datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(hours=hour, seconds=own):%y%m%d%H%M%S}"
        rows.append(("train", identifier, "bronze", "failed" if k >= 9_970 else "complete", None, {}, identifier[:8]))
    log = spark.createDataFrame(rows, f"{RUN_SCHEMA}, slot string")
    log.repartition("slot").write.partitionBy("slot").parquet(f"{root}/runs/train")
    read = []
    for part in run_log(spark, root, "train").newest_first():
        read += part.inputFiles()
        if not part.filter("state = 'complete'").isEmpty():
            break
    assert len(read) <= 3
    assert current_run(spark, root, "train") == rows[9_969][1]
    assert run_states(read_runs(spark, root, "train")).count() == 10_000


def test_model_runs(spark, rows, tmp_path):
    root = str(tmp_path)
    for run_id, year in [("r2", 2022), ("r3", 2023), ("r1", 2021)]:
        append_model_run(
            spark, root, run_id, "exp", datetime(year, 1, 1, tzinfo=timezone.utc), {"epochs": 3}, {"loss": 1}, f"m/{run_id}"
        )
    runs = read_model_runs(spark, root)
    assert rows(latest_model_runs(runs)) == [{"experiment": "exp", "run_id": "r3", "model_path": "m/r3"}]
    assert runs.first()["params"] == {"epochs": "3"} and runs.first()["metrics"] == {"loss": 1.0}


# --- pages -------------------------------------------------------------------


def _brute_force(pages):
    """Walk every request's pages in order, as a client would."""
    kept, status = [], {}
    for request in {p["request_id"] for p in pages}:
        status[request] = ("open", None)
        for page in sorted((p for p in pages if p["request_id"] == request), key=lambda p: p["page_no"]):
            if page["object"] == "error" or page["data"] is None:
                status[request] = ("error" if page["object"] == "error" else "invalid", page["page_no"] - 1)
                break
            kept += [(request, page["page_no"], item["v"]) for item in page["data"]]
            if not page["has_more"]:
                status[request] = ("complete", page["page_no"])
                break
    return sorted(kept, key=repr), status


def _random_pages(seed):
    rng = random.Random(seed)
    pages = []
    for request in ["hot", "a", "b", "c", None]:
        for page_no in range(60 if request == "hot" else rng.randint(1, 8)):
            pages.append(
                {
                    "request_id": request,
                    "page_no": page_no,
                    "object": rng.choices(["list", "error", None], [30, 1, 2])[0],
                    "data": None if rng.random() < 0.04 else [{"v": f"{request}{page_no}{i}"} for i in range(rng.randint(0, 3))],
                    "has_more": rng.choices([True, False, None], [30, 1, 1])[0],
                    "next_page": None,
                    "code": None,
                    "status": None,
                }
            )
    return pages


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
@pytest.mark.parametrize("seed", range(4))
def test_pages_equal_a_serial_walk(spark, seed, broadcast_bytes):
    pages = _random_pages(seed)
    schema = page_schema(RECORD)
    df = spark.createDataFrame([tuple(p[n] for n in schema.fieldNames()) for p in pages], schema).repartition(3)
    kept, status = _brute_force(pages)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, str(broadcast_bytes or -1))
    got = flatten_pages(df, broadcast_bytes=broadcast_bytes)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("SortMergeJoin" in plan) == (broadcast_bytes == 0)
    assert got.columns == ["request_id", "page_no", "v"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == kept
    assert {r.request_id: (r.status, r.last_page) for r in page_status(df).collect()} == status
    spark.conf.unset(threshold)


def test_broken_lines_are_quarantined(spark, tmp_path):
    lines = [
        '{"request_id":"r","page_no":0,"object":"list","has_more":true,"data":[{"v":"a"}]}',
        '{"request_id":"r","page_no":1,"object":"list","has_more":true,"data":[{"v":"b"',
        "no page at all",
        '{"request_id":"r","page_no":"two","object":"list","has_more":false,"data":[{"v":"c"}]}',
    ]
    (tmp_path / "p.json").write_text("\n".join(lines))
    pages = read_pages(spark, str(tmp_path), RECORD, keep_all=False)
    staged = stage_pages(pages, F.col("v") != "x")
    assert sorted(r.malformed_line for r in quarantined_lines(staged).collect()) == sorted(lines[1:])
    got = {r.request_id: (r.status, r.pages, r.unnumbered_pages) for r in staged_status(staged).collect()}
    assert got == {"r": ("complete", 2, 1), None: ("malformed", 2, 2)}


def test_staging_opens_pages_once_and_keeps_names_apart(spark):
    """Records with the page's own field names; only wanted ones are staged, next to one row per page."""
    record = string_schema(["request_id", "page_no", "page", "v"])
    rows = [("r", 0, "list", [("own", "x", "p", "a"), ("own", "y", "q", "b")], True), ("r", 1, "list", [], True), ("r", 2, "list", [("o", "z", "r", "a")], False), ("s", 0, "list", None, True)]
    pages = spark.createDataFrame(rows, StructType(page_schema(record).fields[:5]))
    staged = stage_pages(pages, F.col("v") == "a")
    assert staged.count() == 4 and staged.filter("wanted").count() == 2
    status = staged_status(staged)
    assert {tuple(r) for r in status.collect()} == {("r", "complete", 2, 3, 0), ("s", "invalid", -1, 1, 0)}
    got = page_records(staged, status).select("page_no", "record.*").collect()
    assert sorted(map(tuple, got)) == [(0, "own", "x", "p", "a"), (2, "o", "z", "r", "a")]
    plan = status._jdf.queryExecution().executedPlan().toString()
    assert "record" not in plan[plan.index("ReadSchema") :]


def test_landed_page_files(spark, tmp_path):
    (tmp_path / "p0.json").write_text('{"request_id":"r","page_no":0,"object":"list","has_more":true,"data":[{"v":"a"},{"v":"b"}]}')
    (tmp_path / "p1.json").write_text('{"request_id":"r","page_no":1,"object":"list","data":[{"v":"c"}]}')
    (tmp_path / "p2.json").write_text('{"request_id":"r","page_no":2,"object":"list","data":[{"v":"late"}]}')
    (tmp_path / "q0.json").write_text('{"request_id":"q","page_no":0,"object":"list","data":"text"}')
    pages = read_pages(spark, str(tmp_path), RECORD)
    assert sorted(r.v for r in flatten_pages(pages).collect()) == ["a", "b", "c"]
    assert {r.request_id: r.status for r in page_status(pages).collect()} == {"r": "complete", "q": "invalid"}


# --- cohorts -----------------------------------------------------------------

AS_OF = date(2024, 7, 18)


def _chosen(spark, records, mode, **options):
    return sorted(r.oracle_id for r in bronze(spark, records).filter(cohort(mode, AS_OF, **options)).collect())


def test_predict_cohort(spark):
    records = [
        card("edge", released_at=date(2024, 6, 18)),
        card("in", released_at=date(2024, 6, 19)),
        card("reprint", released_at=AS_OF, reprint=True),
        card("digital", released_at=AS_OF, digital=True),
        card("unknown", released_at=AS_OF, reprint=None),
    ]
    assert _chosen(spark, records, "predict") == ["in"]
    assert _chosen(spark, records, "predict", predict_days=31) == ["edge", "in"]


def test_train_cohort(spark):
    good = dict(usd="0.10", legacy="legal", released_at=date(2011, 1, 1))
    records = [
        card("in", **good),
        card("old", **{**good, "released_at": date(2010, 12, 31)}),
        card("new", **{**good, "released_at": date(2023, 7, 19)}),
        card("edge", **{**good, "released_at": date(2023, 7, 18)}),
        card("banned", **{**good, "legacy": "banned"}),
        card("free", **{**good, "usd": "0.0"}),
        card("foil", **{**good, "usd": None}, usd_foil="3"),
        card("text", **{**good, "usd": "n/a"}),
    ]
    # A leap day lies between, so 365 days before is 2023-07-19.
    assert _chosen(spark, records, "train") == ["edge", "in"]
    assert _chosen(spark, records, "train", train_days=366) == ["in"]


def test_name_cohort(spark):
    records = [card("a", name="Amber lamp"), card("b", name="Will"), card("c", name="CHAMBERS")]
    assert _chosen(spark, records, "test", term="amber") == ["a", "c"]
    with pytest.raises(ValueError):
        cohort("test")


def test_cohort_default_date_and_mode(spark):
    recent = bronze(spark, [card("now", released_at=date.today())])
    assert recent.filter(cohort("predict")).count() == 1
    with pytest.raises(ValueError):
        cohort("")


def test_cohort_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "bronze")
    bronze(spark).write.parquet(path)
    chosen = spark.read.parquet(path).filter(cohort("train", AS_OF))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(released_at" in pushed and "EqualTo(legalities.legacy,legal)" in pushed


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_row_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch, fmt):
    """every row repeats names and marks, which take most of the room."""
    monkeypatch.setitem(zones._COMPRESSED, "maxRecordsPerFile", "400")
    path = str(tmp_path / "t")
    write_table(spark.range(0, 1000, 1, 1).selectExpr("cast(id as string) id", "repeat('text ', 40) text"), path, fmt)
    files = list((tmp_path / "t").glob("part-*"))
    assert len(files) == 3 and sum(f.stat().st_size for f in files) < 50_000
    read = read_table(spark, path, fmt)
    assert read.count() == 1000 and read.select("id").distinct().count() == 1000
