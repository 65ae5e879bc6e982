"""Zones, run tables, landed pages and cohort filters."""

from .cohorts import cohort, name_cohort, predict_cohort, train_cohort
from .pages import (
    flatten_pages,
    load_status,
    page_records,
    page_status,
    quarantined_lines,
    read_pages,
    stage_pages,
    staged_status,
)
from .runs import (
    append_model_run,
    current_run,
    current_runs,
    latest_model_run,
    latest_model_runs,
    latest_runs,
    new_run,
    read_model_runs,
    read_runs,
    record_step,
    run_identifier,
    run_states,
    step_details,
)
from .zones import LAYOUTS, ZoneStore, read_table, record_path, write_results_table, write_table

__all__ = [
    "LAYOUTS",
    "ZoneStore",
    "append_model_run",
    "cohort",
    "current_run",
    "current_runs",
    "flatten_pages",
    "latest_model_run",
    "latest_model_runs",
    "latest_runs",
    "load_status",
    "name_cohort",
    "new_run",
    "page_records",
    "page_status",
    "predict_cohort",
    "quarantined_lines",
    "read_model_runs",
    "read_pages",
    "read_runs",
    "read_table",
    "record_path",
    "record_step",
    "run_identifier",
    "run_states",
    "stage_pages",
    "staged_status",
    "step_details",
    "train_cohort",
    "write_results_table",
    "write_table",
]
