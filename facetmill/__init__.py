"""Nested product records to model-ready rows and scored results, on Spark."""

from .operators import gold_transform, select_faces, silver_transform
from .plans import (
    IncompleteLoadError,
    TrainingConfig,
    Workspace,
    bronze_job,
    gold_job,
    predict_df,
    predict_job,
    read_bronze_history,
    read_load_status,
    read_quarantine,
    silver_job,
    train_job,
    train_model,
    write_predict_results,
)
from .sources import ZoneStore, flatten_pages

__all__ = [
    "IncompleteLoadError",
    "TrainingConfig",
    "Workspace",
    "ZoneStore",
    "bronze_job",
    "flatten_pages",
    "gold_job",
    "gold_transform",
    "predict_df",
    "predict_job",
    "read_bronze_history",
    "read_load_status",
    "read_quarantine",
    "select_faces",
    "silver_job",
    "silver_transform",
    "train_job",
    "train_model",
    "write_predict_results",
]
