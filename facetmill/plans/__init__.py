"""Jobs that chain the steps through the zones."""

from .jobs import (
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

__all__ = [
    "IncompleteLoadError",
    "TrainingConfig",
    "Workspace",
    "bronze_job",
    "gold_job",
    "predict_df",
    "predict_job",
    "read_bronze_history",
    "read_load_status",
    "read_quarantine",
    "silver_job",
    "train_job",
    "train_model",
    "write_predict_results",
]
