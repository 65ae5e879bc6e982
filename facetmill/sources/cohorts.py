"""Which bronze records a mode works on."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import check_mode


def _days_before(as_of: date | None, days: int) -> Column:
    today = F.current_date() if as_of is None else F.lit(as_of)
    return F.date_sub(today, days)


def predict_cohort(as_of: date | None = None, days: int = 30) -> Column:
    """First prints, not digital, released within the last ``days``."""
    return ~F.col("reprint") & ~F.col("digital") & (F.col("released_at") > _days_before(as_of, days))


def train_cohort(as_of: date | None = None, days: int = 365, since_year: int = 2011) -> Column:
    """Legacy-legal, priced, released from ``since_year`` on and more than ``days`` ago.

    The year is compared as a date so that the filter reaches the scan.
    """
    return (
        (F.col("legalities.legacy") == "legal")
        & (F.col("released_at") >= F.lit(date(since_year, 1, 1)))
        & (F.col("released_at") < _days_before(as_of, days))
        & (F.col("prices.usd").try_cast("double") > 0)
    )


def name_cohort(term: str) -> Column:
    """Names that hold ``term``."""
    return F.lower("name").contains(term.lower())


def cohort(
    mode: str,
    as_of: date | None = None,
    predict_days: int = 30,
    train_days: int = 365,
    since_year: int = 2011,
    term: str | None = None,
) -> Column:
    """The filter of ``mode``; the test mode needs a ``term``."""
    match check_mode(mode):
        case "train":
            return train_cohort(as_of, train_days, since_year)
        case "predict":
            return predict_cohort(as_of, predict_days)
        case _:
            if term is None:
                raise ValueError("the test cohort needs a term")
            return name_cohort(term)
