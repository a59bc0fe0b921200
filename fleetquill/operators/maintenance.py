"""Which tables are due for vacuum or optimize."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetquill.functions import dates


def with_next_run(control: DataFrame, task: str) -> DataFrame:
    """Next run: last run plus the interval; null before the first run."""
    return control.withColumn(
        f"{task}_next_run", F.date_add(f"{task}_last_run", F.col("days"))
    )


def due(control: DataFrame, task: str, today: str | dt.date) -> DataFrame:
    """Switched-on tables whose next run has come; a table never treated is due."""
    planned = with_next_run(control, task)
    next_run = F.col(f"{task}_next_run")
    return planned.where(
        F.col(f"{task}_flag")
        & (F.col(f"{task}_last_run").isNull() | (next_run <= dates.as_date(today)))
    )
