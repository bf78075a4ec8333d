"""Run metadata: events appended by the pipeline, and views on them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.sources.tables import Warehouse, append_metadata, read_metadata

STARTED, COMPLETED, FAILED = "STARTED", "COMPLETED", "FAILED"


def log_run_start(
    warehouse: Warehouse, run_id: str, months: list[str], when: dt.datetime
) -> None:
    """Append a STARTED event per month of the run."""
    rows = [
        {
            "run_id": run_id,
            "execution_date": month,
            "env": warehouse.env,
            "status": STARTED,
            "run_date": when,
        }
        for month in months
    ]
    append_metadata(warehouse, "pipeline_runs", rows)


def log_run_end(
    warehouse: Warehouse, run_id: str, outcomes: list[dict], started: dt.datetime, when: dt.datetime
) -> None:
    """Append the final event of each month.

    An outcome has ``execution_date`` and ``status``, and where known the rows of
    the layers and an ``error_message``.
    """
    common = {
        "run_id": run_id,
        "env": warehouse.env,
        "run_date": when,
        "completed_at": when,
        "duration_seconds": (when - started).total_seconds(),
    }
    append_metadata(warehouse, "pipeline_runs", [{**common, **row} for row in outcomes])


def log_steps(
    warehouse: Warehouse, run_id: str, layer: str, rows: dict[str, int | None], when: dt.datetime
) -> None:
    """Append that a run has finished a layer, for each month with its rows if known."""
    common = {"run_id": run_id, "layer": layer, "finished_at": when}
    append_metadata(
        warehouse, "pipeline_steps", [{**common, "execution_date": m, "rows": n} for m, n in rows.items()]
    )


def finished_steps(warehouse: Warehouse, run_id: str) -> dict[str, dict[str, int | None]]:
    """Months that a run has finished, by layer, with their rows (three rows a month)."""
    steps = read_metadata(warehouse, "pipeline_steps").where(F.col("run_id") == run_id)
    found: dict[str, dict[str, int | None]] = {}
    for row in steps.select("layer", "execution_date", "rows").collect():
        found.setdefault(row["layer"], {})[row["execution_date"]] = row["rows"]
    return found


def log_quality_results(
    warehouse: Warehouse, run_id: str, results: list[dict], when: dt.datetime
) -> None:
    """Append check results under the run that made them."""
    rows = [{**row, "run_id": run_id, "check_timestamp": when} for row in results]
    append_metadata(warehouse, "quality_checks", rows)


def latest_run_status(events: DataFrame) -> DataFrame:
    """One row per run and month: where it stands now and when it began.

    A run has a start event and later an end event; of two events at the same
    time the end event counts.
    """
    ended = (F.col("status") != STARTED).cast("int")
    last = F.max_by(
        F.struct("env", "status", "completed_at", "error_message", "rows_ingested"),
        F.struct("run_date", ended),
    )
    return (
        events.groupBy("run_id", "execution_date")
        .agg(
            F.min("run_date").alias("started_at"),
            F.max("run_date").alias("last_event_at"),
            last.alias("last"),
        )
        .select("run_id", "execution_date", "started_at", "last_event_at", "last.*")
    )


def recent_runs(events: DataFrame, number: int = 20) -> DataFrame:
    """The newest events; Spark keeps only that many rows in every task."""
    newest = [F.desc_nulls_last(name) for name in ("run_date", "run_id", "status")]
    return events.orderBy(*newest).limit(number)


def run_history(events: DataFrame, number: int = 20) -> DataFrame:
    """The newest events with the seconds from their date to completion."""
    return recent_runs(events, number).select(
        "run_id",
        "execution_date",
        "status",
        "run_date",
        "rows_ingested",
        "duration_seconds",
        F.timestamp_diff("SECOND", F.col("run_date"), F.col("completed_at")).alias(
            "total_duration_s"
        ),
        "error_message",
    )


def quality_trend(checks: DataFrame) -> DataFrame:
    """Check results that did not pass, newest first."""
    return (
        checks.where(F.col("status") != "PASSED")
        .select(
            "execution_date",
            "layer",
            "check_name",
            "status",
            "rows_failed",
            "failure_rate",
            "check_timestamp",
        )
        .orderBy(F.desc("check_timestamp"), "layer", "check_name")
    )
