"""Running the checks of written tables, so that a broken one stops no other."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions.months import Months, in_months, month_list
from fareloom.operators import checks, runs
from fareloom.sources.tables import Warehouse


def layer_table(warehouse: Warehouse, layer: str, months: list[str]) -> DataFrame:
    """The table a layer's checks read, cut to the months by its partitions."""
    if layer == "bronze":
        return warehouse.bronze_trips(months)
    if layer == "silver":
        return warehouse.silver_trips(months)
    daily = warehouse.read("gold", "kpi_daily_revenue")
    return daily.where(in_months(F.col("_execution_date"), months))


def error_result(check: checks.Check, month: str, error: Exception) -> dict:
    return {
        "execution_date": month,
        "check_name": check.name,
        "layer": "unknown",
        "table_name": "unknown",
        "status": checks.FAILED,
        "rows_tested": 0,
        "rows_failed": 0,
        "failure_rate": 0.0,
        "threshold": 0.0,
        "details": f"Check raised exception: {error}",
    }


def collect_layer_checks(
    layer: str,
    months: list[str],
    read: Callable[[], DataFrame],
    as_of: dt.datetime | None = None,
    table_name: Callable[[str, str], str] = "{}.{}".format,
) -> list[dict]:
    """Results of a layer as rows: at most three a month.

    All checks run as one job. If it fails each check runs by itself, and those
    that fail again become results of status FAILED.
    """

    def collect(chosen: list[checks.Check]) -> list[dict]:
        frame = checks.run_layer_checks(read(), layer, months, as_of, chosen, table_name)
        return [row.asDict() for row in frame.collect()]

    chosen = checks.checks_of(layer)
    try:
        return collect(chosen)
    except Exception:
        results = []
        for check in chosen:
            try:
                results += collect([check])
            except Exception as error:
                results += [error_result(check, month, error) for month in months]
        return results


def run_quality_checks(
    warehouse: Warehouse,
    months: list[str],
    layers: tuple[str, ...] = checks.LAYERS,
    as_of: dt.datetime | None = None,
) -> list[dict]:
    """Check the written tables of some layers, in order, for each month."""
    results = []
    for layer in layers:
        results += collect_layer_checks(
            layer,
            months,
            lambda layer=layer: layer_table(warehouse, layer, months),
            as_of,
            warehouse.name,
        )
    return results


def run_quality(
    warehouse: Warehouse,
    run_id: str,
    months: Months,
    layers: tuple[str, ...] = checks.LAYERS,
    as_of: dt.datetime | None = None,
    enforce: bool = True,
) -> dict[str, dict]:
    """Check written tables, log the results, sum them up, and stop if one failed.

    Returns for each month how many checks passed, warned and failed, and the verdict.
    The results are logged before the gate, so that a closed gate leaves its reasons.
    """
    wanted = month_list(months) or []
    results = run_quality_checks(warehouse, wanted, layers, as_of)
    runs.log_quality_results(warehouse, run_id, results, as_of or dt.datetime.now(dt.UTC).replace(tzinfo=None))
    summary = {}
    for month in wanted:
        found = [row["status"] for row in results if row["execution_date"] == month]
        failed = found.count(checks.FAILED)
        summary[month] = {
            "passed": found.count(checks.PASSED),
            "warnings": found.count(checks.WARNING),
            "failed": failed,
            "verdict": "FAIL" if failed else "PASS",
        }
    failed = [f"{row['check_name']} ({row['execution_date']})" for row in results if row["status"] == checks.FAILED]
    if failed and enforce:
        raise checks.QualityGateError(f"{len(failed)} check(s) failed: {', '.join(failed)}")
    return summary
