"""Rewrites that become visible in one step.

A rewrite is written into a version folder of its own, which no reader looks into.
One row appended to the publications then says which months the version holds from
now on. Readers take each month from the version published last for it, so a rewrite
that fails half way changes nothing, and one that is published changes all its months
at once. As before, a table has one writer at a time.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from fareloom.functions.months import Months, month_list

PUBLICATIONS = (
    "sequence long, layer string, table_name string, version string, months array<string>, "
    "held array<string>, whole boolean, published_at timestamp_ntz"
)


@dataclass(frozen=True)
class Staged:
    """A written version that is not published yet.

    It replaces ``months``, or all of the table if ``whole``, and has rows in those
    ``held``.
    """

    layer: str
    table: str
    version: str
    months: tuple[str, ...]
    held: tuple[str, ...]
    whole: bool = False


def stage(
    root: str,
    layer: str,
    table: str,
    rows: DataFrame,
    partition: str,
    arrange: Callable[[DataFrame], DataFrame],
    months: Months = None,
    whole: bool = False,
) -> Staged:
    """Write the rows as a version of the table under ``root``, arranged into files.

    Without ``months`` it replaces those that it holds. Which these are is told by the
    names of the partitions that were written; their files are listed and not opened.
    """
    version = f"v{dt.datetime.now(dt.UTC):%Y%m%d%H%M%S}-{uuid.uuid4().hex[:12]}"
    path = f"{root}/version={version}"
    arrange(rows).write.mode("errorifexists").partitionBy(partition).parquet(path)
    files = rows.sparkSession.read.schema(rows.schema).parquet(path).inputFiles()
    named = re.compile(rf"/{re.escape(partition)}=(\d{{4}}-\d{{2}})")
    held = tuple(sorted({found[1] for file in files if (found := named.search(file))}))
    return Staged(layer, table, version, tuple(month_list(months) or held), held, whole)


def publications(spark: SparkSession, log: str) -> list[dict]:
    """All publications in order: a row for each rewrite."""
    try:
        rows = spark.read.schema(PUBLICATIONS).parquet(log).orderBy("sequence").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [row.asDict() for row in rows]


def publish(spark: SparkSession, log: str, staged: Iterable[Staged]) -> None:
    """Make versions current, all of them by one file that appears at once."""
    number = max((row["sequence"] for row in publications(spark, log)), default=0) + 1
    when = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    rows = [
        (number, s.layer, s.table, s.version, list(s.months), list(s.held), s.whole, when) for s in staged
    ]
    spark.createDataFrame(rows, PUBLICATIONS).coalesce(1).write.mode("append").parquet(log)


def current(spark: SparkSession, log: str, layer: str, table: str) -> dict[str, str] | None:
    """Version of every month that has rows; ``None`` if nothing was ever published."""
    found = [r for r in publications(spark, log) if (r["layer"], r["table_name"]) == (layer, table)]
    if not found:
        return None
    versions: dict[str, str] = {}
    for row in found:
        gone = set(versions) if row["whole"] else set(row["months"])
        versions = {month: version for month, version in versions.items() if month not in gone}
        versions |= dict.fromkeys(row["held"], row["version"])
    return versions


def paths(root: str, partition: str, versions: dict[str, str], months: Months = None) -> list[str]:
    """One glob a version for its current months, or for those of them asked for."""
    wanted = month_list(months)
    chosen: dict[str, list[str]] = {}
    for month, version in sorted(versions.items()):
        if wanted is None or month in wanted:
            chosen.setdefault(version, []).append(month)
    return [f"{root}/version={version}/{partition}={{{','.join(ms)}}}*" for version, ms in chosen.items()]


def vacuum(spark: SparkSession, log: str, root: str, layer: str, table: str) -> list[str]:
    """Delete the versions no month is read from any more; returns their names.

    To be run when no reader that began before the last publication is still busy.
    """
    versions = current(spark, log, layer, table)
    if versions is None:
        return []
    names = {r["version"] for r in publications(spark, log) if (r["layer"], r["table_name"]) == (layer, table)}
    gone = sorted(names - set(versions.values()))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    deleted = []
    for name in gone:
        path = hadoop.Path(f"{root}/version={name}")
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True):
            deleted.append(name)
    return deleted
