"""Session settings the pipeline relies on."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Trip times carry no zone; UTC keeps every day and hour as recorded.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Size aimed at by AQE when it merges or splits shuffle partitions, and so
    # also the size of the files written.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Small inputs are spread over all cores too. Files do not get smaller by it:
    # tables are written from shuffles by partition value, which are never split
    # below the size above.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    # Rows are wide and compress well; tasks that sort what they scan hold about a
    # million at this size.
    "spark.sql.files.maxPartitionBytes": "32m",
    # A rewrite replaces the partitions it produces and leaves the others.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Directories of days are listed by this many tasks, not one task each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # Percentiles are grouped by day or by hour of the week. The default of 128
    # groups per task would fall back to sorting the input in a backfill.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "1024",
}

BYTES_PER_SHUFFLE_PARTITION = 256 * 1024 * 1024
MOST_SHUFFLE_PARTITIONS = 50_000
#: Rows of a task after a shuffle, about, where bytes do not tell the memory it takes.
ROWS_PER_TASK = 500_000
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
LEAST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.minPartitionNum"


def session(app: str = "fareloom", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session; keyword settings use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    extra = {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session somebody else made."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.unset(LEAST_PARTITIONS)
    return spark


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path``; lists them, reads no content."""
    files: DataFrame = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    )
    return files.selectExpr("sum(length) AS n").first()["n"] or 0


def size_shuffle(spark: SparkSession, input_bytes: int, expansion: float = 4.0) -> int:
    """Start AQE from enough shuffle partitions for ``input_bytes`` of Parquet.

    AQE merges small shuffle partitions but does not split those feeding a
    window or an aggregate, so the starting number has to follow the input.
    ``expansion`` is the growth from compressed columns to shuffled rows. Beyond
    the upper limit partitions only get larger and spill.
    """
    wanted = math.ceil(input_bytes * expansion / BYTES_PER_SHUFFLE_PARTITION)
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = max(current, min(wanted, MOST_SHUFFLE_PARTITIONS))
    spark.conf.set(INITIAL_PARTITIONS, str(number))
    return number


def size_tasks(spark: SparkSession, rows: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Let AQE merge shuffle partitions into no fewer tasks than the rows ask for.

    AQE merges by compressed bytes, and rows that repeat much of each other compress to
    a few bytes: a task would then sort rows in proportion to the input.
    """
    number = min(math.ceil(rows / rows_per_task), MOST_SHUFFLE_PARTITIONS)
    initial = spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(INITIAL_PARTITIONS, str(max(int(initial), number)))
    least = max(number, spark.sparkContext.defaultParallelism)
    spark.conf.set(LEAST_PARTITIONS, str(least))
    return least
