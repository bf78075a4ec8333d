"""Helpers the corpus operators share: words, the shared folder, numbering."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"

CHECKPOINT_DIR = "spark.checkpoint.dir"
T = TypeVar("T")


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    context = spark.sparkContext
    folder = context.getConf().get(CHECKPOINT_DIR) or spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="corpus-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read back: its lineage ends here."""
    path = f"{shared_folder(frame.sparkSession)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


_HELD: dict[tuple, object] = {}


def held(key: tuple, load: Callable[[], T]) -> T:
    """What a Python worker keeps between tasks: one operator's model at a time.

    Workers outlive their stage; without this, one would carry the models and
    memories of all stages that it has worked for.
    """
    if key not in _HELD:
        release()
        _HELD[key] = load()
    return _HELD[key]  # type: ignore[return-value]


def release() -> None:
    """Let go of what the worker keeps for other operators."""
    _HELD.clear()


def words(text: Column) -> Column:
    """Words of a text as an array, without Python; none for NULL or blank texts."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_GAP))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_fold(doc_id: Column, folds: int) -> Column:
    """Fold of a row: CRC-32 of its id as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds))


def numbered(
    frame: DataFrame, groups: list[str], slice_of: Column, order: list[str], name: str
) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in order of (slice, order).

    A group may hold any share of the rows: it is numbered in slices, and each
    slice starts where the ones before it end. ``slice_of`` gives a row's slice.
    Rows that are equal in the order columns too are numbered in any order.
    """
    sliced = frame.withColumn("_slice", slice_of)
    keys = [*groups, "_slice"]
    local = Window.partitionBy(*keys).orderBy(*order)
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    inner = sliced.withColumn("_local", F.row_number().over(local) - 1)
    same = [inner[key].eqNullSafe(starts[key]) for key in keys]
    joined = inner.join(starts, same, "left").select(
        *[inner[c] for c in inner.columns], starts["_start"]
    )
    return joined.withColumn(name, (F.col("_start") + F.col("_local")).cast("long")).drop(
        "_slice", "_local", "_start"
    )


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application.

    Nodes on which it is installed do not need it.
    """
    if getattr(spark.sparkContext, "_corpus_package_sent", False):
        return spark
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(top)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "fareloom.zip")
    with open(path, "wb") as out:
        out.write(packed.getvalue())
    spark.sparkContext.addPyFile(path)
    spark.sparkContext._corpus_package_sent = True
    return spark
