"""The zone lookup, from CSV or Parquet."""

from pyspark.sql import DataFrame, SparkSession

from fareloom import schemas


def scan_zone_lookup(spark: SparkSession, path: str, file_format: str | None = None) -> DataFrame:
    """Read the lookup with its declared schema; the ending tells the format."""
    if file_format is None:
        file_format = "csv" if path.rstrip("/").endswith(".csv") else "parquet"
    reader = spark.read.schema(schemas.ZONE_LOOKUP)
    if file_format == "csv":
        return reader.option("header", "true").csv(path)
    return reader.parquet(path).select(*schemas.ZONE_LOOKUP.names)
