"""Tasks sized by rows, not by the bytes they compress to."""

from pyspark.sql import functions as F

from fareloom import session


def test_tasks_follow_the_rows(spark):
    rows = spark.range(1_000_000).select("id", F.lit("the same in every row").alias("text"))
    try:
        session.size_tasks(spark, 1_000_000, rows_per_task=20_000)
        tasks = rows.repartition("id").groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 30
    finally:
        session.apply_settings(spark)
        spark.conf.unset(session.INITIAL_PARTITIONS)
    assert spark.conf.get(session.LEAST_PARTITIONS, None) is None
