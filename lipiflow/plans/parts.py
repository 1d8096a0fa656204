"""How many tasks a step that reads few bytes but does much work is dealt to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def parts(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), spark.sparkContext.defaultParallelism)
