"""A local session for tests, benchmarks and the command line; on a cluster the caller brings its own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str | None = None, memory: str = "8g", **settings: str) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS") or "*"
    builder = SparkSession.builder.master(f"local[{cores}]").appName("meshloom")
    base = {
        "spark.driver.memory": memory, "spark.sql.shuffle.partitions": "8", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for key, value in {**base, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
