"""Session builder for local runs, tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "swaplens", **conf: str) -> SparkSession:
    """Local session; on a cluster, spark-submit brings its own settings instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
