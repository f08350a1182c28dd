"""Session defaults for tests and the bench; a cluster brings its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, partitions: int = 8, **conf: str) -> SparkSession:
    """A local[cpus] session in UTC with adaptive execution."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("skein")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
