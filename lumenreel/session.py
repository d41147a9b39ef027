"""Session helpers: table access and the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def build_session(cpus: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lumenreel")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table by name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
