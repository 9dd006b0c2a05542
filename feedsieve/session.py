"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the jobs are written for. Shuffle partitions are left to the cluster;
# adaptive execution merges small ones and splits skewed ones.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def local_session(
    app_name: str = "feedsieve", cores: str | int = "*", **settings: str
) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in {**RECOMMENDED, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
