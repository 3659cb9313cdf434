"""Session construction shared by tests, the bench and the command line."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(cpus: int | str = "*", app: str = "quarrylink", memory: str = "8g") -> SparkSession:
    """A local session with the settings the library is written for (UTC, AQE, ANSI on)."""
    n = os.cpu_count() if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str):
    """Read one of the parquet tables below ``sf_dir``; any path that Spark can open will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
