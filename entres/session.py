"""Session defaults for local use and tests; a cluster's own settings always win."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str | None = None, **conf: str) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
