"""Spark session with the settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: str = "*", app: str = "tidemark", **conf: str) -> SparkSession:
    """Single-machine session for tests and benchmarks.

    On a cluster use the session ``spark-submit`` provides; the library sets
    nothing globally and reads only ``spark.checkpoint.dir`` from it.
    """
    cores = None if cpus == "*" else int(cpus)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # Call sites of columns cost a round trip to the JVM for every expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(cores or 8),
        "spark.driver.memory": "8g",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
