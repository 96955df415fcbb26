"""One place that builds a session, for tests, the bench and scripts."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(master: str = "local[8]", partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and a driver sized for local mode."""
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    spark = SparkSession.builder.master(master).appName("boxloom").config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
