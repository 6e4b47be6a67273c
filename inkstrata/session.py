"""Session factory and the table reader every query shares."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "inkstrata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine relies on (UTC, AQE); conf overrides them."""
    builder = SparkSession.builder.appName(app)
    if master or not os.environ.get("SPARK_MASTER"):
        builder = builder.master(master or "local[8]")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    } | conf
    return builder.config(map=settings).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory; any path Spark can open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
