"""Session building."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(cores: int | str = "*", **conf: object) -> SparkSession:
    """A local session with the settings that the engine's results assume: UTC, adaptive execution, Arrow."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("cantora")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("CANTORA_DRIVER_MEMORY", "4g"),
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, str(v))
    return builder.getOrCreate()
