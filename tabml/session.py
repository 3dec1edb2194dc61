"""Session settings used by the tests and the benchmark.

On a cluster the session comes from the job submission; nothing in the library
depends on these values.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "tabml", **conf: str) -> SparkSession:
    """A single-machine session with as many shuffle partitions as cores."""
    settings = {
        "spark.sql.shuffle.partitions": "8" if cores == "*" else str(cores),
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
