"""Session construction with the settings the engine relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "quern", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` entries win over the defaults.

    On a cluster the master and the shared ``spark.checkpoint.dir`` come from
    spark-submit; only a local run gets values of its own here.
    """
    b = SparkSession.builder.appName(app)
    if master or not os.environ.get("PYSPARK_SUBMIT_ARGS"):
        b = b.master(master or "local[*]")
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        base["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in {**base, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()
