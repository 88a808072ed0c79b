"""Session settings that the jobs in this package are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A row of a chunk table holds about a hundred documents, so batches that
    # cross to Python are kept short.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def build_session(
    app: str = "tokenmill", master: str | None = None, **settings: str
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
