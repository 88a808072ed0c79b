"""Log lines of training runs: writing them, and reading them back as typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The two line formats.
VALIDATION_FORMAT = "Step: %d, val_loss: %.4f"
RUN_FORMAT = (
    "INFO(master process): | step: %d | loss: %s | norm: %.4f | lr %.4e "
    "| dt: %.2fms | tok/sec: %.2f"
)

_NUMBER = r"([-+]?(?:\d+\.?\d*(?:[eE][-+]?\d+)?|nan|inf|NaN|Infinity))"
RUN_PATTERN = (
    rf"\| step: (\d+) \| loss: {_NUMBER} \| norm: {_NUMBER} \| lr {_NUMBER} "
    rf"\| dt: {_NUMBER}ms \| tok/sec: {_NUMBER}\s*$"
)
VALIDATION_PATTERN = rf"^Step: (\d+), val_loss: {_NUMBER}\s*$"


def validation_line(step: Column, val_loss: Column) -> Column:
    return F.format_string(VALIDATION_FORMAT, step, val_loss)


def run_line(
    step: Column, loss: Column, norm: Column, lr: Column, dt_ms: Column, tokens: Column
) -> Column:
    """The loss is written in full, all other numbers with fixed digits."""
    return F.format_string(
        RUN_FORMAT, step, loss.cast("string"), norm, lr, dt_ms, tokens.cast("double")
    )


def append_lines(lines: DataFrame, path: str) -> None:
    """Append a one-column table of lines to a log folder."""
    lines.toDF("value").write.mode("append").text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def _group(pattern: str, index: int, kind: str) -> Column:
    return F.regexp_extract("value", pattern, index).try_cast(kind)


def parse_run_log(lines: DataFrame) -> DataFrame:
    """Typed metric rows of the lines that are run records.

    What the line calls ``tok/sec`` is the number of tokens processed, so the
    rate is worked out from the step's time.
    """
    seconds = F.col("dt_ms") / 1000.0
    return (
        lines.where(F.col("value").rlike(RUN_PATTERN))
        .select(
            _group(RUN_PATTERN, 1, "bigint").alias("step"),
            _group(RUN_PATTERN, 2, "double").alias("loss"),
            _group(RUN_PATTERN, 3, "double").alias("norm"),
            _group(RUN_PATTERN, 4, "double").alias("lr"),
            _group(RUN_PATTERN, 5, "double").alias("dt_ms"),
            _group(RUN_PATTERN, 6, "double").cast("bigint").alias("tokens_processed"),
        )
        .withColumn("tokens_per_second", F.try_divide("tokens_processed", seconds))
    )


def parse_validation_log(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("value").rlike(VALIDATION_PATTERN)).select(
        _group(VALIDATION_PATTERN, 1, "bigint").alias("step"),
        _group(VALIDATION_PATTERN, 2, "double").alias("val_loss"),
    )


def malformed(lines: DataFrame) -> DataFrame:
    """Non-empty lines that are neither run nor validation records."""
    known = F.col("value").rlike(RUN_PATTERN) | F.col("value").rlike(VALIDATION_PATTERN)
    return lines.where(~known & (F.trim("value") != ""))
