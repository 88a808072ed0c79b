"""Averages and rates over metric records ``(run_id, rank, step, loss, dt_ms, tokens)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def loss_by_rank(micro: DataFrame, by: Sequence[str] = ("step",)) -> DataFrame:
    """Mean loss over the micro-batches of a rank."""
    return micro.groupBy(*by, "rank").agg(F.avg("loss").alias("loss"))


def loss_by_step(micro: DataFrame, by: Sequence[str] = ("step",)) -> DataFrame:
    """Mean of the rank means; every rank counts the same.

    Both averages combine before their shuffle.
    """
    return (
        loss_by_rank(micro, by)
        .groupBy(*by)
        .agg(F.avg("loss").alias("loss"), F.count(F.lit(1)).alias("n_ranks"))
    )


def throughput(records: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Tokens, seconds and tokens per second; with ``by`` a step, the rate of that step."""
    seconds = F.sum("dt_ms") / 1000.0
    return records.groupBy(*by).agg(
        F.sum("tokens").alias("tokens"),
        seconds.alias("seconds"),
        (F.sum("tokens") / seconds).alias("tokens_per_second"),
    )


def wall_time(records: DataFrame, time_col: str, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Seconds between the first and the last record."""
    epoch = F.unix_micros(F.col(time_col).cast("timestamp")) / 1e6
    return records.groupBy(*by).agg((F.max(epoch) - F.min(epoch)).alias("seconds"))
