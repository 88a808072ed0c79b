"""Which batch every rank reads at every step, from the shard sizes alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenmill.functions import steps
from tokenmill.operators.ordering import BUCKET, RowOrder
from tokenmill.operators.windows import usable_batches

#: Batches that a block of the schedule has at least, and blocks of a shard and rank at most.
BLOCK_BATCHES = 10_000
MOST_BLOCKS = 10_000


def rank_shards(manifest: DataFrame, batch_rows: int, length: int, ranks: int) -> DataFrame:
    """Shards of a split with the batches each rank takes from them.

    Shards too short for a rank's first batch stay in with ``n_batches`` 0.
    """
    rank = F.col("rank").cast("bigint")
    return manifest.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(ranks - 1))).alias("rank")
    ).withColumn(
        "n_batches", usable_batches(F.col("n_tokens"), rank, batch_rows, length, ranks)
    )


def batch_schedule(
    manifest: DataFrame,
    batch_rows: int,
    length: int,
    ranks: int,
    n_batches: int,
    buckets: int | None = None,
) -> DataFrame:
    """The first ``n_batches`` batches of each rank: ``(rank, i, shard_id, pos)``.

    Ranks go through the shards of the manifest in order and start again after
    the last one.  Every (shard, rank) row knows how many batches come before
    it in a cycle, so it writes out its own batches; nothing has to be looked
    up by range.  It does so in blocks that are dealt out first, so neither many cycles over
    a tiny shard nor one huge shard is left to one task.  The manifest may hold many millions of
    shards: their running batch count is taken per key range, with one total per rank and range.
    """
    if n_batches < 1:
        raise ValueError("n_batches must be at least 1")
    order = RowOrder.fit(manifest, "shard_id", buckets)
    if order.n_rows == 0:
        raise ValueError("no shards found for the split")
    manifest = manifest.select("shard_id", "n_tokens")
    per_bucket = (
        rank_shards(order.with_bucket(manifest), batch_rows, length, ranks)
        .groupBy(BUCKET, "rank")
        .agg(F.sum("n_batches").alias("in_bucket"))
    )
    by_rank = Window.partitionBy("rank")
    earlier = by_rank.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = per_bucket.select(
        BUCKET,
        "rank",
        F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)).alias("base"),
        F.sum("in_bucket").over(by_rank).alias("per_cycle"),
    )
    inside = (
        Window.partitionBy(BUCKET, "rank")
        .orderBy("shard_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        rank_shards(order.place(manifest), batch_rows, length, ranks)
        .withColumn("ahead", F.coalesce(F.sum("n_batches").over(inside), F.lit(0)))
        .join(per_bucket, [BUCKET, "rank"])
        .where("n_batches > 0")
        .withColumn("ahead", F.col("base") + F.col("ahead"))
        .where(F.col("ahead") < n_batches)
    )
    # The batches of a row over all cycles are numbered m = 0, 1, ..., and dealt out in blocks.
    own = F.expr(f"(({n_batches - 1}L - ahead) div per_cycle + 1) * n_batches")
    in_block = F.expr(f"greatest({BLOCK_BATCHES}L, own div {MOST_BLOCKS}L + 1)")
    blocks = F.expr("sequence(0L, (own - 1) div in_block)")
    numbers = F.expr("sequence(block * in_block, least((block + 1) * in_block, own) - 1)")
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cycle, k = F.expr("m div n_batches"), F.expr("m % n_batches")
    return (
        placed.withColumn("own", own)
        .withColumn("in_block", in_block)
        .withColumn("block", F.explode(blocks))
        .repartition(parts, "rank", "shard_id", "block")
        .withColumn("m", F.explode(numbers))
        .select(
            "rank",
            (cycle * F.col("per_cycle") + F.col("ahead") + k).alias("i"),
            "shard_id",
            ((F.col("rank") + k * ranks) * (batch_rows * length)).alias("pos"),
        )
        .where(F.col("i") < n_batches)
    )


def eval_batches(
    manifest: DataFrame, batch_rows: int, length: int, ranks: int, n_batches: int = 20
) -> DataFrame:
    """Every evaluation starts over at the first validation shard."""
    return batch_schedule(manifest, batch_rows, length, ranks, n_batches)


def by_step(schedule: DataFrame, accumulate: int) -> DataFrame:
    """Group the batches of a rank into optimizer steps of ``accumulate`` micro-batches."""
    return schedule.withColumns(
        {
            "step": F.expr(f"i div {accumulate}L"),
            "micro": (F.col("i") % accumulate).cast("int"),
        }
    )


def training_manifest(
    spark: SparkSession,
    max_steps: int,
    batch_rows: int,
    length: int,
    ranks: int,
    total_tokens: int,
    validate_every: int = 20,
    sample_every: int = 20,
    monitor_every: int = 2,
) -> DataFrame:
    """One row per optimizer step: tokens so far, learning rate, and what else happens."""
    accumulate = steps.accumulation_steps(total_tokens, batch_rows, length, ranks)
    per_step = steps.tokens_per_step(batch_rows, length, accumulate, ranks)
    step = F.col("step")
    return spark.range(max_steps).select(
        F.col("id").alias("step"),
    ).select(
        "step",
        ((step + 1) * per_step).alias("tokens"),
        steps.learning_rate(step).alias("lr"),
        steps.is_due(step, validate_every, max_steps).alias("validate"),
        steps.is_due(step, sample_every, max_steps).alias("sample"),
        steps.is_monitored(step, validate_every, monitor_every, max_steps).alias("monitor"),
        steps.is_last(step, max_steps).alias("last"),
    )
