"""Training windows over shards: next-token pairs and their place in rank batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARD = ("split", "shard_id", "shard_tokens")


def token_windows(pieces: DataFrame, length: int) -> DataFrame:
    """All windows of ``length + 1`` tokens starting at multiples of ``length`` in a shard.

    Consecutive windows share one token and never cross a shard border; the
    tail of a shard that does not fill a window is dropped.

    A window that lies inside one piece is sliced off in place.  Only the
    at most two windows at the borders of a piece are put together from
    fragments, so no more than about ``2 * length`` tokens per piece are
    shuffled.  ``pieces`` is read twice and should be a written table.
    """
    if length < 1:
        raise ValueError("length must be at least 1")
    last = F.col("start") + F.col("n_tokens") - 1
    bounded = pieces.withColumns(
        {
            "first_whole": F.expr(f"(start + {length - 1}) div {length}L"),
            "last_touched": F.expr(f"(start + n_tokens - 1) div {length}L"),
        }
    )

    def cut(window: Column) -> tuple[Column, Column]:
        pos = F.greatest(F.col("start"), window * length)
        stop = F.least(last, window * length + length)
        part = F.slice(
            "tokens", (pos - F.col("start") + 1).cast("int"), (stop - pos + 1).cast("int")
        )
        return pos, part

    whole = bounded.where("first_whole < last_touched").select(
        *SHARD,
        "start",
        "tokens",
        F.explode(F.expr("sequence(first_whole, last_touched - 1)")).alias("window"),
    )
    whole = whole.select(
        *SHARD,
        "window",
        F.slice(
            "tokens", (F.col("window") * length - F.col("start") + 1).cast("int"), length + 1
        ).alias("buffer"),
    )

    touched = F.array_distinct(
        F.array(F.col("first_whole") - 1, F.col("last_touched"))
    )
    fragments = bounded.select(
        *SHARD, "start", "n_tokens", "tokens", F.explode(touched).alias("window")
    ).where("window >= 0")
    pos, part = cut(F.col("window"))
    in_order = F.array_sort(F.collect_list(F.struct(pos.alias("pos"), part.alias("part"))))
    joined = (
        fragments.groupBy(*SHARD, "window")
        .agg(in_order.alias("parts"))
        .select(*SHARD, "window", F.flatten("parts.part").alias("buffer"))
        .where(F.size("buffer") == length + 1)
    )
    return whole.unionByName(joined)


def next_token_pairs(windows: DataFrame, length: int) -> DataFrame:
    """Inputs ``x`` and, shifted by one token, targets ``y``."""
    return windows.select(
        *SHARD,
        "window",
        F.slice("buffer", 1, length).alias("x"),
        F.slice("buffer", 2, length).alias("y"),
    )


def usable_batches(
    shard_tokens: Column, rank: Column, batch_rows: int, length: int, ranks: int
) -> Column:
    """Batches that a rank takes from a shard before it moves on to the next one.

    Zero if the shard is too short for the first batch of the rank; the first
    batch is taken whenever it fits.
    """
    batch = batch_rows * length
    rounds = F.floor((shard_tokens - 1 - rank * batch) / F.lit(batch * ranks)).cast("bigint")
    fits = shard_tokens >= batch * (rank + 1) + 1
    return F.when(fits, F.greatest(rounds, F.lit(1))).otherwise(0).cast("bigint")


def rank_batches(pairs: DataFrame, batch_rows: int, length: int, ranks: int) -> DataFrame:
    """Give each window its rank, batch number and row, and drop what no rank reads."""
    return (
        pairs.withColumn("block", F.expr(f"window div {batch_rows}L"))
        .withColumns(
            {
                "rank": F.col("block") % ranks,
                "batch": F.expr(f"block div {ranks}L"),
                "row": (F.col("window") % batch_rows).cast("int"),
            }
        )
        .where(
            F.col("batch")
            < usable_batches(F.col("shard_tokens"), F.col("rank"), batch_rows, length, ranks)
        )
        .drop("block")
    )


def prompt_rows(pieces: DataFrame, shard_id: int, rows: int, length: int) -> DataFrame:
    """The first ``rows`` windows of a shard; only its head is read."""
    head = pieces.where(
        (F.col("shard_id") == shard_id) & (F.col("start") <= rows * length)
    )
    pairs = next_token_pairs(token_windows(head, length), length)
    return pairs.where(F.col("window") < rows)


def random_prompt(
    pieces: DataFrame, shard_id: int, rows: int, length: int, seed: int
) -> DataFrame:
    """One of the first ``rows`` windows, drawn by a hash of ``seed`` so that it can be repeated."""
    drawn = prompt_rows(pieces, shard_id, rows, length)
    return drawn.orderBy(F.md5(F.format_string(f"{seed}:%d", "window").cast("binary"))).limit(1)
