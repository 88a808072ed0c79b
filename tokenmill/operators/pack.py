"""Packing a stream of token sequences into shards of a fixed number of tokens.

With the global offset ``g`` of a token, its shard is ``g div S`` and its place
in the shard ``g mod S``.  A sequence that crosses shard borders is cut with
``slice``; there is never a row per token, and no row holds a whole shard.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tokenmill.operators.ordering import with_base
from tokenmill.operators.splits import TRAIN, VAL

#: Longest piece of a shard in a row of its own.
PIECE_TOKENS = 1 << 16


@dataclass(frozen=True)
class Packed:
    """Pieces ``(split, shard_id, start, n_tokens, shard_tokens, tokens)`` of the shards."""

    pieces: DataFrame
    total_tokens: int
    shard_size: int
    max_shards: int | None = None

    def manifest(self) -> DataFrame:
        """It equals :func:`shard_manifest` of the pieces without a pass over them."""
        spark = self.pieces.sparkSession
        return planned_manifest(spark, self.total_tokens, self.shard_size, self.max_shards)


def planned_manifest(
    spark: SparkSession, total_tokens: int, shard_size: int, max_shards: int | None = None
) -> DataFrame:
    """``(split, shard_id, n_tokens)`` of each shard, from the token total alone."""
    n_shards = -(-total_tokens // shard_size)
    if max_shards is not None:
        n_shards = min(n_shards, max_shards)
    shard_id = F.col("id")
    filled = shard_fill(shard_id, total_tokens, shard_size)
    return spark.range(n_shards).select(
        shard_split(filled, shard_size).alias("split"),
        shard_id.alias("shard_id"),
        filled.alias("n_tokens"),
    )


def shard_fill(shard_id: Column, total_tokens: int, shard_size: int) -> Column:
    """Tokens in a shard when ``total_tokens`` are packed in all."""
    left = F.lit(total_tokens).cast("bigint") - shard_id * shard_size
    return F.least(left, F.lit(shard_size).cast("bigint"))


def shard_split(filled: Column, shard_size: int) -> Column:
    """Full shards are training data, the unfilled one at the end validates."""
    return F.when(filled == shard_size, TRAIN).otherwise(VAL)


def cut_into_shards(
    sequences: DataFrame, shard_size: int, max_shards: int | None = None
) -> DataFrame:
    """Cut sequences with a known global ``offset`` at the shard borders.

    Inside a shard they are cut at each ``PIECE_TOKENS`` tokens, too, which bounds a row.
    """
    if shard_size < 1:
        raise ValueError("shard_size must be at least 1")
    kept = sequences.where("n_tokens > 0")
    if max_shards is not None:
        kept = kept.where(F.col("offset") < max_shards * shard_size)
    per_shard = -(-shard_size // PIECE_TOKENS)

    def stretch(token: str) -> str:
        """Number of the stretch of at most ``PIECE_TOKENS`` tokens of a shard that a token is in."""
        place = f"(({token}) % {shard_size}L) div {PIECE_TOKENS}L"
        return f"(({token}) div {shard_size}L) * {per_shard}L + {place}"

    first, last = stretch("offset"), stretch("offset + n_tokens - 1")
    cut = kept.withColumn("stretch", F.explode(F.expr(f"sequence({first}, {last})")))
    cut = cut.withColumn("shard_id", F.expr(f"stretch div {per_shard}L"))
    if max_shards is not None:
        cut = cut.where(F.col("shard_id") < max_shards)
    shard_start = F.col("shard_id") * shard_size
    starts = shard_start + (F.col("stretch") % per_shard) * PIECE_TOKENS
    ends = F.least(starts + PIECE_TOKENS, shard_start + shard_size)
    from_token = F.greatest(starts - F.col("offset"), F.lit(0))
    to_token = F.least(ends - F.col("offset"), F.col("n_tokens"))
    return cut.select(
        "shard_id",
        (F.col("offset") + from_token - shard_start).alias("start"),
        (to_token - from_token).alias("n_tokens"),
        F.slice(
            "tokens", (from_token + 1).cast("int"), (to_token - from_token).cast("int")
        ).alias("tokens"),
    )


def label_shards(pieces: DataFrame, total_tokens: int, shard_size: int) -> DataFrame:
    """Add what depends on the token total: the size of the shard and its split."""
    filled = shard_fill(F.col("shard_id"), total_tokens, shard_size)
    return pieces.select(
        shard_split(filled, shard_size).alias("split"),
        "shard_id",
        "start",
        "n_tokens",
        filled.alias("shard_tokens"),
        "tokens",
    )


def pack(
    sequences: DataFrame,
    bucket_totals: Sequence[int],
    shard_size: int,
    max_shards: int | None = None,
) -> Packed:
    """Pack sequences that know their ``bucket`` and the tokens before them ``inside`` it.

    ``bucket_totals`` are the tokens per bucket, so that the global offset is
    a projection.
    """
    total = sum(bucket_totals)
    placed = with_base(sequences, bucket_totals, "offset").withColumn(
        "offset", F.col("offset") + F.col("inside")
    )
    pieces = cut_into_shards(placed, shard_size, max_shards)
    return Packed(label_shards(pieces, total, shard_size), total, shard_size, max_shards)


def shard_manifest(pieces: DataFrame) -> DataFrame:
    """One row per shard.  Few pieces make a shard, so partial sums do most of the work."""
    return pieces.groupBy("split", "shard_id").agg(F.sum("n_tokens").alias("n_tokens"))


def shards_per_split(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_shards"), F.sum("n_tokens").alias("n_tokens")
    )


def with_progress(pieces: DataFrame, name: str = "packing") -> tuple[DataFrame, Observation]:
    """Count tokens, shards touched and the fill of the open shard while the pieces are written.

    The observation holds its numbers once an action on the returned table is done.
    """
    seen = Observation(name)
    is_open = F.col("split") == VAL
    observed = pieces.observe(
        seen,
        F.sum("n_tokens").alias("n_tokens"),
        (F.max("shard_id") + 1).alias("n_shards"),
        F.sum(F.when(is_open, F.col("n_tokens")).otherwise(0)).alias("open_tokens"),
    )
    return observed, seen
