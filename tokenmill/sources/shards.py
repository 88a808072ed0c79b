"""Token shards as Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.functions.tokens import widen
from tokenmill.operators.pack import shard_manifest
from tokenmill.operators.splits import TRAIN
from tokenmill.staging import LONG_ROWS

PIECE_SCHEMA = (
    "shard_id bigint, start bigint, n_tokens bigint, shard_tokens bigint, "
    "tokens array<int>, split string"
)


def write_shards(pieces: DataFrame, path: str, one_folder_per_shard: bool = False) -> None:
    """Write the pieces of shards below one folder per split.

    Pieces arrive bucket by bucket in shard order, so the files of a split hold
    disjoint shard ranges already and a filter on ``shard_id`` skips all other
    row groups, which are small, as readers hold one at a time.  A folder per shard is for
    small corpora only: a large one has millions of shards.
    """
    folders = ["split", "shard_id"] if one_folder_per_shard else ["split"]
    writer = pieces.sortWithinPartitions("split", "shard_id", "start").write
    writer.options(**LONG_ROWS).mode("overwrite").partitionBy(*folders).parquet(path)


def read_pieces(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    pieces = spark.read.schema(PIECE_SCHEMA).parquet(path)
    return pieces if split is None else pieces.where(F.col("split") == split)


def read_shard(
    spark: SparkSession, path: str, split: str, shard_id: int, raw: bool = False
) -> DataFrame:
    """The pieces of one shard, widened to 64-bit ids unless ``raw``."""
    pieces = read_pieces(spark, path, split).where(F.col("shard_id") == shard_id)
    return pieces if raw else pieces.withColumn("tokens", widen(F.col("tokens")))


def list_shards(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Shards of a split in order; the token column is not read."""
    shards = shard_manifest(read_pieces(spark, path, split)).orderBy("shard_id")
    if shards.isEmpty():
        raise ValueError(f"no shards found for split {split}")
    return shards


def write_split_tokens(tokens: DataFrame, path: str) -> None:
    """Write whole-split token tables ``(split, seq, tokens, n_tokens)``."""
    tokens.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split_tokens(
    spark: SparkSession, path: str, splits: Sequence[str] = (TRAIN,)
) -> DataFrame:
    table = spark.read.parquet(path).where(F.col("split").isin(list(splits)))
    return table.withColumn("tokens", widen(F.col("tokens")))


def split_token_counts(tokens: DataFrame) -> DataFrame:
    """Tokens per split; only the length column is read."""
    return tokens.groupBy("split").agg(F.sum("n_tokens").alias("n_tokens"))
