"""Small steps that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.staging import stage

#: A table is only sent whole to all machines up to so many rows of a few numbers.
BROADCAST_ROWS = 500_000


def free_name(docs: DataFrame, name: str) -> str:
    """The name, with as many underscores behind it as no column of the table has."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def beside(
    docs: DataFrame, table: DataFrame, key: Column, how: str = "left"
) -> tuple[DataFrame, dict[str, Column]]:
    """Documents next to a table with a ``doc_id`` and a ``text_key``, which ``key`` is of the text.

    The columns of the table come under names that the documents do not use; they are
    returned by their own ones.
    """
    names = {column: free_name(docs, f"_{column}") for column in table.columns}
    found = {column: F.col(name) for column, name in names.items()}
    same = F.col("doc_id").cast("bigint").eqNullSafe(found["doc_id"]) & (key == found["text_key"])
    return docs.join(table.withColumnsRenamed(names), same, how), found


def columns_of(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{column}`") for column in docs.columns]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold_of(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def small_or_shuffled(df: DataFrame, label: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The table written once, and marked for broadcast if it has at most ``rows`` rows.

    With more rows it comes back unmarked, so that a join with it shuffles.
    """
    table = stage(df, label)
    return F.broadcast(table) if table.count() <= rows else table


def ascii_lower(text: Column) -> Column:
    """A-Z as a-z, nothing else changed."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, lower))
