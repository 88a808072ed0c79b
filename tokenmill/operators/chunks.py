"""Grouping consecutive documents into chunks, the unit of tokenization."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.operators.ordering import BUCKET, RowOrder


@dataclass(frozen=True)
class ChunkedRows:
    """Rows of a corpus with their position, bucketed so that no chunk straddles buckets."""

    rows: DataFrame  # source rows as read, limited to the kept chunks
    order: RowOrder
    chunk_size: int
    #: Keys and ``SIZE`` of these rows, the bytes of their texts, where they are known.
    sizes: DataFrame | None = None

    @property
    def chunks_per_bucket(self) -> list[int]:
        ends = [*self.order.bases[1:], self.order.n_rows]
        return [-(-(end - base) // self.chunk_size) for base, end in zip(self.order.bases, ends)]

    def numbered(self) -> DataFrame:
        """Every row with its position ``ord`` and its ``chunk_id``; one shuffle."""
        placed = self.order.with_ordinal(self.rows)
        return placed.withColumn("chunk_id", F.expr(f"ord div {self.chunk_size}"))

    def texts(self, text_col: str = "text") -> DataFrame:
        """One row per chunk: its texts in order, joined without a separator."""
        text = F.coalesce(F.col(text_col), F.lit(""))
        numbered = self.numbered()
        if self.chunk_size == 1:
            return numbered.select(BUCKET, "chunk_id", F.lit(1).alias("n_rows"), text.alias("text"))
        in_order = F.array_sort(F.collect_list(F.struct("ord", text.alias("text"))))
        return (
            numbered.groupBy(BUCKET, "chunk_id")
            .agg(in_order.alias("parts"))
            .select(
                BUCKET,
                "chunk_id",
                F.size("parts").alias("n_rows"),
                F.array_join(F.col("parts.text"), "").alias("text"),
            )
        )


def chunk_rows(
    df: DataFrame,
    order_by: str | list[str],
    chunk_size: int = 100,
    max_chunks: int | None = None,
    buckets: int | None = None,
    text_col: str = "text",
) -> ChunkedRows:
    """Cut a corpus into runs of ``chunk_size`` consecutive rows.

    Two passes over the key columns place the buckets; the texts themselves
    are shuffled once, when :meth:`ChunkedRows.numbered` is executed.
    ``max_chunks`` keeps only the first chunks and becomes a filter on the key.
    """
    if chunk_size < 1:
        raise ValueError("chunk_size must be at least 1")
    size = F.octet_length(F.coalesce(F.col(text_col), F.lit("")))
    order = RowOrder.fit(df, order_by, buckets, size)
    n_rows = order.n_rows
    if max_chunks is not None:
        n_rows = min(n_rows, max_chunks * chunk_size)
    order = order.realign(df, chunk_size, also=[n_rows])
    sizes = order.sizes
    if n_rows < order.n_rows:
        kept = order.before(df, n_rows)
        df, sizes = df.where(kept), sizes.where(kept)
    return ChunkedRows(df, order.head(n_rows), chunk_size, sizes)
