"""From a text corpus to packed shards."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.operators.chunks import ChunkedRows, chunk_rows
from tokenmill.operators.encode import (
    SPLIT_PATTERN,
    BpeEncoder,
    ByteEncoder,
    Encoder,
    delimited,
    encode_in_order,
)
from tokenmill.operators.longpieces import MIDDLE, soft_tokens
from tokenmill.operators.ordering import (
    BUCKET,
    SIZE,
    RowOrder,
    inside_total,
    totals_by_bucket,
)
from tokenmill.operators.pack import Packed, pack, planned_manifest
from tokenmill.operators.seams import BLOCK_BYTES, split_units
from tokenmill.operators.splits import TEST, TRAIN, VAL, split_label, split_starts
from tokenmill.sources.corpus import spread
from tokenmill.staging import LONG_ROWS, stage


@dataclass(frozen=True)
class CorpusPlan:
    """Settings of a corpus run.

    ``delimit`` is ``"chunk"`` (the texts of a chunk are joined, one delimiter
    in front) or ``"document"`` (one delimiter per text).
    """

    order_by: str | tuple[str, ...] = "doc_id"
    chunk_size: int = 100
    shard_size: int = 1_000_000
    delimit: str = "chunk"
    max_chunks: int | None = None
    max_shards: int | None = None
    buckets: int | None = None

    def __post_init__(self) -> None:
        if self.delimit not in ("chunk", "document"):
            raise ValueError("delimit must be 'chunk' or 'document'")


def chunked(corpus: DataFrame, plan: CorpusPlan) -> ChunkedRows:
    keys = plan.order_by if isinstance(plan.order_by, str) else list(plan.order_by)
    if plan.delimit == "chunk":
        return chunk_rows(corpus, keys, plan.chunk_size, plan.max_chunks, plan.buckets)
    limit = None if plan.max_chunks is None else plan.max_chunks * plan.chunk_size
    return chunk_rows(corpus, keys, 1, limit, plan.buckets)


def encoded_chunks(
    corpus: DataFrame, plan: CorpusPlan, encoder: Encoder | None = None
) -> tuple[DataFrame, list[int]]:
    """Sequences ``(bucket, chunk_id, n_rows, tokens, n_tokens, inside)`` and bucket totals."""
    return encode_rows(chunked(corpus, plan), encoder or ByteEncoder())


def encode_rows(chunks: ChunkedRows, encoder: Encoder) -> tuple[DataFrame, list[int]]:
    """Encode chunks; texts are shuffled once, token arrays never.

    If the encoder knows lengths without encoding, the totals per bucket come
    from a scan without a shuffle.  If not, the encoded chunks are written to a
    staged table and the totals are read from its length column.
    """
    texts = chunks.texts()
    length = encoder.length(F.col("text"))
    if length is None:
        encoded = encode_in_order(texts, encoder, BUCKET, "chunk_id")
        sequences = stage(encoded, "encoded", options=LONG_ROWS)
        return sequences, totals_by_bucket(sequences, "n_tokens", chunks.order.n_buckets)
    sequences = (
        texts.withColumn("n_tokens", (length + 1).cast("bigint"))
        .withColumn("inside", inside_total("n_tokens", "chunk_id"))
        .withColumn("tokens", delimited(encoder.encode(F.col("text")), encoder.eot))
        .drop("text")
    )
    if chunks.sizes is not None and isinstance(encoder, ByteEncoder):
        lengths = chunks.order.totals(chunks.sizes, F.col(f"`{SIZE}`"))
    else:
        lengths = chunks.order.totals(chunks.rows, length)
    return sequences, [t + n for t, n in zip(lengths, chunks.chunks_per_bucket)]


def corpus_to_shards(
    corpus: DataFrame, plan: CorpusPlan, encoder: Encoder | None = None
) -> Packed:
    """Chunk, encode, delimit and pack a corpus ``(keys..., text)``."""
    sequences, totals = encoded_chunks(corpus, plan, encoder)
    return pack(sequences, totals, plan.shard_size, max_shards=plan.max_shards)


def corpus_tokens(corpus: DataFrame, plan: CorpusPlan, encoder: Encoder | None = None) -> int:
    """How many tokens the corpus packs into shards.

    A sum does not depend on the order of the texts, so with an encoder that knows lengths
    it takes one scan, without a shuffle.
    """
    encoder = encoder or ByteEncoder()
    length = encoder.length(F.col("text"))
    if length is None or plan.max_chunks is not None:
        return sum(encoded_chunks(corpus, plan, encoder)[1])
    size = plan.chunk_size if plan.delimit == "chunk" else 1
    seen = corpus.agg(F.count("*").alias("rows"), F.sum(length).alias("tokens")).first()
    return (seen["tokens"] or 0) + -(-seen["rows"] // size)


def corpus_manifest(
    corpus: DataFrame, plan: CorpusPlan, encoder: Encoder | None = None
) -> DataFrame:
    """The shards that :func:`corpus_to_shards` fills, without packing them."""
    total = corpus_tokens(corpus, plan, encoder)
    return planned_manifest(corpus.sparkSession, total, plan.shard_size, plan.max_shards)


def joined_split_tokens(
    corpus: DataFrame,
    order: RowOrder,
    starts: tuple[int, int],
    encoder: BpeEncoder,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Tokens of each split encoded as one text, in rows of bounded size."""
    if encoder.pattern != SPLIT_PATTERN:
        raise ValueError("where a joined text can be cut is known for the published pattern only")
    units = stage(split_units(corpus, order, starts, block_bytes), "units")
    is_soft = F.col("soft_start") | F.col("soft_end")
    rows = units.where(~is_soft).select(
        "split", "seq", F.lit(MIDDLE).alias("part"), "is_first",
        encoder.encode(F.col("text")).alias("tokens"),
    )
    soft = units.where(is_soft)
    if not soft.isEmpty():
        rows = rows.unionByName(soft_tokens(soft, encoder.batch_encoder()))
    first = F.col("is_first") & (F.col("part") == MIDDLE)
    tokens = F.when(first, delimited(F.col("tokens"), encoder.eot)).otherwise(F.col("tokens"))
    return rows.select(
        "split",
        (F.col("seq") * 3 + F.col("part")).alias("seq"),
        tokens.alias("tokens"),
        F.size(tokens).cast("bigint").alias("n_tokens"),
    )


def split_tokens(
    corpus: DataFrame,
    order_by: str | list[str] = "doc_id",
    train: float = 0.8,
    val: float = 0.15,
    encoder: Encoder | None = None,
) -> DataFrame:
    """Positional splits as token sequences with one delimiter in front of each split.

    ``seq`` gives the order of the rows within the split.  With byte ids a row
    is a document, ``seq`` its key (a struct if there are several key columns), and only the
    keys of the first documents, which get the delimiter, are looked up.  Other encoders see
    the joined text of the split, so a row is a stretch of it between two safe cuts.  A split
    without documents is its delimiter alone, in a row without ``seq``.
    """
    encoder = encoder or ByteEncoder()
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    joined = encoder.length(F.col("text")) is None
    weight = F.octet_length(F.coalesce(F.col("text"), F.lit(""))) if joined else None
    order, starts = split_starts(corpus, keys, train, val, weight)
    if joined:
        rows = joined_split_tokens(corpus, order, starts, encoder)
    else:
        firsts = order.keys_at(corpus, sorted({0, *starts}))
        tokens = encoder.encode(F.col("text"))
        is_first = F.lit(False)
        for first in firsts.values():
            same = [F.col(k) == F.lit(v) for k, v in zip(keys, first)]
            is_first = is_first | reduce(Column.__and__, same)
        rows = spread(corpus.select(*keys, "text")).select(
            split_label(order, corpus, starts).alias("split"),
            (F.col(keys[0]) if len(keys) == 1 else F.struct(*keys)).alias("seq"),
            F.when(is_first, delimited(tokens, encoder.eot)).otherwise(tokens).alias("tokens"),
            (encoder.length(F.col("text")) + is_first.cast("int")).cast("bigint").alias("n_tokens"),
        )
    ends = (*starts, order.n_rows)
    without = [s for s, a, b in zip((TRAIN, VAL, TEST), (0, *starts), ends) if a == b]
    if not without:
        return rows
    alone = corpus.sparkSession.createDataFrame([(split,) for split in without], "split string")
    return rows.unionByName(
        alone.select(
            "split",
            F.lit(None).cast(rows.schema["seq"].dataType).alias("seq"),
            delimited(F.array().cast("array<int>"), encoder.eot).alias("tokens"),
            F.lit(1).cast("bigint").alias("n_tokens"),
        )
    )
