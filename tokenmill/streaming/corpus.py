"""Packing a growing corpus with Structured Streaming.

Files must arrive in key order.  Each micro-batch continues where the last one
stopped: the log of batch ``n`` (highest key, next chunk, next token offset, and what was
observed while packing) and the rows of the chunk still open are written under its batch
number after the pieces of that batch.  A repeated batch reads the log of its predecessor again
and overwrites its own output, so a restart neither loses nor repeats tokens.  A micro-batch
with a key that is not above the highest one before it raises an error that names the file.

A limit on chunks bounds the stream: what lies beyond it is not packed, and the stream stops
once it is reached.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tokenmill.operators.chunks import ChunkedRows
from tokenmill.operators.encode import ByteEncoder, Encoder
from tokenmill.operators.ordering import RowOrder, with_base
from tokenmill.operators.pack import Packed, cut_into_shards, label_shards
from tokenmill.plans.corpus import CorpusPlan, encode_rows
from tokenmill.staging import LONG_ROWS


def stream_corpus(
    spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int | None = None
) -> DataFrame:
    """Read a growing corpus folder, oldest files first.

    By default a micro-batch takes all new files, whatever their order among
    themselves.  ``files_per_batch`` bounds it for files that arrive one by
    one in key order.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


#: What the log of a micro-batch holds besides the state.
SEEN = "n_rows bigint, n_tokens bigint, last_shard bigint"


class StreamPacker:
    """``foreachBatch`` sink that packs texts into shards below ``path``."""

    def __init__(self, path: str, plan: CorpusPlan, encoder: Encoder | None = None):
        self.path = path.rstrip("/")
        limit = plan.max_chunks
        if plan.delimit == "document" and limit is not None:
            limit *= plan.chunk_size  # a document is a chunk of its own then
        self.max_chunks = limit
        self.plan = plan if plan.delimit == "chunk" else replace(plan, chunk_size=1)
        self.encoder = encoder or ByteEncoder()
        self.keys = [plan.order_by] if isinstance(plan.order_by, str) else list(plan.order_by)

    def _state(self, spark: SparkSession, batch_id: int) -> tuple[int, int, object]:
        """Next chunk, next offset and highest key after a micro-batch."""
        if batch_id < 0:
            return 0, 0, None
        row = spark.read.parquet(f"{self.path}/state/batch={batch_id}").first()
        return row["next_chunk"], row["next_offset"], row["last_key"]

    def is_full(self, next_chunk: int) -> bool:
        return self.max_chunks is not None and next_chunk >= self.max_chunks

    def _in_order(self, batch: DataFrame, last_key: object) -> tuple[int, object]:
        """Rows of the batch and its highest key, after a look whether it follows ``last_key``."""
        key = F.struct(*self.keys)
        seen = batch.agg(
            F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")
        ).first()
        if seen["n"] and last_key is not None and tuple(seen["low"]) <= tuple(last_key):
            file = batch
            for name, value in zip(self.keys, seen["low"]):
                file = file.where(F.col(name) == F.lit(value))
            name = file.select(F.input_file_name()).first()[0]
            raise ValueError(
                f"{name} is late: it holds the key {tuple(seen['low'])}, and {tuple(last_key)} "
                "has been packed; files have to arrive in key order"
            )
        return seen["n"], seen["high"] if seen["n"] else last_key

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        next_chunk, next_offset, last_key = self._state(spark, batch_id - 1)
        key_schema = batch.select(F.struct(*self.keys).alias("last_key")).schema
        seen = {"n_rows": 0, "n_tokens": 0, "last_shard": None}
        if not self.is_full(next_chunk):
            batch = batch.select(*self.keys, "text")
            seen["n_rows"], last_key = self._in_order(batch, last_key)
            rows = batch
            if batch_id > 0:
                earlier = spark.read.schema(batch.schema)
                rows = batch.unionByName(earlier.parquet(f"{self.path}/open/batch={batch_id - 1}"))
            size = self.plan.chunk_size
            bytes_of = F.octet_length(F.coalesce("text", F.lit("")))
            order = RowOrder.fit(rows, self.keys, self.plan.buckets, bytes_of)
            chunks = order.n_rows // size
            if self.max_chunks is not None:
                chunks = min(chunks, self.max_chunks - next_chunk)
            closed = chunks * size
            order = order.realign(rows, size, also=[closed])
            is_closed = order.before(rows, closed)
            next_chunk += chunks
            still_open = ~is_closed if not self.is_full(next_chunk) else F.lit(False)
            self._write(rows.where(still_open), "open", batch_id)
            cut = ChunkedRows(
                rows.where(is_closed), order.head(closed), size, order.sizes.where(is_closed)
            )
            pieces, next_offset = self._pack(cut, next_offset)
            observed = Observation()
            self._write(
                pieces.observe(
                    observed, F.sum("n_tokens").alias("n_tokens"), F.max("shard_id").alias("last_shard")
                ),
                "pieces",
                batch_id,
            )
            seen |= {"n_tokens": observed.get["n_tokens"] or 0, "last_shard": observed.get["last_shard"]}
        else:
            self._write(batch.select(*self.keys, "text").limit(0), "open", batch_id)
        row = (next_chunk, next_offset, last_key, *seen.values())
        fields = "next_chunk bigint, next_offset bigint"
        kept = StructType([*StructType.fromDDL(fields), key_schema[0], *StructType.fromDDL(SEEN)])
        kept["last_key"].nullable = True
        self._write(spark.createDataFrame([row], kept).coalesce(1), "state", batch_id)

    def _pack(self, chunks: ChunkedRows, next_offset: int) -> tuple[DataFrame, int]:
        sequences, totals = encode_rows(chunks, self.encoder)
        placed = with_base(sequences, totals, "offset", next_offset).withColumn(
            "offset", F.col("offset") + F.col("inside")
        )
        pieces = cut_into_shards(placed, self.plan.shard_size, self.plan.max_shards)
        return pieces, next_offset + sum(totals)

    def _write(self, df: DataFrame, kind: str, batch_id: int) -> None:
        options = LONG_ROWS if kind == "pieces" else {}
        df.write.options(**options).mode("overwrite").parquet(f"{self.path}/{kind}/batch={batch_id}")

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Pack all files that are there, then stop; earlier if the limit on chunks is reached."""
        return (
            stream.writeStream.foreachBatch(self)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def last_batch(self, spark: SparkSession) -> int:
        """Number of the last batch that was written completely."""
        return spark.read.parquet(f"{self.path}/state").agg(F.max("batch")).first()[0]

    def progress(self, spark: SparkSession) -> DataFrame:
        """What each micro-batch did: rows in, tokens packed, and the fill of the open shard after it.

        ``n_tokens`` was observed while the pieces were written.
        """
        size = self.plan.shard_size
        return spark.read.parquet(f"{self.path}/state").select(
            F.col("batch").cast("bigint").alias("batch"),
            "n_rows",
            "n_tokens",
            F.expr(f"next_offset div {size}L").alias("full_shards"),
            (F.col("next_offset") % size).alias("open_tokens"),
        )

    def packed(self, spark: SparkSession, last_batch: int | None = None) -> Packed:
        """Shards after ``last_batch``, with the open chunk closed as a short one.

        Whether a shard is full is worked out from the token total here, so no
        written row has to change when a later batch fills its shard.
        """
        if last_batch is None:
            last_batch = self.last_batch(spark)
        _, end, _ = self._state(spark, last_batch)
        pieces = spark.read.parquet(f"{self.path}/pieces").where(F.col("batch") <= last_batch)
        pieces = pieces.drop("batch")
        open_rows = spark.read.parquet(f"{self.path}/open/batch={last_batch}")
        n_open = open_rows.count()
        if n_open:  # fewer rows than a chunk has, known to be in order and unique
            schema = open_rows.select(*self.keys).schema
            order = RowOrder(tuple(self.keys), schema, (), (0,), n_open)
            tail, end = self._pack(ChunkedRows(open_rows, order, self.plan.chunk_size), end)
            pieces = pieces.unionByName(tail)
        size = self.plan.shard_size
        return Packed(label_shards(pieces, end, size), end, size, self.plan.max_shards)
