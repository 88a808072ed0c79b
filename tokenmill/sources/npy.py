"""Shards as ``.npy`` files of unsigned 16-bit ids, one file per shard.

Writing goes through a Python data source: the shard id decides the partition
and a task holds one shard at a time.  The files go to a folder of this attempt, next to the
target; a repeated task writes the same bytes under the same name there.  Once all tasks are
done the attempt takes the place of the target, by two renames, so a failed export leaves the
old one as it was.  Reading uses Spark's binary file source.
"""

from __future__ import annotations

import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import ArrayType, IntegerType, StructType

from tokenmill.staging import Folder

FILE_NAME = "{split}_shard_{shard_id:06d}.npy"
FILE_PATTERN = r"([^/]+)_shard_(\d+)\.npy$"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:(?!//)", "file://", path))
    return fs.LocalFileSystem(), path


@dataclass
class Written(WriterCommitMessage):
    n_shards: int


class NpyWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        files, folder = _open(self.path)
        files.create_dir(folder, recursive=True)
        shard: tuple[str, int] | None = None
        parts: list[np.ndarray] = []
        n_shards = 0

        def flush() -> int:
            if shard is None:
                return 0
            name = FILE_NAME.format(split=shard[0], shard_id=shard[1])
            attempt = f"{folder}/_{uuid.uuid4().hex}"
            blob = io.BytesIO()
            np.save(blob, np.concatenate(parts))
            with files.open_output_stream(attempt) as sink:
                sink.write(blob.getvalue())
            files.move(attempt, f"{folder}/{name}")
            return 1

        for batch in batches:
            rows = zip(
                batch.column("split").to_pylist(),
                batch.column("shard_id").to_pylist(),
                batch.column("tokens"),
            )
            for split, shard_id, tokens in rows:
                if shard != (split, shard_id):
                    n_shards += flush()
                    shard, parts = (split, shard_id), []
                ids = tokens.values.to_numpy(zero_copy_only=False)
                if len(ids) and (ids.min() < 0 or ids.max() >= 2**16):
                    raise ValueError(f"shard {shard_id} holds ids that do not fit 16 bits")
                parts.append(ids.astype("<u2"))
        n_shards += flush()
        return Written(n_shards)

    def commit(self, messages: list[Any]) -> None:
        files, folder = _open(self.path)
        with files.open_output_stream(f"{folder}/_SUCCESS"):
            pass

    def abort(self, messages: list[Any]) -> None:
        """Finished files may stay: without the marker the export is not complete."""


class NpyShards(DataSource):
    @classmethod
    def name(cls) -> str:
        return "npy_shards"

    def writer(self, schema: StructType, overwrite: bool) -> NpyWriter:
        return NpyWriter(self.options)


def write_npy(pieces: DataFrame, path: str) -> None:
    """Export pieces as one file per shard in place of what ``path`` held.

    Only the tokens of one shard, a bounded number, come together in one place.  A path
    without a scheme lies in the default file system of the cluster.
    """
    spark = pieces.sparkSession
    target = Folder(spark, path.rstrip("/"))
    attempt = Folder(spark, f"{target.uri()}.attempt-{uuid.uuid4().hex}")
    attempt.create()
    spark.dataSource.register(NpyShards)
    try:
        (
            pieces.select("split", "shard_id", "start", "tokens")
            .repartition("split", "shard_id")
            .sortWithinPartitions("split", "shard_id", "start")
            .write.format("npy_shards")
            .mode("append")
            .option("path", attempt.uri())
            .save()
        )
    except BaseException:
        attempt.delete()
        raise
    _take_place(spark, attempt, target)


def _take_place(spark: SparkSession, attempt: Folder, target: Folder) -> None:
    """Put the finished attempt where the target is; the old one comes back if that fails."""
    uri = target.uri()
    old = Folder(spark, f"{uri}.old-{uuid.uuid4().hex}")
    had = target.exists()
    if had:
        target.move(old.uri())
    try:
        attempt.move(uri)
    except BaseException:
        if had:
            old.move(uri)
        raise
    old.delete()


@F.arrow_udf(ArrayType(IntegerType()))
def _ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The ids of one file at a time."""
    for blob in (blob for blobs in batches for blob in blobs):
        values = np.load(io.BytesIO(blob.as_py())).astype(np.int32)
        offsets = pa.array([0, len(values)], pa.int32())
        yield pa.ListArray.from_arrays(offsets, pa.array(values))


def read_npy(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Read exported shards as ``(split, shard_id, start, n_tokens, shard_tokens, tokens)``."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"{split or '*'}_shard_*.npy")
        .load(path)
    )
    named = files.select(
        F.regexp_extract("path", FILE_PATTERN, 1).alias("split"),
        F.regexp_extract("path", FILE_PATTERN, 2).cast("bigint").alias("shard_id"),
        _ids("content").alias("tokens"),
    )
    n_tokens = F.size("tokens").cast("bigint")
    return named.select(
        "split",
        "shard_id",
        F.lit(0).cast("bigint").alias("start"),
        n_tokens.alias("n_tokens"),
        n_tokens.alias("shard_tokens"),
        "tokens",
    )
