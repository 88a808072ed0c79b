"""Intermediate tables in the shared folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def work_root(spark: SparkSession) -> str:
    """Folder for staged tables: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Only a local session may fall back to a temporary folder of its own: on a
    cluster that folder would not be seen by the other machines.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tokenmill-"))
    return context.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{work_root(spark)}/tokenmill/{label}-{uuid.uuid4().hex}"


#: Writer options of tables with a long array in each row.  Readers take up to a row group at
#: once, so a small one bounds their memory, whatever the number of rows of a batch is.
LONG_ROWS = {
    "parquet.block.row.count.limit": "32",
    "parquet.block.size": str(8 << 20),
    "parquet.page.size.row.check.min": "1",
}


#: Makes Spark delete the shuffle files of a query as soon as the query has ended.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files, which Spark else keeps until it collects garbage.

    A DataFrame takes the setting over when it is made; a written one when it is written.
    """
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def stage(
    df: DataFrame,
    label: str,
    folders: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    The table survives the loss of any executor, and later readers scan only
    the columns they use, which a checkpointed DataFrame cannot do.  What was shuffled on
    the way is deleted, as nothing reads it again.  With ``folders``, filters on these columns choose the files to read.  ``options`` go to the
    writer.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    for made in _collecting:
        made.append(path)
    with shuffles_removed(spark):
        df.write.options(**(options or {})).partitionBy(*folders).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


_collecting: list[list[str]] = []


@contextmanager
def collecting() -> Iterator[list[str]]:
    """The paths of the tables staged inside, in order, so that they can be removed in time."""
    made: list[str] = []
    _collecting.append(made)
    try:
        yield made
    finally:
        _collecting.remove(made)


def remove_staged(spark: SparkSession, paths: Sequence[str], read_by: Sequence[DataFrame] = ()) -> None:
    """Delete staged tables but for those that one of the tables ``read_by`` is still read from.

    Other DataFrames that are still to be run must not read them.
    """
    needed = [file for table in read_by for file in table.inputFiles()]
    for path in paths:
        name = path.rsplit("/", 1)[1]
        if not any(f"/{name}/" in file for file in needed):
            remove(spark, path)


class Folder:
    """A folder in whatever file system Spark reads its path from."""

    def __init__(self, spark: SparkSession, path: str):
        self.context = spark.sparkContext
        self.path = self._path(path)
        self.files = self.path.getFileSystem(self.context._jsc.hadoopConfiguration())

    def _path(self, path: str) -> Any:
        return self.context._jvm.org.apache.hadoop.fs.Path(path)

    def uri(self) -> str:
        """The path with its scheme, which means the same on all machines."""
        return self.files.makeQualified(self.path).toString()

    def exists(self) -> bool:
        return self.files.exists(self.path)

    def create(self) -> None:
        self.files.mkdirs(self.path)

    def delete(self) -> None:
        self.files.delete(self.path, True)

    def move(self, path: str) -> None:
        if not self.files.rename(self.path, self._path(path)):
            raise OSError(f"{self.uri()} could not be moved to {path}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package has written, if it is there."""
    Folder(spark, path).delete()
