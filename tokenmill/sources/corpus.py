"""Text corpora as tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Corpus:
    """Where a corpus lies and which of its rows belong to it."""

    path: str
    where: str | None = None
    text_col: str = "text"
    order_by: str | tuple[str, ...] = "doc_id"

    @property
    def keys(self) -> list[str]:
        return [self.order_by] if isinstance(self.order_by, str) else list(self.order_by)


class CorpusRegistry:
    """Corpora under short names."""

    def __init__(self, corpora: dict[str, Corpus] | None = None):
        self._corpora = dict(corpora or {})

    def add(self, name: str, corpus: Corpus) -> None:
        self._corpora[name] = corpus

    def names(self) -> list[str]:
        return sorted(self._corpora)

    def __getitem__(self, name: str) -> Corpus:
        if name not in self._corpora:
            raise KeyError(f"unknown corpus {name!r}; known: {', '.join(self.names())}")
        return self._corpora[name]

    def load(self, spark: SparkSession, name: str, extra_columns: Sequence[str] = ()) -> DataFrame:
        corpus = self[name]
        return load_corpus(
            spark, corpus.path, corpus.text_col, corpus.keys, corpus.where, extra_columns
        )


def load_corpus(
    spark: SparkSession,
    path: str,
    text_col: str = "text",
    order_by: str | Sequence[str] = "doc_id",
    where: str | Column | None = None,
    extra_columns: Sequence[str] = (),
) -> DataFrame:
    """Read key and text column of a Parquet corpus, as ``(keys..., text, extra...)``.

    ``where`` is applied on the scan, so it prunes partitions (a ``split``
    folder) and row groups.
    """
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    table = spark.read.parquet(path)
    missing = [c for c in [*keys, text_col, *extra_columns] if c not in table.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    if where is not None:
        table = table.where(where)
    return table.select(*keys, F.col(text_col).alias("text"), *extra_columns)


def spread(df: DataFrame) -> DataFrame:
    """Give every core something to do if a scan has fewer splits than there are cores.

    A file cannot be split below its row groups, so a small corpus may arrive
    in one partition, which matters before per-row work in Python.  A large
    corpus has many splits and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def corpus_counts(corpus: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows and characters, in all or per group."""
    return corpus.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.char_length("text")), F.lit(0)).alias("n_chars"),
    )


def read_texts(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """Text files, one row per file (``whole``, line feeds and all) or per line."""
    return spark.read.text(path, wholetext=whole).select(F.col("value").alias("text"))


def append_texts(df: DataFrame, path: str, text_col: str = "text") -> None:
    """Append each text and a line feed to a folder of text files; its own line feeds stay."""
    df.select(F.col(text_col).alias("value")).write.mode("append").text(path)
