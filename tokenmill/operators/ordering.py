"""Row positions and running totals for tables whose order is part of their meaning.

A window without partition keys would pull the whole table into one task.
Instead the key space is cut into ranges ("buckets") of about equal bytes.
The cuts are a small table that is sent to all tasks and searched by position, so a
bucket number follows from the row's own key and a re-run task always gives the
same answer.  One number per bucket is enough to turn positions inside a bucket
into global positions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime
from itertools import accumulate
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, LongType, StructType

from tokenmill.staging import stage

BUCKET = "bucket"
#: What a range holds if there is enough of it, whatever the number of ranges.
RANGE_BYTES = 64 << 20
#: Rows without a size of their own count as so many bytes.
ROW_BYTES = 64
#: Keys of the sketch that stand for a range.
SKETCH_PER_RANGE = 64
#: A range with fewer rows is not worth a task.
MIN_ROWS = 128
SIZE = "row bytes"
_CUTS = "cuts of ranges"


def exclusive_sums(values: Sequence[int]) -> list[int]:
    return [0, *accumulate(values)][:-1]


def local_table(spark: SparkSession, columns: dict[str, Sequence[int]]) -> DataFrame:
    """A table of numbers, one row per bucket, that is part of the plan."""
    return spark.createDataFrame(pa.table({n: pa.array(v, pa.int64()) for n, v in columns.items()}))


def with_bases(df: DataFrame, bases: Sequence[int], out: str) -> DataFrame:
    """Add the number that ``bases`` has for the bucket of a row."""
    if len(bases) == 1:
        return df.withColumn(out, F.lit(bases[0]).cast("bigint"))
    table = local_table(df.sparkSession, {BUCKET: range(len(bases)), out: bases})
    table = table.withColumn(BUCKET, F.col(BUCKET).cast("int"))
    return df.join(F.broadcast(table), BUCKET, "left").select(*df.columns, out)


def _picked(n_keys: int, step: float, ranges: int) -> Callable:
    """Of sorted keys with their weights those at which a multiple of ``step`` is passed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = 0.0
        for batch in batches:
            weights = batch.column(n_keys).to_numpy()
            upto = carried + np.cumsum(weights)
            reached = np.minimum(upto // step, ranges - 1)
            at = np.flatnonzero(reached > np.minimum((upto - weights) // step, ranges - 1))
            carried = float(upto[-1]) if len(upto) else carried
            yield batch.select(range(n_keys)).take(pa.array(at))

    return run


@dataclass(frozen=True)
class RowOrder:
    """Total order of a table under a unique key, cut into key ranges.

    ``bounds`` are the first keys of all buckets but bucket 0, ``bases`` the
    number of rows in front of each bucket.  ``sizes`` is a staged table of the keys with
    the weight of their rows in the column ``SIZE``, if there were weights.
    """

    keys: tuple[str, ...]
    key_schema: StructType
    bounds: tuple[tuple[Any, ...], ...]
    bases: tuple[int, ...]
    n_rows: int
    sizes: DataFrame | None = field(default=None, compare=False, repr=False)

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        keys: str | Sequence[str],
        buckets: int | None = None,
        weight: Column | None = None,
        range_bytes: int = RANGE_BYTES,
    ) -> RowOrder:
        """Place the cuts so that ranges hold about ``range_bytes`` of ``weight`` each.

        Small tables get a range per core instead.  Besides the keys the table is read
        once, for the weights, which go to a staged table next to the keys.  The
        quantiles come from a threshold sample: a key is in it if its weight reaches the
        threshold times a hash of the key in [0, 1), and then stands for the threshold
        or its weight, whichever is more.  Such samples of parts of a table merge by
        putting them together, and any key range holds its own weight in the sample but
        for a few parts in ``SKETCH_PER_RANGE``.

        Keys that are null or come up twice raise an error.  What reaches the driver is
        one key and one row count per range.
        """
        keys = (keys,) if isinstance(keys, str) else tuple(keys)
        spark = df.sparkSession
        key_schema = df.select(*keys).schema
        size = F.lit(ROW_BYTES) if weight is None else weight
        sized = df.select(*keys, size.cast("bigint").alias(SIZE))
        if weight is not None:
            sized = stage(sized, "order-keys")
        unknown = F.count_if(F.array_contains(F.array(*[F.col(k).isNull() for k in keys]), True))
        seen = sized.agg(
            F.count("*").alias("rows"), unknown.alias("nulls"), F.sum(SIZE).alias("bytes")
        ).first()
        if seen["nulls"]:
            raise ValueError(f"{seen['nulls']} rows have no order key in {', '.join(keys)}")
        n_rows, n_bytes = seen["rows"], float(seen["bytes"] or 0) + seen["rows"]
        if buckets is None:
            cores = spark.sparkContext.defaultParallelism
            buckets = min(n_rows // MIN_ROWS, max(cores, int(n_bytes // range_bytes)))
        bounds: tuple[tuple[Any, ...], ...] = ()
        if buckets > 1 and n_rows:
            bounds = _cuts(sized, keys, key_schema, n_bytes, buckets)
        sizes = None if weight is None else sized
        order = cls(keys, key_schema, bounds, (0,) * (len(bounds) + 1), n_rows, sizes)
        return replace(order, bases=tuple(exclusive_sums(order._unique_counts(sized))))

    def _unique_counts(self, sized: DataFrame) -> list[int]:
        """Rows per bucket, after a look at all neighbours in the order for equal keys."""
        key = F.struct(*self.keys)
        before = F.lag(key).over(Window.partitionBy(BUCKET).orderBy(*self.keys))
        twice = F.when(before == key, key)
        rows = (
            self.place(sized)
            .withColumn("twice", twice)
            .groupBy(BUCKET)
            .agg(F.count("*").alias("rows"), F.min("twice").alias("twice"))
            .collect()
        )
        for row in rows:
            if row["twice"] is not None:
                raise ValueError(
                    f"order keys {', '.join(self.keys)} are not unique: {tuple(row['twice'])} "
                    "comes up more than once; add a column that breaks ties"
                )
        found = {row[BUCKET]: row["rows"] for row in rows}
        return [found.get(bucket, 0) for bucket in range(self.n_buckets)]

    @property
    def n_buckets(self) -> int:
        return len(self.bases)

    def _key(self) -> Column:
        return F.col(self.keys[0]) if len(self.keys) == 1 else F.struct(*self.keys)

    def _literal(self, key: Sequence[Any]) -> Column:
        parts = [
            F.lit(value).cast(field.dataType).alias(field.name)
            for value, field in zip(key, self.key_schema.fields)
        ]
        return parts[0] if len(parts) == 1 else F.struct(*parts)

    def _cut_table(self, spark: SparkSession) -> DataFrame:
        """One row that holds all cuts."""
        kinds = ArrayType(
            self.key_schema[0].dataType if len(self.keys) == 1 else self.key_schema
        )
        # Times come from the driver's time zone and are sent with it.
        values = [
            tuple(v.astimezone() if isinstance(v, datetime) else v for v in bound)
            for bound in self.bounds
        ]
        if len(self.keys) == 1:
            values = [value for (value,) in values]
        else:
            values = [dict(zip(self.keys, value)) for value in values]
        return spark.createDataFrame(
            pa.table({_CUTS: pa.array([values], to_arrow_type(kinds))})
        ).select(F.col(f"`{_CUTS}`").cast(kinds).alias(_CUTS))

    def with_bucket(self, df: DataFrame) -> DataFrame:
        """Add the bucket number of a row: how many cuts its key has reached."""
        if not self.bounds:
            return df.withColumn(BUCKET, F.lit(0))
        cuts, key = F.col(f"`{_CUTS}`"), self._key()
        strides = [1 << bit for bit in reversed(range(len(self.bounds).bit_length()))]
        position = F.aggregate(  # a binary search
            F.array(*[F.lit(stride) for stride in strides]),
            F.lit(0),
            lambda below, stride: F.when(
                F.try_element_at(cuts, below + stride) <= key, below + stride
            ).otherwise(below),
        )
        table = F.broadcast(self._cut_table(df.sparkSession))
        return df.join(table, F.lit(True)).withColumn(BUCKET, position).drop(_CUTS)

    def totals(self, df: DataFrame, value: Column) -> list[int]:
        """Sum of ``value`` per bucket, as one driver-side number per bucket."""
        valued = df.select(*self.keys, value.alias("value"))
        return totals_by_bucket(self.with_bucket(valued), "value", self.n_buckets)

    def place(self, df: DataFrame) -> DataFrame:
        """Shuffle the rows once, one partition per bucket."""
        return self.with_bucket(df).repartitionById(self.n_buckets, F.col(BUCKET))

    def with_ordinal(self, df: DataFrame, out: str = "ord") -> DataFrame:
        """Add the zero-based position of each row in the whole table."""
        position = F.row_number().over(Window.partitionBy(BUCKET).orderBy(*self.keys))
        placed = self.place(df).withColumn("place in range", position)
        return (
            with_bases(placed, self.bases, "base of range")
            .withColumn(out, F.col("`base of range`") + F.col("`place in range`") - 1)
            .drop("base of range", "place in range")
        )

    def keys_at(self, df: DataFrame, ordinals: Iterable[int]) -> dict[int, tuple[Any, ...]]:
        """Keys of the rows at the given positions; only key columns are shuffled.

        At most a few positions per bucket may be asked for.
        """
        ends = [*self.bases[1:], self.n_rows]
        wanted = sorted({o for o in ordinals if 0 <= o < self.n_rows})
        if not wanted:
            return {}
        places = np.searchsorted(np.array(ends), np.array(wanted), side="right")
        asked = local_table(df.sparkSession, {"ord": wanted, BUCKET: places.tolist()})
        touched = F.broadcast(asked.select(F.col(BUCKET).cast("int")).distinct())
        keys = self.with_bucket(df.select(*self.keys)).join(touched, BUCKET, "left_semi")
        rows = self.with_ordinal(keys.select(*self.keys))
        hits = rows.join(F.broadcast(asked.select("ord")), "ord", "left_semi")
        return {row["ord"]: tuple(row[k] for k in self.keys) for row in hits.collect()}

    def realign(self, df: DataFrame, multiple: int, also: Sequence[int] = ()) -> RowOrder:
        """Move the cuts so that each bucket starts at a multiple of ``multiple`` rows.

        Groups of ``multiple`` consecutive rows then never straddle two
        buckets, so grouping them after :meth:`place` needs no second shuffle.
        The positions ``also`` become starts of buckets, too.
        """
        if multiple == 1 and not set(also) - {0, self.n_rows}:
            return self
        return self.recut(df, {-(-base // multiple) * multiple for base in self.bases} | set(also))

    def recut(self, df: DataFrame, starts: Iterable[int]) -> RowOrder:
        """The same order with buckets that start at the given positions."""
        wanted = {start for start in starts if 0 < start < self.n_rows}
        at = {base: key for base, key in zip(self.bases[1:], self.bounds) if base in wanted}
        at |= self.keys_at(df, wanted - set(at))
        kept = sorted(at)
        return replace(self, bounds=tuple(at[o] for o in kept), bases=(0, *kept))

    def head(self, n_rows: int) -> RowOrder:
        """The order of the first ``n_rows`` rows alone; a bucket has to start there."""
        if n_rows >= self.n_rows:
            return self
        kept = [base for base in self.bases if base < n_rows] or [0]
        return replace(
            self, bounds=self.bounds[: len(kept) - 1], bases=tuple(kept), n_rows=n_rows
        )

    def before(self, df: DataFrame, ordinal: int) -> Column:
        """Condition ``position < ordinal`` as a comparison on the key.

        It needs no shuffle of the table it is applied to and, for a
        single-column key, reaches the file scan.
        """
        if ordinal <= 0:
            return F.lit(False)
        if ordinal >= self.n_rows:
            return F.lit(True)
        if ordinal in self.bases:
            key = self.bounds[self.bases.index(ordinal) - 1]
        else:
            key = self.keys_at(df, [ordinal])[ordinal]
        return self._key() < self._literal(key)


def inside_total(value: str, order_by: str = "ord") -> Column:
    """Sum of ``value`` over the earlier rows of the same bucket."""
    earlier = (
        Window.partitionBy(BUCKET).orderBy(order_by).rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(value).over(earlier), F.lit(0))


def with_base(df: DataFrame, totals: Sequence[int], out: str, first: int = 0) -> DataFrame:
    """Add ``first`` plus the totals of all earlier buckets."""
    return with_bases(df, [first + base for base in exclusive_sums(totals)], out)


def _cuts(
    sized: DataFrame,
    keys: tuple[str, ...],
    key_schema: StructType,
    n_bytes: float,
    ranges: int,
) -> tuple[tuple[Any, ...], ...]:
    """First keys of all ranges but the first, from the threshold sample.

    The sample, a key for each ``1 / SKETCH_PER_RANGE`` of a range, is sorted and read
    through in one task, which keeps nothing of it.
    """
    threshold = n_bytes / (ranges * SKETCH_PER_RANGE)
    share = F.shiftrightunsigned(F.xxhash64(*keys), 11) / float(1 << 53)
    size = F.col(f"`{SIZE}`").cast("double") + 1
    sample = sized.where(size >= share * threshold).select(
        *keys, F.greatest(size, F.lit(threshold)).alias(SIZE)
    )
    picked = _picked(len(keys), n_bytes / ranges, ranges)
    found = sample.repartition(1).sortWithinPartitions(*keys).mapInArrow(picked, key_schema)
    return tuple(dict.fromkeys(sorted(tuple(row) for row in found.collect())))


def totals_by_bucket(df: DataFrame, value: str, n_buckets: int) -> list[int]:
    """Sum of ``value`` per bucket of a table that carries its bucket numbers."""
    rows = df.groupBy(BUCKET).agg(F.sum(value).alias("total")).collect()
    found = {row[BUCKET]: int(row["total"] or 0) for row in rows}
    return [found.get(bucket, 0) for bucket in range(n_buckets)]


def with_carried(
    df: DataFrame,
    order: RowOrder,
    per_bucket: DataFrame,
    group: str,
    carries: dict[str, tuple[Column, str]],
) -> DataFrame:
    """Add to bucketed rows what their group brings into the bucket from the buckets before it.

    ``per_bucket`` has one row per (bucket, group) of a table ordered by group
    first, ``carries`` names the aggregate over a group's earlier buckets and
    its type.  A bucket is a key range, so at most one group enters it from
    earlier buckets: the broadcast table has at most one row per bucket.
    """
    if order.n_buckets == 1:
        return df.withColumns({n: F.lit(None).cast(kind) for n, (_, kind) in carries.items()})
    earlier = (
        Window.partitionBy(group).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = {name: column.over(earlier) for name, (column, _) in carries.items()}
    entering = (
        per_bucket.withColumns({**carried, "entered": F.count(F.lit(1)).over(earlier) > 0})
        .where("entered")
        .select(BUCKET, group, *carries)
    )
    return df.join(F.broadcast(entering), [BUCKET, group], "left")
