"""Early stopping over the loss series of many runs.

A step improves if its score reaches the best score so far plus ``delta``; the
best score moves only then, so this is a true fold.  A run may hold most of the
table, so no task may hold a run:

* The table is cut into key ranges (buckets).  A running maximum, carried over
  the bucket borders, leaves only the records, the scores above all earlier
  ones; nothing else can improve.
* The fold then needs one record per bucket, the first that a run takes in it.  Only
  runs that cross a border have to look for it.  Inside a bucket every record
  knows with which record a run that took it leaves the bucket, and where it goes
  from there.  These maps are put together for pairs of buckets, pairs of pairs
  and so on, and the way of a run is read off from the largest pair down, so
  the number of jobs grows with the logarithm of the number of buckets.
* With these records known, all buckets are folded at the same time.

Counters and flags follow from the positions of the improvements alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.operators.ordering import BUCKET, RowOrder, with_carried
from tokenmill.staging import stage


@dataclass(frozen=True)
class Patience:
    """Stop after ``patience`` steps in a row without an improvement of ``delta``."""

    patience: int = 30
    delta: float = 0.2
    mode: str = "min"

    def __post_init__(self) -> None:
        if self.mode not in ("min", "max"):
            raise ValueError("mode must be 'min' or 'max'")
        if self.delta < 0:
            raise ValueError("delta must not be negative")

    def score(self, loss: Column) -> Column:
        """Larger is better.  A loss that is not a number is an error."""
        text = F.lit("a loss is not a number; filter such steps or end the run before them")
        loss = F.when(loss.isNull() | F.isnan(loss), F.raise_error(text)).otherwise(loss)
        return -loss if self.mode == "min" else loss + F.lit(0.0)

    @property
    def limit(self) -> int:
        """The counter is looked at only after a step without improvement."""
        return max(self.patience, 1)


RECORD = "bucket int, run_id bigint, step bigint, ord bigint, score double"


def _numbered(series: DataFrame, order: RowOrder, rule: Patience) -> DataFrame:
    """Rows with the position ``ord`` in their run and the best score before them.

    A row of ``weight`` w stands for itself and for w - 1 rows without an
    improvement right after it.
    """
    scored = _weighted(series).select(
        "run_id", "step", "weight", rule.score(F.col("loss")).alias("score")
    )
    per_bucket = order.with_bucket(scored).groupBy(BUCKET, "run_id").agg(
        F.max("score").alias("max_score"), F.sum("weight").alias("n_rows")
    )
    in_run = Window.partitionBy(BUCKET, "run_id").orderBy("step")
    upto = in_run.rowsBetween(Window.unboundedPreceding, 0)
    earlier = in_run.rowsBetween(Window.unboundedPreceding, -1)
    rows = order.place(scored).withColumns(
        {
            "ord": F.sum("weight").over(upto) - F.col("weight") + 1,
            "max_before": F.max("score").over(earlier),
        }
    )
    carries = {"max_in": (F.max("max_score"), "double"), "rows_in": (F.sum("n_rows"), "bigint")}
    return with_carried(rows, order, per_bucket, "run_id", carries).select(
        BUCKET,
        "run_id",
        "step",
        "score",
        (F.col("ord") + F.coalesce("rows_in", F.lit(0))).alias("ord"),
        F.greatest("max_before", "max_in").alias("max_before"),
    )


def _weighted(series: DataFrame) -> DataFrame:
    if "weight" in series.columns:
        return series
    return series.withColumn("weight", F.lit(1).cast("bigint"))


def climb(scores: np.ndarray, at: int, delta: float) -> list[int]:
    """Positions of the improvements in never-falling ``scores`` from the one at ``at`` on.

    The next improvement is the first score to reach the last one plus ``delta``, which a
    binary search finds.
    """
    taken = []
    while at < len(scores):
        taken.append(at)
        at += 1 + int(np.searchsorted(scores[at + 1 :], scores[at] + delta, side="left"))
    return taken


def last_taken(scores: np.ndarray, delta: float) -> np.ndarray:
    """For each of some never-falling ``scores`` the position :func:`climb` ends at from there."""
    places = np.arange(len(scores))
    after = np.maximum(np.searchsorted(scores, scores + delta, side="left"), places + 1)
    ends = np.where(after < len(scores), after, places)
    while True:
        further = ends[ends]
        if np.array_equal(further, ends):
            return ends
        ends = further


def _records(series: DataFrame, order: RowOrder, rule: Patience) -> DataFrame:
    """Rows that can improve, as a staged table with one folder per bucket.

    A score equal to the highest before it improves only if ``delta`` is too
    small to change it.
    """
    score, before = F.col("score"), F.col("max_before")
    can_improve = before.isNull() | (score > before) | (
        (score == before) & (score + F.lit(rule.delta) == score)
    )
    kept = _numbered(series, order, rule).where(can_improve)
    return stage(kept.select("run_id", "step", "ord", "score", BUCKET), "records", [BUCKET])


def _segments(batches: Iterator[pd.DataFrame]) -> Iterator[dict[str, np.ndarray]]:
    """The share of one run in one bucket, whole, from rows sorted by bucket and run."""
    held: list[dict[str, np.ndarray]] = []

    def whole() -> dict[str, np.ndarray]:
        if len(held) == 1:
            return held[0]
        return {name: np.concatenate([part[name] for part in held]) for name in held[0]}

    for batch in batches:
        columns = {name: batch[name].to_numpy() for name in batch.columns}
        runs, buckets = columns["run_id"], columns["bucket"]
        borders = np.flatnonzero((np.diff(runs) != 0) | (np.diff(buckets) != 0)) + 1
        for lo, hi in zip([0, *borders.tolist()], [*borders.tolist(), len(batch)]):
            if lo == hi:
                continue
            first = held[0] if held else None
            if first and (first["run_id"][0] != runs[lo] or first["bucket"][0] != buckets[lo]):
                yield whole()
                held = []
            held.append({name: column[lo:hi] for name, column in columns.items()})
    if held:
        yield whole()


def _together(
    parts: Iterator[dict[str, np.ndarray]], names: list[str], rows: int = 10_000
) -> Iterator[pd.DataFrame]:
    """Small results as frames of some thousand rows."""
    held: list[dict[str, np.ndarray]] = []

    def frame() -> pd.DataFrame:
        return pd.DataFrame({name: np.concatenate([p[name] for p in held]) for name in names})

    size = 0
    for part in parts:
        held.append(part)
        size += len(part[names[0]])
        if size >= rows:
            yield frame()
            held, size = [], 0
    if held:
        yield frame()


def _by_segment(records: DataFrame) -> DataFrame:
    placed = records.repartition(BUCKET, "run_id")
    return placed.sortWithinPartitions(BUCKET, "run_id", "ord")


def _fold(records: DataFrame, entries: DataFrame, rule: Patience) -> DataFrame:
    """Improvements among the records, given the record ``entry`` a run takes first in a bucket.

    ``entries`` has a row per bucket of each run that crosses a border, at most two per
    bucket, which bounds the broadcast; ``entry`` is 0 where such a run takes none.  Other runs
    begin with their first record.
    """
    delta = rule.delta

    names = ["bucket", "run_id", "step", "ord", "score"]

    def taken(batches: Iterator[pd.DataFrame]) -> Iterator[dict[str, np.ndarray]]:
        for segment in _segments(batches):
            entry, first = segment["entry"][0], 0
            if not np.isnan(entry):
                if not entry:
                    continue
                first = int(np.searchsorted(segment["ord"], entry))
            at = climb(segment["score"], first, delta)
            yield {name: segment[name][at] for name in names}

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _together(taken(batches), names)

    known = records.join(F.broadcast(entries), [BUCKET, "run_id"], "left")
    return _by_segment(known).mapInPandas(walk, RECORD)


#: Ways out of buckets that are followed without further jobs.
FEW_WAYS = 20_000

EXIT = "bucket int, run_id bigint, ord bigint, score double, needed double"


def _exits(crossing: DataFrame, delta: float) -> DataFrame:
    """For each record the score that a run has to reach to get better after its bucket."""

    names = ["bucket", "run_id", "ord", "score", "needed"]

    def needing(batches: Iterator[pd.DataFrame]) -> Iterator[dict[str, np.ndarray]]:
        for segment in _segments(batches):
            scores = segment["score"]
            yield segment | {"needed": scores[last_taken(scores, delta)] + delta}

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _together(needing(batches), names)

    return _by_segment(crossing).mapInPandas(walk, EXIT)


def _leaving(crossing: DataFrame, runs: DataFrame, most: int, delta: float) -> DataFrame:
    """For each record the bucket ``to`` and the record ``next`` that its run takes after its bucket.

    The bucket is the first later one whose highest score is enough, found by a binary search in
    the at most ``most`` buckets of the run; inside it, scores asked for and scores there are
    sorted together.
    """
    exits = _exits(crossing, delta)
    strides = [1 << bit for bit in reversed(range(most.bit_length()))]

    def passed(below: Column, stride: Column) -> Column:
        at = F.try_element_at("tops", below + stride)
        short = (at[BUCKET] <= F.col(BUCKET)) | (at["top"] < F.col("needed"))
        return F.when(short, below + stride).otherwise(below)

    place = F.aggregate(F.array(*[F.lit(stride) for stride in strides]), F.lit(0), passed)
    sent = exits.join(F.broadcast(runs), "run_id").withColumn("to", F.get("tops", place)[BUCKET])
    asked = sent.select(
        F.col("to").alias("at"), "run_id", F.col("needed").alias("value"), F.lit(1).alias("asks"),
        BUCKET, "ord",
    )
    there = crossing.select(
        F.col(BUCKET).alias("at"), "run_id", F.col("score").alias("value"), F.lit(0).alias("asks"),
        F.lit(None).cast("int").alias(BUCKET), "ord",
    )
    downwards = Window.partitionBy("at", "run_id").orderBy(
        F.desc("value"), "asks", F.desc("ord")
    )
    found = F.last(F.when(F.col("asks") == 0, F.col("ord")), ignorenulls=True)
    return (
        asked.where("at is not null").unionByName(there)
        .withColumn("next", found.over(downwards.rowsBetween(Window.unboundedPreceding, 0)))
        .where("asks = 1")
        .select("run_id", BUCKET, "ord", F.col("at").alias("to"), "next")
    )


def _entries(records: DataFrame, order: RowOrder, rule: Patience) -> DataFrame:
    """The record a run takes first in each of its buckets: ``(bucket, run_id, entry)``.

    Only for runs with records in several buckets, of which a border has one at most, so
    what reaches the driver is two rows per bucket at most.
    """
    spark = records.sparkSession
    empty = spark.createDataFrame([], "bucket int, run_id bigint, entry bigint")
    if order.n_buckets == 1:
        return empty
    per_bucket = records.groupBy("run_id", BUCKET).agg(
        F.max("score").alias("top"), F.min("ord").alias("first")
    )
    found = (
        per_bucket.groupBy("run_id")
        .agg(F.array_sort(F.collect_list(F.struct(BUCKET, "top", "first"))).alias("tops"))
        .where(F.size("tops") > 1)
        .toArrow()
        .combine_chunks()
    )
    if not len(found):
        return empty
    runs = spark.createDataFrame(found)
    firsts = [tops[0] for tops in found["tops"].to_pylist()]
    starts = pa.table(
        {
            "run_id": found["run_id"],
            BUCKET: pa.array([first[BUCKET] for first in firsts], pa.int32()),
            "ord": pa.array([first["first"] for first in firsts], pa.int64()),
        }
    )
    way = spark.createDataFrame(_way(records, runs, starts, order.n_buckets, rule.delta))
    segments = runs.select("run_id", F.explode("tops").alias("segment")).select(
        "run_id", f"segment.{BUCKET}"
    )
    taken = way.withColumnRenamed("ord", "entry")
    return segments.join(F.broadcast(taken), ["run_id", BUCKET], "left").select(
        BUCKET, "run_id", F.coalesce("entry", F.lit(0)).alias("entry")
    )


def _way(
    records: DataFrame, runs: DataFrame, starts: pa.Table, n_buckets: int, delta: float
) -> pa.Table:
    """The records ``(run_id, bucket, ord)`` that runs take first in their buckets.

    A few ways out are followed one after the other; more are put together by doubling.
    """
    spark = records.sparkSession
    crossing = records.join(F.broadcast(runs.select("run_id")), "run_id", "left_semi")
    leaving = _leaving(crossing, runs, n_buckets, delta)
    ways = _reached(leaving, spark.createDataFrame(starts))
    few = ways.limit(FEW_WAYS + 1).toArrow()
    if len(few) <= FEW_WAYS:
        return _followed(starts, few)
    # levels[k] leads a record out of its block of 2^k buckets.
    levels, found = [stage(ways, "leaving")], starts
    while 1 << len(levels) < n_buckets:
        levels.append(stage(_doubled(levels[-1], len(levels)), "leaving"))
    for size, level in reversed(list(enumerate(levels))):
        leads = level.where(_block("to", size + 1) == _block(BUCKET, size + 1))
        so_far = F.broadcast(spark.createDataFrame(found))
        further = leads.join(so_far, ["run_id", BUCKET, "ord"]).select(
            "run_id", F.col("to").alias(BUCKET), F.col("next").alias("ord")
        )
        found = pa.concat_tables([found, further.toArrow()]).combine_chunks()
    return found


def _followed(starts: pa.Table, leaving: pa.Table) -> pa.Table:
    key = lambda table, bucket, ord_: zip(
        *(table[c].to_pylist() for c in ("run_id", bucket, ord_)), strict=True
    )
    after = dict(zip(key(leaving, BUCKET, "ord"), key(leaving, "to", "next"), strict=True))
    way = []
    for record in key(starts, BUCKET, "ord"):
        while record is not None:
            way.append(record)
            record = after.get(record)
    columns = [pa.array(c, f.type) for c, f in zip(zip(*way), starts.schema)]
    return pa.Table.from_arrays(columns, schema=starts.schema)


def _reached(leaving: DataFrame, starts: DataFrame) -> DataFrame:
    """Of the records those that a run may take first in a bucket: targets of others, and its first."""
    entered = leaving.select("run_id", F.col("to").alias(BUCKET), F.col("next").alias("ord"))
    return leaving.join(entered.unionByName(starts).distinct(), ["run_id", BUCKET, "ord"], "left_semi")


def _block(bucket: str, size: int) -> Column:
    """Number of the block of 2^size buckets that a bucket is in."""
    return F.shiftright(F.col(bucket), size)


def _doubled(level: DataFrame, size: int) -> DataFrame:
    """Ways out of blocks of 2^size buckets, from those out of blocks of half the size."""
    inside = _block("to", size) == _block(BUCKET, size)
    on = level.select(
        "run_id",
        F.col(BUCKET).alias("to"),
        F.col("ord").alias("next"),
        F.col("to").alias("to_after"),
        F.col("next").alias("next_after"),
    )
    stay = level.where(inside).join(on, ["run_id", "to", "next"]).select(
        "run_id", BUCKET, "ord", F.col("to_after").alias("to"), F.col("next_after").alias("next")
    )
    return level.where(~inside).unionByName(stay)


def _improvements(series: DataFrame, order: RowOrder, rule: Patience) -> DataFrame:
    """Staged improvements ``(bucket, run_id, step, ord, score)``."""
    records = _records(series, order, rule)
    return stage(_fold(records, _entries(records, order, rule), rule), "improvements")


def _stops(found: DataFrame, order: RowOrder, rule: Patience) -> DataFrame:
    """Position ``stop_ord`` of the first stop between two improvements, for runs that have one."""
    per_bucket = found.groupBy(BUCKET, "run_id").agg(F.max("ord").alias("last_ord"))
    in_run = Window.partitionBy(BUCKET, "run_id").orderBy("ord")
    rows = found.withColumn("ord_before", F.lag("ord").over(in_run))
    carries = {"ord_in": (F.max("last_ord"), "bigint")}
    gaps = with_carried(rows, order, per_bucket, "run_id", carries).withColumn(
        "ord_before", F.coalesce("ord_before", "ord_in")
    )
    return (
        gaps.where(F.col("ord") - F.col("ord_before") - 1 >= rule.limit)
        .groupBy("run_id")
        .agg(F.min(F.col("ord_before") + rule.limit).alias("stop_ord"))
    )


def _val_loss(rule: Patience) -> Column:
    return (-F.col("score") if rule.mode == "min" else F.col("score")).alias("val_loss")


def improvements(series: DataFrame, rule: Patience, buckets: int | None = None) -> DataFrame:
    """The steps at which a run gets better, which is when it would be saved."""
    order = RowOrder.fit(series, ["run_id", "step"], buckets)
    return _improvements(series, order, rule).select("run_id", "step", "score", _val_loss(rule))


def early_stop(series: DataFrame, rule: Patience, buckets: int | None = None) -> DataFrame:
    """End state of every run of ``(run_id, step, loss)``.

    A ``weight`` column marks series that go on from an earlier state.
    """
    order = RowOrder.fit(series, ["run_id", "step"], buckets)
    found = _improvements(series, order, rule)
    last = (
        found.groupBy("run_id")
        .agg(F.max_by(F.struct("step", "ord", "score"), "ord").alias("last"))
        .select("run_id", "last.*")
    )
    lengths = _weighted(series).groupBy("run_id").agg(F.sum("weight").alias("n_steps"))
    counter = F.col("n_steps") - F.col("ord")
    ends = last.join(lengths, "run_id").join(_stops(found, order, rule), "run_id", "left")
    return ends.select(
        "run_id",
        "n_steps",
        F.col("step").alias("best_step"),
        "score",
        _val_loss(rule),
        counter.alias("counter"),
        (F.col("stop_ord").isNotNull() | (counter >= rule.limit)).alias("stopped"),
    )


def early_stop_trace(series: DataFrame, rule: Patience, buckets: int | None = None) -> DataFrame:
    """State of every run after each of its steps.

    Improvements are put in front of their own row, and each row takes up the
    latest one: inside its key range by a window, from earlier ranges by the
    carried one.
    """
    order = RowOrder.fit(series, ["run_id", "step"], buckets)
    found = _improvements(series, order, rule)
    stopped_before = F.coalesce(F.col("ord") > F.col("stop_ord"), F.lit(False))
    better = found.join(_stops(found, order, rule), "run_id", "left").withColumn(
        "mark",
        F.struct("ord", F.col("score").alias("best"), stopped_before.alias("stopped_before")),
    )
    per_bucket = (
        order.with_bucket(series).groupBy(BUCKET, "run_id")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .join(
            better.groupBy(BUCKET, "run_id").agg(F.max_by("mark", "ord").alias("mark")),
            [BUCKET, "run_id"],
            "left",
        )
    )
    rows = order.place(
        series.select("run_id", "step", "loss", F.lit(1).alias("is_row")).unionByName(
            better.select("run_id", "step", F.lit(0).alias("is_row"), "mark"),
            allowMissingColumns=True,
        )
    )
    in_run = Window.partitionBy(BUCKET, "run_id").orderBy("step", "is_row")
    upto = in_run.rowsBetween(Window.unboundedPreceding, 0)
    numbered = rows.withColumns(
        {
            "ord": F.sum("is_row").over(upto),
            "state": F.last("mark", ignorenulls=True).over(upto),
            "improved": F.coalesce(F.lag("is_row").over(in_run) == 0, F.lit(False)),
        }
    ).where("is_row = 1")
    mark_type = "struct<ord: bigint, best: double, stopped_before: boolean>"
    carries = {
        "mark_in": (F.last("mark", ignorenulls=True), mark_type),
        "rows_in": (F.sum("n_rows"), "bigint"),
    }
    traced = with_carried(numbered, order, per_bucket, "run_id", carries).withColumns(
        {
            "ord": F.col("ord") + F.coalesce("rows_in", F.lit(0)),
            "state": F.coalesce("state", "mark_in"),
        }
    )
    counter = F.col("ord") - F.col("state.ord")
    return traced.select(
        "run_id",
        "step",
        "loss",
        F.col("state.best").alias("best"),
        counter.alias("counter"),
        "improved",
        (F.col("state.stopped_before") | (counter >= rule.limit)).alias("stopped"),
    )
