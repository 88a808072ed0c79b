"""Early stopping over a stream of loss records.

:func:`monitor_runs` is the stateful operator.  The records of a micro-batch are reduced before
they come to the state of their run: each stretch of ``BLOCK_STEPS`` steps of a run passes on
its length and its records, the scores above all earlier ones of the stretch, as nothing else can
improve.  A run that holds a whole backlog is thereby spread over tasks, and what meets
in one task are its records.  :class:`RunMonitor` goes through the batch operator, in which the
folding itself is spread over tasks, too.

Both raise an error where a loss is null or not a number, as the batch operator does, and where
a step does not come after all steps of earlier micro-batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tokenmill.operators.earlystop import Patience, climb, early_stop
from tokenmill.staging import remove

STATE = (
    "best double, best_step bigint, n_steps bigint, counter bigint, stopped boolean, "
    "last_step bigint"
)
OUTPUT = (
    "run_id bigint, n_steps bigint, best_step bigint, score double, val_loss double, "
    "counter bigint, stopped boolean"
)
#: Steps of a run that are reduced together.
BLOCK_STEPS = 4096
#: Blocks are dealt out into so many groups by a hash; a group holds at least one whole block.
CELLS = 4096
REDUCED = (
    "run_id bigint, block bigint, n_rows bigint, first_step bigint, last_step bigint, "
    "step bigint, place bigint, score double"
)


def block_records(rows: pa.Table, sign: float) -> pa.Table:
    """The records of all blocks of steps in a table ``(run_id, block, step, loss)``."""
    runs = rows.column("run_id").combine_chunks()
    if rows.column("step").null_count:
        raise ValueError("a step is not known")
    run = runs.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
    block, step, loss = (rows.column(c).to_numpy() for c in ("block", "step", "loss"))
    order = np.lexsort((step, block, run))
    run, block, step, score = run[order], block[order], step[order], sign * loss[order] + 0.0
    if np.isnan(score).any():
        raise ValueError(f"a loss of run {runs[order[np.isnan(score).argmax()]]} is not a number")
    opens = np.append(True, (np.diff(run) != 0) | (np.diff(block) != 0))
    twice = ~opens[1:] & (np.diff(step) == 0)
    if twice.any():
        raise ValueError(f"a step of run {runs[order[twice.argmax()]]} comes up more than once")
    owner, firsts = np.cumsum(opens) - 1, np.flatnonzero(opens)
    n_rows = np.diff(np.append(firsts, len(step)))
    # a running maximum that starts anew with each block, on the ranks of the scores
    level = owner * (len(step) + 1) + np.unique(score, return_inverse=True)[1]
    kept = np.flatnonzero(level >= np.maximum.accumulate(level))
    first, size = firsts[owner[kept]], n_rows[owner[kept]]
    return pa.table(
        {
            "run_id": runs.take(pa.array(order[kept])),
            "block": block[kept],
            "n_rows": size,
            "first_step": step[first],
            "last_step": step[first + size - 1],
            "step": step[kept],
            "place": kept - first,
            "score": score[kept],
        }
    )


def reduced(losses: DataFrame, rule: Patience) -> DataFrame:
    """The records of each block of steps of a run, with their place and the size of the block.

    Blocks are reduced many at a time, as runs with few steps in a block make as many blocks
    as there are rows.
    """
    sign = -1.0 if rule.mode == "min" else 1.0

    def shorten(rows: pa.Table) -> pa.Table:
        return block_records(rows, sign)

    blocks = losses.select(
        F.col("run_id").cast("bigint").alias("run_id"),
        F.floor(F.col("step") / BLOCK_STEPS).alias("block"),
        F.col("step").cast("bigint").alias("step"),
        F.col("loss").cast("double").alias("loss"),
    )
    cell = F.pmod(F.xxhash64("run_id", "block"), F.lit(CELLS)).alias("cell")
    return blocks.groupBy(cell).applyInArrow(shorten, REDUCED)


def monitor_runs(losses: DataFrame, rule: Patience) -> DataFrame:
    """State of each run after every micro-batch of ``(run_id, step, loss)``.

    Steps must arrive in order from one micro-batch to the next; within one
    they are sorted here.  The state is six numbers per run.
    """
    sign = -1.0 if rule.mode == "min" else 1.0
    delta, limit = rule.delta, rule.limit

    def advance(
        key: tuple[int], frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames))
        block, place, n_rows = (rows[c].to_numpy() for c in ("block", "place", "n_rows"))
        order = np.lexsort((place, block))
        block, n_rows = block[order], n_rows[order]
        opens = np.append(True, np.diff(block) != 0)
        n_rows = n_rows[opens]
        ahead = np.cumsum(n_rows) - n_rows
        places = place[order] + ahead[np.cumsum(opens) - 1]
        steps, scores = rows["step"].to_numpy()[order], rows["score"].to_numpy()[order]
        first_step = int(rows["first_step"].to_numpy()[order[0]])
        records = np.flatnonzero(scores >= np.maximum.accumulate(scores))
        places, steps, scores = places[records], steps[records], scores[records]
        if state.exists:
            best, best_step, n_steps, counter, stopped, last_step = state.get
            if first_step <= last_step:
                raise ValueError(
                    f"step {first_step} of run {key[0]} is late: {last_step} has been seen"
                )
            first = int(np.searchsorted(scores, best + delta, side="left"))
        else:
            best, best_step, n_steps, counter, stopped = None, 0, 0, 0, False
            first = 0
        last = -1 - counter
        for record in climb(scores, first, delta):
            at = int(places[record])
            stopped = stopped or at - last - 1 >= limit
            best, best_step, last = float(scores[record]), int(steps[record]), at
        taken = int(n_rows.sum())
        n_steps += taken
        counter = taken - 1 - last
        stopped = bool(stopped or counter >= limit)
        last_step = int(rows["last_step"].to_numpy()[order[-1]])
        state.update((best, best_step, n_steps, counter, stopped, last_step))
        yield pd.DataFrame(
            {
                "run_id": [key[0]],
                "n_steps": [n_steps],
                "best_step": [best_step],
                "score": [best],
                "val_loss": [sign * best],
                "counter": [counter],
                "stopped": [stopped],
            }
        )

    return reduced(losses, rule).groupBy("run_id").applyInPandasWithState(
        advance, OUTPUT, STATE, "update", GroupStateTimeout.NoTimeout
    )


class RunMonitor:
    """``foreachBatch`` sink that keeps the state of all runs.

    A micro-batch folds and writes only the runs it holds records of.  The state of a run
    enters as one row: its best loss, standing for all steps since.  Every
    ``snapshot_every`` micro-batches the states of all runs are written together, and what lies
    before the snapshot ahead of that is removed.  A repeated micro-batch starts from the
    states of its predecessors again and overwrites its own.
    """

    def __init__(self, path: str, rule: Patience, snapshot_every: int = 10):
        self.path = path.rstrip("/")
        self.rule = rule
        self.snapshot_every = snapshot_every

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/batch={batch_id}"

    def _before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Latest state of each run before a micro-batch, back to the last snapshot."""
        first = (batch_id - 1) // self.snapshot_every * self.snapshot_every
        folders = [self._folder(n) for n in range(first, batch_id)]
        states = spark.read.schema(KEPT).option("basePath", self.path).parquet(*folders)
        return newest(states)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.select("run_id", "step", "loss", F.lit(1).cast("bigint").alias("weight"))
        spans = new.groupBy("run_id").agg(
            F.min("step").alias("first_step"), F.max("step").alias("last_step")
        )
        if batch_id == 0:
            ends = early_stop(new, self.rule).join(spans.drop("first_step"), "run_id")
            ends.write.mode("overwrite").parquet(self._folder(0))
            return
        every = self._before(spark, batch_id)
        before = every.join(spans, "run_id").select(
            every["*"], "first_step", spans["last_step"].alias("new_last_step")
        )
        late = before.where(F.col("first_step") <= F.col("last_step")).first()
        if late:
            raise ValueError(
                f"step {late['first_step']} of run {late['run_id']} is late: "
                f"{late['last_step']} has been seen"
            )
        carried = before.select(
            "run_id",
            F.col("best_step").alias("step"),
            F.col("val_loss").alias("loss"),
            (F.col("counter") + 1).alias("weight"),
        )
        # the carried row repeats steps that ``before`` has counted already
        known = before.select(
            "run_id",
            (F.col("n_steps") - F.col("counter") - 1).alias("earlier_steps"),
            F.col("stopped").alias("stopped_earlier"),
        )
        ends = (
            early_stop(new.unionByName(carried), self.rule)
            .join(known, "run_id", "left")
            .withColumns(
                {
                    "n_steps": F.col("n_steps") + F.coalesce("earlier_steps", F.lit(0)),
                    "stopped": F.col("stopped") | F.coalesce("stopped_earlier", F.lit(False)),
                }
            )
            .drop("earlier_steps", "stopped_earlier")
            .join(spans.drop("first_step"), "run_id")
        )
        if batch_id % self.snapshot_every == 0:
            quiet = every.join(spans, "run_id", "left_anti")
            ends = ends.unionByName(quiet)
        ends.write.mode("overwrite").parquet(self._folder(batch_id))
        if batch_id % self.snapshot_every == 0:
            for old in range(batch_id - 2 * self.snapshot_every, batch_id - self.snapshot_every):
                remove(spark, self._folder(old))

    def start(self, losses: DataFrame, checkpoint: str) -> StreamingQuery:
        """Take in all records that are there, then stop."""
        return (
            losses.writeStream.foreachBatch(self)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def state(self, spark: SparkSession) -> DataFrame:
        """State of all runs after the last micro-batch."""
        return newest(spark.read.schema(KEPT).parquet(self.path)).drop("last_step")


KEPT = f"{OUTPUT}, last_step bigint, batch int"


def newest(states: DataFrame) -> DataFrame:
    """Of each run the state of the latest micro-batch that has one."""
    rest = [c for c in states.columns if c not in ("run_id", "batch")]
    return (
        states.groupBy("run_id")
        .agg(F.max_by(F.struct(*rest), "batch").alias("s"))
        .select("run_id", "s.*")
    )


def latest(updates: DataFrame) -> DataFrame:
    """Last state of each run out of a table of updates."""
    rest: list[Any] = [c for c in updates.columns if c != "run_id"]
    return (
        updates.groupBy("run_id")
        .agg(F.max_by(F.struct(*rest), "n_steps").alias("s"))
        .select("run_id", "s.*")
    )
