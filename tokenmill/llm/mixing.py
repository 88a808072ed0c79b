"""Mix sources to target weights by balanced sampling with the cube method.

A source that is to give ``target`` words of its ``size`` takes every document
``target / size`` times: the whole part for sure, the rest with a fractional
probability.  The flight of the cube method turns the fractions into 0 or 1
without changing two totals, the words and the documents taken: as long as
three documents are open, their probabilities are moved along the direction in
which both totals stay the same, until one of them is decided.  At most two are
left open.

The flight runs in blocks of a source's documents, side by side; what blocks
leave open meets in fewer blocks, and so on, until one block holds the rest of
a source.  The ``RESERVE`` smallest open documents of a source are kept out until then: the
last documents of the others, which may be large, are drawn by their probability, a document
or a few more change sides to make up for them, and what is still missing is moved into the
probabilities of the reserve, which fly next.  The one or two that stay open are rounded, and single documents of the
reserve or pairs change sides as long as that brings the words nearer to the target.  So
a source misses its target by less than its smallest documents, if it has any to choose from.

Contract: null text has size 0; documents of size 0 are taken 0 words; the
document order does not matter; a null source is a source of its own that
sorts last; repeated rows are documents of their own; an empty table gives an
empty table.  Draws come from a hash of the seed, source and block, and blocks
from a hash of ``doc_id``, so reruns agree.  Other columns are not used.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenmill.llm.tables import BROADCAST_ROWS
from tokenmill.llm.text import blocks, word_bounds
from tokenmill.staging import stage

BLOCK_ROWS = 4096
#: Documents of a source that the landing chooses from.
RESERVE = 64
MOST_COPIES = 3
NEAR = 1e-9


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``source``, words of the text, and ``copy``: which of equal ids in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [
                np.diff(word_bounds(raw, offsets)[2])
                for _, _, raw, offsets in blocks(batch.column(2))
            ]
            ids = pd.Series(batch.column(0).to_pandas())
            copies = ids.groupby(ids, dropna=False).cumcount()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(np.concatenate([np.zeros(0, np.int64), *sizes]), pa.int64()),
                    pa.array(copies.to_numpy(np.int64)),
                ],
                ["doc_id", "source", "size", "copy"],
            )

    schema = "doc_id bigint, source string, size bigint, copy bigint"
    chosen = docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), text)
    return chosen.mapInArrow(run, schema)


def source_targets(
    sources: DataFrame, weights: Sequence[float], most: int = MOST_COPIES
) -> DataFrame:
    """Words that each source gives: all words shared by weight, at most ``most`` times its own.

    ``sources`` has a row ``(source, source_size, n_docs)`` for each source.  The
    sources in order of ``cap / weight`` are at their cap up to some place and share
    the rest beyond it, so running sums tell the level at which they stop.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    return (
        sources.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * most)
        .withColumn(
            "level",
            (
                F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
            ).cast("double")
            / F.sum("weight").over(rest),
        )
        .withColumn("full", F.col("cap") / F.col("weight") < F.col("level"))
        .withColumn("shared", F.max(F.when(~F.col("full"), F.col("level"))).over(whole))
        .withColumn(
            "target",
            F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
                F.least(F.col("weight") * F.col("shared"), F.col("cap").cast("double"))
            ),
        )
        .select("source", "source_size", "n_docs", "target")
    )


def flight(
    chances: np.ndarray, sizes: np.ndarray, land: bool, draws: np.random.Generator
) -> np.ndarray:
    """Move chances to 0 or 1, keeping their sum and the sum of chance times size.

    Rows are taken in the given order.  Without ``land`` up to two stay open.
    """
    chances = chances.astype(float).copy()
    values, weights = chances.tolist(), sizes.astype(float).tolist()
    is_open = lambda i: NEAR < values[i] < 1 - NEAR
    queue = iter([i for i in range(len(values)) if is_open(i)])
    active: list[int] = []

    def move(rows: list[int], direction: list[float]) -> None:
        up = down = np.inf
        for i, d in zip(rows, direction, strict=True):
            if d > 0:
                up, down = min(up, (1 - values[i]) / d), min(down, values[i] / d)
            elif d < 0:
                up, down = min(up, values[i] / -d), min(down, (1 - values[i]) / -d)
        step = up if draws.random() * (up + down) < down else -down
        for i, d in zip(rows, direction, strict=True):
            values[i] = min(1.0, max(0.0, values[i] + step * d))
            if not is_open(i):
                values[i] = float(round(values[i]))

    for new in queue:
        active.append(new)
        if len(active) == 3:
            a, b, c = (weights[i] for i in active)
            direction = [b - c, c - a, a - b]
            if a == b:  # two alike can always change places
                direction = [1.0, -1.0, 0.0]
            elif b == c:
                direction = [0.0, 1.0, -1.0]
            elif a == c:
                direction = [1.0, 0.0, -1.0]
            move(active, direction)
            active = [i for i in active if is_open(i)]
    if land:
        for i in active:
            values[i] = float(draws.random() < values[i])
    return np.array(values)


def landing(
    chances: np.ndarray, sizes: np.ndarray, reserve: np.ndarray, draws: np.random.Generator
) -> np.ndarray:
    """All chances as 0 or 1, with their words near what they were.

    The rows of the ``reserve`` make up for what the others miss.  Rows are taken in order.
    """
    done = chances.astype(float).copy()
    decided = (done <= NEAR) | (done >= 1 - NEAR)
    done[decided] = np.round(done[decided])
    rest = ~reserve & ~decided
    aim = float(chances[rest] @ sizes[rest])
    flown = flight(done[rest], sizes[rest], True, draws)
    done[rest] = nearer(flown, sizes[rest].astype(float), aim, pairs=False)
    rest = ~reserve
    own, open_sizes = done[reserve], sizes[reserve].astype(float)
    wanted = float(chances @ sizes) - float(done[rest] @ sizes[rest])
    expected, most = float(own @ open_sizes), float(open_sizes.sum())
    if wanted <= expected:
        own = own * (max(0.0, wanted) / expected if expected else 0.0)
    else:
        own = 1 - (1 - own) * max(0.0, most - wanted) / (most - expected)
    done[reserve] = nearer(flight(own, open_sizes, True, draws), open_sizes, wanted)
    return done


def nearer(
    taken: np.ndarray, sizes: np.ndarray, wanted: float, pairs: bool = True
) -> np.ndarray:
    """Change sides of single rows, or ``pairs`` too, as long as the words taken come nearer."""
    taken = taken.copy()
    while len(sizes):
        change = np.where(taken > 0.5, -sizes, sizes)
        off = float(taken @ sizes) - wanted
        # Two changes, where the diagonal stands for one of them alone.
        both = change[:, None] + change[None, :] if pairs else change[:, None]
        if pairs:
            np.fill_diagonal(both, change)
        at = np.unravel_index(np.abs(off + both).argmin(), both.shape)
        if abs(off + both[at]) >= abs(off) - NEAR:
            break
        for i in set(at) if pairs else at[:1]:
            taken[i] = 1 - taken[i]
    return taken


def _fly(seed: int):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        order = pc.sort_indices(
            rows,
            sort_keys=[
                ("size", "descending"),
                ("place", "ascending"),
                ("doc_id", "ascending"),
                ("copy", "ascending"),
            ],
        )
        rows = rows.take(order)
        name = f"{seed}|{key[0].as_py()}|{key[1].as_py()}|{rows['level'][0].as_py()}"
        draws = np.random.Generator(np.random.PCG64(zlib.crc32(name.encode())))
        chances, sizes = rows["chance"].to_numpy(), rows["size"].to_numpy()
        if rows["lands"][0].as_py():
            is_open = (chances > NEAR) & (chances < 1 - NEAR)
            reserve = rows["reserve"].to_numpy(zero_copy_only=False) & is_open
            chance = landing(chances, sizes, reserve, draws)
        else:
            chance = flight(chances, sizes, False, draws)
        at = rows.schema.get_field_index("chance")
        return rows.set_column(at, "chance", pa.array(chance))

    return run


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float],
    most: int = MOST_COPIES,
    seed: int = 1,
    text: str = "text",
) -> DataFrame:
    """How many words of each document the mix takes, repeats counted.

    Columns: doc_id, source, size, source_size, target, copies, taken.
    """
    sized = stage(word_counts(docs, text), "mix-sizes")
    totals = stage(
        sized.groupBy("source").agg(
            F.sum("size").alias("source_size"), F.count("*").alias("n_docs")
        ),
        "mix-sources",
    )
    targets = stage(source_targets(totals, weights, most), "mix-targets")
    known = targets.agg(F.count("*").alias("n"), F.max("n_docs").alias("most")).first()
    near = F.broadcast(targets) if known["n"] <= BROADCAST_ROWS else targets
    rate = F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))
    rows = (
        sized.alias("d")
        .join(near.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
        .select("d.*", "source_size", "n_docs", "target")
        .withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(F.lit(0.0)))
        .withColumn("sure", F.floor(F.col("rate") + NEAR).cast("long"))
        .withColumn("chance", F.greatest(F.lit(0.0), F.col("rate") - F.col("sure")))
        .drop("rate")
        .withColumn("place", F.xxhash64("doc_id", "copy", F.lit(seed)))
        .withColumn("row", F.struct("size", "place", "doc_id", "copy"))
    )
    is_open = (F.col("chance") > NEAR) & (F.col("chance") < 1 - NEAR)
    smallest = Window.partitionBy("source").orderBy("row")
    ends = stage(
        rows.where(is_open & (F.col("size") > 0))
        .select("source", "row")
        .withColumn("number", F.row_number().over(smallest))
        .where(F.col("number") <= RESERVE)
        .groupBy("source")
        .agg(F.max("row").alias("last")),
        "mix-reserves",
    )
    near = F.broadcast(ends) if known["n"] <= BROADCAST_ROWS else ends
    kept_out = is_open & (F.col("size") > 0) & (F.col("row") <= F.col("last"))
    rows = (
        rows.alias("r")
        .join(near.alias("e"), F.col("r.source").eqNullSafe(F.col("e.source")), "left")
        .select("r.*", F.coalesce(kept_out, F.lit(False)).alias("reserve"))
        .drop("row")
    )
    reserve = rows.where("reserve")
    done = []
    left, most_left, level = rows.where("not reserve"), known["most"] or 0, 0
    count: Column = F.col("n_docs")
    while True:
        number = F.ceil(count / BLOCK_ROWS)
        lands = number <= 1
        joining, reserve = reserve.where(lands), reserve.where(~lands)
        part = (
            left.unionByName(joining)
            .withColumn("lands", lands)
            .withColumn("level", F.lit(level))
            .withColumn("block", F.pmod(F.xxhash64("place", F.lit(level)), number))
        )
        flown = stage(
            part.groupBy("source", "block").applyInArrow(_fly(seed), part.schema), "mix-flight"
        )
        done.append(flown.where(~is_open))
        if most_left <= BLOCK_ROWS:
            break
        left = flown.where(is_open).drop("lands", "level", "block")
        count, most_left, level = number * 2, -(-most_left // BLOCK_ROWS) * 2, level + 1
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    copies = F.col("sure") + F.round("chance").cast("long")
    return whole.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )
