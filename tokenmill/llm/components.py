"""Connected components of a table of links, by repeated contraction.

In every round each node looks at its neighbours and itself and moves to the one
that comes first in an order drawn for the round; links are renamed accordingly
and those inside a node vanish.  A link's ends stay connected, so when no link is
left each component has one name.  The order changes by round, so long chains
shrink by a constant share, and the number of rounds grows with the logarithm of
the longest.  Before each round every task replaces its own links by a spanning
forest.  Once at most ``TAIL_LINKS`` links are left, a table of fixed size, one task
names the rest instead of many more rounds over next to nothing.  Nothing is collected
but row counts.

A self-link makes its node a component of one; repeated links change nothing;
links with a null end are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.tables import small_or_shuffled
from tokenmill.staging import stage

LINK = "a bigint, b bigint"
FOREST_ROWS = 500_000
TAIL_LINKS = 20_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each node to one node of its component, with the same components."""
    names, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = place[: len(a)], place[len(a) :]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[left], root[right])
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        while not np.array_equal(jump := root[root], root):
            root = jump
        if np.array_equal(root[left], root[right]):
            break
    moved = np.flatnonzero(root != np.arange(len(names)))
    return names[moved], names[root[moved]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def made() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        links = forest(table["a"].to_numpy(), table["b"].to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in links], ["a", "b"])

    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) > FOREST_ROWS:
            yield made()
            held.clear()
    if held:
        yield made()


def renamed(names: DataFrame, moves: DataFrame) -> DataFrame:
    return names.join(moves.withColumnRenamed("a", "name"), "name", "left").select(
        "node", F.coalesce("to", "name").alias("name")
    )


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for all nodes of links ``(a, b)``; a component is its least node."""
    links = stage(links.select("a", "b").where("a is not null and b is not null"), "links")
    nodes = links.select("a").union(links.select("b")).distinct().select(F.col("a").alias("node"))
    left = stage(links.where("a <> b").mapInArrow(_forests, LINK), "links")
    names = nodes.withColumn("name", F.col("node"))
    turn = 0
    while count := left.count():
        if count <= TAIL_LINKS:
            # The forest of all links: each node that is not a root has one link, to its root.
            tail = left.coalesce(1).mapInArrow(_forests, LINK)
            moves = small_or_shuffled(tail.select("a", F.col("b").alias("to")), "moves")
            names = renamed(names, moves)
            break
        order = lambda c, turn=turn: F.xxhash64(F.col(c), F.lit(turn))
        sides = left.union(left.select("b", "a"))
        first = F.min(F.struct(order("b").alias("o"), F.col("b")))
        moves = small_or_shuffled(
            sides.groupBy("a")
            .agg(first.alias("near"))
            .select(
                "a",
                F.when(
                    F.struct(order("a").alias("o"), F.col("a").alias("b")) < F.col("near"),
                    F.col("a"),
                )
                .otherwise(F.col("near.b"))
                .alias("to"),
            ),
            "moves",
        )
        ends = moves.select(F.col("a").alias("b"), F.col("to").alias("b_to"))
        left = stage(
            left.join(moves, "a")
            .join(ends, "b")
            .select(F.col("to").alias("a"), F.col("b_to").alias("b"))
            .where("a <> b")
            .distinct()
            .mapInArrow(_forests, LINK),
            "links",
        )
        names = renamed(names, moves)
        turn += 1
    names = stage(names, "names")
    least = small_or_shuffled(
        names.groupBy("name").agg(F.min("node").alias("component")), "components"
    )
    return names.join(least, "name").select("node", "component")
