"""Near-duplicate vectors by sorted projection passes.

In each pass every vector gets 64 hash bits, the signs of its products with random
directions, and all vectors are ordered lexicographically by label and bits.  Close
vectors agree in most bits and so come near one another in some pass.  Each
vector is compared with the next ``window`` vectors in the order; pairs with a
cosine of at least ``least`` are links.  The links of all passes are put together
and their connected components found.

Before they are projected, unit vectors are centred by the mean of their label, without which
the bits of a dense label say little.  The number of passes is found for each label from a
bounded hash sample of ``crowd`` of its vectors: from the angles in the sample follows how many
bits it takes until no more than half a window of other vectors are expected to agree with
one, and how likely a partner at the least cosine agrees in these bits.  The passes are so
many that this partner is missed with a probability of at most ``miss``, for the sampled vector
it is worst for.

Equal vectors are one class and go through the passes once.  Tasks pass on a
spanning forest of the links they find, so large groups of near copies cost one
link per vector.  How many vectors each one links with is counted afterwards
inside the components, all pairs of a component in blocks of bounded size, so
the bounded windows cut no count.

Contract: cosine in double precision; only vectors of equal label and length are
compared; a null label, a null vector, a zero vector and one with null or
non-finite components link with nothing and are their own component.  Repeated rows
link like any equal vectors.  ``kept`` is false for a null ``vec_id``.  Other columns are not used.  An empty table gives an
empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import FloatType, StructType

from tokenmill.llm.components import components, forest
from tokenmill.llm.tables import partitions, small_or_shuffled
from tokenmill.staging import stage

BITS = 64
#: Rows of a sorted partition at least, in windows.
WINDOWS_PER_TASK = 20
#: Rows of a component that are compared with one another at once.
BLOCK_ROWS = 1024
SORTED = "label bigint, dims int, pass int, place bigint, node bigint, vector array<{kind}>"
#: Numbers of the means of all labels that are sent to all tasks.
MEANS_SENT = 1_000_000
SHAPE = "label bigint, dims int, rows bigint, passes int, mean array<double>"


@dataclass(frozen=True)
class PassSettings:
    least: float = 0.93
    window: int = 48
    miss: float = 0.001
    #: Vectors of a label that its passes are found from.
    crowd: int = 1000
    seed: int = 11


def passes_for(
    sample: np.ndarray, mean: np.ndarray, rows: int, settings: PassSettings
) -> int:
    """Passes after which a pair at the least cosine is missed by chance ``miss``.

    ``sample`` holds unit vectors of a label of ``rows`` vectors with the given mean.
    """
    centred = sample - mean
    lengths = np.maximum(np.sqrt((centred * centred).sum(axis=1)), 1e-12)
    angles = (centred @ centred.T) / np.outer(lengths, lengths)
    agree = 1 - np.arccos(np.clip(angles, -1, 1)) / np.pi
    # Those that link anyway do not stand in the way of a partner.
    agree[sample @ sample.T >= settings.least] = 0
    others = max(rows - 1, 0) / max(len(sample) - 1, 1)
    # A partner of the same product with the mean.
    partner = (settings.least - 1) / lengths**2 + 1
    near = 1 - np.arccos(np.clip(partner, -1, 1)) / np.pi
    found = np.full(len(sample), 1 - 1e-9)
    power = np.ones_like(agree)
    open_rows = (agree > 0).sum(axis=1) * others > settings.window / 2
    for bits in range(1, BITS + 1):
        if not open_rows.any():
            break
        power *= agree
        found[open_rows] = near[open_rows] ** bits
        open_rows &= power.sum(axis=1) * others > settings.window / 2
    worst = min(max(float(found.min(initial=1 - 1e-9)), 1e-4), 1 - 1e-9)
    return max(4, math.ceil(math.log(settings.miss) / math.log1p(-worst)))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors of a column, all of length ``dims``, with unit length in double precision."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = values.reshape(len(column), dims)
    rows = rows / np.abs(rows).max(axis=1, initial=0)[:, None]
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def kind_of(vectors: DataFrame) -> str:
    """Floats stay floats, all else is taken as doubles; cosines are those of doubles."""
    element = vectors.schema["embedding"].dataType.elementType
    return "float" if isinstance(element, FloatType) else "double"


def usable(vectors: DataFrame) -> DataFrame:
    """The rows that can link, with ``row`` as their number."""
    parts = F.col("embedding")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return (
        vectors.select(
            F.monotonically_increasing_id().alias("row"),
            "vec_id",
            F.col("label").cast("bigint"),
            parts.cast(f"array<{kind_of(vectors)}>").alias("vector"),
            F.size(parts).alias("dims"),
        )
        .withColumn(
            "fit",
            F.col("label").isNotNull()
            & F.coalesce(
                F.forall("vector", finite) & F.exists("vector", lambda x: x != 0), F.lit(False)
            ),
        )
        .withColumn("one", F.xxhash64("vector"))
        .withColumn("two", F.xxhash64(F.lit(1), "vector"))
    )


def _groups(table: pa.Table) -> Iterator[tuple[int, int, pa.Table]]:
    """The rows of each label and length."""
    pairs = set(zip(table["label"].to_pylist(), table["dims"].to_pylist(), strict=True))
    for label, dims in sorted(pairs):
        same = pa.compute.and_(
            pa.compute.equal(table["label"], label), pa.compute.equal(table["dims"], dims)
        )
        yield label, dims, table.filter(same).combine_chunks()


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and sum of the unit vectors of each label and length in a task."""
    found: dict[tuple[int, int], list] = {}
    for batch in batches:
        for label, dims, own in _groups(pa.Table.from_batches([batch])):
            held = found.setdefault((label, dims), [0, np.zeros(dims)])
            held[0] += len(own)
            held[1] += matrix(own["vector"].combine_chunks(), dims).sum(axis=0)
    if found:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([label for label, _ in found], pa.int64()),
                pa.array([dims for _, dims in found], pa.int32()),
                pa.array([rows for rows, _ in found.values()], pa.int64()),
                pa.array([list(total) for _, total in found.values()], pa.list_(pa.float64())),
            ],
            names=["label", "dims", "rows", "total"],
        )


def _shaped(settings: PassSettings):
    """Rows, passes and mean of a label and length from partial sums and sampled vectors."""

    def run(key: tuple, sums: pa.Table, sampled: pa.Table) -> pa.Table:
        rows = sum(sums["rows"].to_pylist())
        dims = key[1].as_py()
        total = sums["total"].combine_chunks().flatten().to_numpy().reshape(-1, dims)
        mean = total.sum(axis=0) / rows
        sampled = sampled.take(pa.compute.sort_indices(sampled["draw"])[: settings.crowd])
        vectors = sampled["vector"].combine_chunks()
        sample = matrix(vectors, dims) if len(vectors) else np.zeros((0, dims))
        return pa.table(
            {
                "label": pa.array([key[0].as_py()], pa.int64()),
                "dims": pa.array([dims], pa.int32()),
                "rows": pa.array([rows], pa.int64()),
                "passes": pa.array([passes_for(sample, mean, rows, settings)], pa.int32()),
                "mean": pa.array([list(mean)], pa.list_(pa.float64())),
            }
        )

    return run


def _projected(settings: PassSettings):
    """Each vector once per pass of its label, with its bits as a place in the order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, dims, own in _groups(pa.Table.from_batches([batch])):
                rows = matrix(own["vector"].combine_chunks(), dims)
                rows = rows - np.array(own["mean"][0].as_py())
                for turn in range(own["passes"][0].as_py()):
                    draws = np.random.Generator(np.random.PCG64([settings.seed, turn, dims]))
                    bits = rows @ draws.standard_normal((dims, BITS)) > 0
                    packed = np.packbits(bits, axis=1).copy().view(">u8")[:, 0].astype(np.uint64)
                    place = (packed ^ np.uint64(1 << 63)).view(np.int64)
                    yield from pa.table(
                        {
                            "label": own["label"],
                            "dims": own["dims"],
                            "pass": pa.array(np.full(len(rows), turn, np.int32)),
                            "place": pa.array(place),
                            "node": own["node"],
                            "vector": own["vector"],
                        }
                    ).to_batches()

    return run


def window_links(
    group: np.ndarray, nodes: np.ndarray, rows: np.ndarray, settings: PassSettings
) -> tuple[np.ndarray, np.ndarray]:
    """Links of each row with the next ``window`` rows of its group, in the given order."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for step in range(1, min(settings.window, len(nodes) - 1) + 1):
        near = np.flatnonzero(group[step:] == group[:-step])
        if not len(near):
            break
        cosine = np.einsum("ij,ij->i", rows[near], rows[near + step])
        hit = near[cosine >= settings.least]
        found.append((nodes[hit], nodes[hit + step]))
    return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def _compared(settings: PassSettings, schema: pa.Schema):
    """Links inside a sorted partition, and the rows at its two ends.

    Rows of kind 0 are links.  Kind 1 are rows at the end of partition ``border``,
    kind 2 those at the start of partition ``border + 1``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        carry: pa.Table | None = None
        head: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if head is None or len(head) < settings.window:
                more = table.slice(0, settings.window - (len(head) if head else 0))
                head = pa.concat_tables([head, more]) if head else more
            if carry is not None:
                table = pa.concat_tables([carry, table])
            for dims in sorted(set(table["dims"].to_pylist())):
                own = table.filter(pa.compute.equal(table["dims"], dims)).combine_chunks()
                keys = [own[name].to_numpy() for name in ("pass", "label")]
                change = np.zeros(len(own), bool)
                for key in keys:
                    change[1:] |= key[1:] != key[:-1]
                links = window_links(
                    np.cumsum(change),
                    own["node"].to_numpy(),
                    matrix(own["vector"].combine_chunks(), dims),
                    settings,
                )
                yield _linked(*forest(*links), schema)
            carry = table.slice(max(0, len(table) - settings.window))
        if carry is not None:
            yield _border(carry, 1, part, schema)
            yield _border(head, 2, part - 1, schema)

    return run


def border_schema(kind: str) -> StructType:
    ends = StructType.fromDDL("kind int, border int, a bigint, b bigint")
    return StructType([*ends, *StructType.fromDDL(SORTED.format(kind=kind))])


def _filled(columns: dict[str, pa.Array], count: int, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [columns.get(f.name, pa.nulls(count, f.type)) for f in schema], schema=schema
    )


def _linked(a: np.ndarray, b: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    kinds = pa.array(np.zeros(len(a), np.int32))
    found = {"kind": kinds, "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}
    return _filled(found, len(a), schema)


def _border(rows: pa.Table, kind: int, border: int, schema: pa.Schema) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    named = {
        name: (rows[name].chunk(0) if rows[name].num_chunks else pa.nulls(0, rows[name].type)).cast(
            schema.field(name).type
        )
        for name in rows.column_names
    }
    ends = {
        "kind": pa.array(np.full(len(rows), kind, np.int32)),
        "border": pa.array(np.full(len(rows), border, np.int32)),
    }
    return _filled(named | ends, len(rows), schema)


def _across(settings: PassSettings):
    """Links across one border, from the rows on both sides of it."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        order = pa.compute.sort_indices(
            rows, sort_keys=[(k, "ascending") for k in ("pass", "label", "dims", "place", "node")]
        )
        rows = rows.take(order)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for dims in sorted(set(rows["dims"].to_pylist())):
            own = rows.filter(pa.compute.equal(rows["dims"], dims)).combine_chunks()
            change = np.zeros(len(own), bool)
            for name in ("pass", "label"):
                values = own[name].to_numpy()
                change[1:] |= values[1:] != values[:-1]
            vectors = matrix(own["vector"].combine_chunks(), dims)
            found.append(
                window_links(np.cumsum(change), own["node"].to_numpy(), vectors, settings)
            )
        a, b = (np.concatenate(side) for side in zip(*found, strict=True))
        return pa.table(dict(zip("ab", map(pa.array, forest(a, b)), strict=True)))

    return run


def _counted(least: float):
    """In a bin: for each row how many vectors of its component on the other side link with it.

    ``side`` 0 rows are compared with one another, or with those of side 1 if there are any.
    """

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        component = rows["component"].to_numpy()
        side = rows["side"].to_numpy()
        size = rows["size"].to_numpy()
        dims = rows["dims"].to_numpy()
        links = np.zeros(len(rows), np.int64)
        order = np.lexsort((side, component))
        edges = np.flatnonzero(np.diff(component[order], prepend=component[order[0]] - 1))
        for start, end in zip(edges, [*edges[1:], len(order)], strict=True):
            own = order[start:end]
            vectors = matrix(rows["vector"].take(pa.array(own)).combine_chunks(), dims[own[0]])
            left, right = side[own] == 0, side[own] == 1
            if not right.any():
                near = vectors @ vectors.T >= least
                np.fill_diagonal(near, False)
                links[own] = near @ size[own]
            else:
                near = vectors[left] @ vectors[right].T >= least
                links[own[left]] = near @ size[own[right]]
                links[own[right]] = size[own[left]] @ near
        return pa.table({"node": rows["node"], "links": pa.array(links)})

    return run


class VectorDedup:
    """Links and components of one table ``(vec_id, embedding, label)``."""

    def __init__(self, vectors: DataFrame, settings: PassSettings | None = None):
        self.settings = settings or PassSettings()
        self.spark = vectors.sparkSession
        self.kind = kind_of(vectors)
        self.rows = stage(usable(vectors), "vectors")
        self.classes = stage(
            self.rows.where("fit")
            .groupBy("label", "dims", "one", "two")
            .agg(
                F.min("row").alias("node"),
                F.min("vec_id").alias("least"),
                F.count("*").alias("size"),
                F.min_by("vector", "row").alias("vector"),
            ),
            "vector-classes",
        )

    def shapes(self) -> DataFrame:
        """``(label, dims, rows, passes, mean)`` of each label and length; one row each."""
        sums = self.classes.select("label", "dims", "vector").mapInArrow(
            _summed, "label bigint, dims int, rows bigint, total array<double>"
        )
        drawn = Window.partitionBy("label", "dims").orderBy("draw", "node")
        sampled = (
            self.classes.select("label", "dims", "node", "vector", F.xxhash64("node").alias("draw"))
            .withColumn("number", F.row_number().over(drawn))
            .where(F.col("number") <= self.settings.crowd)
            .select("label", "dims", "draw", "vector")
        )
        shapes = (
            sums.groupBy("label", "dims")
            .cogroup(sampled.groupBy("label", "dims"))
            .applyInArrow(_shaped(self.settings), SHAPE)
        )
        shapes = stage(shapes, "vector-shapes")
        numbers = shapes.agg(F.sum("dims")).first()[0] or 0
        return F.broadcast(shapes) if numbers <= MEANS_SENT else shapes

    def links(self) -> DataFrame:
        """Verified links ``(a, b)`` between classes, as spanning forests of what was found."""
        fields = SORTED.format(kind=self.kind)
        shapes = self.shapes()
        rows = shapes.agg(F.sum(F.col("rows") * F.col("passes"))).first()[0] or 0
        tasks = max(1, min(2 * partitions(self.spark), rows // (WINDOWS_PER_TASK * self.settings.window)))
        projected = (
            self.classes.select("label", "dims", "node", "vector")
            .join(shapes, ["label", "dims"])
            .mapInArrow(_projected(self.settings), fields)
            .repartitionByRange(tasks, "pass", "label", "dims", "place", "node")
            .sortWithinPartitions("pass", "label", "dims", "place", "node")
        )
        schema = border_schema(self.kind)
        compared = _compared(self.settings, to_arrow_schema(schema))
        found = stage(projected.mapInArrow(compared, schema), "vector-links")
        across = (
            found.where("kind > 0")
            .select("border", *[f.split()[0] for f in fields.split(", ")])
            .groupBy("border")
            .applyInArrow(_across(self.settings), "a bigint, b bigint")
        )
        return found.where("kind = 0").select("a", "b").unionByName(across)

    def counts(self, named: DataFrame) -> DataFrame:
        """``(node, links)``: rows that each class links with inside its component."""
        sizes = named.groupBy("component").agg(F.count("*").alias("members"))
        rows = (
            self.classes.join(named, "node")
            .join(small_or_shuffled(sizes.where("members > 1"), "component-sizes"), "component")
            .withColumn("blocks", F.ceil(F.col("members") / BLOCK_ROWS))
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        )
        bins = max(partitions(self.spark), 1)
        small = rows.where("blocks = 1").select(
            F.lit(0).cast("bigint").alias("group"),
            F.pmod(F.xxhash64("component"), F.lit(bins)).alias("first"),
            F.lit(0).cast("bigint").alias("second"),
            F.lit(0).alias("side"),
            "component", "node", "size", "dims", "vector",
        )
        # A block meets itself and each other block of its component once.
        other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
        large = (
            rows.where("blocks > 1")
            .withColumn("other", other)
            .select(
                F.col("component").alias("group"),
                F.least("block", "other").alias("first"),
                F.greatest("block", "other").alias("second"),
                (F.col("block") > F.col("other")).cast("int").alias("side"),
                "component", "node", "size", "dims", "vector",
            )
        )
        counted = (
            small.unionByName(large)
            .groupBy("group", "first", "second")
            .applyInArrow(_counted(self.settings.least), "node bigint, links bigint")
        )
        return counted.groupBy("node").agg(F.sum("links").alias("links"))

    def report(self) -> DataFrame:
        """For every row: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
        named = stage(components(self.links()), "vector-components")
        classes = self.classes.drop("vector").join(named, "node", "left").withColumn(
            "component", F.coalesce("component", "node")
        )
        least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
        found = small_or_shuffled(
            classes.join(least, "component")
            .join(self.counts(named), "node", "left")
            .select(
                "label",
                "dims",
                "one",
                "two",
                "component_id",
                (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"),
            ),
            "vector-groups",
        )
        component = F.when(F.col("fit"), F.col("component_id")).otherwise(F.col("vec_id"))
        links = F.when(F.col("fit"), F.col("links")).otherwise(0)
        return (
            self.rows.drop("vector", "row")
            .join(found, ["label", "dims", "one", "two"], "left")
            .select(
                "vec_id",
                F.coalesce(links, F.lit(0)).cast("bigint").alias("n_links"),
                F.coalesce(component, F.col("vec_id")).cast("bigint").alias("component_id"),
            )
            .withColumn(
                "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
            )
        )
