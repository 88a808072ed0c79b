"""Whitening of vectors by Chebyshev-filtered subspace iteration.

Entries become whole numbers, ``floor(1024 * c) + 100000``, so row count and sums are exact.
The leading eigenvectors of their covariance are found without ever forming it: a pass
over the table returns ``A Q`` for the covariance ``A`` and a block ``Q`` of a few columns, each
task adding up ``X'(X Q)`` over its centred rows.

A round takes the block through a Chebyshev polynomial of ``A``, by its three-term
recurrence, one pass a degree.  The polynomial stays below one between zero and the least
Ritz value and grows fast above, so it damps the unwanted spectrum.  Then follow a QR
decomposition and a Rayleigh-Ritz step, whose product with ``A`` also gives the residuals
and the first step of the next polynomial.  Rounds end when the residuals of all wanted
vectors are certified below ``tolerance`` times the largest eigenvalue, or have stopped
falling below ``stalled`` times it, which is where rounding ends them; a run that gets there in
neither way raises an error.

The driver holds blocks of dimensions times columns only; the partial sums of many tasks are
added up in groups of tasks first.

Contract: a vector that is null, empty or holds a null or non-finite entry is dropped, as is one
whose length is not the commonest (the longer of two equally common).  Entries are held within
about a million either way (2^20), so that whole numbers fit.  Repeated rows and null keys are rows of
their own.  Components are numbered from 1 by falling eigenvalue; there are as many as wanted,
or fewer if the dimensions or the variance end before: a component with less than 1e-12 of the
total variance is none.  Of each the entry of the largest size is positive.  A table with
no variance or no rows gives no rows.  Other columns are not used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.staging import stage

SCALE, SHIFT = 1024, 100_000
#: Largest size of an entry before it is scaled.
MOST = float(1 << 20)
#: Numbers of a block of rows that a task works on at once.
BLOCK_NUMBERS = 1 << 21
#: Partial sums that go to the driver as they are.
FEW_TASKS = 64
#: A component with a smaller share of the variance is none.
LEAST_SHARE = 1e-12

PARTIAL = "part int, rows bigint, total binary"


@dataclass(frozen=True)
class WhiteningSettings:
    components: int = 8
    #: Columns of the block beyond the wanted ones.
    guard: int = 24
    most_degree: int = 12
    tolerance: float = 1e-14
    stalled: float = 1e-10
    rounds: int = 200
    seed: int = 5


def whole_numbers(vector: Column) -> Column:
    """The entries as whole numbers; null if the vector has to be dropped."""
    parts = vector.cast("array<double>")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    held = lambda c: F.greatest(F.least(c, F.lit(MOST)), F.lit(-MOST))
    rounded = F.transform(parts, lambda c: (F.floor(held(c) * SCALE) + SHIFT).cast("int"))
    return F.when(F.forall(parts, finite) & (F.size(parts) > 0), rounded)


def blocks(batch: pa.RecordBatch, dims: int) -> Iterator[np.ndarray]:
    """The whole numbers of a batch as int64 matrices of bounded size."""
    numbers = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    step = max(1, BLOCK_NUMBERS // dims)
    for at in range(0, len(numbers), step):
        yield numbers[at : at + step].astype(np.int64)


def exact_squares(rows: np.ndarray) -> list[int]:
    """Sum of the squares of each row, without overflow."""
    most = int(np.abs(rows).max(initial=0))
    if most * most * rows.shape[1] < 2**63:
        return np.einsum("ij,ij->i", rows, rows).tolist()
    return (rows.astype(object) ** 2).sum(axis=1).tolist()


def leading(
    product: Callable[[np.ndarray], np.ndarray], dims: int, settings: WhiteningSettings
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues, eigenvectors as columns, and residuals of a positive semi-definite map.

    ``product(Q)`` multiplies a block by the map.  There are as many columns as wanted.
    """
    wanted = min(dims, settings.components)
    width = min(dims, settings.components + settings.guard)
    draws = np.random.Generator(np.random.PCG64(settings.seed))
    block = np.linalg.qr(draws.standard_normal((dims, width)))[0]
    image = product(block)
    best, waited = np.inf, 0
    for _ in range(settings.rounds):
        inner = block.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        residuals = np.linalg.norm(image - block * values, axis=0)[:wanted]
        worst, top = residuals.max(), max(values[0], np.finfo(float).tiny)
        waited = 0 if worst < best / 2 else waited + 1
        best = min(best, worst)
        certified = worst <= settings.tolerance * top or width == dims
        if certified or waited >= 2 and worst <= settings.stalled * top:
            return values[:wanted], block[:, :wanted], residuals
        block = np.linalg.qr(
            filtered(product, block, image, values, wanted, worst / top, settings)
        )[0]
        image = product(block)
    raise ValueError(f"residual {worst / top:.1e} of the largest eigenvalue after all rounds")


def filtered(
    product: Callable[[np.ndarray], np.ndarray],
    block: np.ndarray,
    image: np.ndarray,
    values: np.ndarray,
    wanted: int,
    open_share: float,
    settings: WhiteningSettings,
) -> np.ndarray:
    """A Chebyshev polynomial of the map times the block, small on the unwanted spectrum.

    The degree is what the least wanted value needs for its residual to reach the tolerance.
    """
    top = values[0]
    half = max(values[-1], 1e-9 * top) / 2
    growth = np.arccosh(max(values[wanted - 1] / half - 1, 1 + 1e-6))
    need = np.log(max(open_share / settings.tolerance, 2)) / growth
    degree = int(np.clip(np.ceil(need) + 1, 2, settings.most_degree))
    scale = half / max(top - half, half)
    first = scale
    before, now = block, (image - half * block) * (scale / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        after = (product(now) - half * now) * (2 * following / half) - scale * following * before
        before, now, scale = now, after, following
    return now


class Whitening:
    """The leading components of a table of vectors, and its rows projected on them."""

    def __init__(
        self,
        vectors: DataFrame,
        key: str = "vec_id",
        column: str = "embedding",
        settings: WhiteningSettings = WhiteningSettings(),
    ):
        self.settings = settings
        fit = stage(
            vectors.select(
                F.col(f"`{key}`").alias("key"), whole_numbers(F.col(f"`{column}`")).alias("x")
            ).where(F.col("x").isNotNull()),
            "whitening-numbers",
        )
        self.key = key
        lengths = fit.groupBy(F.size("x").alias("dims")).count()
        most = lengths.orderBy(F.desc("count"), F.desc("dims")).first()
        self.dims = most.dims if most else 0
        self.data = fit.where(F.size("x") == self.dims)
        self.rows, self.tasks = 0, 1
        self.sums = np.zeros(self.dims, np.int64)
        self.total = 0
        self.values, self.residuals = np.zeros((2, 0))
        self.vectors = np.zeros((self.dims, 0))
        self.identity_error = 0.0
        if most:
            self._fit()

    def _fit(self) -> None:
        self.rows, self.sums = self._added(_sums(self.dims), np.int64, (self.dims,))
        center = self._center()
        _, squares = self._added(_squares(center), np.int64, (3,))
        low, middle, high = map(int, squares)
        #: Sum of all deviations, which is the trace of the covariance times rows cubed.
        self.total = low + (middle << 40) + (high << 80)
        if not self.total:
            return

        def product(block: np.ndarray) -> np.ndarray:
            return self._added(_product(center, block), np.float64, block.shape)[1] / self.rows

        values, vectors, residuals = leading(product, self.dims, self.settings)
        own = values > LEAST_SHARE * self.trace
        vectors = vectors[:, own]
        largest = np.abs(vectors).argmax(axis=0)
        self.vectors = vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])
        self.values, self.residuals = values[own], residuals[own]
        count = len(self.values)
        _, moments = self._added(
            _moments(center, self._scaled()), np.float64, (count + 1, count)
        )
        mean = moments[0] / self.rows
        covariance = moments[1:] / self.rows - np.outer(mean, mean)
        self.identity_error = float(np.abs(covariance - np.eye(count)).max(initial=0))

    @property
    def trace(self) -> float:
        """Total variance."""
        return self.total / self.rows**3 if self.rows else 0.0

    @property
    def explained(self) -> np.ndarray:
        """Share of each component in the total variance."""
        return self.values / self.trace if self.total else self.values

    def _center(self) -> tuple[int, np.ndarray]:
        return self.rows, self.sums

    def _scaled(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)

    def _added(self, partial, kind: type, shape: tuple[int, ...]) -> tuple[int, np.ndarray]:
        """Rows and total of the partial sums of all tasks, added up in the order of the tasks."""
        parts = self.data.mapInArrow(partial, PARTIAL)
        if self.tasks > FEW_TASKS:
            groups = isqrt(self.tasks)
            parts = parts.groupBy((F.col("part") % groups).alias("group")).applyInArrow(
                _summed(kind), PARTIAL
            )
        found = sorted(parts.collect(), key=lambda r: r.part)
        self.tasks = max(self.tasks, len(found))
        total = np.zeros(shape, kind)
        for row in found:
            total += np.frombuffer(row.total, kind).reshape(shape)
        return sum(r.rows for r in found), total

    def transformed(self) -> DataFrame:
        """``key, deviation, whitened``: the sum of (rows * x - sums)^2, exact, and the projections."""
        kind = self.data.schema["key"].dataType.simpleString()
        schema = f"key {kind}, deviation decimal(38,0), whitened array<double>"
        rows = self.data.mapInArrow(_projected(self._center(), self._scaled()), schema)
        return rows.withColumnRenamed("key", self.key)

    def report(self) -> DataFrame:
        """One row per vector and component, with the figures of the whole fit."""
        shares = F.array(*(F.lit(float(v)) for v in self.explained)).cast("array<double>")
        return self.transformed().select(
            self.key,
            F.posexplode("whitened").alias("place", "whitened"),
            "deviation",
        ).select(
            self.key,
            (F.col("place") + 1).alias("component"),
            F.lit(self.rows).cast("bigint").alias("n"),
            "deviation",
            "whitened",
            F.get(shares, F.col("place")).alias("explained"),
            F.lit(self.identity_error).alias("identity_error"),
        )


def _partial(rows: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([TaskContext.get().partitionId()], pa.int32()),
            pa.array([rows], pa.int64()),
            pa.array([total.tobytes()], pa.binary()),
        ],
        names=["part", "rows", "total"],
    )


def _summed(kind: type):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        total = sum(np.frombuffer(t, kind) for t in table["total"].to_pylist())
        return pa.table(
            {
                "part": pa.array([table["part"][0].as_py()], pa.int32()),
                "rows": pa.array([sum(table["rows"].to_pylist())], pa.int64()),
                "total": pa.array([total.tobytes()], pa.binary()),
            }
        )

    return run


def _folded(dims: int, start: Callable[[], np.ndarray], step):
    """A task's function that passes on one partial sum, if the task has rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = 0, start()
        for batch in batches:
            for block in blocks(batch, dims):
                rows += len(block)
                total = total + step(block)
        if rows:
            yield _partial(rows, total)

    return run


def _sums(dims: int):
    return _folded(dims, lambda: np.zeros(dims, np.int64), lambda x: x.sum(axis=0))


def _centred(x: np.ndarray, center: tuple[int, np.ndarray]) -> np.ndarray:
    """``x - sums / rows``, rounded once."""
    rows, sums = center
    return (rows * x - sums) / rows


def _squares(center: tuple[int, np.ndarray]):
    """The sum of all deviations in three parts of 40 bits."""
    rows, sums = center

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = total = 0
        for batch in batches:
            for block in blocks(batch, len(sums)):
                count += len(block)
                total += sum(exact_squares(rows * block - sums))
        if count:
            mask = (1 << 40) - 1
            parts = [total & mask, total >> 40 & mask, total >> 80]
            yield _partial(count, np.array(parts, np.int64))

    return run


def _product(center: tuple[int, np.ndarray], block: np.ndarray):
    """``X'(X Q)`` over the centred rows of a task."""

    def step(x: np.ndarray) -> np.ndarray:
        own = _centred(x, center)
        return own.T @ (own @ block)

    return _folded(len(center[1]), lambda: np.zeros(block.shape), step)


def _moments(center: tuple[int, np.ndarray], scaled: np.ndarray):
    """Sums and products of the whitened rows of a task."""

    def step(x: np.ndarray) -> np.ndarray:
        white = _centred(x, center) @ scaled
        return np.vstack([white.sum(axis=0), white.T @ white])

    count = scaled.shape[1]
    return _folded(len(center[1]), lambda: np.zeros((count + 1, count)), step)


def _projected(center: tuple[int, np.ndarray], scaled: np.ndarray):
    rows, sums = center

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for block in blocks(batch, len(sums)):
                white = _centred(block, center) @ scaled
                offsets = np.arange(len(block) + 1, dtype=np.int32) * scaled.shape[1]
                squares = exact_squares(rows * block - sums)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(at, len(block)),
                        pa.array([Decimal(s) for s in squares], pa.decimal128(38, 0)),
                        pa.ListArray.from_arrays(offsets, pa.array(white.ravel())),
                    ],
                    names=["key", "deviation", "whitened"],
                )
                at += len(block)

    return run
