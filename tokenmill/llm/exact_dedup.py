"""Exact duplicates by two passes over a Bloom filter, so that unique texts never shuffle.

Two texts are equal when they are the same after deleting all white space of
``[\\x20\\x09-\\x0D]``; equality is decided by the SHA-256 of what is left.

First pass: every text sets two bits in a segment of a filter that its hash names.  A
segment has two planes, the bits set at least once and those set at least twice,
as counters that stop at two.  Tasks pass on each hash once per block of rows, with a
mark if it came up more than once there, and the segments are put together from these.
Equal texts set the same bits, so a repeated text always finds all its bits in the
second plane.

Second pass: rows whose bits are not all in the second plane are unique and go straight
to the result.  Only the others shuffle, first combined in their task to one row
per text, so a text that a third of all rows hold is no hot spot.

A filter has one byte per row of the table.  Only the second plane is sent to the tasks, in
slices of ``slice_segments`` segments (32 MB by default), one slice after the other, so neither
the driver nor a task ever holds more than one slice.

Contract: a null text counts as empty, and all texts without other characters are equal.
Of equal texts the row with the most code points in its original text stays, then the one
with the smallest doc_id (null last), then the first in the table.  ``kept`` is true for just
one row of a group, repeated rows included.  An empty table gives an empty table.
``deduplicated`` passes all columns through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from tokenmill.staging import stage

#: Bits of one plane of a segment.
SEGMENT_BITS = 1 << 20
#: Hashes that a task sorts at once before it passes them on.
BLOCK_ROWS = 1 << 20
#: The characters that equality does not see.
WHITE_SPACE = " \t\n\x0b\x0c\r"

PASSED_ON = "segment bigint, once binary, again binary"
PLANE = "segment bigint, plane binary"


@dataclass(frozen=True)
class FilterSettings:
    """Bits per row of a plane, and the segments that are sent to the tasks at once."""

    bits_per_row: int = 8
    slice_segments: int = 256


def squeezed(text: Column) -> Column:
    """The text without white space; null is empty."""
    held = F.coalesce(text, F.lit(""))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), WHITE_SPACE, held)


def segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    """The segment of each hash, from its upper 24 bits and the 20 bits below."""
    return ((hashes >> np.uint64(24)) % np.uint64(segments)).astype(np.int64)


def bits_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places in the segment, from mixed bits of the hash."""
    mixed = hashes * np.uint64(0x9E3779B97F4A7C15)
    mask = np.uint64(SEGMENT_BITS - 1)
    return (
        ((mixed >> np.uint64(44)) & mask).astype(np.int64),
        ((mixed >> np.uint64(20)) & mask).astype(np.int64),
    )


def _passed_on(segments: int):
    """Per block of rows and segment: the hashes met, and those met more than once."""

    def block(held: list[np.ndarray]) -> pa.RecordBatch:
        hashes, counts = np.unique(np.concatenate(held), return_counts=True)
        places = segment_of(hashes, segments)
        order = np.argsort(places, kind="stable")
        hashes, counts, places = hashes[order], counts[order], places[order]
        names, starts = np.unique(places, return_index=True)
        ends = np.append(starts[1:], len(hashes))
        parts = [(hashes[a:b], counts[a:b]) for a, b in zip(starts, ends, strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.int64()),
                pa.array([h.tobytes() for h, _ in parts], pa.binary()),
                pa.array([h[c > 1].tobytes() for h, c in parts], pa.binary()),
            ],
            names=["segment", "once", "again"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch.column("hash").to_numpy().view(np.uint64))
            rows += batch.num_rows
            if rows >= BLOCK_ROWS:
                yield block(held)
                held, rows = [], 0
        if rows:
            yield block(held)

    return run


def second_plane(parts: Iterator[tuple[bytes, bytes]]) -> np.ndarray:
    """The bits that at least two of the rows have set, from ``(once, again)`` of blocks."""
    first, second = np.zeros((2, SEGMENT_BITS), bool)
    for once, again in parts:
        own = np.zeros(SEGMENT_BITS, bool)
        for places in bits_of(np.frombuffer(once, np.uint64)):
            own[places] = True
        second |= first & own
        first |= own
        for places in bits_of(np.frombuffer(again, np.uint64)):
            second[places] = True
    return second


def _merged(key: tuple, table: pa.Table) -> pa.Table:
    rows = zip(table["once"].to_pylist(), table["again"].to_pylist(), strict=True)
    plane = np.packbits(second_plane(rows), bitorder="little").tobytes()
    return pa.table(
        {"segment": pa.array([key[0].as_py()], pa.int64()), "plane": pa.array([plane], pa.binary())}
    )


def _tested(segments: int, first: int, planes: dict[int, bytes]):
    """Add to the rows of a slice whether all bits of their hash are in the second plane."""
    names = sorted(planes)
    held = np.frombuffer(b"".join(planes[n] for n in names), np.uint8)
    place_of = np.full(max(names, default=first) - first + 2, -1, np.int64)
    place_of[np.array(names, np.int64) - first] = np.arange(len(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hash").to_numpy().view(np.uint64)
            own = np.minimum(segment_of(hashes, segments) - first, len(place_of) - 1)
            found = place_of[own]
            hit = found >= 0
            start = found[hit] * SEGMENT_BITS
            both = np.ones(len(start), bool)
            for places in bits_of(hashes[hit]):
                at = start + places
                both &= (held[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            hit[hit] = both
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(hit)], names=[*batch.schema.names, "maybe"]
            )

    return run


class ExactDedup:
    """Groups of equal texts in a table with a ``doc_id`` and a ``text``."""

    def __init__(self, docs: DataFrame, settings: FilterSettings = FilterSettings()):
        self.docs = docs
        self.settings = settings
        #: One small row per document; the texts are read once for it.
        digest = F.unhex(F.sha2(squeezed(F.col("text")).cast("binary"), 256))
        self.digests = stage(
            docs.select(
                F.monotonically_increasing_id().alias("row"),
                F.col("doc_id"),
                F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint").alias("length"),
                digest.alias("digest"),
            ).withColumn("hash", F.xxhash64("digest")),
            "exact-digests",
        )
        self.rows = self.digests.count()
        self.segments = max(1, -(-self.rows * settings.bits_per_row // SEGMENT_BITS))
        hashes = self.digests.select("hash").mapInArrow(_passed_on(self.segments), PASSED_ON)
        self.planes = stage(
            hashes.groupBy("segment").applyInArrow(_merged, PLANE), "exact-filter"
        )

    def _slices(self) -> Iterator[tuple[int, int, dict[int, bytes]]]:
        """First segment, end segment and the planes of each slice."""
        step = self.settings.slice_segments
        for first in range(0, self.segments, step):
            own = self.planes.where(F.col("segment").between(first, first + step - 1))
            yield first, first + step, {row.segment: bytes(row.plane) for row in own.collect()}

    def tested(self, hashed: DataFrame) -> DataFrame:
        """The rows of a table with a ``hash``, with ``maybe`` false for the unique ones."""
        schema = StructType([*hashed.schema.fields, StructField("maybe", BooleanType())])
        segment = F.shiftrightunsigned("hash", 24) % F.lit(self.segments)
        parts = []
        for first, end, planes in self._slices():
            own = hashed
            if self.segments > self.settings.slice_segments:
                own = hashed.where((segment >= first) & (segment < end))
            parts.append(own.mapInArrow(_tested(self.segments, first, planes), schema))
        return reduce(DataFrame.unionAll, parts)

    def report(self) -> DataFrame:
        """One row per document: ``doc_id, keep_id, group_size, kept, digest``."""
        tested = self.tested(self.digests)
        passed = tested.where(~F.col("maybe")).select(
            "doc_id",
            F.col("doc_id").alias("keep_id"),
            F.lit(1).cast("bigint").alias("group_size"),
            F.lit(True).alias("kept"),
            "digest",
        )
        repeated = tested.where("maybe")
        # Written, so that the join has a shuffle of its own and Spark can split a hot group in it.
        groups = stage(
            repeated.groupBy("digest").agg(
                F.min(_rank()).alias("best"), F.count("*").alias("group_size")
            ),
            "exact-groups",
        )
        joined = repeated.join(groups, "digest").select(
            "doc_id",
            F.col("best.doc_id").alias("keep_id"),
            "group_size",
            (F.col("row") == F.col("best.row")).alias("kept"),
            "digest",
        )
        return passed.unionAll(joined)

    def deduplicated(self) -> DataFrame:
        """The documents that stay, with all their columns.

        The rows that stay are looked up by their digest, length and doc_id only among the
        possibly repeated ones; the others pass without a shuffle.
        """
        whole = self.docs.select(
            F.struct(*(F.col(f"`{c}`") for c in self.docs.columns)).alias("document"),
            F.monotonically_increasing_id().alias("row"),
            F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint").alias("length"),
            F.unhex(F.sha2(squeezed(F.col("text")).cast("binary"), 256)).alias("digest"),
        )
        tested = self.tested(whole.withColumn("hash", F.xxhash64("digest")))
        repeated = tested.where("maybe").withColumn("doc_id", F.col("document.doc_id"))
        best = repeated.groupBy("digest").agg(F.min_by("document", _rank()).alias("document"))
        kept = tested.where(~F.col("maybe")).select("document").unionAll(best.select("document"))
        return kept.select("document.*")


def _rank() -> Column:
    """Least for the row of a group that stays."""
    return F.struct(
        (-F.col("length")).alias("shorter"),
        F.col("doc_id").isNull().alias("unnamed"),
        F.col("doc_id").alias("doc_id"),
        F.col("row").alias("row"),
    )
