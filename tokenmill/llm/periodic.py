"""Periodic runs of words in texts, found in tiles per octave of periods.

A run is a stretch of consecutive words with smallest period q and a length of at least
``max(least_words, least_powers * q)`` that no neighbouring word extends with that period.

Periods go in octaves: 1 to 7, then 8 to 15, 16 to 31 and so on.  In an octave of periods
from P, boundaries stand every ``max(16, 2 P)`` words.  The words that equal the word q later
form a stretch; one that belongs to a run is long enough to hold a boundary.  So a run of
period q shows at a boundary b as a pair of extensions: how far the words from b equal those
from b + q, the Z-function of the suffix at the boundary, and how far the words before b equal
those before b + q, the Z-function of the reversed prefix.  Both are cut at the next boundary.
The first of them also says which q are multiples of a smaller period, and those are left out.
Only boundaries at which eight words come back at a distance of the octave are solved.

Documents are exploded into tiles per octave, each some boundaries and the words their
extensions can reach, so tiles are solved independently.  The tiles of a document with more than
``spread_words`` words are rows dealt out to all tasks; those of the others are solved
where the document was read.  What tiles pass on are fragments ``(document, period, from,
to)`` of stretches, touching ones of a document joined first.  They are shuffled by document
and period and stitched to whole stretches, whose runs are then joined with their document.
Documents in which no eight words come back, most of them, hold no run and never shuffle.

Words are compared by their number in the document, which is exact.

A text crosses to Python once in each pass, beside the columns that the result needs, and is
handled about a megabyte at a time, so that neither side holds copies of a whole batch.

Contract: words are runs of ``[^\\x20\\x09-\\x0D]``; a null text has none.  Repeated rows and
rows with equal or null keys are documents of their own.  An empty table gives an empty table.
``report`` and ``collapsed`` take tables with any further columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tokenmill.llm.text import word_bounds
from tokenmill.operators.encode import sliced
from tokenmill.staging import stage

#: Words that have to come back before a boundary is solved: less than half of what a
#: stretch of a run holds, which is 16 words at least.
GRAM = 8
NARROWEST = 16
#: Comparisons of a tile, which bounds the memory of solving it.
TILE_COMPARISONS = 1 << 21

#: Texts of more bytes are handled as arrays.
LONG_BYTES = 1 << 20

RUNS = ArrayType(StructType([StructField(n, LongType()) for n in ("start", "length", "period")]))


@dataclass(frozen=True)
class RunSettings:
    least_words: int = 24
    least_powers: int = 3
    #: Longer documents have their tiles dealt out.
    spread_words: int = 1 << 18

    def __post_init__(self) -> None:
        if self.least_words < 24 or self.least_powers < 3:
            raise ValueError("boundaries are spaced for runs of 24 words and three periods at least")


@dataclass(frozen=True)
class Octave:
    """Periods from ``low`` to below ``high`` and the distance of the boundaries."""

    low: int
    high: int

    @property
    def spacing(self) -> int:
        return max(NARROWEST, 2 * self.low)

    @property
    def reach(self) -> int:
        """Words that an extension from a boundary can read."""
        return self.spacing + self.high


def octaves(words: int, powers: int) -> Iterator[Octave]:
    low, high = 1, 8
    while low * powers <= words:
        yield Octave(low, min(high, words // powers + 1))
        low, high = high, 2 * high


def tiles(words: int, octave: Octave) -> Iterator[tuple[int, int, int]]:
    """Tiles as first boundary, number of boundaries and first word."""
    boundaries = -(-words // octave.spacing)
    step = max(1, TILE_COMPARISONS // (octave.high - octave.low))
    for first in range(0, boundaries, step):
        at = first * octave.spacing
        yield at, min(step, boundaries - first), max(0, at - octave.spacing)


def z_function(values: list[int]) -> list[int]:
    """For each place, how many values from there on equal those from the start."""
    size = len(values)
    found = [0] * size
    found[0] = size
    left = right = 0
    for at in range(1, size):
        length = min(right - at, found[at - left]) if at < right else 0
        while at + length < size and values[length] == values[at + length]:
            length += 1
        if at + length > right:
            left, right = at, at + length
        found[at] = length
    return found


def primitive(ahead: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """Whether the first q words are no power of a shorter text, from the Z-function there."""
    covered = np.maximum.accumulate(np.arange(1, len(ahead)) + ahead[1:])
    shortest = np.searchsorted(covered, periods) + 1
    return (shortest >= periods) | (periods % shortest != 0)


def grams(codes: np.ndarray) -> np.ndarray:
    """A number for each run of ``GRAM`` words, equal where the words are."""
    with np.errstate(over="ignore"):
        found, width = codes, 1
        while width < GRAM:
            found = found[: max(0, len(found) - width)] * np.uint64(0x9E3779B97F4A7C15) ^ (
                found[width:] + np.uint64(width)
            )
            found = found ^ (found >> np.uint64(31))
            width *= 2
    return found


def comes_back(codes: np.ndarray) -> bool:
    """Whether any eight words come up twice; else the text holds no fragment."""
    marks = np.sort(grams(codes))
    return bool((marks[1:] == marks[:-1]).any())


def least_distance(marks: np.ndarray) -> int:
    """Least distance of equal marks, below which there is no period; some are equal."""
    order = np.argsort(marks, kind="stable")
    same = marks[order[1:]] == marks[order[:-1]]
    return int((order[1:] - order[:-1])[same].min())


def solve(
    codes: np.ndarray, marks: np.ndarray, first: int, count: int, octave: Octave
) -> Iterator[tuple[int, int, int]]:
    """Fragments ``(period, from, to)`` at the boundaries of a tile.

    ``codes`` are the words of the tile, ``marks`` their grams and ``first`` the place of the
    first boundary in it.
    """
    spacing, periods = octave.spacing, np.arange(octave.low, octave.high)
    starts = first + spacing * np.arange(count)
    seen = np.zeros((count, len(periods)), bool)
    for shift in (0, -GRAM):
        fit = starts[(starts + shift >= 0) & (starts + shift + octave.low < len(marks))]
        if not len(fit):
            continue
        places = (fit + shift)[:, None] + periods
        inside = places < len(marks)
        same = marks[np.where(inside, places, 0)] == marks[fit + shift][:, None]
        seen[(fit - first) // spacing] |= same & inside
    for row in np.flatnonzero(seen.any(axis=1)):
        start = int(starts[row])
        own = periods[seen[row]]
        ahead = np.array(z_function(codes[start : start + octave.reach].tolist()))
        own = own[own < len(ahead)]  # else the stretch ends before the boundary
        own = own[primitive(ahead, own)]
        if not len(own):
            continue
        behind = _backwards(codes, start, spacing, octave.high)
        right = np.minimum(ahead[own], spacing)
        left = np.minimum(behind[own], spacing)
        least = np.maximum(2 * own, NARROWEST)
        kept = (right + left >= least) | (right >= spacing) | (left >= spacing)
        for q, a, b in zip(own[kept], left[kept], right[kept], strict=True):
            yield int(q), start - int(a), start + int(b)


def _backwards(codes: np.ndarray, start: int, spacing: int, high: int) -> np.ndarray:
    """For each period, how many words before the boundary equal those before it plus the period."""
    before = codes[max(0, start - spacing) : start][::-1]
    after = codes[start : start + high][::-1]
    found = np.zeros(high + 1, np.int64)
    if len(before):
        window = np.concatenate([before, [np.uint64(2**64 - 1)], after, before])
        ahead = np.array(z_function(window.tolist()))
        # Place start + q - 1 is followed, going back, by the words before it.
        periods = np.arange(1, len(after) + 1)
        found[1 : len(after) + 1] = np.minimum(
            ahead[len(before) + 1 + len(after) - periods], len(before)
        )
    return found


def joined(pieces: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Touching fragments of a period as one."""
    whole: list[tuple[int, int, int]] = []
    for period, start, end in sorted(pieces):
        if whole and whole[-1][0] == period and start <= whole[-1][2]:
            whole[-1] = (period, whole[-1][1], max(end, whole[-1][2]))
        else:
            whole.append((period, start, end))
    return whole


def fragments(codes: np.ndarray, settings: RunSettings) -> list[tuple[int, int, int]]:
    """Joined fragments of a document, all its tiles solved here."""
    if len(codes) < settings.least_words or not comes_back(codes):
        return []
    marks = grams(codes)
    least = least_distance(marks)
    found: list[tuple[int, int, int]] = []
    for octave in octaves(len(codes), settings.least_powers):
        if octave.high <= least:
            continue
        for first, count, _ in tiles(len(codes), octave):
            found.extend(solve(codes, marks, first, count, octave))
    return joined(found)


def kept_words(words: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """For each word, whether no run has it after its first period."""
    change = np.zeros(words + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


class Words:
    """The words of a text, and numbers that are equal for equal words."""

    def __init__(self, raw: bytes):
        self.words = raw.split()  # of bytes, splits at the white space of the contract

    def __len__(self) -> int:
        return len(self.words)

    def codes(self) -> np.ndarray:
        seen: dict[bytes, int] = {}
        numbers = (seen.setdefault(word, len(seen)) for word in self.words)
        return np.fromiter(numbers, np.uint64, len(self.words))

    def without(self, runs: list[tuple[int, int, int]]) -> str:
        """The words that no run has after its first period, joined by one space."""
        words = self.words
        if runs:
            words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs)).tolist()]
        return b" ".join(words).decode()


class LongWords:
    """The same of a long text, without an object for each word."""

    def __init__(self, raw: bytes):
        self.raw = np.frombuffer(raw, np.uint8)
        self.starts, self.ends, _ = word_bounds(self.raw, np.array([0, len(self.raw)]))

    def __len__(self) -> int:
        return len(self.starts)

    def codes(self) -> np.ndarray:
        inside = np.zeros(len(self.raw) + 1, np.int8)
        inside[self.starts] = 1
        inside[self.ends] = -1
        letters = self.raw[np.cumsum(inside[:-1], dtype=np.int8) > 0]
        offsets = np.concatenate([[0], np.cumsum(self.ends - self.starts)])
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(),
            len(self.starts),
            [None, pa.py_buffer(offsets), pa.py_buffer(letters)],
        )
        return pc.dictionary_encode(words).indices.to_numpy().astype(np.uint64)

    def without(self, runs: list[tuple[int, int, int]]) -> str:
        kept = kept_words(len(self), runs)
        mask = np.zeros(len(self.raw) + 1, np.int8)
        mask[self.starts[kept]] += 1
        # A word takes the white space behind it along, which becomes the one space.
        mask[np.minimum(self.ends[kept] + 1, len(self.raw))] -= 1
        letters = self.raw[np.cumsum(mask[:-1], dtype=np.int8) > 0].copy()
        letters[(letters >= 9) & (letters <= 13)] = 32
        return letters.tobytes().removesuffix(b" ").decode()


def words_of(text: str | None) -> Words | LongWords:
    raw = (text or "").encode()
    return LongWords(raw) if len(raw) > LONG_BYTES else Words(raw)


def is_plain(words: Words | LongWords, settings: RunSettings) -> bool:
    """Whether a text can hold no run because no eight words come back in it."""
    return len(words) < settings.least_words or not comes_back(words.codes())


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with a ``text`` in stretches of about a megabyte of it."""
    for batch in batches:
        yield from sliced(batch, "text")


# Rows that the first pass over the documents gives, by ``kind``.
FRAGMENT, TILE, DOCUMENT = range(3)
INNER = (
    "kind int, row bigint, period bigint, lo bigint, hi bigint, "
    "low bigint, high bigint, first bigint, count bigint, start bigint, codes binary"
)
INNER_NAMES = [part.split()[0] for part in INNER.split(", ")]


def _inner(kind: int, row: int, **values) -> dict:
    return dict.fromkeys(INNER_NAMES) | {"kind": kind, "row": row} | values


def _fragment(row: int, period: int, start: int, end: int) -> dict:
    return _inner(FRAGMENT, row, period=period, lo=start, hi=end)


def _tile_rows(row: int, codes: np.ndarray, settings: RunSettings) -> Iterator[dict]:
    narrow = codes.astype(np.uint32)
    for octave in octaves(len(codes), settings.least_powers):
        for first, count, start in tiles(len(codes), octave):
            end = first + (count - 1) * octave.spacing + octave.reach
            yield _inner(
                TILE, row, low=octave.low, high=octave.high, first=first, count=count,
                start=start, codes=narrow[start:end].tobytes(),
            )


def _first_pass(settings: RunSettings, kinds: pa.DataType):
    """Fragments of documents, tiles of long ones, and the documents that are not plain."""
    schema = pa.schema(
        [("kind", pa.int32())]
        + [(n, pa.int64()) for n in INNER_NAMES[1:-1]]
        + [("codes", pa.binary())]
    )

    def batch_of(rows: list[dict], documents: list[pa.Array] | None = None) -> pa.RecordBatch:
        columns = pa.RecordBatch.from_pylist(rows, schema).columns
        held = documents or [pa.nulls(len(rows), pa.string()), pa.nulls(len(rows), kinds)]
        return pa.RecordBatch.from_arrays(
            [*columns, *held], names=[*INNER_NAMES, "text", "document"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            found, places = [], []
            numbers = batch.column("row").to_pylist()
            for place, text in enumerate(batch.column("text")):
                row, words = numbers[place], words_of(text.as_py())
                if is_plain(words, settings):
                    continue
                places.append(place)
                if len(words) > settings.spread_words:
                    for tile in _tile_rows(row, words.codes(), settings):
                        yield batch_of([tile])
                    continue
                pieces = fragments(words.codes(), settings)
                found.extend(_fragment(row, *piece) for piece in pieces)
            if found:
                yield batch_of(found)
            if places:
                own = batch.select(["text", "document"]).take(pa.array(places)).columns
                yield batch_of([_inner(DOCUMENT, numbers[p]) for p in places], own)

    return run


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The joined fragments of tiles."""
    for batch in batches:
        for tile in batch.to_pylist():
            codes = np.frombuffer(tile["codes"], np.uint32).astype(np.uint64)
            octave = Octave(tile["low"], tile["high"])
            pieces = solve(
                codes, grams(codes), tile["first"] - tile["start"], tile["count"], octave
            )
            own = np.array(joined(list(pieces)), np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(own), tile["row"], np.int64)),
                    pa.array(own[:, 0]),
                    pa.array(own[:, 1] + tile["start"]),
                    pa.array(own[:, 2] + tile["start"]),
                ],
                names=["row", "period", "lo", "hi"],
            )


def _without_runs(settings: RunSettings):
    """The documents that the first pass gave no row for, with their words joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            places, counts, texts = [], [], []
            for place, text in enumerate(batch.column("text")):
                words = words_of(text.as_py())
                if not is_plain(words, settings):
                    continue
                places.append(place)
                counts.append(len(words))
                texts.append(words.without([]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("document").take(pa.array(places, pa.int64())),
                    pa.array(counts, pa.int64()),
                    pa.array(texts, pa.string()),
                ],
                names=["document", "n_words", "collapsed"],
            )

    return run


def _with_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents next to their runs, with the words that stay joined."""
    for batch in parts(batches):
        counts, texts = [], []
        for text, runs in zip(batch.column("text"), batch.column("runs"), strict=True):
            words = words_of(text.as_py())
            own = [(r["start"], r["length"], r["period"]) for r in runs.as_py()]
            counts.append(len(words))
            texts.append(words.without(own))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("document"),
                pa.array(counts, pa.int64()),
                pa.array(texts, pa.string()),
                batch.column("runs"),
            ],
            names=["document", "n_words", "collapsed", "runs"],
        )


class PeriodicRuns:
    """The runs of every text of a table with a ``text``."""

    def __init__(self, docs: DataFrame, settings: RunSettings = RunSettings()):
        self.docs = docs
        self.settings = settings

    def _whole(self, kept: list[str]) -> DataFrame:
        """The texts with a number for each row, and next to them the columns ``kept``."""
        return self.docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("text").cast("string").alias("text"),
            F.struct(*(F.col(f"`{c}`") for c in kept)).alias("document"),
        )

    def stretches(self, first: DataFrame) -> DataFrame:
        """Whole stretches ``row, period, lo, hi`` from the fragments of all tiles."""
        names = ["row", "period", "lo", "hi"]
        tiles_out = first.where(F.col("kind") == TILE).select(*INNER_NAMES[1:])
        dealt = tiles_out.repartition("row", "low", "first")
        solved = dealt.mapInArrow(_solved, "row bigint, period bigint, lo bigint, hi bigint")
        pieces = first.where(F.col("kind") == FRAGMENT).select(*names).unionAll(solved)
        by_period = Window.partitionBy("row", "period").orderBy("lo", "hi")
        reached = F.max("hi").over(by_period.rowsBetween(Window.unboundedPreceding, -1))
        begins = F.coalesce((F.col("lo") > reached).cast("int"), F.lit(1))
        numbered = pieces.withColumn("begins", begins).withColumn(
            "piece", F.sum("begins").over(by_period.rowsBetween(Window.unboundedPreceding, 0))
        )
        return numbered.groupBy("row", "period", "piece").agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi")
        )

    def runs(self, first: DataFrame) -> DataFrame:
        """The runs of each document, by start and then period."""
        length = F.col("hi") - F.col("lo") + F.col("period")
        least = F.greatest(
            F.lit(self.settings.least_words), F.col("period") * self.settings.least_powers
        )
        found = self.stretches(first).where(length >= least)
        run = F.struct(F.col("lo").alias("start"), length.alias("length"), F.col("period"))
        one = F.struct(F.col("lo").alias("at"), F.col("period").alias("by"), run.alias("run"))
        return found.groupBy("row").agg(
            F.transform(F.array_sort(F.collect_list(one)), lambda r: r["run"]).alias("runs")
        )

    def _found(self, kept: list[str]) -> DataFrame:
        """``document, n_words, collapsed, runs`` for every document, with its columns ``kept``."""
        whole = self._whole(kept)
        document = StructField("document", whole.schema["document"].dataType)
        inner = StructType.fromDDL(INNER).add("text", "string")
        kinds = whole.limit(0).select("document").toArrow().schema.field("document").type
        first = stage(
            whole.mapInArrow(
                _first_pass(self.settings, kinds), StructType([*inner.fields, document])
            ),
            "periodic-fragments",
        )
        result = StructType([document, StructField("n_words", LongType())]).add(
            "collapsed", "string"
        )
        plain = whole.mapInArrow(_without_runs(self.settings), result)
        documents = first.where(F.col("kind") == DOCUMENT).select("row", "text", "document")
        own = documents.join(self.runs(first), "row", "left").select(
            "text",
            "document",
            F.coalesce("runs", F.array().cast(RUNS)).alias("runs"),
        )
        periodic = own.mapInArrow(_with_runs, StructType(result.fields).add("runs", RUNS))
        return plain.withColumn("runs", F.array().cast(RUNS)).unionByName(periodic)

    def report(self, key: str = "doc_id") -> DataFrame:
        """One row per document: the key, ``n_words``, ``runs`` and ``collapsed``."""
        return self._found([key]).select(
            F.col("document").getField(key).alias(key), "n_words", "runs", "collapsed"
        )

    def collapsed(self) -> DataFrame:
        """The documents with their text replaced by the words that stay."""
        columns = [
            F.col("collapsed").alias(c) if c == "text" else F.col("document").getField(c).alias(c)
            for c in self.docs.columns
        ]
        # A struct needs a field.
        kept = [c for c in self.docs.columns if c != "text"] or ["text"]
        return self._found(kept).select(*columns)
