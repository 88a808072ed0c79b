"""Byte-pair tokens of pieces that are too long for one task.

A piece of the split pattern, such as the letters of a script without white space, can be as
long as a corpus, and its merges know no border inside.  It comes here as a chain of blocks
of bounded size.  Each block is encoded speculatively: from its first byte, and from each
of the further bytes that a token reaching over from the block before may leave it to
start with.  These runs follow one another from where they first share a token, so all
but the first are short.  A run goes on a little into the next block, which says with
which byte the next block starts: a block is a map from entering to leaving byte.  The maps
nearly always forget their entry, as all runs meet; where they do not, maps are put together
over stretches of 1, 2, 4, ... blocks until they do or the chain begins.

Exactness: a sequence of tokens is the byte-pair encoding of its text if, and only if, each two
neighbours encode to themselves, because the first merge across a border in the whole would
be made in the pair alone, too.  So two runs that share a token can be joined at it, and
a run may begin at any border of another.  What is left of a block's end without the
text that follows is checked: the first token from each entry has to be the same with
the whole block behind it as with the part that the block before has seen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.operators.encode import sliced
from tokenmill.staging import stage

#: Bytes of the next block that a run goes on into.
AHEAD = 4096

Encode = Callable[[bytes], list[int]]


class Codec(Protocol):
    """What of an encoder is needed in the tasks."""

    pattern: str
    #: Bytes of each token.
    sizes: np.ndarray

    def encode_piece(self, piece: bytes) -> list[int]: ...


def borders(ids: list[int], sizes: np.ndarray, start: int) -> np.ndarray:
    """Where the tokens of a run begin, and where the last one ends."""
    return start + np.concatenate([[0], np.cumsum(sizes[ids])]) if ids else np.array([start])


def shared_token(a: np.ndarray, b: np.ndarray) -> tuple[int, int] | None:
    """Places in two sorted lists of borders at which both have the same next border, too."""
    common, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    following = (np.diff(in_a) == 1) & (np.diff(in_b) == 1)
    at = np.flatnonzero(following)
    return (int(in_a[at[0]]), int(in_b[at[0]])) if len(at) else None


class Block:
    """Runs over one block of a piece and the head of the next block."""

    def __init__(self, text: bytes, head: bytes, encode: Encode, sizes: np.ndarray):
        self.text, self.whole = text, text + head
        self.encode, self.sizes = encode, sizes
        self.main = encode(self.whole)
        self.places = borders(self.main, sizes, 0)

    def run(self, entry: int) -> tuple[list[int], np.ndarray]:
        """Tokens from a byte on, joined to the main run where they first share a token."""
        if entry == 0:
            return self.main, self.places
        width = 16 * int(self.sizes.max())
        while entry + width < len(self.whole):
            ids = self.encode(self.whole[entry : entry + width])
            found = borders(ids, self.sizes, entry)
            at = shared_token(found, self.places)
            if at is not None:
                own, main = at
                return (
                    ids[:own] + self.main[main:],
                    np.concatenate([found[:own], self.places[main:]]),
                )
            width *= 4
        ids = self.encode(self.whole[entry:])
        return ids, borders(ids, self.sizes, entry)

    def leave(self, entry: int) -> int:
        """First byte of the next block that a run from ``entry`` leaves to it."""
        places = self.run(entry)[1]
        return int(places[np.searchsorted(places, len(self.text))]) - len(self.text)

    def tokens(self, entry: int) -> list[int]:
        """The tokens that begin in the block, after a look whether the first one was foreseen."""
        ids, places = self.run(entry)
        seen = self.encode(self.text[entry:AHEAD])
        if len(self.text) > AHEAD and seen[:1] != ids[:1]:
            raise ValueError("a token depends on more of the text than the block before has seen")
        return ids[: int(np.searchsorted(places, len(self.text)))]


def leaving(blocks: DataFrame, codec: Codec) -> DataFrame:
    """The map of each block of ``(split, seq, body, head, opens)``, as an array over its entries.

    A block that ``opens`` a piece is entered at its first byte whatever came before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = codec.sizes
        for batch in (part for batch in batches for part in sliced(batch, "body")):
            maps = []
            for row in batch.select(["body", "head", "opens"]).to_pylist():
                block = Block(row["body"], row["head"], codec.encode_piece, sizes)
                starts = [0] * int(sizes.max()) if row["opens"] else range(int(sizes.max()))
                maps.append([block.leave(min(e, len(block.text))) for e in starts])
            columns = [batch.column("split"), batch.column("seq")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(maps, pa.list_(pa.int32()))], names=["split", "seq", "leave"]
            )

    return blocks.mapInArrow(run, "split string, seq bigint, leave array<int>")


def block_tokens(blocks: DataFrame, codec: Codec) -> DataFrame:
    """``(split, seq, part, tokens)`` of blocks with the byte they are entered at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for batch in batches for part in sliced(batch, "body")):
            found = []
            for row in batch.select(["body", "head", "entry"]).to_pylist():
                block = Block(row["body"], row["head"], codec.encode_piece, codec.sizes)
                found.append(block.tokens(row["entry"]))
            columns = [batch.column(c) for c in ("split", "seq", "part")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.list_(pa.int32()))],
                names=["split", "seq", "part", "tokens"],
            )

    return blocks.mapInArrow(run, "split string, seq bigint, part int, tokens array<int>")


def _forgets(maps: Column) -> Column:
    return F.array_min(maps) == F.array_max(maps)


def entries(maps: DataFrame) -> DataFrame:
    """The byte that a block enters the next one at: ``(split, seq, entry)`` of the next one.

    Rounds are as many as the logarithm of the longest stretch that remembers its entry.
    """
    key = ["split", "seq"]
    maps = stage(maps, "leaving-bytes")
    width = 1
    while not (open_ := maps.where(~_forgets(F.col("leave")))).isEmpty():
        before = maps.select(
            "split", (F.col("seq") + width).alias("seq"), F.col("leave").alias("earlier")
        )
        through = F.transform("earlier", lambda b: F.element_at("leave", b + 1))
        longer = open_.join(before, key).select(*key, through.alias("leave"))
        closed = maps.where(_forgets(F.col("leave")))
        maps = stage(closed.unionByName(longer), "leaving-bytes")
        width *= 2
    return maps.select(
        "split", (F.col("seq") + 1).alias("seq"), F.get("leave", F.lit(0)).alias("entry")
    )


BLOCKS = (
    "split string, seq bigint, part int, opens boolean, goes_on boolean, "
    "is_first boolean, body binary, tokens array<int>"
)
LEAD, MIDDLE, TAIL = range(3)


def _parted(codec: Codec):
    """Units at soft borders as the block they end, the pieces inside, and the block they open.

    Pieces inside are encoded at once.  A unit that is one piece between two soft borders is
    a block that does neither.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        pattern = regex.compile(codec.pattern)
        names = [part.split()[0] for part in BLOCKS.split(", ")]
        schema = pa.schema(
            zip(
                names,
                [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_(),
                 pa.binary(), pa.list_(pa.int32())],
            )
        )
        for batch in (part for batch in batches for part in sliced(batch, "text")):
            rows = []
            for unit in batch.to_pylist():
                pieces = [m.encode() for m in pattern.findall(unit["text"])]
                key = {"split": unit["split"], "seq": unit["seq"], "is_first": unit["is_first"]}
                begins, ends = unit["soft_start"], unit["soft_end"]
                if begins:
                    through = ends and len(pieces) == 1
                    rows.append(
                        key | {"part": LEAD, "opens": False, "goes_on": through, "body": pieces[0]}
                    )
                    if through:
                        continue
                    pieces = pieces[1:]
                inside = pieces[:-1] if ends else pieces
                ids = [i for piece in inside for i in codec.encode_piece(piece)]
                rows.append(key | {"part": MIDDLE, "tokens": ids})
                if ends:
                    rows.append(
                        key | {"part": TAIL, "opens": True, "goes_on": True, "body": pieces[-1]}
                    )
            yield from pa.Table.from_pylist(rows, schema).combine_chunks().to_batches()

    return run


def soft_tokens(units: DataFrame, codec: Codec) -> DataFrame:
    """``(split, seq, part, is_first, tokens)`` of units with soft borders, in several rows each."""
    key = ["split", "seq"]
    parts = stage(units.mapInArrow(_parted(codec), BLOCKS), "long-pieces")
    blocks = parts.where(F.col("part") != MIDDLE).select(*key, "part", "opens", "goes_on", "body")
    # What a block goes on into is the head of the block that the next unit begins with.
    heads = blocks.where(F.col("part") == LEAD).select(
        "split",
        (F.col("seq") - 1).alias("seq"),
        F.lit(True).alias("goes_on"),
        F.substring("body", 1, AHEAD).alias("head"),
    )
    empty = F.lit(b"")
    known = blocks.join(heads, [*key, "goes_on"], "left").withColumn(
        "head", F.coalesce("head", empty)
    )
    entered = entries(leaving(known.where("goes_on").select(*key, "body", "head", "opens"), codec))
    lead = known.where(F.col("part") == LEAD).join(entered, key)
    tail = known.where(F.col("part") == TAIL).withColumn("entry", F.lit(0))
    columns = [*key, "part", "body", "head", "entry"]
    found = block_tokens(lead.select(*columns).unionByName(tail.select(*columns)), codec)
    middle = parts.where(F.col("part") == MIDDLE).select(*key, "part", "is_first", "tokens")
    return middle.unionByName(found.withColumn("is_first", F.lit(False)))
