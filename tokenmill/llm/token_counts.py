"""Exact token counts of every prefix of a text, by dynamic programming.

Byte-pair encoding has a property that makes this possible: a sequence of
tokens is the encoding of its bytes exactly if every two neighbours are the
encoding of theirs.  So the encoding of a prefix is the encoding of a shorter
prefix plus one token that fits the shorter one's last token, and exactly one
token does.  ``PrefixCounter`` walks the prefixes of a piece of text in order
and keeps count and last token of each.

The library cuts a text into pieces before it merges bytes, and no token
reaches across a piece.  Hence the count at any prefix is the sum over the
whole pieces before it plus the count inside one piece.  The stored table has
one entry per piece, from which the count at every prefix follows without
encoding the text again (``count_at``), as does the longest prefix within a
budget (``longest_within``).

Contract: a null text counts as empty; an empty text has no tokens; the string
of a special token inside a text is one token, as by the library's default; a
row is answered by itself, so repeated rows and doc_ids give repeated results;
of the input columns only ``doc_id`` and the text column are used, whatever
else there is.  An empty table gives an empty table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.hashtable import HashIndex
from tokenmill.llm.text import Spans, blocks

#: How the library cuts a text into pieces before merging; fixed values.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts with other characters are cut by the library itself, as the
#: Unicode tables of two libraries need not be of the same version.
COMMON = r"[^\t\n\r -~\xa1-ɏͰ-ͳΆ-ϿЀ-ҁҊ-ԧ‐-‧€]"
KNOWN_PIECES = 500_000
KNOWN_PAIRS = 1_000_000
TOGETHER = 50_000
LONG_PIECE = 64

TABLE_SCHEMA = (
    "doc_id bigint, n_bytes bigint, n_tokens bigint, ends array<int>, counts array<int>"
)
COUNT_SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint"


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [value for value in range(256) if value not in set(plain)]
    letters = {chr(value): value for value in plain}
    return letters | {chr(256 + place): value for place, value in enumerate(others)}


def joined(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(pieces) + 1, np.int64)
    np.cumsum([len(piece) for piece in pieces], out=offsets[1:])
    return np.frombuffer(b"".join(pieces), np.uint8), offsets


def spans(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return Spans(raw)(offsets[:-1], offsets[1:])


class PrefixCounter:
    """Prefix tables for one byte-level byte-pair vocabulary."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        model = json.loads(Path(path).read_text(encoding="utf-8"))
        self.library = Tokenizer.from_file(path)
        letters = byte_alphabet()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        self.special = sorted(
            (t["content"] for t in model["added_tokens"]), key=len, reverse=True
        )
        self.vocabulary = {
            as_bytes(token)
            for token in model["model"]["vocab"]
            if token not in self.special
        }
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"])
        self.ranks = {(as_bytes(a), as_bytes(b)): rank for rank, (a, b) in enumerate(pairs)}
        self.longest = max(map(len, self.vocabulary))
        self.cut = regex.compile(PIECES)
        self.uncommon = regex.compile(COMMON)
        self.cut_special = regex.compile("|".join(map(regex.escape, self.special)))
        self.halves = {left + right: (left, right) for left, right in self.ranks}
        self.made = {left + right: rank for (left, right), rank in self.ranks.items()}
        self.pairs: dict[int, bool] = {}
        self.piece_tokens: dict[str, int] = {}
        tokens = sorted(self.vocabulary)
        hashes = spans(*joined(tokens))
        order = np.argsort(hashes)
        self.index = HashIndex(hashes[order])
        self.ids = order.astype(np.int64)
        self.tokens = tokens

    def fits(self, left: bytes, right: bytes) -> bool:
        """Whether the two tokens are the encoding of their joined bytes.

        The merges that made them are taken back, the latest first.  If at some
        point the parts that touch could have been merged earlier than what has
        been taken back, that merge would have come first.
        """
        limit = len(self.ranks)
        while True:
            across = self.ranks.get((left, right))
            if across is not None and across < limit:
                return False
            of_left, of_right = self.made.get(left, -1), self.made.get(right, -1)
            if of_left > of_right:
                limit, left = of_left, self.halves[left][1]
            elif of_right >= 0:
                limit, right = of_right + 1, self.halves[right][0]
            else:
                return True

    def prefix_counts(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of every prefix of every piece: entry ``[i, n]`` is of the first n bytes.

        All pieces advance together by one byte.  For each prefix the candidates
        for its last token are tried by falling length; the one that is in the
        vocabulary and fits the last token of what is left is the right one.
        """
        raw, offsets = joined(pieces)
        lengths = np.diff(offsets)
        width = int(lengths.max(initial=0))
        hash_of = Spans(raw)
        counts = np.zeros((len(pieces), width + 1), np.int32)
        last = np.full((len(pieces), width + 1), -1, np.int64)
        for end in range(1, width + 1):
            rows = np.flatnonzero(lengths >= end)
            for size in range(min(end, self.longest), 0, -1):
                if not len(rows):
                    break
                stop = offsets[rows] + end
                place = self.index.find(hash_of(stop - size, stop))
                hit = np.flatnonzero(place >= 0)
                token = self.ids[place[hit]]
                before = last[rows[hit], end - size]
                right = np.ones(len(hit), dtype=bool)
                if size < end:
                    right = self.fitting(before, token)
                done = rows[hit[right]]
                counts[done, end] = counts[done, end - size] + 1
                last[done, end] = token[right]
                left = np.ones(len(rows), dtype=bool)
                left[hit[right]] = False
                rows = rows[left]
        return counts

    def fitting(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if len(self.pairs) > KNOWN_PAIRS:
            self.pairs.clear()
        keys, place = np.unique(left * len(self.tokens) + right, return_inverse=True)
        found = np.zeros(len(keys), dtype=bool)
        for i, key in enumerate(keys.tolist()):
            fits = self.pairs.get(key)
            if fits is None:
                one, two = divmod(key, len(self.tokens))
                fits = self.pairs[key] = self.fits(self.tokens[one], self.tokens[two])
            found[i] = fits
        return found[place]

    def learn(self, pieces: set[str]) -> None:
        """Put the token counts of pieces that are new into the table of known ones."""
        known = self.piece_tokens
        if len(known) > KNOWN_PIECES:
            known.clear()
        new = sorted(pieces.difference(known), key=len)
        for at in range(0, len(new), TOGETHER):
            some = new[at : at + TOGETHER]
            coded = [piece.encode() for piece in some]
            table = self.prefix_counts([c for c in coded if len(c) <= LONG_PIECE])
            totals = iter(table[np.arange(len(table)), [len(c) for c in coded if len(c) <= LONG_PIECE]].tolist())
            for piece, code in zip(some, coded, strict=True):
                known[piece] = next(totals) if len(code) <= LONG_PIECE else self.walk(code)[-1]

    def walk(self, piece: bytes) -> list[int]:
        """The same counts of one long piece, without a table of all pieces' widths."""
        counts, last = [0], [b""]
        for end in range(1, len(piece) + 1):
            for start in range(max(0, end - self.longest), end):
                token = piece[start:end]
                if token in self.vocabulary and (
                    start == 0 or self.fits(last[start], token)
                ):
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break
        return counts

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text without special tokens, in order."""
        if text.isascii() or not self.uncommon.search(text):
            if not self.control(text):
                return self.cut.findall(text)
        spans = [span for _, span in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return [text[start:end] for start, end in spans]

    @staticmethod
    def control(text: str) -> bool:
        """Characters that some libraries take for white space and others do not."""
        return any(c in text for c in "\x1c\x1d\x1e\x1f\x0b\x0c\x85")

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text cut at special tokens, each part with whether it is one."""
        if not any(token in text for token in self.special):
            yield text, False
            return
        at = 0
        for match in self.cut_special.finditer(text):
            yield text[at : match.start()], False
            yield match.group(), True
            at = match.end()
        yield text[at:], False

    def cut_texts(self, texts: list[str]) -> list[list[str]]:
        """The pieces of each text, a special token being one; all are known afterwards."""
        cut = []
        for text in texts:
            if any(token in text for token in self.special):
                own = []
                for part, special in self.parts(text):
                    own += [part] if special else self.pieces(part)
                cut.append(own)
            else:
                cut.append(self.pieces(text))
        self.learn(set().union(*cut))
        for token in self.special:
            self.piece_tokens[token] = 1
        return cut

    def tables(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ends of the pieces of each text in characters, and the tokens up to each end."""
        tokens = self.piece_tokens
        return [
            (list(accumulate(map(len, own))), list(accumulate(map(tokens.__getitem__, own))))
            for own in self.cut_texts(texts)
        ]

    def totals(self, texts: list[str]) -> list[int]:
        """The last entry of each table."""
        tokens = self.piece_tokens
        return [sum(map(tokens.__getitem__, own)) for own in self.cut_texts(texts)]

    def count_at(self, text: str, ends: list[int], counts: list[int], length: int) -> int:
        """Tokens of the first ``length`` characters, from the stored table.

        The pieces of a prefix are those of the text but near its end, where
        the cut can fall inside a piece or a run of white space.  Counting goes
        on from the last piece border before both.
        """
        length = max(0, min(length, len(text)))
        place = int(np.searchsorted(ends, length, "right"))
        while place and (
            ends[place - 1] > length
            or text[ends[place - 1] - 1].isspace()
            or text[ends[place - 1] : ends[place - 1] + 1].isspace()
            and text[ends[place - 1] : length].isspace()
        ):
            place -= 1
        start = ends[place - 1] if place else 0
        return (counts[place - 1] if place else 0) + self.totals([text[start:length]])[0]

    def longest_within(
        self, text: str, ends: list[int], counts: list[int], budget: int
    ) -> int:
        """The largest number of leading characters that take at most ``budget`` tokens."""
        if not ends or counts[-1] <= budget:
            return len(text)
        place = int(np.searchsorted(counts, budget, "right"))
        # The piece after the first that exceeds the budget can only add a space
        # to a run of white space; beyond it no count is lower.
        high = ends[min(place + 1, len(ends) - 1)]
        for length in range(high, -1, -1):
            if self.count_at(text, ends, counts, length) <= budget:
                return length
        return 0


@lru_cache(maxsize=2)
def counter_of(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def _bytes(column: pa.Array) -> pa.Array:
    return pa.compute.binary_length(column.fill_null("")).cast(pa.int64())


def by_block(column: pa.Array) -> Iterator[list[str]]:
    """The texts of a column, null as empty, a few megabytes at a time."""
    for start, end, _, _ in blocks(column):
        yield column.slice(start, end - start).fill_null("").to_pylist()


def prefix_tables(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """The table of every text: ends of its pieces and exact token counts up to them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(vocabulary)
        for batch in batches:
            tables = [t for texts in by_block(batch.column(1)) for t in counter.tables(texts)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    _bytes(batch.column(1)),
                    pa.array([c[-1] if c else 0 for _, c in tables], pa.int64()),
                    pa.array([e for e, _ in tables], pa.list_(pa.int32())),
                    pa.array([c for _, c in tables], pa.list_(pa.int32())),
                ],
                ["doc_id", "n_bytes", "n_tokens", "ends", "counts"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), text).mapInArrow(run, TABLE_SCHEMA)


def token_counts(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """Bytes and tokens of every whole text: the last entries of the prefix tables.

    ``vocabulary`` is the path of the library's file, which every machine has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(vocabulary)
        for batch in batches:
            totals = [n for texts in by_block(batch.column(1)) for n in counter.totals(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _bytes(batch.column(1)), pa.array(totals, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), text).mapInArrow(run, COUNT_SCHEMA)


def counts_at(docs: DataFrame, tables: DataFrame, vocabulary: str, length: int) -> DataFrame:
    """Tokens of the first ``length`` characters of every text, from its stored table.

    Joined on ``doc_id``, which has to be unique here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(vocabulary)
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True)
            found = [counter.count_at(t or "", e, c, length) for t, e, c in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], ["doc_id", "n_tokens"]
            )

    joined = docs.select("doc_id", "text").join(
        tables.select("doc_id", "ends", "counts"), "doc_id"
    )
    return joined.mapInArrow(run, "doc_id bigint, n_tokens bigint")
