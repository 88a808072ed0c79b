"""Text to token ids and back."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tokenmill.functions.text import END_OF_TEXT
from tokenmill.functions.tokens import ID_LIMIT, checked, prefix_token

TOKENS = ArrayType(IntegerType())

#: Bytes of text that a task encodes together, whatever Spark sends it at once.
SLICE_BYTES = 1 << 20

# Fixed value: the published split pattern of the GPT-2 vocabulary.
SPLIT_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder(Protocol):
    """What the corpus jobs need to know about a tokenizer."""

    eot: int

    def encode(self, text: Column) -> Column: ...

    def length(self, text: Column) -> Column | None:
        """Token count without encoding, where there is such a thing."""

    def batch_encoder(self) -> Callable[[pa.Array], pa.Array]:
        """Function of an Arrow batch of texts, to be run in tasks."""


def _list_array(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def sliced(batch: pa.RecordBatch, column: str, size: int | None = None) -> Iterator[pa.RecordBatch]:
    """A batch in stretches whose ``column`` holds about ``size`` bytes, or one longer value.

    Tokens take several times the memory of their text, so they are made of one stretch at a time.
    """
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ahead = np.cumsum(lengths, dtype=np.int64) - lengths
    firsts = np.flatnonzero(np.diff(ahead // (size or SLICE_BYTES), prepend=-1)).tolist()
    for first, end in zip(firsts, [*firsts[1:], len(lengths)]):
        yield batch.slice(first, end - first)


def utf8_bytes(texts: pa.Array) -> pa.Array:
    blobs = texts.fill_null("").cast(pa.binary())
    lengths = pc.binary_length(blobs).to_numpy(zero_copy_only=False)
    _, offsets, data = blobs.buffers()
    first = np.frombuffer(offsets, np.int32, 1, blobs.offset * 4)[0] if len(blobs) else 0
    values = np.frombuffer(data or b"", np.uint8)[first : first + lengths.sum()]
    return _list_array(values, lengths)


@dataclass(frozen=True)
class ByteEncoder:
    """Each UTF-8 byte is a token; the delimiter follows the 256 byte ids."""

    eot: int = 256
    n_vocab: int = 257

    def encode(self, text: Column) -> Column:
        return as_column(utf8_bytes, text)

    def length(self, text: Column) -> Column:
        return F.octet_length(F.coalesce(text, F.lit("")))

    def batch_encoder(self) -> Callable[[pa.Array], pa.Array]:
        return utf8_bytes


@dataclass
class BpeEncoder:
    """Byte-pair encoding with a given rank table; special tokens are plain text.

    The rank table is small by its nature (ids fit two bytes), which is checked
    when it is read, and travels to the executors as one broadcast.
    """

    ranks: dict[bytes, int]
    pattern: str = SPLIT_PATTERN
    _batch: Any = field(default=None, repr=False)

    def __post_init__(self) -> None:
        if len(self.ranks) >= ID_LIMIT:
            raise ValueError(f"a vocabulary has at most {ID_LIMIT - 1} entries and a delimiter")

    @classmethod
    def from_table(cls, ranks: DataFrame, pattern: str = SPLIT_PATTERN) -> BpeEncoder:
        """Read a table ``(id, bytes)``."""
        return cls(collect_vocabulary(ranks), pattern)

    @property
    def eot(self) -> int:
        return len(self.ranks)

    @property
    def n_vocab(self) -> int:
        return len(self.ranks) + 1

    def encode(self, text: Column) -> Column:
        return as_column(self.batch_encoder(), text)

    def length(self, text: Column) -> None:
        return None

    def batch_encoder(self) -> Callable[[pa.Array], pa.Array]:
        if self._batch is None:
            context = SparkSession.getActiveSession().sparkContext
            self._batch = _Codec(context.broadcast(self.ranks), self.pattern)
        return self._batch


def collect_vocabulary(ranks: DataFrame) -> dict[bytes, int]:
    """Read a table ``(id, bytes)`` to the driver after a check of its size."""
    if ranks.count() >= ID_LIMIT:
        raise ValueError(f"a vocabulary has at most {ID_LIMIT - 1} entries and a delimiter")
    rows = ranks.select("bytes", "id").collect()
    table = {bytes(row["bytes"]): row["id"] for row in rows}
    if len(table) != len(rows):
        raise ValueError("vocabulary entries must be distinct")
    if sorted(table.values()) != list(range(len(table))):
        raise ValueError("vocabulary ids must run from 0 without gaps")
    return table


class _Codec:
    """Batch encoder that is sent as its rank table and built once per task."""

    def __init__(self, ranks_broadcast: Any, pattern: str):
        self.ranks = ranks_broadcast
        self.pattern = pattern

    @cached_property
    def encoding(self) -> Any:
        import tiktoken

        return tiktoken.Encoding(
            name="given-ranks",
            pat_str=self.pattern,
            mergeable_ranks=self.ranks.value,
            special_tokens={},
        )

    @cached_property
    def sizes(self) -> np.ndarray:
        found = np.zeros(len(self.ranks.value), np.int64)
        for piece, rank in self.ranks.value.items():
            found[rank] = len(piece)
        return found

    def encode_piece(self, piece: bytes) -> list[int]:
        """Tokens of the bytes of one piece, or of a part of one."""
        return self.encoding._core_bpe.encode_single_piece(piece) if piece else []

    def __call__(self, texts: pa.Array) -> pa.Array:
        encode = self.encoding.encode_ordinary
        ids = [np.asarray(encode(text or ""), dtype=np.int32) for text in texts.to_pylist()]
        lengths = np.fromiter((len(one) for one in ids), np.int64, len(ids))
        return _list_array(np.concatenate(ids) if ids else np.empty(0), lengths)

    def __getstate__(self) -> dict[str, Any]:
        return {"ranks": self.ranks, "pattern": self.pattern}


def in_range(values: np.ndarray) -> None:
    """Fail the task if an id does not fit the storage type."""
    if len(values) and (values.min() < 0 or values.max() >= ID_LIMIT):
        raise ValueError(f"token id outside 0..{ID_LIMIT - 1}")


def as_column(batch: Callable[[pa.Array], pa.Array], text: Column) -> Column:
    @F.arrow_udf(TOKENS)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for part in sliced(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
                tokens = batch(part.column("text"))
                in_range(tokens.flatten().to_numpy(zero_copy_only=False))
                yield tokens

    return encode(text)


def delimited(tokens: Column, eot: int) -> Column:
    """The delimiter id in front; ids too large for the storage type fail the job."""
    tokens = prefix_token(tokens, eot)
    return checked(tokens) if eot >= ID_LIMIT else tokens


def encode_in_order(
    texts: DataFrame, encoder: Encoder, group: str, order_by: str, text_col: str = "text"
) -> DataFrame:
    """Replace the text by ``tokens``, ``n_tokens`` and ``inside``, the tokens before the row.

    Every ``group`` must lie in one partition already, so nothing is shuffled:
    rows are sorted where they are and the count runs along with the encoder.
    """
    batch_encoder, eot = encoder.batch_encoder(), encoder.eot
    kept = [field for field in texts.schema if field.name != text_col]
    schema = StructType(
        [
            *kept,
            StructField("tokens", TOKENS),
            StructField("n_tokens", LongType()),
            StructField("inside", LongType()),
        ]
    )
    names = [field.name for field in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seen = None, 0
        for batch in (part for batch in batches for part in sliced(batch, text_col)):
            tokens = batch_encoder(batch.column(text_col))
            firsts = tokens.offsets.to_numpy()[:-1]
            values = np.insert(tokens.values.to_numpy(zero_copy_only=False), firsts, eot)
            in_range(values)
            lengths = pc.list_value_length(tokens).to_numpy(zero_copy_only=False) + 1
            inside = []
            for owner, n in zip(batch.column(group).to_pylist(), lengths.tolist()):
                if owner != current:
                    current, seen = owner, 0
                inside.append(seen)
                seen += n
            columns = [batch.column(name) for name in names]
            columns += [
                _list_array(values, lengths),
                pa.array(lengths, pa.int64()),
                pa.array(inside, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*names, "tokens", "n_tokens", "inside"])

    return texts.sortWithinPartitions(group, order_by).mapInArrow(run, schema)


def decode(tokens: Column, vocabulary: dict[bytes, int]) -> Column:
    """Token ids to text; ids outside the vocabulary are dropped first.

    The delimiter id, which follows the vocabulary, reads as its marker text.
    Byte sequences that are not valid UTF-8 become replacement characters.
    """
    by_id = [piece for piece, _ in sorted(vocabulary.items(), key=lambda item: item[1])]
    by_id.append(END_OF_TEXT.encode())
    shared = SparkSession.getActiveSession().sparkContext.broadcast(by_id)

    @F.arrow_udf(StringType())
    def to_text(sequences: pa.Array) -> pa.Array:
        pieces = pa.array(shared.value, pa.binary())
        ids = sequences.flatten().to_numpy(zero_copy_only=False)
        lengths = pc.list_value_length(sequences).fill_null(0).to_numpy(zero_copy_only=False)
        known = (ids >= 0) & (ids < len(pieces))
        before = np.concatenate([[0], np.cumsum(known)])
        ends = before[np.concatenate([[0], np.cumsum(lengths)])]
        spelled = pa.ListArray.from_arrays(
            pa.array(ends.astype(np.int32)), pieces.take(pa.array(ids[known]))
        )
        joined = pc.binary_join(spelled, b"")
        try:
            return joined.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([one.decode("utf-8", "replace") for one in joined.to_pylist()])

    return to_text(tokens)
