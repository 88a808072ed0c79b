"""Column expressions on arrays of token ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ids are stored in two bytes on disk.
ID_LIMIT = 2**16


def prefix_token(tokens: Column, token: int) -> Column:
    """Put a delimiter id in front of the sequence."""
    return F.concat(F.array(F.lit(token)), tokens)


def in_vocabulary(tokens: Column, n_vocab: int) -> Column:
    """Drop the ids that the vocabulary does not know."""
    return F.filter(tokens, lambda token: (token >= 0) & (token < n_vocab))


def out_of_range(tokens: Column, limit: int = ID_LIMIT) -> Column:
    """Number of ids that do not fit the storage type."""
    return F.size(F.filter(tokens, lambda token: (token < 0) | (token >= limit)))


def checked(tokens: Column, limit: int = ID_LIMIT) -> Column:
    """The sequence itself; the job fails if an id does not fit the storage type."""
    return F.when(out_of_range(tokens, limit) == 0, tokens).otherwise(
        F.raise_error(F.lit(f"token id outside 0..{limit - 1}"))
    )


def widen(tokens: Column) -> Column:
    return tokens.cast("array<bigint>")


def narrow(tokens: Column) -> Column:
    return tokens.cast("array<int>")


def truncate(tokens: Column, max_length: int) -> Column:
    return F.slice(tokens, 1, max_length)
