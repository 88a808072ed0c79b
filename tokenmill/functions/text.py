"""Column expressions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marker texts around one document.
START_OF_TEXT = "<|startoftext|>"
END_OF_TEXT = "<|endoftext|>"


def with_boundaries(text: Column) -> Column:
    """Put the start and end markers around a document, each set off by one space."""
    return F.concat(F.lit(f"{START_OF_TEXT} "), text, F.lit(f" {END_OF_TEXT}"))


def shard_name(split: Column, shard_id: Column) -> Column:
    return F.concat(split, F.lit("_shard_"), six_digits(shard_id))


def six_digits(number: Column) -> Column:
    return F.format_string("%06d", number)
