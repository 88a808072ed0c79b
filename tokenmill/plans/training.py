"""From shards to what a training run reads, and from its losses to decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.functions.tokens import in_vocabulary
from tokenmill.operators.earlystop import Patience, early_stop
from tokenmill.operators.encode import decode
from tokenmill.operators.metrics import loss_by_step
from tokenmill.operators.windows import (
    next_token_pairs,
    random_prompt,
    rank_batches,
    token_windows,
)
from tokenmill.staging import stage


def training_batches(
    pieces: DataFrame, batch_rows: int = 4, length: int = 32, ranks: int = 1
) -> DataFrame:
    """Inputs and targets of all batches of all ranks, read from written shards."""
    pairs = next_token_pairs(token_windows(pieces, length), length)
    return rank_batches(pairs, batch_rows, length, ranks)


def prompt_text(
    pieces: DataFrame,
    vocabulary: dict[bytes, int],
    rows: int = 5,
    length: int = 7,
    seed: int = 42,
    shard_id: int = 0,
) -> DataFrame:
    """One of the first windows of a shard as text, with ids outside the vocabulary left out."""
    known = in_vocabulary(F.col("x"), len(vocabulary) + 1)
    return random_prompt(pieces, shard_id, rows, length, seed).select(
        "window", decode(known, vocabulary).alias("text")
    )


def validate_runs(
    records: DataFrame, rule: Patience, gate: Column | None = None, digits: int | None = None
) -> DataFrame:
    """Early stopping on the validation losses of many runs.

    ``records`` are micro-batch losses ``(run_id, step, rank, loss)``; the loss
    of a step is the mean of its rank means.  ``digits`` rounds it, for results
    that must not depend on the order of the sums.  ``gate`` picks the steps that
    are monitored.
    """
    losses = loss_by_step(records, ["run_id", "step"])
    if gate is not None:
        losses = losses.where(gate)
    loss = F.col("loss") if digits is None else F.round("loss", digits)
    losses = losses.select("run_id", "step", loss.alias("loss"))
    return early_stop(stage(losses, "step_losses"), rule)
