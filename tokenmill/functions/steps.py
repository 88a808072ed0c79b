"""Column expressions on the step number of a training run."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The learning-rate schedule.
MAX_LR = 6e-4
FLOOR_SHARE = 0.1
WARMUP_STEPS = 715
DECAY_END = 19073


def learning_rate(
    step: Column,
    max_lr: float = MAX_LR,
    floor_share: float = FLOOR_SHARE,
    warmup_steps: int = WARMUP_STEPS,
    decay_end: int = DECAY_END,
) -> Column:
    """Linear warm-up, cosine decay to a floor, then the floor."""
    if not 0 <= warmup_steps < decay_end:
        raise ValueError("the decay must end after the warm-up")
    floor = max_lr * floor_share
    progress = (step - warmup_steps) / F.lit(float(decay_end - warmup_steps))
    cosine = (F.cos(progress * math.pi) + 1.0) * 0.5
    return (
        F.when(step < warmup_steps, F.lit(max_lr) * (step + 1) / F.lit(float(warmup_steps or 1)))
        .when(step > decay_end, F.lit(floor))
        .otherwise(cosine * (max_lr - floor) + floor)
    )


def is_last(step: Column, max_steps: int) -> Column:
    return step == max_steps - 1


def is_due(step: Column, every: int, max_steps: int) -> Column:
    """Every ``every`` steps but not at step 0; the last step is always due."""
    return ((step % every == 0) & (step != 0)) | is_last(step, max_steps)


def is_monitored(step: Column, validate_every: int, monitor_every: int, max_steps: int) -> Column:
    """Validation steps that the early-stopping monitor looks at."""
    hit = (step > 0) & ((step % monitor_every == 0) | is_last(step, max_steps))
    return is_due(step, validate_every, max_steps) & hit


def tokens_per_step(batch_rows: int, row_tokens: int, accumulate: int, ranks: int) -> int:
    return batch_rows * row_tokens * accumulate * ranks


def accumulation_steps(total_tokens: int, batch_rows: int, row_tokens: int, ranks: int) -> int:
    """Micro-batches per step and rank so that one step covers ``total_tokens``."""
    per_round = batch_rows * row_tokens * ranks
    if per_round <= 0 or total_tokens % per_round:
        raise ValueError(
            f"total batch of {total_tokens} tokens is no multiple of "
            f"{batch_rows} rows x {row_tokens} tokens x {ranks} ranks"
        )
    return total_tokens // per_round
