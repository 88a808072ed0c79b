"""Small models of the expected behaviour, in plain Python, on lists."""

from __future__ import annotations


def shuffles(plan: str) -> int:
    """Exchanges of a plan that move rows between tasks."""
    return plan.count("Exchange") - plan.count("BroadcastExchange")


def pack(chunks: list[list[int]], size: int) -> list[tuple[str, list[int]]]:
    """One long stream, cut into shards; a short one at the end validates."""
    stream = [token for chunk in chunks for token in chunk]
    shards = [stream[at : at + size] for at in range(0, len(stream), size)]
    return [("train_set" if len(s) == size else "val_set", s) for s in shards]


class Reader:
    """Cursor of one rank over shards of given lengths."""

    def __init__(self, lengths: list[int], rows: int, length: int, rank: int, ranks: int):
        self.lengths, self.span, self.rank, self.ranks = lengths, rows * length, rank, ranks
        self.shard, self.pos = 0, self.span * rank

    def fits(self) -> bool:
        return self.pos + self.span + 1 <= self.lengths[self.shard]

    def roll(self) -> None:
        self.shard = (self.shard + 1) % len(self.lengths)
        self.pos = self.span * self.rank

    def next(self) -> tuple[int, int]:
        while not self.fits():  # too short for this rank's first batch
            self.roll()
        taken = self.shard, self.pos
        self.pos += self.span * self.ranks
        if self.pos + self.span * self.ranks + 1 > self.lengths[self.shard]:
            self.roll()
        return taken


def stop_trace(losses: list[float], patience: int, delta: float, mode: str) -> list[tuple]:
    """(best, counter, improved, stopped) after each loss."""
    best, counter, stopped, out = None, 0, False, []
    for loss in losses:
        score = -loss if mode == "min" else loss
        improved = best is None or not score < best + delta
        if improved:
            best, counter = score, 0
        else:
            counter += 1
            stopped = stopped or counter >= patience
        out.append((best, counter, improved, stopped))
    return out
