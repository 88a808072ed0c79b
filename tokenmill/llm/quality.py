"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad.  What speaks for a label are simple shares of
the line and of the lines before and after it (letters, capitals, digits, bars,
exclamation marks, other signs, words that repeat the word before, length), and
the label of the line before.  The forward-backward recursion gives the
probability that each line is good, and their mean, weighted by the length of the
lines, is what a document is judged by; a logistic curve fitted on the same
training rows turns it into the probability of label 1.

Training uses a bounded sample of the labelled rows: about ``sample`` documents of
each label, chosen by a hash of ``doc_id``, all their lines.  A document's label is
taken for all its lines.  Scoring reads whole texts.

Contract: null text is empty; an empty text is one line of length 0 and gets a
score like any other; documents whose labels contradict each other or are null are
not learned from; without labelled rows of both kinds every score is the share of
label 1, or 0.5 if there are none.  A row is scored by itself; other columns pass
through and never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.tables import small_or_shuffled
from tokenmill.llm.text import Spans, blocks, word_bounds

GOOD = 0.7
_KINDS = 7
_KIND = np.full(256, 6, np.uint8)  # other signs
_KIND[[9, 11, 12, 13, 32]] = 0
_KIND[[*range(97, 123), *range(128, 256)]] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[ord("|")]] = 4
_KIND[[ord("!")]] = 5
_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".,;:?'\"()-"]] = True


@dataclass(frozen=True)
class QualitySettings:
    sample: int = 2000
    rounds: int = 120
    penalty: float = 1e-3


def line_features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of a block, each text's first line, and the lines' lengths.

    A text has one line more than line feeds.
    """
    feeds = np.flatnonzero(raw == 10)
    owner = np.searchsorted(offsets, feeds, "right") - 1
    count = np.bincount(owner, minlength=len(offsets) - 1) + 1
    firsts = np.concatenate([[0], np.cumsum(count)])
    starts = np.empty(firsts[-1], np.int64)
    is_first = np.zeros(firsts[-1], bool)
    is_first[firsts[:-1]] = True
    starts[is_first] = offsets[:-1]
    starts[~is_first] = feeds + 1
    ends = np.empty_like(starts)
    is_last = np.zeros(firsts[-1], bool)
    is_last[firsts[1:] - 1] = True
    ends[is_last] = offsets[1:]
    ends[~is_last] = feeds
    length = ends - starts

    def per_line(marks: np.ndarray) -> np.ndarray:
        running = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(marks, out=running[1:], dtype=np.int32)
        return running[ends] - running[starts]

    kind = _KIND[raw]
    held = [per_line(kind == k) for k in range(1, _KINDS)]
    stops = per_line(_STOPS[raw])
    word_starts, word_ends, _ = word_bounds(raw, offsets)
    hashes = Spans(raw)(word_starts, word_ends)
    line_of = np.searchsorted(starts, word_starts, "right") - 1
    words = np.bincount(line_of, minlength=len(starts))
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    repeats = np.bincount(line_of[again], minlength=len(starts))
    size = np.maximum(length, 1)
    letters = np.maximum(held[0] + held[1], 1)
    own = np.stack(
        [
            np.log1p(length),
            (held[0] + held[1]) / size,
            held[1] / letters,
            held[2] / size,
            held[3] / size,
            held[4] / size,
            (held[5] - stops) / size,
            stops / size,
            repeats / np.maximum(words, 1),
            np.minimum(letters / np.maximum(words, 1), 40) / 10,
            np.minimum(held[3], 3) / 3,
        ],
        axis=1,
    )
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[is_first], after[is_last] = 0, 0
    edges = np.stack([is_first, is_last], axis=1).astype(float)
    return np.concatenate([own, before, after, edges], axis=1), firsts, length


class Chain:
    """Order in which the lines of many texts are visited side by side."""

    def __init__(self, firsts: np.ndarray):
        counts = np.diff(firsts)
        order = np.argsort(-counts, kind="stable")
        self.firsts, self.counts = firsts[:-1][order], counts[order]
        longest = int(counts.max(initial=0))
        self.active = np.searchsorted(-self.counts, -np.arange(longest), "left")

    def steps(self) -> Iterator[tuple[int, np.ndarray]]:
        for step, active in enumerate(self.active):
            yield step, self.firsts[:active] + step


def _logsum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


def marginals(
    scores: np.ndarray, moves: np.ndarray, chain: Chain
) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each label of each line, and of each pair of labels over all lines."""
    forward, backward = scores.copy(), np.zeros_like(scores)
    steps = list(chain.steps())
    for step, rows in steps[1:]:
        forward[rows] += _logsum(forward[rows - 1][:, :, None] + moves[None], 1)
    pairs = np.zeros((2, 2))
    for step, rows in reversed(steps[1:]):
        inner = scores[rows] + backward[rows]
        backward[rows - 1] = _logsum(moves[None] + inner[:, None, :], 2)
        joint = forward[rows - 1][:, :, None] + moves[None] + inner[:, None, :]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    total = forward + backward
    chance = np.exp(total - total.max(axis=1, keepdims=True))
    return chance / chance.sum(axis=1, keepdims=True), pairs


class QualityModel:
    def __init__(self, prior: float):
        self.prior = prior
        self.fitted = False

    def fit(self, features, firsts, lengths, labels, weights, settings: QualitySettings) -> None:
        """Maximise the penalised likelihood of the line labels by gradient steps."""
        self.mean = features.mean(axis=0)
        self.scale = features.std(axis=0) + 1e-6
        x = (features - self.mean) / self.scale
        x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
        chain, counts = Chain(firsts), np.diff(firsts)
        wanted = np.repeat(labels, counts).astype(int)
        truth = np.eye(2)[wanted]
        inner = np.ones(len(wanted), bool)
        inner[firsts[:-1]] = False
        seen = np.zeros((2, 2))
        np.add.at(seen, (wanted[inner], wanted[inner]), 1)
        self.weights, self.moves = np.zeros((x.shape[1], 2)), np.zeros((2, 2))
        moment = [np.zeros_like(self.weights), np.zeros_like(self.moves)]
        square = [np.zeros_like(self.weights), np.zeros_like(self.moves)]
        for turn in range(1, settings.rounds + 1):
            chance, pairs = marginals(x @ self.weights, self.moves, chain)
            steps = [
                x.T @ (truth - chance) / len(x) - settings.penalty * self.weights,
                (seen - pairs) / len(x) - settings.penalty * self.moves,
            ]
            for value, step, m, v in zip(
                (self.weights, self.moves), steps, moment, square, strict=True
            ):
                m += 0.1 * (step - m)
                v += 0.01 * (step * step - v)
                value += 0.1 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
        self.fitted, self.curve = True, (0.0, 1.0)
        share = self.shares(features, firsts, lengths)
        self.curve = logistic(share, labels, weights)

    def lines(self, features: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        x = (features - self.mean) / self.scale
        x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
        return marginals(x @ self.weights, self.moves, Chain(firsts))[0][:, 1]

    def shares(self, features, firsts, lengths) -> np.ndarray:
        """Share of a document in good lines, by length; an empty line counts a little."""
        good, weight = self.lines(features, firsts), lengths + 1.0
        if not len(good):
            return np.zeros(0)
        starts = firsts[:-1]
        return np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(offsets) - 1, self.prior)
        at, slope = self.curve
        share = self.shares(*line_features(raw, offsets))
        return 1 / (1 + np.exp(-np.clip(at + slope * share, -30, 30)))


def logistic(share: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Offset and slope of the weighted logistic curve, by Newton steps with a small penalty."""
    x = np.stack([np.ones_like(share), share], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weights * (labels - chance)) - 1e-2 * beta
        curve = (x * (weights * chance * (1 - chance))[:, None]).T @ x + 1e-2 * np.eye(2)
        beta = beta + np.linalg.solve(curve, slope)
    return float(beta[0]), float(max(beta[1], 1e-3))


def learn_quality(
    docs: DataFrame, labels: DataFrame, settings: QualitySettings | None = None
) -> QualityModel:
    """Learn from the documents that ``labels (doc_id, quality)`` names with label 0 or 1."""
    settings = settings or QualitySettings()
    known = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .where("quality = most")
        .select("doc_id", "quality")
    )
    sizes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    model = QualityModel(sizes.get(1, 0) / total if total else 0.5)
    if len(sizes) < 2:
        return model
    part = {k: min(1.0, settings.sample / n) for k, n in sizes.items()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    chosen = small_or_shuffled(
        known.where(place < F.when(F.col("quality") == 1, part[1]).otherwise(part[0])),
        "labelled-sample",
    )
    rows = (
        docs.select("doc_id", "text")
        .join(chosen, "doc_id")
        .select("doc_id", "quality", F.coalesce("text", F.lit("")).alias("text"))
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("text", "ascending")])
    )
    if len(set(rows["quality"].to_pylist())) < 2:
        return model
    features, firsts, lengths = [], [np.zeros(1, np.int64)], []
    for _, _, raw, offsets in blocks(rows["text"].combine_chunks()):
        own, at, length = line_features(raw, offsets)
        features.append(own)
        firsts.append(at[1:] + firsts[-1][-1])
        lengths.append(length)
    label = rows["quality"].to_numpy().astype(float)
    weights = np.where(label == 1, 1 / part[1], 1 / part[0])
    model.fit(
        np.concatenate(features), np.concatenate(firsts), np.concatenate(lengths),
        label, weights / weights.mean(), settings,
    )
    return model


def with_quality(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The rows with ``score`` and ``predicted``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        parts = [sent.value.score(raw, offsets) for _, _, raw, offsets in blocks(column)]
        return pa.array(np.concatenate([np.zeros(0), *parts]))

    return docs.withColumn("score", score(F.col(text))).withColumn(
        "predicted", (F.col("score") >= GOOD).cast("int")
    )


def line_quality(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """``(doc_id, good)``: the probability that each line is good, in the order of the lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, raw, offsets in blocks(batch.column(1)):
                features, firsts, _ = line_features(raw, offsets)
                good = model.lines(features, firsts) if model.fitted else np.full(firsts[-1], model.prior)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(good)),
                    ],
                    ["doc_id", "good"],
                )

    chosen = docs.select(F.col("doc_id").cast("bigint"), text)
    return chosen.mapInArrow(run, "doc_id bigint, good array<double>")
