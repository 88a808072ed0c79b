"""Softmax, top-k, weighted draws and cross-entropy over score tables.

Two layouts are supported.  With one array of scores per position everything
is computed inside the row and nothing is shuffled.  In the long layout
``(position, class, score)`` the sums are ordinary aggregations, which combine
before the shuffle, so a position with very many rows does not land whole in
one task.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Use ``value`` in ``body``, worked out once per row.

    A value written out inside a lambda would be worked out again for every
    element that the lambda is applied to.
    """
    return F.transform(F.array(value), body)[0]


def _doubles(scores: Column) -> Column:
    return scores.cast("array<double>")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)


def _shifted_exps(scores: Column, top: Column) -> Column:
    return F.transform(scores, lambda score: F.exp(score - top))


def log_sum_exp(scores: Column) -> Column:
    """``ln(sum(exp(score)))``, shifted by the largest score so that nothing overflows."""
    scores = _doubles(scores)
    return _let(F.array_max(scores), lambda top: top + F.ln(_sum(_shifted_exps(scores, top))))


def softmax(scores: Column) -> Column:
    """Array of probabilities of an array of scores."""
    scores = _doubles(scores)
    exps = _let(F.array_max(scores), lambda top: _shifted_exps(scores, top))
    return _let(
        exps,
        lambda all_exps: _let(
            _sum(all_exps), lambda total: F.transform(all_exps, lambda one: one / total)
        ),
    )


def top_k(probabilities: Column, k: int = 50) -> Column:
    """The ``k`` largest as ``array<struct<prob, id>>``; the smaller id wins a tie."""
    ranked = F.array_sort(
        F.transform(probabilities, lambda p, i: F.struct((-p).alias("neg"), i.alias("id")))
    )
    return F.transform(
        F.slice(ranked, 1, k), lambda item: F.struct((-item.neg).alias("prob"), item.id.alias("id"))
    )


def unit_draw(seed: int, *keys: Any) -> Column:
    """A number in [0, 1) that depends on nothing but ``seed`` and ``keys``.

    It is made of the first 52 bits of an MD5 digest, so any engine can repeat it.
    """
    parts = [F.col(key) if isinstance(key, str) else key for key in keys]
    text = F.concat_ws(":", F.lit(str(seed)), *parts)
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint")
    return bits / F.lit(float(1 << 52))


def draw(weighted: Column, unit: Column) -> Column:
    """Draw one element of ``array<struct<prob, id>>`` in proportion to ``prob``.

    The weights need not sum to one.  Returns the element.
    """
    start = F.struct(F.lit(0.0).alias("seen"), F.lit(0).alias("passed"))

    def passed(items: Column, target: Column) -> Column:
        walked = F.aggregate(
            items,
            start,
            lambda acc, item: F.struct(
                (acc.seen + item.prob).alias("seen"),
                F.when(acc.seen + item.prob <= target, acc.passed + 1)
                .otherwise(acc.passed)
                .alias("passed"),
            ),
        )
        return walked.passed

    def pick(items: Column) -> Column:
        target = unit * _sum(F.transform(items, lambda item: item.prob))
        position = _let(target, lambda bound: passed(items, bound))
        return gather(items, F.least(position, F.size(items) - 1))

    return _let(weighted, pick)


def gather(values: Column, position: Column) -> Column:
    """Element at a zero-based position."""
    return F.element_at(values, position + 1)


def cross_entropy(scores: Column, target: Column) -> Column:
    """Loss of the target class under the scores of one position."""
    return log_sum_exp(scores) - gather(_doubles(scores), target)


def mean_cross_entropy(df: DataFrame, scores: str, target: str, by: tuple = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.avg(cross_entropy(F.col(scores), F.col(target))).alias("loss"),
        F.count(F.lit(1)).alias("n_positions"),
    )


# Long layout.


#: Scores are summed up in bands of this width, in which no exponential overflows.
BAND = 128


def log_sum_exp_long(scores: DataFrame, position: str = "pos", score: str = "score") -> DataFrame:
    """``(position, log_sum)``: ln(sum(exp(score))) of each position, in one pass over the scores.

    The sums of a position are kept per band of scores, next to the lower end of the band.
    Such sums merge by adding them up, so every task passes on a row or two per position, and a
    position with very many rows meets in no task.  The two highest bands make the
    result: what lies below them is smaller by e^128 at least.
    """
    value = F.col(score).cast("double")
    banded = scores.select(position, value.alias("_score"), F.floor(value / BAND).alias("_band"))
    sums = banded.groupBy(position, "_band").agg(
        F.sum(F.exp(F.col("_score") - F.col("_band") * BAND)).alias("_sum")
    )
    highest = F.sort_array(F.collect_list(F.struct("_band", "_sum")), asc=False)
    first, second = F.get("_bands", F.lit(0)), F.get("_bands", F.lit(1))
    lower = F.coalesce(
        second["_sum"] * F.exp(((second["_band"] - first["_band"]) * BAND).cast("double")),
        F.lit(0.0),
    )
    return (
        sums.where("_band is not null")
        .groupBy(position)
        .agg(highest.alias("_bands"))
        .select(position, (first["_band"] * BAND + F.ln(first["_sum"] + lower)).alias("log_sum"))
    )


def softmax_long(
    scores: DataFrame, position: str = "pos", score: str = "score", out: str = "prob"
) -> DataFrame:
    """Softmax per position over rows: one aggregation, and one join of its result."""
    sums = log_sum_exp_long(scores, position, score).withColumnRenamed("log_sum", "_log_sum")
    share = F.exp(F.col(score).cast("double") - F.col("_log_sum"))
    return scores.join(sums, position).withColumn(out, share).drop("_log_sum")


def top_k_long(
    scores: DataFrame, position: str = "pos", class_id: str = "id", value: str = "prob", k: int = 50
) -> DataFrame:
    """The ``k`` best rows per position.

    Spark cuts each partition to ``k`` rows per position before it shuffles,
    so at most ``k`` rows per position and input partition travel.
    """
    ranked = Window.partitionBy(position).orderBy(F.desc(value), F.asc(class_id))
    return scores.withColumn("rank_no", F.row_number().over(ranked)).where(F.col("rank_no") <= k)


def draw_long(
    ranked: DataFrame,
    unit: Column,
    position: str = "pos",
    value: str = "prob",
    rank_no: str = "rank_no",
) -> DataFrame:
    """Draw one row per position from rows of :func:`top_k_long`, at most ``k`` per position."""
    whole = Window.partitionBy(position)
    running = whole.orderBy(rank_no).rowsBetween(Window.unboundedPreceding, 0)
    marked = ranked.withColumns(
        {"_seen": F.sum(value).over(running), "_all": F.sum(value).over(whole)}
    )
    hit = (F.col("_seen") > unit * F.col("_all")) | (F.col("_seen") >= F.col("_all"))
    first = Window.partitionBy(position).orderBy(rank_no)
    return (
        marked.where(hit)
        .withColumn("_n", F.row_number().over(first))
        .where(F.col("_n") == 1)
        .drop("_seen", "_all", "_n")
    )


def last_positions(df: DataFrame, sequence: str, position: str) -> DataFrame:
    """The row with the largest position of each sequence, combined before the shuffle."""
    rest = [c for c in df.columns if c != sequence]
    latest = df.groupBy(sequence).agg(F.max_by(F.struct(*rest), F.col(position)).alias("_last"))
    return latest.select(sequence, "_last.*")
