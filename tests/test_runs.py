import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from models import stop_trace
from pyspark.sql import functions as F

from tokenmill.functions import steps
from tokenmill.operators import metrics
from tokenmill.operators.earlystop import Patience, early_stop, early_stop_trace, improvements
from tokenmill.sources import runlog

SERIES = "run_id bigint, step bigint, loss double"


def series(spark, runs):
    rows = [(run, 10 * i, float(x)) for run, xs in runs.items() for i, x in enumerate(xs)]
    random.Random(2).shuffle(rows)
    return spark.createDataFrame(rows, SERIES)


def check(spark, runs, rule, buckets, summary=True):
    df = series(spark, runs)
    trace, ends, better = {}, {}, []
    for run, losses in runs.items():
        states = stop_trace([float(x) for x in losses], rule.patience, rule.delta, rule.mode)
        for i, state in enumerate(states):
            trace[run, 10 * i] = state
            if state[2]:
                better.append((run, 10 * i, state[0]))
        best_step = max(10 * i for i, s in enumerate(states) if s[2])
        ends[run] = (len(losses), best_step, states[-1][0], states[-1][1], states[-1][3])
    got = {
        (r["run_id"], r["step"]): (r["best"], r["counter"], r["improved"], r["stopped"])
        for r in early_stop_trace(df, rule, buckets).collect()
    }
    assert got == trace
    if not summary:
        return
    got = {
        r["run_id"]: (r["n_steps"], r["best_step"], r["score"], r["counter"], r["stopped"])
        for r in early_stop(df, rule, buckets).collect()
    }
    assert got == ends
    rows = improvements(df, rule, buckets).collect()
    assert sorted((r["run_id"], r["step"], r["score"]) for r in rows) == sorted(better)
    sign = -1 if rule.mode == "min" else 1
    assert all(r["val_loss"] == sign * r["score"] for r in rows)


EDGE = {
    1: [5.0, 4.8, 4.6, 4.4],  # by exactly delta, up to rounding
    2: [5, 4.9, 4.81, 4.75, 4.5],
    3: [1.0],
    4: [1, 2, 3, 4, 5, 0.5, 6, 7, 8, 9],
    5: [3, 3, 3, 3, 3, 3, 3],
    6: [9, 8, 7, 6, 5, 4, 3, 2, 1, 0, -1],
}


@pytest.mark.parametrize("rule, buckets, summary", [
    (Patience(3, 0.2), 4, True),
    (Patience(3, 0.2), 1, False),
    (Patience(2, 0.0), 4, False),
    (Patience(3, 0.5, "max"), 3, False),
    (Patience(0, 0.2), 2, False),
    (Patience(100, 1.0), 1, False),
])
def test_edge_cases(spark, rule, buckets, summary):
    check(spark, EDGE, rule, buckets, summary)


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    runs=st.dictionaries(
        st.integers(-5, 5), st.lists(st.integers(0, 12), min_size=1, max_size=25), min_size=1, max_size=4
    ),
    patience=st.integers(1, 4),
    delta=st.sampled_from([0.0, 1.0, 2.5]),
)
def test_fold_property(spark, runs, patience, delta):
    check(spark, runs, Patience(patience, delta), 5, summary=False)


@pytest.mark.parametrize("delta", [0.0, 0.2, 1.5])
def test_ways_by_doubling(spark, monkeypatch, delta):
    """With no few ways that are followed at once, and runs over many buckets."""
    monkeypatch.setattr("tokenmill.operators.earlystop.FEW_WAYS", 0)
    rng = random.Random(3)
    runs = {
        1: [10 - i * 0.01 for i in range(700)],
        2: [rng.random() * 10 - i * 0.01 for i in range(600)],
        3: [5.0] * 200 + [1.0] * 10,
        4: [2.0],
    }
    check(spark, runs, Patience(20, delta), 11, summary=False)


def test_a_run_with_most_of_the_rows_is_spread_over_buckets(spark):
    rng = random.Random(7)
    hot = [rng.random() * 10 for _ in range(3000)]
    falling = [10 - i * 0.001 for i in range(2000)]
    runs = {1: [1.0, 2.0], 2: hot, 3: falling, 4: [4.0]}
    check(spark, runs, Patience(30, 0.2), 9, summary=False)
    from tokenmill.operators.ordering import RowOrder

    df = series(spark, runs)
    order = RowOrder.fit(df, ["run_id", "step"], 9)
    spread = order.with_bucket(df.where("run_id = 2")).groupBy("bucket").count().collect()
    assert len(spread) >= 4 and max(r["count"] for r in spread) < 1500


def test_rules_are_checked():
    with pytest.raises(ValueError):
        Patience(mode="best")
    with pytest.raises(ValueError):
        Patience(delta=-1)


def test_rank_means_count_the_same(spark):
    rows = [(0, 0, 1.0), (0, 0, 3.0), (0, 0, 5.0), (0, 1, 10.0), (1, 0, 2.0)]
    df = spark.createDataFrame(rows, "step bigint, rank int, loss double")
    got = {r["step"]: (r["loss"], r["n_ranks"]) for r in metrics.loss_by_step(df).collect()}
    assert got == {0: (6.5, 2), 1: (2.0, 1)}


def test_throughput(spark):
    df = spark.createDataFrame(
        [(1, 0, 500.0, 1000), (1, 1, 1500.0, 1000)], "run_id bigint, step bigint, dt_ms double, tokens bigint"
    )
    assert tuple(metrics.throughput(df).first()) == (1, 2000, 2.0, 1000.0)
    by_step = metrics.throughput(df, ["step"]).orderBy("step").collect()
    assert [r["tokens_per_second"] for r in by_step] == pytest.approx([2000.0, 1000 / 1.5])


def test_log_lines_have_the_documented_form(spark):
    df = spark.range(1).select(
        runlog.run_line(F.lit(7), F.lit(3.25), F.lit(1.5), F.lit(6e-4), F.lit(12.345), F.lit(524288)),
        runlog.validation_line(F.lit(20), F.lit(2.0)),
    )
    line, val = df.first()
    assert line == (
        "INFO(master process): | step: 7 | loss: 3.25 | norm: 1.5000 | lr 6.0000e-04 "
        "| dt: 12.35ms | tok/sec: 524288.00"
    )
    assert val == "Step: 20, val_loss: 2.0000"


def test_log_parsing_keeps_malformed_lines_apart(spark, tmp_path):
    path = str(tmp_path / "log")
    lines = [
        "INFO(master process): | step: 7 | loss: 3.25e-05 | norm: 1.5000 | lr 6.0000e-04 | dt: 500.00ms | tok/sec: 524288.00",
        "INFO(master process): | step: 8 | loss: nan | norm: 1.5000 | lr 6.0000e-04 | dt: 0.00ms | tok/sec: 1.00",
        "INFO(master process): | step: 9 | loss: | norm",
        "Step: 20, val_loss: 2.1234",
        "",
        "noise",
    ]
    runlog.append_lines(spark.createDataFrame([(x,) for x in lines[:3]], "x string"), path)
    runlog.append_lines(spark.createDataFrame([(x,) for x in lines[3:]], "x string"), path)
    read = runlog.read_lines(spark, path)
    rows = {r["step"]: r for r in runlog.parse_run_log(read).collect()}
    assert set(rows) == {7, 8}
    assert rows[7]["loss"] == 3.25e-05 and rows[7]["tokens_per_second"] == 524288 / 0.5
    assert rows[8]["loss"] != rows[8]["loss"] and rows[8]["tokens_per_second"] is None
    assert [tuple(r) for r in runlog.parse_validation_log(read).collect()] == [(20, 2.1234)]
    assert sorted(r[0] for r in runlog.malformed(read).collect()) == sorted([lines[2], "noise"])


def test_gates(spark):
    due = spark.range(100).where(steps.is_due(F.col("id"), 20, 95))
    assert [r["id"] for r in due.orderBy("id").collect()] == [20, 40, 60, 80, 94]
    watched = spark.range(95).where(steps.is_monitored(F.col("id"), 20, 40, 95))
    assert [r["id"] for r in watched.orderBy("id").collect()] == [40, 80, 94]


def test_losses_that_are_not_numbers_are_refused(spark):
    for buckets in (1, 3):
        with pytest.raises(Exception, match="not a number"):
            early_stop(series(spark, {1: [1.0, float("nan"), 0.9]}), Patience(2), buckets).collect()
