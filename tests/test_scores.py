import math
import random

import pytest
from pyspark.sql import functions as F

from tokenmill.operators import scores

ROWS = {
    0: [0.1, -2.0, 3.5, 3.5],
    1: [1000.0, 999.0, -1000.0],
    2: [7.0],
    3: [float(i % 5) for i in range(40)],
}


def array_table(spark):
    return spark.createDataFrame([(k, v) for k, v in ROWS.items()], "pos int, score array<float>")


def long_table(spark):
    rows = [(k, i, x) for k, v in ROWS.items() for i, x in enumerate(v)]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "pos int, id int, score double")


def expected_softmax(values):
    top = max(values)
    exps = [math.exp(v - top) for v in values]
    return [e / sum(exps) for e in exps]


def test_softmax_in_both_layouts(spark):
    wide = array_table(spark).select("pos", scores.softmax(F.col("score")).alias("p")).collect()
    for r in wide:
        assert r["p"] == pytest.approx(expected_softmax(ROWS[r["pos"]]))
    for r in scores.softmax_long(long_table(spark)).collect():
        assert r["prob"] == pytest.approx(expected_softmax(ROWS[r["pos"]])[r["id"]])


def test_long_softmax_over_bands_and_hot_positions(spark):
    """Scores on both sides of a band's end, far apart, and one position with most rows."""
    rows = {
        0: [127.9, 128.0, 128.1, -3.0],
        1: [1e6, 1e6 - 0.5, -1e6],
        2: [-700.0, -701.0, -828.5],
        3: [(i * 37 % 1000) / 10 - 40 for i in range(20_000)],
    }
    table = spark.createDataFrame(
        [(k, i, x) for k, v in rows.items() for i, x in enumerate(v)], "pos int, id int, score double"
    ).repartition(6)
    found = scores.softmax_long(table)
    for r in found.where("pos < 3").collect():
        assert r["prob"] == pytest.approx(expected_softmax(rows[r["pos"]])[r["id"]], rel=1e-9)
    hot = found.where("pos = 3")
    assert hot.agg(F.sum("prob")).first()[0] == pytest.approx(1)
    want = expected_softmax(rows[3])
    assert hot.where("id = 77").first()["prob"] == pytest.approx(want[77], rel=1e-9)
    sums = scores.log_sum_exp_long(table)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in sums and "Window" not in sums and "partial_sum" in sums


def test_top_k_breaks_ties_by_id_and_takes_small_groups_whole(spark):
    best = scores.top_k(F.col("score").cast("array<double>"), 3)
    wide = {r["pos"]: [i["id"] for i in r["b"]] for r in array_table(spark).select("pos", best.alias("b")).collect()}
    assert wide == {0: [2, 3, 0], 1: [0, 1, 2], 2: [0], 3: [4, 9, 14]}
    ranked = scores.top_k_long(long_table(spark), value="score", k=3)
    found = {}
    for r in sorted(ranked.collect(), key=lambda r: r["rank_no"]):
        found.setdefault(r["pos"], []).append(r["id"])
    assert found == wide


def test_top_k_is_cut_before_the_shuffle(spark):
    plan = scores.top_k_long(long_table(spark), value="score", k=3)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


def test_cross_entropy(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], 2), ([1000.0, 0.0], 1)], "s array<float>, t int")
    got = [r[0] for r in df.select(scores.cross_entropy(F.col("s"), F.col("t"))).collect()]
    assert got == pytest.approx([math.log(sum(map(math.exp, [1, 2, 3]))) - 3, 1000.0])
    mean = scores.mean_cross_entropy(df, "s", "t").first()
    assert mean["loss"] == pytest.approx(sum(got) / 2) and mean["n_positions"] == 2


def test_draw_frequencies_follow_the_weights(spark):
    weights = [0.5, 0.3, 0.15, 0.05]
    n = 20_000
    items = F.array(*[F.struct(F.lit(w * 3).alias("prob"), F.lit(10 + i).alias("id")) for i, w in enumerate(weights)])
    drawn = spark.range(n).select(scores.draw(items, scores.unit_draw(42, "id"))["id"].alias("d"))
    counts = {r["d"]: r["count"] for r in drawn.groupBy("d").count().collect()}
    for i, w in enumerate(weights):
        assert abs(counts[10 + i] / n - w) < 5 * math.sqrt(w * (1 - w) / n)


def test_draws_repeat_and_depend_on_the_seed(spark):
    ranked = scores.top_k_long(scores.softmax_long(long_table(spark)), k=5)
    one = scores.draw_long(ranked, scores.unit_draw(1, "pos")).select("pos", "id")
    assert sorted(one.collect()) == sorted(one.collect())
    units = spark.range(100).select(scores.unit_draw(1, "id").alias("a"), scores.unit_draw(2, "id").alias("b"))
    rows = units.collect()
    assert all(0 <= r["a"] < 1 for r in rows) and any(r["a"] != r["b"] for r in rows)


def test_both_layouts_draw_the_same(spark):
    unit = scores.unit_draw(5, "pos")
    best = scores.top_k(scores.softmax(F.col("score")), 4)
    wide = array_table(spark).select("pos", scores.draw(best, unit)["id"].alias("id"))
    ranked = scores.top_k_long(scores.softmax_long(long_table(spark)), k=4)
    long = scores.draw_long(ranked, unit).select("pos", "id")
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, long.collect()))


def test_last_positions(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 9, "z")], "seq int, pos int, x string")
    assert sorted(map(tuple, scores.last_positions(df, "seq", "pos").collect())) == [(1, 3, "c"), (2, 9, "z")]
