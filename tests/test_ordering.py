import random

import pytest
from models import shuffles
from pyspark.sql import functions as F

from tokenmill.operators.ordering import RowOrder, inside_total, totals_by_bucket, with_base
from tokenmill.operators.splits import positional_split


def shuffled(spark, keys, schema):
    keys = list(keys)
    random.Random(1).shuffle(keys)
    return spark.createDataFrame(keys, schema)


@pytest.mark.parametrize("buckets", [1, 3, 60])
def test_ordinals_follow_a_numeric_key(spark, buckets):
    df = shuffled(spark, [(3 * i - 500,) for i in range(1000)], "k bigint")
    order = RowOrder.fit(df, "k", buckets)
    rows = order.with_ordinal(df).collect()
    assert sorted((r["k"], r["ord"]) for r in rows) == [(3 * i - 500, i) for i in range(1000)]
    assert len({r["bucket"] for r in rows}) == buckets


@pytest.mark.parametrize("buckets", [5, 40])
def test_ordinals_follow_a_composite_key(spark, buckets):
    keys = sorted((f"é{i % 7}", i) for i in range(400))
    df = shuffled(spark, keys, "name string, n int")
    order = RowOrder.fit(df, ["name", "n"], buckets)
    rows = order.with_ordinal(df).collect()
    assert sorted((r["ord"], (r["name"], r["n"])) for r in rows) == list(enumerate(keys))


def test_buckets_are_of_similar_size(spark):
    df = spark.range(20_000).select((F.col("id") * F.col("id")).alias("k"))
    order = RowOrder.fit(df, "k", 8)
    sizes = [b - a for a, b in zip(order.bases, [*order.bases[1:], order.n_rows])]
    assert max(sizes) < 2 * 20_000 / 8


def test_realigned_buckets_start_at_multiples(spark):
    df = shuffled(spark, [(i,) for i in range(1003)], "k bigint")
    order = RowOrder.fit(df, "k", 6).realign(df, 100, also=[900])
    assert all(base % 100 == 0 for base in order.bases)
    assert 900 in order.bases
    rows = order.with_ordinal(df).collect()
    assert all(r["k"] == r["ord"] for r in rows)
    per_chunk = {}
    for r in rows:
        per_chunk.setdefault(r["ord"] // 100, set()).add(r["bucket"])
    assert all(len(found) == 1 for found in per_chunk.values())
    first = order.head(900)
    assert first.n_rows == 900 and max(first.bases) < 900


def test_before_is_a_key_filter_that_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).withColumnRenamed("id", "k").write.parquet(path)
    df = spark.read.parquet(path)
    order = RowOrder.fit(df, "k", 4)
    kept = df.where(order.before(df, 137))
    assert sorted(r["k"] for r in kept.collect()) == list(range(137))
    plan = kept._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(k), LessThan(k,137)]" in plan
    assert df.where(order.before(df, 0)).count() == 0
    assert df.where(order.before(df, 1000)).count() == 1000


def test_running_totals(spark):
    df = shuffled(spark, [(i, (i * 7) % 5) for i in range(500)], "k bigint, v bigint")
    order = RowOrder.fit(df, "k", 4)
    placed = order.with_ordinal(df)
    totals = totals_by_bucket(placed, "v", order.n_buckets)
    summed = with_base(placed.withColumn("inside", inside_total("v")), totals, "base", 10)
    summed = summed.withColumn("offset", F.col("base") + F.col("inside"))
    expected, total = {}, 10
    for i in range(500):
        expected[i] = total
        total += (i * 7) % 5
    assert {r["k"]: r["offset"] for r in summed.collect()} == expected


def test_no_exchange_into_a_single_partition(spark):
    df = shuffled(spark, [(i,) for i in range(500)], "k bigint")
    order = RowOrder.fit(df, "k", 4)
    plan = order.with_ordinal(df)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and shuffles(plan) == 1


@pytest.mark.parametrize("n", [0, 1, 7, 130])
def test_split_sizes_are_truncated_and_the_rest_is_test(spark, n):
    df = shuffled(spark, [(i,) for i in range(n)], "doc_id bigint") if n else spark.range(
        0
    ).withColumnRenamed("id", "doc_id")
    rows = positional_split(df, "doc_id").collect()
    n_train, n_val = int(0.8 * n), int(0.15 * n)
    for r in rows:
        want = (
            "train_set" if r["doc_id"] < n_train
            else "val_set" if r["doc_id"] < n_train + n_val else "test_set"
        )
        assert r["split"] == want


def test_split_moves_no_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    plan = positional_split(df, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_null_and_repeated_keys_are_refused(spark):
    import pytest

    nulls = spark.createDataFrame([(1,), (None,), (2,)], "key long")
    with pytest.raises(ValueError, match="no order key"):
        RowOrder.fit(nulls, "key")
    twice = spark.range(400).selectExpr("id div 2 as key")
    with pytest.raises(ValueError, match="not unique"):
        RowOrder.fit(twice, "key", 4)


def test_any_repeated_key_is_refused_wherever_it_lies(spark):
    keys = [(i,) for i in range(3000)] + [(1777,)]
    for buckets in (1, 4, 23):
        with pytest.raises(ValueError, match="1777.*more than once"):
            RowOrder.fit(shuffled(spark, keys, "k bigint"), "k", buckets)
    pairs = [("a", i % 50, i) for i in range(1000)]
    with pytest.raises(ValueError, match="not unique"):
        RowOrder.fit(shuffled(spark, pairs, "s string, a int, b int"), ["s", "a"], 5)
    assert RowOrder.fit(shuffled(spark, pairs, "s string, a int, b int"), ["s", "a", "b"]).n_rows == 1000
    with pytest.raises(ValueError, match="not unique"):
        positional_split(spark.range(1000).selectExpr("id div 2 as doc_id"), "doc_id")


def test_ranges_hold_about_the_same_bytes(spark):
    """A tenth of the rows at one end of the keys hold nearly all bytes."""
    df = spark.range(20_000).selectExpr("id as k", "if(id < 2000, 5000, 10) as n")
    order = RowOrder.fit(df, "k", weight=F.col("n"), range_bytes=200_000)
    total = 2000 * 5000 + 18_000 * 10
    assert 35 <= order.n_buckets <= (total + 20_000) // 200_000  # a row counts a byte more
    assert max(order.totals(df, F.col("n"))) < 1.7 * total / order.n_buckets
    by_rows = RowOrder.fit(df, "k", order.n_buckets)
    assert max(by_rows.totals(df, F.col("n"))) > 3 * total / order.n_buckets


def test_the_number_of_ranges_does_not_depend_on_the_shuffle_setting(spark):
    df = spark.range(50_000).selectExpr("id as k", "1000 as n")
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    order = RowOrder.fit(df, "k", weight=F.col("n"), range_bytes=1_000_000)
    assert order.n_buckets == 50
    rows = order.with_ordinal(df.select("k")).where("k <> ord").count()
    assert rows == 0
    assert order.keys_at(df, [0, 17, 49_999]) == {0: (0,), 17: (17,), 49_999: (49_999,)}


def test_one_heavy_row_gets_a_range_of_its_own(spark):
    df = spark.range(2000).selectExpr("id as k", "if(id = 1000, 1000000, 100) as n")
    order = RowOrder.fit(df, "k", 8, weight=F.col("n"))
    starts = [bound for (bound,) in order.bounds]
    assert any(900 <= start <= 1000 for start in starts)


@pytest.mark.parametrize("schema, key", [
    ("k timestamp", "timestamp_seconds(id * 977)"),
    ("k date", "date_add(date'2020-01-01', cast(id as int))"),
    ("k double", "id / 7 - 30"),
    ("k string", "format_string('%06d é', id)"),
    ("k decimal(20,3)", "cast(id / 8 as decimal(20,3))"),
    ("k binary", "encode(format_string('%06d', id), 'utf-8')"),
])
def test_key_types(spark, schema, key):
    df = spark.range(700).selectExpr("id", f"{key} as k")
    order = RowOrder.fit(df, "k", 5)
    assert order.n_buckets == 5
    assert order.with_ordinal(df).where("id <> ord").count() == 0


def test_schedule_comes_from_many_tasks(spark):
    from tokenmill.operators.schedule import batch_schedule

    manifest = spark.range(300).selectExpr("id as shard_id", "5000L as n_tokens")
    schedule = batch_schedule(manifest, 1, 8, 4, 50_000)
    sizes = schedule.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 200_000 and max(sizes) < 60_000


@pytest.mark.parametrize("tokens", [[9], [2_000_000], [9, 2_000_000]])
def test_one_shard_does_not_make_a_task(spark, tokens):
    """Many cycles over a tiny shard, and one huge shard."""
    from tokenmill.operators.schedule import batch_schedule

    manifest = spark.createDataFrame(list(enumerate(tokens)), "shard_id bigint, n_tokens bigint")
    schedule = batch_schedule(manifest, 1, 8, 1, 240_000)
    sizes = schedule.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 240_000 and max(sizes) < 120_000
    assert schedule.selectExpr("count(distinct i)", "min(i)", "max(i)").first() == (240_000, 0, 239_999)
