import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from models import Reader, shuffles
from pyspark.sql import functions as F

from tokenmill.functions import steps
from tokenmill.operators.schedule import batch_schedule, by_step, training_manifest
from tokenmill.plans.training import prompt_text, training_batches
from tokenmill.operators.windows import (
    next_token_pairs,
    random_prompt,
    rank_batches,
    token_windows,
    usable_batches,
)

PIECES = "split string, shard_id bigint, start bigint, n_tokens bigint, shard_tokens bigint, tokens array<int>"


def pieces_of(spark, shards, cuts):
    rows = []
    for shard_id, tokens in enumerate(shards):
        edges = sorted({0, len(tokens), *(c for c in cuts if 0 < c < len(tokens))})
        rows += [
            ("train_set", shard_id, a, b - a, len(tokens), tokens[a:b])
            for a, b in zip(edges, edges[1:])
        ]
    return spark.createDataFrame(rows, PIECES)


def model_windows(tokens, length):
    return [tokens[at : at + length + 1] for at in range(0, len(tokens) - length, length)]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    sizes=st.lists(st.integers(1, 60), min_size=1, max_size=3),
    cuts=st.sets(st.integers(1, 59), max_size=12),
    length=st.integers(1, 9),
)
def test_windows_property(spark, sizes, cuts, length):
    shards = [[100 * s + i for i in range(n)] for s, n in enumerate(sizes)]
    windows = token_windows(pieces_of(spark, shards, cuts), length).collect()
    found = sorted((r["shard_id"], r["window"], r["buffer"]) for r in windows)
    assert found == [
        (s, w, buffer)
        for s, tokens in enumerate(shards)
        for w, buffer in enumerate(model_windows(tokens, length))
    ]


def test_pairs_are_shifted_by_one(spark):
    shards = [list(range(10))]
    pairs = next_token_pairs(token_windows(pieces_of(spark, shards, {4}), 3), 3)
    rows = sorted((r["window"], r["x"], r["y"]) for r in pairs.collect())
    assert rows == [(0, [0, 1, 2], [1, 2, 3]), (1, [3, 4, 5], [4, 5, 6]), (2, [6, 7, 8], [7, 8, 9])]


def test_only_borders_of_pieces_are_shuffled(spark):
    windows = token_windows(pieces_of(spark, [list(range(50))], {20}), 4)
    plan = windows._jdf.queryExecution().executedPlan().toString()
    assert shuffles(plan) == 1


@pytest.mark.parametrize("ranks", [1, 3])
def test_rank_batches_equal_the_readers(spark, ranks):
    rows, length = 2, 3
    sizes = [60, 7, 41, 13]
    shards = [[1000 * s + i for i in range(n)] for s, n in enumerate(sizes)]
    windows = next_token_pairs(token_windows(pieces_of(spark, shards, {10, 11, 30}), length), length)
    found = {}
    for r in rank_batches(windows, rows, length, ranks).collect():
        found.setdefault((r["rank"], r["shard_id"], r["batch"]), {})[r["row"]] = r["x"]
    expected = {}
    for rank in range(ranks):
        usable = [i for i, n in enumerate(sizes) if n >= rows * length * (rank + 1) + 1]
        reader = Reader(sizes, rows, length, rank, ranks)
        seen = set()
        while (taken := reader.next()) not in seen:
            seen.add(taken)
            shard, pos = taken
            batch = (pos // (rows * length) - rank) // ranks
            buffer = shards[shard][pos : pos + rows * length]
            expected[rank, shard, batch] = {
                i: buffer[i * length : (i + 1) * length] for i in range(rows)
            }
        assert {s for _, s, _ in expected if _ is not None} >= set(usable[:1])
    assert found == expected


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    sizes=st.lists(st.integers(1, 120), min_size=1, max_size=6),
    rows=st.integers(1, 3),
    length=st.integers(1, 4),
    ranks=st.integers(1, 4),
    buckets=st.integers(1, 3),
)
def test_schedule_property(spark, sizes, rows, length, ranks, buckets):
    sizes = [*sizes, rows * length * ranks + 1]  # every rank finds at least one shard
    manifest = spark.createDataFrame(list(enumerate(sizes)), "shard_id bigint, n_tokens bigint")
    plan = batch_schedule(manifest, rows, length, ranks, 25, buckets).collect()
    found = {(r["rank"], r["i"]): (r["shard_id"], r["pos"]) for r in plan}
    assert len(found) == len(plan)
    expected = {}
    for rank in range(ranks):
        reader = Reader(sizes, rows, length, rank, ranks)
        for i in range(25):
            expected[rank, i] = reader.next()
    assert found == expected


@pytest.mark.parametrize("rank", [0, 1, 2])
def test_a_shard_too_short_by_one_is_left_out(spark, rank):
    edge = 4 * 32 * (rank + 1)
    df = spark.createDataFrame([(edge,), (edge + 1,)], "n bigint")
    counts = df.select("n", usable_batches(F.col("n"), F.lit(rank), 4, 32, 3).alias("k"))
    assert dict(map(tuple, counts.collect())) == {edge: 0, edge + 1: 1}


def test_a_split_without_shards_is_an_error(spark):
    empty = spark.createDataFrame([], "shard_id bigint, n_tokens bigint")
    with pytest.raises(ValueError, match="no shards"):
        batch_schedule(empty, 4, 32, 1, 5)


def test_steps_and_micro_batches(spark):
    manifest = spark.createDataFrame([(0, 1000)], "shard_id bigint, n_tokens bigint")
    rows = by_step(batch_schedule(manifest, 4, 8, 2, 12), 4).collect()
    assert sorted((r["rank"], r["step"], r["micro"]) for r in rows) == [
        (rank, i // 4, i % 4) for rank in range(2) for i in range(12)
    ]


def test_accumulation_needs_a_multiple():
    assert steps.accumulation_steps(524288, 4, 32, 1) == 4096
    with pytest.raises(ValueError, match="no multiple"):
        steps.accumulation_steps(1000, 4, 32, 1)


def test_training_manifest(spark):
    rows = training_manifest(spark, 30, 4, 32, 1, 524288).orderBy("step").collect()
    assert [r["step"] for r in rows if r["validate"]] == [20, 29]
    assert [r["step"] for r in rows if r["monitor"]] == [20, 29]
    assert [r["step"] for r in rows if r["last"]] == [29]
    assert rows[2]["tokens"] == 3 * 524288
    assert rows[0]["lr"] == pytest.approx(6e-4 / 715)


def test_learning_rate_knots(spark):
    df = spark.createDataFrame([(s,) for s in (714, 715, 9894, 19073, 19074)], "step bigint")
    rates = [r[0] for r in df.select(steps.learning_rate(F.col("step"))).collect()]
    assert rates == pytest.approx([6e-4, 6e-4, 3.3e-4, 6e-5, 6e-5])


def test_prompt_as_text(spark):
    shard = [256, *b"the quick brown fox jumps over the lazy dog", 9999]
    vocabulary = {bytes([b]): b for b in range(256)}
    texts = {prompt_text(pieces_of(spark, [shard], {9}), vocabulary, 5, 7, s).first()["text"] for s in range(4)}
    assert texts <= {"<|endoftext|>the qu", "ick bro", "wn fox ", "jumps o", "ver the"}


def test_training_batches(spark):
    rows = training_batches(pieces_of(spark, [list(range(30))], {9}), 2, 3, 2).collect()
    assert sorted((r["rank"], r["batch"], r["row"], r["x"][0]) for r in rows) == [
        (0, 0, 0, 0), (0, 0, 1, 3), (0, 1, 0, 12), (0, 1, 1, 15), (1, 0, 0, 6), (1, 0, 1, 9)
    ]


def test_prompt_is_one_of_the_first_rows(spark):
    pieces = pieces_of(spark, [list(range(100)), list(range(500, 600))], {20})
    drawn = [random_prompt(pieces, 0, 5, 7, seed).collect() for seed in range(4)]
    assert all(len(rows) == 1 and rows[0]["window"] < 5 for rows in drawn)
    assert all(r[0]["x"] == list(range(7 * r[0]["window"], 7 * r[0]["window"] + 7)) for r in drawn)
    assert len({rows[0]["window"] for rows in drawn}) > 1
    again = random_prompt(pieces, 0, 5, 7, 3).collect()
    assert again == drawn[3]
