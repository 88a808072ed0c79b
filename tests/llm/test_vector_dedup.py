import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from tests.llm.test_ngram_join import connected

from tokenmill.llm import queries, vector_dedup
from tokenmill.llm.vector_dedup import PassSettings, VectorDedup, passes_for

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n_links int"


def brute(rows, least=0.93):
    """``(vec_id, n_links, component_id, kept)`` by comparing all pairs."""
    good = []
    for i, (_, v, label) in enumerate(rows):
        ok = label is not None and v and all(x is not None and math.isfinite(x) for x in v)
        if ok and any(v):
            x = np.array(v, np.float32).astype(float)
            good.append((i, label, x / np.linalg.norm(x)))
    links, pairs = [0] * len(rows), []
    for a, (i, label, x) in enumerate(good):
        for j, other, y in good[a + 1 :]:
            if label == other and len(x) == len(y) and x @ y >= least:
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    root = connected(range(len(rows)), pairs)
    low = {}
    for i, r in enumerate(rows):
        low[root[i]] = min(low.get(root[i], r[0]), r[0])
    return sorted((r[0], links[i], low[root[i]], r[0] == low[root[i]]) for i, r in enumerate(rows))


def made(seed=1):
    draws = np.random.default_rng(seed)
    near = lambda v, s: (v + s * draws.standard_normal(len(v))).astype(np.float32).tolist()
    rows = [(i, draws.standard_normal(16).astype(np.float32).tolist(), i % 3) for i in range(150)]
    for size, spread in ((2, 0.05), (9, 0.15), (160, 0.12)):
        base = draws.standard_normal(16)
        rows += [(1000 + len(rows), near(base, spread), 1) for _ in range(size)]
    rows += [(2000 + i, rows[i][1], 2) for i in range(20)]
    rows += rows[:6]
    rows += [
        (3000, None, 1), (3001, rows[0][1], None), (3002, [0.0] * 16, 1), (3003, [1.0, None], 1),
        (3004, [float("nan")] * 16, 1), (3005, [float("inf")] + [1.0] * 15, 1), (3006, [], 1),
        (3007, [1.0, 2.0], 1), (3008, [2.0, 4.0], 1), (3009, [3e38, 3e38], 1), (3010, [1e-30, 1e-30], 1),
    ]
    return rows


def result(spark, rows):
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, VectorDedup(df).report().collect()))


@pytest.mark.parametrize("block", [1024, 20])
def test_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vector_dedup, "BLOCK_ROWS", block)
    rows = made()
    assert result(spark, rows) == brute(rows)


def test_empty(spark):
    assert VectorDedup(spark.createDataFrame([], SCHEMA)).report().count() == 0


def unit(rows):
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def test_passes_grow_slowly_with_rows_and_with_density():
    draws = np.random.default_rng(0)
    sample = unit(draws.standard_normal((500, 64)))
    mean = sample.mean(axis=0)
    found = [passes_for(sample, mean, n, PassSettings()) for n in (500, 10**4, 10**6, 10**9)]
    assert found == sorted(found) and found[0] <= 10 and found[-1] < 400
    dense = unit(draws.standard_normal((500, 64)) * 0.5 + 8 * sample[:1])
    assert passes_for(dense, dense.mean(axis=0), 10**4, PassSettings()) > 2 * found[1]
    assert passes_for(sample[:0], np.zeros(64), 0, PassSettings()) == 4


def planted(rows, partners, density, seed=2):
    """Vectors of one label around one direction, some with a partner at a cosine near 0.94."""
    draws = np.random.default_rng(seed)
    base = unit(draws.standard_normal((1, 64)))
    own = unit(draws.standard_normal((rows, 64)))
    own = unit(own - (own @ base.T) * base)
    found = unit(np.sqrt(density) * base + np.sqrt(1 - density) * own)
    away = unit(draws.standard_normal((partners, 64)))
    away = unit(away - (away * found[:partners]).sum(axis=1)[:, None] * found[:partners])
    near = 0.94 * found[:partners] + np.sqrt(1 - 0.94**2) * away
    return np.concatenate([found, near])


@pytest.mark.parametrize("rows, partners", [(4000, 300), (600, 100)])
def test_recall_in_a_dense_label(spark, rows, partners):
    vectors = planted(rows, partners, 0.8)
    gram = vectors @ vectors.T
    assert np.median(gram) > 0.7
    np.fill_diagonal(gram, 0)
    want = (gram >= 0.93).sum(axis=1)
    table = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in VectorDedup(df).report().collect()}
    found = sum(got.values())
    assert all(got[i] <= want[i] for i in got)
    assert found >= 0.995 * want.sum() and want.sum() >= 2 * partners


def test_doubles_are_not_narrowed(spark):
    """Cosines on both sides of the least one that single precision cannot tell apart."""
    angle = math.acos(0.93)
    rows = [
        (1, [1.0, 0.0], 1), (2, [math.cos(angle - 1e-9), math.sin(angle - 1e-9)], 1),
        (3, [1.0, 0.0], 2), (4, [math.cos(angle + 1e-9), math.sin(angle + 1e-9)], 2),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert {r.vec_id: r.n_links for r in VectorDedup(df).report().collect()} == {1: 1, 2: 1, 3: 0, 4: 0}


@pytest.mark.parametrize("parts", ["1", "400"])
def test_the_result_does_not_depend_on_partitions(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = made()
        assert result(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_recall_on_the_larger_sample(spark):
    path = "/root/testdata/sf0.1"
    rows = [
        (r["vec_id"], r["embedding"], r["label"])
        for r in pq.read_table(f"{path}/embeddings.parquet").to_pylist()
    ]
    want = {r[0]: r for r in brute(rows)}
    got = {r["vec_id"]: tuple(r) for r in queries.op1_sorted_projection_dedup(spark, path).collect()}
    total = sum(r[1] for r in want.values())
    assert all(got[k][1] <= want[k][1] for k in want)
    assert sum(r[1] for r in got.values()) >= 0.97 * total
