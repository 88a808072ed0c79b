import zlib
from itertools import product

import numpy as np
from tests.llm.conftest import ODD_ROWS

from tokenmill.llm import queries
from tokenmill.llm.quality import (
    Chain,
    learn_quality,
    line_features,
    line_quality,
    marginals,
    with_quality,
)
from tokenmill.llm.text import blocks

SF_DIR = "/root/testdata/sf0.1"


def test_marginals_equal_sums_over_all_labellings():
    draws = np.random.default_rng(3)
    firsts = np.array([0, 3, 4, 9])
    scores, moves = draws.normal(size=(9, 2)), draws.normal(size=(2, 2))
    got, pairs = marginals(scores, moves, Chain(firsts))
    want, all_pairs = np.zeros((9, 2)), np.zeros((2, 2))
    for start, end in zip(firsts[:-1], firsts[1:], strict=True):
        total, own, own_pairs = 0.0, np.zeros((9, 2)), np.zeros((2, 2))
        for labels in product((0, 1), repeat=end - start):
            value = sum(scores[start + i, y] for i, y in enumerate(labels))
            value += sum(moves[a, b] for a, b in zip(labels, labels[1:], strict=False))
            weight = np.exp(value)
            total += weight
            for i, y in enumerate(labels):
                own[start + i, y] += weight
            for a, b in zip(labels, labels[1:], strict=False):
                own_pairs[a, b] += weight
        want += own / total
        all_pairs += own_pairs / total
    assert np.allclose(got, want) and np.allclose(pairs, all_pairs)


def test_lines_of_texts():
    import pyarrow as pa

    texts = ["a\nBB\n", "", None, "x", "\n\n"]
    (_, _, raw, offsets), = blocks(pa.array(texts, pa.string()))
    features, firsts, lengths = line_features(raw, offsets)
    assert np.diff(firsts).tolist() == [3, 1, 1, 1, 3]
    assert lengths.tolist() == [1, 2, 0, 0, 0, 1, 0, 0, 0]
    assert features[1, 2] == 1.0 and features[0, 2] == 0.0


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in queries.op6_line_crf_quality(spark, SF_DIR).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    for r in rows.values():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [(rows[k], q) for k, q in labels.items() if rows[k]["held_out"]]
    right = np.mean([r["predicted"] == q for r, q in held])
    good = np.mean([[r["score"] > s["score"] for s, p in held if p == 0] for r, q in held if q == 1])
    print("accuracy", right, "area", good)
    assert right >= 0.97 and good >= 0.97


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame(
        [(5, 1), (7, 0), (8, 1), (8, 0), (2, 1), (None, 0), (4, None), (77, 1)], "doc_id long, quality int"
    )
    model = learn_quality(odd, labels)
    rows = with_quality(odd, model).collect()
    assert len(rows) == len(ODD_ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert with_quality(empty, model).count() == 0
    lines = {r["doc_id"]: r["good"] for r in line_quality(odd, model).collect()}
    assert len(lines[3]) == 2 and len(lines[8]) == 1
    nothing = learn_quality(odd, labels.where("doc_id = 99"))
    assert {r["score"] for r in with_quality(odd, nothing).collect()} == {0.5}
