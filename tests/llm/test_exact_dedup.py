import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from tokenmill.llm import exact_dedup
from tokenmill.llm.exact_dedup import ExactDedup, FilterSettings, second_plane

SPACE = re.compile("[\x20\x09-\x0d]")


def model(rows):
    """``(doc_id, keep_id, group_size, kept, digest)`` by a dictionary of squeezed texts."""
    groups = defaultdict(list)
    for at, row in enumerate(rows):
        text = row["text"] or ""
        digest = hashlib.sha256(SPACE.sub("", text).encode()).hexdigest()
        number = row["doc_id"]
        groups[digest].append((-len(text), number is None, number or 0, at, number))
    found = []
    for digest, members in groups.items():
        best = min(members)
        found += [(m[4], best[4], len(members), m == best, digest) for m in members]
    return sorted(found, key=repr)


def reported(dedup):
    rows = dedup.report().collect()
    return sorted(
        ((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in rows), key=repr
    )


def test_sample_equals_the_model(spark, sample):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    assert reported(ExactDedup(docs)) == model(sample)


def test_odd_rows(odd):
    dedup = ExactDedup(odd.coalesce(1))
    rows = [r.asDict() for r in odd.coalesce(1).collect()]
    assert reported(dedup) == model(rows)
    kept = dedup.deduplicated()
    assert kept.columns == odd.columns
    assert kept.count() == len({r[4] for r in model(rows)})


def test_empty_table(empty):
    dedup = ExactDedup(empty)
    assert dedup.report().collect() == []
    assert dedup.deduplicated().collect() == []


def test_the_longest_row_stays(spark):
    rows = [(9, "a b"), (3, "ab"), (4, "a  b"), (2, "a\tb\n"), (1, "b a"), (None, "a b  ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = ExactDedup(docs).report().collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in found} == {
        (9, None, 5, False),
        (3, None, 5, False),
        (4, None, 5, False),
        (2, None, 5, False),
        (None, None, 5, True),
        (1, 1, 1, True),
    }


def test_other_white_space_counts(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "a\x1fb")], "doc_id long, text string")
    assert all(r.kept for r in ExactDedup(docs).report().collect())


def test_columns_with_the_names_of_inner_ones(spark):
    names = ("row", "hash", "digest", "maybe", "document", "length", "segment", "a.b")
    rows = [(i, "same" if i % 2 else f"text {i}", *[i] * len(names)) for i in range(20)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    kept = ExactDedup(docs).deduplicated()
    assert kept.columns == docs.columns
    assert {tuple(r) for r in kept.collect()} == {r for r in rows if r[0] % 2 == 0 or r[0] == 1}


def test_many_segments_in_slices(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BLOCK_ROWS", 100)
    rows = [(i, f"text {i % 700 if i % 3 else 'hot'}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    settings = FilterSettings(bits_per_row=1 << 12, slice_segments=3)
    dedup = ExactDedup(docs, settings)
    assert dedup.segments == 12
    named = [{"doc_id": i, "text": t} for i, t in rows]
    assert reported(dedup) == model(named)
    assert dedup.deduplicated().count() == len({t for _, t in rows})


def test_unique_texts_pass_the_filter(spark):
    rows = [(i, f"text {i // 2 if i < 2000 else i}") for i in range(22_000)]
    dedup = ExactDedup(spark.createDataFrame(rows, "doc_id long, text string"))
    maybe = dedup.tested(dedup.digests).where("maybe").select("doc_id").collect()
    assert {r.doc_id for r in maybe} >= set(range(2000))
    assert len(maybe) < 2200


@pytest.mark.parametrize("seed", range(5))
def test_a_repeated_hash_is_always_in_the_second_plane(seed):
    draws = np.random.default_rng(seed)
    hashes = draws.integers(0, 2**63, 400, dtype=np.uint64)
    rows = draws.choice(hashes, 600)
    parts = []
    for block in np.array_split(rows, 9):
        once, counts = np.unique(block, return_counts=True)
        parts.append((once.tobytes(), once[counts > 1].tobytes()))
    plane = second_plane(iter(parts))
    again, counts = np.unique(rows, return_counts=True)
    one, two = exact_dedup.bits_of(again[counts > 1])
    assert plane[one].all() and plane[two].all()
