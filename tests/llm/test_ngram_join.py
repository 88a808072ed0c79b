import random
import re
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import DOC_SCHEMA, ODD_ROWS, SF_DIR

from tokenmill.llm import components as contraction
from tokenmill.llm import ngram_join, queries, tables
from tokenmill.llm.components import components, forest
from tokenmill.llm.ngram_join import JoinSettings, NgramJoin, need, prefix_length


def shingle_set(text, width=5):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(
        tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))
    )


def connected(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def brute(rows):
    """``(doc_id, n_shingles, component_id)`` by comparing all pairs of different sets."""
    sets = [shingle_set(text) for _, text in rows]
    classes = {}
    for i, s in enumerate(sets):
        if s:
            classes.setdefault(s, []).append(i)
    links = [(own[0], i) for own in classes.values() for i in own[1:]]
    for a, b in combinations(classes, 2):
        if 100 * len(a & b) >= 75 * len(a | b):
            links.append((classes[a][0], classes[b][0]))
    root = connected(range(len(rows)), links)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root[i]] = min(least.get(root[i], doc_id), doc_id)
    return sorted(
        ((d, len(s), least.get(root[i])) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))),
        key=str,
    )


def result(spark, rows, parts=4):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    found = NgramJoin(docs).groups().select("doc_id", "n", "component_id")
    return sorted(map(tuple, found.collect()), key=str)


def near_copies(draws, words, edits):
    words = list(words)
    for _ in range(edits):
        words[draws.randrange(len(words))] = f"new{draws.randrange(10**6)}"
    return " ".join(words)


def made_rows(seed=3):
    """Groups of copies, chains of edits, a passage that many texts share, and odd rows."""
    draws = random.Random(seed)
    word = lambda: f"w{draws.randrange(4000)}"
    rows, at = [(r[0], r[1]) for r in ODD_ROWS], 100
    passage = [word() for _ in range(60)]
    for size in (2, 5, 90):
        base = [word() for _ in range(120)]
        for _ in range(size):
            rows.append((at, near_copies(draws, base, draws.choice([0, 1, 2, 4, 6]))))
            at += 1
    chain = [word() for _ in range(150)]
    for i in range(30):
        chain[5 * i : 5 * i + 4] = [word() for _ in range(4)]
        rows.append((at, " ".join(chain)))
        at += 1
    for _ in range(80):
        own = [word() for _ in range(draws.choice([8, 15, 25, 60]))]
        rows.append((at, " ".join(own + passage)))
        at += 1
    for _ in range(40):
        rows.append((at, " ".join(word() for _ in range(draws.randint(1, 90)))))
        at += 1
    rows += draws.sample(rows, 20)
    draws.shuffle(rows)
    return rows


def test_brute_force(spark):
    rows = made_rows()
    assert result(spark, rows) == brute(rows)


def test_shuffled_joins_and_small_units(spark, monkeypatch):
    """The ways that large tables take: no broadcast, several units a task, more rounds."""
    monkeypatch.setattr(tables.small_or_shuffled, "__defaults__", (0,))
    monkeypatch.setattr(ngram_join, "BUCKET_ROWS", 500)
    rows = made_rows(4)
    assert result(spark, rows) == brute(rows)


def test_sample(spark, sample):
    rows = [(r["doc_id"], r["text"]) for r in sample]
    got = queries.op9_ngram_jaccard_join(spark, SF_DIR).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_empty_and_extra_columns(spark, odd, empty):
    assert NgramJoin(empty).groups().count() == 0
    got = NgramJoin(odd).groups().select("doc_id", "n", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute([(r[0], r[1]) for r in ODD_ROWS])
    assert set(DOC_SCHEMA) and len(got) == len(ODD_ROWS)


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_one_row_of_each_component(spark, monkeypatch, broadcast):
    """Equal and null doc_ids: near copies go, other texts of a kept doc_id's component too."""
    monkeypatch.setattr(tables.small_or_shuffled, "__defaults__", (broadcast,))
    draws = random.Random(8)
    text = lambda: " ".join(f"w{draws.randrange(10**6)}" for _ in range(60))
    near = lambda t, n=0: f"{t} more words {n}"
    twins, five, other, gone, nulls, mixed, lone, copied = (text() for _ in range(8))
    rows = [
        (1, twins), (1, near(twins)), (1, near(twins, 1)),  # near copies of one doc_id
        (3, other), (5, near(other)), (5, five),  # doc_id 5 is kept for its other text alone
        (5, near(five)),
        (None, nulls), (None, near(nulls)), (None, lone),  # no doc_id at all
        (None, mixed), (9, near(mixed)),  # the row with a doc_id stays
        (7, gone), (7, text()), (6, near(gone)),
        (11, copied), (11, copied), (12, copied),
        (1, ""), (None, None), (None, " "), (5, None),
    ]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, at int")
    kept = [tuple(r) for r in NgramJoin(df.repartition(5)).one_of_each().collect()]
    assert {rows[at] for *_, at in kept} == {r[:2] for r in kept}
    groups = [{0, 1, 2}, {3}, {5, 6}, {7, 8}, {9}, {11}, {13}, {14}, {15, 16}, {18}, {19}, {20}, {21}]
    at = sorted(r[2] for r in kept)
    assert len(at) == len(groups)
    assert all(len(own & set(at)) == 1 for own in groups)
    again = NgramJoin(df.repartition(2)).one_of_each().collect()
    assert sorted(r[2] for r in again) == at


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 60), min_size=1), st.sets(st.integers(0, 60), min_size=1))
def test_long_prefixes_share_what_they_ask_for(one, two):
    if 100 * len(one & two) < 75 * len(one | two):
        return
    rules = JoinSettings()
    cut = [set(sorted(s)[: prefix_length(len(s), rules)]) for s in (one, two)]
    for own, n in zip(cut, (len(one), len(two)), strict=True):
        assert len(cut[0] & cut[1]) >= 1 + rules.extra * need(n, 75) // 100
        assert len(own) <= n


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=25))
def test_forest_keeps_components(links):
    a, b = (np.array(x, np.int64) for x in zip(*links, strict=True))
    made = list(zip(*(x.tolist() for x in forest(a, b)), strict=True))
    nodes = {x for link in links for x in link}
    assert connected(nodes, made) == connected(nodes, links)
    assert len(made) < len(nodes)


@pytest.mark.parametrize("tail", [0, 40, 20_000])
@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_components(spark, monkeypatch, kind, tail):
    monkeypatch.setattr(contraction, "TAIL_LINKS", tail)
    draws = random.Random(2)
    links = {
        "chain": [(i, i + 1) for i in range(300)],
        "star": [(150, i) for i in range(300)],
        "random": [(draws.randrange(400), draws.randrange(400)) for _ in range(220)],
    }[kind]
    df = spark.createDataFrame([*links, (None, 3), (9000, 9000)], "a long, b long").repartition(6)
    got = {r["node"]: r["component"] for r in components(df).collect()}
    nodes = {x for link in links for x in link} | {9000}
    assert got == connected(nodes, links)
    assert components(df.where("a < -1")).count() == 0


def test_a_pair_that_shares_many_shingles_is_made_once(spark, monkeypatch):
    """Loose copies are not connected by the first turn and share dozens of shingles each."""
    draw = random.Random(5)
    base = [f"w{i}" for i in range(160)]
    rows = []
    for i in range(40):
        words = list(base)
        for at in draw.sample(range(160), 4):
            words[at] = f"x{draw.randrange(10**9)}"
        rows.append((i, " ".join(words)))
    made = []
    plain = NgramJoin.open_pairs

    def counted(self, *given):
        pairs = plain(self, *given)
        made.append((pairs.count(), pairs.distinct().count()))
        return pairs

    monkeypatch.setattr(NgramJoin, "open_pairs", counted)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = [tuple(r) for r in NgramJoin(docs).groups().drop("row").collect()]
    assert sorted(found, key=str) == brute(rows)
    total = sum(rows for rows, _ in made)
    assert sum(pairs for _, pairs in made) > 100
    assert total < 1.5 * sum(pairs for _, pairs in made)
