import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tokenmill.llm import periodic
from tokenmill.llm.periodic import (
    LongWords,
    PeriodicRuns,
    RunSettings,
    Words,
    fragments,
    words_of,
    z_function,
)
from tokenmill.llm.queries import op13_periodic_runs, with_planted_runs

WORD = re.compile("[^\x20\x09-\x0d]+")


def runs_of(words):
    """All runs ``(start, length, period)`` by trying every period."""
    stretches, n = [], len(words)
    for q in range(1, n // 3 + 1):
        start = 0
        while start < n - q:
            end = start
            while end < n - q and words[end] == words[end + q]:
                end += 1
            if end - start + q >= max(24, 3 * q):
                stretches.append((start, end - start + q, q))
            start = end + 1
    smallest = []
    for start, length, q in stretches:
        part = words[start : start + length]
        if not any(part[p:] == part[:-p] for p in range(1, q)):
            smallest.append((start, length, q))
    return sorted(smallest, key=lambda r: (r[0], r[2]))


def collapsed_of(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(draws, size):
    """Words with runs of all kinds of periods, nested and next to one another."""
    words = []
    while len(words) < size:
        kind = draws.random()
        alphabet = draws.choice([1, 2, 3, 50])
        part = [f"w{draws.randrange(alphabet)}" for _ in range(draws.choice([1, 2, 5, 9, 17, 40]))]
        if kind < 0.6:
            part = (part * draws.randrange(2, 12))[: draws.randrange(1, 160)]
        if kind < 0.2:
            part = part * draws.randrange(2, 5)
        words += part
    return words[:size]


def texts(count, seed=0):
    draws = random.Random(seed)
    gaps = [" ", "\n", "\t ", "\x0b"]
    found = []
    for i in range(count):
        words = repetitive(draws, draws.choice([3, 23, 24, 60, 300]))
        found.append("".join(draws.choice(gaps) + w for w in words) + (" " if i % 2 else ""))
    return found


@pytest.mark.parametrize("seed", range(40))
def test_fragments_hold_all_runs(seed, monkeypatch):
    monkeypatch.setattr(periodic, "TILE_COMPARISONS", random.Random(seed).choice([1, 40, 1 << 20]))
    words = repetitive(random.Random(seed), 400)
    found = fragments(words_of(" ".join(words)).codes(), RunSettings())
    got = sorted(
        ((a, b - a + q, q) for q, a, b in found if b - a + q >= max(24, 3 * q)),
        key=lambda r: (r[0], r[2]),
    )
    assert got == runs_of(words)


def test_one_word_and_long_periods():
    for words in (["a"] * 3000, [f"w{i % 997}" for i in range(3100)], ["a", "b"] * 500 + ["c"]):
        found = fragments(words_of(" ".join(words)).codes(), RunSettings())
        got = sorted((a, b - a + q, q) for q, a, b in found if b - a + q >= max(24, 3 * q))
        assert got == runs_of(words)


def test_z_function():
    draws = random.Random(2)
    for _ in range(50):
        values = [draws.randrange(2) for _ in range(30)]
        slow = [
            next((k for k in range(30 - i) if values[k] != values[i + k]), 30 - i) for i in range(30)
        ]
        assert z_function(values) == slow


@pytest.mark.parametrize("kind", [Words, LongWords])
def test_words_are_those_of_the_contract(kind):
    text = " é\x0b日本 x y \x1f  \n end"
    words = kind(text.encode())
    assert len(words) == len(WORD.findall(text))
    assert words.without([]) == " ".join(WORD.findall(text))
    codes = kind(b"a b ab a  ab").codes()
    assert (codes == np.array([0, 1, 2, 0, 2])).all()
    assert kind(b"").without([]) == "" == kind(b" \n").without([])
    assert words_of(None).without([]) == ""
    runs = [(2, 9, 3), (8, 6, 1)]
    text = " \t".join("abcdefghijklmnopq")
    assert kind(text.encode()).without(runs) == collapsed_of(WORD.findall(text), runs)


def reported(docs, settings=RunSettings()):
    rows = PeriodicRuns(docs, settings).report().collect()
    return {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in rows}


def expected(rows):
    found = {}
    for number, text in rows:
        words = WORD.findall(text or "")
        runs = runs_of(words)
        found[number] = (len(words), runs, collapsed_of(words, runs))
    return found


@pytest.mark.parametrize("spread", [1 << 18, 30])
def test_texts_equal_the_model(spark, spread, monkeypatch):
    rows = list(enumerate(texts(60)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = reported(docs, RunSettings(spread_words=spread))
    assert found == expected(rows)


def test_tiles_of_long_documents_are_stitched(spark):
    words = ["x"] * 40 + [f"w{i % 700}" for i in range(9000)] + ["tail"]
    rows = [(1, " ".join(words)), (2, "a b c " * 4000), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = reported(docs, RunSettings(spread_words=100))
    assert found[1][1] == [(0, 40, 1), (40, 9000, 700)]
    assert found[2][1:] == ([(0, 12000, 3)], "a b c")
    assert found[3] == (0, [], "")


def test_odd_rows_and_columns(odd, empty):
    clash = odd
    for name in ("row", "kind", "runs", "document", "period", "collapsed"):
        clash = clash.selectExpr("*", f"'mine' as `{name}`")
    found = PeriodicRuns(clash).collapsed()
    assert found.columns == clash.columns
    want = sorted(
        collapsed_of(w := WORD.findall(r.text or ""), runs_of(w) if len(w) < 1000 else [(0, 5000, 1)])
        for r in odd.collect()
    )
    rows = found.collect()
    assert sorted(r.text for r in rows) == want
    assert all(r.runs == "mine" for r in rows)
    assert PeriodicRuns(clash).report().count() == odd.count()
    assert PeriodicRuns(empty).report().collect() == []


def test_query_on_the_sample(spark, sample):
    import hashlib

    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = set()
    for row in sample:
        words = WORD.findall(row["text"] or "")
        n = len(words)
        if n > 1500:
            continue  # the model tries every period
        h = zlib.crc32(str(row["doc_id"]).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = runs_of(words)
        top = [None] * 4
        if runs:
            start, length, q = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]))
            top = [start, length, q, 1000 * length // q]
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        want.add(
            (row["doc_id"], len(runs), *top, sha(listed), sha(collapsed_of(words, runs)))
        )
    got = {tuple(r) for r in op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert want <= got
    assert len(got) == len(sample)
    assert sum(r[1] > 0 for r in want) > 10


def test_planting_leaves_other_rows_alone(spark):
    rows = [(None, "a b"), (1, None), (2, "  x  y ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    planted = {r.doc_id: r.text for r in with_planted_runs(docs).collect()}
    for number, text in rows:
        if zlib.crc32(str(number).encode()) % 10 or number is None:
            assert planted[number] == text


def test_batches_come_back_in_small_parts():
    """What a task holds at once does not follow the size of the batches Spark sends."""
    whole = " ".join(f"w{i}" for i in range(3000))
    again = whole + " " + " ".join(["on", "off"] * 20)
    texts = [whole, again] * 200 + [None]
    numbers = pa.array(range(len(texts)), pa.int64())
    keys = pa.StructArray.from_arrays([numbers], ["doc_id"])
    batch = pa.RecordBatch.from_arrays(
        [numbers, pa.array(texts, pa.string()), keys], ["row", "text", "document"]
    )
    assert batch.nbytes > 5 << 20
    plain = list(periodic._without_runs(RunSettings())(iter([batch])))
    assert sum(len(part) for part in plain) == 201
    first = list(periodic._first_pass(RunSettings(), keys.type)(iter([batch])))
    assert max(part.nbytes for part in plain + first) < 2 << 20
    kinds = [kind for part in first for kind in part.column("kind").to_pylist()]
    assert kinds.count(periodic.DOCUMENT) == 200


def test_only_the_columns_asked_for_travel_with_a_text(spark):
    docs = spark.createDataFrame([(1, "a b", "much", 2.0)], "doc_id int, text string, b string, c double")
    found = PeriodicRuns(docs)
    assert found.report("doc_id").collect() == [(1, 2, [], "a b")]
    assert found.collapsed().collect() == [(1, "a b", "much", 2.0)]
    assert PeriodicRuns(docs.select("text")).collapsed().collect() == [("a b",)]
    sent = found._whole(["doc_id"]).schema
    assert sent["document"].dataType.names == ["doc_id"]
