import hashlib
import re

from tests.llm.conftest import ODD_ROWS, SF_DIR

from tokenmill.llm import contamination, queries, tables
from tokenmill.llm.contamination import Hits

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return WORD.findall(lower)


def brute(docs, items, width=10):
    grams = {}
    for item, text in items:
        w = split(text)
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[i : i + n]), set()).add(item)
    rows = []
    for doc_id, text in docs:
        w, hit, found = split(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if (gram := tuple(w[i : i + n])) in grams:
                    hit |= set(range(i, i + n))
                    found |= grams[gram]
        names = ",".join(sorted(str(x) for x in found if x is not None))
        rows.append(
            (doc_id, len(w), len(hit), len(found - {None}),
             hashlib.sha256(names.encode()).hexdigest(), len(hit) > 0)
        )
    return sorted(rows, key=str)


ITEMS = [
    (1, "One two, three"),
    (2, "two three"),
    (30, "x y z a b c d e f g h i j"),
    (31, "b c d e f g h i j k l"),
    (None, "number at ALL"),
    (5, None),
    (6, "... !"),
    (7, "two three"),
]
TEXTS = [
    (20, "Say: one TWO three, x y z a b c d e f g h i j k l m. End"),
    (21, "x y z a b c d e f g"),
    (22, "x y z a b c d e f"),
    (23, "two three two three two"),
    (24, "clean words only"),
]


def report(hits):
    from pyspark.sql import functions as F

    joined = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    rows = hits.report().select("doc_id", "n_words", "n_hit", "n_items", joined, "contaminated")
    return sorted(map(tuple, rows.collect()), key=str)


def fixtures(spark, odd):
    docs = odd.select("doc_id", "text", "score").unionByName(
        spark.createDataFrame([(*t, 1.0) for t in TEXTS], "doc_id long, text string, score double")
    )
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


def test_brute_force(spark, odd, monkeypatch):
    docs, items = fixtures(spark, odd)
    want = brute([(r[0], r[1]) for r in ODD_ROWS] + TEXTS, ITEMS)
    assert report(Hits(docs, items)) == want
    monkeypatch.setattr(tables, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(tables.small_or_shuffled, "__defaults__", (0,))
    assert report(Hits(docs, items)) == want


def test_removals(spark, odd):
    docs, items = fixtures(spark, odd)
    hits = Hits(docs, items)
    clean = hits.clean_documents()
    assert clean.columns == docs.columns
    want = {(r[0], r[1]) for r in ODD_ROWS + TEXTS if not brute([(r[0], r[1])], ITEMS)[0][5]}
    assert {(r["doc_id"], r["text"]) for r in clean.collect()} == want
    cut = {r["doc_id"]: r["text"] for r in hits.without_spans().collect() if r["doc_id"] != 5}
    assert cut[20] == "Say: m. End"
    assert cut[21] == "" and cut[22] == "x y z a b c d e f" and cut[23] == "two"
    assert cut[1] is None and cut[2] == "" and cut[24] == "clean words only"


def test_empty_tables(spark, odd, empty):
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert not any(r[5] for r in report(Hits(odd, no_items)))
    assert Hits(odd, no_items).clean_documents().count() == len(ODD_ROWS)
    _, items = fixtures(spark, odd)
    assert report(Hits(empty, items)) == []


def test_sample(spark, sample):
    import pyarrow.parquet as pq

    items = pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pylist()
    want = brute([(r["doc_id"], r["text"]) for r in sample], [(r["item_id"], r["text"]) for r in items])
    got = queries.op4_decontaminate(spark, SF_DIR)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert contamination.WIDTH == 10
