import hashlib
import random
import re

from tests.llm.conftest import DOC_SCHEMA, ODD_ROWS, SF_DIR

from tokenmill.llm import queries
from tokenmill.llm.privacy import DisclosureSettings, Privacy

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = int(c) * (1 + place % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
        "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 10 <= len(digits) <= 15,
    }[kind]()


def base(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            if passes(kind, m.group()):
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [name for _, _, name in sorted(found)]


def check(rows, docs):
    """The base columns of the rows against Python's own matching."""
    assert len(rows) == len(docs)
    want = []
    for doc_id, text in docs:
        spans = base(text)
        counts = tuple(sum(s.startswith(k + ":") for s in spans) for k in PATTERNS)
        want.append((doc_id, *counts, hashlib.sha256(",".join(spans).encode()).hexdigest(), spans))
    got = []
    for r in rows:
        spans = [s for s in r["spans"].split(",") if s]
        counts = tuple(r[f"n_{k}"] for k in PATTERNS)
        own = [s for s in spans if not s.startswith("term:")]
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)
        got.append((r["doc_id"], *counts, r["base_sha256"], own))
    assert sorted(got, key=str) == sorted(want, key=str)


PARTS = [
    "a@b.co", "x.y@z-1.example.com", "@", ".", "1.2.3.4", "256.1.1.1", "001.02.3.255", "4111 1111 1111 1111",
    "4111-1111-1111-1112", "+1 (555) 123-4567", "+49 30 1234567890123", "é", "日本", " ", " ", "-", "12", "+", "(", "😀",
    "79927398713", "%", "_", "foo", ")", "9",
]


def test_fuzzed_texts(spark):
    draws = random.Random(9)
    docs = [(i, "".join(draws.choice(PARTS) for _ in range(draws.randint(0, 30)))) for i in range(400)]
    docs += [(500, "1 " * 20000 + "x" + "7" * 30000 + "a" * 20000 + "@"), (501, "a@b.c" * 300), (501, "+1" * 5000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    check(Privacy(df).report().collect(), docs)


def test_sample(spark, sample):
    check(queries.op2_personal_data(spark, SF_DIR).collect(), [(r["doc_id"], r["text"]) for r in sample])


def test_odd_rows(spark, odd, empty):
    found = Privacy(odd)
    check(found.report().collect(), [(r[0], r[1]) for r in ODD_ROWS])
    assert sorted(found.sanitised().collect(), key=str) == sorted(odd.collect(), key=str)
    assert Privacy(empty).report().count() == 0


def disclosing_docs():
    """A name that is only ever seen beside one address, among common words."""
    draws = random.Random(4)
    word = lambda: f"w{draws.randrange(300)}"
    rows = []
    for i in range(1500):
        words = [word() for _ in range(30)]
        if i % 150 == 3:
            words[10:12] = ["Zebulon", "zeb@mail.example.com"]
            words[25] = "zebulon,"
        rows.append((i, " ".join(words), "en", "a", 0))
    rows.append((5000, "zebulon alone in a clean text", "en", "a", 0))
    return rows


def test_terms_that_disclose(spark):
    rows = disclosing_docs()
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    found = Privacy(docs, DisclosureSettings(min_bits=6.0))
    report = {r["doc_id"]: r for r in found.report().collect()}
    for doc_id, text, *_ in rows:
        spans = [s.split(":") for s in report[doc_id]["spans"].split(",") if s]
        terms = [text[int(a) : int(b)] for kind, a, b in spans if kind == "term"]
        assert terms == (["Zebulon", "zebulon"] if doc_id < 5000 and doc_id % 150 == 3 else [])
    clean = {r["doc_id"]: r["text"] for r in found.sanitised().collect()}
    assert "[EMAIL]" in clean[3] and "ebulon" not in clean[3]
    assert clean[5000] == rows[-1][1] and clean[4] == rows[4][1]


def test_terms_far_from_the_entity(spark):
    """Terms anywhere in the texts of an entity, in a small table, told from chance."""
    draws = random.Random(6)
    word = lambda: f"w{draws.randrange(300)}"
    rows, far = [], [f"f{i}" for i in range(40)]
    for i in range(400):
        words = [word() for _ in range(60)]
        if i in (7, 20):  # only two texts, and the name is forty words away
            words[5], words[50] = "Quillon", "quill@mail.example.com"
        if i % 100 == 11:
            words = ["Ostrander", *far, "+49 30 1234567", *far, f"alone{i}"]
        if i == 33:
            words[3], words[30] = "hapax", "single@mail.example.com"
        rows.append((i, " ".join(words), "en", "a", 0))
    rows += [(1000 + i, rows[33][1], "en", "a", 0) for i in range(5)]  # copies are no evidence
    docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)
    report = {r["doc_id"]: r for r in Privacy(docs).report().collect()}
    for doc_id, text, *_ in rows:
        spans = [s.split(":") for s in report[doc_id]["spans"].split(",") if s]
        terms = [text[int(a) : int(b)] for kind, a, b in spans if kind == "term"]
        want = ["Quillon"] if doc_id in (7, 20) else []
        if doc_id in (11, 111, 211, 311):
            want = ["Ostrander", *far, *far]
        assert terms == want
