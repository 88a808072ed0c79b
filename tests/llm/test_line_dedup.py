import random
import time

import duckdb
from check_oracles import connect, difference
from pyspark.sql import functions as F
from tests.llm.conftest import DOC_SCHEMA, ODD_ROWS, SF_DIR

from tokenmill.llm import line_dedup, queries, tables
from tokenmill.llm.line_dedup import LineDedup
from tokenmill.staging import stage


def tokens(line):
    w = line.lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None


def brute(rows):
    """``(doc_id, n_lines, n_removed, removed)``; rows equal in id and text are one."""
    order = sorted({r for r in rows}, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    before, gone, count = [], {}, {}
    for doc in order:
        gone[doc], count[doc] = [], 0
        for i, line in enumerate((doc[1] or "").split("\n")):
            own = tokens(line)
            if own is None:
                continue
            count[doc] += 1
            if any(100 * len(own & t) >= 75 * len(own | t) for t in before):
                gone[doc].append(i)
            before.append(own)
    return sorted(
        ((r[0], count[r], len(gone[r]), ",".join(map(str, gone[r]))) for r in rows), key=str
    )


def made(seed=6):
    draws = random.Random(seed)
    word = lambda: f"w{draws.randrange(500)}"
    line = lambda n: [word() for _ in range(n)]
    pool = [line(draws.choice([1, 2, 4, 6, 12, 40])) for _ in range(25)]
    frame = line(30)
    rows = []
    for doc in range(120):
        lines = []
        for _ in range(draws.randint(0, 6)):
            kind = draws.random()
            if kind < 0.4:
                own = list(draws.choice(pool))
                for _ in range(draws.choice([0, 0, 1, 2])):
                    own[draws.randrange(len(own))] = word()
            elif kind < 0.55:
                own = frame + line(draws.choice([2, 8, 30]))
            else:
                own = line(draws.randint(0, 45))
            lines.append(draws.choice([" ", "  ", "\t"]).join(own))
        rows.append((doc, "\n".join(lines)))
    rows += [(1000 + r[0], r[1]) for r in ODD_ROWS if r[0] not in (5, None)]
    return rows + draws.sample(rows, 10)


def result(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, one int")
    found = LineDedup(df.repartition(3))
    return found, sorted(map(tuple, found.report().collect()), key=str)


def test_brute_force(spark):
    rows = made()
    found, got = result(spark, rows)
    assert got == brute(rows)
    left = {r["doc_id"]: r["text"] for r in found.deduplicated().collect()}
    for doc_id, lines, n, removed in got:
        text = dict(rows)[doc_id]
        if n and n == lines:
            assert doc_id not in left
        else:
            gone = {int(i) for i in removed.split(",") if i}
            cut = [x for i, x in enumerate((text or "").split("\n")) if i not in gone]
            assert left[doc_id] == (text if not gone else "\n".join(cut))


def test_shuffled_joins(spark, monkeypatch):
    monkeypatch.setattr(tables.small_or_shuffled, "__defaults__", (0,))
    monkeypatch.setattr(line_dedup, "TOKENS_SENT", 0)
    rows = made(8)
    assert result(spark, rows)[1] == brute(rows)


def test_odd_and_empty(spark, odd, empty):
    got = LineDedup(odd).report().collect()
    assert len(got) == len(ODD_ROWS)
    assert {r["n_lines"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}
    assert LineDedup(odd).deduplicated().columns == odd.columns
    assert LineDedup(empty).report().count() == 0
    assert LineDedup(empty).deduplicated().count() == 0


def test_sql(spark):
    got = queries.op8_line_dedup(spark, SF_DIR).toPandas()
    want = connect(SF_DIR).execute(queries.SQL["op8_line_dedup"]).df()
    assert difference(got, want) is None
    assert duckdb.__version__ and DOC_SCHEMA


def test_a_pair_that_shares_many_tokens_is_made_once(spark, monkeypatch):
    """Loose copies of a long line share many tokens of their prefixes."""
    draws = random.Random(9)
    base = [f"w{i}" for i in range(160)]
    rows = []
    for i in range(40):
        words = list(base)
        for at in draws.sample(range(160), 4):
            words[at] = f"x{draws.randrange(10**9)}"
        rows.append((i, " ".join(words)))
    made = []
    plain = LineDedup.near

    def counted(self, left, right):
        pairs = plain(self, left, right)
        made.append((pairs.count(), pairs.distinct().count()))
        return pairs

    monkeypatch.setattr(LineDedup, "near", counted)
    assert result(spark, rows)[1] == brute(rows)
    total, pairs = made[1]  # heads of lists first, then the lists
    assert pairs > 50
    assert total < 1.5 * pairs


def shuffled_files(spark):
    environment = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    files = environment.blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "/shuffle_" in f and f.endswith(".data")}


def left(spark, before):
    """The new shuffle files once Spark has had some seconds to delete what it wants to."""
    until = time.time() + 10
    while (new := shuffled_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return new


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before = shuffled_files(spark)
    spread = spark.range(10_000).groupBy((F.col("id") % 5_000).alias("k")).agg(F.sum("id").alias("s"))
    table = stage(spread, "spread")
    assert not left(spark, before)
    assert table.count() == 5_000


def test_no_text_is_shuffled_for_the_sets_of_lines(spark, monkeypatch):
    """Only the documents that hold a line of a pair are cut again."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(200)]
    rows += [(1000 + i, f"{rows[i][1]} more") for i in range(3)]
    read = []
    plain = line_dedup.line_rows

    def counted(docs):
        read.append(docs.count())
        return plain(docs)

    monkeypatch.setattr(line_dedup, "line_rows", counted)
    assert result(spark, rows)[1] == brute(rows)
    assert read[:2] == [203, 203]  # how rare the tokens are, and the prefixes
    assert all(n <= 8 for n in read[2:])
