from pathlib import Path

import corpus_pipeline
from tests.llm.test_contamination import brute as contaminated
from tests.llm.test_line_dedup import brute as lines_removed
from tests.llm.test_ngram_join import brute as grouped

from tokenmill.staging import stage, work_root

SF_DIR = "/root/testdata/sf0.001"


def staged(spark):
    folder = Path(f"{work_root(spark).removeprefix('file:')}/tokenmill")
    return {p.name for p in folder.iterdir()}


def test_staged_tables_go(spark):
    """What a stage staged on its way is gone once the next one is called."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    steps["op7_language"](spark, docs, SF_DIR)
    before = staged(spark)
    docs = stage(steps["op8_line_dedup"](spark, docs, SF_DIR), "test-lines")
    made = staged(spark) - before
    assert not any(name.startswith(("line-sets", "line-index", "line-rest")) for name in made)
    assert any(name.startswith("line-prefixes") for name in made)
    rows = docs.count()
    docs = stage(steps["op9_near_duplicates"](spark, docs, SF_DIR), "test-near")
    left = staged(spark) - before
    assert not any(name.startswith("line-") for name in left)
    assert not any(name.startswith(("token-sets", "rarity-index", "verified")) for name in left)
    assert 0 < docs.count() <= rows
    assert steps["op3_mixing"](spark, docs, SF_DIR).count() == docs.count()
    assert {n.rsplit("-", 1)[0] for n in staged(spark) - before} <= {
        "test-lines", "test-near", "mix-sizes", "mix-sources", "mix-targets", "mix-flight", "mix-reserves",
    }


def test_stages_one_by_one(spark, sample):
    """Each stage against brute force on its own input."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert [n.split("_")[0] for n in steps] == ["op7", "op8", "op9", "op4", "op3"]

    docs = spark.createDataFrame(
        steps["op7_language"](spark, docs, SF_DIR).collect(), docs.schema
    )
    assert {r["doc_id"] for r in docs.collect()} == {
        r["doc_id"] for r in sample if any(c.isalpha() for c in r["text"])
    }
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = {}
    for doc_id, lines, n, removed in lines_removed(rows):
        gone = {int(i) for i in removed.split(",") if i}
        if not n or n < lines:
            cut = [x for i, x in enumerate(dict(rows)[doc_id].split("\n")) if i not in gone]
            want[doc_id] = "\n".join(cut)
    docs = spark.createDataFrame(
        steps["op8_line_dedup"](spark, docs, SF_DIR).collect(), docs.schema
    )
    assert docs.columns == columns and {r["doc_id"]: r["text"] for r in docs.collect()} == want

    kept = {d for d, _, c in grouped(list(want.items())) if d == c}
    docs = spark.createDataFrame(
        steps["op9_near_duplicates"](spark, docs, SF_DIR).collect(), docs.schema
    )
    assert sorted(r["doc_id"] for r in docs.collect()) == sorted(kept)

    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    clean = sorted(r[0] for r in contaminated(rows, items) if not r[5])
    docs = spark.createDataFrame(
        steps["op4_decontamination"](spark, docs, SF_DIR).collect(), docs.schema
    )
    assert sorted(r["doc_id"] for r in docs.collect()) == clean
    mixed = steps["op3_mixing"](spark, docs, SF_DIR)
    assert sorted(r["doc_id"] for r in mixed.collect()) == clean
