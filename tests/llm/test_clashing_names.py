"""Every operator and pipeline stage on odd rows with columns that have the names of inner ones."""

import corpus_pipeline
import pytest

from tokenmill.llm.contamination import Hits
from tokenmill.llm.exact_dedup import ExactDedup
from tokenmill.llm.language import identify, learn_languages
from tokenmill.llm.line_dedup import LineDedup
from tokenmill.llm.mixing import mix_sources
from tokenmill.llm.ngram_join import NgramJoin
from tokenmill.llm.periodic import PeriodicRuns
from tokenmill.llm.privacy import Privacy

SF_DIR = "/root/testdata/sf0.001"
NAMES = (
    "_id _key _hit_id _hit_key _doc_id _text_key _language _language_ _text _spans _parts _leading "
    "_removed _lines _n_lines _row one two n text_key component rows start end length removed "
    "document digest hash lang_pred score"
).split()


@pytest.fixture(scope="module", params=["odd rows", "no rows"])
def docs(request, odd, empty):
    table = (odd if request.param == "odd rows" else empty).select(
        "doc_id", "text", "lang", "source", "n_chars"
    )
    return table.selectExpr("*", *[f"'mine {name}' as `{name}`" for name in NAMES])


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet(f"{SF_DIR}/benchmark.parquet")


def untouched(found, docs):
    """All columns are there and hold what they held."""
    assert found.columns == docs.columns
    rows = found.collect()
    assert all(row[name] == f"mine {name}" for row in rows for name in NAMES)
    return rows


def test_tables_that_pass_through(docs, benchmark):
    n = docs.count()
    assert len(untouched(Privacy(docs).sanitised(), docs)) == n
    assert len(untouched(Hits(docs, benchmark).clean_documents(), docs)) == n
    assert len(untouched(Hits(docs, benchmark).without_spans(), docs)) == n
    assert len(untouched(PeriodicRuns(docs).collapsed(), docs)) == n
    for found in (
        LineDedup(docs).deduplicated(),
        NgramJoin(docs).one_of_each(),
        ExactDedup(docs).deduplicated(),
    ):
        assert len(untouched(found, docs)) <= n


def test_reports(docs, benchmark):
    n = docs.count()
    for report in (
        Privacy(docs).report(),
        Hits(docs, benchmark).report(),
        LineDedup(docs).report(),
        NgramJoin(docs).groups(),
        ExactDedup(docs).report(),
        PeriodicRuns(docs).report(),
        mix_sources(docs, (5.0, 2.0, 1.0)),
    ):
        assert report.count() == n
    model = learn_languages(docs)
    found = identify(docs, model)
    assert found.count() == n and set(found.columns) == set(docs.columns)


def test_pipeline_stages(spark, docs):
    for name, step in corpus_pipeline.STAGES[:-1]:
        found = step(spark, docs, SF_DIR)
        assert len(untouched(found, docs)) <= docs.count(), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == docs.count()
