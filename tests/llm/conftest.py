import pyarrow.parquet as pq
import pytest

SF_DIR = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

#: Rows that every operator has to take: null and empty texts, null columns, no letters,
#: repeated rows, a doc_id with two texts, a null doc_id, and one long text.
ODD_ROWS = [
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, "   \n\t ", None, None, 6),
    (4, "12345 !!! ...", "en", "b", 13),
    (5, "one two three", None, "b", 13),
    (5, "one two three", None, "b", 13),
    (5, "another text of the same number", "en", "b", 31),
    (None, "no number at all here", "en", None, 21),
    (7, "é ü ñ 日本 😀 x", "fr", "c", 12),
    (8, "word " * 5000, "en", "c", 25000),
]


@pytest.fixture(scope="session")
def shared(tmp_path_factory):
    return tmp_path_factory.mktemp("shared")


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with further columns that have the names of results."""
    rows = [(*row, "mine", -1.0, 99, 7) for row in ODD_ROWS]
    extra = ", lang_pred string, score double, size bigint, key bigint"
    return spark.createDataFrame(rows, DOC_SCHEMA + extra)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def sample():
    """The documents of the smallest test data as Python rows."""
    return pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()
