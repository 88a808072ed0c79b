import random

import public_tokenizers
import pytest
from tests.llm.conftest import ODD_ROWS, SF_DIR

from tokenmill.llm import queries
from tokenmill.llm.token_counts import PrefixCounter, counts_at, prefix_tables, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "b", "'", "ll", "'ll", "re", " ", "  ", "\n", "\t", "é", "ß", "日", "本", "😀", "1", "²",
    "½", "_", "-", "!", "\x1c", "\x85", "́", "᠎", "​", "<|endoftext|>", "<|endof",
    "the", "ing", "İ", "ⅷ", "﻿", "Ḁ", "\x00", "\x0b",
]


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter(PATH)


def library_count(counter, text):
    return len(counter.library.encode(text, add_special_tokens=False).ids)


def test_every_prefix_equals_the_library(counter):
    draws = random.Random(5)
    for _ in range(800):
        text = "".join(draws.choice(PARTS) for _ in range(draws.randint(0, 14)))
        ends, counts = counter.tables([text])[0]
        want = [library_count(counter, text[:n]) for n in range(len(text) + 1)]
        assert [counter.count_at(text, ends, counts, n) for n in range(len(text) + 1)] == want
        budget = draws.randint(0, 8)
        longest = max(n for n in range(len(text) + 1) if want[n] <= budget)
        assert counter.longest_within(text, ends, counts, budget) == longest


def test_prefixes_of_pieces_equal_the_library(counter):
    pieces = [b" theoretical", b" 98076150", b"zzzzzzzzzz", b"----------------", "Ä".encode()]
    table = counter.prefix_counts(pieces)
    for row, piece in zip(table, pieces, strict=True):
        assert row[: len(piece) + 1].tolist() == counter.walk(piece)
        if piece.isascii():
            ids = [library_count(counter, piece[:n].decode()) for n in range(len(piece) + 1)]
            assert row[: len(piece) + 1].tolist() == ids


def test_long_pieces(counter):
    text = "ab" * 500 + " " + "=" * 3000
    assert counter.totals([text]) == [library_count(counter, text)]


def test_query_equals_the_library(spark, counter, sample):
    got = {r["doc_id"]: r for r in queries.op5_token_counts(spark, SF_DIR).collect()}
    for row in sample:
        tokens = library_count(counter, row["text"])
        assert got[row["doc_id"]]["n_tokens"] == tokens
        assert got[row["doc_id"]]["n_bytes"] == len(row["text"].encode())
        assert got[row["doc_id"]]["over_limit"] == (tokens > 1024)


def test_odd_rows(spark, counter, odd, empty):
    got = sorted(map(tuple, token_counts(odd, PATH).collect()), key=str)
    want = [
        (row[0], len((row[1] or "").encode()), library_count(counter, row[1] or ""))
        for row in ODD_ROWS
    ]
    assert got == sorted(want, key=str)
    assert token_counts(empty, PATH).count() == 0


def test_stored_tables_answer_truncation(spark, counter, sample):
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in sample[:20]], "doc_id long, text string")
    tables = prefix_tables(docs, PATH)
    got = {r["doc_id"]: r["n_tokens"] for r in counts_at(docs, tables, PATH, 301).collect()}
    assert got == {r["doc_id"]: library_count(counter, r["text"][:301]) for r in sample[:20]}
