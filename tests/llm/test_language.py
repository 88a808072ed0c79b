import zlib
from collections import Counter

import numpy as np
from tests.llm.conftest import SF_DIR

from tokenmill.llm import queries
from tokenmill.llm.language import (
    LanguageFilter,
    LanguageSettings,
    identify,
    learn_languages,
    ngrams,
)

SF_001 = SF_DIR.replace("0.001", "0.01")


def test_ngrams_do_not_reach_over_words():
    (found, places), = ngrams(["ab", "", "a b"], (3,))
    assert np.diff(places).tolist() == [2, 0, 2]
    (alone, _), = ngrams(["b"], (3,))
    assert alone[0] == found[3]


def test_more_than_64_languages():
    names = [f"l{i:03d}" for i in range(70)]
    model = LanguageFilter(LanguageSettings(orders=(3,), slots=1 << 14), names, "l000")
    for i, _ in enumerate(names):
        word = chr(0x4E00 + 3 * i) * 2
        (grams, _), = ngrams([word], (3,))
        model.add(i, grams)
    texts = [chr(0x4E00 + 3 * i) * 2 for i in (0, 63, 64, 69)]
    assert model.predict(texts)[0] == ["l000", "l063", "l064", "l069"]


def test_held_out_accuracy(spark):
    rows = queries.op7_language_id(spark, SF_001).collect()
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_001}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    right = np.mean([r["lang_pred"] == docs[r["doc_id"]] for r in held])
    assert len(held) > 150 and right >= 0.97


def test_odd_rows(spark, odd, empty):
    model = learn_languages(odd)
    rows = identify(odd, model).collect()
    assert identify(odd, model).columns.count("lang_pred") == 1
    for r in rows:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "fr")
    assert Counter(r["doc_id"] for r in rows)[5] == 3
    nothing = learn_languages(empty)
    assert {r["lang_pred"] for r in identify(odd, nothing).collect()} == {"und"}
    assert identify(empty, model).count() == 0
