"""Language identification with bit-sliced Bloom filters of character n-grams.

Every slot of the filter holds one bit per language.  An n-gram of a language's
profile sets that language's bit in the slots that its hashes name, and the
bitwise AND of an n-gram's slots gives all languages that contain it in one
step.  For a text, the bits of all its n-grams are counted per language.  A
share of the n-grams of any text hits a filter by chance; that share is known
from how full each language's slice is and is taken off before the languages
are compared.

A profile holds the n-grams (runs of letters of the given orders, a word's ends
marked, case folded) that make up at least ``min_share`` of a language's n-grams
and are not much rarer there than in another language, so it has at most
``1 / min_share`` entries however large the corpus is.

Learning uses a bounded sample of the labelled rows: about ``sample`` per
language, chosen by a hash of ``doc_id``.  Prediction reads whole texts.

Contract: null texts and texts without a letter are ``und`` with score 0; a text
with letters of which no n-gram is known gets the language with the most
labelled rows and score 0, or ``und`` if nothing was learned (no labelled rows);
equal counts go to the language that sorts first.  A row is answered by itself,
so repeated rows give repeated results.  Other columns pass through
``identify`` untouched; a column that has the name of a result is replaced.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenmill.llm.text import blocks, mix
from tokenmill.llm.tables import free_name
from tokenmill.staging import stage

UNKNOWN = "und"
RESULT = "struct<lang_pred: string, score: double>"
_PLACES = np.random.Generator(np.random.PCG64(77)).integers(
    1, 2**63, (16, 16), dtype=np.uint64
) | np.uint64(1)


@dataclass(frozen=True)
class LanguageSettings:
    orders: tuple[int, ...] = (3, 4)
    sample: int = 3000
    min_share: float = 2e-5
    min_ratio: float = 0.1
    slots: int = 1 << 20
    probes: int = 3


@lru_cache(maxsize=1)
def letter_codes() -> np.ndarray:
    """For every code point the code of its lower-case letter, 0 if it is none."""
    codes = np.zeros(sys.maxunicode + 1, np.uint32)
    for code in range(sys.maxunicode + 1):
        if chr(code).isalpha():
            low = chr(code).lower()
            codes[code] = ord(low) if len(low) == 1 else code
    return codes


def ngrams(texts: list[str], orders: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the hashes of all n-grams, and for each text the place of its first.

    Only the first and the last character of an n-gram may be the end of a word.
    """
    points = np.frombuffer("\0".join(["", *texts, ""]).encode("utf-32-le"), np.uint32)
    codes = letter_codes()[points].astype(np.uint64)
    borders = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(text) + 1 for text in texts], out=borders[1:])
    letter = codes > 0
    for order in orders:
        size = max(0, len(codes) - order + 1)
        inside = np.ones(size, dtype=bool)
        for step in range(1, order - 1):
            inside &= letter[step : step + size]
        starts = np.flatnonzero(inside)
        total = np.zeros(len(starts), np.uint64)
        with np.errstate(over="ignore"):
            for step in range(order):
                total += codes[starts + step] * _PLACES[order % 16, step % 16]
            yield mix(total), np.searchsorted(starts, borders)


def sums(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    running = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=running[1:])
    return running[places[1:]] - running[places[:-1]]


class LanguageFilter:
    """The bit-sliced filter: for every 64 languages one word of bits per slot."""

    def __init__(self, settings: LanguageSettings, languages: list[str], common: str | None):
        self.settings, self.languages, self.common = settings, languages, common
        self.width = max(1, -(-len(languages) // 64))
        small = next(k for k in (8, 16, 32, 64) if k >= min(64, max(1, len(languages))))
        self.masks = np.zeros((self.width, settings.slots), np.dtype(f"uint{small}"))

    def slots(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        with np.errstate(over="ignore"):
            for probe in range(self.settings.probes):
                place = (hashes + np.uint64(probe) * step) % np.uint64(self.settings.slots)
                yield place.astype(np.int64)

    def add(self, language: int, hashes: np.ndarray) -> None:
        word, bit = divmod(language, 64)
        for place in self.slots(hashes):
            self.masks[word, place] |= self.masks.dtype.type(1 << bit)

    def chance(self) -> np.ndarray:
        """For each language how often an n-gram that it lacks looks contained."""
        full = [
            np.mean((self.masks[i // 64] >> self.masks.dtype.type(i % 64)) & 1)
            for i in range(len(self.languages))
        ]
        return np.array(full) ** self.settings.probes

    def shares(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected shares of contained n-grams by text and language; n-grams by text."""
        found = np.zeros((len(texts), len(self.languages)), np.int64)
        count = np.zeros(len(texts), np.int64)
        one = self.masks.dtype.type(1)
        for hashes, places in ngrams(texts, self.settings.orders):
            count += np.diff(places)
            slots = list(self.slots(hashes))
            for word in range(self.width):
                held = self.masks[word, slots[0]]
                for place in slots[1:]:
                    held = held & self.masks[word, place]
                for i in range(word * 64, min(len(self.languages), word * 64 + 64)):
                    bits = (held >> self.masks.dtype.type(i % 64)) & one
                    found[:, i] += sums(bits, places)
        chance = self.chance()
        raw = found / np.maximum(count, 1)[:, None]
        return np.clip((raw - chance) / np.maximum(1 - chance, 1e-9), 0, 1), count

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        shares, count = self.shares(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best = shares.argmax(axis=1)
        total = shares.sum(axis=1)
        top = shares[np.arange(len(texts)), best]
        score = np.divide(top, total, out=np.zeros(len(texts)), where=total > 0)
        names = [
            UNKNOWN if not n else self.languages[b] if t > 0 else self.common
            for n, b, t in zip(count.tolist(), best.tolist(), total.tolist(), strict=True)
        ]
        return names, score


def _count_ngrams(settings: LanguageSettings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, _, _ in blocks(batch.column(1)):
                langs = batch.column(0).slice(start, end - start).to_pylist()
                texts = batch.column(1).slice(start, end - start).to_pylist()
                for lang in sorted(set(langs)):
                    own = [t for t, name in zip(texts, langs, strict=True) if name == lang]
                    found = [hashes for hashes, _ in ngrams(own, settings.orders)]
                    grams, counts = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(grams), pa.string()),
                            pa.array(grams.view(np.int64)),
                            pa.array(counts.astype(np.int64)),
                        ],
                        ["lang", "gram", "n"],
                    )

    return run


def learn_languages(
    labelled: DataFrame, settings: LanguageSettings | None = None
) -> LanguageFilter:
    """Build the filter from rows ``(doc_id, text, lang)`` with known languages."""
    settings = settings or LanguageSettings()
    rows = labelled.select("doc_id", "text", "lang").where(
        "text is not null and lang is not null"
    )
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageFilter(settings, [], None)
    parts = F.create_map(
        *[x for k in languages for x in (F.lit(k), F.lit(min(1.0, settings.sample / sizes[k])))]
    )
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    counts = stage(
        rows.where(place < F.element_at(parts, F.col("lang")))
        .select("lang", "text")
        .mapInArrow(_count_ngrams(settings), "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n")),
        "language-ngrams",
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    share = F.col("n") / F.col("total")
    profile = (
        counts.join(F.broadcast(totals), "lang")
        .withColumn("share", share)
        .withColumn("most", F.max("share").over(Window.partitionBy("gram")))
        .where(F.col("share") >= settings.min_share)
        .where(F.col("share") >= settings.min_ratio * F.col("most"))
        .select("lang", "gram")
        .toArrow()
        .to_pandas()
    )
    common = max(languages, key=lambda name: sizes[name])
    made = LanguageFilter(settings, languages, common)
    for lang, own in profile.groupby("lang"):
        made.add(languages.index(lang), own["gram"].to_numpy(np.int64).view(np.uint64))
    return made


def predictions(docs: DataFrame, model: LanguageFilter, text: Column) -> Column:
    """A struct of language and score for each row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def predict(column: pa.Array) -> pa.Array:
        names: list[str] = []
        scores: list[np.ndarray] = [np.zeros(0)]
        for start, end, _, _ in blocks(column):
            texts = column.slice(start, end - start).fill_null("").to_pylist()
            name, score = sent.value.predict(texts)
            names += name
            scores.append(score)
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(np.concatenate(scores))],
            ["lang_pred", "score"],
        )

    return predict(text)


def identify(docs: DataFrame, model: LanguageFilter, text: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and ``score``."""
    name = free_name(docs, "_language")
    found = docs.withColumn(name, predictions(docs, model, F.col(text)))
    return found.withColumns(
        {"lang_pred": F.col(f"{name}.lang_pred"), "score": F.col(f"{name}.score")}
    ).drop(name)
