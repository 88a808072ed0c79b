"""Find and remove benchmark passages in documents, with DataFrame expressions alone.

Texts are normalised to words: A-Z count as a-z, a word is a run of characters
other than the ASCII ones that are neither digit nor letter.  A benchmark item is
cut into windows of ``width`` consecutive words, an item of fewer words being one
window.  The hashes of all windows are a small table that goes to every machine;
every window of every document is hashed and looked up in it while the document is
scanned, and a hit is verified against the words themselves.  Only verified hits
are shuffled.

The table of hashes is broadcast if it has at most ``BROADCAST_ROWS`` rows;
a larger benchmark is joined by a shuffle on the hash.

Contract: null texts and texts without a word have no words and no hits; a null
``item_id`` marks words as hit but is no item; repeated items and repeated rows
count once per item and once per row; documents are told apart by ``doc_id`` and
text, so rows that agree in both have equal results.  An empty benchmark hits
nothing.  Columns other than ``doc_id`` and ``text`` pass through the removals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenmill.llm.tables import ascii_lower, beside, columns_of, free_name, small_or_shuffled
from tokenmill.staging import stage

#: What separates words, and what words are made of, in lower-cased text.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same for a text whose case has not been changed.
FIRST_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
PART = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WIDTH = 10


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), GAP), "")


def window_key(length: int, at: Column, words: Column) -> Column:
    """Hash of the ``length`` words from ``at`` (from 0) on."""
    return F.xxhash64(F.lit(length), *[F.get(words, at + step) for step in range(length)])


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """All windows ``(length, gram, item_id)``; ``gram`` has the words joined by a space."""
    items = benchmark.select("item_id", words(F.col("text")).alias("words")).where(
        F.size("words") > 0
    )
    length = F.least(F.lit(width), F.size("words"))
    return items.select(
        "item_id",
        length.alias("length"),
        "words",
        F.explode(F.sequence(F.lit(0), F.size("words") - length)).alias("at"),
    ).select(
        "item_id",
        "length",
        F.array_join(F.slice("words", F.col("at") + 1, F.col("length")), " ").alias("gram"),
    )


def _key_of(gram: Column, lengths: list[int]) -> Column:
    """The hash that ``window_key`` gives for the words of ``gram``."""
    parts = F.split(gram, " ")
    by_length = [
        F.when(F.size(parts) == n, window_key(n, F.lit(0), parts)) for n in lengths
    ]
    return F.coalesce(*by_length)


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


class Hits:
    """Verified hits of one set of documents against one benchmark."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, width: int = WIDTH):
        found = stage(benchmark_windows(benchmark, width).distinct(), "benchmark-windows")
        lengths = sorted(r["length"] for r in found.select("length").distinct().collect())
        self.items = found.where("item_id is not null")
        self.docs = docs
        self.spans = self.scan(found, lengths) if lengths else self.nothing()

    def nothing(self) -> DataFrame:
        schema = "doc_id bigint, text_key bigint, start int, length int, gram string"
        return self.docs.sparkSession.createDataFrame([], schema)

    def scan(self, found: DataFrame, lengths: list[int]) -> DataFrame:
        grams = small_or_shuffled(
            found.select("length", "gram").distinct().withColumn(
                "key", _key_of(F.col("gram"), lengths)
            ),
            "benchmark-keys",
        ).select("key", F.col("length").alias("gram_length"), "gram")
        texts = self.docs.select(
            F.col("doc_id").cast("bigint"),
            text_key(F.col("text")).alias("text_key"),
            words(F.col("text")).alias("words"),
        )
        at = F.col("start")
        # An inner explode would be given a filter that cuts the text a second time.
        starts = F.when(
            F.size("words") >= lengths[0], F.sequence(F.lit(0), F.size("words") - lengths[0])
        )
        places = texts.select("*", F.explode_outer(starts).alias("start"))
        keys = [
            F.when(at + n <= F.size("words"), window_key(n, at, F.col("words"))) for n in lengths
        ]
        if len(keys) == 1:
            keyed = places.withColumn("key", keys[0])
        else:
            keyed = places.withColumn("key", F.explode(F.array(*keys)))
        same = F.array_join(F.slice("words", at + 1, F.col("gram_length")), " ") == F.col("gram")
        hits = (
            keyed.join(grams, "key")
            .where(same)
            .select("doc_id", "text_key", "start", F.col("gram_length").alias("length"), "gram")
        )
        return stage(hits.distinct(), "benchmark-hits")

    def merged(self) -> DataFrame:
        """``(doc_id, text_key, start, end)``: hits that overlap or touch as one span of words."""
        spans = self.spans.select("doc_id", "text_key", "start", "length").distinct()
        order = Window.partitionBy("doc_id", "text_key").orderBy("start", "length")
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        end = F.col("start") + F.col("length")
        apart = F.coalesce(F.col("start") > F.max(end).over(before), F.lit(True))
        return (
            spans.withColumn("apart", apart.cast("int"))
            .withColumn("span", F.sum("apart").over(order))
            .groupBy("doc_id", "text_key", "span")
            .agg(F.min("start").alias("start"), F.max(end).alias("end"))
            .drop("span")
        )

    def word_counts(self) -> DataFrame:
        """``(doc_id, text_key, n_hit)``: words inside the union of all hits of a text."""
        return (
            self.merged()
            .groupBy("doc_id", "text_key")
            .agg(F.sum(F.col("end") - F.col("start")).alias("n_hit"))
        )

    def item_lists(self) -> DataFrame:
        """``(doc_id, text_key, n_items, items)`` with the ids as sorted strings."""
        grams = self.spans.select("doc_id", "text_key", "gram").distinct()
        items = small_or_shuffled(self.items.select("gram", "item_id"), "benchmark-items")
        return (
            grams.join(items, "gram")
            .select("doc_id", "text_key", F.col("item_id").cast("string").alias("item"))
            .distinct()
            .groupBy("doc_id", "text_key")
            .agg(F.sort_array(F.collect_list("item")).alias("items"))
            .withColumn("n_items", F.size("items").cast("bigint"))
        )

    def report(self) -> DataFrame:
        """For every document row its words, hit words and the items found in it."""
        rows = self.docs.select(
            F.col("doc_id").cast("bigint"),
            text_key(F.col("text")).alias("text_key"),
            F.size(words(F.col("text"))).cast("bigint").alias("n_words"),
        )
        found = small_or_shuffled(
            self.word_counts().join(
                self.item_lists().withColumnsRenamed({"doc_id": "i", "text_key": "k"}),
                F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("k")),
                "left",
            ).select("doc_id", "text_key", "n_hit", "n_items", "items"),
            "benchmark-found",
        ).withColumnsRenamed({"doc_id": "i", "text_key": "k"})
        n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
        return rows.join(
            found,
            F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("k")),
            "left",
        ).select(
            "doc_id",
            "n_words",
            n_hit.alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            (n_hit > 0).alias("contaminated"),
        )

    def clean_documents(self) -> DataFrame:
        """The rows without a hit, all their columns unchanged."""
        hit = small_or_shuffled(
            self.spans.select("doc_id", "text_key").distinct(), "contaminated"
        )
        return beside(self.docs, hit, text_key(F.col("text")), "left_anti")[0]

    def without_spans(self) -> DataFrame:
        """All rows, the hit words and what follows each up to the next word cut out."""
        spans = small_or_shuffled(
            self.merged()
            .groupBy("doc_id", "text_key")
            .agg(F.collect_list(F.struct("start", "end")).alias("spans")),
            "contaminated-spans",
        )
        whole, found = beside(self.docs, spans, text_key(F.col("text")))
        inside = found["spans"]
        # Words and gaps take turns; the case is the text's own, so gaps leave letters alone.
        parts = F.regexp_extract_all(F.col("text"), F.lit(PART), F.lit(0))
        leading = F.when(F.regexp_like(F.col("text"), F.lit(f"^{FIRST_GAP}")), 1).otherwise(0)

        names = [free_name(whole, name) for name in ("_parts", "_leading")]

        def stays(part: Column, place: Column) -> Column:
            word = F.floor((place - F.col(names[1])) / 2)
            return ~F.exists(
                inside,
                lambda s: (word >= s["start"]) & (word < s["end"]),
            )

        joined = whole.withColumns(
            {names[0]: F.when(inside.isNotNull(), parts), names[1]: leading}
        )
        cut = F.array_join(F.filter(names[0], stays), "")
        return joined.withColumn(
            "text", F.when(inside.isNotNull(), cut).otherwise(F.col("text"))
        ).select(*columns_of(self.docs))

