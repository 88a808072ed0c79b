"""Personal data in texts, and terms that reveal it, with DataFrame expressions alone.

Patterns find e-mail addresses, IP addresses, card and phone numbers: these are the
protected entities.  Other words can give one away: a word that occurs almost only
in texts with one address names its owner.  For every term of the texts that hold an
entity the corpus tells how likely the entity is given the term, and how many bits the
term adds to what one knows without it (the pointwise mutual information).  A term that
predicts the entity with at least ``min_share`` is disclosing, if that many texts with
both would come about by chance with a probability of at most ``chance`` for any of all
terms and entities (the bound of Chernoff, times their number).  In documents that hold
the entity it is generalised, or removed if it adds ``remove_bits``.

Term counts cover whole texts of all documents, wherever the term is in them.  Equal
texts count once, so copies of a document are no evidence.

Contract: null text is empty and has no spans; positions are code points, the end
exclusive; documents are told apart by ``doc_id`` and text, so repeated rows have
equal results; other columns pass through ``sanitised`` untouched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenmill.llm.tables import beside, columns_of, small_or_shuffled
from tokenmill.staging import stage

#: The kinds in the order of their listing.  The possessive forms match what the plain
#: ones do, without going back; a match can only begin where a run does or where the
#: match before ended.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "term")
TERM_GAP = r"[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class DisclosureSettings:
    min_share: float = 0.8
    chance: float = 0.05
    min_bits: float = 0.0
    remove_bits: float = 12.0


def text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def terms(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), TERM_GAP), "")


def matches(text: Column, kind: str, pattern: str) -> Column:
    """Structs of kind, number, characters since the match before, and match."""
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(
        found,
        lambda m, n: F.struct(
            F.lit(kind).alias("kind"),
            n.alias("number"),
            F.char_length(F.get(gaps, n)).alias("gap"),
            m.alias("value"),
        ),
    )


def luhn(digits: Column) -> Column:
    """Whether the check sum of a string of digits is a multiple of ten."""
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, -place, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(place % 2 == 0, twice).otherwise(digit)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def valid(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    count = F.length(digits)

    def small(part: Column) -> Column:
        short = F.regexp_replace(part, "^0+(?=.)", "")
        return F.when(F.length(short) <= 3, short.cast("int") <= 255).otherwise(False)

    return (
        F.when(kind == "ip", F.forall(F.split(value, r"\."), small))
        .when(kind == "card", F.when(count.between(14, 19), luhn(digits)).otherwise(False))
        .when(kind == "phone", count.between(10, 15))
        .otherwise(True)
    )


def rank(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


class Privacy:
    """Spans of one table of documents."""

    def __init__(self, docs: DataFrame, settings: DisclosureSettings | None = None):
        self.settings = settings or DisclosureSettings()
        self.docs = docs
        self.spark = docs.sparkSession
        self.base = stage(self.base_spans(), "base-spans")

    def base_spans(self) -> DataFrame:
        """``(doc_id, text_key, kind, start, end, value)`` of all valid matches."""
        text = F.col("text")
        none = F.array().cast("array<struct<kind string, number int, gap int, value string>>")

        def when(hint: Column, kind: str, pattern: str) -> Column:
            return F.coalesce(F.when(hint, matches(text, kind, pattern)), none)

        found = F.concat(
            when(text.contains("@"), "email", EMAIL),
            when(F.regexp_like(text, F.lit(r"[0-9]\.[0-9]")), "ip", IP),
            when(F.regexp_like(text, F.lit(r"[0-9][\x20-]?[0-9]")), "card", CARD),
            when(text.contains("+"), "phone", PHONE),
        )
        rows = (
            self.docs.select(
                F.col("doc_id").cast("bigint"),
                text_key().alias("text_key"),
                F.explode_outer(found).alias("m"),
            )
            .where("m is not null")
            .select("doc_id", "text_key", "m.*")
            .dropDuplicates(["doc_id", "text_key", "kind", "number"])
        )
        length = F.char_length("value")
        so_far = Window.partitionBy("doc_id", "text_key", "kind").orderBy("number")
        return (
            rows.withColumn("end", F.sum(F.col("gap") + length).over(so_far))
            .withColumn("start", F.col("end") - length)
            .where(valid(F.col("kind"), F.col("value")))
            .select("doc_id", "text_key", "kind", "start", "end", "value")
        )

    def entities(self) -> DataFrame:
        """The base spans with ``entity``, the same for all ways to write one."""
        digits = F.regexp_replace("value", "[^0-9]", "")
        name = F.when(F.col("kind").isin("card", "phone"), digits).otherwise(F.lower("value"))
        return self.base.withColumn("entity", F.concat_ws(":", "kind", name))

    def term_counts(self, held: DataFrame) -> tuple[DataFrame, int]:
        """``(term, texts, most)`` of all terms, and the number of different texts.

        ``most`` is the greatest number of the term's texts that hold one kind of entity.
        """
        keys = stage(
            self.docs.groupBy(text_key().alias("text_key")).agg(F.count("*").alias("copies")),
            "text-keys",
        )
        copies = small_or_shuffled(keys.where("copies > 1"), "text-copies")
        kinds = held.groupBy("text_key").agg(F.collect_set("kind").alias("kinds"))
        texts = (
            self.docs.select(
                text_key().alias("text_key"), F.array_distinct(terms(F.col("text"))).alias("terms")
            )
            .join(copies, "text_key", "left")
            .join(small_or_shuffled(kinds, "text-kinds"), "text_key", "left")
        )
        # Each of a text's copies counts as a share of one, so that no text moves to be counted.
        one = F.lit(1.0) / F.coalesce("copies", F.lit(1))
        holds = lambda kind: F.coalesce(F.array_contains("kinds", kind), F.lit(False))
        found = texts.select(
            F.explode("terms").alias("term"),
            one.alias("one"),
            *[F.when(holds(kind), one).otherwise(0.0).alias(kind) for kind in KINDS[:-1]],
        )
        whole = lambda name: F.round(F.sum(name)).cast("bigint")
        counts = found.groupBy("term").agg(
            whole("one").alias("texts"), F.greatest(*[whole(kind) for kind in KINDS[:-1]]).alias("most")
        )
        return stage(counts, "term-counts"), keys.count()

    def disclosing(self) -> DataFrame:
        """``(entity, term, share, bits)`` of the terms that reveal an entity."""
        s = self.settings
        held = stage(self.entities().select("entity", "kind", "text_key").distinct(), "holders")
        if held.isEmpty():
            return self.spark.createDataFrame(
                [], "entity string, term string, share double, bits double"
            )
        counts, total = self.term_counts(held)
        holders = stage(held.groupBy("entity").agg(F.count("*").alias("held")), "entity-holders")
        tested = float(counts.count()) * holders.count()
        # One text with both has by chance the probability of one in all texts at least, so
        # it is no evidence unless these outnumber what is tested.
        least = 1 if total * s.chance >= tested else 2
        # A term cannot predict an entity better than it does the entity's kind.
        wanted = counts.where(
            (F.col("texts") >= least) & (F.col("most") >= s.min_share * F.col("texts"))
        )
        wanted = small_or_shuffled(wanted.select("term", "texts"), "terms-wanted")
        often = small_or_shuffled(holders.where(F.col("held") >= least), "entities-often")
        held = stage(held.join(often, "entity").select("entity", "held", "text_key"), "held-often")
        keys = small_or_shuffled(held.select("text_key").distinct(), "held-texts")
        inside = (
            self.docs.select(text_key().alias("text_key"), "text")
            .join(keys, "text_key", "left_semi")
            .select("text_key", F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
            .join(wanted, "term")
            .distinct()
        )
        together = (
            inside.join(held, "text_key")
            .groupBy("entity", "term", "texts", "held")
            .agg(F.count("*").alias("together"))
        )
        share = F.col("together") / F.col("texts")
        plain = F.col("held") / F.lit(float(total))
        missing = F.when(
            F.col("together") < F.col("texts"), (1 - share) * F.log((1 - share) / (1 - plain))
        ).otherwise(0.0)
        surprise = F.col("texts") * (share * F.log(share / plain) + missing)
        sure = F.when(share > plain, surprise >= math.log(tested / s.chance)).otherwise(False)
        return (
            together.where((share >= s.min_share) & sure)
            .select("entity", "term", share.alias("share"), F.log2(share / plain).alias("bits"))
            .where(F.col("bits") >= s.min_bits)
        )

    def term_spans(self) -> DataFrame:
        """``(doc_id, text_key, start, end, value, bits)`` of disclosing terms in holding documents."""
        found = (
            self.entities()
            .select("doc_id", "text_key", "entity")
            .distinct()
            .join(stage(self.disclosing(), "disclosing"), "entity")
            .groupBy("doc_id", "text_key", "term")
            .agg(F.max("bits").alias("bits"))
        )
        found = stage(found, "terms-found")
        keys = small_or_shuffled(found.select("doc_id", "text_key").distinct(), "terms-documents")
        texts, of = beside(self.docs.select("doc_id", "text"), keys, text_key(), "inner")
        texts = texts.select(
            of["doc_id"].alias("_id"),
            of["text_key"].alias("_key"),
            F.coalesce("text", F.lit("")).alias("_text"),
        )
        part = F.regexp_extract_all(
            "_text", F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0)
        )
        parts = (
            texts.select("_id", "_key", part.alias("parts"))
            .select("_id", "_key", F.posexplode_outer("parts").alias("number", "value"))
            .where("value is not null")
            .distinct()
        )
        so_far = Window.partitionBy("_id", "_key").orderBy("number")
        length = F.char_length("value")
        placed = (
            parts.withColumn("end", F.sum(length).over(so_far))
            .withColumn("start", F.col("end") - length)
            .withColumn("_term", F.lower("value"))
        )
        same = (
            F.col("_id").eqNullSafe(F.col("doc_id"))
            & (F.col("_key") == F.col("text_key"))
            & (F.col("_term") == F.col("term"))
        )
        spans = placed.join(found, same).select(
            "doc_id", "text_key", "start", "end", "value", "bits"
        )
        base = self.base.select(
            F.col("doc_id").alias("_id"),
            F.col("text_key").alias("_key"),
            F.col("start").alias("_start"),
            F.col("end").alias("_end"),
        )
        inside = (
            F.col("doc_id").eqNullSafe(F.col("_id"))
            & (F.col("text_key") == F.col("_key"))
            & (F.col("start") < F.col("_end"))
            & (F.col("end") > F.col("_start"))
        )
        return spans.join(base, inside, "left_anti")

    def spans(self) -> DataFrame:
        """All spans, base ones with null ``bits``."""
        base = self.base.withColumn("bits", F.lit(None).cast("double"))
        return base.unionByName(self.term_spans().withColumn("kind", F.lit("term")))

    def by_document(self) -> DataFrame:
        """``(doc_id, text_key, spans)`` with the spans of a document in order."""
        one = F.struct(
            "start", rank(F.col("kind")).alias("rank"), "end", "kind", "value", "bits"
        )
        return (
            self.spans()
            .groupBy("doc_id", "text_key")
            .agg(F.sort_array(F.collect_list(one)).alias("spans"))
        )

    def _joined(self, docs: DataFrame) -> tuple[DataFrame, Column]:
        """Documents and the column of their spans."""
        found = small_or_shuffled(self.by_document(), "document-spans")
        joined, columns = beside(docs, found, text_key())
        return joined, columns["spans"]

    def report(self) -> DataFrame:
        """Counts by kind, the hash of the base spans, and all spans as text."""
        empty = F.array().cast(
            "array<struct<start bigint, rank bigint, end bigint, kind string, value string, bits double>>"
        )
        joined, own = self._joined(self.docs.select("doc_id", "text"))
        spans = F.coalesce(own, empty)
        shown = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind))
        base = F.filter(spans, lambda s: s["kind"] != "term")
        listed = F.array_join(F.transform(base, shown), ",")
        return joined.select(
            F.col("doc_id").cast("bigint"),
            *[count(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS],
            F.sha2(listed.cast("binary"), 256).alias("base_sha256"),
            F.array_join(F.transform(spans, shown), ",").alias("spans"),
        )

    def sanitised(self) -> DataFrame:
        """The rows with spans replaced by their kind, strongly disclosing terms removed."""
        text = F.col("text")
        start = F.struct(F.lit("").alias("made"), F.lit(0).cast("bigint").alias("at"))

        def mask(s: Column) -> Column:
            term = F.when(s["bits"] >= self.settings.remove_bits, "").otherwise("[TERM]")
            return F.when(s["kind"] == "term", term).otherwise(
                F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
            )

        def step(done: Column, s: Column) -> Column:
            kept = F.substring(
                text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int")
            )
            new = F.concat(done["made"], kept, mask(s))
            return F.struct(
                F.when(s["start"] >= done["at"], new).otherwise(done["made"]).alias("made"),
                F.greatest(done["at"], s["end"]).alias("at"),
            )

        joined, spans = self._joined(self.docs)
        cut = F.aggregate(
            spans,
            start,
            step,
            lambda done: F.concat(done["made"], F.substring(text, (done["at"] + 1).cast("int"), F.char_length(text))),
        )
        return joined.withColumn(
            "text", F.when(spans.isNotNull(), cut).otherwise(text)
        ).select(*columns_of(self.docs))
