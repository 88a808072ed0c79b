"""Remove lines that an earlier line of the corpus already has, exactly or nearly.

An exact set-similarity join with DataFrame expressions alone.  The tokens of a
line are its distinct runs of five words (a shorter line is one token).  Two lines
match if the Jaccard similarity of their tokens is at least 0.75; a line goes if
any line before it, in the order of ``doc_id`` and line number, matches it.

* Tokens are ordered by rarity.  How often a token occurs is estimated by a sketch:
  the counts of all tokens of the corpus in ``BUCKETS`` buckets by hash, a table of
  fixed size.  Any order that all lines share gives an exact join; this one puts
  what very many lines hold last.  Order and token are one number.
* Prefix filter: matching lines share a token among the first ``n - need(n) + 1``.
  Tokens that occur in the prefixes of different lines make the index.
* Length and positional filters drop pairs by the sizes of the sets and the places
  of a shared token.  So does a sketch of 128 parities per set: it differs in at most
  as many bits as the sets have tokens that the other lacks, so no match is lost.  The
  rest is verified on the whole sets.
* Lines with equal sets are one class and compared once.  In each list of the index
  one line is compared with all others first; after that only lines that nothing
  has removed yet are compared with the others.  A large group of near copies
  takes one comparison per line.

Contract: texts are split at line feeds, compared in lower case and by words
between white space; blank lines are never removed and remove nothing; null and
empty texts have no lines.  Rows equal in ``doc_id`` and text are one document and
have equal results; a null ``doc_id`` comes last.  Other columns pass through
``deduplicated`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenmill.llm.tables import beside, columns_of, small_or_shuffled
from tokenmill.staging import collecting, remove_staged, stage

WIDTH = 5
PERCENT = 75
BUCKETS = 1 << 14
EARLIER = 4
TOKENS_SENT = 2_000_000
MARKS = 1 << 21
BLANKS = "\t\x0b\x0c\r"


def text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def need(n: Column) -> Column:
    """Tokens of a set of ``n`` that a matching one holds at least."""
    return F.floor((PERCENT * n + 99) / 100).cast("int")


def line_rows(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_key, line_no, line)`` of all lines that are not blank, in lower case."""
    lines = F.split(F.lower(F.coalesce("text", F.lit(""))), "\n")
    # An inner explode would be given a filter that cuts the text a second time.
    rows = docs.select(
        F.col("doc_id").cast("bigint"),
        text_key().alias("text_key"),
        F.posexplode_outer(lines).alias("line_no", "line"),
    )
    line = F.col("line")
    other = line.contains(BLANKS[0])
    for blank in BLANKS[1:]:
        other = other | line.contains(blank)
    plain = F.when(other, F.translate(line, BLANKS, " " * len(BLANKS))).otherwise(line)
    return rows.withColumn("line", plain).where(F.trim("line") != "")


def words() -> Column:
    return F.array_remove(F.split("line", " "), "")


def bucket(run: Column) -> Column:
    """The bucket of a token, told by its words but the last one."""
    return run.bitwiseAND(BUCKETS - 1).cast("int")


def run_bucket(at: Column) -> Column:
    """The bucket of the token whose words, given as text, lie from ``at`` on.

    The words are hashed here rather than once each, as an expression on single values is
    compiled and one on arrays is not.
    """
    hashed = lambda step: F.xxhash64(F.get("words", at + step))
    found = hashed(0)
    for step in range(1, WIDTH - 1):
        found = F.xxhash64(found, hashed(step))
    return F.when(F.size("words") < WIDTH, 0).otherwise(bucket(found))


def starts() -> Column:
    return F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("words") - WIDTH))


def rarity_levels(lines: DataFrame) -> Column:
    """An array literal: a level for each bucket, which grows with its count, of 0 to 63 times 2 ** 57."""
    counts = (
        lines.select(words().alias("words"))
        .select("words", F.explode(starts()).alias("at"))
        .select(run_bucket(F.col("at")).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("n"))
        .select("bucket", F.least(F.lit(63), F.floor(2 * F.log2("n"))).alias("level"))
        .collect()
    )
    levels = ["0"] * BUCKETS
    for row in counts:
        levels[row["bucket"]] = str(row["level"] << 57)
    return F.split(F.lit(",".join(levels)), ",").cast("array<bigint>")


def token_sets(lines: DataFrame, levels: Column) -> DataFrame:
    """The lines with ``tokens``: their distinct tokens, rarest first.

    A token has 57 bits for its run of words below the level of its bucket; a shorter line
    is one run, in the bucket 0.
    """
    ranked = lambda at, run: F.get(levels, at).bitwiseOR(F.shiftrightunsigned(run, 7))
    count = F.size("words") - (WIDTH - 1)
    found = F.slice("words", F.lit(1), count)
    for step in range(1, WIDTH):
        following = F.slice("words", F.lit(step + 1), count)
        if step < WIDTH - 1:
            join = lambda run, word: F.xxhash64(run, word)
        else:
            join = lambda run, word: ranked(bucket(run), F.xxhash64(run, word))
        found = F.zip_with(found, following, join)
    short = F.array(ranked(F.lit(0), F.xxhash64("words")))
    hashed = lines.withColumn("words", F.transform(words(), lambda w: F.xxhash64(w))).drop("line")
    runs = F.when(count > 0, found).otherwise(short)
    return hashed.withColumn("tokens", F.sort_array(F.array_distinct(runs))).drop("words")


def parities(upper: bool) -> Column:
    """64 bits of the sketch of ``tokens``: each token turns one of its 128 bits over.

    Without ``upper`` the two halves on top of each other.  Few and plain steps, as they are
    taken for every token and are not compiled.
    """

    def turned(bits: Column, token: Column) -> Column:
        one = F.getbit(token, F.lit(6)).cast("bigint") if upper else F.lit(1).cast("bigint")
        # Of the places to shift by only the last six bits count.
        return bits.bitwiseXOR(F.call_function("shiftleft", one, F.hash(token)))

    return F.aggregate("tokens", F.lit(0).cast("bigint"), turned)


def position() -> Column:
    return F.struct(
        F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("text_key"), F.col("line_no")
    )


def with_earlier(lists: DataFrame) -> DataFrame:
    """The lists with ``earlier``, the last ``EARLIER`` tokens of the line before in its prefix."""
    order = Window.partitionBy("one", "n").orderBy("place").rowsBetween(-EARLIER, -1)
    return lists.withColumn("earlier", F.collect_list("token").over(order))


class LineDedup:
    """Which lines of one table of documents go."""

    def __init__(self, docs: DataFrame):
        self.docs = docs
        self.levels = rarity_levels(line_rows(docs))
        n = F.size("tokens")
        self.lines = stage(
            token_sets(line_rows(docs), self.levels).select(
                "doc_id",
                "text_key",
                "line_no",
                F.xxhash64("tokens").alias("one"),
                F.xxhash64(F.lit(1), "tokens").alias("two"),
                n.alias("n"),
                F.slice("tokens", F.lit(1), n - need(n) + 1).alias("prefix"),
                parities(False).alias("both"),
                parities(True).alias("high"),
            ),
            "line-prefixes",
        )
        self.classes = stage(
            self.lines.groupBy("one", "two", "n").agg(F.min(position()).alias("first")),
            "line-classes",
        )

    def index(self) -> DataFrame:
        """``(token, one, n, place, both, high)``: prefix tokens that occur in different sets."""
        tokens = self.lines.select(
            "one", "n", "both", "high", F.posexplode("prefix").alias("place", "token")
        )
        shared = small_or_shuffled(
            tokens.groupBy("token")
            .agg(F.min("one").alias("least"), F.max("one").alias("most"))
            .where("least <> most")
            .select("token"),
            "shared-tokens",
            TOKENS_SENT,
        )
        kept = tokens.join(shared, "token").select("token", "one", "n", "place", "both", "high")
        return stage(kept.distinct(), "line-index")

    def token_sets_of(self, classes: DataFrame) -> DataFrame:
        """``(one, two, first, tokens)``: whole sets of classes ``(one, two, first)``.

        Only the texts of marked documents are cut into lines, those that hold a wanted one
        and some others: the marks are of a fixed number, so that all tasks can have them.
        """
        wanted = small_or_shuffled(
            classes.select(
                "one",
                "two",
                F.col("first.doc_id").alias("_id"),
                F.col("first.text_key").alias("_key"),
                F.col("first.line_no").alias("_no"),
                "first",
            ),
            "wanted-lines",
        )
        mark = lambda doc_id, key: F.xxhash64(doc_id, key).bitwiseAND(MARKS - 1)
        marks = wanted.select(mark(F.col("_id"), F.col("_key")).alias("_mark")).distinct()
        marks = stage(marks, "line-marks")
        own = mark(F.col("doc_id").cast("bigint"), text_key())
        docs = self.docs.select("doc_id", "text").withColumn("_mark", own)
        docs = docs.join(F.broadcast(marks), "_mark", "left_semi")
        same = (
            F.col("doc_id").eqNullSafe(F.col("_id"))
            & (F.col("text_key") == F.col("_key"))
            & (F.col("line_no") == F.col("_no"))
        )
        sets = token_sets(line_rows(docs).join(wanted, same), self.levels)
        found = stage(sets.select("one", "two", "first", "tokens"), "line-sets")
        if found.count() != wanted.count():  # repeated rows hold the same line more than once
            found = stage(found.dropDuplicates(["one", "two"]), "line-sets")
        return found

    def matches(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The classes ``(one, two)`` that come later in a verified pair of classes."""
        spark = self.docs.sparkSession
        with collecting() as made:
            pairs = stage(pairs.distinct(), "line-pairs")
            used = small_or_shuffled(
                pairs.select(F.col("a").alias("one")).union(pairs.select("b")).distinct(),
                "line-used",
            )
            sets = self.token_sets_of(classes.join(used, "one", "left_semi"))
            side = lambda name: sets.select(
                F.col("one").alias(name),
                F.col("two").alias(f"{name}_two"),
                F.col("first").alias(f"{name}_first"),
                F.col("tokens").alias(f"{name}_tokens"),
            )
            joined = pairs.join(side("a"), "a").join(side("b"), "b")
            both = F.size(F.array_intersect("a_tokens", "b_tokens"))
            union = F.size("a_tokens") + F.size("b_tokens") - both
            later = F.col("a_first") > F.col("b_first")
            pick = lambda one, two: F.when(later, F.col(one)).otherwise(F.col(two))
            found = stage(
                joined.where(100 * both >= PERCENT * union)
                .select(pick("a", "b").alias("one"), pick("a_two", "b_two").alias("two"))
                .distinct(),
                "later-lines",
            )
        remove_staged(spark, made, [found])
        return found

    def near(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """Pairs of the two sides of the index that pass the filters by length, place and sketch.

        With ``earlier``, a pair that shares one of the last tokens before is left to the list
        of that token, so that lines which share several make their pair once.
        """
        a = left.select(
            "token",
            F.col("one").alias("a"),
            F.col("n").alias("a_n"),
            F.col("place").alias("a_place"),
            F.col("both").alias("a_both"),
            F.col("high").alias("a_high"),
            *[c for c in left.columns if c.startswith("a_")],
        )
        n, place = F.col("n"), F.col("place")
        length = 100 * F.least("n", "a_n") >= PERCENT * F.greatest("n", "a_n")
        most = (
            F.least(place, F.col("a_place"))
            + F.least(n - place, F.col("a_n") - F.col("a_place"))
        )
        positional = (100 + PERCENT) * most >= PERCENT * (n + F.col("a_n"))
        high = F.col("high").bitwiseXOR(F.col("a_high"))
        low = F.col("both").bitwiseXOR(F.col("a_both")).bitwiseXOR(high)
        apart = F.bit_count(low) + F.bit_count(high)
        alike = (100 + PERCENT) * apart <= (100 - PERCENT) * (n + F.col("a_n"))
        condition = (F.col("one") != F.col("a")) & length & positional & alike
        if "b_first" in right.columns:
            made_before = F.arrays_overlap("earlier", "a_earlier")
            condition = condition & (F.col("a_first") < F.col("b_first")) & ~made_before
        return right.join(a, "token").where(condition).select("a", F.col("one").alias("b"))

    def later_classes(self) -> DataFrame:
        """Classes whose first line matches a line of another class before it."""
        index = self.index()
        classes = stage(
            index.select("one").distinct().join(self.classes, "one").select("one", "two", "first"),
            "line-candidates",
        )
        head = F.min(F.struct("one", "n", "place", "both", "high")).alias("head")
        lists = stage(index.groupBy("token").agg(head, F.count("*").alias("size")), "line-lists")
        heads = lists.select("token", "head.*")
        gone = self.matches(self.near(heads, index), classes)
        firsts = small_or_shuffled(
            classes.join(gone.withColumn("gone", F.lit(True)), ["one", "two"], "left").select(
                "one", "first", F.coalesce("gone", F.lit(False)).alias("gone")
            ),
            "line-states",
        )
        long = lists.where("size > 2").select("token", F.col("head.one").alias("head"))
        rest = index.join(small_or_shuffled(long, "line-heads"), "token").where("one <> head")
        rest = stage(with_earlier(rest.drop("head").join(firsts, "one")), "line-rest")
        earlier = rest.withColumnsRenamed({"first": "a_first", "earlier": "a_earlier"}).drop("gone")
        still = rest.where("not gone").withColumnRenamed("first", "b_first").drop("gone")
        return gone.unionByName(self.matches(self.near(earlier, still), classes)).distinct()

    def removed(self) -> DataFrame:
        """``(doc_id, text_key, n_lines, removed)``: line numbers that go, for every document."""
        with collecting() as made:
            later = small_or_shuffled(self.later_classes(), "later-lines")
            later = later.withColumn("later", F.lit(True))
            classes = stage(
                self.classes.join(later, ["one", "two"], "left").select(
                    "one", "two", "n", "first", F.coalesce("later", F.lit(False)).alias("later")
                ),
                "line-fates",
            )
        remove_staged(self.docs.sparkSession, made, [classes])
        keys = self.lines.select("doc_id", "text_key", "line_no", "one", "two", "n")
        goes = F.col("later") | (F.col("first") != position())
        return (
            keys.join(classes, ["one", "two", "n"])
            .groupBy("doc_id", "text_key", "line_no")
            .agg(F.max(goes).alias("goes"))
            .groupBy("doc_id", "text_key")
            .agg(
                F.count("*").alias("n_lines"),
                F.sort_array(
                    F.collect_list(F.when(F.col("goes"), F.col("line_no")))
                ).alias("removed"),
            )
        )

    def report(self) -> DataFrame:
        """For every row its lines that are not blank, how many go, and which."""
        none = F.array().cast("array<int>")
        removed = small_or_shuffled(self.removed(), "removed-lines")
        joined, found = beside(self.docs.select("doc_id", "text"), removed, text_key())
        gone = F.coalesce(found["removed"], none)
        return joined.select(
            F.col("doc_id").cast("bigint"),
            F.coalesce(found["n_lines"], F.lit(0)).cast("bigint").alias("n_lines"),
            F.size(gone).cast("bigint").alias("n_removed"),
            F.array_join(gone, ",").alias("removed"),
        )

    def deduplicated(self) -> DataFrame:
        """The documents without these lines; those of which only blank lines are left go."""
        removed = self.removed().where(F.size("removed") > 0)
        whole, found = beside(
            self.docs, small_or_shuffled(removed, "removed-lines"), text_key()
        )
        gone = found["removed"]
        lines = F.split("text", "\n")
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        cut = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
        return (
            whole.where(gone.isNull() | (F.size(gone) < found["n_lines"]))
            .withColumn("text", F.when(gone.isNotNull(), cut).otherwise(F.col("text")))
            .select(*columns_of(self.docs))
        )
