"""Cutting a long joined text where no token can reach across.

A whole split is encoded as one text, so pieces may merge across documents, but
no task can hold a split.  The pieces of the split pattern never hold white
space after other characters, and never go on from letters or digits to another kind of
character, so the text can be cut there with the same tokens on either side.

Documents that offer no such place, the words of a script without white space for
instance, are joined with their neighbours.  Where they would come to more than
``block_bytes``, one that is all letters, all digits or all marks is cut inside, at a soft
border, which a token may cross; :mod:`tokenmill.operators.longpieces` sees to that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.operators.ordering import RowOrder, inside_total, totals_by_bucket, with_base
from tokenmill.operators.splits import TEST, TRAIN, VAL

BLOCK_BYTES = 1 << 16

# A document up to its first safe cut; nothing if it has none.
_HEAD = (
    r"(?U)^(\s*+(?:\p{L}++(?=[\p{N}\p{P}\p{S}\s])|\p{N}++(?=[\p{L}\p{P}\p{S}\s])|"
    r"[\p{P}\p{S}]++(?=[\p{N}\s]))|\s*+\S++(?=\s))"
)
# Documents that can be cut inside at a soft border.
_ONE_KIND = r"(?U)^(?:\p{L}+|\p{N}+|[\p{P}\p{S}&&[^']]+)$"
#: Longest document that a soft border is looked for in, as a power of two of characters.
_MOST_BITS = 30


def _within(text: Column, size: Column) -> Column:
    """How many characters of a text fit into so many bytes, by a binary search."""
    strides = F.array(*[F.lit(1 << bit) for bit in reversed(range(_MOST_BITS))])

    def longer(below: Column, stride: Column) -> Column:
        fits = (below + stride <= F.char_length(text)) & (
            F.octet_length(F.substring(text, F.lit(1), below + stride)) <= size
        )
        return F.when(fits, below + stride).otherwise(below)

    return F.aggregate(strides, F.lit(0), longer)


def split_units(
    corpus: DataFrame, order: RowOrder, starts: tuple[int, int], block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The joined text of each positional split in units.

    Columns ``(split, seq, is_first, soft_start, soft_end, text)``.  A unit starts at the
    first safe cut of a document and ends at the first one of a later document, so it
    is one document long as a rule.  Documents without a cut are passed through to the
    unit they are in, which ends at a soft border beyond ``block_bytes``.  The order is
    cut where the validation and the test rows start.
    """
    keys = order.keys
    text = F.coalesce(F.col("text"), F.lit(""))
    hard = (F.regexp_extract(text, _HEAD, 1) != "").cast("bigint")
    shape = corpus.select(
        *keys,
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        hard.alias("hard"),
        text.rlike(_ONE_KIND).alias("one_kind"),
    )
    first_bytes = F.floor(F.col("at") / block_bytes)
    crosses = first_bytes != F.floor((F.col("at") + F.col("n_bytes") - 1) / block_bytes)
    soft = (
        (F.col("hard") == 0) & F.col("one_kind") & crosses & (F.col("n_bytes") > 4)
    )

    def cut(ordered: DataFrame) -> DataFrame:
        """Add where a document lies in its key range, and whether it is cut."""
        placed = ordered.withColumn("at", inside_total("n_bytes")).withColumn("soft", soft)
        return placed.withColumn("cuts", F.col("hard") + F.col("soft").cast("bigint"))

    cuts = totals_by_bucket(cut(order.with_ordinal(shape)), "cuts", order.n_buckets)
    ordered = order.with_ordinal(corpus.select(*keys, text.alias("text"))).withColumns(
        {
            "n_bytes": F.octet_length("text").cast("bigint"),
            "hard": hard,
            "one_kind": F.col("text").rlike(_ONE_KIND),
        }
    )
    counted = cut(ordered).withColumn("inside", inside_total("cuts"))
    to_border = (first_bytes + 1) * block_bytes - F.col("at")
    fitting = F.least(F.greatest(_within(F.col("text"), to_border), F.lit(1)), F.char_length("text") - 1)
    head = F.when(F.col("soft"), F.left("text", fitting)).otherwise(
        F.regexp_extract("text", _HEAD, 1)
    )
    numbered = (
        with_base(counted, cuts, "base")
        .withColumn("seq", F.col("base") + F.col("inside"))
        .withColumn("head", head)
    )
    body = F.substring("text", F.char_length("head") + 1, F.char_length("text"))

    def part(seq, place, text):
        return F.struct(seq.alias("seq"), F.lit(place).alias("place"), text.alias("text"))

    parts = F.when(
        F.col("cuts") == 1,
        F.array(part(F.col("seq"), 0, F.col("head")), part(F.col("seq") + 1, 1, body)),
    ).otherwise(F.array(part(F.col("seq"), 0, F.col("text"))))
    ord_ = F.col("ord")
    split = F.when(ord_ < starts[0], TRAIN).when(ord_ < starts[1], VAL).otherwise(TEST)
    opens = ord_.isin([0, *starts]) & (F.col("part.place") == 0)
    fragments = (
        numbered.select("ord", "soft", split.alias("split"), F.explode(parts).alias("part"))
        .select("split", "ord", "soft", "part.*", opens.alias("opens"))
        .where((F.col("text") != "") | F.col("opens"))
    )
    in_order = F.array_sort(F.collect_list(F.struct("ord", "place", "text")))
    return (
        fragments.groupBy("split", "seq")
        .agg(
            in_order.alias("found"),
            F.bool_or("opens").alias("is_first"),
            F.bool_or(F.col("soft") & (F.col("place") == 1)).alias("soft_start"),
            F.bool_or(F.col("soft") & (F.col("place") == 0)).alias("soft_end"),
        )
        .select(
            "split", "seq", "is_first", "soft_start", "soft_end",
            F.array_join("found.text", "").alias("text"),
        )
    )
