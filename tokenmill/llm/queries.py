"""The registered queries of this subpackage, each over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tokenmill.llm.contamination import Hits
from tokenmill.llm.exact_dedup import ExactDedup
from tokenmill.llm.language import identify, learn_languages
from tokenmill.llm.language_model import WHOLE, learn, score
from tokenmill.llm.line_dedup import LineDedup
from tokenmill.llm.mixing import mix_sources
from tokenmill.llm.ngram_join import NgramJoin
from tokenmill.llm.periodic import PeriodicRuns
from tokenmill.llm.privacy import Privacy
from tokenmill.llm.quality import learn_quality, with_quality
from tokenmill.llm.tables import fold_of
from tokenmill.llm.token_counts import token_counts
from tokenmill.llm.vector_dedup import VectorDedup
from tokenmill.llm.whitening import Whitening

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024
SOURCE_WEIGHTS = (5.0, 2.0, 1.0)


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def held_out(folds: int, fold: int) -> Column:
    return F.coalesce(fold_of("doc_id", folds) == fold, F.lit(False))


@register
def op1_sorted_projection_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return VectorDedup(table(spark, sf_dir, "embeddings")).report()


@register
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Privacy(table(spark, sf_dir, "documents")).report()


@register
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"), SOURCE_WEIGHTS)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@register
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = Hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.report().select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


@register
def op6_line_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learn_quality(docs, labels.where(fold_of("doc_id", 4) != 2))
    return with_quality(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(4, 2).alias("held_out"), "score", "predicted"
    )


@register
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn_languages(docs.where(fold_of("doc_id", 5) != 0))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score"
    )


@register
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LineDedup(table(spark, sf_dir, "documents")).report()


@register
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = NgramJoin(table(spark, sf_dir, "documents")).groups()
    return groups.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


@register
def op10_suffix_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tree, words = learn(docs.where(fold_of("doc_id", 10) != 0), WHOLE)
    return score(docs, tree, words).withColumn("held_out", held_out(10, 0))


@register
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ExactDedup(table(spark, sf_dir, "documents")).report()
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    return found.select("doc_id", "keep_id", "group_size", "kept", digest)


@register
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Whitening(table(spark, sf_dir, "embeddings")).report()
    return rows.withColumn("deviation", F.col("deviation").cast("bigint"))


@F.arrow_udf(StringType())
def planted(texts: pa.Array, places: pa.Array) -> pa.Array:
    """The texts with the words from some word on repeated, as the contract plants runs."""
    found: list[str | None] = []
    for text, g in zip(texts.to_pylist(), places.to_pylist(), strict=True):
        words = text.encode().split() if text else []
        if words:
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            again = -(-(len(words) - a) // p)
            words = (words[:a] + words[a : a + p] * again)[: len(words)]
        found.append(b" ".join(words).decode() if words else text)
    return pa.array(found, pa.string())


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, with a run planted in one document of ten."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.when(hashed % 10 == 0, F.col("text"))
    text = F.coalesce(planted(chosen, F.floor(hashed / 10)), F.col("text"))
    return docs.select("doc_id", text.alias("text"))


@register
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = PeriodicRuns(with_planted_runs(table(spark, sf_dir, "documents"))).report()
    higher = lambda x, y: y["length"] * x["period"] > x["length"] * y["period"]
    top = F.aggregate(
        "runs", F.get("runs", F.lit(0)), lambda x, y: F.when(higher(x, y), y).otherwise(x)
    )
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


# The hits by joins on the words themselves; items of fewer than ten words are one window.
SQL["op4_decontaminate"] = r"""
with d as (
  select doc_id, rid, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w
  from (select *, row_number() over () rid from documents)),
b as (
  select item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w
  from benchmark),
g as (
  select distinct item_id, k, array_to_string(w[i + 1 : i + k], ' ') gram
  from (select *, least(10, len(w)) k from b where len(w) > 0), range(0, 100000) r(i)
  where i <= len(w) - k),
lens as (select distinct k from g),
x as (
  select rid, i, lens.k k, array_to_string(w[i + 1 : i + lens.k], ' ') gram
  from (select rid, w, unnest(range(0, len(w))) i from d), lens where i + lens.k <= len(w)),
h as (select rid, i, x.k k, item_id from x join g using (gram)),
p as (select rid, count(distinct i + j) n_hit from h, range(0, 10) r(j) where j < k group by rid),
t as (select rid, count(distinct item_id) n_items,
        array_to_string(list_sort(list(distinct item_id::varchar)), ',') items
      from h where item_id is not null group by rid)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit,
  coalesce(n_items, 0)::bigint n_items, sha256(coalesce(items, '')) items_sha256,
  coalesce(n_hit, 0) > 0 contaminated
from d left join p using (rid) left join t using (rid)
"""

# All pairs of lines that share a run of words, by a join on the run itself.
SQL["op8_line_dedup"] = r"""
with l as (
  select doc_id, i, list_filter(regexp_split_to_array(lower(line), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') w
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) line,
          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 i
        from documents)),
s as (
  select doc_id, i, list_sort(list_distinct(list_transform(range(0, greatest(len(w) - 4, 1)),
    lambda j: array_to_string(w[j + 1 : j + 5], ' ')))) t
  from l where len(w) > 0),
c as (select t, len(t) n, min(struct_pack(a := doc_id, b := i)) f, row_number() over () id
      from s group by t),
u as (select id, n, f, unnest(t) k from c),
p as (select x.id id from u x join u y on x.k = y.k and y.f < x.f
      group by x.id, y.id, x.n, y.n having 100 * count(*) >= 75 * (x.n + y.n - count(*))),
r as (
  select doc_id, count(*) n_lines,
    list_sort(list(i) filter (f <> struct_pack(a := doc_id, b := i)
                              or id in (select id from p))) g
  from s join c using (t) group by doc_id)
select d.doc_id, coalesce(n_lines, 0)::bigint n_lines, coalesce(len(g), 0)::bigint n_removed,
  coalesce(array_to_string(g, ','), '') removed
from documents d left join r on d.doc_id = r.doc_id
"""

SQL["op11_exact_dedup"] = r"""
with d as (
  select doc_id, length(coalesce(text, '')) n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) text_sha256
  from documents)
select doc_id, first_value(doc_id) over g keep_id, count(*) over (partition by text_sha256) group_size,
  row_number() over g = 1 kept, text_sha256
from d window g as (partition by text_sha256 order by n desc, doc_id nulls last)
"""
