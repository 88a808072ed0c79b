"""The registered queries: every operator of the package over the given tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.functions import steps
from tokenmill.functions.text import shard_name, with_boundaries
from tokenmill.functions.tokens import in_vocabulary, out_of_range, truncate
from tokenmill.operators import metrics, scores
from tokenmill.operators.chunks import chunk_rows
from tokenmill.operators.earlystop import Patience, early_stop, early_stop_trace, improvements
from tokenmill.operators.encode import BpeEncoder, ByteEncoder, decode
from tokenmill.operators.ordering import RowOrder
from tokenmill.operators.pack import (
    Packed,
    planned_manifest,
    shards_per_split,
    with_progress,
)
from tokenmill.operators.schedule import batch_schedule, by_step, eval_batches, training_manifest
from tokenmill.operators.splits import TRAIN, VAL, positional_split
from tokenmill.operators.windows import (
    next_token_pairs,
    random_prompt,
    rank_batches,
    token_windows,
)
from tokenmill.plans.corpus import (
    CorpusPlan,
    corpus_manifest,
    corpus_to_shards,
    corpus_tokens,
    encoded_chunks,
    split_tokens,
)
from tokenmill.plans.training import prompt_text, validate_runs
from tokenmill.sources import npy, runlog
from tokenmill.sources.corpus import (
    Corpus,
    CorpusRegistry,
    append_texts,
    corpus_counts,
    load_corpus,
    read_texts,
    spread,
)
from tokenmill.sources.shards import (
    list_shards,
    read_pieces,
    read_shard,
    read_split_tokens,
    split_token_counts,
    write_shards,
    write_split_tokens,
)
from tokenmill.staging import new_path
from tokenmill.streaming.corpus import StreamPacker, stream_corpus
from tokenmill.streaming.monitor import RunMonitor, latest, monitor_runs

# Settings that the SQL counterparts repeat.
SHARD_SIZE = 100_000
BATCH_ROWS, LENGTH, RANKS = 4, 32, 4
RULE = Patience(patience=30, delta=0.2, mode="min")
TOP_K = 50
SEED = 42
MERGES = ("an", "in", "on", "en", "ion")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def documents(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return load_corpus(spark, f"{sf_dir}/documents.parquet", extra_columns=extra)


def registry(sf_dir: str) -> CorpusRegistry:
    path = f"{sf_dir}/documents.parquet"
    return CorpusRegistry(
        {
            "all": Corpus(path),
            "french": Corpus(path, "lang = 'fr'"),
            "first_source": Corpus(path, "source = 'src0'"),
            "chats": Corpus(f"{sf_dir}/conversations.parquet", order_by=("conv_id", "turn")),
        }
    )


def sample_ranks(spark: SparkSession) -> DataFrame:
    """Rank table of the 256 bytes and a few merges; a published table would be read here."""
    merges = F.array(*[F.lit(m) for m in MERGES])
    return spark.range(256 + len(MERGES)).select(
        "id",
        F.when(F.col("id") < 256, F.unhex(F.lpad(F.hex("id"), 2, "0")))
        .otherwise(F.encode(F.try_element_at(merges, (F.col("id") - 255).cast("int")), "utf-8"))
        .alias("bytes"),
    )


def id_sum(tokens: Column) -> Column:
    return F.aggregate(tokens, F.lit(0).cast("bigint"), lambda total, token: total + token)


def place_sum(tokens: Column, start: Column) -> Column:
    """Sum of id times place, which notices a wrong order."""
    weighted = F.transform(tokens, lambda token, i: token * ((start + i) % 1000))
    return F.aggregate(weighted, F.lit(0).cast("bigint"), lambda total, one: total + one)


# Sources, projections, chunks, splits


@register
def corpus_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_counts(documents(spark, sf_dir))


@register
def corpus_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_counts(documents(spark, sf_dir, "lang", "source"), ["lang", "source"])


@register
def registry_french(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry(sf_dir).load(spark, "french")


@register
def boundary_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = registry(sf_dir).load(spark, "chats")
    return chats.select("conv_id", "turn", with_boundaries(F.col("text")).alias("text"))


@register
def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks, _ = encoded_chunks(documents(spark, sf_dir), CorpusPlan())
    return chunks.select("chunk_id", "n_rows", "n_tokens")


@register
def chunk_text_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joined texts of chunks of a corpus with a two-column order."""
    chats = registry(sf_dir).load(spark, "chats")
    texts = chunk_rows(chats, ["conv_id", "turn"], 20).texts()
    return texts.select("chunk_id", "n_rows", F.md5(F.encode("text", "utf-8")).alias("digest"))


@register
def first_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunk limit, set to half of the corpus."""
    corpus = documents(spark, sf_dir)
    half = corpus.count() // 100 // 2
    rows = chunk_rows(corpus, "doc_id", 100, max_chunks=half).numbered()
    return rows.select("doc_id", "ord", "chunk_id")


@register
def split_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positional_split(documents(spark, sf_dir), "doc_id").select("doc_id", "split")


@register
def tokens_per_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write each split as tokens with one delimiter, read it back and count."""
    path = new_path(spark, "split_tokens")
    write_split_tokens(split_tokens(documents(spark, sf_dir)), path)
    return split_token_counts(read_split_tokens(spark, path, ["train_set", "val_set", "test_set"]))


@register
def bpe_tokens_per_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each split encoded as one text, with byte-pair ids."""
    encoder = BpeEncoder.from_table(sample_ranks(spark))
    tokens = split_tokens(documents(spark, sf_dir), encoder=encoder)
    return tokens.groupBy("split").agg(
        F.sum("n_tokens").alias("n_tokens"), F.sum(id_sum(F.col("tokens"))).alias("id_sum")
    )


@register
def text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append all texts to text files and read the lines back."""
    path = new_path(spark, "texts")
    append_texts(documents(spark, sf_dir), path)
    lines = read_texts(spark, path, whole=False)
    return lines.agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.char_length("text")).alias("n_chars")
    )


@register
def whole_text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same read back file by file, with all line feeds, after a second append."""
    path = new_path(spark, "texts")
    corpus = documents(spark, sf_dir)
    append_texts(corpus, path)
    append_texts(corpus, path)
    feeds = F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit("")))
    return read_texts(spark, path).agg(
        F.sum(F.char_length("text")).alias("n_chars"),
        F.sum(feeds).alias("n_feeds"),
        F.bool_and(F.endswith("text", F.lit("\n"))).alias("all_end"),
    )


@register
def chat_tokens_per_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits of a corpus with a two-column order, first row of each and tokens."""
    chats = registry(sf_dir).load(spark, "chats")
    tokens = split_tokens(chats, ["conv_id", "turn"])
    return tokens.groupBy("split").agg(
        F.min("seq.conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(id_sum(F.col("tokens"))).alias("id_sum"),
    )


@register
def split_without_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five regions give no validation rows; the split is its delimiter."""
    regions = spark.read.parquet(f"{sf_dir}/region.parquet").select(
        F.col("r_regionkey").cast("bigint").alias("doc_id"), F.col("r_name").alias("text")
    )
    path = new_path(spark, "split_tokens")
    write_split_tokens(split_tokens(regions), path)
    return split_token_counts(read_split_tokens(spark, path, ["train_set", "val_set", "test_set"]))


# Tokens


@register
def byte_token_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = CorpusPlan(delimit="document")
    tokens, _ = encoded_chunks(documents(spark, sf_dir), plan)
    return tokens.select(
        F.col("chunk_id").alias("doc_no"),
        "n_tokens",
        id_sum(F.col("tokens")).alias("id_sum"),
        place_sum(F.col("tokens"), F.lit(0)).alias("place_sum"),
    )


@register
def token_range_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids outside the storage range, and ids left by a vocabulary of 128."""
    tokens = ByteEncoder().encode(F.col("text"))
    corpus = spread(documents(spark, sf_dir, "lang"))
    encoded = corpus.select("lang", tokens.alias("tokens"))
    return encoded.groupBy("lang").agg(
        F.sum(F.size("tokens")).alias("n_tokens"),
        F.sum(out_of_range(F.col("tokens"))).alias("n_out_of_range"),
        F.sum(F.size(in_vocabulary(F.col("tokens"), 128))).alias("n_known"),
    )


@register
def truncated_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = truncate(ByteEncoder().encode(F.col("text")), 50)
    return documents(spark, sf_dir).select(
        "doc_id", F.size(tokens).alias("n_tokens"), id_sum(tokens).alias("id_sum")
    )


@register
def bpe_chunk_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoder = BpeEncoder.from_table(sample_ranks(spark))
    chunks, _ = encoded_chunks(documents(spark, sf_dir), CorpusPlan(), encoder)
    return chunks.select("chunk_id", "n_tokens", id_sum(F.col("tokens")).alias("id_sum"))


@register
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoder = BpeEncoder.from_table(sample_ranks(spark))
    corpus = spread(documents(spark, sf_dir))
    tokens = corpus.select("doc_id", encoder.encode(F.col("text")).alias("ids"))
    return tokens.select("doc_id", decode(F.col("ids"), encoder.ranks).alias("text"))


# Shards


def packed(spark: SparkSession, sf_dir: str, **settings: object) -> Packed:
    plan = CorpusPlan(shard_size=SHARD_SIZE, **settings)
    return corpus_to_shards(documents(spark, sf_dir), plan)


def planned(spark: SparkSession, sf_dir: str, **settings: object) -> DataFrame:
    plan = CorpusPlan(shard_size=SHARD_SIZE, **settings)
    return corpus_manifest(documents(spark, sf_dir), plan)


def written_shards(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "shards")
    write_shards(packed(spark, sf_dir).pieces, path)
    return path


def checksums(pieces: DataFrame) -> DataFrame:
    return pieces.groupBy("split", "shard_id").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(id_sum(F.col("tokens"))).alias("id_sum"),
        F.sum(place_sum(F.col("tokens"), F.col("start"))).alias("place_sum"),
    )


@register
def shard_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = shard_name(F.col("split"), F.col("shard_id"))
    return planned(spark, sf_dir).withColumn("name", name)


@register
def shard_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checksums(packed(spark, sf_dir).pieces)


@register
def shard_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planned(spark, sf_dir, max_shards=5)


@register
def pack_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the packing job reports while it writes."""
    pieces, seen = with_progress(packed(spark, sf_dir).pieces)
    write_shards(pieces, new_path(spark, "progress"))
    return spark.createDataFrame(
        [seen.get], "n_tokens bigint, n_shards bigint, open_tokens bigint"
    )


@register
def shard_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_shards(spark, written_shards(spark, sf_dir), TRAIN).drop("split")


@register
def shard_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shard out of the written table, ids widened."""
    shard = read_shard(spark, written_shards(spark, sf_dir), TRAIN, 0)
    return checksums(shard).drop("split")


@register
def split_shard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards_per_split(planned(spark, sf_dir))


@register
def npy_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "npy")
    npy.write_npy(packed(spark, sf_dir).pieces, path)
    return checksums(npy.read_npy(spark, path))


# Windows and schedules


@register
def window_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = read_pieces(spark, written_shards(spark, sf_dir))
    pairs = next_token_pairs(token_windows(pieces, LENGTH), LENGTH)
    return pairs.select(
        "split",
        "shard_id",
        "window",
        F.array_join("x", " ").alias("x"),
        F.array_join("y", " ").alias("y"),
    )


@register
def rank_batch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = read_pieces(spark, written_shards(spark, sf_dir))
    pairs = next_token_pairs(token_windows(pieces, LENGTH), LENGTH)
    rows = rank_batches(pairs, BATCH_ROWS, LENGTH, RANKS)
    return rows.select(
        "split", "shard_id", "window", "rank", "batch", "row",
        F.array_join("x", " ").alias("x"), F.array_join("y", " ").alias("y"),
    )


@register
def rank_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds through the training shards for each rank, in steps of 8 micro-batches."""
    total = corpus_tokens(documents(spark, sf_dir), CorpusPlan())
    train = planned_manifest(spark, total, SHARD_SIZE).where(F.col("split") == TRAIN)
    n = 2 * (total // (BATCH_ROWS * LENGTH * RANKS))
    return by_step(batch_schedule(train, BATCH_ROWS, LENGTH, RANKS, n), 8)


@register
def eval_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    val = planned(spark, sf_dir).where(F.col("split") == VAL)
    return eval_batches(val, BATCH_ROWS, LENGTH, RANKS)


@register
def training_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One epoch over the corpus in steps of 128 tokens."""
    total = corpus_tokens(documents(spark, sf_dir), CorpusPlan())
    plan = training_manifest(spark, total // 128, BATCH_ROWS, LENGTH, 1, 128)
    return plan.withColumn("lr", F.round("lr", 12))


@register
def prompt_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = read_pieces(spark, written_shards(spark, sf_dir), TRAIN)
    prompt = random_prompt(pieces, 0, 5, 7, SEED)
    return prompt.select("window", F.array_join("x", " ").alias("ids"))


@register
def prompt_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = read_pieces(spark, written_shards(spark, sf_dir), TRAIN)
    return prompt_text(pieces, {bytes([b]): b for b in range(256)})


# Scores


def score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def long_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_table(spark, sf_dir).select(
        F.col("vec_id").alias("pos"), F.posexplode("embedding").alias("id", "score")
    )


@register
def cross_entropy_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    losses = scores.mean_cross_entropy(score_table(spark, sf_dir), "embedding", "label", ("label",))
    return losses.withColumn("loss", F.round("loss", 9))


@register
def grouped_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = score_table(spark, sf_dir).withColumn("probs", scores.softmax(F.col("embedding")))
    return table.select(
        F.col("vec_id").alias("pos"), F.posexplode("probs").alias("id", "prob")
    ).withColumn("prob", F.round("prob", 9))


@register
def softmax_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over one row per class."""
    probs = scores.softmax_long(long_scores(spark, sf_dir))
    return probs.select("pos", "id", F.round("prob", 9).alias("prob"))


def drawn_from(table: DataFrame) -> DataFrame:
    best = scores.top_k(scores.softmax(F.col("embedding")), TOP_K)
    unit = scores.unit_draw(SEED, "vec_id")
    return table.select("vec_id", best.alias("best"), unit.alias("unit"))


@register
def topk_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = drawn_from(score_table(spark, sf_dir)).select(
        F.col("vec_id").alias("pos"), F.posexplode("best").alias("at", "item")
    )
    return ranked.select(
        "pos",
        (F.col("at") + 1).alias("rank_no"),
        F.col("item.id").alias("id"),
        F.round("item.prob", 9).alias("prob"),
    )


@register
def topk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = scores.top_k_long(scores.softmax_long(long_scores(spark, sf_dir)), k=TOP_K)
    return ranked.select("pos", "rank_no", "id", F.round("prob", 9).alias("prob"))


@register
def weighted_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = drawn_from(score_table(spark, sf_dir))
    item = scores.draw(F.col("best"), F.col("unit"))
    return drawn.select(F.col("vec_id").alias("pos"), item["id"].alias("id"))


@register
def weighted_draw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = scores.top_k_long(scores.softmax_long(long_scores(spark, sf_dir)), k=TOP_K)
    return scores.draw_long(ranked, scores.unit_draw(SEED, "pos")).select("pos", "id")


# Runs


def loss_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("step"),
        F.col("value").alias("loss"),
    )


def metric_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as metric records: 16 micro-batches on each of 4 ranks make a step."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("user_id").alias("run_id"),
        F.expr("event_id div 64").alias("step"),
        (F.col("event_id") % 4).cast("int").alias("rank"),
        F.col("value").alias("loss"),
        (F.col("value") * 10 + 100).alias("dt_ms"),
        F.lit(BATCH_ROWS * LENGTH).cast("bigint").alias("tokens"),
        "ts",
        "event_id",
    )


@register
def last_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.last_positions(loss_series(spark, sf_dir), "run_id", "step")


@register
def loss_by_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    losses = metrics.loss_by_step(metric_records(spark, sf_dir))
    return losses.withColumn("loss", F.round("loss", 9))


@register
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = metric_records(spark, sf_dir)
    rates = metrics.throughput(records).join(
        metrics.wall_time(records, "ts").withColumnRenamed("seconds", "wall_seconds"), "run_id"
    )
    rounded = {c: F.round(c, 6) for c in ("seconds", "tokens_per_second", "wall_seconds")}
    return rates.withColumns(rounded)


def run_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log lines; every seventh is not a record."""
    event = spark.read.parquet(f"{sf_dir}/events.parquet")
    step = F.col("event_id")
    line = runlog.run_line(
        step,
        F.col("value"),
        F.col("value") / 2,
        steps.learning_rate(step),
        F.col("value") * 10 + 100,
        F.lit(524288),
    )
    return event.select(F.when(step % 7 == 3, F.concat(F.lit("? "), "event_type")).otherwise(line))


def run_log(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "runlog")
    runlog.append_lines(run_lines(spark, sf_dir), path)
    return path


def parsed_columns(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        "step",
        "loss",
        F.round("norm", 3).alias("norm"),
        "lr",
        F.round("dt_ms", 1).alias("dt_ms"),
        "tokens_processed",
    )


@register
def run_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = runlog.read_lines(spark, run_log(spark, sf_dir))
    return parsed_columns(runlog.parse_run_log(lines))


@register
def run_log_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = runlog.malformed(runlog.read_lines(spark, run_log(spark, sf_dir)))
    return lines.groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n_lines"))


@register
def validation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "vallog")
    series = loss_series(spark, sf_dir)
    runlog.append_lines(series.select(runlog.validation_line(F.col("step"), F.col("loss"))), path)
    return runlog.parse_validation_log(runlog.read_lines(spark, path))


@register
def monitored_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation steps that also hit the monitor period, as a filter on the loss series."""
    series = loss_series(spark, sf_dir)
    n = series.agg(F.max("step") + 1).first()[0]
    return series.where(steps.is_monitored(F.col("step"), 20, 30, n))


@register
def early_stop_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return early_stop(loss_series(spark, sf_dir), RULE)


@register
def early_stop_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return early_stop_trace(loss_series(spark, sf_dir), RULE)


@register
def improvement_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return improvements(loss_series(spark, sf_dir), RULE)


@register
def validation_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batch losses to rank means to step means to early stopping, per run."""
    records = metric_records(spark, sf_dir).withColumn("step", F.expr("event_id div 1000"))
    return validate_runs(records, RULE, digits=6)


# Streams


def arrivals(df: DataFrame, key: str, parts: int) -> Iterator[DataFrame]:
    """The table in ``parts`` consecutive key ranges, as it would arrive over time."""
    order = RowOrder.fit(df, key)
    cuts = [order.n_rows * i // parts for i in range(parts + 1)]
    order = order.recut(df, cuts)
    for start, stop in zip(cuts, cuts[1:]):
        yield df.where(~order.before(df, start) & order.before(df, stop))


@register
def stream_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack the corpus as files arrive, with a restart of the stream after each arrival."""
    corpus = documents(spark, sf_dir)
    source, checkpoint = new_path(spark, "stream_in"), new_path(spark, "stream_checkpoint")
    packer = StreamPacker(new_path(spark, "stream_out"), CorpusPlan(shard_size=SHARD_SIZE))
    for part in arrivals(corpus, "doc_id", 3):
        part.write.mode("append").parquet(source)
        stream = stream_corpus(spark, source, corpus.schema)
        packer.start(stream, checkpoint).awaitTermination()
    return checksums(packer.packed(spark).pieces)


@register
def stream_pack_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the corpus in a limit on chunks, one arrival per micro-batch."""
    corpus = documents(spark, sf_dir)
    source, checkpoint = new_path(spark, "stream_in"), new_path(spark, "stream_checkpoint")
    plan = CorpusPlan(shard_size=SHARD_SIZE, max_chunks=corpus.count() // 100 // 2)
    packer = StreamPacker(new_path(spark, "stream_out"), plan)
    for part in arrivals(corpus, "doc_id", 4):
        part.coalesce(1).write.mode("append").parquet(source)
    stream = stream_corpus(spark, source, corpus.schema, files_per_batch=1)
    packer.start(stream, checkpoint).awaitTermination()
    return checksums(packer.packed(spark).pieces)


@register
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each micro-batch took in and packed, and how full it left the open shard."""
    corpus = documents(spark, sf_dir)
    source, checkpoint = new_path(spark, "stream_in"), new_path(spark, "stream_checkpoint")
    packer = StreamPacker(new_path(spark, "stream_out"), CorpusPlan(shard_size=SHARD_SIZE))
    for part in arrivals(corpus, "doc_id", 3):
        part.coalesce(1).write.mode("append").parquet(source)
    stream = stream_corpus(spark, source, corpus.schema, files_per_batch=1)
    packer.start(stream, checkpoint).awaitTermination()
    return packer.progress(spark)


@register
def stream_early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watch the runs as records arrive, with a restart after each arrival."""
    losses = loss_series(spark, sf_dir)
    source, checkpoint = new_path(spark, "losses_in"), new_path(spark, "losses_checkpoint")
    monitor = RunMonitor(new_path(spark, "losses_out"), RULE)
    for part in arrivals(losses, "step", 2):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(losses.schema).parquet(source)
        monitor.start(stream, checkpoint).awaitTermination()
    return monitor.state(spark)


@register
def stream_run_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the stateful operator on small micro-batches."""
    losses = loss_series(spark, sf_dir)
    source, out = new_path(spark, "losses_in"), new_path(spark, "states_out")
    checkpoint = new_path(spark, "states_checkpoint")
    for part in arrivals(losses, "step", 2):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(losses.schema).parquet(source)
        query = (
            monitor_runs(stream, RULE)
            .writeStream.outputMode("update")
            .foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}"))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return latest(spark.read.parquet(out).drop("batch"))


@register
def stream_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tail the run log as a stream into a table."""
    lines = runlog.stream_lines(spark, run_log(spark, sf_dir))
    out = new_path(spark, "runlog_out")
    query = (
        parsed_columns(runlog.parse_run_log(lines))
        .writeStream.format("parquet")
        .option("checkpointLocation", new_path(spark, "runlog_checkpoint"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return spark.read.parquet(out)
