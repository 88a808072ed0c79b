import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from models import pack as model_pack
from models import shuffles
from pyspark.sql import functions as F

from tokenmill.operators.chunks import chunk_rows
from tokenmill.operators.encode import (
    SPLIT_PATTERN,
    BpeEncoder,
    ByteEncoder,
    as_column,
    decode,
    encode_in_order,
    sliced,
    utf8_bytes,
)
from tokenmill.operators.pack import (
    PIECE_TOKENS,
    cut_into_shards,
    shard_manifest,
    shards_per_split,
    with_progress,
)
from tokenmill.operators.seams import split_units
from tokenmill.plans.corpus import (
    CorpusPlan,
    corpus_manifest,
    corpus_to_shards,
    encoded_chunks,
    split_tokens,
)
from tokenmill.sources.corpus import (
    Corpus,
    CorpusRegistry,
    append_texts,
    corpus_counts,
    load_corpus,
    read_texts,
)
from tokenmill.sources.npy import read_npy, write_npy
from tokenmill.sources.shards import (
    list_shards,
    read_pieces,
    read_shard,
    read_split_tokens,
    split_token_counts,
    write_shards,
    write_split_tokens,
)

TEXT = "doc_id bigint, text string"


def corpus(spark, texts):
    rows = list(enumerate(texts))
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, TEXT)


def some_texts(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab é\n☃") for _ in range(rng.randrange(12))) for _ in range(n)]


def byte_chunks(texts, size):
    joined = ["".join(texts[at : at + size]) for at in range(0, len(texts), size)]
    return [[256, *one.encode()] for one in joined]


def shards_of(pieces):
    found = {}
    for r in sorted(pieces.collect(), key=lambda r: (r["shard_id"], r["start"])):
        split, tokens, size = found.setdefault(r["shard_id"], (r["split"], [], r["shard_tokens"]))
        assert split == r["split"] and r["start"] == len(tokens)
        assert r["n_tokens"] == len(r["tokens"])
        tokens.extend(r["tokens"])
    assert sorted(found) == list(range(len(found)))
    assert all(len(tokens) == size for _, tokens, size in found.values())
    return [found[k][:2] for k in sorted(found)]


@pytest.mark.parametrize("size", [1, 5, 64])
def test_shards_equal_one_long_stream(spark, size):
    texts = some_texts(60)
    plan = CorpusPlan(chunk_size=7, shard_size=size, buckets=5)
    packed = corpus_to_shards(corpus(spark, texts), plan)
    expected = model_pack(byte_chunks(texts, 7), size)
    assert shards_of(packed.pieces) == expected
    manifest = sorted(map(tuple, packed.manifest().collect()))
    assert manifest == sorted((s, i, len(t)) for i, (s, t) in enumerate(expected))
    assert manifest == sorted(map(tuple, shard_manifest(packed.pieces).collect()))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    texts=st.lists(st.text(max_size=8), min_size=1, max_size=25),
    chunk=st.integers(1, 6),
    size=st.integers(1, 40),
    buckets=st.integers(1, 4),
)
def test_packing_property(spark, texts, chunk, size, buckets):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    plan = CorpusPlan(chunk_size=chunk, shard_size=size, buckets=buckets)
    packed = corpus_to_shards(corpus(spark, texts), plan)
    assert shards_of(packed.pieces) == model_pack(byte_chunks(texts, chunk), size)


@pytest.mark.parametrize("extra", [-1, 0, 1])
def test_a_stream_that_ends_at_a_border_has_no_validation_shard(spark, extra):
    texts = ["a" * 9, "b" * 9, "c" * (9 + extra)]
    packed = corpus_to_shards(corpus(spark, texts), CorpusPlan(chunk_size=1, shard_size=10))
    splits = [split for split, _ in shards_of(packed.pieces)]
    want = {-1: ["train_set"] * 2 + ["val_set"], 0: ["train_set"] * 3,
            1: ["train_set"] * 3 + ["val_set"]}
    assert splits == want[extra]


def test_empty_corpus_and_empty_texts(spark):
    none = corpus_to_shards(spark.createDataFrame([], TEXT), CorpusPlan())
    assert none.total_tokens == 0 and none.pieces.count() == 0 and none.manifest().count() == 0
    packed = corpus_to_shards(corpus(spark, ["", "", ""]), CorpusPlan(delimit="document"))
    assert shards_of(packed.pieces) == [("val_set", [256, 256, 256])]


def test_null_text_counts_as_empty(spark):
    df = spark.createDataFrame([(0, "a"), (1, None), (2, "b")], TEXT)
    for plan in (CorpusPlan(), CorpusPlan(delimit="document")):
        packed = corpus_to_shards(df, plan)
        (_, tokens), = shards_of(packed.pieces)
        assert [t for t in tokens if t < 256] == [97, 98]
        assert packed.total_tokens == len(tokens)


def test_chunk_and_shard_limits(spark):
    texts = ["x" * 9] * 50
    plan = CorpusPlan(chunk_size=5, shard_size=20, max_chunks=4, buckets=3)
    chunks, totals = encoded_chunks(corpus(spark, texts), plan)
    assert sorted(r["chunk_id"] for r in chunks.collect()) == [0, 1, 2, 3]
    assert sum(totals) == 4 * 46
    plan = CorpusPlan(chunk_size=5, shard_size=20, max_shards=3, buckets=3)
    packed = corpus_to_shards(corpus(spark, texts), plan)
    assert [len(t) for _, t in shards_of(packed.pieces)] == [20, 20, 20]
    assert packed.manifest().count() == 3


def test_a_planned_manifest_is_that_of_the_packed_shards(spark):
    texts = some_texts(40)
    for plan in (
        CorpusPlan(chunk_size=7, shard_size=90),
        CorpusPlan(delimit="document", shard_size=50, max_shards=3),
        CorpusPlan(chunk_size=5, shard_size=30, max_chunks=4),
    ):
        docs = corpus(spark, texts)
        want = corpus_to_shards(docs, plan).manifest().collect()
        assert corpus_manifest(docs, plan).collect() == want
    assert corpus_manifest(corpus(spark, [None, ""]), CorpusPlan()).collect()[0].n_tokens == 1


def test_one_shuffle_of_the_texts(spark):
    packed = corpus_to_shards(corpus(spark, some_texts(50)), CorpusPlan(chunk_size=5, buckets=4))
    plan = packed.pieces._jdf.queryExecution().executedPlan().toString()
    assert shuffles(plan) == 1 and "SinglePartition" not in plan


def test_lengths_alone_do_not_run_the_encoder(spark):
    chunks, _ = encoded_chunks(corpus(spark, some_texts(50)), CorpusPlan(chunk_size=5))
    plan = chunks.select("chunk_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan


RANKS = {**{bytes([b]): b for b in range(256)}, b"th": 256, b"le": 257, b" t": 258, b"the": 259}


def reference_ids(text):
    import tiktoken

    return tiktoken.Encoding(
        "t", pat_str=SPLIT_PATTERN, mergeable_ranks=RANKS, special_tokens={}
    ).encode_ordinary(text)


def test_bpe_equals_the_public_tokenizer(spark):
    texts = ["the little theatre", "", "it's the  end\n\n le", "é☃ 123 <|endoftext|>"] + some_texts(20)
    df = corpus(spark, texts)
    encoder = BpeEncoder(dict(RANKS))
    rows = df.select("doc_id", encoder.encode(F.col("text")).alias("ids")).collect()
    assert {r["doc_id"]: r["ids"] for r in rows} == {
        i: reference_ids(t) for i, t in enumerate(texts)
    }
    back = df.select("text", decode(encoder.encode(F.col("text")), RANKS).alias("again"))
    assert all(r["text"] == r["again"] for r in back.collect())


def test_pieces_merge_across_document_borders_in_chunk_mode(spark):
    df = corpus(spark, ["at", "he"])
    encoder = BpeEncoder({**{bytes([b]): b for b in range(256)}, b"th": 256, b"le": 257})
    chunk = corpus_to_shards(df, CorpusPlan(chunk_size=100), encoder)
    assert shards_of(chunk.pieces) == [("val_set", [258, 97, 256, 101])]
    apart = corpus_to_shards(df, CorpusPlan(delimit="document"), encoder)
    assert shards_of(apart.pieces) == [("val_set", [258, 97, 116, 258, 104, 101])]


def test_bpe_shards_over_many_buckets(spark):
    texts = [f"the {i} little theatre" for i in range(60)]
    plan = CorpusPlan(chunk_size=7, shard_size=50, buckets=4)
    packed = corpus_to_shards(corpus(spark, texts), plan, BpeEncoder(dict(RANKS)))
    joined = ["".join(texts[at : at + 7]) for at in range(0, 60, 7)]
    chunks = [[260, *reference_ids(one)] for one in joined]
    assert shards_of(packed.pieces) == model_pack(chunks, 50)
    plan = packed.pieces._jdf.queryExecution().executedPlan().toString()
    assert shuffles(plan) == 0  # the staged chunks know their offsets


def test_encoding_in_order_adds_no_shuffle(spark):
    chunks = chunk_rows(corpus(spark, some_texts(60)), "doc_id", 7, buckets=4)
    encoder = BpeEncoder(dict(RANKS))
    encoded = encode_in_order(chunks.texts(), encoder, "bucket", "chunk_id")
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert shuffles(plan) == 1


def test_rank_tables_are_checked(spark):
    table = spark.createDataFrame([(0, b"a"), (2, b"b")], "id int, bytes binary")
    with pytest.raises(ValueError, match="gaps"):
        BpeEncoder.from_table(table)


def test_decode_drops_unknown_ids_and_survives_bad_bytes(spark):
    df = spark.createDataFrame([([104, 9999, -1, 105],), ([195],), ([],), ([256],)], "ids array<int>")
    vocabulary = {bytes([b]): b for b in range(256)}
    texts = [r[0] for r in df.select(decode(F.col("ids"), vocabulary)).collect()]
    assert texts == ["hi", "�", "", "<|endoftext|>"]


def test_ids_beyond_the_storage_type_fail(spark):
    packed = corpus_to_shards(corpus(spark, ["abc"]), CorpusPlan(), ByteEncoder(eot=70000))
    with pytest.raises(Exception, match="token id outside"):
        packed.pieces.select("tokens").collect()


def test_split_tokens_have_one_delimiter_per_split(spark, tmp_path):
    texts = ["ab"] * 40
    path = str(tmp_path / "tokens")
    write_split_tokens(split_tokens(corpus(spark, texts)), path)
    splits = ["train_set", "val_set", "test_set"]
    table = read_split_tokens(spark, path, splits)
    counts = {r["split"]: r["n_tokens"] for r in split_token_counts(table).collect()}
    assert counts == {"train_set": 65, "val_set": 13, "test_set": 5}
    firsts = [r["seq"] for r in table.where(F.array_contains("tokens", 256)).collect()]
    assert sorted(firsts) == [0, 32, 38]


def test_a_split_is_encoded_as_one_text(spark):
    rng = random.Random(8)
    words = ["the", "th", "e", "le", " ", "  ", "\n", "'", "ll", "é", "\u00a0", "12", "", "☃"]
    texts = ["".join(rng.choices(words, k=rng.randrange(6))) for _ in range(200)]
    units = split_tokens(corpus(spark, texts), encoder=BpeEncoder(dict(RANKS))).collect()
    found = {}
    for r in sorted(units, key=lambda r: r["seq"]):
        assert r["n_tokens"] == len(r["tokens"])
        found.setdefault(r["split"], []).extend(r["tokens"])
    cuts = {"train_set": texts[:160], "val_set": texts[160:190], "test_set": texts[190:]}
    assert found == {s: [260, *reference_ids("".join(t))] for s, t in cuts.items()}
    assert len(units) > 50


def test_splits_of_a_composite_key(spark):
    rows = [(f"c{i // 7:02}", i % 7, f"text {i}") for i in range(60)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "conv string, turn int, text string")
    want = {}
    for n, (_, _, text) in enumerate(sorted(rows)):
        split = "train_set" if n < 48 else "val_set" if n < 57 else "test_set"
        want.setdefault(split, [256]).extend(text.encode())
    for encoder in (None, BpeEncoder({bytes([b]): b for b in range(256)})):
        found = {}
        tokens = split_tokens(df, ["conv", "turn"], encoder=encoder).collect()
        for r in sorted(tokens, key=lambda r: r["seq"]):
            found.setdefault(r["split"], []).extend(r["tokens"])
        assert found == want


@pytest.mark.parametrize("n, without", [(0, 3), (1, 2), (3, 1), (7, 0)])
def test_a_split_without_documents_is_its_delimiter(spark, n, without):
    df = corpus(spark, ["ab"] * n)
    for encoder, eot in ((None, 256), (BpeEncoder(dict(RANKS)), 260)):
        rows = split_tokens(df, encoder=encoder).collect()
        assert {r["split"] for r in rows} == {"train_set", "val_set", "test_set"}
        assert [r["tokens"] for r in rows if r["seq"] is None] == [[eot]] * without
        assert sum(r["n_tokens"] for r in rows) == 3 + 2 * n


class Wild(ByteEncoder):
    """Gives ids beyond the storage type."""

    def length(self, text):
        return None

    def batch_encoder(self):
        return lambda texts: pa.array([[70_000]] * len(texts), pa.list_(pa.int32()))

    def encode(self, text):
        return as_column(self.batch_encoder(), text)


@pytest.mark.parametrize("delimit", ["chunk", "document"])
def test_ids_of_any_encoder_are_checked(spark, delimit):
    df = corpus(spark, ["abc"] * 3)
    with pytest.raises(Exception, match="token id outside"):
        corpus_to_shards(df, CorpusPlan(delimit=delimit), Wild())
    with pytest.raises(Exception, match="token id outside"):
        df.select(Wild().encode(F.col("text"))).collect()


def test_a_failed_export_keeps_the_old_one(spark, tmp_path):
    path = str(tmp_path / "npy")
    packed = corpus_to_shards(corpus(spark, ["x" * 99] * 9), CorpusPlan(chunk_size=3, shard_size=500))
    write_npy(packed.pieces, path)
    before = shards_of(read_npy(spark, path))
    bad = packed.pieces.withColumn("tokens", F.array(F.lit(70_000)))
    with pytest.raises(Exception, match="do not fit"):
        write_npy(bad, path)
    assert shards_of(read_npy(spark, path)) == before
    assert [p.name for p in tmp_path.iterdir()] == ["npy"]  # nothing of the attempt is left
    write_npy(packed.pieces.where("shard_id = 0"), path)
    assert shards_of(read_npy(spark, path)) == before[:1]


def test_written_shards_can_be_listed_and_pruned(spark, tmp_path):
    path = str(tmp_path / "shards")
    packed = corpus_to_shards(corpus(spark, ["x" * 99] * 30), CorpusPlan(chunk_size=3, shard_size=500))
    write_shards(packed.pieces, path)
    assert [r["shard_id"] for r in list_shards(spark, path, "train_set").collect()] == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError, match="no shards"):
        list_shards(spark, path, "test_set")
    shard = read_shard(spark, path, "train_set", 2)
    assert shard.schema["tokens"].dataType.simpleString() == "array<bigint>"
    raw = read_shard(spark, path, "train_set", 2, raw=True)
    assert raw.schema["tokens"].dataType.simpleString() == "array<int>"
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "EqualTo(shard_id,2)" in plan
    assert shards_of(read_pieces(spark, path)) == shards_of(packed.pieces)
    counts = {r["split"]: r["n_shards"] for r in shards_per_split(packed.manifest()).collect()}
    assert counts == {"train_set": 5, "val_set": 1}


def test_progress_is_observed(spark, tmp_path):
    packed = corpus_to_shards(corpus(spark, ["x" * 99] * 30), CorpusPlan(chunk_size=3, shard_size=500))
    pieces, seen = with_progress(packed.pieces)
    write_shards(pieces, str(tmp_path / "s"))
    assert seen.get == {"n_tokens": 2980, "n_shards": 6, "open_tokens": 480}


def test_npy_files_hold_unsigned_16_bit_ids(spark, tmp_path):
    import numpy as np

    path = str(tmp_path / "npy")
    packed = corpus_to_shards(corpus(spark, some_texts(80)), CorpusPlan(chunk_size=9, shard_size=64))
    write_npy(packed.pieces, path)
    expected = shards_of(packed.pieces)
    names = sorted(p.name for p in (tmp_path / "npy").iterdir() if p.suffix == ".npy")
    assert names == sorted(f"{s}_shard_{i:06d}.npy" for i, (s, _) in enumerate(expected))
    first = np.load(tmp_path / "npy" / "train_set_shard_000000.npy")
    assert first.dtype == np.uint16 and first.tolist() == expected[0][1]
    assert shards_of(read_npy(spark, path)) == expected
    assert read_npy(spark, path, "val_set").count() == 1
    write_npy(packed.pieces.where("shard_id = 0"), path)
    assert shards_of(read_npy(spark, path)) == expected[:1]
    wide = spark.createDataFrame(
        [("train_set", 0, 0, [70000])], "split string, shard_id bigint, start bigint, tokens array<int>"
    )
    with pytest.raises(Exception, match="16 bits"):
        write_npy(wide, path)


def test_corpora_are_read_by_name(spark, tmp_path):
    path = str(tmp_path / "docs")
    rows = [(i, f"t{i}", "fr" if i % 3 else "en", i) for i in range(30)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, more int").write.parquet(path)
    registry = CorpusRegistry({"fr": Corpus(path, "lang = 'fr'")})
    registry.add("all", Corpus(path))
    french = registry.load(spark, "fr")
    assert french.columns == ["doc_id", "text"] and french.count() == 20
    plan = french._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(lang,fr)" in plan and "more" not in plan
    with pytest.raises(KeyError, match="all, fr"):
        registry["de"]
    with pytest.raises(ValueError, match="no column body"):
        load_corpus(spark, path, text_col="body")
    assert corpus_counts(registry.load(spark, "all")).first()["n_rows"] == 30


def test_text_files(spark, tmp_path):
    path = str(tmp_path / "texts")
    append_texts(corpus(spark, ["a", "b"]), path)
    append_texts(corpus(spark, ["c\nd"]), path)
    lines = [r["text"] for r in read_texts(spark, path, whole=False).collect()]
    assert sorted(lines) == ["a", "b", "c", "d"]
    assert "c\nd\n" in [r["text"] for r in read_texts(spark, path).collect()]


class OneTextAtATime:
    """Byte ids; it refuses to get more than it should at once."""

    eot = 256

    def encode(self, text):
        return as_column(self.batch_encoder(), text)

    def length(self, text):
        return None

    def batch_encoder(self):
        def run(texts):
            if pc.sum(pc.binary_length(texts)).as_py() > 2_300_000:
                raise ValueError("too much text at once")
            return utf8_bytes(texts)

        return run


def test_long_texts_are_encoded_in_small_parts(spark):
    """A batch holds as many texts as Spark sends; ids take four times their memory, and more."""
    texts = ["a" * 700_000, "b" * 700_000, None, "", "c" * 700_000, "d" * 1_200_000]
    df = corpus(spark, texts).coalesce(1)
    ids = df.select(F.size(OneTextAtATime().encode(F.col("text"))).alias("n"), "doc_id")
    want = [len(text or "") for text in texts]
    assert [row.n for row in ids.orderBy("doc_id").collect()] == want
    plan = CorpusPlan(chunk_size=1, buckets=1)
    chunks, totals = encoded_chunks(df, plan, OneTextAtATime())
    assert totals == [sum(want) + len(want)]
    found = chunks.orderBy("chunk_id").select("n_tokens", "inside").collect()
    inside = np.cumsum([0, *[n + 1 for n in want]])
    assert [tuple(row) for row in found] == [(n + 1, at) for n, at in zip(want, inside)]
    assert [len(part) for part in sliced(pa.record_batch([texts], ["t"]), "t")] == [2, 3, 1]


def test_written_shards_are_read_in_small_parts(spark, tmp_path):
    """A reader holds a row group at once, so neither its rows nor its row groups may be long."""
    plan = CorpusPlan(chunk_size=2, shard_size=150_000, buckets=1)
    texts = [chr(97 + i % 26) * 40_000 for i in range(120)]
    pieces = corpus_to_shards(corpus(spark, texts), plan).pieces
    path = str(tmp_path / "shards")
    write_shards(pieces, path)
    files = [pq.ParquetFile(file) for file in tmp_path.rglob("*.parquet")]
    groups = [f.metadata.row_group(i).num_rows for f in files for i in range(f.num_row_groups)]
    assert max(groups) <= 32 < sum(groups)
    back = read_pieces(spark, path)
    assert back.agg(F.max("n_tokens")).first()[0] <= PIECE_TOKENS
    model = model_pack(byte_chunks(texts, 2), 150_000)
    assert shards_of(back) == model
    limited = cut_into_shards(
        spark.createDataFrame([(5, 200_000, [1] * 200_000)], "offset long, n_tokens long, tokens array<int>"),
        90_000, 2,
    )
    found = sorted(limited.selectExpr("shard_id", "start", "n_tokens", "size(tokens)").collect())
    assert [tuple(row) for row in found] == [
        (0, 5, 65531, 65531), (0, 65536, 24464, 24464), (1, 0, 65536, 65536), (1, 65536, 24464, 24464)
    ]


def test_a_joined_split_is_dealt_out_by_bytes(spark, monkeypatch):
    """A few long texts weigh as much as many short ones."""
    seen = []

    def units(df, order, *rest):
        seen.append(order)
        return split_units(df, order, *rest)

    monkeypatch.setattr("tokenmill.plans.corpus.split_units", units)
    texts = ["a word " * (2000 if i < 200 else 2) for i in range(2000)]
    df = corpus(spark, texts)
    tokens = split_tokens(df, encoder=BpeEncoder({bytes([b]): b for b in range(256)}))
    assert tokens.agg(F.sum("n_tokens")).first()[0] == sum(map(len, texts)) + 3
    sizes = seen[0].totals(df, F.octet_length("text"))
    assert max(sizes) < sum(sizes) / 4
