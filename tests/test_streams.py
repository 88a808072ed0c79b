import random

import pyarrow as pa
import pytest
from models import pack as model_pack
from models import stop_trace
from test_corpus import byte_chunks, corpus, shards_of, some_texts
from test_runs import series

from tokenmill.operators.earlystop import Patience
from tokenmill.operators.encode import BpeEncoder
from tokenmill.plans.corpus import CorpusPlan
from tokenmill.sources import runlog
from tokenmill.streaming.corpus import StreamPacker, stream_corpus
from tokenmill.streaming.monitor import RunMonitor, block_records, latest, monitor_runs, reduced

TEXT = "doc_id bigint, text string"


def arrive(spark, texts, first, folder):
    rows = [(first + i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, TEXT).write.mode("append").parquet(folder)


def run(spark, packer, folders):
    source, checkpoint = folders
    packer.start(stream_corpus(spark, source, TEXT), checkpoint).awaitTermination()


def test_stream_equals_batch_over_arrivals(spark, tmp_path):
    texts = some_texts(47, seed=4)
    folders = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    packer = StreamPacker(str(tmp_path / "out"), CorpusPlan(chunk_size=6, shard_size=40, buckets=2))
    for lo, hi in ((0, 3), (3, 29), (29, 47)):
        arrive(spark, texts[lo:hi], lo, folders[0])
        run(spark, packer, folders)
        packed = packer.packed(spark)
        assert shards_of(packed.pieces) == model_pack(byte_chunks(texts[:hi], 6), 40)
    run(spark, packer, folders)  # nothing new
    assert shards_of(packer.packed(spark).pieces) == model_pack(byte_chunks(texts, 6), 40)


def test_a_failed_batch_is_repeated_without_duplicates(spark, tmp_path):
    texts = some_texts(30, seed=5)
    folders = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    plan = CorpusPlan(chunk_size=4, shard_size=25)

    class Failing(StreamPacker):
        def _write(self, df, kind, batch_id):
            if kind == "state" and batch_id == 1:
                raise RuntimeError("lost after the pieces were written")
            super()._write(df, kind, batch_id)

    arrive(spark, texts[:13], 0, folders[0])
    run(spark, Failing(str(tmp_path / "out"), plan), folders)
    arrive(spark, texts[13:], 13, folders[0])
    with pytest.raises(Exception, match="lost after"):
        run(spark, Failing(str(tmp_path / "out"), plan), folders)
    packer = StreamPacker(str(tmp_path / "out"), plan)
    half = packer.packed(spark)
    assert shards_of(half.pieces) == model_pack(byte_chunks(texts[:13], 4), 25)
    run(spark, packer, folders)
    assert shards_of(packer.packed(spark).pieces) == model_pack(byte_chunks(texts, 4), 25)


def test_stream_with_bpe_and_documents(spark, tmp_path):
    texts = ["an onion", "", "in", "on and on"]
    ranks = {**{bytes([b]): b for b in range(256)}, b"on": 256}
    folders = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    plan = CorpusPlan(delimit="document", shard_size=8)
    packer = StreamPacker(str(tmp_path / "out"), plan, BpeEncoder(ranks))
    arrive(spark, texts[:2], 0, folders[0])
    run(spark, packer, folders)
    arrive(spark, texts[2:], 2, folders[0])
    run(spark, packer, folders)
    ids = lambda t: [257, *(256 if c == "O" else ord(c) for c in t.replace("on", "O"))]
    assert shards_of(packer.packed(spark).pieces) == model_pack([ids(t) for t in texts], 8)


def test_late_files_are_refused(spark, tmp_path):
    texts = some_texts(20, seed=6)
    folders = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    packer = StreamPacker(str(tmp_path / "out"), CorpusPlan(chunk_size=3, shard_size=40))
    arrive(spark, texts[10:], 10, folders[0])
    run(spark, packer, folders)
    kept = shards_of(packer.packed(spark).pieces)
    arrive(spark, texts[:10], 0, folders[0])
    with pytest.raises(Exception, match=r"\.parquet is late: it holds the key \(0,\), and \(19,\)"):
        run(spark, packer, folders)
    assert shards_of(packer.packed(spark).pieces) == kept
    assert kept == model_pack(byte_chunks(texts[10:], 3), 40)


@pytest.mark.parametrize("max_chunks, delimit", [(4, "chunk"), (1, "chunk"), (7, "chunk"), (2, "document")])
def test_a_limit_on_chunks_bounds_the_stream(spark, tmp_path, max_chunks, delimit):
    texts = some_texts(47, seed=7)
    folders = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    plan = CorpusPlan(chunk_size=6, shard_size=40, max_chunks=max_chunks, delimit=delimit)
    packer = StreamPacker(str(tmp_path / "out"), plan)
    for lo, hi in ((0, 9), (9, 29), (29, 40), (40, 47)):
        arrive(spark, texts[lo:hi], lo, folders[0])
        run(spark, packer, folders)
    size = 6 if delimit == "chunk" else 1
    want = model_pack(byte_chunks(texts[: 6 * max_chunks], size), 40)
    assert shards_of(packer.packed(spark).pieces) == want


def test_progress_of_each_batch(spark, tmp_path):
    texts = some_texts(31, seed=8)
    folders = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    packer = StreamPacker(str(tmp_path / "out"), CorpusPlan(chunk_size=4, shard_size=30))
    want, before = [], 0
    for n, (lo, hi) in enumerate(((0, 2), (2, 17), (17, 31))):
        arrive(spark, texts[lo:hi], lo, folders[0])
        run(spark, packer, folders)
        tokens = sum(map(len, byte_chunks(texts[: hi // 4 * 4], 4)))
        want.append((n, hi - lo, tokens - before, tokens // 30, tokens % 30))
        before = tokens
    assert sorted(tuple(r) for r in packer.progress(spark).collect()) == want


RUNS = {
    1: [5, 4, 4, 4, 3, 3, 3, 3, 3],
    2: [1, 2, 0.5, 0.4, 0.1, 7, 8, 9, 9],
    3: [2.0],
    4: [9, 9, 9, 9, 1, 1],
}


def watch(spark, tmp_path, start):
    source = str(tmp_path / "in")
    df = series(spark, RUNS)
    for part in ("step < 30", "step >= 30 and step < 40", "step >= 40"):
        df.where(part).write.mode("append").parquet(source)
        start(spark.readStream.schema(df.schema).parquet(source), str(tmp_path / "checkpoint"))


def check_states(states):
    got = {r["run_id"]: r for r in states.collect()}
    assert set(got) == set(RUNS)
    for run_id, losses in RUNS.items():
        best, counter, _, stopped = stop_trace(losses, 3, 0.2, "min")[-1]
        r = got[run_id]
        assert (r["score"], r["counter"], r["stopped"], r["n_steps"]) == (best, counter, stopped, len(losses))
        assert r["val_loss"] == -best


def test_monitor_keeps_its_state_between_batches(spark, tmp_path):
    monitor = RunMonitor(str(tmp_path / "out"), Patience(3, 0.2))
    watch(spark, tmp_path, lambda s, c: monitor.start(s, c).awaitTermination())
    check_states(monitor.state(spark))


def test_stateful_operator_keeps_its_state_between_batches(spark, tmp_path):
    out = str(tmp_path / "out")

    def start(stream, checkpoint):
        (
            monitor_runs(stream, Patience(3, 0.2)).writeStream.outputMode("update")
            .foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}"))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
            .awaitTermination()
        )

    watch(spark, tmp_path, start)
    check_states(latest(spark.read.parquet(out).drop("batch")))


def states_of(spark, tmp_path, rule):
    out = str(tmp_path / "out")

    def start(stream, checkpoint):
        (
            monitor_runs(stream, rule).writeStream.outputMode("update")
            .foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}"))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
            .awaitTermination()
        )

    return out, start


def test_one_run_with_a_whole_backlog_is_spread(spark, tmp_path, monkeypatch):
    """Most rows are reduced before they come to the state of the run."""
    monkeypatch.setattr("tokenmill.streaming.monitor.BLOCK_STEPS", 640)
    draws = random.Random(6)
    losses = [round(20 - i * 0.004 + draws.random() * 8, 3) for i in range(4000)]
    df = series(spark, {7: losses, 8: [1.0]})
    short = reduced(df, Patience(50, 0.2))
    assert short.where("run_id = 7").count() < 600
    assert short.selectExpr("run_id", "block", "n_rows").distinct().groupBy().sum("n_rows").first()[0] == 4001
    out, start = states_of(spark, tmp_path, Patience(50, 0.2))
    source = str(tmp_path / "in")
    for part in ("step < 25000", "step >= 25000"):
        df.where(part).repartition(4).write.mode("append").parquet(source)
        start(spark.readStream.schema(df.schema).parquet(source), str(tmp_path / "checkpoint"))
    row = latest(spark.read.parquet(out).drop("batch")).where("run_id = 7").first()
    best, counter, _, stopped = stop_trace(losses, 50, 0.2, "min")[-1]
    assert (row.score, row.counter, row.stopped, row.n_steps) == (best, counter, stopped, 4000)


def test_blocks_of_many_runs_are_reduced_together():
    """Runs with few steps a block make as many blocks as rows, so one call takes many blocks."""
    draws = random.Random(4)
    rows = [
        (run, step // 8, step, draws.choice([0.5, 1.0, 2.0, -0.0]))
        for run in [None, 3, 7] for step in draws.sample(range(64), 30)
    ]
    columns = ["run_id", "block", "step", "loss"]
    table = lambda rows: pa.table([pa.array(c) for c in zip(*rows)], columns)
    want = []
    for key in {row[:2] for row in rows}:
        own = sorted(row[2:] for row in rows if row[:2] == key)
        for place, (step, loss) in enumerate(own):
            if all(loss <= earlier for _, earlier in own[:place]):
                ends = own[0][0], own[-1][0]
                want.append((*key, len(own), *ends, step, place, -loss))
    got = [tuple(row.values()) for row in block_records(table(rows), -1.0).to_pylist()]
    order = lambda row: (str(row[0]), *row[1:])
    assert sorted(got, key=order) == sorted(want, key=order)
    with pytest.raises(ValueError, match="a step of run 7 comes up more than once"):
        block_records(table([*rows, (7, *rows[-1][1:])]), -1.0)


@pytest.mark.parametrize("bad, message", [
    ([(1, 50, float("nan"))], "not a number"),
    ([(1, 50, None)], "not a number"),
    ([(1, 5, 1.0)], "late"),
    ([(1, 10, 1.0)], "late"),
])
def test_monitors_refuse_bad_records(spark, tmp_path, bad, message):
    schema = "run_id bigint, step bigint, loss double"
    monitor = RunMonitor(str(tmp_path / "kept"), Patience(3, 0.2))
    _, start = states_of(spark, tmp_path, Patience(3, 0.2))
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, 0, 3.0), (1, 10, 2.0)], schema).write.parquet(source)
    stream = lambda: spark.readStream.schema(schema).parquet(source)
    monitor.start(stream(), str(tmp_path / "c1")).awaitTermination()
    start(stream(), str(tmp_path / "c2"))
    spark.createDataFrame(bad, schema).write.mode("append").parquet(source)
    with pytest.raises(Exception, match=message):
        monitor.start(stream(), str(tmp_path / "c1")).awaitTermination()
    with pytest.raises(Exception, match=message):
        start(stream(), str(tmp_path / "c2"))


def test_monitor_snapshots(spark, tmp_path):
    """Runs that fall silent keep their state, and old micro-batches go."""
    schema = "run_id bigint, step bigint, loss double"
    monitor = RunMonitor(str(tmp_path), Patience(3, 0.2), snapshot_every=2)
    for n in range(6):
        rows = [(n % 4, n, 5.0 - n), (9, n, 1.0)]
        monitor(spark.createDataFrame(rows, schema), n)
    monitor(spark.createDataFrame([(1, 5, 0.0), (9, 5, 1.0)], schema), 5)  # once more
    found = {r.run_id: (r.n_steps, r.score, r.counter, r.stopped) for r in monitor.state(spark).collect()}
    assert found == {
        0: (2, -1.0, 0, False),
        1: (2, 0.0, 0, False),
        2: (1, -3.0, 0, False),
        3: (1, -2.0, 0, False),
        9: (6, -1.0, 5, True),
    }
    kept = {p.name for p in tmp_path.iterdir()}
    assert kept == {"batch=2", "batch=3", "batch=4", "batch=5"}


def test_log_tailing(spark, tmp_path):
    path = str(tmp_path / "log")
    lines = [f"Step: {i}, val_loss: {i / 2:.4f}" for i in range(5)] + ["?"]
    for line in lines:
        runlog.append_lines(spark.createDataFrame([(line,)], "x string"), path)
    query = (
        runlog.parse_validation_log(runlog.stream_lines(spark, path))
        .writeStream.format("memory").queryName("tailed").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    rows = sorted(map(tuple, spark.table("tailed").collect()))
    assert rows == [(i, i / 2) for i in range(5)]
