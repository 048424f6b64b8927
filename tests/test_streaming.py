"""The document stream: outcomes, replays, restarts, reset, sinks, presence."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from inkwell.operators import chunks as C, control as K, ledger as L, monitoring as MO
from inkwell.plans.process import process_refs
from inkwell.sinks import exports as EX, tables as TB
from inkwell.sources.fetch import fetch_content
from inkwell.sources.files import stream_files
from inkwell.sources.messages import read_messages
from inkwell.streaming.control import PipelineControl
from inkwell.streaming.presence import live_presence
from inkwell.streaming.processor import DocumentStream, source_backlog

PARAMS = C.ChunkParams(10, 2, 0, 100)


@pytest.fixture
def store(tmp_path):
    (tmp_path / "store").mkdir()
    for name, data in {"a.txt": b"one. two. three. four.", "b.html": b"<p>page</p>", "blank.txt": b" \n", "x.pdf": b"%PDF-"}.items():
        (tmp_path / "store" / name).write_bytes(data)
    (tmp_path / "in").mkdir()
    return tmp_path


def message(store, name, kind="HDFS"):
    return json.dumps({"type": kind, "url": f"http://nn:9870/webhdfs/v1{store}/store/{name}", "inputStream": "in-1"})


def put(store, file, names):
    tmp = store / f".{file}"
    tmp.write_text("\n".join(n if n.startswith("{") else message(store, n) for n in names) + "\n")
    os.rename(tmp, store / "in" / file)


def run(spark, store, stream, checkpoint="cp"):
    messages = read_messages(spark, str(store / "in"), streaming=True)
    stream.start(messages, str(store / checkpoint), {"availableNow": True}).awaitTermination()


def new_stream(spark, store, root="out", **kw):
    return DocumentStream(spark, str(store / root), fetch_content, PARAMS, readers={}, **kw)


def outcomes(stream):
    return sorted((r.filename or "", r.outcome) for r in stream.outcomes().collect())


def test_stream_end_to_end(spark, store):
    stream = new_stream(spark, store)
    put(store, "m1", ["a.txt", "b.html", "blank.txt", "blank.txt", "x.pdf", "none.txt", "a.txt", '{"type":'])
    run(spark, store, stream)
    assert outcomes(stream) == sorted([
        ("a.txt", "COMPLETED"), ("a.txt", "DUPLICATE"), ("b.html", "COMPLETED"), ("blank.txt", "BLANK"), ("blank.txt", "BLANK"),
        ("none.txt", "NOT_FOUND"), ("x.pdf", "UNSUPPORTED_FORMAT"), ("", "MALFORMED_JSON"),
    ])
    chunks = stream.chunks().where("filename = 'a.txt'").orderBy("chunk_no").collect()
    assert [c.text for c in chunks] == ["one. two.", "three.", "four."] and chunks[0].n_chunks == 3
    texts = {r.filename: (r.text, r.output_path) for r in stream.texts().collect()}
    assert texts["b.html"] == ("\n\npage", "http://nn:9870/webhdfs/v1/processed_files/b.html.txt") and len(texts) == 2
    ledger = {r.filename: r for r in stream.processed().collect()}
    assert set(ledger) == {"a.txt", "b.html"} and ledger["a.txt"].chunk_count == 3 and ledger["a.txt"].input_stream == "in-1"
    sent = [json.loads(r.message) for r in spark.read.parquet(str(store / "out" / "messages")).collect()]
    assert {m["originalFile"].rsplit("/", 1)[1] for m in sent} == {"a.txt", "b.html"}
    assert all(m["processed"] is True and m["url"].endswith(".txt") and "outputStream" not in m for m in sent)

    # restart on the same checkpoint: done files are duplicates, failed ones are retried
    (store / "store" / "none.txt").write_bytes(b"now here")
    put(store, "m2", ["a.txt", "none.txt", "blank.txt"])
    run(spark, store, stream)
    second = sorted(r.outcome for r in spark.read.parquet(str(store / "out" / "outcomes" / "batch_id=1")).collect())
    assert second == ["BLANK", "COMPLETED", "DUPLICATE"]
    assert stream.processed().count() == 3


def test_replayed_batch_changes_nothing(spark, store):
    stream = new_stream(spark, store)
    batch = spark.createDataFrame([(message(store, n),) for n in ("a.txt", "b.html")], "value string")
    stream.process_batch(batch, 0)
    first = (outcomes(stream), stream.ledger.read().count(), stream.chunks().count())
    stream.process_batch(batch, 0)
    assert (outcomes(stream), stream.ledger.read().count(), stream.chunks().count()) == first
    stream.process_batch(batch, 1)
    assert [r.outcome for r in spark.read.parquet(str(store / "out" / "outcomes" / "batch_id=1")).collect()] == ["DUPLICATE"] * 2


def test_failed_sink_leaves_no_ledger_rows(spark, store):
    calls = []

    def broken(df, batch_id):
        calls.append(df.count())
        if len(calls) == 1:
            raise RuntimeError("sink down")

    stream = new_stream(spark, store, message_sink=broken)
    batch = spark.createDataFrame([(message(store, "a.txt"),)], "value string")
    with pytest.raises(RuntimeError):
        stream.process_batch(batch, 0)
    assert stream.ledger.read().count() == 0
    assert stream.outcomes().count() == stream.texts().count() == stream.chunks().count() == 0  # not committed yet
    stream.process_batch(batch, 0)
    assert stream.texts().count() == 1
    assert calls == [1, 1] and [r.status for r in stream.ledger.read().collect()] == ["COMPLETED"]


def test_batch_equals_stream(spark, store):
    names = ["a.txt", "b.html", "blank.txt", "a.txt"]
    put(store, "m", names)
    stream = new_stream(spark, store)
    run(spark, store, stream)
    rows = [(i, message(store, n)) for i, n in enumerate(names)]
    batch = spark.createDataFrame(rows, "msg_id long, value string").withColumn("arrived_at", F.timestamp_seconds("msg_id"))
    same = process_refs(batch, fetch_content, readers={})
    assert sorted((r.filename, r.outcome) for r in same.collect()) == outcomes(stream)


def test_reprocess_marker_lets_a_url_pass(spark, store):
    stream = new_stream(spark, store)
    batch = spark.createDataFrame([(message(store, "a.txt"),)], "value string")
    stream.process_batch(batch, 0)
    urls = stream.outcomes().select("url")
    stream.ledger.write(L.reprocess_markers(urls, F.localtimestamp()), 1)
    stream.process_batch(batch, 2)
    assert [r.outcome for r in spark.read.parquet(str(store / "out" / "outcomes" / "batch_id=2")).collect()] == ["COMPLETED"]
    stream.process_batch(batch, 3)  # the completion after the marker counts, though the message is older than it
    assert [r.outcome for r in spark.read.parquet(str(store / "out" / "outcomes" / "batch_id=3")).collect()] == ["DUPLICATE"]
    assert stream.texts().count() == 1 and stream.chunks().select("chunk_no").distinct().count() == stream.chunks().count()
    assert all(r.elapsed_ms is not None and r.elapsed_ms >= 0 for r in stream.processed().collect())


def test_ledger_compaction_keeps_rows(spark, store):
    stream = new_stream(spark, store)
    for i, n in enumerate(["a.txt", "b.html", "a.txt"]):
        stream.process_batch(spark.createDataFrame([(message(store, n),)], "value string"), i)
    before = sorted(map(str, stream.ledger.read().collect()))
    stream.ledger.compact(1, files=1)
    assert sorted(map(str, stream.ledger.read().collect())) == before
    assert stream.ledger.read(before=1).count() == 1  # a replay of batch 1 must not see the snapshot
    assert stream.ledger.vacuum(2) == 0  # batch 2 is not covered
    assert stream.ledger.vacuum(1) == 2
    assert sorted(map(str, stream.ledger.read().collect())) == before
    stream.ledger.compact(2, files=1)
    assert stream.ledger.vacuum(2) == 1 and sorted(map(str, stream.ledger.read().collect())) == before


def test_control_lifecycle(spark, store):
    streams = {}

    def starter(tables, checkpoint):
        streams["s"] = DocumentStream(spark, tables, fetch_content, PARAMS, readers={})
        return streams["s"].start(read_messages(spark, str(store / "in"), streaming=True), checkpoint, {"processingTime": "0 seconds"})

    control = PipelineControl(spark, str(store / "run"), starter)
    assert control.state()["status"] == "STOPPED" and control.state()["lastChangeReason"] == K.STARTUP_REASON
    put(store, "m1", ["a.txt"])
    assert control.start()["stateChanged"] is True and control.start()["stateChanged"] is False
    control.query.processAllAvailable()
    assert streams["s"].processed().count() == 1 and source_backlog(control.query)["status"] == "ok"
    answer = control.toggle()
    assert (answer["action"], answer["enabled"], answer["previousState"]["status"]) == ("stopped", False, "STARTED")
    put(store, "m2", ["b.html"])  # waits while stopped
    assert control.stop()["stateChanged"] is False
    control.toggle()
    control.query.processAllAvailable()
    assert streams["s"].processed().count() == 2
    reset = control.reset()
    assert (reset["stateChanged"], reset["hdfsCleared"], reset["directoryRecreated"], reset["enabled"]) == (True, True, True, False)
    assert control.generation == 1
    control.start()
    control.query.processAllAvailable()
    control.stop()
    assert streams["s"].processed().count() == 2  # everything was read again
    replay = K.control_replay(control.log()).orderBy("ts", "cmd_id").collect()
    assert [r.cmd for r in replay] == ["start", "start", "toggle", "stop", "toggle", "reset", "start", "stop"]
    assert replay[-1].status == "STOPPED" and [r.changed for r in replay] == [True, False, True, False, True, True, True, True]


def test_file_stream_archives_inputs(spark, tmp_path):
    src, arc = tmp_path / "in", tmp_path / "done"
    src.mkdir()
    got = []
    for i in range(2):
        (src / f"f{i}.txt").write_text(f"t{i}")
        q = stream_files(spark, str(src), str(arc)).writeStream.foreachBatch(
            lambda df, b: got.extend(r.path.rsplit("/", 1)[1] for r in df.select("path").collect())
        ).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
    assert sorted(got) == ["f0.txt", "f1.txt"]
    assert any("f0.txt" in files for _, _, files in os.walk(arc))


def test_exports(spark, tmp_path):
    rows = spark.createDataFrame(
        [("/d/a.txt", "old", 1, "processed"), ("/d/a.txt", "new é", 2, "processed"), ("/b.txt", "x", 1, "error")],
        "output_path string, text string, arrived_at int, destination string",
    )
    EX.export_text_files(EX.last_write_per_path(rows), f"file://{tmp_path}/export")
    assert (tmp_path / "export" / "d" / "a.txt").read_text() == "new é"
    assert sorted(os.listdir(tmp_path / "export" / "d")) == ["a.txt"]
    EX.write_by_outcome(rows, str(tmp_path / "by"))
    assert {d for d in os.listdir(tmp_path / "by") if "=" in d} == {"destination=processed", "destination=error"}
    EX.write_messages(rows.withColumn("message", F.col("text")), str(tmp_path / "msg"))
    assert spark.read.text(str(tmp_path / "msg")).count() == 3
    EX.discard(rows)
    path = str(tmp_path / "deep" / "dir")
    assert not TB.path_exists(spark, path) and TB.ensure_dir(spark, path) and TB.path_exists(spark, path)
    assert TB.delete_dir(spark, path) and not TB.delete_dir(spark, path)


def test_heartbeat_windows_on_a_stream(spark, tmp_path):
    rows = [(1, "s", "a", 0, "INIT"), (2, "s", "a", 3, "HEARTBEAT"), (3, "s", "a", 12, "ERROR"), (4, "s", "b", 100, "HEARTBEAT")]
    df = spark.createDataFrame(rows, "event_id long, service string, instanceId string, sec int, event string")
    df.withColumn("ts", F.timestamp_seconds("sec")).drop("sec").write.parquet(str(tmp_path / "m"))
    m = spark.readStream.schema(spark.read.parquet(str(tmp_path / "m")).schema).parquet(str(tmp_path / "m")).withWatermark("ts", "5 seconds")
    q = MO.heartbeat_windows(m).writeStream.outputMode("append").format("memory").queryName("hb").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r.instanceId, r.window_start.second): (r.n_messages, r.n_heartbeats) for r in spark.table("hb").collect()}
    assert got == {("a", 0): (2, 2), ("a", 10): (1, 0)}


def test_live_presence(spark, tmp_path):
    src = tmp_path / "m"
    schema = "service string, instanceId string, ts timestamp, event string"

    def send(n, rows):
        spark.createDataFrame(rows, "event_id long, service string, instanceId string, s int, event string").withColumn(
            "ts", F.timestamp_seconds("s")
        ).drop("s", "event_id").coalesce(1).write.mode("append").parquet(str(src))

    send(0, [(1, "s", "a", 1, "INIT"), (2, "s", "a", 2, "HEARTBEAT"), (3, "s", "b", 1, "INIT"), (4, "s", "b", 2, "SHUTDOWN")])
    got = []
    q = (
        live_presence(spark.readStream.schema(schema).parquet(str(src)), alive_s=2, degraded_s=20)
        .writeStream.outputMode("update")
        .foreachBatch(lambda df, b: got.extend((r.instanceId, r.liveness) for r in df.collect()))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="1 second").start()
    )
    deadline = time.time() + 90
    while ("a", "Offline") not in got and time.time() < deadline and q.isActive:
        time.sleep(0.5)
    q.stop()
    assert q.exception() is None
    assert [s for i, s in got if i == "a"] == ["Alive", "Degraded", "Offline"] and [s for i, s in got if i == "b"] == ["Stopped"]
