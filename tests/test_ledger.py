"""Ledger views, pending work, statistics and collisions."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from inkwell.operators import ledger as L

T0 = datetime(2024, 1, 1)
SCHEMA = "filename string, url_key string, processed_at timestamp, status string, input_stream string, output_stream string, seq int"


def ledger(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_last_write_wins(spark):
    rows = [
        ("a", "k1", T0, "COMPLETED", None, None, 1), ("a", "k2", T0 + timedelta(hours=1), "ERROR", None, None, 2),
        (None, "k3", T0, "COMPLETED", None, None, 3), ("b", "k4", T0, "COMPLETED", None, None, 4), ("b", "k5", T0, "COMPLETED", None, None, 5),
    ]
    latest = L.ledger_latest(ledger(spark, rows), order=("processed_at", "seq"))
    assert {r.filename: r.seq for r in latest.collect()} == {"a": 2, "b": 5}
    assert [r.filename for r in L.processed_view(latest).collect()] == ["b"]
    names = spark.createDataFrame([("a",), ("zz",), (None,), ("a",)], "filename string")
    assert [r.seq for r in L.ledger_lookup(latest, names).collect()] == [2]


def test_partial_limit_before_the_shuffle(spark):
    plan = L.ledger_latest(ledger(spark, []))._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2


def test_stream_names(spark):
    rows = [("a", None, T0, "x", "in-1", None, 1), ("b", None, T0 + timedelta(hours=1), "x", None, "out-1", 2)]
    assert tuple(L.stream_names(ledger(spark, rows), ["processed_at", "seq"]).collect()[0]) == ("in-1", "out-1")
    assert tuple(L.stream_names(ledger(spark, []), ["processed_at", "seq"]).collect()[0]) == (L.DEFAULT_INPUT, L.DEFAULT_OUTPUT)


def test_pending_and_done_partition_the_input(spark):
    files = spark.createDataFrame([(f"/in/{i}",) for i in range(20)], "path string")
    done = files.where("path like '%1%'")
    pending = L.pending_files(files, done)
    assert pending.count() + done.count() == 20 and pending.intersect(done).count() == 0
    samples = spark.createDataFrame([(1, '{"messages": 4}'), (2, '{"messages": 6}')], "ts int, body string")
    report = L.pending_items("Standalone", pending, F.lit("/in"), samples).collect()[0]
    assert (report.mode, report.directory, report["count"]) == ("standalone", "/in", pending.count())
    assert L.pending_items("other", pending, F.lit("/in"), samples).collect()[0].status == "unsupported"
    assert tuple(L.pending_items("SCDF", pending, F.lit("/in"), samples).collect()[0]) == ("scdf", 6, "ok", None)
    assert tuple(L.pending_queue(samples.where("false")).collect()[0]) == ("scdf", -1, "unavailable", "no queue snapshot")


def test_pending_estimate(spark):
    pending = spark.createDataFrame([("/in/b", 2), ("/in/a", 3)], "path string, at int")
    latest = spark.createDataFrame([("COMPLETED", 1500), ("COMPLETED", 2500), ("ERROR", 9)], "status string, elapsed_ms long")
    assert tuple(L.pending_estimate(pending, latest, "path", ["at"]).collect()[0]) == (2, 4, "/in/b")
    nothing = latest.where("false")
    assert tuple(L.pending_estimate(pending, nothing, "path", ["at"]).collect()[0]) == (2, 0, "/in/b")


def test_stats_and_collisions(spark):
    rows = spark.createDataFrame([("C", 10, 5, 1, 100), ("C", 20, 7, 2, 200)], "status string, file_size long, text_length long, chunk_count int, elapsed_ms long")
    s = L.ledger_stats(rows, ["status"]).collect()[0]
    assert (s.n_files, s.bytes, s.chars, s.max_chars, s.avg_chars, s.chunks, s.elapsed_ms) == (2, 30, 12, 7, 6.0, 3, 300)
    paths = spark.createDataFrame([("p", "u1"), ("p", "u2"), ("q", "u3"), ("q", "u3")], "output_path string, url string")
    assert [tuple(r) for r in L.path_collisions(paths).collect()] == [("p", 2, "u1", "u2")]


def test_ledger_projection_defaults(spark):
    refs = spark.createDataFrame([("a.pdf", "k", None, "o")], "filename string, url_key string, inputStream string, outputStream string")
    row = L.ledger_rows(refs).collect()[0]
    assert (row.file_type, row.chunk_size, row.chunk_count, row.status, row.input_stream, row.output_stream) == (
        "application/pdf", 262144, 1, "COMPLETED", "default-input", "o",
    )
