"""References: parsing, validation, duplicates, reprocessing, skewed lookups."""

from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from inkwell.functions import urls as U
from inkwell.operators import ledger as L, outcomes as O, refs as R
from inkwell.operators.skew import attach_by_key
from inkwell.sources import messages as M

T0 = datetime(2024, 1, 1)


def messages(spark, values):
    rows = [(i, T0 + timedelta(seconds=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "msg_id long, arrived_at timestamp, value string")


def test_validation_reasons(spark):
    values = [
        '{"type":"HDFS","url":"http://h/a.txt"}', '{"type":"hdfs","url":"http://h/b.txt","extra":[1]}',
        '{"type":"S3","url":"x"}', '{"url":"x"}', '{"type":null,"url":"x"}', '{"type":"HDFS","url":" "}', '{"type":"HDFS"}',
        '{"type":"HDFS","url":null}', '{"type":"HDFS","url":{"a":1}}', '{"type":"HDFS","url":"http://h/"}',
        '{"type":"HDFS","url":"http://h/bad%zz"}', '{"type":"HDFS","u', "", None, '{"type":"HDFS","url":5}',
    ]
    got = M.validate_refs(M.parse_file_refs(messages(spark, values))).orderBy("msg_id").collect()
    assert [r.reject for r in got] == [
        None, None, "UNSUPPORTED_TYPE", "UNSUPPORTED_TYPE", "UNSUPPORTED_TYPE", "MISSING_URL", "MISSING_URL",
        "MISSING_URL", "MISSING_URL", "BAD_NAME", "BAD_ENCODING", "MALFORMED_JSON", "MALFORMED_JSON", "MALFORMED_JSON", None,
    ]
    assert got[-1].url == "5" and got[0].filename == "a.txt"


def ref(url):
    return '{"type":"HDFS","url":"%s"}' % url


def flagged(spark, values, done=None):
    refs = M.validate_refs(M.parse_file_refs(messages(spark, values)))
    return [r.dedupe for r in R.dedupe_refs(refs, done).orderBy("msg_id").collect()]


def test_dedupe_within_batch_and_against_ledger(spark):
    values = [ref("http://h/a"), ref("http://h/b"), ref("http://h/a"), "{", ref("http://h/c")]
    assert flagged(spark, values) == ["FIRST", "FIRST", "DUPLICATE", "REJECTED", "FIRST"]
    done = spark.createDataFrame([("http://h/b",), ("http://h/zz",)], "url string").select(U.file_key(F.col("url")).alias("url_key"))
    assert flagged(spark, values, done) == ["FIRST", "DUPLICATE", "DUPLICATE", "REJECTED", "FIRST"]


def test_ledger_keys_follow_the_latest_marker(spark):
    rows = [
        ("a", T0, "COMPLETED"), ("b", T0, "COMPLETED"), ("b", T0 + timedelta(hours=1), "REPROCESS"),
        ("c", T0, "REPROCESS"), ("c", T0 + timedelta(hours=1), "COMPLETED"), ("d", T0, "ERROR"), ("e", T0, "BLANK"),
        ("f", T0, "COMPLETED"), ("f", T0, "REPROCESS"), (None, T0, "COMPLETED"), ("g", T0, "COMPLETED"), ("g", T0 + timedelta(hours=1), "ERROR"),
    ]
    ledger = spark.createDataFrame(rows, "url_key string, processed_at timestamp, status string")
    assert sorted(r.url_key for r in R.ledger_keys(ledger).collect()) == ["a", "c", "g"]


def test_reprocess_marker_shape(spark):
    urls = spark.createDataFrame([("http://h/a%20b",)], "url string")
    row = L.reprocess_markers(urls, F.lit("2024-01-01").cast("timestamp_ntz")).collect()[0]
    assert (row.filename, row.status, row.file_size) == ("a b", "REPROCESS", None)


def test_settle_copies(spark):
    firsts = spark.createDataFrame([("k1", "BLANK"), ("k2", "COMPLETED")], "url_key string, outcome string")
    copies = spark.createDataFrame([(1, "k1"), (2, "k2"), (3, "k3")], "msg_id long, url_key string")
    got = {r.msg_id: r.outcome for r in O.settle_copies(copies, firsts).collect()}
    assert got == {1: "BLANK", 2: "DUPLICATE", 3: "DUPLICATE"}


def test_attach_by_key_equals_left_join_on_skewed_keys(spark):
    rows = spark.range(30000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"),
    )
    lookup = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")).unionByName(
        spark.range(1).select(F.lit("hot").alias("k"), F.lit(-5).cast("long").alias("v"))
    )
    got = attach_by_key(rows, lookup, "k")
    want = rows.join(lookup, "k", "left").select("id", "k", "v")
    assert got.columns == ["id", "k", "v"] and got.count() == 30000
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_source_ids_may_be_missing_or_repeated(spark):
    rows = [
        (None, T0, ref("http://h/a")), (None, T0 + timedelta(seconds=1), ref("http://h/b")), (5, T0, ref("http://h/c")),
        (5, T0, ref("http://h/c")), (None, T0, ref("http://h/a")), (7, None, ref("http://h/d")), (7, T0, ref("http://h/d")),
    ]
    refs = M.validate_refs(M.parse_file_refs(spark.createDataFrame(rows, "msg_id long, arrived_at timestamp, value string").coalesce(1)))
    out = R.dedupe_refs(refs).collect()
    assert Counter((r.url, r.dedupe) for r in out) == Counter(
        [("http://h/a", "FIRST"), ("http://h/a", "DUPLICATE"), ("http://h/b", "FIRST"), ("http://h/c", "FIRST"), ("http://h/c", "DUPLICATE"),
         ("http://h/d", "FIRST"), ("http://h/d", "DUPLICATE")]
    )
    assert [r.arrived_at for r in out if (r.url, r.dedupe) == ("http://h/d", "FIRST")] == [T0]


def test_skewed_dedupe_spreads_over_tasks(spark):
    """Two thirds of the messages carry one URL; no join of the plan is keyed by it."""
    values = spark.range(20000).select(
        F.col("id").alias("msg_id"),
        F.timestamp_seconds("id").alias("arrived_at"),
        F.concat(
            F.lit('{"type":"HDFS","url":"http://h/'), F.when(F.col("id") % 3 != 0, F.lit("x")).otherwise(F.col("id").cast("string")), F.lit('"}')
        ).alias("value"),
    )
    out = R.dedupe_refs(M.validate_refs(M.parse_file_refs(values)))
    assert Counter(r.dedupe for r in out.select("dedupe").collect()) == {"FIRST": 6668, "DUPLICATE": 13332}
    plan = out._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
    # messages move by their own number; by key only what the partial aggregate left over
    assert sum("hashpartitioning(url_key" in x for x in exchanges) == 1, plan
    assert "SortAggregate" not in plan and plan.count("partial_min") == 1


def test_plus_signs_and_escapes_in_paths(spark):
    names = ["a+b.txt", "a%20b.txt", "a%2Bb.txt", "a b.txt", "bad%zz"]
    urls = spark.createDataFrame([(f"http://nn:1/webhdfs/v1/d/{n}?op=OPEN",) for n in names], "url string")
    assert [r[0] for r in urls.select(U.storage_path(F.col("url"))).collect()] == ["/d/a+b.txt", "/d/a b.txt", "/d/a+b.txt", "/d/a b.txt", None]


def test_reason_of_missing_bytes(spark):
    df = spark.createDataFrame([(None,), ("NOT_FOUND",), ("TOO_LARGE",), ("PermissionError: no",)], "e string")
    none = F.lit(None).cast("string")
    got = df.select(O.outcome_of(none, F.lit("FIRST"), F.lit(False), none, F.lit("x"), fetch_error=F.col("e")).alias("o")).collect()
    assert [r.o for r in got] == ["NOT_FOUND", "NOT_FOUND", "TOO_LARGE", "READ_ERROR"]
