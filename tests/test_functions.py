"""Scalar functions on hand-made boundary values."""

import hashlib

import pytest
from pyspark.sql import functions as F

from inkwell.functions import html as H, mime as MT, status as S, text as TX, urls as U
from inkwell.sources.queues import queue_depth

BLANKS = [None, "", " \n\t", "\u2003", "\u00a0", "\u0001", "x", "   ", " x "]


def test_blank_trimmed(one):
    assert one(TX.is_blank_trimmed, BLANKS) == [True, True, True, False, False, True, False, False, False]


def test_blank_unicode(one):
    assert one(TX.is_blank_unicode, BLANKS) == [True, True, True, True, False, False, False, True, False]


def test_utf16_length_counts_surrogates(one):
    assert one(TX.utf16_length, ["abc", "é", "a\U0001f600b", ""]) == [3, 1, 4, 0]


def test_snippet_cuts_before_flattening(one):
    assert one(lambda c: TX.snippet(c, 3), ["a\nbcd", "ab", None]) == ["a b", "ab", None]


def test_safe_and_dump_names(one):
    assert one(TX.safe_name, ["a b/é.pdf", "ok-1_2.txt"]) == ["a_b__.pdf", "ok-1_2.txt"]
    assert one(lambda c: TX.dump_name(c, "chunked", "x_"), ["a b"]) == ["x_a_b_chunked.txt"]


def test_join_pages(one):
    pages = [[], ["a"], ["a", None, "b"]]
    assert one(TX.join_pages, pages, "array<string>") == ["", "\n\na", "\n\na\n\n\n\nb"]
    assert one(lambda c: TX.join_pages(c, False), pages, "array<string>") == ["", "a", "a\n\n\n\nb"]


def test_size_class_is_strict(one):
    sizes = [52428799, 52428800, 52428801]
    assert one(TX.size_class, sizes, "bigint") == ["NORMAL", "NORMAL", "LARGE"]


def test_estimates(one):
    assert one(TX.estimated_chunks, [0, 1, 262144, 262145], "bigint") == [0, 1, 1, 2]
    assert one(TX.megabytes, [0, 1572864], "bigint") == ["0.00", "1.50"]


@pytest.mark.parametrize(
    "url,name",
    [
        ("http://h/d/a%20b.pdf", "a b.pdf"),
        ("http://h/d/a+b.pdf", "a b.pdf"),
        ("http://h/d/bad%zz.pdf", None),
        ("http://h/d/a.pdf?op=OPEN", "a.pdf?op=OPEN"),
        ("http://h/d/", ""),
        ("plain.txt", "plain.txt"),
        ("http://h/c é.pdf", "c é.pdf"),
    ],
)
def test_stream_filename(one, url, name):
    assert one(U.stream_filename, [url]) == [name]


def test_fetch_url(one):
    urls = ["http://h/a b.pdf", "http://h/a%20b.pdf", "http://h/a.pdf?x=1", "http://h/a.pdf?op=OPEN", "http://h/é.pdf"]
    assert one(U.fetch_url, urls) == [
        "http://h/a+b.pdf?op=OPEN",
        "http://h/a%20b.pdf?op=OPEN",
        "http://h/a.pdf?x=1&op=OPEN",
        "http://h/a.pdf?op=OPEN",
        "http://h/%C3%A9.pdf?op=OPEN",
    ]


def test_output_paths(one):
    base = "http://nn:50070/webhdfs/v1/in/x/webhdfs/v1/y.pdf"
    assert one(U.store_base, [base, "http://h/a.pdf"]) == ["http://nn:50070/webhdfs/v1", "http://h/a.pdf"]
    assert one(lambda c: U.output_path(c, F.lit("My Doc é*~.pdf")), [base]) == [
        "http://nn:50070/webhdfs/v1/processed_files/My+Doc+%C3%A9*%7E.pdf.txt"
    ]
    assert one(lambda c: U.local_output_path("/out/", c), ["a b.pdf"]) == ["/out/a b.pdf.txt"]


def test_storage_path(one):
    urls = ["http://nn:1/webhdfs/v1/a/b%20c.txt?op=OPEN", "/a/b", "hdfs://nn/a?x"]
    assert one(U.storage_path, urls) == ["/a/b c.txt", "/a/b", "hdfs://nn/a"]


def test_file_key_is_sha256(one):
    assert one(U.file_key, ["http://h/é"]) == [hashlib.sha256("http://h/é".encode()).hexdigest()]


def test_html(one):
    page = (
        "<html><head><title>T</title><script>var t='</p>';</script></head><body><h1>A &amp; B</h1>"
        "<!-- x --><p>one<b>two</b>&nbsp; three<br>four<style>p{}</style><p>5 &lt; 6 &amp;lt; <span"
    )
    assert one(H.html_to_text, [page, "", "a < b"]) == ["A & B\nonetwo three\nfour \n5 < 6 &lt;".replace(" \n", "\n"), "", "a < b"]


def test_html_unclosed_parts(one):
    pages = ["<p>a<!-- cut", "a<script>x</p>", "a<style>b</style>c<script", "<head><title>t", "x<br" ]
    assert one(H.html_to_text, pages) == ["a", "a", "ac", "t", "x"]


def test_html_scan_is_linear(one):
    page = "<!--" * 50000 + "\U0001f600a" * 50000 + "<script>" * 50000
    assert one(H.html_to_text, ["<p>x</p>" + page]) == ["x"]


def test_entities(one):
    raw = ["a &amp;amp; b", "&#39;&#x41;&#128512;&#0;&#xD800;", "&unknown; & &lt", "&;&amp", "no", "x&copy;&middot;y&"]
    assert one(H.decode_entities, raw) == ["a &amp; b", "'A\U0001f600&#0;&#xD800;", "&unknown; & &lt", "&;&amp", "no", "x©·y&"]


def test_mime(one):
    assert one(MT.mime_from_name, ["a.PDF", "a.tar.html", "a", "a.", "x.y/z"]) == ["application/pdf", "text/html", None, None, None]
    data = [b"%PDF-1.7", b"PK\x03\x04..", b" <!DOCTYPE html>", b"hello", b"\xff\xfe\x00", b"{\\rtf1"]
    assert one(MT.mime_from_bytes, data, "binary") == [
        "application/pdf", "application/zip", "text/html", "text/plain", None, "application/rtf",
    ]


def test_error_class_first_match_wins(one):
    messages = [
        None, "Missing root object specification in trailer", "TIKA-198: x", "org.apache.tika.TikaException: TIKA-198",
        "TikaException", "java.io.IOException: memory", "not enough memory", "OutOfMemoryError", "boom",
    ]
    assert one(S.error_class, messages) == [
        "NO_MESSAGE", "CORRUPTED_PDF", "CORRUPTED_PDF", "CORRUPTED_PDF", "PARSE_ERROR", "IO_ERROR",
        "MEMORY_ERROR", "MEMORY_ERROR", "UNKNOWN",
    ]


def test_consumer_and_binding_status(one):
    raw = [None, "running", "Binding x: Stopped", "running then stopped", "foo"]
    assert one(S.consumer_status, raw) == ["UNKNOWN", "CONSUMING", "IDLE", "CONSUMING", "FOO"]
    states = [None, "[state=running]", "[state=stopped]", "odd"]
    assert one(lambda c: S.binding_status(F.lit("b"), c), states) == [
        "Binding b: unknown", "Binding b: running", "Binding b: stopped", "Binding b: odd",
    ]
    assert one(S.is_running, [None, "not running", "x"]) == [False, True, False]


def test_event_status_and_stage(spark):
    rows = spark.createDataFrame(
        [("file_start", False, False), ("PROCESSING", False, False), ("X", True, True), ("X", True, False), ("X", False, True)],
        "e string, en boolean, r boolean",
    )
    got = rows.select(
        S.event_status(F.col("e"), F.col("en"), F.col("r")).alias("s"), S.event_stage(F.col("e"), F.col("en"), F.col("r")).alias("t")
    ).collect()
    assert [tuple(r) for r in got] == [
        ("PROCESSING", "processing"), ("PROCESSING", "idle"), ("RUNNING", "processing"), ("IDLE", "idle"), ("IDLE", "idle"),
    ]


def test_uptime_and_rate(one):
    assert one(S.uptime_text, [0, 59, 3600, 90000], "bigint") == ["0h 0m", "0h 0m", "1h 0m", "25h 0m"]
    assert one(lambda c: S.processing_rate(F.lit(5), c), [0, 2], "bigint") == [0.0, 2.5]


def test_instance_fields(one):
    assert one(lambda c: S.instance_url(c, F.lit("pub:9"), F.lit("h")), [None, " ", "http://x"]) == ["http://pub:9", "http://pub:9", "http://x"]
    assert one(lambda c: S.instance_url(F.lit(None).cast("string"), c, F.lit("h")), [None, "p"]) == ["http://h:8080", "http://p:8080"]
    assert one(lambda c: S.instance_id(c, F.lit("app"), F.lit(""), F.lit(7), F.lit("h")), ["o", ""]) == ["o", "app-7@h"]
    assert one(lambda c: S.instance_id(F.lit(""), F.lit("app"), c, F.lit(None).cast("int"), F.lit("h")), ["3", None]) == ["app-3", "app-unknown@h"]
    assert one(S.first_uri_host, ['{"application_uris":["A.Example"]}', '{"application_uris":[]}', "{}"]) == ["a.example", None, None]
    assert one(S.port_number, ["9090", "x", None]) == [9090, 8080, 8080]


def test_message_time(one):
    raw = ["2025-08-08T13:18:16.219026-04:00", "2025-08-08T12:34:56.789Z", "2025-08-07T12:34:56", "1723141096219", "garbage", None]
    got = one(lambda c: S.message_time(c).cast("string"), raw)
    assert got == [
        "2025-08-08 17:18:16.219026", "2025-08-08 12:34:56.789", "2025-08-07 12:34:56", "2024-08-08 18:18:16.219", None, None,
    ]


def test_liveness_bounds(one):
    ages = [30_000_000, 30_001_000, 120_000_000, 120_001_000]
    assert one(S.liveness, ages, "bigint") == ["Alive", "Degraded", "Degraded", "Offline"]


def test_queue_depth(one):
    bodies = [
        '{"messages": 12}', '{"a":{"messages":3}}', '[{"messages" :4},{"messages":9}]', "{}", '{"messages":"x","n":5}',
        '{"messages": -2}', '{"messages": 99999999999}', None, '{"messages":null,"z":{"messages":4}}',
    ]
    assert one(queue_depth, bodies) == [12, 3, 4, -1, -1, -1, -1, -1, -1]
