"""Operator inputs derived from the given tables, row by row and deterministically."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from inkwell.functions import mime as MT, urls as U
from inkwell.operators import ledger as L
from inkwell.operators.evaluate import spread_small
from inkwell.session import configure

EPOCH_S = 1_704_067_200  # 2024-01-01T00:00:00Z


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a text table, spread over the cores if the table is small."""
    return spread_small(table(spark, sf_dir, name).select(*columns))


def at_second(n: Column) -> Column:
    return F.timestamp_seconds(n.cast("long") + F.lit(EPOCH_S))


def pick(index: Column, *values: str) -> Column:
    """Value number ``index mod n``."""
    n = len(values)
    out = F.when(index % n == 0, F.lit(values[0]))
    for i in range(1, n):
        out = out.when(index % n == i, F.lit(values[i]))
    return out


# ids of files made besides the documents, which all go through as they are
BLANK_FILES, PDF_FILES, PLUS_FILES = 1_000_000_000, 2_000_000_000, 3_000_000_000


def with_made_files(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, source and, if given, text) and further ones: blank files, a format without reader, odd names."""
    has_text = "text" in docs.columns

    def row(shift: int, kind: str | None, text: Column) -> Column:
        fields = [(F.col("doc_id") + F.lit(shift)).cast("long").alias("doc_id"), "source", F.lit(kind).cast("string").alias("kind")]
        return F.struct(*fields, *([text.alias("text")] if has_text else []))

    text = F.col("text") if has_text else F.lit(None)
    rows = F.array(
        row(0, None, text),
        F.when(F.col("doc_id") % 37 == 0, row(BLANK_FILES, "blank", F.lit(" \n\t "))),
        F.when(F.col("doc_id") % 6 == 2, row(PDF_FILES, "pdf", text)),
        F.when(F.col("doc_id") % 31 == 0, row(PLUS_FILES, "plus", text)),
    )
    return docs.select(F.explode(F.array_compact(rows)).alias("f")).select("f.*")


def document_name() -> Column:
    i, kind = F.col("doc_id"), F.col("kind")
    ending = (
        F.when(kind == "blank", F.lit(".txt")).when(kind == "pdf", F.lit(".pdf")).when(kind == "plus", F.lit("+x y.txt"))
        .otherwise(pick(i, ".txt", ".html", ".md", ".csv", ".json", ""))
    )
    return F.concat(F.lit("doc_"), i, ending)


def document_path() -> Column:
    return F.concat(F.lit("/corpus/"), F.col("source"), F.lit("/"), document_name())


def raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of six formats, and the made ones."""
    docs = with_made_files(texts(spark, sf_dir, "documents", "doc_id", "source", "text"))
    return docs.select(
        "doc_id",
        "source",
        document_name().alias("filename"),
        document_path().alias("path"),
        at_second(F.col("doc_id") * 60).alias("modificationTime"),
        F.octet_length("text").cast("long").alias("length"),
        F.encode("text", "UTF-8").alias("content"),
    )


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of the same files; no text is read."""
    docs = with_made_files(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return docs.select(
        "doc_id",
        "source",
        document_name().alias("filename"),
        document_path().alias("path"),
        at_second(F.col("doc_id") * 60).alias("modificationTime"),
    )


def store_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages naming the files above: a few name missing files, a third arrive twice."""
    return store_refs_of(table(spark, sf_dir, "documents"))


def store_refs_of(documents: DataFrame) -> DataFrame:
    """The same on any documents table, streaming ones included."""
    docs = with_made_files(documents.select("doc_id", "source"))
    name = F.when(F.col("doc_id") % 23 == 0, F.concat(F.lit("missing_"), F.col("doc_id"))).otherwise(
        F.replace(document_name(), F.lit(" "), F.lit("%20"))
    )
    url = F.concat(F.lit("http://namenode:9870/webhdfs/v1/corpus/"), F.col("source"), F.lit("/"), name)
    value = F.concat(
        F.lit('{"type":"'), F.when(F.col("doc_id") % 29 == 0, F.lit("S3")).otherwise(F.lit("HDFS")),
        F.lit('","url":"'), url, F.lit('","outputStream":"out"}'),
    )
    once = docs.select(F.col("doc_id").alias("msg_id"), at_second(F.col("doc_id")).alias("arrived_at"), value.alias("value"))
    return with_copies(once)


def with_copies(once: DataFrame) -> DataFrame:
    """Every third message arrives again much later, under a new id."""
    copy = F.col("msg_id") % 3 == 0
    later = F.struct(
        (F.col("msg_id") + 1_000_000_000_000).alias("msg_id"),
        (F.col("arrived_at") + F.expr("INTERVAL 1000 DAYS")).alias("arrived_at"),
        "value",
    )
    now = F.struct("msg_id", "arrived_at", "value")
    return once.select(F.explode(F.when(copy, F.array(now, later)).otherwise(F.array(now))).alias("m")).select("m.*")


def file_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages naming web pages: mixed types, blank urls, duplicates, malformed JSON."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    i = F.col("page_id")
    kind = F.when(i % 17 == 0, F.lit("S3")).when(i % 5 == 0, F.lit("hdfs")).otherwise(F.lit("HDFS"))
    url = F.when(i % 19 == 0, F.lit("")).otherwise(F.col("url"))
    stream = F.when(i % 4 == 0, F.lit("")).otherwise(F.concat(F.lit(',"inputStream":"in-'), i % 3, F.lit('"')))
    value = F.concat(
        F.lit('{"type":"'), kind, F.lit('","url":"'), url, F.lit('"'), stream, F.lit(',"outputStream":"out"}')
    )
    value = F.when(i % 41 == 0, F.left(value, F.lit(10))).otherwise(value)
    once = pages.select(i.alias("msg_id"), at_second(i).alias("arrived_at"), value.alias("value"))
    return with_copies(once)


def store_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page urls, every second one below a storage API root."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.withColumn(
        "url",
        F.when(F.col("page_id") % 2 == 0, F.regexp_replace("url", r"\A(https?://[^/]+)/", "$1/webhdfs/v1/in/"))
        .otherwise(F.col("url")),
    )


def document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per line of the document, blank lines included."""
    docs = texts(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", F.split("text", "\n").alias("pages"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processing history with overwritten names; every 11th row is an error."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source")
    i = F.col("doc_id")
    name = F.concat(F.lit("doc_"), i % 700, F.lit(".txt"))
    return docs.select(
        i.alias("seq"),
        name.alias("filename"),
        U.file_key(F.concat(F.lit("http://namenode:9870/webhdfs/v1/corpus/"), F.col("source"), F.lit("/"), name)).alias("url_key"),
        MT.mime_from_name(name).alias("file_type"),
        F.col("n_chars").alias("file_size"),
        F.lit(L.CHUNK_SIZE).alias("chunk_size"),
        F.lit(1).alias("chunk_count"),
        at_second(i * 60).cast("timestamp_ntz").alias("processed_at"),
        F.when(i % 11 == 0, F.lit("ERROR")).otherwise(F.lit("COMPLETED")).alias("status"),
        F.when(i % 7 == 0, F.concat(F.lit("in-"), i % 3)).alias("input_stream"),
        F.when(i % 9 == 0, F.concat(F.lit("out-"), i % 2)).alias("output_stream"),
        F.col("n_chars").alias("text_length"),
        (F.col("n_chars") % 997 + 10).alias("elapsed_ms"),
    )


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as monitoring messages, one instance per user, three services."""
    ev = table(spark, sf_dir, "events")
    u, i, t = F.col("user_id"), F.col("event_id"), F.col("event_type")
    service = pick(u, "watcher", "extractor", "embedder")
    ts = F.col("ts").cast("timestamp")
    return ev.select(
        "event_id",
        ts.alias("ts"),
        service.alias("service"),
        F.concat(service, F.lit("-"), u).alias("instanceId"),
        F.when(i % 2 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .otherwise(F.unix_millis(ts).cast("string")).alias("timestamp"),
        F.when(t == "signup", F.lit("INIT")).when(t == "view", F.lit("HEARTBEAT")).when(t == "click", F.lit("FILE_START"))
        .when(t == "purchase", F.lit("FILE_COMPLETE")).when(t == "error", F.lit("ERROR")).alias("event"),
        F.when(t == "error", F.lit("ERROR")).when(t.isin("click", "purchase"), F.lit("PROCESSING"))
        .when(t == "signup", F.lit("STARTING")).when(i % 2 == 0, F.lit("RUNNING")).otherwise(F.lit("IDLE")).alias("status"),
        F.when(i % 3 == 0, F.lit(-1)).otherwise(F.get_json_object("props", "$.k").try_cast("long")).cast("long").alias("pendingMessages"),
        F.when(t.isin("click", "purchase"), F.concat(F.lit("doc_"), i, F.lit(".txt"))).alias("filename"),
        F.when(t == "error", F.concat(F.lit("failure "), i % 7)).alias("lastError"),
        F.when(u % 10 == 3, F.lit("")).otherwise(F.concat(F.lit("host-"), u % 10)).alias("hostname"),
        F.when(u % 4 == 1, F.concat(F.lit("pub-"), u, F.lit(".example.org:9000")))
        .when(u % 4 > 1, F.concat(F.lit("pub-"), u, F.lit(".example.org"))).alias("publicHostname"),
        F.when(i % 5 == 1, F.lit("")).when(i % 5 > 1, F.concat(F.lit("http://app-"), u, F.lit(".example.org"))).alias("url"),
        F.concat(F.lit("5."), u % 4, F.lit("."), i % 3).alias("version"),
        F.when(i % 2 == 0, F.lit("state=running")).otherwise(F.lit("state=stopped")).alias("bindingState"),
        (u % 5 != 0).alias("hdfsProcessedDirExists"),
        F.when(t == "signup", F.lit("starting")).when(t == "view", F.lit("idle"))
        .when(t == "error", F.lit("error")).otherwise(F.lit("processing")).alias("processingStage"),
        F.lit("scdf").alias("inputMode"),
        F.concat(F.lit("z"), u % 3).alias("zone"),
        F.col("value").alias("processingRate"),
    )


def metrics_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as JSON text, some incomplete, illegal or cut off."""
    m = spread_small(metrics(spark, sf_dir))
    i = F.col("event_id")
    body = F.to_json(
        F.struct(
            "instanceId",
            "timestamp",
            F.when(i % 31 != 0, F.col("event")).alias("event"),
            F.when(i % 37 == 0, F.lit("BROKEN")).otherwise(F.col("status")).alias("status"),
            "processingRate", "lastError", "pendingMessages", "hostname", "publicHostname", "filename", "url", "version",
            F.struct(
                "service", "bindingState", "hdfsProcessedDirExists", "inputMode", "processingStage",
                F.create_map(F.lit("zone"), F.col("zone")).alias("tags"),
            ).alias("meta"),
        )
    )
    return m.select("event_id", F.when(i % 43 == 0, F.left(body, F.lit(40))).otherwise(body).alias("value"))


def control_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    t = F.col("event_type")
    return ev.select(
        F.col("event_id").alias("cmd_id"),
        F.concat(pick(F.col("user_id"), "watcher", "extractor", "embedder"), F.lit("-"), F.col("user_id")).alias("instance_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(t == "signup", F.lit("start")).when(t == "error", F.lit("stop")).when(t == "purchase", F.lit("reset"))
        .when(t == "click", F.lit("toggle")).otherwise(F.lit("state")).alias("cmd"),
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "view")
    return ev.select(
        F.concat(pick(F.col("user_id"), "watcher", "extractor", "embedder"), F.lit("-"), F.col("user_id")).alias("instance_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
    )


def queue_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Management snapshots of eight shapes, two of them without a usable number."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    i = F.col("event_id")
    n = (i % 500).cast("string")
    body = (
        F.when(i % 8 == 0, F.concat(F.lit('{"messages": '), n, F.lit("}")))
        .when(i % 8 == 1, F.concat(F.lit('{"name":"q","stats":{"messages":'), n, F.lit("}}")))
        .when(i % 8 == 2, F.concat(F.lit('[{"messages" : '), n, F.lit('},{"messages":7}]')))
        .when(i % 8 == 3, F.lit('{"name":"q"}'))
        .when(i % 8 == 4, F.lit('{"messages":"many","messages_ready":4}'))
        .when(i % 8 == 5, F.concat(F.lit('{"messages": -'), n, F.lit("}")))
        .when(i % 8 == 6, F.lit('{"messages": 99999999999}'))
    )
    return ev.select("event_id", "ts", "user_id", body.alias("body"))


def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failure messages of all classes; each carries the number of its document."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    i = F.col("doc_id")
    text = pick(
        i,
        "Missing root object specification in trailer.",
        "TIKA-198: Illegal IOException from org.apache.tika.parser.pdf.PDFParser@1",
        "org.apache.tika.exception.TikaException: Unexpected RuntimeException",
        "java.io.IOException: stream closed",
        "Not enough memory left",
        "java.lang.OutOfMemoryError: Java heap space",
        "index out of range",
        "org.apache.tika.io.IOException in memory buffer",
    )
    message = F.when(i % 13 != 0, F.concat(text, F.lit(" #"), i))
    return docs.select(i.alias("doc_id"), F.concat(F.lit("doc_"), i, F.lit(".pdf")).alias("filename"), message.alias("message"))
