"""Registered queries: one per operator, each over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from inkwell.functions import html as H, mime as MT, status as S, text as TX, urls as U
from inkwell.operators import (
    chunks as C, control as K, extract as X, ledger as L, monitoring as MO, outcomes as O, refs as R, splits as SP, tokens as TK,
)
from inkwell.operators.evaluate import computed_once
from inkwell.plans import fixtures as FX
from inkwell.plans.process import chunk_references, flag_messages, from_table, process_directory, process_refs, staged
from inkwell.session import shared_dir
from inkwell.sinks import exports as EX
from inkwell.sinks.index import KeyIndex
from inkwell.sources import files as FS, messages as M, queues as Q
from inkwell.sources.fetch import fetch_content
from inkwell.streaming.processor import DocumentStream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# thresholds scaled to the sizes in the given tables, so that every class occurs
SMALL_THRESHOLD = 8192
CHUNKING = C.ChunkParams(budget=2000, min_chars=200)
TOKEN_BUDGET = 500
ALIVE_S, DEGRADED_S, STALE_S = 6 * 3600, 12 * 3600, 4 * 3600


def query(fn: Query) -> Query:
    """Register under the function's name; timestamps leave as naive UTC."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        naive = {
            f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)
        }
        return df.withColumns(naive) if naive else df

    QUERIES[fn.__name__] = run
    return fn


# -- sources ---------------------------------------------------------------


def _text_path():
    """Path of a document's file: not all in one folder, as a folder is listed by one task."""
    return F.concat("source", F.lit("/"), F.expr("doc_id div 5000"), F.lit("/doc+"), "doc_id", F.lit(".txt"))


def _text_files(spark, sf) -> str:
    """Every document as a text file of its own, in a new folder."""
    docs = FX.texts(spark, sf, "documents", "doc_id", "source", "text")
    folder = f"{shared_dir(spark).rstrip('/')}/files-{uuid.uuid4().hex}"
    named = docs.select(_text_path().alias("path"), F.coalesce("text", F.lit("")).alias("text"))
    EX.export_text_files(named, folder, "path", "text")
    return folder


@query
def scan_binary(spark, sf):
    """Export of all texts and a scan of the folder."""
    return FS.scan_files(spark, _text_files(spark, sf), recursive=True, glob="*.txt").select(
        F.substring_index("path", "/", -1).alias("filename"), "length", F.sha2("content", 256).alias("content_sha")
    )


@query
def fetch_files(spark, sf):
    """The same files opened one by one by their references; some references name no file."""
    folder = _text_files(spark, sf)
    docs = FX.table(spark, sf, "documents").select("doc_id", "source")
    missing = docs.where("doc_id % 23 = 0").select((F.col("doc_id") + FX.BLANK_FILES).alias("doc_id"), "source")
    url = F.concat(F.lit("http://namenode:9870/webhdfs/v1/"), _text_path())
    got = fetch_content(docs.union(missing).select(F.col("doc_id").alias("msg_id"), url.alias("url")), folder)
    return got.select("msg_id", "fetched", "length", F.sha2("content", 256).alias("content_sha"), "fetch_error")


@query
def parse_file_refs(spark, sf):
    return M.parse_file_refs(FX.file_refs(spark, sf)).select(
        "msg_id", "arrived_at", "type", "url", "inputStream", "outputStream", "malformed"
    )


@query
def fetch_by_ref(spark, sf):
    flagged = staged(flag_messages(FX.store_refs(spark, sf)), "refs")
    files = FX.raw_files(spark, sf).select("path", "length", "content")
    got = FS.attach_content(flagged.where("dedupe = 'FIRST'"), files)
    return got.select("msg_id", "url", "outputStream", "fetched", "length", F.sha2("content", 256).alias("content_sha"))


@query
def queue_depth_parse(spark, sf):
    return Q.queue_report(FX.queue_samples(spark, sf)).select("event_id", "queue_depth", "status")


# -- references ------------------------------------------------------------


@query
def validate_refs(spark, sf):
    return M.validate_refs(M.parse_file_refs(FX.file_refs(spark, sf))).select("msg_id", "url", "filename", "reject")


@query
def dedupe_refs(spark, sf):
    refs = M.validate_refs(M.parse_file_refs(FX.file_refs(spark, sf)))
    # history: pages whose number is divisible by ten were handled before
    old = FX.table(spark, sf, "pages").where("page_id % 10 = 0").select(U.file_key(F.col("url")).alias("url_key"))
    return R.dedupe_refs(refs, old).select("msg_id", "url_key", "dedupe")


@query
def dedupe_indexed(spark, sf):
    """The same messages in ten batches, each asking the key index instead of the whole history."""
    refs = staged(M.validate_refs(M.parse_file_refs(FX.file_refs(spark, sf))), "refs")
    index = KeyIndex(spark, f"{shared_dir(spark).rstrip('/')}/index-{uuid.uuid4().hex}")
    old = FX.table(spark, sf, "pages").where("page_id % 10 = 0").select(U.file_key(F.col("url")).alias("url_key"), F.lit(0).cast("long").alias("stamp"))
    index.add(old, 0)
    cuts = refs.agg(F.percentile_approx(F.unix_micros("arrived_at"), [i / 10 for i in range(1, 10)])).first()[0] or []
    later = [F.when(F.unix_micros("arrived_at") > c, 1).otherwise(0) for c in cuts]
    number = sum(later, F.lit(0)) + F.when(F.col("arrived_at").isNull(), len(cuts)).otherwise(0)  # without a time: last
    flagged = []
    for batch in range(len(cuts) + 1):
        part = refs.where(number == batch)
        flags = staged(R.dedupe_refs(part, lambda keys, b=batch: R.done_keys(index.lookup(keys, before=b + 1))), "flags")
        index.add(flags.where("dedupe = 'FIRST'").select("url_key", F.lit(0).cast("long").alias("stamp")), batch + 1)
        flagged.append(flags.select("msg_id", "url_key", "dedupe"))
    return reduce(DataFrame.union, flagged)


@query
def reprocess(spark, sf):
    history = FX.ledger(spark, sf)
    done = history.select("url_key", "processed_at", "status")
    chosen = FX.table(spark, sf, "documents").where("doc_id % 5 = 0").select(
        F.concat(
            F.lit("http://namenode:9870/webhdfs/v1/corpus/"), F.col("source"),
            F.lit("/doc_"), F.col("doc_id") % 700, F.lit(".txt"),
        ).alias("url")
    )
    at = F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")
    markers = L.reprocess_markers(chosen, at).select("url_key", "processed_at", "status")
    still_done = R.ledger_keys(done.unionByName(markers))
    return R.ledger_keys(done).join(still_done.withColumn("skip", F.lit(True)), "url_key", "left").select(
        "url_key", F.coalesce("skip", F.lit(False)).alias("still_done")
    )


@query
def url_filename(spark, sf):
    pages = FX.table(spark, sf, "pages")
    return pages.select(
        "page_id", U.stream_filename(F.col("url")).alias("filename"), U.file_key(F.col("url")).alias("url_key")
    )


@query
def fetch_url(spark, sf):
    urls = FX.store_urls(spark, sf)
    return urls.select(
        "page_id",
        U.with_open_op(F.col("url")).alias("open_url"),
        U.fetch_filename(F.col("url")).alias("name"),
        U.fetch_url(F.col("url")).alias("fetch_url"),
    )


@query
def output_path(spark, sf):
    urls = FX.store_urls(spark, sf).withColumn("filename", U.stream_filename(F.col("url")))
    return urls.select(
        "page_id",
        U.store_base(F.col("url")).alias("base"),
        U.output_path(F.col("url"), F.col("filename")).alias("output_path"),
        U.local_output_path("/data/output", F.col("filename")).alias("local_path"),
    )


@query
def path_collisions(spark, sf):
    urls = FX.store_urls(spark, sf).withColumn("filename", U.stream_filename(F.col("url")))
    # one store for all sources: equal file names meet
    paths = urls.select("url", U.output_path(F.lit("http://nn/webhdfs/v1/x"), F.col("filename")).alias("output_path"))
    return L.path_collisions(paths)


# -- extraction ------------------------------------------------------------


@query
def extract_html(spark, sf):
    pages = FX.texts(spark, sf, "pages", "page_id", "url", "html")
    texts = computed_once(pages, "page", H.html_to_text(F.col("html")))
    joined = texts.withColumn("text", TX.join_pages(F.array("page"))).withColumn("filename", U.stream_filename(F.col("url")))
    return joined.where(~TX.is_blank_trimmed(F.col("text"))).select(
        "page_id",
        "filename",
        U.output_path(F.col("url"), F.col("filename")).alias("output_path"),
        "text",
        TX.utf16_length(F.col("text")).alias("n_utf16"),
    )


@query
def extract_text(spark, sf):
    return X.extract_text(FX.raw_files(spark, sf), readers={}).select(
        "doc_id", "mime", "failure", "text", F.length("text").alias("n_chars")
    )


@query
def content_type(spark, sf):
    files = FX.raw_files(spark, sf)
    return files.select(
        "doc_id",
        MT.mime_from_name(F.col("filename")).alias("by_name"),
        MT.content_type(F.col("filename"), F.col("content")).alias("mime"),
    )


@query
def size_class(spark, sf):
    files = FX.raw_files(spark, sf)
    return files.groupBy(TX.size_class(F.col("length"), SMALL_THRESHOLD).alias("size_class")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"), F.max("length").alias("largest")
    )


@query
def classify_text(spark, sf):
    """Every text, and as many made ones at the edges of blankness."""
    i = F.col("doc_id")
    made = F.when(i % 7 < 6, FX.pick(i % 7, "", " \n\t", "\u2003", "\u00a0", "\u0001", "x"))
    docs = FX.texts(spark, sf, "documents", "doc_id", "text")
    rows = docs.union(FX.table(spark, sf, "documents").select(i + F.lit(FX.BLANK_FILES), made))
    return rows.select(
        "doc_id",
        TX.is_blank_trimmed(F.col("text")).alias("blank_trimmed"),
        TX.is_blank_unicode(F.col("text")).alias("blank_unicode"),
    )


@query
def join_pages(spark, sf):
    return FX.document_pages(spark, sf).select(
        "doc_id",
        TX.join_pages(F.col("pages")).alias("text"),
        TX.join_pages(F.col("pages"), leading_separator=False).alias("plain"),
    )


@query
def page_diag(spark, sf):
    return C.page_diagnostics(FX.document_pages(spark, sf), "pages", ["doc_id"])


@query
def safe_name(spark, sf):
    pages = FX.table(spark, sf, "pages").withColumn("filename", U.stream_filename(F.col("url")))
    return pages.select(
        "page_id",
        TX.safe_name(F.col("filename")).alias("safe"),
        TX.dump_name(F.col("filename")).alias("text_dump"),
        TX.dump_name(F.col("filename"), "chunked").alias("chunk_dump"),
    )


# -- chunks ----------------------------------------------------------------


def _document_chunks(spark, sf, params=CHUNKING):
    docs = FX.texts(spark, sf, "documents", "doc_id", "text").withColumn("pages", F.array("text"))
    return C.chunk_text(docs, "pages", params, ["doc_id"])


@query
def chunk_text(spark, sf):
    return _document_chunks(spark, sf)


@query
def chunk_text_large(spark, sf):
    """The rule for large files, named by the caller, over all texts."""
    return _document_chunks(spark, sf, C.params_for(L.CHUNK_SIZE, "large"))


@query
def chunk_capped(spark, sf):
    """Both options of the caller: short chunks left out and counted, the rest after the cap in one chunk."""
    docs = FX.texts(spark, sf, "documents", "doc_id", "text")
    p = C.ChunkParams(budget=2000, min_chars=200, min_len=40, max_chunks=8)
    return docs.select("doc_id", F.size(C.split_text(F.col("text"), p)).alias("n_chunks"), C.left_out(F.col("text"), p).alias("left_out"))


@query
def chunk_loss(spark, sf):
    """Non-blank characters in and out of the chunker, and the longest chunk, per document."""
    docs = FX.texts(spark, sf, "documents", "doc_id", "text")
    solid = lambda c: F.length(F.regexp_replace(c, TX.CONTROL_AND_SPACE, "")).cast("long")
    rows = docs.where(~TX.is_blank_trimmed(F.col("text"))).select("doc_id", solid(F.col("text")).alias("n_in"), C.split_text(F.col("text"), CHUNKING).alias("c"))
    return rows.select(
        "doc_id", "n_in", F.aggregate("c", F.lit(0).cast("long"), lambda n, c: n + solid(c["text"])).alias("n_out"),
        (F.array_max(F.transform("c", lambda c: F.length(c["text"]))) <= CHUNKING.budget).alias("within_budget"),
    )


def token_chunks(spark, sf):
    """Chunks of at most TOKEN_BUDGET tokens of a byte-pair vocabulary."""
    import public_tokenizers

    docs = FX.texts(spark, sf, "documents", "doc_id", "text")
    vocabulary = TK.read_vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return TK.chunk_by_tokens(docs, "text", ["doc_id"], vocabulary, TOKEN_BUDGET, CHUNKING.min_chars)


@query
def chunk_tokens_loss(spark, sf):
    """Non-blank characters in and out of the token chunker, and whether a chunk exceeds the budget, per document."""
    docs = FX.table(spark, sf, "documents").select("doc_id", F.length(F.regexp_replace("text", TX.CONTROL_AND_SPACE, "")).cast("long").alias("n_in"))
    out = token_chunks(spark, sf).groupBy("doc_id").agg(
        F.sum(F.length(F.regexp_replace("chunk", TX.CONTROL_AND_SPACE, ""))).alias("n_out"),
        F.max(F.col("n_tokens") > TOKEN_BUDGET).alias("over_budget"),
        (F.count("*") == F.max("n_chunks")).alias("all_there"),
    )
    return docs.join(out, "doc_id", "left")


@query
def chunk_split_file(spark, sf):
    """All texts as files, read in ranges of 4 KB; each window is found by the range it starts in."""
    folder = _text_files(spark, sf)
    named = FX.table(spark, sf, "documents").select("doc_id", F.concat(F.lit(folder + "/"), _text_path()).alias("path"), F.octet_length("text").cast("long").alias("length"))
    chunks = SP.chunk_files(named, CHUNKING, staged, split_bytes=4096)
    return chunks.select(F.regexp_extract("path", r"doc\+(\d+)\.txt$", 1).cast("long").alias("doc_id"), "chunk_no", "n_chunks", "text")


@query
def chunk_refs(spark, sf):
    flagged = staged(flag_messages(FX.store_refs(spark, sf)), "refs")
    files = FX.raw_files(spark, sf).select("path", "length", "content")
    return chunk_references(flagged, from_table(files), CHUNKING, ["msg_id"], readers={}).select(
        "msg_id", "chunk_no", "n_chunks", "text", "overflow"
    )


@query
def chunk_report(spark, sf):
    docs = FX.texts(spark, sf, "documents", "doc_id", "text")
    arrays = docs.select("doc_id", C.split_text(F.col("text"), CHUNKING).alias("c"))
    return arrays.select("doc_id", C.report_of(F.transform("c", lambda x: x["text"])).alias("report"))


@query
def chunk_rejoin(spark, sf):
    return C.rejoin_chunks(_document_chunks(spark, sf), "doc_id")


@query
def chunk_stats(spark, sf):
    return _document_chunks(spark, sf).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.sum(F.length("text")).alias("n_chars"),
        F.max(F.length("text")).alias("longest"),
    )


@query
def chunk_params(spark, sf):
    docs = FX.table(spark, sf, "documents").select("doc_id", "n_chars")
    cols = C.rule_columns((F.col("n_chars") * 16).cast("int"), F.col("n_chars") > SMALL_THRESHOLD)
    return docs.select("doc_id", *[e.alias(n) for n, e in cols.items()])


@query
def estimate_chunks(spark, sf):
    files = FX.table(spark, sf, "documents").select("doc_id", (F.col("n_chars") * 1000).alias("length"))
    return files.select(
        "doc_id",
        TX.estimated_chunks(F.col("length")).alias("n_chunks"),
        TX.megabytes(F.col("length")).alias("mb"),
    )


# -- outcomes and ledger ---------------------------------------------------


@query
def route_outcome(spark, sf):
    files = FX.raw_files(spark, sf).select("path", "length", "content")
    rows = process_refs(FX.store_refs(spark, sf), from_table(files), readers={})
    return rows.select(
        "msg_id", "dedupe", "outcome", O.route(F.col("outcome")).alias("destination"), "mime", "text_length"
    )


@query
def stream_extract(spark, sf):
    root = f"{shared_dir(FX.configure(spark)).rstrip('/')}/stream-{uuid.uuid4().hex}"
    documents = f"{sf}/documents.parquet"
    schema = spark.read.parquet(documents).schema
    incoming = spark.readStream.schema(schema).option("pathGlobFilter", "documents.parquet").parquet(sf)
    files = FX.raw_files(spark, sf).select("path", "length", "content")
    stream = DocumentStream(spark, root, from_table(files), readers={})
    stream.start(FX.store_refs_of(incoming), f"{root}/checkpoint", {"availableNow": True}).awaitTermination()
    return stream.outcomes().select("msg_id", "dedupe", "outcome", "mime", "text_length")


@query
def directory_batch(spark, sf):
    files = FX.raw_files(spark, sf)
    done = files.where("doc_id % 4 = 0").select("path")
    return process_directory(files.select("path", "length", "content"), done, readers={}).select(
        "filename", "mime", "outcome", "destination", "text_length"
    )


@query
def processed_message(spark, sf):
    refs = M.validate_refs(M.parse_file_refs(FX.file_refs(spark, sf))).where("reject IS NULL")
    texts = FX.texts(spark, sf, "pages", "page_id", "html").select(
        F.col("page_id").alias("_p"), TX.utf16_length(H.html_to_text(F.col("html"))).alias("text_length")
    )
    rows = refs.withColumn("_p", F.col("msg_id") % 1_000_000_000_000).join(texts, "_p")
    return O.processed_message(rows).select(
        "msg_id", "message", "header_original_file", "header_processed_url", "header_text_length"
    )


@query
def ledger_project(spark, sf):
    refs = M.validate_refs(M.parse_file_refs(FX.file_refs(spark, sf))).where("reject IS NULL")
    rows = L.ledger_rows(refs, processed_at=F.col("arrived_at"))
    return rows.select(
        "filename", "url_key", "file_type", "chunk_size", "chunk_count", "processed_at", "status", "input_stream", "output_stream"
    )


@query
def error_class(spark, sf):
    return FX.error_log(spark, sf).select("doc_id", S.error_class(F.col("message")).alias("error_class"))


@query
def error_counts(spark, sf):
    rows = FX.error_log(spark, sf).withColumn("error_class", S.error_class(F.col("message")))
    return O.outcome_counts(rows, "error_class")


def _latest(spark, sf):
    return L.ledger_latest(FX.ledger(spark, sf), order=("processed_at", "seq"))


@query
def ledger_latest(spark, sf):
    return _latest(spark, sf).select("filename", "seq", "status", "file_size", "processed_at")


@query
def processed_list(spark, sf):
    return L.processed_view(_latest(spark, sf)).select(
        "filename", "file_type", "file_size", "chunk_count", "processed_at", "text_length", "elapsed_ms"
    )


@query
def ledger_lookup(spark, sf):
    names = FX.table(spark, sf, "labels").select(F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".txt")).alias("filename"))
    return L.ledger_lookup(_latest(spark, sf), names).select("filename", "seq", "status")


@query
def ledger_stats(spark, sf):
    return L.ledger_stats(_latest(spark, sf), ["status", "file_type"])


@query
def stream_names(spark, sf):
    return L.stream_names(FX.ledger(spark, sf), ["processed_at", "seq"])


def _pending(spark, sf):
    files = FX.file_listing(spark, sf)
    return L.pending_files(files, files.where("doc_id % 4 <> 0"))


@query
def pending_files(spark, sf):
    return _pending(spark, sf).select("path", "filename")


@query
def pending_report(spark, sf):
    directory = F.concat(F.lit("/corpus/"), F.col("source"))
    return L.pending_items("standalone", _pending(spark, sf), directory, FX.queue_samples(spark, sf))


@query
def pending_queue(spark, sf):
    samples = FX.queue_samples(spark, sf)
    return samples.groupBy("user_id").agg(F.max_by("body", F.struct("ts", "event_id")).alias("body")).select(
        "user_id", Q.queue_depth(F.col("body")).alias("queue_depth")
    ).unionByName(L.pending_queue(samples, ("ts", "event_id")).select(F.lit(-1).cast("long").alias("user_id"), "queue_depth"))


@query
def pending_estimate(spark, sf):
    return L.pending_estimate(_pending(spark, sf), _latest(spark, sf), "path", ["modificationTime", "doc_id"])


# -- monitoring ------------------------------------------------------------


@query
def metrics_parse(spark, sf):
    parsed = MO.parse_metrics(FX.metrics_raw(spark, sf))
    return parsed.select(
        "event_id", "instanceId", "event", "status", "pendingMessages", "processingRate", "ts",
        F.col("meta.service").alias("service"), F.col("meta.bindingState").alias("bindingState"),
        F.col("meta.tags")["zone"].alias("zone"), "malformed",
    )


@query
def validate_metrics(spark, sf):
    checked = MO.validate_metrics(MO.parse_metrics(FX.metrics_raw(spark, sf)))
    return checked.select("event_id", F.array_join("violations", ",").alias("violations"))


@query
def event_search(spark, sf):
    return MO.search_events(FX.metrics_raw(spark, sf), "Failure 3").select("event_id")


@query
def metrics_json(spark, sf):
    m = FX.metrics(spark, sf).select("event_id", "instanceId", "timestamp", "event", "status", "lastError", "pendingMessages", "url")
    return MO.metrics_json(m).select("event_id", "value")


@query
def instance_registry(spark, sf):
    return MO.instance_registry(FX.metrics(spark, sf))


def _live(spark, sf):
    m = FX.metrics(spark, sf)
    as_of = m.agg(F.max("ts")).scalar()
    return MO.with_liveness(MO.instance_registry(m), as_of, ALIVE_S, DEGRADED_S, STALE_S)


@query
def liveness(spark, sf):
    return _live(spark, sf).select("service", "instanceId", "liveness", "hb_stale")


@query
def service_rollup(spark, sf):
    return MO.service_rollup(_live(spark, sf))


@query
def dashboard_counts(spark, sf):
    return MO.dashboard_counts(FX.metrics(spark, sf))


@query
def recent_events(spark, sf):
    return MO.recent_events(FX.metrics(spark, sf)).select("event_id", "ts", "instanceId", "event", "status")


@query
def instance_rates(spark, sf):
    return MO.instance_rates(FX.metrics(spark, sf))


@query
def restarts(spark, sf):
    return MO.restarts(MO.boot_epochs(FX.metrics(spark, sf).select("event_id", "service", "instanceId", "ts", "event", "version")))


@query
def init_messages(spark, sf):
    return MO.init_messages(
        MO.boot_epochs(FX.metrics(spark, sf).select("event_id", "service", "instanceId", "ts", "event", "version", "hostname"))
    )


@query
def uptime_format(spark, sf):
    m = FX.metrics(spark, sf)
    seconds = F.call_function("div", F.unix_micros("ts") - F.lit(FX.EPOCH_S * 1_000_000), F.lit(1_000_000))
    return m.select("event_id", S.uptime_text(seconds).alias("uptime"))


@query
def event_status(spark, sf):
    m = FX.metrics(spark, sf)
    i = F.col("event_id")
    enabled, running = i % 2 == 0, i % 3 != 0
    event = F.when(i % 4 == 0, F.lower("event")).otherwise(F.col("event"))
    return m.select(
        "event_id",
        S.event_status(event, enabled, running).alias("status"),
        S.event_stage(event, enabled, running).alias("stage"),
    )


@query
def consumer_status(spark, sf):
    i = F.col("event_id")
    raw = F.when(i % 7 != 0, FX.pick(
        i, "running", "Binding x: STOPPED", "running then stopped", "foo", "[state=running, group=a]", "[state=stopped]"
    ))
    ev = FX.table(spark, sf, "events").select("event_id").withColumn("raw", raw)
    return ev.select(
        "event_id",
        S.consumer_status(F.col("raw")).alias("consumer_status"),
        S.binding_status(F.lit("input-0"), F.col("raw")).alias("binding_status"),
        S.is_running(F.col("raw")).alias("running"),
    )


@query
def instance_url(spark, sf):
    m = FX.metrics(spark, sf)
    i = F.col("event_id")
    port = S.port_number(F.when(i % 3 == 0, F.lit("9090")).when(i % 3 == 1, F.lit("none")))
    return m.select(
        "event_id",
        S.instance_url(F.col("url"), F.col("publicHostname"), F.col("hostname")).alias("instance_url"),
        port.alias("port"),
        S.public_url(F.col("url"), F.col("publicHostname"), port).alias("public_url"),
    )


@query
def instance_id(spark, sf):
    ev = FX.table(spark, sf, "events").select("event_id", "user_id")
    i = F.col("event_id")
    return ev.select(
        "event_id",
        S.instance_id(
            F.when(i % 5 == 0, F.lit("fixed")).when(i % 5 == 1, F.lit(" ")),
            F.lit("app"),
            F.when(i % 3 == 0, F.col("user_id").cast("string")),
            F.when(i % 4 != 0, i),
            F.lit("host-1"),
        ).alias("instance_id"),
    )


@query
def metrics_snapshot(spark, sf):
    m = FX.metrics(spark, sf)
    control = K.control_state(K.control_replay(FX.control_log(spark, sf)))
    return MO.snapshot(m, control, m.agg(F.max("ts")).scalar())


@query
def health_report(spark, sf):
    control = K.control_state(K.control_replay(FX.control_log(spark, sf)))
    return MO.health_report(FX.metrics(spark, sf), control)


@query
def status_mapping(spark, sf):
    m = FX.metrics(spark, sf).select("event_id", "service", "instanceId", "ts", "event", "status", "hdfsProcessedDirExists")
    return MO.status_mapping(m, F.col("hdfsProcessedDirExists"), 6 * 3600).select("event_id", "mapped_status")


@query
def error_tracking(spark, sf):
    m = FX.metrics(spark, sf).select("event_id", "service", "instanceId", "ts", "event", "lastError")
    return MO.error_tracking(m).select("event_id", "errorCount", "lastError")


@query
def heartbeat_windows(spark, sf):
    return MO.heartbeat_windows(FX.metrics(spark, sf), "1 hour")


@query
def missed_heartbeats(spark, sf):
    return MO.missed_heartbeats(FX.metrics(spark, sf), 4 * 3600).select(
        "instanceId", "event_id", "ts", "previous_ts", "missed"
    )


# -- control log -----------------------------------------------------------


@query
def control_replay(spark, sf):
    return K.control_replay(FX.control_log(spark, sf))


@query
def control_state(spark, sf):
    return K.control_state(K.control_replay(FX.control_log(spark, sf)))


@query
def control_response(spark, sf):
    return K.control_response(K.control_replay(FX.control_log(spark, sf)))


@query
def backlog_consume(spark, sf):
    replay = staged(K.control_replay(FX.control_log(spark, sf)), "replay")
    return K.consume_backlog(FX.arrivals(spark, sf), replay)


@query
def queue_depth_series(spark, sf):
    replay = staged(K.control_replay(FX.control_log(spark, sf)), "replay")
    return K.queue_depth_series(staged(K.consume_backlog(FX.arrivals(spark, sf), replay), "consumed"))
