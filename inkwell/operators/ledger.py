"""The processed-file ledger: latest rows, lookups, statistics, pending work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from inkwell import schemas
from inkwell.functions import mime as MT, urls as U
from inkwell.sources.queues import queue_report

CHUNK_SIZE = 262144
DEFAULT_INPUT = "default-input"
DEFAULT_OUTPUT = "default-output"


def ledger_rows(done: DataFrame, status: Column | None = None, processed_at: Column | None = None,
                chunk_count: Column | None = None) -> DataFrame:
    """Ledger projection of handled references; whole documents count as one chunk."""
    has = set(done.columns)

    def col(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in has else F.lit(None).cast(kind)

    return done.select(
        "filename",
        "url_key",
        (F.col("mime") if "mime" in has else MT.mime_from_name(F.col("filename"))).alias("file_type"),
        col("length", "long").alias("file_size"),
        F.lit(CHUNK_SIZE).alias("chunk_size"),
        (F.lit(1) if chunk_count is None else chunk_count).cast("int").alias("chunk_count"),
        (F.localtimestamp() if processed_at is None else processed_at).cast("timestamp_ntz").alias("processed_at"),
        (F.lit("COMPLETED") if status is None else status).alias("status"),
        F.coalesce("inputStream", F.lit(DEFAULT_INPUT)).alias("input_stream"),
        F.coalesce("outputStream", F.lit(DEFAULT_OUTPUT)).alias("output_stream"),
        col("text_length", "long").alias("text_length"),
        col("elapsed_ms", "long").alias("elapsed_ms"),
    )


def ledger_latest(ledger: DataFrame, key: str = "filename", order: tuple[str, ...] = ("processed_at",)) -> DataFrame:
    """Last write per key; rows without a key are ignored.

    ``row_number = 1`` lets the optimizer keep one row per key already in each input
    partition, so a file rewritten very often does not pile up in one task.
    """
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return (
        ledger.where(F.col(key).isNotNull()).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    )


def ledger_lookup(latest: DataFrame, names: DataFrame) -> DataFrame:
    """Ledger rows of the given file names; unknown and NULL names give nothing."""
    return latest.join(names.where(F.col("filename").isNotNull()).distinct(), "filename", "left_semi")


def processed_view(latest: DataFrame) -> DataFrame:
    """The list of processed files: completed rows only."""
    return latest.where(F.col("status") == "COMPLETED")


def ledger_stats(latest: DataFrame, by: list[str]) -> DataFrame:
    """Counts and sizes of the latest rows, grouped by status, file type or the like."""
    return latest.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("file_size").alias("bytes"),
        F.sum("text_length").alias("chars"),
        F.max("text_length").alias("max_chars"),
        F.avg("text_length").alias("avg_chars"),
        F.sum("chunk_count").cast("long").alias("chunks"),
        F.sum("elapsed_ms").alias("elapsed_ms"),
    )


def stream_names(ledger: DataFrame, order: list[str]) -> DataFrame:
    """Latest non-NULL input and output stream names, with the startup defaults."""
    seq = F.struct(*order)

    def last(name: str) -> Column:
        return F.max_by(name, F.when(F.col(name).isNotNull(), seq))

    return ledger.agg(
        F.coalesce(last("input_stream"), F.lit(DEFAULT_INPUT)).alias("input_stream"),
        F.coalesce(last("output_stream"), F.lit(DEFAULT_OUTPUT)).alias("output_stream"),
    )


def pending_files(files: DataFrame, ledger: DataFrame, key: str = "path") -> DataFrame:
    """Scanned files without a ledger row."""
    return files.join(ledger.select(key), key, "left_anti")


def pending_report(pending: DataFrame, directory: Column) -> DataFrame:
    """Pending count per directory.

    The names stay a distributed table (:func:`pending_files`): one array of all of
    them would have to fit a single task.
    """
    return pending.groupBy(directory.alias("directory")).agg(F.count(F.lit(1)).alias("count")).select(
        F.lit("standalone").alias("mode"), "directory", "count"
    )


def pending_queue(samples: DataFrame, order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Queue depth by the latest management snapshot; -1 and a reason without one."""
    latest = samples.agg(F.max_by("body", F.struct(*order)).alias("body"))
    report = queue_report(latest)
    return report.select(
        F.lit("scdf").alias("mode"),
        F.col("queue_depth"),
        "status",
        F.when(F.col("status") == "unavailable", F.lit("no queue snapshot"))
        .when(F.col("status") == "error", F.lit("no message count in the snapshot")).alias("reason"),
    )


def pending_items(mode: str, pending: DataFrame, directory: Column, samples: DataFrame) -> DataFrame:
    """The pending report of a mode; an unknown one is answered as unsupported."""
    if mode.lower() == "standalone":
        return pending_report(pending, directory)
    if mode.lower() == "scdf":
        return pending_queue(samples)
    return pending.sparkSession.range(1).select(F.lit(mode).alias("mode"), F.lit("unsupported").alias("status"))


def pending_estimate(pending: DataFrame, latest: DataFrame, url: str, order: list[str]) -> DataFrame:
    """Pending count, expected seconds at the average pace so far, next file in line."""
    queue = pending.agg(
        F.count(F.lit(1)).alias("pending_count"),
        F.min(F.struct(*order, url))[url].alias("next_url"),
    )
    pace = processed_view(latest).agg(F.avg("elapsed_ms").alias("_ms"))
    # both sides are one-row aggregates
    return queue.select(
        "pending_count",
        F.ceil(F.col("pending_count") * F.coalesce(pace.scalar(), F.lit(0.0)) / 1000.0).cast("long").alias("estimated_seconds"),
        "next_url",
    )


def path_collisions(rows: DataFrame, path: str = "output_path", url: str = "url") -> DataFrame:
    """Output paths that more than one URL would write."""
    return (
        rows.groupBy(path)
        .agg(F.countDistinct(url).alias("n_urls"), F.min(url).alias("first_url"), F.max(url).alias("last_url"))
        .where("n_urls > 1")
    )


def reprocess_markers(urls: DataFrame, at: Column, url: str = "url") -> DataFrame:
    """Ledger markers that let the given URLs be processed again."""
    given = {
        "filename": U.stream_filename(F.col(url)),
        "url_key": U.file_key(F.col(url)),
        "processed_at": at,
        "status": F.lit("REPROCESS"),
    }
    return urls.select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.LEDGER.fields]
    )
