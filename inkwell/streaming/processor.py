"""The document job on a stream: every micro-batch runs the batch job and commits its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from inkwell import schemas
from inkwell.functions import urls as U
from inkwell.operators import chunks as C, ledger as L, outcomes as O
from inkwell.plans.process import Fetch, process_refs, with_text
from inkwell.sinks import exports as EX
from inkwell.sinks.tables import BatchTable, LedgerTable

Sink = Callable[[DataFrame, int], None]


class DocumentStream:
    """Micro-batch processor with its output tables below ``root``.

    Tables: ``inbox`` (messages with the ids given to them), ``refs``, ``texts``, ``chunks``,
    ``outcomes``, ``messages`` and ``ledger``. The ledger is written last: a batch that
    fails before that point counts as not done and its messages are processed again
    when the batch is replayed from the checkpoint, overwriting the other tables.
    """

    def __init__(self, spark: SparkSession, root: str, fetch: Fetch, chunk_params: C.ChunkParams | None = None,
                 message_sink: Sink | None = None, **extract_options):
        self.spark, self.root, self.fetch = spark, root.rstrip("/"), fetch
        self.chunk_params = chunk_params or C.params_for(L.CHUNK_SIZE)
        self.message_sink = message_sink
        self.extract_options = extract_options
        self.ledger = LedgerTable(spark, f"{self.root}/ledger")

    def table(self, name: str) -> BatchTable:
        return BatchTable(self.spark, f"{self.root}/{name}")

    def inbox(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Messages with an id and an arrival time, fixed by writing them once."""
        given = set(batch.columns)
        ids = F.col("msg_id") if "msg_id" in given else (
            F.lit(batch_id).cast("long") * F.lit(1 << 40) + F.monotonically_increasing_id()
        )
        at = F.col("arrived_at") if "arrived_at" in given else F.current_timestamp()
        rows = batch.select(ids.cast("long").alias("msg_id"), at.cast("timestamp").alias("arrived_at"),
                            F.col("value").cast("string").alias("value"))
        return self.table("inbox").write(rows, batch_id)

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` function; also callable with a plain DataFrame."""
        messages = self.inbox(batch, batch_id)
        done = lambda keys: self.ledger.done(keys, before=batch_id)
        rows = process_refs(
            messages, self.fetch, done, stage=lambda df, name: self.table(name).write(df, batch_id), **self.extract_options
        )
        outcomes = self.table("outcomes").write(
            rows.select(
                "msg_id", "arrived_at", "url", "inputStream", "outputStream", "filename", "url_key", "dedupe",
                "outcome", "mime", "length", "text_length", "error_message",
            ),
            batch_id,
        )
        written = self.spark.read.schema(rows.schema).parquet(self.table("texts").batch_path(batch_id))
        completed = written.where("outcome = 'COMPLETED'")
        chunked = self.table("chunks").write(
            C.chunk_text(completed, "pages", self.chunk_params, ["url_key", "filename"]), batch_id
        )
        outgoing = O.processed_message(completed).select(
            "msg_id", "message", "header_original_file", "header_processed_url", "header_text_length"
        )
        if self.message_sink:
            self.message_sink(outgoing, batch_id)
        else:
            self.table("messages").write(outgoing, batch_id)
        self.ledger.write(self._ledger_rows(outcomes, chunked), batch_id)

    def _ledger_rows(self, outcomes: DataFrame, chunked: DataFrame) -> DataFrame:
        """Terminal outcomes of accepted references; duplicates are in the ledger already.

        ``processed_at`` is the time of this write, so a marker set after it asks for
        another run and one set before it does not; ``elapsed_ms`` counts from arrival.
        """
        per_url = chunked.groupBy("url_key").agg(F.count(F.lit(1)).alias("_chunks"))
        settled = outcomes.where(F.col("dedupe") == "FIRST").join(per_url, "url_key", "left")
        waited = F.unix_millis(F.current_timestamp()) - F.unix_millis("arrived_at")
        return L.ledger_rows(
            settled.withColumn("elapsed_ms", F.greatest(waited, F.lit(0))), status=F.col("outcome"), processed_at=F.localtimestamp(),
            chunk_count=F.coalesce("_chunks", F.lit(0)),
        )

    def start(self, messages: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Run on a streaming DataFrame with a ``value`` column."""
        return (
            messages.writeStream.foreachBatch(self.process_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"}))
            .start()
        )

    def _committed(self, name: str, schema) -> DataFrame:
        """Rows with their batch number; a batch counts when its ledger rows are there."""
        return self.table(name).read(schema, before=self.ledger.next_batch(), with_batch=True)

    def outcomes(self) -> DataFrame:
        return self._committed("outcomes", schemas.OUTCOMES).drop("batch_id")

    def _current(self) -> DataFrame:
        """(batch_id, url_key) of the text that each output path holds: a later one overwrites it."""
        done = self._committed("texts", schemas.TEXTS).where("outcome = 'COMPLETED'")
        paths = done.select("batch_id", "url_key", "arrived_at", "msg_id", U.output_path(F.col("url"), F.col("filename")).alias("output_path"))
        return EX.last_write_per_path(paths, order=("batch_id", "arrived_at", "msg_id", "url_key")).select("batch_id", "url_key")

    def texts(self) -> DataFrame:
        """Completed documents with their joined text, one per output path."""
        done = self._committed("texts", schemas.TEXTS).where("outcome = 'COMPLETED'").join(self._current(), ["batch_id", "url_key"], "left_semi")
        return with_text(done).withColumn("output_path", U.output_path(F.col("url"), F.col("filename"))).drop("batch_id")

    def chunks(self) -> DataFrame:
        """Chunks of the same documents."""
        return self._committed("chunks", schemas.CHUNKS).join(self._current(), ["batch_id", "url_key"], "left_semi").drop("batch_id")

    def processed(self) -> DataFrame:
        """Latest completed ledger row per file name."""
        return L.processed_view(L.ledger_latest(self.ledger.read(), order=("processed_at", "url_key")))

    def backlog(self, seen: DataFrame) -> DataFrame:
        """Referenced URL keys that have no terminal outcome yet."""
        return seen.join(self.ledger.read().select("url_key"), "url_key", "left_anti")


def source_backlog(query: StreamingQuery) -> dict:
    """Input rows of the last batch and the source's own offset metrics, if any batch ran."""
    last = query.lastProgress
    if not last:
        return {"status": "unavailable", "queueDepth": -1}
    sources = last["sources"]
    return {
        "status": "ok",
        "inputRows": last["numInputRows"],
        "sources": [{"description": s["description"], "metrics": s.get("metrics") or {}} for s in sources],
    }
