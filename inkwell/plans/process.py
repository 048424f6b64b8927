"""The document job: references in, one settled outcome row per message out."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from inkwell.functions import mime as MT, text as TX, urls as U
from inkwell.operators import chunks as C, extract as X, outcomes as O, refs as R, splits as SP
from inkwell.session import shared_dir
from inkwell.sources import files as FS, messages as M

RESULT = [
    "msg_id", "arrived_at", "type", "url", "inputStream", "outputStream", "filename", "url_key",
    "dedupe", "outcome", "mime", "length", "text_length", "pages", "error_message",
]


Stage = Callable[[DataFrame, str], DataFrame]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and continue from there.

    Several consumers then read one written result instead of repeating the work, a
    lost executor costs a re-read only, and the next joins are planned with the true
    size of the table.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def flag_messages(messages: DataFrame, done: R.Done | None = None) -> DataFrame:
    return R.dedupe_refs(M.validate_refs(M.parse_file_refs(messages)), done)


Fetch = Callable[[DataFrame], DataFrame]


def from_table(files: DataFrame) -> Fetch:
    """Fetch by joining with a table or scan of files."""
    return lambda refs: FS.attach_content(refs, files)


def extract_first(flagged: DataFrame, fetch: Fetch, **kwargs) -> DataFrame:
    """Fetch and extract the first copy of every new reference."""
    firsts = flagged.where(F.col("dedupe") == "FIRST")
    fetched = fetch(firsts)
    if "fetch_error" not in fetched.columns:
        fetched = fetched.withColumn("fetch_error", F.when(~F.col("fetched"), F.lit("NOT_FOUND")))
    texts = X.extract_text(fetched, **kwargs)
    outcome = O.outcome_of(
        F.col("reject"), F.col("dedupe"), F.col("fetched"), F.col("failure"), F.col("text"), fetch_error=F.col("fetch_error")
    )
    return (
        texts.withColumn("outcome", outcome)
        .withColumn("error_message", F.coalesce("error_message", F.when(F.col("outcome") == "READ_ERROR", F.col("fetch_error"))))
        .withColumns(
            {
                # the joined text is derived from the pages, so only the pages are kept
                "pages": F.when(F.col("outcome") == "COMPLETED", F.col("pages")),
                "text_length": F.when(F.col("outcome") == "COMPLETED", TX.utf16_length(F.col("text"))),
            }
        )
        .select(*RESULT)
    )


def chunk_references(flagged: DataFrame, fetch: Fetch, params: C.ChunkParams, keep: list[str], **kwargs) -> DataFrame:
    """Fetch, extract and chunk the first copy of every reference in one pass over the bytes."""
    pages = X.extract_text(fetch(flagged.where(F.col("dedupe") == "FIRST")), **kwargs)
    return C.chunk_text(pages, "pages", params, keep)


def chunk_large_references(fetched: DataFrame, params: C.ChunkParams, keep: list[str], base_uri: str = "file://",
                           stage: Stage = staged, split_bytes: int = SP.SPLIT_BYTES) -> DataFrame:
    """The chunks that :func:`chunk_references` cannot give: plain text files too large for a row.

    ``fetched`` are references as ``fetch_content`` returns them. Of those that are TOO_LARGE
    the plain types, by their name, are read by byte ranges, with the same result columns.
    Several references to one file get its chunks each.
    """
    plain = MT.mime_from_name(F.col("filename")).isin(*MT.PLAIN_TYPES)
    base = base_uri if base_uri.endswith("://") else base_uri.rstrip("/")
    path = F.concat(F.lit(base), U.storage_path(F.col("url"))).alias("_path")
    large = stage(fetched.where(F.col("fetch_error") == "TOO_LARGE").where(plain).select(*keep, path, "length"), "large-refs")
    chunks = SP.chunk_files(large.select(F.col("_path").alias("path"), "length"), params, stage, split_bytes)
    rows = chunks.withColumnRenamed("path", "_path").join(large.drop("length"), "_path")
    numbers = [F.col(c).cast("int").alias(c) for c in ("chunk_no", "n_chunks")]
    return rows.select(*keep, F.lit(1).alias("page_no"), *numbers, "text", F.lit(False).alias("overflow"))


def with_text(rows: DataFrame) -> DataFrame:
    """Add the joined text of completed rows."""
    return rows.withColumn("text", F.when(F.col("pages").isNotNull(), TX.join_pages(F.col("pages"))))


def process_refs(messages: DataFrame, fetch: Fetch, done: R.Done | None = None,
                 stage: Stage = staged, **kwargs) -> DataFrame:
    """One row per message with its outcome and, when completed, its pages of text.

    Duplicates are removed before any bytes are fetched. Text moves through no
    shuffle after extraction: first copies, further copies and rejected messages are
    computed apart and united. Two results are staged because several of these parts
    need them: the flagged messages (small) and the extracted first copies.
    """
    flagged = stage(flag_messages(messages, done), "refs")
    first = stage(extract_first(flagged, fetch, **kwargs), "texts")
    copies = O.settle_copies(flagged.where(F.col("dedupe") == "DUPLICATE"), first)
    rejected = flagged.where(F.col("dedupe") == "REJECTED").withColumn("outcome", F.col("reject"))
    types = {f.name: f.dataType for f in first.schema.fields}

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(types[c]).alias(c) for c in RESULT])

    return first.unionByName(shaped(copies)).unionByName(shaped(rejected))


def process_directory(files: DataFrame, done_paths: DataFrame | None = None, **kwargs) -> DataFrame:
    """Directory batch: every file not yet in the ledger, filed as processed or error."""
    todo = files if done_paths is None else files.join(done_paths.select("path"), "path", "left_anti")
    named = todo.withColumn("filename", F.substring_index("path", "/", -1))
    texts = X.extract_text(named, **kwargs)
    outcome = O.outcome_of(
        F.lit(None).cast("string"), F.lit("FIRST"), F.col("content").isNotNull(), F.col("failure"), F.col("text"),
        unicode_blank=True, fetch_error=F.when(F.col("length") > FS.MAX_FILE_BYTES, F.lit("TOO_LARGE")),
    )
    return (
        texts.withColumn("outcome", outcome)
        .withColumn("destination", O.route(F.col("outcome")))
        .withColumn("text", F.when(F.col("outcome") == "COMPLETED", F.col("text")))
        .withColumn("text_length", TX.utf16_length(F.col("text")))
        .select("path", "filename", "mime", "length", "outcome", "destination", "text_length", "text", "error_message")
    )
