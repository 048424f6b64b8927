"""Document files as DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from inkwell import schemas
from inkwell.functions import urls as U
from inkwell.sources.fetch import BATCH_BYTES
from inkwell.sources.listing import Store, list_files, opened_by_tasks

# binaryFile holds one file per row and a row's bytes end at this size
MAX_FILE_BYTES = 2**31 - 1
FILES_PER_TASK = 5_000


def scan_files(spark: SparkSession, directory: str, recursive: bool = False, glob: str | None = None,
               metadata_only: bool = False) -> DataFrame:
    """Regular files of a directory: path, modificationTime, length and content.

    ``metadata_only`` leaves ``content`` out, so no file is opened. Files above the
    binary row limit keep their row, with NULL content.

    Files are listed by tasks when this is called and opened by tasks when ``content`` is asked
    for, so the driver's memory does not depend on their number. Where Arrow does not
    open the store, Spark's reader does both: it lists on the driver and leaves empty files out.
    """
    served = opened_by_tasks(spark, directory)
    if served is None:
        return _read_files(spark, directory, recursive, glob, metadata_only)
    store, roots, shared = served
    listing, number, size = list_files(spark, store, roots, shared, recursive, glob, MAX_FILE_BYTES)
    columns = ["path", F.timestamp_millis("modified").alias("modificationTime"), "length"]
    if metadata_only:
        return listing.select(*columns)
    most = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    cores = spark.sparkContext.defaultParallelism
    parts = max(1, -(-size // most), -(-number // FILES_PER_TASK), min(cores, number // 32))
    # names are dealt out, not bytes; content is a column of its own, read only for the rows and queries that ask for it
    return listing.repartition(parts).select(*columns, _content(spark, store)(F.col("path"), F.col("length")).alias("content"))


def _content(spark: SparkSession, store: Store) -> Callable[[Column, Column], Column]:
    """The function from path and length of a file to its bytes, NULL above the row limit."""
    large = spark.conf.get("spark.sql.execution.arrow.useLargeVarTypes", "false") == "true"
    held_most, row_most, opened = BATCH_BYTES, MAX_FILE_BYTES, store.opener()

    @F.arrow_udf(T.BinaryType())
    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        filesystem, own = opened()
        kind = pa.large_binary() if large else pa.binary()
        for paths, lengths in batches:
            contents, held = [], 0
            for path, length in zip(paths.to_pylist(), lengths.to_pylist()):
                data = None
                if length <= row_most:
                    if held and held + length > held_most:  # before the file, so offsets of a batch stay small
                        yield pa.array(contents, kind)
                        contents, held = [], 0
                    with filesystem.open_input_file(own(path)) as f:
                        data = f.read()
                    held += len(data)
                contents.append(data)
            yield pa.array(contents, kind)

    return read


def _read_files(spark: SparkSession, directory: str, recursive: bool, glob: str | None, metadata_only: bool) -> DataFrame:
    """The scan by Spark's reader, for any store that it knows."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(directory)
    if metadata_only:
        return files.select("path", "modificationTime", "length")
    # by the size in the listing: files of the other part get no task; the plain filter is pushed into the scan
    listed = F.col("_metadata.file_size")
    large = files.where(listed > MAX_FILE_BYTES).select("path", "modificationTime", "length", F.lit(None).cast("binary").alias("content"))
    return files.where((listed <= MAX_FILE_BYTES) & (F.col("length") <= MAX_FILE_BYTES)).unionByName(large)


def oversized_files(spark: SparkSession, directory: str, recursive: bool = False) -> DataFrame:
    """The files that are not read."""
    return scan_files(spark, directory, recursive, metadata_only=True).where(F.col("length") > MAX_FILE_BYTES)


def stream_files(spark: SparkSession, directory: str, archive_dir: str | None = None,
                 max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """The same scan as a stream; handled inputs can be moved to ``archive_dir``.

    Archiving happens when a later batch commits, so the last files stay in place
    until new ones arrive.
    """
    reader = spark.readStream.format("binaryFile").schema(schemas.FILES)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(directory)


def bare_path(path: Column) -> Column:
    """Path without scheme and host: ``file:///p``, ``file:/p`` and ``hdfs://host/p`` give ``/p``."""
    return F.regexp_replace(path, r"\A[a-z0-9]+:(//[^/]*)?", "")


def attach_content(refs: DataFrame, files: DataFrame) -> DataFrame:
    """Join references with the bytes they point to, on the storage path.

    ``refs`` must already be deduplicated, so no bytes are fetched for duplicates.
    ``fetched`` tells found files from missing ones. Found files come from an inner
    join: when ``refs`` is a written table small enough to broadcast, the bytes stay
    where they were read, whereas an outer join could only move the bytes to the
    references. Missing ones are settled on paths alone, without reading content.
    """
    wanted = refs.withColumn("fetch_path", bare_path(U.storage_path(F.col("url"))))
    path = bare_path(F.col("path")).alias("fetch_path")
    found = files.select(path, "length", "content").join(wanted, "fetch_path")
    missing = wanted.join(files.select(path), "fetch_path", "left_anti")
    columns = [*refs.columns, "fetch_path"]
    return found.select(*columns, "length", "content", F.lit(True).alias("fetched")).unionByName(
        missing.select(
            *columns,
            F.lit(None).cast("long").alias("length"),
            F.lit(None).cast("binary").alias("content"),
            F.lit(False).alias("fetched"),
        )
    )
