"""Bytes of referenced files, opened on the executors that need them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from inkwell.functions import urls as U

BATCH_BYTES = 64 * 1024 * 1024


def fetch_content(refs: DataFrame, base_uri: str = "file://", max_bytes: int = 2**31 - 1) -> DataFrame:
    """Add ``length``, ``content``, ``fetched`` and ``fetch_error`` to deduplicated references.

    Only referenced files are opened, each by the task holding its row, whereas a
    directory scan would read every file. Use ``sources.files.attach_content`` when
    most of a directory is wanted. ``base_uri`` names the file system that serves the
    storage paths (``hdfs://namenode:8020``, ``s3://bucket``, ``file://``).

    ``fetch_error`` is NOT_FOUND (also for undecodable paths and folders), TOO_LARGE or the
    text of a refused read. Any other storage failure fails the task, so the batch is
    replayed instead of filing its messages as errors.
    """
    added = [
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("fetch_error", T.StringType()),
    ]
    source = refs.withColumn("_path", U.storage_path(F.col("url")))
    schema = T.StructType(refs.schema.fields + added)
    columns = refs.columns
    large = refs.sparkSession.conf.get("spark.sql.execution.arrow.useLargeVarTypes", "false") == "true"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        kind = pa.large_binary() if large else pa.binary()
        filesystem, prefix = fs.FileSystem.from_uri(base_uri.rstrip("/") + "/")
        prefix = prefix.rstrip("/")

        def emit(batch, start, stop, lengths, contents, errors):
            part = batch.slice(start, stop - start).select(columns)
            arrays = [*part.columns, pa.array(lengths, pa.int64()), pa.array(contents, kind), pa.array(errors, pa.string())]
            return pa.RecordBatch.from_arrays(arrays, names=[*columns, "length", "content", "fetch_error"])

        for batch in batches:
            start, held = 0, 0
            lengths, contents, errors = [], [], []
            for i, path in enumerate(batch.column("_path").to_pylist()):
                size, data, error = None, None, None
                try:
                    info = filesystem.get_file_info(prefix + path) if path is not None else None
                    size = info.size if info is not None else None
                    if size is None:
                        error = "NOT_FOUND"
                    elif size > max_bytes:
                        error = "TOO_LARGE"
                    else:
                        if held and held + size > BATCH_BYTES:  # before the file, so offsets of a batch stay small
                            yield emit(batch, start, i, lengths, contents, errors)
                            start, held = i, 0
                            lengths, contents, errors = [], [], []
                        with filesystem.open_input_file(prefix + path) as f:
                            data = f.read()
                except FileNotFoundError:
                    error = "NOT_FOUND"
                except PermissionError as e:  # an outcome of its row
                    error = f"{type(e).__name__}: {e}"
                lengths.append(size)
                contents.append(data)
                errors.append(error)
                held += len(data or b"")
                if held >= BATCH_BYTES:
                    yield emit(batch, start, i + 1, lengths, contents, errors)
                    start, held = i + 1, 0
                    lengths, contents, errors = [], [], []
            if start < batch.num_rows:
                yield emit(batch, start, batch.num_rows, lengths, contents, errors)

    return source.mapInArrow(read, schema).withColumn("fetched", F.col("content").isNotNull())
