"""Schemas shared by sources, operators and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)

FILE_REF = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("inputStream", T.StringType()),
        T.StructField("outputStream", T.StringType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("filename", T.StringType()),
        T.StructField("url_key", T.StringType()),
        T.StructField("file_type", T.StringType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("chunk_size", T.IntegerType()),
        T.StructField("chunk_count", T.IntegerType()),
        T.StructField("processed_at", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("input_stream", T.StringType()),
        T.StructField("output_stream", T.StringType()),
        T.StructField("text_length", T.LongType()),
        T.StructField("elapsed_ms", T.LongType()),
    ]
)

META = T.StructType(
    [
        T.StructField("service", T.StringType()),
        T.StructField("bindingState", T.StringType()),
        T.StructField("hdfsProcessedDirExists", T.BooleanType()),
        T.StructField("inputMode", T.StringType()),
        T.StructField("processingStage", T.StringType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("instanceId", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("totalChunks", T.LongType()),
        T.StructField("processedChunks", T.LongType()),
        T.StructField("errorCount", T.LongType()),
        T.StructField("processingRate", T.DoubleType()),
        T.StructField("uptime", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("currentFile", T.StringType()),
        T.StructField("filesProcessed", T.LongType()),
        T.StructField("filesTotal", T.LongType()),
        T.StructField("lastError", T.StringType()),
        T.StructField("memoryUsedMB", T.LongType()),
        T.StructField("pendingMessages", T.LongType()),
        T.StructField("hostname", T.StringType()),
        T.StructField("publicHostname", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("internalUrl", T.StringType()),
        T.StructField("publicUrl", T.StringType()),
        T.StructField("port", T.IntegerType()),
        T.StructField("bootEpoch", T.LongType()),
        T.StructField("version", T.StringType()),
        T.StructField("meta", META),
    ]
)

CONTROL_LOG = T.StructType(
    [
        T.StructField("cmd_id", T.LongType()),
        T.StructField("instance_id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("cmd", T.StringType()),
    ]
)

OUTCOMES = T.StructType(
    [
        T.StructField("msg_id", T.LongType()),
        T.StructField("arrived_at", T.TimestampType()),
        T.StructField("url", T.StringType()),
        T.StructField("inputStream", T.StringType()),
        T.StructField("outputStream", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("url_key", T.StringType()),
        T.StructField("dedupe", T.StringType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("mime", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("text_length", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)

CHUNKS = T.StructType(
    [
        T.StructField("url_key", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("chunk_no", T.IntegerType()),
        T.StructField("n_chunks", T.IntegerType()),
        T.StructField("text", T.StringType()),
        T.StructField("overflow", T.BooleanType()),
    ]
)

TEXTS = T.StructType(OUTCOMES.fields + [T.StructField("pages", T.ArrayType(T.StringType()))])
