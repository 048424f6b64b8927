"""Helpers the training-data operators share."""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from inkwell.session import shared_dir

BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20
WORD = re.compile(r"\w+")
SHINGLE = 5
ODD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Long texts: at most so many rows and bytes per Arrow batch, so a worker's memory stays bounded."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder; it is only named here, Spark makes it."""
    return f"{shared_dir(spark).rstrip('/')}/inkwell-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write as a table in the shared folder and read it back."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(column: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(column.cast("string").cast("binary")) % n


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (xor-shift and multiply, invertible)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class WordHashes(dict):
    """word -> 64-bit hash, the same in every process; forgets all when it has grown large."""

    LIMIT = 500_000

    def __missing__(self, word: str) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= self.LIMIT:
            self.clear()
        value = xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(word) <= 64:
            self[word] = value
        return value


_HASHES = WordHashes()


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased words of a text, in order."""
    words = WORD.findall((text or "").lower())
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of each run of ``size`` words; a shorter text has one shingle of all its words."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    size = min(size, n)
    with np.errstate(over="ignore"):
        out = mix(words[: n - size + 1])
        for i in range(1, size):
            out = mix(out * ODD + words[i : n - size + 1 + i])
    return out


def texts_of(column: pa.Array) -> list[str]:
    """Null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def table_columns(schema: str) -> list[str]:
    """Names of a schema written as "name type, name type"."""
    return [x.split()[0] for x in schema.split(",")]


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the input does not use yet (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name
