"""Output tables of the document job, written so that a replayed batch changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from inkwell import schemas
from inkwell.operators.refs import done_keys, marker_stamps

BATCH_ID = StructField("batch_id", LongType())


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def ensure_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.mkdirs(p)


def delete_dir(spark: SparkSession, path: str) -> bool:
    """True if the folder existed and is gone."""
    fs, p = _fs(spark, path)
    return fs.delete(p, True) if fs.exists(p) else False


def sub_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


class BatchTable:
    """A Parquet folder with one sub-folder per micro-batch.

    Writing a batch replaces its own sub-folder only, so a batch that is replayed
    after a failure overwrites what its first attempt left behind.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def batch_path(self, batch_id: int) -> str:
        return f"{self.path}/batch_id={batch_id}"

    def write(self, df: DataFrame, batch_id: int) -> DataFrame:
        """Write one batch and return it as read back from storage."""
        df.write.mode("overwrite").parquet(self.batch_path(batch_id))
        return self.spark.read.schema(df.schema).parquet(self.batch_path(batch_id))

    def read(self, schema: StructType, before: int | None = None, with_batch: bool = False) -> DataFrame:
        """All batches, or those before the given one; ``with_batch`` keeps their number."""
        full = StructType([*schema.fields, BATCH_ID])
        if not sub_dirs(self.spark, self.path):
            return self.spark.createDataFrame([], full if with_batch else schema)
        df = self.spark.read.schema(full).option("basePath", self.path).parquet(self.path)
        if before is not None:
            df = df.where(F.col("batch_id") < before)  # partition filter
        return df if with_batch else df.select(*schema.fieldNames())


class LedgerTable:
    """Ledger batches, compacted snapshots of everything up to some batch, and an index of the keys."""

    def __init__(self, spark: SparkSession, path: str):
        from inkwell.sinks.index import KeyIndex

        self.spark, self.path = spark, path.rstrip("/")
        self.batches = BatchTable(spark, f"{self.path}/batches")
        self.index = KeyIndex(spark, f"{self.path}/index")

    def write(self, df: DataFrame, batch_id: int) -> None:
        """The index first: a batch counts when its ledger rows are there."""
        names = schemas.LEDGER.fieldNames()
        rows = df.select(*[F.col(n).cast(schemas.LEDGER[n].dataType) for n in names])
        fixed = BatchTable(self.spark, f"{self.path}/pending").write(rows, batch_id)
        self.index.add(marker_stamps(fixed), batch_id)
        self.batches.write(fixed, batch_id)
        delete_dir(self.spark, f"{self.path}/pending")

    def done(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """Those of the keys that count as handled, from the index; batches it lacks are read."""
        stamps = self.index.lookup(keys, before)
        known = self.index.covered(before)
        batches = [int(d.split("=")[1]) for d in sub_dirs(self.spark, self.batches.path)]
        lacking = [b for b in batches if b not in known and (before is None or b < before)]
        if lacking:
            rows = self.batches.read(schemas.LEDGER, before, with_batch=True).where(F.col("batch_id").isin(lacking))
            stamps = stamps.unionByName(marker_stamps(rows.join(keys.select("url_key").distinct(), "url_key", "left_semi")))
        return done_keys(stamps)

    def next_batch(self) -> int:
        """The first batch that is not committed: batches run in order and the ledger is written last."""
        done = [
            int(d.split("=")[1])
            for d in sub_dirs(self.spark, self.batches.path)
            if path_exists(self.spark, f"{self.batches.path}/{d}/_SUCCESS")
        ]
        snapshot = self._snapshot(None)
        return max([*done, -1 if snapshot is None else snapshot], default=-1) + 1

    def _snapshot(self, before: int | None) -> int | None:
        done = [
            int(d.split("=")[1])
            for d in sub_dirs(self.spark, f"{self.path}/compact")
            if path_exists(self.spark, f"{self.path}/compact/{d}/_SUCCESS")
        ]
        usable = [u for u in done if before is None or u < before]
        return max(usable) if usable else None

    def read(self, before: int | None = None) -> DataFrame:
        base = self._snapshot(before)
        if base is None:
            return self.batches.read(schemas.LEDGER, before)
        snapshot = self.spark.read.schema(schemas.LEDGER).parquet(f"{self.path}/compact/upto={base}")
        full = StructType([*schemas.LEDGER.fields, BATCH_ID])
        newer = self.spark.read.schema(full).option("basePath", self.batches.path).parquet(self.batches.path)
        newer = newer.where(F.col("batch_id") > base)
        if before is not None:
            newer = newer.where(F.col("batch_id") < before)
        return snapshot.unionByName(newer.select(*snapshot.columns))

    def compact(self, upto: int, files: int | None = None) -> None:
        """Fold all batches up to ``upto`` into one snapshot sorted by key.

        Readers switch when the snapshot's success marker appears; until then, and
        after a crash, they keep using the batches.
        """
        rows = self.read(before=upto + 1)
        parts = rows.repartition(files, "url_key") if files else rows.repartition("url_key")
        parts.sortWithinPartitions("url_key").write.mode("overwrite").parquet(f"{self.path}/compact/upto={upto}")

    def vacuum(self, upto: int) -> int:
        """Delete batch folders that a complete snapshot covers; returns how many.

        Without it the folder listing of every later batch grows with the age of the
        stream. Only batches after ``upto`` can be replayed from then on.
        """
        snapshot = self._snapshot(None)
        if snapshot is None or snapshot < upto:
            return 0
        old = [d for d in sub_dirs(self.spark, self.batches.path) if int(d.split("=")[1]) <= upto]
        return sum(delete_dir(self.spark, f"{self.batches.path}/{d}") for d in old)
