"""Exports outside of tables: one text file per document, outcome folders, message text."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, Window, functions as F

MOST_FOLDERS = 100_000  # that a task remembers to have made


def last_write_per_path(df: DataFrame, path: str = "output_path", order: tuple[str, ...] = ("arrived_at",)) -> DataFrame:
    """The row that would remain after overwriting in the order given; name a column that settles ties."""
    w = Window.partitionBy(path).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def export_text_files(df: DataFrame, base_uri: str, path: str = "output_path", text: str = "text") -> None:
    """Write every row to its own UTF-8 file below ``base_uri``, replacing existing ones.

    ``path`` must be unique (:func:`last_write_per_path`). Each file is written under
    a task-private name and then moved, so a repeated task cannot leave half a file.
    """

    def write(rows: Iterator[Row]) -> None:
        import posixpath
        import uuid

        from pyarrow import fs

        filesystem, prefix = fs.FileSystem.from_uri(base_uri.rstrip("/") + "/")
        prefix = prefix.rstrip("/")
        made = set()
        for row in rows:
            target = f"{prefix}/{row[path].lstrip('/')}"
            folder, name = posixpath.split(target)
            if folder not in made:
                filesystem.create_dir(folder, recursive=True)
                made = made if len(made) < MOST_FOLDERS else set()
                made.add(folder)
            hidden = f"{folder}/.{uuid.uuid4().hex}"
            with filesystem.open_output_stream(hidden) as f:
                f.write(row[text].encode("utf-8"))
            filesystem.move(hidden, f"{folder}/{name}")

    df.select(path, text).foreachPartition(write)


def write_by_outcome(df: DataFrame, path: str, mode: str = "overwrite", outcome: str = "destination") -> None:
    """One folder per destination in a single pass."""
    df.write.mode(mode).partitionBy(outcome).parquet(path)


def write_messages(df: DataFrame, path: str, mode: str = "append", message: str = "message") -> None:
    """JSON lines; a Kafka topic takes the same column as ``value``."""
    df.select(F.col(message).alias("value")).write.mode(mode).text(path)


def discard(df: DataFrame) -> None:
    """Run the plan and keep nothing."""
    df.write.format("noop").mode("overwrite").save()
