"""Listings of folders, made by tasks and kept as a table: the driver holds no file names."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from inkwell.session import shared_dir

LISTED = "path string, modified long, length long, folder boolean"
STEP = 10_000  # entries after which a task leaves further folders to the next round
ROWS = 10_000  # of a batch
FOLDERS_PER_TASK = 1_000
GLOB = re.compile(r"[{}\[\]*?\\]")
# the reader can leave out files that are gone or broken, see ``opened_by_tasks``
READER_ONLY = ("spark.sql.files.ignoreMissingFiles", "spark.sql.files.ignoreCorruptFiles")


class Store(NamedTuple):
    """A file system: what paths begin with as Spark shows them, and its address for Arrow."""

    shown: str
    uri: str

    def opener(self) -> Callable:
        """For tasks: gives the file system and the function from a shown path to its own."""
        shown, uri = len(self.shown), self.uri

        def opened():
            from pyarrow import fs

            filesystem, prefix = fs.FileSystem.from_uri(uri)
            prefix = prefix.rstrip("/")
            return filesystem, lambda path: prefix + path[shown:]

        return opened


def opened_by_tasks(spark: SparkSession, directory: str) -> tuple[Store, list[str], str] | None:
    """The store of a path, the paths it stands for and a folder for the listing, or None if only Spark's reader can serve it.

    That is so for stores that Arrow does not open, for paths that do not exist (the reader
    names them), for sessions that leave out missing or broken files and without a folder
    that all executors share.
    """
    if any(spark.conf.get(c, "false").lower() == "true" for c in READER_ONLY):
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    path = system.makeQualified(path)
    where = path.toUri()
    authority = where.getAuthority()
    store = Store(f"{where.getScheme()}:" + (f"//{authority}" if authority else ""), f"{where.getScheme()}://{authority or ''}/")
    roots = [s.getPath().toString() for s in system.globStatus(path) or []] if GLOB.search(directory) else [path.toString()]
    try:
        folder = shared_dir(spark)
        filesystem, own = store.opener()()
        found = roots and filesystem.get_file_info(own(roots[0])).type.name in ("File", "Directory")
    except (OSError, ValueError, ImportError):
        return None
    return (store, roots, folder) if found else None


def list_files(spark: SparkSession, store: Store, roots: list[str], shared: str, recursive: bool = False,
               glob: str | None = None, largest: int = 2**63 - 1) -> tuple[DataFrame, int, int]:
    """The files of folders, and those among ``roots``: path, modified (milliseconds), length.

    With them their number, and the bytes of those of ``largest`` bytes at most.

    A task walks its folders and, up to ``STEP`` entries, what is below them; the folders left
    are dealt out anew. One folder is listed by one task. Each round is written below
    ``shared``, so the listing is that of the moment of this call.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern() if glob else None
    step, rows, opened = STEP, ROWS, store.opener()

    def hidden(name: str) -> bool:
        """Names that Spark's file sources leave out."""
        return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        filesystem, own = opened()
        wanted = re.compile(pattern, re.DOTALL).fullmatch if pattern else lambda name: True
        seen, out = 0, []

        def entry(shown: str, info) -> tuple | None:
            """The row of a file that is wanted."""
            name = shown.rsplit("/", 1)[-1]
            if info.type == fs.FileType.File and not hidden(name) and wanted(name):
                return shown, info.mtime_ns // 1_000_000 if info.mtime_ns is not None else 0, info.size, False

        def batch() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_())
            columns = zip(*out) if out else ((),) * 4
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["path", "modified", "length", "folder"])

        for given in batches:
            for root in given.column("path").to_pylist():
                info = filesystem.get_file_info(own(root))
                if info.type != fs.FileType.Directory:
                    out.extend(filter(None, [entry(root, info)]))
                    continue
                todo = [root]
                while todo:
                    folder = todo.pop()
                    if folder != root and seen >= step:
                        out.append((folder, None, None, True))
                    else:
                        for info in filesystem.get_file_info(fs.FileSelector(own(folder))):
                            seen += 1
                            shown = f"{folder.rstrip('/')}/{info.base_name}"
                            if info.type == fs.FileType.Directory:
                                if recursive and (not hidden(info.base_name) or info.base_name.startswith(("_metadata", "_common_metadata"))):
                                    todo.append(shown)
                            elif row := entry(shown, info):
                                out.append(row)
                                if len(out) >= rows:
                                    yield batch()
                    if len(out) >= rows:
                        yield batch()
        yield batch()

    base = f"{shared.rstrip('/')}/listing-{uuid.uuid4().hex}"
    todo, folders, rounds = spark.createDataFrame([(r,) for r in roots], "path string"), len(roots), []
    files = size = 0
    while folders:
        tasks = max(min(folders, 4 * spark.sparkContext.defaultParallelism), -(-folders // FOLDERS_PER_TASK))
        rounds.append(f"{base}/{len(rounds)}")
        todo.repartition(tasks).mapInArrow(walk, LISTED).write.parquet(rounds[-1])
        found = spark.read.schema(LISTED).parquet(rounds[-1])
        todo = found.where("folder").select("path")
        opened_size = F.sum(F.when(F.col("length") <= largest, F.col("length")))
        folders, more, more_size = found.agg(F.count_if("folder"), F.count_if(~F.col("folder")), F.coalesce(opened_size, F.lit(0))).first()
        files, size = files + more, size + more_size
    return spark.read.schema(LISTED).parquet(*rounds).where("NOT folder").drop("folder"), files, size
