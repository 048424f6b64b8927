"""Token ids in flat binary files with document offsets, written in key order and memory-mapped.

Rows are range-partitioned by key and sorted, so that each task writes one shard: the ids of
its documents as unsigned little-endian integers without a gap (16 bits wide if every id of
the tokenizer fits, else 32), the 64-bit offsets at which its documents start (one more than
documents, counted from the shard's own start) and the 64-bit keys. The shards in order are
one flat stream. Where a shard's ids start in it is only known once all are written: the
tables of shards is summed up by blocks of shards, the blocks are summed up, and both prefix
sums together are the shard's base.

A shard's files carry a name of the attempt that wrote them, and only shards whose task was
committed get into the table of shards, so lost executors and repeated attempts do no harm.

Encoding: a byte-level pre-tokenizer never joins characters over the start of a blank-led
run of other characters, so texts are cut there and the runs' ids remembered; every run is
encoded by the tokenizers library. Where all blanks and line ends stand alone, splitting at
them gives the same cuts faster than a pattern. Texts that hold an added token, and
tokenizers of another kind, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from array import array
from collections.abc import Iterator
from functools import cache, partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from inkwell.llm.common import quoted, small_batches, table_columns, work_path, written

DEFAULT_FILE = "byte_bpe_50k.json"
END_ID = 0
CACHED_RUNS = 900_000
CACHED_LENGTH = 32
GROUP_CHARS = 1 << 20
JOINED_WORDS = 500
BLOCK_SHARDS = 1024
#: The white space of the pre-tokenizer's pattern.
SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SIGNS = ".,;:!?"
RUN = re.compile(rf" ?[^{SPACE}]++|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
SHARD = "shard int, path string, width int, n_docs long, n_null long, n_ids long"
DOCUMENT = "doc_id long, start long, n_tokens long, ids binary"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_FILE)


class Encoder:
    """Ids of texts as bytes of little-endian unsigned integers; one per worker process."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.by_runs = (
            spec.get("normalizer") is None and spec.get("truncation") is None and spec.get("padding") is None
            and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
            and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
        )
        added = [t["content"] for t in spec.get("added_tokens", ())]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        largest = max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=0)
        self.kind = np.dtype("<u2" if largest < 1 << 16 else "<u4")
        self.pack = partial(array, next(c for c in "HIL" if array(c).itemsize == self.kind.itemsize))
        self.runs: dict[str, bytes] = {}
        line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_end = line_end[0] if self.by_runs and len(line_end) == 1 else None

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [self.pack(e.ids).tobytes() for e in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of each word with a blank before it: many to a text, as the library's cost for a text is more than for a word.

        A line end before a blank is a piece of its own, which no other piece's ids contain.
        """
        texts = ["\n ".join(["", *words[i : i + JOINED_WORDS]]) + "\n" for i in range(0, len(words), JOINED_WORDS)]
        if self.line_end is None or self.added and any(map(self.added.search, texts)):
            return self._library([f" {w}" for w in words])
        out: list[bytes] = []
        size = self.kind.itemsize
        for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids = self.pack(e.ids)
            at = np.flatnonzero(np.frombuffer(ids, self.kind) == self.line_end) * size
            data = ids.tobytes()
            out += [data[a + size : b] for a, b in pairwise(at.tolist())]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        out: list[bytes] = []
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= GROUP_CHARS:
                out += self._group(group)
                group, size = [], 0
        return out + self._group(group)

    def _group(self, texts: list[str]) -> list[bytes]:
        whole = [i for i, t in enumerate(texts) if not self.by_runs or self.added and self.added.search(t)]
        rest = sorted(set(range(len(texts))).difference(whole))
        words = {i: texts[i].replace("\n", " \n").split(" ") for i in rest}  # all but the first led by a blank or a line end
        first = [w.pop(0) for w in words.values()]
        found = {i: list(map(self.runs.get, w)) for i, w in words.items()}
        gaps = {i: [k for k, ids in enumerate(f) if ids is None] for i, f in found.items()}
        new = {w[k] for i, w in words.items() for k in gaps[i]}
        unclean = {w for w in new if not w or w == "\n" or w.strip() != w.removeprefix("\n")}
        spaced = [i for i in rest if unclean and any(words[i][k] in unclean for k in gaps[i])]  # unclean ones are never known
        out = dict(zip(whole, self._library([texts[i] for i in whole]), strict=True)) | dict(zip(rest, self._library(first), strict=True))
        new -= unclean
        room = CACHED_RUNS - len(self.runs)  # frequent runs come early; the first ones stay
        # behind a letter or number signs stand alone: most words with a comma are known without it
        signed = {w: core for w in new if w[-1] in SIGNS and (core := w.rstrip(SIGNS)) and core[-1].isalnum()}
        whole_runs = list(new.difference(signed).union(c for c in signed.values() if c not in self.runs))
        lines, inner = [w for w in whole_runs if w[0] == "\n"], [w for w in whole_runs if w[0] != "\n"]
        self.runs.update(zip(lines, self._library(lines), strict=True))
        self.runs.update(zip(inner, self._words(inner), strict=True))
        tails = list({w[len(c) :] for w, c in signed.items()})
        after = dict(zip(tails, self._library(tails), strict=True))
        self.runs.update((w, self.runs[c] + after[w[len(c) :]]) for w, c in signed.items())
        for i in set(rest).difference(spaced):
            ids, w = found[i], words[i]
            for k in gaps[i]:
                ids[k] = self.runs[w[k]]
            out[i] += b"".join(ids)
        for n, w in enumerate(new.union(whole_runs)):
            if n >= room or len(w) > CACHED_LENGTH:
                del self.runs[w]
        cut = {i: RUN.findall(texts[i]) for i in spaced}
        runs = list(set().union(*cut.values()))
        of_run = dict(zip(runs, self._library(runs), strict=True))
        out |= {i: b"".join(map(of_run.__getitem__, c)) for i, c in cut.items()}
        return [out[i] for i in range(len(texts))]


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID, key: str = "doc_id",
                 text: str = "text", parts: int | None = None) -> DataFrame:
    """Write the shards below ``folder``; a written table (shard, path, width, n_docs, n_null, n_ids, base_docs, base_ids).

    Documents come in rising order of the integer ``key``, null keys first, rows of equal key by a
    hash of their text (equal rows are interchangeable). A null text is empty; every document
    ends with ``end_id``. ``parts`` is the number of ranges; without it Spark decides by size.
    Nothing is written for an empty table.
    """
    small_batches(docs.sparkSession)
    path = tokenizer or default_tokenizer()
    rows = docs.select(quoted(key).cast("long").alias("key"), F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    # the salt cuts a group of equal rows; which of them comes first does not show
    at = ["key", "tie", F.rand(7)]
    ranged = rows.repartitionByRange(parts, *at) if parts else rows.repartitionByRange(*at)
    ordered = ranged.sortWithinPartitions("key", "tie").select("key", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        end = np.array([end_id], encoder.kind).tobytes()
        name, out, keys, sizes = f"{folder.rstrip('/')}/ids-{uuid.uuid4().hex}", None, [], []
        n_null = 0
        for batch in batches:
            if out is None:
                store, base = pafs.FileSystem.from_uri(name)
                store.create_dir(base.rsplit("/", 1)[0], recursive=True)
                out = store.open_output_stream(f"{base}.bin", compression=None)
            for ids in encoder.encode(batch.column(1).to_pylist()):
                out.write(ids)
                out.write(end)
                sizes.append(len(ids) // encoder.kind.itemsize + 1)
            n_null += batch.column(0).null_count
            keys.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        if out is None:
            return
        out.close()
        offsets = np.concatenate(([0], np.cumsum(np.array(sizes, np.uint64)))).astype("<u8")
        for end_of_name, values in ((".off", offsets), (".key", np.concatenate(keys))):
            with store.open_output_stream(base + end_of_name, compression=None) as f:
                f.write(values.tobytes())
        number = TaskContext.get().partitionId()  # ranges keep their order
        values = [number, name, encoder.kind.itemsize, len(sizes), n_null, int(offsets[-1])]
        yield pa.record_batch([pa.array([v], t) for v, t in zip(values, (pa.int32(), pa.string(), pa.int32(), *[pa.int64()] * 3), strict=True)], table_columns(SHARD))

    return written(with_bases(written(ordered.mapInArrow(write, SHARD), "shards")), "shards")


def with_bases(shards: DataFrame) -> DataFrame:
    """Add base_docs and base_ids, what the shards before hold, by prefix sums in two levels."""
    block = F.floor(F.col("shard") / BLOCK_SHARDS).alias("block")
    sums = ["n_docs", "n_ids"]
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("block").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    blocks = shards.groupBy(block).agg(*[F.sum(c).alias(c) for c in sums])
    blocks = blocks.select("block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"of_{c}") for c in sums])
    inner = shards.select("*", block).withColumns({f"in_{c}": F.coalesce(F.sum(c).over(within), F.lit(0)) for c in sums})
    return inner.join(blocks, "block").select(
        *shards.columns, (F.col("of_n_docs") + F.col("in_n_docs")).alias("base_docs"), (F.col("of_n_ids") + F.col("in_n_ids")).alias("base_ids")
    )


def mapped(path: str, kind: str) -> np.ndarray:
    """The integers of a file: memory-mapped where the store is a file system of this machine, else read."""
    store, name = pafs.FileSystem.from_uri(path)
    if store.get_file_info(name).size == 0:
        return np.empty(0, kind)
    if isinstance(store, pafs.LocalFileSystem):
        return np.memmap(name, kind, "r")
    with store.open_input_file(name) as f:
        return np.frombuffer(f.read(), kind)


def read_tokens(shards: DataFrame) -> DataFrame:
    """One row per document of the shards, with the number of ids before it and its ids as 32-bit integers."""
    small_batches(shards.sparkSession)
    names = table_columns(DOCUMENT)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for path, width, n_null, base in zip(*(c.to_pylist() for c in part.columns), strict=True):
                ids, offsets, keys = mapped(f"{path}.bin", f"<u{width}"), mapped(f"{path}.off", "<u8"), mapped(f"{path}.key", "<i8")
                if len(offsets) != len(keys) + 1 or int(offsets[-1]) != len(ids):
                    raise ValueError(f"files of {path} do not fit together")
                held, size = [], 0
                for i, key in enumerate(keys.tolist()):
                    low, high = int(offsets[i]), int(offsets[i + 1])
                    held.append((None if i < n_null else key, base + low, high - low, ids[low:high].astype("<u4").tobytes()))
                    size += 4 * (high - low)
                    if len(held) >= 1000 or size >= 8 << 20:
                        yield batch(held)
                        held, size = [], 0
                if held:
                    yield batch(held)

    n = min(max(1, shards.count()), 100_000)
    return shards.select("path", "width", "n_null", "base_ids").repartition(n, "path").mapInArrow(read, DOCUMENT)


class TokenStream:
    """Random access to the flat stream of a table of shards, for a trainer's sampler: only the table is held."""

    def __init__(self, shards: DataFrame) -> None:
        self.shards = shards.orderBy("shard").collect()
        self.bases = np.array([s.base_ids for s in self.shards] + [self.shards[-1].base_ids + self.shards[-1].n_ids if self.shards else 0])

    def __len__(self) -> int:
        return int(self.bases[-1])

    def window(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from ``start`` on, over the ends of documents and shards; fewer at the stream's end."""
        out = [np.empty(0, np.uint32)]
        i = int(np.searchsorted(self.bases, start, "right")) - 1
        while n > 0 and i < len(self.shards):
            s, low = self.shards[i], start - int(self.bases[i])
            piece = mapped(f"{s.path}.bin", f"<u{s.width}")[low : low + n].astype(np.uint32)
            out.append(piece)
            start, n, i = start + len(piece), n - len(piece), i + 1
        return np.concatenate(out)


def tokenfiles_query(docs: DataFrame, tokenizer: str | None = None, parts: int | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each row, as read back from the files.

    A null text is empty, a null doc_id comes first; repeated rows are documents of their own.
    Other columns are not looked at.
    """
    shards = write_tokens(docs, work_path(docs.sparkSession, "tokens"), tokenizer, parts=parts)
    return read_tokens(shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
