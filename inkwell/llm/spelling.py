"""Spelling variants: words within one edit of each other, found by a relational trie frontier.

The words are a trie held as a distributed table of edges (node, first character, label,
child, word that ends at the child). Only nodes at which words part or end are kept: an edge's
label runs to the next of them, so the depth of the trie is the number of partings, not the
length of the words. Prefixes are compared by a hash of 128 bits, and a node is named by the
first word that passes it and its depth. Sorted words tell from their neighbours how deep
anything is shared; deeper nodes are not made. A state (word, position,
node, edits) says how far a word has been read along the trie. Without an edit a word stands
on its own path, so these states are known at once. Where another word parts from it lies
the edit: the state goes on over the other edges of that node with a character replaced or
inserted, or with one of its own deleted; states whose next character does not lead on from the
child are not made, a mask of characters on each edge tells. States with their one edit spent then follow
exactly fitting edges, joined level by level until none is left; one that has read its
whole word at a node where a word ends has found a neighbour.

Near the root all words part. But of two words within one edit either the first or the last
half is the same, so the trie holds every word from both ends, and edits are tried in the
second half of the reading only; nodes of the first half are not even made.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from inkwell.llm.common import quoted, small_batches, table_columns, written

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
TYPO_EVERY = 31
COUNTED = 200_000
LONG_TEXT = 4 << 20
NODES = "id long, depth int, node binary, next int"
BIT = "shiftleft(1L, cast(%s %% 62 as int))"
COUNTS = "word string, n long"


def _runs(text: str, pattern: re.Pattern) -> Counter:
    """Runs of a text and how often they occur, A-Z in lower case."""
    low = text.encode().lower().decode()
    return Counter(pattern.findall(low) if len(low) < LONG_TEXT else (m.group() for m in pattern.finditer(low)))


def with_typos(key: str, runs: Counter, typo_every: int) -> Iterator[tuple[str, int]]:
    """The runs of one document as words: of about one in ``typo_every`` a character is left out."""
    start = crc32(f"{key}:".encode())
    for run, n in runs.items():
        h = crc32(run.encode(), start)
        if typo_every and h % typo_every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        yield run, n


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                typo_every: int = TYPO_EVERY) -> DataFrame:
    """(word, n) of all words of the texts. A null text has none, a null key counts as empty.

    Counts are combined in the task, then before the shuffle, so frequent words do not pile up.
    """
    small_batches(docs.sparkSession)
    pattern = re.compile(f"[A-Za-zÀ-ÿ]{{{least_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in with_typos(k, _runs(t, pattern), typo_every):
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) >= COUNTED:
                    yield pa.record_batch([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], table_columns(COUNTS))
                    held = Counter()
        yield pa.record_batch([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], table_columns(COUNTS))

    texts = docs.select(F.coalesce(quoted(key).cast("string"), F.lit("")).alias("k"), quoted(text).cast("string").alias("t")).where("t is not null")
    return texts.mapInArrow(count, COUNTS).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return low


def _nodes(readings: DataFrame) -> DataFrame:
    """(id, depth, node, next) of the nodes in each reading's second half that another may share, and of its end (``next`` -1).

    Where a task's range of the sorted readings starts or ends the neighbour is unknown and
    all depths are made; nodes too many do no harm.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128

        columns: list[list] = [[] for _ in range(4)]

        def done() -> pa.RecordBatch:
            types = (pa.int64(), pa.int32(), pa.binary(), pa.int32())
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], table_columns(NODES))

        def add(i: int, word: str, shared: int) -> None:
            n = len(word)
            low = (n - 1) // 2  # a neighbour may be shorter by one
            digest = xxh3_128((">" if i >= 0 else "<") + word[:low])
            for depth in range(low, min(shared, n - 1) + 1):
                for column, value in zip(columns, (i, depth, digest.digest(), ord(word[depth])), strict=True):
                    column.append(value)
                digest.update(word[depth])
            digest.update(word[max(low, min(shared, n - 1) + 1) :])
            for column, value in zip(columns, (i, n, digest.digest(), -1), strict=True):
                column.append(value)

        last, before = None, None
        for batch in batches:
            for i, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if last is not None:
                    here = _shared(last[1], word) if (last[0] < 0) == (i < 0) else 0
                    add(*last, len(last[1]) if before is None else max(before, here))
                    before = here
                last = i, word
                if len(columns[0]) >= 50_000:
                    yield done()
                    columns = [[] for _ in range(4)]
        if last is not None:
            add(*last, len(last[1]))
        if columns[0]:
            yield done()

    side = F.col("id") < 0
    return readings.repartitionByRange(side, "w").sortWithinPartitions(side, "w").select("id", "w").mapInArrow(walk, NODES)


def alive(to: str) -> str:
    """SQL: from the edge's child a state at ``to`` goes on, or ends where a word does."""
    bit = BIT % f"ascii(substr(w, {to} + 1, 1))"
    return f"(case when {to} < length then (to_mask & {bit}) <> 0 else {to} = length and to_ending is not null end)"


def neighbours(words: DataFrame) -> DataFrame:
    """(id, other) of all words (id long from 0, word string, both unique) one code point apart, in both directions.

    Apart means one inserted, deleted or replaced code point; a word is not its own neighbour.
    Null and empty words have none.
    """
    word = words.where("word <> ''")
    # the reversed reading of word i has the number -i - 1
    both = written(word.select("id", F.col("word").alias("w")).union(word.select(-F.col("id") - 1, F.reverse("word"))), "readings")
    nodes = written(_nodes(both), "nodes")
    goes_on, ends = F.when(F.col("next") >= 0, F.col("next")), F.when(F.col("next") == -1, F.col("id"))
    mask = F.coalesce(F.bit_or(F.when(F.col("next") >= 0, F.expr(BIT % "next"))), F.lit(0))
    kept = nodes.groupBy("node").agg(F.min("id").alias("at"), F.min(goes_on).alias("a"), F.max(goes_on).alias("b"), F.max(ends).alias("ending"), mask.alias("mask"))
    kept = kept.where("a <> b or ending is not null").select("node", "at", "ending", "mask", F.coalesce(F.col("a") != F.col("b"), F.lit(False)).alias("parts"), F.col("a").isNotNull().alias("goes_on"))
    path = nodes.join(kept, "node").select("id", "depth", "at", "ending", "mask", "parts", "goes_on")
    ahead = Window.partitionBy("id").orderBy("depth")
    path = path.withColumns({f"next_{c}": F.lead(c).over(ahead) for c in ("at", "depth", "ending", "mask")})
    path = written(path.where("goes_on").drop("goes_on", "mask").join(both, "id"), "paths")
    label = F.expr("substr(w, depth + 1, next_depth - depth)")
    child = [F.col(f"next_{c}").alias(f"to_{c}") for c in ("at", "depth", "ending", "mask")]
    # a node that words reach in one way only is never left by another edge, but passed on the way
    edges = path.where("next_at is not null").groupBy("at", "depth", *child, label.alias("label")).count()
    # columns of the state (w, pos, node) and of the edge (label, child) meet in the joins
    edges = written(edges.select("at", "depth", F.substring("label", 1, 1).alias("first"), "label", F.length("label").alias("size"), "to_at", "to_depth", "to_ending", "to_mask"), "edges")

    own = path.select("id", "w", F.length("w").alias("length"), F.col("depth").alias("pos"), "at", "depth", "parts", "ending").where(F.col("pos") >= F.floor(F.col("length") / 2))
    other = own.where("parts or pos = length").drop("ending", "parts").join(edges, ["at", "depth"]).where("first <> substr(w, pos + 1, 1)")
    ways = {  # where the reading goes on, and what has to fit for it
        "pos + size": "substr(label, 2) = substr(w, pos + 2, size - 1)",  # replaced
        "pos + size - 1": "substr(label, 2) = substr(w, pos + 1, size - 1)",  # inserted
        "pos + size + 1": "label = substr(w, pos + 2, size)",  # deleted
    }
    fits = {to: f"{alive(to)} and {way}" for to, way in ways.items()}
    columns = ["id", "w", "length", "pos", F.col("to_at").alias("at"), F.col("to_depth").alias("depth"), F.col("to_ending").alias("ending")]
    step = other.where(" or ".join(f"({f})" for f in fits.values()))
    step = step.withColumn("pos", F.explode(F.array_compact(F.array(*[F.expr(f"case when {f} then {to} end") for to, f in fits.items()]))))
    frontier = written(step.select(*columns), "frontier")
    # the last character deleted: the shorter word ends where the longer one has one to go
    found = [frontier, own.where("pos = length - 1 and ending is not null").select("id", F.col("length").alias("pos"), "length", "ending")]
    while not (going := frontier.where("pos < length")).isEmpty():
        step = going.drop("ending").withColumn("first", F.expr("substr(w, pos + 1, 1)")).join(edges, ["at", "depth", "first"])
        step = step.where("label = substr(w, pos + 1, size)").withColumn("pos", F.col("pos") + F.col("size")).where(alive("pos"))
        frontier = written(step.select(*columns), "frontier")
        found.append(frontier)
    plain = lambda c: F.when(F.col(c) < 0, -F.col(c) - 1).otherwise(F.col(c)).alias(c)
    pairs = [f.where("pos = length and ending is not null and ending <> id").select("id", F.col("ending").alias("other")) for f in found]
    everything = pairs[0]
    for p in pairs[1:]:
        everything = everything.union(p)
    return everything.select(plain("id"), plain("other")).distinct()


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of each row of ``words`` (word, n; words are unique).

    ``form`` is the most frequent neighbour (ties: the smallest word), if it is at least ``ratio``
    times as frequent, else null; ``root`` follows forms to the last. Forms are ever more
    frequent, so chains are short; each round of following doubles the reach.
    """
    words = written(words.withColumn("id", F.monotonically_increasing_id()), "words")
    near = neighbours(words)
    sides = near.join(words.select(F.col("id").alias("other"), F.col("word").alias("its_word"), F.col("n").alias("its_n")), "other")
    best = sides.groupBy("id").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("its_n")).alias("minus"), F.col("its_word").alias("word"), "other")).alias("best"))
    table = words.join(best, "id", "left")
    taken = -F.col("best.minus") >= ratio * F.col("n")
    table = written(
        table.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), *[
            F.when(taken, e).alias(c) for c, e in (("form", F.col("best.word")), ("form_n", -F.col("best.minus")), ("to", F.col("best.other")))
        ]),
        "forms",
    )
    jumps = table.where("to is not null").select("id", "to")
    while True:
        next_jump = jumps.select(F.col("id").alias("to"), F.col("to").alias("further"))
        followed = written(jumps.join(next_jump, "to", "left").select("id", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")), "roots")
        jumps = followed.select("id", "to")
        if followed.where("moved").isEmpty():
            break
    roots = jumps.join(words.select(F.col("id").alias("to"), F.col("word").alias("root")), "to").select("id", "root")
    return table.join(roots, "id", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_query(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of all texts, see :func:`count_words` for nulls.

    Repeated rows count each time; an empty table has no words. Other columns are not looked at.
    """
    return variants(count_words(docs))
