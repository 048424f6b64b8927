"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a sequence of first turns. It is told from others by its depth and by the xor of
128-bit hashes of (place, turn) over its turns, a running value that a prefix scan computes, so
no sequence is ever collected. A node's name is its smallest member and its depth. The
smallest members of the nodes along a conversation only rise, so every conversation names
one run of its own last nodes (or none), and the number of nodes below a node is a sum of
the lengths of its members' own runs: one grouping gives the sizes of all subtrees.

Sums over subtrees come from centroid decomposition of the forest of parent edges. In each
component the nodes that hold more than half of it form the path from its top to its
centroid, so each node knows by itself whether it lies on it. The total below the centroid is
aggregated and added along the path above it, whose sizes shrink by the centroid's; then
the centroid goes, and its children's subtrees and the part above it are components of at
most half the size. To which of them a node belongs is read from its own conversation's
nodes at the centroid's depth. However long and thin the trie is, the rounds grow with the
logarithm of its size. Components of few nodes are finished inside one task by the same steps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from inkwell.llm.common import table_columns, written
from inkwell.operators.timeline import SLICE, Timeline, range_number

HEADS = 6
FAMILY = 100
LOCAL = 5000
DONE = "conv long, depth long, n_leaves long, saved long"


def head_turns(conv: Column, heads: int = HEADS) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.crc32(conv.cast("string").cast("binary")) % heads


def _numbered(conversations: DataFrame) -> DataFrame:
    """(conv, at, turn_hash, size): turns numbered from 0; equal turn numbers go by the hash of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("turn_hash"), F.length(text).cast("long").alias("size"),
    )
    rows = written(rows, "turns")
    line = Timeline(["conv"], ["turn", "turn_hash"])
    local = line.sliced(rows).withColumn("_n", F.count("*").over(line.within()))
    joined = line.with_carry(local, {"_t": F.count("*")}, {"_c": F.sum("_t").over(line.before())})
    return joined.select("conv", (F.col("_n") + F.coalesce("_c", F.lit(0)) - 1).alias("at"), "turn_hash", "size")


def rebuilt(turns: DataFrame, heads: int = HEADS, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """(conv, length) of all conversations and (conv, at, turn_hash, size) of their rebuilt turns.

    The first turns come from the family's first conversation, the rest are the conversation's own.
    """
    own = turns.groupBy("conv").agg(F.count("*").alias("n"))
    first = own.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    h = head_turns(F.col("conv"), heads)
    convs = own.withColumns({"base": F.col("conv") - F.col("conv") % family, "h": h}).join(first, "base", "left")
    convs = convs.withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = written(convs.select("conv", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "conversations")
    heads_of = turns.where((F.col("at") < heads) & (F.col("conv") % family == 0)).withColumnRenamed("conv", "base")
    taken = convs.where("taken > 0").join(heads_of, "base").where("at < h").select("conv", "at", "turn_hash", "size")
    kept = turns.where(F.col("at") >= h).join(convs.select("conv", "h", "taken"), "conv")
    kept = kept.select("conv", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "turn_hash", "size")
    return convs.select("conv", "length"), written(taken.union(kept), "rebuilt")


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, a, b, size): the hash of the first ``depth`` turns and the length of the last of them."""
    line = Timeline(["conv"], ["at"])
    local = line.sliced(turns).withColumns({"x": F.xxhash64("at", "turn_hash"), "y": F.xxhash64("turn_hash", F.lit(7), "at")})
    local = local.withColumns({f"_{c}": F.bit_xor(c).over(line.within()) for c in "xy"})
    joined = line.with_carry(local, {f"_t{c}": F.bit_xor(c) for c in "xy"}, {f"_c{c}": F.bit_xor(f"_t{c}").over(line.before()) for c in "xy"})
    both = [F.col(f"_{c}").bitwiseXOR(F.coalesce(f"_c{c}", F.lit(0))).alias(name) for c, name in (("x", "a"), ("y", "b"))]
    return joined.select("conv", (F.col("at") + 1).alias("depth"), *both, "size")


def build(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie: ``places`` (conv, depth, owner, above) of each conversation's nodes below the root, and ``nodes``.

    ``owner`` names the node at the depth, ``above`` the one before it. Nodes: (conv, depth,
    parent, size_below, n_convs, text_size), the root with a null parent.
    """
    prefixes = written(_prefixes(turns), "prefixes")
    key = ["depth", "a", "b"]
    groups = prefixes.groupBy(*key).agg(F.min("conv").alias("owner"), F.count("*").alias("n_convs"))
    at = prefixes.join(groups, key).select("conv", "depth", "owner", "n_convs", "size")
    at = written(at, "owners")
    root = convs.agg(F.min("conv").alias("root"), F.count("*").alias("n_convs"))
    before = at.select("conv", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("above"))
    places = at.join(before, ["conv", "depth"], "left").withColumn("above", F.coalesce("above", root.select("root").scalar()))
    places = written(places, "places")

    own = places.where("owner = conv").groupBy("conv").agg(F.min("depth").alias("start"), F.count("*").alias("own"))
    own = written(own, "own")
    weights = places.join(own.select("conv", "own"), "conv").groupBy("owner", "depth").agg(F.sum("own").alias("own_below"))
    nodes = places.where("owner = conv").join(weights.withColumnRenamed("owner", "conv"), ["conv", "depth"]).join(own.select("conv", "start"), "conv")
    nodes = nodes.select("conv", "depth", F.col("above").alias("parent"), (F.col("own_below") - F.col("depth") + F.col("start")).alias("size_below"), "n_convs", F.col("size").alias("text_size"))
    n_nodes = own.agg((F.coalesce(F.sum("own"), F.lit(0)) + 1).alias("n"))
    top = root.where("n_convs > 0").withColumn("size_below", n_nodes.scalar())
    top = top.select(F.col("root").alias("conv"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"), "size_below", "n_convs", F.lit(0).cast("long").alias("text_size"))
    return places, written(nodes.unionByName(top), "nodes")


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of whole components, given in order of their tops and of depth."""
    names = table_columns(DONE)

    def solve(rows: list[tuple]) -> list[tuple]:
        number = {(conv, depth): i for i, (_, _, conv, depth, *_) in enumerate(rows)}
        parent = [number.get((p, depth - 1), -1) for _, _, _, depth, p, *_ in rows]
        size = [r[5] for r in rows]
        values = [(r[6], r[7]) for r in rows]
        sums = [[r[8], r[9]] for r in rows]
        waiting = [list(range(len(rows)))]
        while waiting:
            part = waiting.pop()  # by rising depth, the top first
            path = [i for i in part if 2 * size[i] > len(part)]
            centroid = path[-1]
            child: dict[int, list[int]] = {}
            branch, above, total = {centroid: None}, [], list(values[centroid])
            for i in part:
                if i == centroid:
                    continue
                if parent[i] in branch:
                    branch[i] = i if parent[i] == centroid else branch[parent[i]]
                    child.setdefault(branch[i], []).append(i)
                    total = [t + v for t, v in zip(total, values[i], strict=True)]
                else:
                    above.append(i)
            for i in path:
                sums[i] = [s + t for s, t in zip(sums[i], total, strict=True)]
                if i != centroid:
                    size[i] -= size[centroid]
            waiting += [*child.values(), *([above] if above else [])]
        return [(r[2], r[3], *s) for r, s in zip(rows, sums, strict=True)]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)

    held: list[tuple] = []
    ready: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][:2] != row[:2]:
                ready += solve(held)
                held = []
                if len(ready) >= 20_000:
                    yield out(ready)
                    ready = []
            held.append(row)
    if held:
        ready += solve(held)
    if ready:
        yield out(ready)


def roll_up(places: DataFrame, nodes: DataFrame, local: int = LOCAL) -> DataFrame:
    """(conv, depth, n_leaves, saved): subtree sums of ``leaf`` and ``saving`` of the nodes.

    Components of more than ``local`` nodes are split in rounds over the whole table.
    """
    root = nodes.where("depth = 0").select("conv", "size_below").first()
    whole = [F.lit(v).cast("long").alias(c) for c, v in zip(("top", "top_depth", "total"), (root and root.conv, 0, root and root.size_below), strict=True)]
    zero = F.lit(0).cast("long")
    forest = nodes.select("conv", "depth", "parent", F.col("size_below").alias("size"), "leaf", "saving", zero.alias("n_leaves"), zero.alias("saved"), *whole)
    comp = ["top", "top_depth"]
    small, finished = [], []
    while True:
        forest = written(forest, "forest")
        small.append(forest.where(F.col("total") <= local))
        big = forest.where(F.col("total") > local)
        if big.isEmpty():
            break
        on_path = F.col("size") * 2 > F.col("total")
        centre = big.where(on_path).groupBy(*comp).agg(F.max(F.struct(F.col("depth").alias("c_depth"), F.col("conv").alias("c_conv"), F.col("size").alias("c_size"))).alias("c"))
        rows = big.join(centre.select(*comp, "c.*"), comp)
        # the node's own conversation one step below the centroid's depth: is the centroid above it, and which child
        beside = places.select("conv", F.col("depth").alias("c_depth"), F.col("owner").alias("branch"), "above")
        rows = rows.withColumn("c_depth", F.col("c_depth") + 1).join(beside, ["conv", "c_depth"], "left")
        rows = rows.withColumns({"is_c": (F.col("conv") == F.col("c_conv")) & (F.col("depth") + 1 == F.col("c_depth"))})
        rows = rows.withColumn("below", (F.col("depth") >= F.col("c_depth")) & F.coalesce(F.col("above") == F.col("c_conv"), F.lit(False)))
        rows = written(rows.drop("above"), "split")
        sums = rows.where("is_c or below").groupBy(*comp).agg(F.sum("leaf").alias("s_leaf"), F.sum("saving").alias("s_saving"))
        rows = rows.join(sums, comp)
        up = on_path & ~F.col("is_c")
        rows = rows.withColumns({
            "n_leaves": F.col("n_leaves") + F.when(on_path, F.col("s_leaf")).otherwise(0),
            "saved": F.col("saved") + F.when(on_path, F.col("s_saving")).otherwise(0),
            "size": F.col("size") - F.when(up, F.col("c_size")).otherwise(0),
            "top": F.when(F.col("below"), F.col("branch")).otherwise(F.col("top")),
            "top_depth": F.when(F.col("below"), F.col("c_depth")).otherwise(F.col("top_depth")),
        })
        rows = written(rows.select(*[c for c in forest.columns if c != "total"], "is_c"), "split")
        finished.append(rows.where("is_c").select("conv", "depth", "n_leaves", "saved"))
        rest = rows.where("not is_c").drop("is_c")
        forest = rest.join(rest.groupBy(*comp).agg(F.count("*").alias("total")), comp)
    columns = [*comp, "conv", "depth", "parent", "size", "leaf", "saving", "n_leaves", "saved"]
    for part in small:
        finished.append(part.select(*columns).repartition(*comp).sortWithinPartitions(*comp, "depth", "conv").mapInArrow(_finish, DONE))
    out = finished[0]
    for f in finished[1:]:
        out = out.union(f)
    return out


def _ends(convs: DataFrame, places: DataFrame, root: DataFrame) -> DataFrame:
    """(conv, depth, ends_sha256) of the nodes at which conversations end.

    The members' numbers are sorted and joined range by range; only the joined pieces of a node
    meet, and a hash takes them in one after the other.
    """
    last = convs.where("length > 0").join(places, (convs.conv == places.conv) & (convs.length == places.depth)).select("owner", "depth", convs.conv.alias("member"))
    at_root = convs.where("length = 0").select(root.scalar().alias("owner"), F.lit(0).cast("long").alias("depth"), F.col("conv").alias("member"))
    ends = written(last.union(at_root), "ends")
    ends = ends.withColumn(SLICE, range_number(ends, ["owner", "depth", "member"]))
    pieces = ends.groupBy(SLICE, "owner", "depth").agg(F.array_join(F.array_sort(F.collect_list("member")).cast("array<string>"), ",").alias("piece"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, rows = None, None, []
        for batch in batches:
            for owner, depth, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (owner, depth) == key:
                    held.update(b"," + piece.encode())
                    continue
                if key is not None:
                    rows.append((*key, held.hexdigest()))
                key, held = (owner, depth), hashlib.sha256(piece.encode())
            if len(rows) >= 10_000:
                yield pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], ["conv", "depth", "ends_sha256"])
                rows = []
        if key is not None:
            rows.append((*key, held.hexdigest()))
            yield pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], ["conv", "depth", "ends_sha256"])

    ordered = pieces.repartition("owner", "depth").sortWithinPartitions("owner", "depth", SLICE).select("owner", "depth", "piece")
    return ordered.mapInArrow(digest, "conv long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, heads: int = HEADS, family: int = FAMILY, local: int = LOCAL) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    Conversations are first rebuilt (:func:`rebuilt`). Rows without a conv_id take no part; null
    turns come first, rows of equal turn go by the hash of role and text; repeated rows are turns of
    their own; null roles and texts are empty. An empty table has no node, not even a root.
    Other columns are not looked at.
    """
    convs, turns = rebuilt(written(_numbered(conversations), "numbered"), heads, family)
    places, nodes = build(convs, turns)
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["conv", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    nodes = written(nodes.withColumns({"leaf": leaf, "saving": (F.col("n_convs") - 1) * F.col("text_size")}), "nodes")
    ends = _ends(convs, places, nodes.where("depth = 0").select(F.col("conv").alias("root")))
    out = nodes.join(roll_up(places, nodes, local), ["conv", "depth"]).join(ends, ["conv", "depth"], "left")
    return out.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )


def convtrie_query(conversations: DataFrame) -> DataFrame:
    return prefix_trie(conversations)
