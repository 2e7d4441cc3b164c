"""Trie of conversation prefixes by a splitter skeleton.

A conversation is a path of turns, each a 128-bit hash of role and text; paths are
compared byte by byte, ties by id. Splitters from a bounded sample cut that order
into shards. All members of a node are next to each other in it, so a node whose
members lie in several shards is a prefix of a splitter between them. The trie of
the splitter paths, the skeleton, is broadcast; it is cut to ``MAX_SKELETON`` nodes
by using fewer splitters. Every shard is sorted and walked once: nodes outside the
skeleton lie whole in one shard and are finished there, skeleton nodes leave
partial counts that are summed, and sums over their subtrees are running sums in
the order of the skeleton.

Memory of a walk: the open path and the closed nodes of the shard whose parent is
still open. A path takes some 20 bytes a turn in one row, texts do not travel.
Members of one node that share it whole, however many, are dealt out by id.
SHA-256 has no parts that could be merged, so the ids that end at a skeleton node
are hashed one after the other, as strings of some thousand ids, in constant memory.

Rows without a conversation id are left out. Null role or text counts as empty, a
null turn comes first, rows of one turn in the order of their hashes; repeated rows
are turns of their own. A table without conversations gives no node.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardfeat.session import stage

#: Conversations that share a head, the most turns of a head and one more.
FAMILY, HEADS = 5, 9

#: Turns of a shard, shards at most, and sampled conversations per shard.
SHARD_TURNS, MAX_SHARDS, SAMPLE_PER_SHARD = 2_000, 20_000, 8
#: Bytes of sampled paths at most, by their average; and bytes of one sampled path.
SAMPLE_BYTES, PATH_BYTES = 32 << 20, 16 << 10
#: Nodes of the skeleton that is broadcast, some 200 bytes each.
MAX_SKELETON = 200_000
#: Bytes of a piece of ids that end at a skeleton node.
PIECE = 64 << 10

_TURN = 16
_NO_ID = -(1 << 63)
_EMPTY = hashlib.sha256().hexdigest()
_RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_FINISHED, _UNDER_SKELETON, _PARTIAL, _ENDS = range(4)
_FOUND = (
    "kind int, number int, shard int, piece int, conv_id bigint, depth bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, size bigint, ends string"
)


def turn_lists(conversations: DataFrame, by_family: bool = False) -> DataFrame:
    """One row per conversation: ``conv_id``, ``turns`` (hash and text bytes of each, in order), and ``family``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(
            F.col("turn").alias("turn"),
            F.substring(F.sha2(named, 256), 1, 2 * _TURN).alias("hash"),
            F.octet_length(text).alias("size"),
        ).alias("turn"),
    )
    rows = rows.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY)
    if by_family:  # lists and the join of a family's conversations then need no other shuffle
        rows = rows.repartition("family")
    return rows.groupBy("family", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def paths(lists: DataFrame) -> DataFrame:
    """``conv_id``, ``path`` (16 bytes a turn) and ``sizes`` (bytes of each text)."""
    joined = F.array_join(F.transform("turns", lambda t: t["hash"]), "")
    return lists.select("conv_id", F.unhex(joined).alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes"))


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """Paths of conversations whose first turns are those of their family's first conversation.

    The head has crc32(id) % 9 turns (all if there are fewer, none if that conversation is
    absent); a conversation's own turns follow after as many of its own.
    """
    lists = turn_lists(conversations, by_family=True)
    heads = lists.filter("conv_id = family").select("family", F.slice("turns", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    head = F.coalesce(F.slice("head", F.lit(1), h), F.slice("turns", 1, 0))
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return paths(lists.join(heads, "family", "left").withColumn("turns", F.concat(head, rest)))


def _common(a: bytes, b: bytes) -> int:
    """How many whole turns two paths share from the start."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // _TURN
    at = 0
    while a[at : at + _TURN] == b[at : at + _TURN]:
        at += _TURN
    return at // _TURN


def splitters(sample: Sequence[tuple[bytes, int, int, bool]], shards: int) -> list[tuple[bytes, int]]:
    """At most ``shards - 1`` places (path, id) that cut a sorted sample (path, id, weight, whole) evenly.

    A place is the shortest path that lies above the sampled conversation before it; equal paths are told apart by id.
    """
    total, reached, wanted, found = sum(s[2] for s in sample), 0, 1, []
    for before, here in zip(sample, sample[1:]):
        reached += before[2]
        if reached * shards < wanted * total:
            continue
        if before[0] != here[0]:
            place = (here[0][: (_common(before[0], here[0]) + 1) * _TURN], _NO_ID)
        elif here[3]:
            place = (here[0], here[1])
        else:
            continue
        found.append(place)
        wanted = reached * shards // total + 1
    return found


class Skeleton:
    """The trie of the splitter paths, numbered in preorder; the root is 0."""

    def __init__(self, places: Sequence[tuple[bytes, int]]):
        self.children: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth = [-1], [0]
        for path, _ in places:
            node = 0
            for at in range(0, len(path), _TURN):
                key = (node, path[at : at + _TURN])
                if key not in self.children:
                    self.children[key] = len(self.parent)
                    self.parent.append(node)
                    self.depth.append(at // _TURN + 1)
                node = self.children[key]

    def __len__(self) -> int:
        return len(self.parent)

    def ends(self) -> np.ndarray:
        """One past the last node of each node's subtree."""
        last = np.arange(1, len(self) + 1)
        for node in range(len(self) - 1, 0, -1):
            last[self.parent[node]] = max(last[self.parent[node]], last[node])
        return last


def _places(rows: DataFrame, shard_turns: int) -> tuple[list[tuple[bytes, int]], Skeleton]:
    """Splitters of the paths, from a sample that is chosen by a hash of the id, and their skeleton."""
    whole = rows.agg(F.count("*").alias("n"), F.sum(F.size("sizes") + 1).alias("turns"), F.sum(F.octet_length("path")).alias("bytes"))
    n, turns, size = whole.first()
    if not n:
        return [], Skeleton([])
    shards = min(max(1, -(-turns // shard_turns)), MAX_SHARDS)
    if shards == 1:
        return [], Skeleton([])
    share = min(1.0, SAMPLE_PER_SHARD * shards / n, SAMPLE_BYTES / max(size, 1))
    scale = 1 << 30
    drawn = rows.filter(F.pmod(F.xxhash64("conv_id", F.lit(12)), F.lit(scale)) < int(share * scale) + 1)
    drawn = drawn.select(
        F.substring("path", 1, PATH_BYTES).alias("path"), "conv_id", (F.size("sizes") + 1).alias("weight"),
        (F.octet_length("path") <= PATH_BYTES).alias("whole"),
    )
    found = splitters(sorted((bytes(r["path"]), r["conv_id"], r["weight"], r["whole"]) for r in drawn.collect()), shards)
    while len(skeleton := Skeleton(found)) > MAX_SKELETON:
        found = found[1::2]
    return found, skeleton


class _Node:
    __slots__ = ("number", "size", "least", "convs", "children", "leaves", "saved", "ended", "ids", "closed")

    def __init__(self, number: int, size: int):
        self.number, self.size = number, size
        self.least, self.convs, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ended = self.ids = None
        self.closed: list[tuple] = []


class _Walk:
    """One pass over sorted shards; ``rows`` fills with what is finished."""

    def __init__(self, children: dict[tuple[int, bytes], int]):
        self.skeleton, self.rows = children, []
        self.shard, self.path, self.open, self.pieces = None, b"", [], 0

    def take(self, shard: int, path: bytes, conv: int, sizes: Sequence[int]) -> None:
        if shard != self.shard:
            self.close(0)
            self.shard, self.path, self.open = shard, b"", [_Node(0, 0)]
        shared = _common(self.path, path)
        self.close(shared + 1)
        for depth in range(shared, len(path) // _TURN):
            parent = self.open[-1].number
            number = -1 if parent < 0 else self.skeleton.get((parent, path[depth * _TURN : (depth + 1) * _TURN]), -1)
            self.open.append(_Node(number, sizes[depth]))
        self.path = path
        node = self.open[-1]
        node.convs += 1
        node.least = conv if node.least is None else min(node.least, conv)
        self._end(node, conv)

    def _end(self, node: _Node, conv: int) -> None:
        if node.number < 0:
            if node.ended is None:
                node.ended = hashlib.sha256(b"%d" % conv)
            else:
                node.ended.update(b",%d" % conv)
            return
        node.ids = node.ids or []
        node.ids.append(str(conv))
        if len(node.ids) * 8 >= PIECE:
            self._piece(node)

    def _piece(self, node: _Node) -> None:
        if node.ids:
            self._put(_ENDS, number=node.number, piece=self.pieces, ends=",".join(node.ids))
            self.pieces += 1
            node.ids = None

    def _put(self, kind, number=None, piece=None, conv=None, depth=None, parent=None, counts=(None,) * 4, size=None, ends=None) -> None:
        self.rows.append((kind, number, self.shard, piece, conv, depth, parent, *counts, size, ends))

    def close(self, until: int) -> None:
        """Finish the open nodes from depth ``until`` on."""
        while len(self.open) > until:
            node, depth = self.open.pop(), len(self.open)
            above = self.open[-1] if self.open else None
            if above is not None:
                above.convs += node.convs
                above.least = node.least if above.least is None else min(above.least, node.least)
            if node.number >= 0:
                self._piece(node)
                counts = (node.convs, node.children, node.leaves, node.saved)
                self._put(_PARTIAL, number=node.number, conv=node.least, depth=depth, counts=counts, size=node.size)
                continue
            leaves = node.leaves or 1
            saved = node.saved + (node.convs - 1) * node.size
            above.children += 1
            above.leaves += leaves
            above.saved += saved
            for conv, counts, ends in node.closed:
                self._put(_FINISHED, conv=conv, depth=depth + 1, parent=node.least, counts=counts, ends=ends)
            ends = node.ended.hexdigest() if node.ended else _EMPTY
            counts = (node.convs, node.children, leaves, saved)
            if above.number >= 0:
                self._put(_UNDER_SKELETON, number=above.number, conv=node.least, depth=depth, counts=counts, ends=ends)
            else:
                above.closed.append((node.least, counts, ends))


def _summed(partials: DataFrame, skeleton: Skeleton) -> list[tuple]:
    """The finished skeleton nodes, but for their ends: number, and the columns of the result."""
    sums = partials.groupBy("number").agg(
        F.min("conv_id").alias("least"), F.max("size").alias("size"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    found = {r["number"]: r for r in sums.collect()}
    if not found:
        return []
    nodes = range(len(skeleton))
    children = [found[k]["n_children"] for k in nodes]
    for k in nodes[1:]:
        children[skeleton.parent[k]] += 1
    own = [[found[k]["n_leaves"] if children[k] else 1, found[k]["saved_tokens"] + (found[k]["n_convs"] - 1) * found[k]["size"]] for k in nodes]
    running = np.concatenate((np.zeros((1, 2), dtype=np.int64), np.cumsum(np.array(own, dtype=np.int64), axis=0)))
    below = running[skeleton.ends()] - running[:-1]
    return [
        (k, found[k]["least"], skeleton.depth[k], found[skeleton.parent[k]]["least"] if k else None, found[k]["n_convs"], children[k], int(below[k, 0]), int(below[k, 1]))
        for k in nodes
    ]


def _hashed_ends(pieces: DataFrame) -> DataFrame:
    """SHA-256 of the pieces of each skeleton node, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([node], pa.int32()), pa.array([digest.hexdigest()])], ["number", "ends_sha256"])

        for batch in batches:
            for number, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if number != node:
                    if digest:
                        yield done()
                    node, digest = number, hashlib.sha256(ends.encode())
                else:
                    digest.update(b"," + ends.encode())
        if digest:
            yield done()

    ordered = pieces.repartition("number").sortWithinPartitions("number", "shard", "piece").select("number", "ends")
    return ordered.mapInArrow(run, "number int, ends_sha256 string")


def prefix_trie(rows: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per distinct prefix of the paths (``conv_id``, ``path``, ``sizes``; ids must be distinct)."""
    spark = rows.sparkSession
    rows = stage(rows.select("conv_id", "path", "sizes"), "paths")
    places, skeleton = _places(rows, shard_turns)
    shared = spark.sparkContext.broadcast((places, skeleton.children))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = shared.value[0]
        for batch in batches:
            keys = zip(batch.column(1).to_pylist(), batch.column(0).to_pylist())
            shards = pa.array([bisect_right(cuts, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([shards, *batch.columns], ["shard", *batch.schema.names])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, schema = _Walk(shared.value[1]), None
        names = [c.split()[0] for c in _FOUND.split(", ")]
        kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
        schema = pa.schema([(n, kinds[c.split()[1]]) for n, c in zip(names, _FOUND.split(", "))])

        def ready() -> pa.RecordBatch:
            columns = list(zip(*state.rows)) or [[] for _ in names]
            state.rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                state.take(*row)
                if len(state.rows) >= 10_000:
                    yield ready()
        state.close(0)
        yield ready()

    dealt = rows.mapInArrow(deal, "shard int, conv_id bigint, path binary, sizes array<int>")
    sorted_shards = dealt.select("shard", "path", "conv_id", "sizes").repartition("shard").sortWithinPartitions("shard", "path", "conv_id")
    found = stage(sorted_shards.mapInArrow(walk, _FOUND), "prefix-nodes")

    top = _summed(found.filter(F.col("kind") == _PARTIAL), skeleton)
    types = "number int, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
    top = spark.createDataFrame(top, types)
    ends = _hashed_ends(found.filter(F.col("kind") == _ENDS))
    finished_top = top.join(F.broadcast(ends), "number", "left").fillna({"ends_sha256": _EMPTY})  # at most a row per skeleton node
    parents = F.broadcast(top.select("number", F.col("conv_id").alias("_parent")))
    rest = found.filter(F.col("kind").isin(_FINISHED, _UNDER_SKELETON)).join(parents, "number", "left")
    rest = rest.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent")).withColumnRenamed("ends", "ends_sha256")
    return rest.select(*_RESULT).unionByName(finished_top.select(*_RESULT))
