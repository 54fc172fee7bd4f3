"""Prefix trie of conversations, from ternary search trees of range shards merged at their borders.

A turn is known by a digest of its role and text, a conversation by its path, the digests in
order.  Paths are dealt by range, so that of the nodes of a shard only those of its first and last path
can be in another one, too: these stay open, and the paths of some hundred shards are merged in the
same kind of tree, until one is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.buckets import whole_groups
from landfall.llm.tables import stored

FAMILY, HEADS = 5, 9
DIGEST = 16
# Turns of different paths that one shard has in the mean, and shards whose borders one task merges.
SHARD_TURNS = 1 << 19
FAN_IN = 256
NO_ENDS = hashlib.sha256(b"").hexdigest()
FAR = 1 << 62
# Groups of the levels of merging are numbered apart.
LEVEL_BITS = 48


def digest_of_turn():
    """16 bytes that tell turns of different role or text apart; null counts as empty."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``path`` and ``sizes`` (bytes of the text of each turn) of every rebuilt conversation.

    The first h turns are those of the first conversation of its family of five, the rest its own; h is the
    crc32 of the decimal id, modulo 9.  Turns of one number are in the order of their digests; rows without
    a conv_id belong to no conversation.  Of a turn 40 bytes are shuffled, once, by family.
    """
    conv_id = F.col("conv_id").cast("bigint")
    text_bytes = F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("bigint")
    turns = conversations.where(conv_id.isNotNull()).select(
        (conv_id - conv_id % FAMILY).alias("family"),
        conv_id.alias("conv_id"),
        F.struct(F.col("turn").cast("bigint").alias("turn"), digest_of_turn().alias("digest"), text_bytes.alias("size")).alias("own"),
    )
    whole = turns.repartition("family").groupBy("family", "conv_id").agg(F.sort_array(F.collect_list("own")).alias("own"))
    heads = whole.where("conv_id = family").select("family", F.slice("own", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    head = F.when(F.col("head").isNull(), F.slice("own", 1, 0)).otherwise(F.slice("head", F.lit(1), h))
    turns = F.concat(head, F.slice("own", h + 1, F.size("own")))
    return whole.join(heads, "family", "left").select("conv_id", turns.alias("turns")).select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")).alias("path"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"),
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[bytes, int, str]]:
    keys, ids = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
    first = 0
    for k in range(1, len(keys) + 1):
        if k == len(keys) or keys[k] != keys[first]:
            yield keys[first], ids[first], ",".join(map(str, ids[first:k]))
            first = k


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            columns = zip(*_runs(batch))
            kinds = (pa.binary(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["key", "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state = None, hashlib.sha256()
    for batch in batches:
        done = []
        for own, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if own != key:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = own, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield _pairs(done)
    if key is not None:
        yield _pairs([(key, state.hexdigest())])


def _pairs(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    keys, ends = zip(*done)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ends, pa.string())], ["key", "ends"])


def ends_of(members: DataFrame) -> DataFrame:
    """SHA-256 of the ids of each ``key``, ascending and joined by commas.

    Ids are sorted in parts of bounded size, however many a key has; a hash takes its bytes one after
    the other, so the joined stretches of one key stream through one task.
    """
    parts = members.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    stretches = parts.mapInArrow(_stretches, "key binary, first bigint, ids string")
    return stretches.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hashed, "key binary, ends string")


def median_order(n: int) -> Iterator[int]:
    """0 to n - 1, the middle before the middles of both halves, and so on."""
    left = [(0, n)]
    while left:
        low, high = left.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            left += [(middle + 1, high), (low, middle)]


class TernaryTree:
    """A trie whose children of one node are a binary search tree of turn codes.

    Node 0 is the root; a node comes after the one above it.  Sorted paths inserted in median order
    make balanced search trees.
    """

    def __init__(self):
        self.code, self.low, self.high, self.below, self.above, self.depth, self.size = [-1], [0], [0], [0], [-1], [0], [0]

    def _new(self, code: int, above: int, size: int) -> int:
        for column, value in zip((self.code, self.low, self.high, self.below, self.above, self.depth, self.size), (code, 0, 0, 0, above, self.depth[above] + 1, size)):
            column.append(value)
        return len(self.code) - 1

    def insert(self, path: list[int], sizes: list[int]) -> list[int]:
        """The nodes of a path, from the root."""
        node, nodes = 0, [0]
        for code, size in zip(path, sizes):
            here = self.below[node]
            if not here:
                here = self.below[node] = self._new(code, node, size)
            while self.code[here] != code:
                side = self.low if code < self.code[here] else self.high
                if not side[here]:
                    side[here] = self._new(code, node, size)
                here = side[here]
            node = here
            nodes.append(node)
        return nodes


VALUES = ["members", "least", "children", "leaves", "saved", "ends"]
LISTS = ", ".join(f"{v} array<{'string' if v == 'ends' else 'bigint'}>" for v in VALUES)
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
# kind 0: a finished node (key: where it was open before; parent_key: if the parent is still open); 1: an open
# path with the values of its nodes from depth ``start`` on; 2: an open node.  owner: the shard, or group of them.
KINDS = (
    "kind int, owner bigint, key binary, parent_key binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
    f"n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, path binary, sizes array<bigint>, start int, {LISTS}"
)
OUT = [part.split()[0] for part in KINDS.split(", ")]
TYPES = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
ROWS = 8192


class Shard:
    """Paths of one shard in a tree, with what is known of each node."""

    def __init__(self, rows: pa.Table):
        """``rows`` are sorted by path; ``start`` is the depth of the first value in their lists."""
        paths = rows.column("path").to_pylist()
        digests = np.frombuffer(b"".join(paths), f"S{DIGEST}")
        distinct, codes = np.unique(digests, return_inverse=True)
        self.digests, codes = distinct.tobytes(), codes.tolist()
        ends = np.cumsum([len(p) // DIGEST for p in paths]).tolist()
        sizes, starts = rows.column("sizes").to_pylist(), rows.column("start").to_pylist()
        values = [rows.column(v).to_pylist() for v in VALUES]
        self.tree, self.paths, self.sizes, self.border = TernaryTree(), paths, sizes, {}
        columns = self.columns = ([], [], [], [], [], [])
        self.members, self.least, self.children, self.leaves, self.saved, self.ends = columns
        blank = (0, FAR, 0, 0, 0, None)
        for row in median_order(len(paths)):
            first = ends[row] - len(sizes[row])
            nodes = self.tree.insert(codes[first : ends[row]], sizes[row])
            for column, value in zip(columns, blank):
                column.extend([value] * (len(self.tree.code) - len(column)))
            if row in (0, len(paths) - 1):
                self.border[row] = nodes
            for node, members, least, children, leaves, saved, own in zip(nodes[starts[row] :], *(v[row] for v in values)):
                self.members[node] += members
                self.least[node] = min(self.least[node], least)
                self.children[node] += children
                self.leaves[node] += leaves
                self.saved[node] += saved
                self.ends[node] = own if own is not None else self.ends[node]

    def keys(self, nodes: set[int]) -> dict[int, bytes]:
        """The keys of some nodes, among them all that are above them: a digest of the path to each."""
        states = {}
        for node in sorted(nodes):
            if node:
                state = states[self.tree.above[node]].copy()
                code = self.tree.code[node]
                state.update(self.digests[DIGEST * code : DIGEST * (code + 1)])
            else:
                state = hashlib.md5(usedforsecurity=False)
            states[node] = state
        return {node: state.digest() for node, state in states.items()}

    def add_up(self, open_: set[int]) -> None:
        """Hands what finished nodes have to the nodes above them, from the last node to the first."""
        tree = self.tree
        for node in range(len(tree.code) - 1, -1, -1):
            if node in open_:
                continue
            self.saved[node] += (self.members[node] - 1) * tree.size[node]
            if not self.children[node]:
                self.leaves[node] = 1
            above = tree.above[node]
            if above >= 0:
                self.members[above] += self.members[node]
                self.least[above] = min(self.least[above], self.least[node])
                self.children[above] += 1
                self.leaves[above] += self.leaves[node]
                self.saved[above] += self.saved[node]

    def rows(self, owner: int, merged: bool, last: bool) -> Iterator[pa.RecordBatch]:
        """What is finished here, what stays open, and the values of the open paths."""
        tree = self.tree
        open_ = set() if last else {node for nodes in self.border.values() for node in nodes}
        self.add_up(open_)
        keys = self.keys(set(range(len(tree.code))) if merged else open_)
        out: list[dict] = []
        for node in range(len(tree.code)):
            if node in open_:
                out.append({"kind": 2, "owner": owner, "key": keys[node]})
                continue
            above = tree.above[node]
            row = {"kind": 0, "owner": owner, "key": keys.get(node), "conv_id": self.least[node], "depth": tree.depth[node]}
            if above in open_:
                row["parent_key"] = keys[above]
            elif above >= 0:
                row["parent_conv_id"] = self.least[above]
            row |= {"n_convs": self.members[node], "n_children": self.children[node], "n_leaves": self.leaves[node]}
            row |= {"saved_tokens": self.saved[node], "ends_sha256": self.ends[node] or NO_ENDS}
            out.append(row)
            if len(out) >= ROWS:
                yield _batch(out)
                out = []
        given: set[int] = set()
        for place, nodes in self.border.items() if open_ else ():
            own = [node for node in nodes if node not in given]
            given.update(own)
            row = {"kind": 1, "owner": owner, "path": self.paths[place], "sizes": self.sizes[place], "start": len(nodes) - len(own)}
            row |= {v: [column[node] for node in own] for v, column in zip(VALUES, self.columns)}
            out.append(row)
        if out:
            yield _batch(out)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [TYPES[part.split(" ")[1]] for part in KINDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in zip(OUT, kinds)], OUT)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if held:
        yield from Shard(pa.Table.from_batches(held)).rows(TaskContext.get().partitionId(), merged=False, last=False)


def _merge(last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["group"]):
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                group = table.slice(s, e - s)
                yield from Shard(group).rows(group.column("group")[0].as_py(), merged=True, last=last)

    return run


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS, fan_in: int = FAN_IN) -> DataFrame:
    """A row for each distinct beginning of the rebuilt conversations, from the empty one.

    ``conversations`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns do not matter.  Returns ``conv_id`` (the
    smallest member), ``depth``, ``parent_conv_id`` (that of the node above; null for the root), ``n_convs`` (members),
    ``n_children``, ``n_leaves`` (nodes without children in the subtree), ``saved_tokens`` (members less one, times the bytes
    of the last text, summed over the subtree) and ``ends_sha256`` (SHA-256 of the ids of the members that end there).

    A null role or text is empty, a null turn comes first, and turns of one number (repeated rows among them) are ordered
    by a digest of role and text.  Rows without a conv_id are in no conversation; no conversation, no node.
    Equal conversations are one path before paths are dealt, so copies make no shard larger.  A task holds the
    digests of one shard, or of one conversation where that is longer.
    """
    spark = conversations.sparkSession
    whole = stored(rebuilt(conversations).withColumn("key", F.unhex(F.md5("path"))))
    paths = whole.groupBy("key", "path", "sizes").agg(F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("least"))
    none = F.array(F.lit(0).cast("bigint"))
    paths = stored(
        paths.join(ends_of(whole.select("key", "conv_id")), "key").select(
            "path", "sizes", F.size("sizes").alias("start"), F.array("members").alias("members"), F.array("least").alias("least"),
            none.alias("children"), none.alias("leaves"), none.alias("saved"), F.array("ends").alias("ends"),
        )
    )
    turns = paths.agg(F.sum("start")).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // shard_turns))
    dealt = paths.repartitionByRange(shards, "path").sortWithinPartitions("path")
    found = stored(dealt.mapInArrow(_build, KINDS))
    nodes, finished = found.where("kind = 0"), []
    open_ = found.where("kind = 2").select("owner", F.col("key").alias("parent_key"))
    pending = nodes.where("parent_key is not null")
    results = [nodes.where("parent_key is null").select(*NODE)]
    level = 0
    while True:
        level += 1
        number = F.expr(f"(owner - {(level - 1) << LEVEL_BITS}) div {fan_in}")
        border = found.where("kind = 1").withColumn("group", number + F.lit(level << LEVEL_BITS))
        most = border.agg(F.max("group")).first()[0]
        last = most is None or most == level << LEVEL_BITS
        border = border.select("group", "path", "sizes", "start", *VALUES).repartition("group").sortWithinPartitions("group", "path")
        found = stored(border.mapInArrow(_merge(last), KINDS))
        nodes = found.where("kind = 0")
        finished.append(nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above")))
        results.append(nodes.where("parent_key is null").select(*NODE))
        if last:
            break
        pending = pending.unionByName(nodes.where("parent_key is not null"))
        open_ = open_.unionByName(found.where("kind = 2").select("owner", F.col("key").alias("parent_key")))
    known = finished[0]
    for more in finished[1:]:
        known = known.unionByName(more)
    # The node above is looked up by shard first: nodes without number have the root above them.
    above = open_.join(known, "parent_key")
    rest = pending.join(above, ["owner", "parent_key"]).withColumn("parent_conv_id", F.col("above")).select(*NODE)
    for own in results:
        rest = rest.unionByName(own)
    return rest
