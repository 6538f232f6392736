"""Prefix trie of conversations by time-forward processing.

A node is a distinct sequence of first turns (role and text); its members are the conversations that start with it.
Totals of subtrees (leaves, bytes that shared prefixes save) flow from the leaves up.

1. A conversation is a path: 16 bytes of hash a turn. Equal paths are one (members counted before the shuffle).
2. Distinct paths are range-partitioned and sorted: every shard is a run of neighbours. A hot first turn is spread over
   many shards, since only whole paths are keys. One scan with a stack of one path cuts a shard into its nodes.
3. Spark's external sort brings a shard's nodes in reverse level order. They are processed in that order: each node
   receives the messages of its children from a priority queue keyed by the receiver's place, sends its totals to its
   parent's place, and writes its children's rows. The queue keeps a bounded number of messages in memory and spills
   sorted runs (an unnamed scratch file of the task, like Spark's own spills; a lost task makes it anew).
4. Nodes on a shard's first or last path may reach into neighbour shards: they leave the shard as partial totals. These
   are united by node, and processed likewise, first within groups of ``fan`` neighbour shards, then within groups of
   ``fan`` such groups, until one is left; a task sees at most two paths of nodes of each shard or group in it.

Turn order: by turn, null first; equal turns by the hash of role and text. Null role or text: empty. Rows of null
conv_id belong to no conversation. Repeated rows are repeated turns. Other columns are ignored. Empty table: no rows.
"""
from __future__ import annotations

import heapq
import hashlib
import pickle
import tempfile
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.llm.common import stored


@dataclass(frozen=True)
class Trie:
    paths: int = 50_000  # of a shard
    fan: int = 32
    messages: int = 200_000  # of a queue in memory
    piece: int = 50_000  # ids hashed at once


#: Characters of a path for each turn.
STEP = 32
EMPTY = hashlib.sha256(b"").hexdigest()
ROWS = 5_000


def own_turns(turns: DataFrame) -> DataFrame:
    """One row (conv_id, turns) for each conversation, ``turns`` in order: hash of role and text, UTF-8 bytes of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, STEP)
    one = turns.where(F.col("conv_id").isNotNull()).select("conv_id", F.struct(
        "turn", digest.alias("step"), F.octet_length(text).cast("long").alias("bytes")).alias("t"))
    return one.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def with_heads(own: DataFrame, head_of: Column, n: Column) -> DataFrame:
    """Conversations whose first ``n`` turns are those of conversation ``head_of`` (fewer: all; absent: none) and whose
    further turns are their own after the first ``n``."""
    heads = own.select(F.col("conv_id").alias("_head"), F.col("turns").alias("_head_turns"))
    rest = F.slice("turns", n.cast("int") + 1, F.greatest(F.size("turns") - n.cast("int"), F.lit(0)))
    return own.withColumn("_of", head_of).join(heads, F.col("_of") == F.col("_head"), "left").select("conv_id", F.concat(
        F.slice(F.coalesce("_head_turns", F.slice("turns", 1, 0)), 1, n.cast("int")), rest).alias("turns"))


class SpillingQueue:
    """Messages by the receiver's place, least first; sorted runs beyond ``limit`` go to one unnamed scratch file."""

    def __init__(self, limit: int):
        self.limit, self.heap, self.heads, self.file, self.end, self.sent = max(2, limit), [], [], None, 0, 0

    def push(self, place, message) -> None:
        self.sent += 1
        heapq.heappush(self.heap, (place, self.sent, message))
        if len(self.heap) > self.limit:
            self._spill(sorted(self.heap))
            self.heap = []
            if len(self.heads) > 64:
                self._merge()

    def _spill(self, run) -> None:
        """Blocks of a sorted run, each with the place of the next one before it."""
        self.file = self.file or tempfile.TemporaryFile()
        blocks, block, count = [], [], 0
        for item in run:
            block.append(item)
            count += 1
            if len(block) == max(1, self.limit // 64):
                blocks.append(self._write(block))
                block = []
        if block:
            blocks.append(self._write(block))
        if blocks:
            self._open(blocks)

    def _write(self, block) -> int:
        self.file.seek(self.end)
        at = self.end
        pickle.dump(block, self.file, protocol=pickle.HIGHEST_PROTOCOL)
        self.end = self.file.tell()
        return at

    def _open(self, blocks: list[int]) -> None:
        self.file.seek(blocks[0])
        block = pickle.load(self.file)
        heapq.heappush(self.heads, (block[0][:2], block, 0, blocks[1:]))

    def _merge(self) -> None:
        """All runs to one."""
        heads, self.heads = self.heads, []

        def rest(head):
            _, block, at, blocks = head
            yield from block[at:]
            for b in blocks:
                self.file.seek(b)
                yield from pickle.load(self.file)

        self._spill(heapq.merge(*map(rest, heads), key=lambda x: x[:2]))

    def least(self):
        """The least place that has a message, or None."""
        return min([x for x in (self.heap[0][0] if self.heap else None, self.heads[0][0][0] if self.heads else None) if x is not None], default=None)

    def pop(self):
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0][:2]):
            _, block, at, blocks = heapq.heappop(self.heads)
            if at + 1 < len(block):
                heapq.heappush(self.heads, (block[at + 1][:2], block, at + 1, blocks))
            elif blocks:
                self._open(blocks)
            return block[at][0], block[at][2]
        place, _, message = heapq.heappop(self.heap)
        return place, message


def _batches(rows, schema: pa.Schema):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows(batches):
    for batch in batches:
        yield from batch.to_pylist()


PIECE = "id binary, start bigint, piece string"


def _pieces(settings: Trie, schema: pa.Schema):
    """Rows in order of (path id, conversation) to comma-joined pieces."""

    def cut(batches):
        at, start, ids = None, None, []
        for row in _rows(batches):
            if row["id"] != at or len(ids) == settings.piece:
                if ids:
                    yield {"id": at, "start": start, "piece": ",".join(ids)}
                at, start, ids = row["id"], row["conv_id"], []
            ids.append(str(row["conv_id"]))
        if ids:
            yield {"id": at, "start": start, "piece": ",".join(ids)}

    return lambda batches: _batches(cut(batches), schema)


def _digests(schema: pa.Schema):
    """Pieces in order of (path id, start) to one digest for each path."""

    def digest(batches):
        at, running = None, None
        for row in _rows(batches):
            if row["id"] == at:
                running.update(b",")
            else:
                if at is not None:
                    yield {"id": at, "ends": running.hexdigest()}
                at, running = row["id"], hashlib.sha256()
            running.update(row["piece"].encode())
        if at is not None:
            yield {"id": at, "ends": running.hexdigest()}

    return lambda batches: _batches(digest(batches), schema)


NODE = ("depth bigint, place bigint, parent bigint, n bigint, conv bigint, bytes bigint, ends string, shard bigint, "
        "key binary, parent_key binary")


def _chain(path: str) -> list[bytes]:
    """Keys of the nodes on a path, from the root."""
    keys = [b"\0" * 16]
    for at in range(0, len(path), STEP):
        keys.append(hashlib.sha256(keys[-1] + path[at:at + STEP].encode()).digest()[:16])
    return keys


def _nodes(schema: pa.Schema):
    """Sorted distinct paths of a shard to its nodes, each with the number and least id of its members here. Nodes on the
    first and the last path have keys that hold in every shard."""

    def cut(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        stack, before, placed, first = [], "", 0, None

        def close(keys=None):
            place, n, conv, size, ends = stack.pop()
            if stack:
                stack[-1][1] += n
                stack[-1][2] = conv if stack[-1][2] is None else min(conv, stack[-1][2])
            depth = len(stack)
            keys = first if place < len(first) else keys
            return {"depth": depth, "place": place, "parent": stack[-1][0] if stack else None, "n": n, "conv": conv, "bytes": size, "ends": ends,
                    "shard": shard, "key": keys[depth] if keys else None, "parent_key": keys[depth - 1] if keys and depth else None}

        for row in _rows(batches):
            path, depth = row["path"], len(row["path"]) // STEP
            if first is None:
                first = _chain(path)
                stack.append([0, 0, None, 0, None])
                placed = 1
            same = 0
            while same < min(depth, len(before) // STEP) and path[same * STEP:(same + 1) * STEP] == before[same * STEP:(same + 1) * STEP]:
                same += 1
            while len(stack) > same + 1:
                yield close()
            for k in range(same, depth):
                stack.append([placed, 0, None, row["bytes"][k], None])
                placed += 1
            top = stack[-1]
            top[1], top[2], top[4] = row["n"], row["conv_id"], row["ends"]
            before = path
        last = _chain(before)
        while stack:
            yield close(last)

    return lambda batches: _batches(cut(batches), schema)


#: ``state``: done (but for the parent's conv_id where ``parent_key`` is set), or part of a node that other shards share.
PART = ("state string, depth bigint, n bigint, conv bigint, parent_conv bigint, bytes bigint, ends string, children bigint, "
        "leaves bigint, saved bigint, key binary, parent_key binary, lo bigint, hi bigint")


def _done(node: dict, parent_conv=None, parent_key=None) -> dict:
    return node | {"state": "done", "parent_conv": parent_conv, "parent_key": parent_key}


def _receive(queue: SpillingQueue, place, node: dict):
    """The node's totals grow by its children's, whose rows are written."""
    while queue.least() == place:
        _, child = queue.pop()
        node["children"] += 1
        node["leaves"] += child["leaves"]
        node["saved"] += child["saved"]
        yield _done(child, node["conv"], None) if node["state"] == "done" else _done(child, None, node["key"])


def _close(node: dict) -> dict:
    """A node whose members and children are all known."""
    node["saved"] += (node["n"] - 1) * node["bytes"]
    node["leaves"] = node["leaves"] or 1
    return node


def _fold_shard(settings: Trie, schema: pa.Schema):
    """A shard's nodes in reverse level order: totals are sent to the parents' places."""

    def fold(batches):
        queue = SpillingQueue(settings.messages)
        for row in _rows(batches):
            node = {k: row[k] for k in ("depth", "n", "conv", "bytes", "ends", "key")} | {
                "state": "part" if row["key"] else "done", "children": 0, "leaves": 0, "saved": 0, "lo": row["shard"], "hi": row["shard"]}
            yield from _receive(queue, (-row["depth"], row["place"]), node)
            if node["state"] == "done":
                queue.push((1 - row["depth"], row["parent"]), _close(node))
            else:
                yield node | {"parent_conv": None, "parent_key": row["parent_key"]}

    return lambda batches: _batches(fold(batches), schema)


def _fold_roots(settings: Trie, schema: pa.Schema):
    """Nodes that lie within a group of shards, by group in reverse level order. Messages to nodes that reach beyond the
    group leave it as parts of them."""

    def part(place, child):
        return [_done(child, None, place[2]), {
            "state": "part", "depth": -place[1], "n": 0, "conv": None, "parent_conv": None, "bytes": 0, "ends": None, "children": 1,
            "leaves": child["leaves"], "saved": child["saved"], "key": place[2], "parent_key": None, "lo": child["lo"], "hi": child["hi"]}]

    def fold(batches):
        queue = SpillingQueue(settings.messages)
        for row in _rows(batches):
            place = (row["group"], -row["depth"], row["key"])
            while queue.heap or queue.heads:
                if queue.least() >= place:
                    break
                yield from part(*queue.pop())
            node = {k: row[k] for k in ("depth", "n", "conv", "bytes", "ends", "key", "children", "leaves", "saved", "lo", "hi")} | {"state": "done"}
            yield from _receive(queue, place, node)
            if row["depth"]:
                queue.push((row["group"], 1 - row["depth"], row["parent_key"]), _close(node))
            else:
                yield _done(_close(node))
        while queue.heap or queue.heads:
            yield from part(*queue.pop())

    return lambda batches: _batches(fold(batches), schema)


def _united(parts: DataFrame) -> DataFrame:
    """One row for each node that several shards share."""
    total = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    return parts.groupBy("key").agg(*total, F.max("depth").alias("depth"), F.min("conv").alias("conv"), F.max("bytes").alias("bytes"),
                                    F.max("ends").alias("ends"), F.max("parent_key").alias("parent_key"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def prefix_trie(conversations: DataFrame, settings: Trie = Trie()) -> DataFrame:
    """All nodes of the trie of ``conversations`` (one row each: conv_id, turns as ``own_turns`` gives them): conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = conversations.sparkSession
    arrow = lambda ddl: to_arrow_schema(spark.createDataFrame([], ddl).schema)
    path = F.array_join(F.transform("turns", lambda t: t["step"]), "")
    members = stored(conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), path.alias("path"), F.transform("turns", lambda t: t["bytes"]).alias("bytes"),
        F.unhex(F.substring(F.sha2(path, 256), 1, STEP)).alias("id")))
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + members.count() // settings.paths)

    ids = members.select("id", "conv_id").repartitionByRange(shards, "id", "conv_id").sortWithinPartitions("id", "conv_id")
    pieces = ids.mapInArrow(_pieces(settings, arrow(PIECE)), PIECE)
    ends = pieces.repartition("id").sortWithinPartitions("id", "start").mapInArrow(_digests(arrow("id binary, ends string")), "id binary, ends string")

    distinct = members.groupBy("id").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.first("path").alias("path"),
                                         F.first("bytes").alias("bytes")).join(ends, "id").select("path", "bytes", "conv_id", "n", "ends")
    nodes = distinct.repartitionByRange(shards, "path").sortWithinPartitions("path").mapInArrow(_nodes(arrow(NODE)), NODE)
    parts = [stored(nodes.sortWithinPartitions(F.desc("depth"), "place").mapInArrow(_fold_shard(settings, arrow(PART)), PART))]

    shared, width, last = _united(parts[0].where("state = 'part'")), 1, parts[0].agg(F.max("hi")).first()[0] or 0
    while width <= last or width == 1:
        width *= settings.fan
        united = stored(shared.withColumn("group", F.expr(f"lo div {width}")).withColumn("inside", F.expr(f"lo div {width} = hi div {width}")))
        inside = united.where("inside").repartition("group").sortWithinPartitions("group", F.desc("depth"), "key")
        parts.append(stored(inside.mapInArrow(_fold_roots(settings, arrow(PART)), PART)))
        beyond = united.where("not inside").withColumns({"state": F.lit("part"), "parent_conv": F.lit(None).cast("long")})
        shared = _united(beyond.select(*parts[0].columns).unionByName(parts[-1].where("state = 'part'")))

    every = parts[0].where("state = 'done'")
    for more in parts[1:]:
        every = every.unionByName(more.where("state = 'done'"))
    tops = every.where("key is not null").select(F.col("key").alias("top_key"), F.col("conv").alias("top_conv"))
    found = every.join(tops, F.col("parent_key") == F.col("top_key"), "left")
    return found.select(
        F.col("conv").alias("conv_id"), "depth", F.coalesce("parent_conv", "top_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"))
