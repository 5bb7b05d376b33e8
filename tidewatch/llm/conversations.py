"""Prefix trie of conversations, built from adaptive radix trees over turn ids of fixed width.

A turn's id is a digest of 16 bytes of its role and text. Conversations are packed into pieces of consecutive turns, so
that one of any length is a few rows. A task puts the pieces it meets into an adaptive radix tree and sends one row for
each turn-aligned node; rows of the same node, from whatever task, are then added up by the node's id: the sum, modulo
2**128, of the marks of its turns at their depths. So a node's id needs the turns before a piece as one number only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.shared import scratch, table

WIDTH = 16
#: Turns of a piece.
PIECE = 256
#: A task sends its nodes and starts a new tree after so many pieces or bytes of keys.
TREE_PIECES, TREE_BYTES = 30_000, 4 << 20
#: Characters of ids that are joined before they are digested.
TEXT = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"
EMPTY = hashlib.sha256(b"").hexdigest()


class Node:
    """A node and the compressed path to it. Layouts hold 4, 16, 48 or 256 children and grow when full."""

    __slots__ = ("prefix", "layout", "bytes", "below", "value")

    def __init__(self, prefix: bytes):
        self.prefix, self.layout, self.bytes, self.below, self.value = prefix, 4, bytearray(), [], None

    def child(self, byte: int) -> Node | None:
        if self.layout <= 16:
            at = self.bytes.find(byte)
            return self.below[at] if at >= 0 else None
        if self.layout == 48:
            at = self.bytes[byte]
            return self.below[at - 1] if at else None
        return self.below[byte]

    def put(self, byte: int, node: Node) -> None:
        """For a byte without a child, or in place of its child."""
        if self.layout <= 16:
            at = self.bytes.find(byte)
            if at >= 0:
                self.below[at] = node
                return
            if len(self.below) < self.layout:
                self.bytes.append(byte)
                self.below.append(node)
                return
        elif self.layout == 48:
            if self.bytes[byte]:
                self.below[self.bytes[byte] - 1] = node
                return
            if len(self.below) < 48:
                self.below.append(node)
                self.bytes[byte] = len(self.below)
                return
        else:
            self.below[byte] = node
            return
        self._grow()
        self.put(byte, node)

    def _grow(self) -> None:
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            places = bytearray(256)
            for at, byte in enumerate(self.bytes):
                places[byte] = at + 1
            self.layout, self.bytes = 48, places
        else:
            whole: list = [None] * 256
            for byte, node in self.children():
                whole[byte] = node
            self.layout, self.bytes, self.below = 256, bytearray(), whole

    def children(self) -> Iterator[tuple[int, Node]]:
        if self.layout <= 16:
            yield from zip(self.bytes, self.below)
        elif self.layout == 48:
            for byte, at in enumerate(self.bytes):
                if at:
                    yield byte, self.below[at - 1]
        else:
            for byte, node in enumerate(self.below):
                if node is not None:
                    yield byte, node


class RadixTree:
    """Keys of whole ids. What ends at a key is a list of sums: members, least member, leaves, rest, shared."""

    def __init__(self) -> None:
        self.root = Node(b"")

    def add(self, key: bytes, value: tuple[int, int | None, int, int, int]) -> None:
        node = self._at(key)
        old = node.value
        if old is None:
            node.value = list(value)
            return
        old[0] += value[0]
        old[1] = _least(old[1], value[1])
        for i in (2, 3, 4):
            old[i] += value[i]

    def _at(self, key: bytes) -> Node:
        node, at, above, byte = self.root, 0, None, 0
        while True:
            prefix = node.prefix
            if not key.startswith(prefix, at):
                same = next((i for i, (a, b) in enumerate(zip(prefix, key[at:at + len(prefix)])) if a != b), len(key) - at)
                parted = Node(prefix[:same])
                node.prefix = prefix[same + 1:]
                parted.put(prefix[same], node)
                above.put(byte, parted)
                node, prefix = parted, prefix[:same]
            at += len(prefix)
            if at == len(key):
                return node
            below = node.child(key[at])
            if below is None:
                below = Node(key[at + 1:])
                node.put(key[at], below)
                return below
            above, byte, node, at = node, key[at], below, at + 1

    def nodes(self, words: dict[bytes, int]) -> list[tuple]:
        """Turn-aligned nodes below the first id: (path without its last id, or an index into the list; last id;
        members, least member, leaves, saved, shared), parents first. The first id of a key is its place, no turn."""
        out: list[list] = []
        # A node is listed for each whole id of its compressed path on the way down; sums go to the node above on the way up.
        stack: list[tuple] = [(self.root, None, b"", None, None)]
        while stack:
            node, before, path, above, listed = stack.pop()
            if listed is None:
                listed, path = [], path + node.prefix
                while len(path) >= WIDTH:
                    turn, path = path[:WIDTH], path[WIDTH:]
                    if before is None:
                        before = turn
                    else:
                        out.append([before, turn])
                        before = len(out) - 1
                        listed.append(before)
                own = list(node.value) if node.value is not None else [0, None, 0, 0, 0]
                stack.append((own, None, b"", above, listed))
                stack += [(below, before, path + bytes((byte,)), own, None) for byte, below in node.children()]
            else:
                for at in reversed(listed):
                    node[3] += node[4] * words[out[at][1]]
                    out[at] += node
                if above is not None:
                    above[1] = _least(above[1], node[1])
                    for i in (0, 2, 3, 4):
                        above[i] += node[i]
        return [tuple(x) for x in out]


def _least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def marks(turns: bytes, depths: np.ndarray) -> np.ndarray:
    """Two numbers of 64 bits for each turn at its depth, each from the whole id."""
    ids, at = np.frombuffer(turns, ">u8").reshape(-1, 2).astype(np.uint64), depths.astype(np.uint64)
    first = _mixed(_mixed(ids[:, 0] + _mixed(at + np.uint64(0x9E3779B97F4A7C15))) ^ ids[:, 1])
    second = _mixed(_mixed(ids[:, 1] + _mixed(at + np.uint64(0xC2B2AE3D27D4EB4F))) ^ ids[:, 0])
    return np.stack([first, second], axis=1)


def packed(conversations: DataFrame) -> DataFrame:
    """conv_id, start (turns before, from 0), n, key (n ids), words (of each turn): pieces of up to PIECE turns.

    Turns are dealt by ranges of conversation and turn, so a conversation of any size goes to as many tasks as it fills.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("id"),
        F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long").alias("words"), F.monotonically_increasing_id().alias("tie"))
    order = ["conv_id", F.asc_nulls_first("turn"), "id", "tie"]
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "id", "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            convs, ids, words = np.asarray(batch.column(0)), batch.column(1).to_pylist(), np.asarray(batch.column(2))
            begins = np.flatnonzero(np.diff(convs, prepend=convs[0] - 1))
            rows = []
            for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(convs)]):
                for at in range(a, b, PIECE):
                    end = min(b, at + PIECE)
                    rows.append((int(convs[a]), part, no, end - at, b"".join(ids[at:end]), words[at:end]))
                    no += 1
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv_id", "part", "no", "n", "key", "words"])

    spark, out = conversations.sparkSession, scratch(conversations.sparkSession, "pieces")
    turns.mapInArrow(run, "conv_id long, part long, no long, n long, key binary, words array<long>").write.parquet(out)
    before = Window.partitionBy("conv_id").orderBy("part", "no").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.parquet(out).select("conv_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), "n", "key", "words")


def with_common_starts(pieces: DataFrame, every: int = 20, most: int = 3) -> DataFrame:
    """Pieces of rebuilt conversations: the first h turns of conversation c - c % every, then c's own after its first h.

    h is crc32(c as text) % (most + 1).
    """
    turn = F.explode(F.sequence(F.lit(0), F.least("n", F.lit(most) - F.col("start")).cast("int") - 1))
    firsts = pieces.where(F.col("start") < most).select("conv_id", "start", "key", "words", turn.alias("i"))
    pick = lambda k, x: F.max(F.when(F.col("start") + F.col("i") == k, x))
    one_id, one_count = F.expr(f"substring(key, i * {WIDTH} + 1, {WIDTH})"), F.expr("words[i]")
    heads = firsts.groupBy(F.col("conv_id").alias("base")).agg(
        F.array(*[pick(k, one_id) for k in range(most)]).alias("ids"), F.array(*[pick(k, one_count) for k in range(most)]).alias("counts"),
        F.max(F.col("start") + F.col("i") + 1).alias("there"))
    own = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    each = pieces.groupBy("conv_id").agg(F.first("start").alias("_")).select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), own.alias("h"))
    each = each.join(heads, "base", "left").withColumn("m", F.least("h", F.coalesce("there", F.lit(0))))
    head = each.where("m > 0").select(
        "conv_id", F.lit(0).cast("long").alias("start"), F.col("m").alias("n"),
        F.expr("aggregate(slice(ids, 1, int(m)), cast('' as binary), (a, x) -> concat(a, x))").alias("key"), F.expr("slice(counts, 1, int(m))").alias("words"))
    rest = pieces.join(each.select("conv_id", "h", "m"), "conv_id").withColumn("skip", F.greatest(F.lit(0), F.col("h") - F.col("start")))
    rest = rest.where("skip < n").select(
        "conv_id", (F.col("m") + F.col("start") + F.col("skip") - F.col("h")).alias("start"), (F.col("n") - F.col("skip")).alias("n"),
        F.expr(f"substring(key, int(skip) * {WIDTH} + 1)").alias("key"), F.expr("slice(words, int(skip) + 1, greatest(int(n - skip), 0))").alias("words"))
    return head.union(rest)


def _placed(pieces: DataFrame) -> DataFrame:
    """With the ids of the node before (a, b) and at the end (end_a, end_b) of each piece, and whether it is the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, sizes, keys = np.asarray(batch.column(1)), np.asarray(batch.column(2)), batch.column(3).to_pylist()
            sums = np.zeros((batch.num_rows, 2), np.uint64)
            if batch.num_rows:
                first = np.cumsum(sizes) - sizes
                depths = np.arange(int(sizes.sum())) - np.repeat(first, sizes) + np.repeat(starts, sizes) + 1
                sums = np.add.reduceat(marks(b"".join(keys), depths), first, axis=0)
            halves = [(sums[:, i] >> np.uint64(s) & np.uint64(0xFFFFFFFF)).astype(np.int64) for i in (0, 1) for s in (0, 32)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, halves)], [*batch.schema.names, "x0", "x1", "x2", "x3"])

    rows = pieces.select("conv_id", "start", "n", "key", "words")
    rows = rows.mapInArrow(run, "conv_id long, start long, n long, key binary, words array<long>, x0 long, x1 long, x2 long, x3 long")
    order = Window.partitionBy("conv_id").orderBy("start")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"y{i}": F.sum(f"x{i}").over(so_far) for i in range(4)} | {"last": F.lead("start").over(order).isNull()})

    def number(low: Column, high: Column) -> Column:
        """low + 2**32 high, modulo 2**64."""
        carried = (high + F.shiftright(low, 32)).bitwiseAND(0xFFFFFFFF)
        return F.shiftleft(carried, 32).bitwiseOR(low.bitwiseAND(0xFFFFFFFF))

    y, x = [F.col(f"y{i}") for i in range(4)], [F.col(f"x{i}") for i in range(4)]
    return rows.select(
        "conv_id", "start", "n", "key", "words", "last", number(y[0], y[1]).alias("end_a"), number(y[2], y[3]).alias("end_b"),
        number(y[0] - x[0], y[1] - x[1]).alias("a"), number(y[2] - x[2], y[3] - x[3]).alias("b"))


def _partial_nodes(pieces: DataFrame) -> DataFrame:
    """pieces with the columns a, b, start, key, words, member, counted, leaf, rest, shared: rows of nodes, to be added up.

    Each tree's keys begin with the id of the node before the piece; `shared` turns of a piece count as shared.
    """

    def flush(tree: RadixTree, words: dict[bytes, int], starts: dict[bytes, int]) -> pa.RecordBatch:
        found = tree.nodes(words)
        depths, ids, parents = [], [], []
        low = (1 << 64) - 1
        for before, *_ in found:
            depths.append((starts[before] if isinstance(before, bytes) else depths[before]) + 1)
        both = marks(b"".join([x[1] for x in found]), np.array(depths, np.int64)).tolist()
        for (before, *_), (a, b) in zip(found, both):
            u, v = (int.from_bytes(before[:8]), int.from_bytes(before[8:])) if isinstance(before, bytes) else ids[before]
            parents.append((u, v))
            ids.append((u + a & low, v + b & low))
        signed = lambda pairs, i: pa.array(np.array([p[i] for p in pairs], np.uint64).view(np.int64))
        columns = [signed(ids, 0), signed(ids, 1), signed(parents, 0), signed(parents, 1), pa.array(depths, pa.int64())]
        columns += [pa.array([words[x[1]] for x in found], pa.int64())] + [pa.array([x[i] for x in found], pa.int64()) for i in (2, 3, 4, 5)]
        return pa.RecordBatch.from_arrays(columns, ["a", "b", "parent_a", "parent_b", "depth", "words", "n_convs", "conv_id", "n_leaves", "saved_tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, words, starts, pieces_in, bytes_in = RadixTree(), {}, {}, 0, 0
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for a, b, start, key, counts, member, counted, leaf, rest, shared in zip(*columns):
                place = (a & (1 << 64) - 1).to_bytes(8) + (b & (1 << 64) - 1).to_bytes(8)
                starts[place] = start
                words.update(zip([key[i:i + WIDTH] for i in range(0, len(key), WIDTH)], counts))
                tree.add(place + key, (counted, member, leaf, rest, int(shared == len(counts))))
                if 0 < shared < len(counts):
                    tree.add(place + key[:shared * WIDTH], (0, None, 0, 0, 1))
                pieces_in, bytes_in = pieces_in + 1, bytes_in + len(key)
                if pieces_in >= TREE_PIECES or bytes_in >= TREE_BYTES:
                    yield flush(tree, words, starts)
                    tree, words, starts, pieces_in, bytes_in = RadixTree(), {}, {}, 0, 0
        if pieces_in:
            yield flush(tree, words, starts)

    rows = pieces.select("a", "b", "start", "key", "words", "member", "counted", "leaf", "rest", "shared")
    return rows.mapInArrow(
        run, "a long, b long, parent_a long, parent_b long, depth long, words long, n_convs long, conv_id long, n_leaves long, saved_tokens long")


def _digests(ends: DataFrame) -> DataFrame:
    """a, b, member -> a, b, ends_sha256. The members of a node are joined to long texts where they lie in order first,
    so what meets in one task is a few texts of each node."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for (a, b), rows in groupby(zip(*[c.to_pylist() for c in batch.columns]), lambda r: r[:2]):
                some, long = [], 0
                for *_, member in rows:
                    some.append(member)
                    long += len(str(member)) + 1
                    if long >= TEXT:
                        out.append((a, b, some[0], ",".join(map(str, some))))
                        some, long = [], 0
                if some:
                    out.append((a, b, some[0], ",".join(map(str, some))))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["a", "b", "first", "text"])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
        done: list[tuple] = []
        for (a, b), texts in groupby(rows, lambda r: r[:2]):
            digest, between = hashlib.sha256(), b""
            for *_, text in texts:
                digest.update(between + text.encode())
                between = b","
            done.append((a, b, digest.hexdigest()))
            if len(done) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["a", "b", "ends_sha256"])
                done = []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["a", "b", "ends_sha256"])

    order = ["a", "b", "member"]
    texts = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined, "a long, b long, first long, text string")
    texts = texts.repartition("a", "b").sortWithinPartitions("a", "b", "first").select("a", "b", "text")
    return texts.mapInArrow(digested, "a long, b long, ends_sha256 string")


def trie(pieces: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of the pieces' conversations; members: conv_id of all conversations, those without turns included."""
    spark = pieces.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        out = scratch(spark, name)
        df.write.parquet(out)
        return spark.read.parquet(out)

    placed = kept(_placed(pieces), "placed-pieces")
    zero = F.lit(0).cast("long")
    counted = placed.select("*", F.col("conv_id").alias("member"), (zero + 1).alias("counted"), zero.alias("leaf"), zero.alias("rest"), zero.alias("shared"))
    nodes = _partial_nodes(counted).groupBy("a", "b").agg(
        F.max("parent_a").alias("parent_a"), F.max("parent_b").alias("parent_b"), F.max("depth").alias("depth"),
        F.max("words").alias("words"), F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    nodes = kept(nodes, "nodes")
    children = nodes.groupBy(F.col("parent_a").alias("a"), F.col("parent_b").alias("b")).agg(F.count("*").alias("n_children"))
    nodes = kept(nodes.join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", zero)), "nodes")

    # A node belongs to its least member, so a conversation owns its path from some depth on. What it saves lies above that
    # depth, and it brings a leaf if it owns one.
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("own"), F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaf"))
    seen = placed.join(owned, "conv_id", "left").withColumn(
        "shared", F.greatest(F.lit(0), F.least("n", F.coalesce(F.col("own") - 1 - F.col("start"), "n"))).cast("long"))
    later = Window.partitionBy("conv_id").orderBy("start").rowsBetween(1, Window.unboundedFollowing)
    spoken = F.expr("aggregate(slice(words, 1, int(shared)), 0L, (s, x) -> s + x)")
    seen = seen.withColumn("spoken", spoken).withColumn("rest", F.coalesce(F.sum("spoken").over(later), zero))
    seen = seen.withColumns({"leaf": F.coalesce("leaf", zero).cast("long"), "member": F.lit(None).cast("long"), "counted": zero})
    sums = _partial_nodes(seen.where("leaf > 0 or shared > 0")).groupBy("a", "b").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))

    ends = placed.where("last").select(F.col("end_a").alias("a"), F.col("end_b").alias("b"), F.col("conv_id").alias("member"))
    turnless = members.join(placed.select("conv_id").distinct(), "conv_id", "left_anti")
    ends = ends.union(turnless.select(zero, zero, "conv_id"))

    top = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).first()
    below = nodes.agg(
        F.sum(F.when(F.col("depth") == 1, 1).otherwise(0)).alias("n_children"), F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("n_leaves"),
        F.sum((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")).first()
    schema = "a long, b long, conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, parent_a long, parent_b long"
    root = (0, 0, top.conv_id, 0, top.n_convs, below.n_children or 0, below.n_leaves or 1, below.saved_tokens or 0, None, None)
    roots = spark.createDataFrame([root] if top.n_convs else [], schema)
    nodes = nodes.join(sums, ["a", "b"], "left").select(*roots.columns).union(roots)
    parents = nodes.select(F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(_digests(ends), ["a", "b"], "left").join(parents, ["parent_a", "parent_b"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", zero).alias("n_leaves"),
        F.coalesce("saved_tokens", zero).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, every: int | None = None, most: int = 3) -> DataFrame:
    """The prefix trie of conversations (conv_id, turn, role, text), one row a node, the textless root included.

    With `every`, conversations are first rebuilt by with_common_starts. Rows with a null conv_id are left out; null
    turns come first; turns of equal number are ordered by a digest of role and text, so repeated rows are turns of
    their own; null roles and texts are empty ones; other columns are ignored; texts and conversations of any length are
    taken whole. An empty table has no node.
    """
    pieces = packed(conversations)
    members = pieces.select("conv_id").distinct()
    return trie(with_common_starts(pieces, every, most) if every else pieces, members)


def op12_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations"), every=20)
