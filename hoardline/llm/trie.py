"""A trie of conversation prefixes, built from adaptive radix trees over fixed-width turn ids.

A turn's id is 16 bytes of a digest of role and text, so that a conversation is a byte string and its prefixes are the byte strings
that end at a multiple of 16. Equal conversations are counted first. The different ones are ranged by their bytes into shards; each
shard puts its keys into an adaptive radix tree (nodes of 4, 16, 48 or 256 children that grow as needed, single-child paths kept as
bytes in the node below) and walks it once: byte depths that are whole turns emit nodes, with sums over the subtree.
A prefix can span shards only if it begins the first or last key of a shard. Those few nodes are merged, and what the cut between two
shards counted twice is taken off along the path that the cut runs through.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoardline.llm.common import text_or_empty
from hoardline.llm.mixing import word_count
from hoardline.session import cut_lineage

WIDTH = 16  # bytes of a turn id
FAMILY = 20  # conversations that may begin with turns of the same one
MOST_SHARED = 3
SHARD_BYTES = 4 << 20
CHUNK_IDS = 50_000
NONE_SHA = hashlib.sha256(b"").hexdigest()


class Sorted:
    """Up to ``room`` children beside their sorted bytes: the layouts of 4 and 16."""

    __slots__ = ("bytes", "kids", "room")

    def __init__(self, room: int, keys: bytes = b"", kids: list | None = None):
        self.room, self.bytes, self.kids = room, bytearray(keys), kids or []

    def find(self, byte: int):
        at = self.bytes.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, kid):
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.kids[at] = kid
            return self
        if len(self.kids) == self.room:
            return (Sorted(16, self.bytes, self.kids) if self.room < 16 else Indexed(self)).put(byte, kid)
        self.bytes.insert(at, byte)
        self.kids.insert(at, kid)
        return self

    def ordered(self) -> list:
        return self.kids


class Indexed:
    """Up to 48 children behind a table of 256 one-byte positions."""

    __slots__ = ("kids", "table")
    ROOM = 48

    def __init__(self, smaller: Sorted):
        self.table, self.kids = bytearray(256), list(smaller.kids)
        for at, byte in enumerate(smaller.bytes, 1):
            self.table[byte] = at

    def find(self, byte: int):
        at = self.table[byte]
        return self.kids[at - 1] if at else None

    def put(self, byte: int, kid):
        at = self.table[byte]
        if at:
            self.kids[at - 1] = kid
        elif len(self.kids) == self.ROOM:
            return Direct(self).put(byte, kid)
        else:
            self.kids.append(kid)
            self.table[byte] = len(self.kids)
        return self

    def ordered(self) -> list:
        return [self.kids[at - 1] for at in self.table if at]


class Direct:
    """A place for every byte."""

    __slots__ = ("places",)

    def __init__(self, smaller: Indexed):
        self.places = [smaller.kids[at - 1] if at else None for at in smaller.table]

    def find(self, byte: int):
        return self.places[byte]

    def put(self, byte: int, kid):
        self.places[byte] = kid
        return self

    def ordered(self) -> list:
        return [kid for kid in self.places if kid is not None]


class Node:
    """``path``: the bytes between the parent's branching byte and this node's own branching or end."""

    __slots__ = ("layout", "path", "value")

    def __init__(self, path: bytes, value: int | None = None):
        self.path, self.value, self.layout = path, value, None

    def put(self, byte: int, kid: Node) -> None:
        self.layout = (self.layout or Sorted(4)).put(byte, kid)


def _common(path: bytes, key: bytes, at: int) -> int:
    """How many leading bytes ``path`` shares with ``key`` from ``at``."""
    if key.startswith(path, at):
        return len(path)
    low, high = 0, len(path)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if key.startswith(path[:middle], at) else (low, middle)
    return low


def insert(root: Node, key: bytes, value: int) -> None:
    """Put ``key`` into the tree; splits a path where the key leaves it."""
    node, at = root, 0
    while True:
        common = _common(node.path, key, at)
        if common < len(node.path):
            below = Node(node.path[common + 1 :], node.value)
            below.layout = node.layout
            byte = node.path[common]
            node.path, node.value, node.layout = node.path[:common], None, None
            node.put(byte, below)
        at += common
        if at == len(key):
            node.value = value
            return
        kid = node.layout.find(key[at]) if node.layout else None
        if kid is None:
            node.put(key[at], Node(key[at + 1 :], value))
            return
        node, at = kid, at + 1


COLUMNS = ["depth", "n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens", "last_words", "ends_sha256", "turn_id"]


def walk(root: Node, keys: list[bytes], words: list, n: list[int], first: list[int], ends: list[str]) -> list[list]:
    """A row of ``COLUMNS`` and the row number of its parent for every turn-aligned depth of the tree, parents before children.

    ``keys`` and the other lists are indexed by the values in the tree; ``words[i][d - 1]`` counts words of turn d."""
    rows: list[list] = []
    opened: list[int] = []
    last = 0
    stack = [(root, 0, False)]
    while stack:
        node, start, leaving = stack.pop()
        if leaving:
            while opened and rows[opened[-1]][0] * WIDTH >= start:
                row = rows[opened.pop()]
                depth = row[0]
                if row[3] == 0:
                    row[4] = 1
                if depth:
                    row[6] = words[last][depth - 1]
                    row[5] += (row[1] - 1) * row[6]
                    row[8] = keys[last][(depth - 1) * WIDTH : depth * WIDTH]
                    above = rows[row[9]]
                    above[1] += row[1]
                    above[2] = row[2] if above[2] is None else min(above[2], row[2])
                    above[3] += 1
                    above[4] += row[4]
                    above[5] += row[5]
            continue
        end = start + len(node.path)
        for depth in range(-(-start // WIDTH), end // WIDTH + 1):
            rows.append([depth, 0, None, 0, 0, 0, 0, NONE_SHA, None, opened[-1] if opened else None])
            opened.append(len(rows) - 1)
        if node.value is not None:
            last = node.value
            row = rows[opened[-1]]
            row[1] += n[last]
            row[2] = first[last] if row[2] is None else min(row[2], first[last])
            row[7] = ends[last]
        stack.append((node, start, True))
        if node.layout:
            stack += [(kid, end + 1, False) for kid in reversed(node.layout.ordered())]
    return rows


def turn_id(role: Column, text: Column) -> Column:
    """32 hexadecimal digits that name a turn."""
    return F.substring(F.sha2(F.concat_ws(":", F.length(role).cast("string"), F.concat(role, text)), 256), 1, 2 * WIDTH)


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, turn_id``, null roles and texts as empty ones; rows without a conversation left out."""
    filled = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text_or_empty("role").alias("role"), text_or_empty("text").alias("text")
    )
    return filled.where("conv_id IS NOT NULL").withColumn("turn_id", turn_id(F.col("role"), F.col("text")))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, key, words``: each conversation's turn ids as one byte string, after it took over the first turns of its family's.

    Families are the conversations of one shuffle key, so that a window over at most a few dozen rows brings the first turns along."""
    conv = F.col("conv_id")
    family = conv - conv % FAMILY
    one = F.struct("turn", "role", "turn_id", word_count(F.col("text")).cast("int").alias("words"))
    rows = turns(conversations).select("conv_id", family.alias("_family"), one.alias("_turn"))
    own = rows.repartition("_family").groupBy("_family", "conv_id").agg(F.sort_array(F.collect_list("_turn")).alias("_own"))
    head = F.max(F.when(conv == F.col("_family"), F.slice("_own", 1, MOST_SHARED))).over(Window.partitionBy("_family"))
    shared = (F.crc32(conv.cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("int")
    with_head = own.withColumn("_head", head).withColumn("_h", shared)
    rest = F.slice("_own", F.col("_h") + 1, F.size("_own"))
    whole = F.when(F.col("_head").isNull(), rest).otherwise(F.concat(F.slice("_head", F.lit(1), F.col("_h")), rest))
    taken = with_head.select("conv_id", whole.alias("_t"))
    return taken.select("conv_id", F.unhex(F.array_join("_t.turn_id", "")).alias("key"), F.col("_t.words").alias("words"))


def _endings(sequences: DataFrame) -> DataFrame:
    """``conv_id, n, ends_sha256`` of each set of equal conversations, named by its smallest member.

    Members are ranged by (key, id), so that a large set is sorted and spelled out by many tasks; the digest then runs over
    its pieces, a row for many thousand members, in order."""

    def spell(batches):
        key, ids = None, []
        held = []

        def close():
            held.append((key, ids[0], len(ids), ",".join(map(str, ids)).encode()))

        for batch in batches:
            for new, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (new != key or len(ids) >= CHUNK_IDS):
                    close()
                    ids = []
                key = new
                ids.append(conv)
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), (pa.binary(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["same", "conv_id", "n", "ids"])
                held.clear()
        if ids:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), (pa.binary(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["same", "conv_id", "n", "ids"])

    def digest(batches):
        same, first, n, running = None, None, 0, None
        for batch in batches:
            done = []
            for new, conv, count, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if running is not None and new == same:
                    running.update(b"," + ids)
                    n += count
                    continue
                if running is not None:
                    done.append((first, n, running.hexdigest()))
                same, first, n, running = new, conv, count, hashlib.sha256(ids)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["conv_id", "n", "ends_sha256"])
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([n]), pa.array([running.hexdigest()])], ["conv_id", "n", "ends_sha256"])

    members = sequences.select(F.unhex(F.md5("key")).alias("same"), "conv_id")
    spelled = members.repartitionByRange("same", "conv_id").sortWithinPartitions("same", "conv_id").mapInArrow(spell, "same binary, conv_id long, n long, ids binary")
    return spelled.repartition("same").sortWithinPartitions("same", "conv_id").mapInArrow(digest, "conv_id long, n long, ends_sha256 string")


SHARD_SCHEMA = (
    "shard int, node binary, depth int, n_convs long, conv_id long, n_children long, n_leaves long, saved_tokens long, last_words long, "
    "ends_sha256 string, turn_id binary, at_first boolean, at_last boolean, childless boolean, parent_conv_id long, parent_node binary"
)
SHARD_TYPES = [pa.int32(), pa.binary(), pa.int32(), *[pa.int64()] * 6, pa.string(), pa.binary(), *[pa.bool_()] * 3, pa.int64(), pa.binary()]
SHARD_NAMES = [part.split()[0] for part in SHARD_SCHEMA.split(", ")]


def _names(key: bytes) -> list[bytes]:
    """A digest for every prefix of whole turns, the empty one first."""
    running = hashlib.md5()
    names = [running.digest()]
    for at in range(0, len(key), WIDTH):
        running.update(key[at : at + WIDTH])
        names.append(running.copy().digest())
    return names


def _shard(batches):
    keys, words, n, first, ends = [], [], [], [], []
    root = Node(b"")
    for batch in batches:
        for key, w, count, conv, sha in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            insert(root, key, len(keys))
            keys.append(key)
            words.append(w)
            n.append(count)
            first.append(conv)
            ends.append(sha)
    if not keys:
        return
    shard = TaskContext.get().partitionId()
    low, high = min(keys), max(keys)
    names = {True: _names(low), False: _names(high)}
    rows = walk(root, keys, words, n, first, ends)
    node: list[bytes | None] = []
    sides: list[tuple[bool, bool]] = []
    path: list[bytes] = []
    out = []
    for row in rows:
        depth, parent = row[0], row[9]
        del path[max(0, depth - 1) :]
        if depth:
            path.append(row[8])
        above = (True, True) if parent is None else sides[parent]
        at = slice((depth - 1) * WIDTH, depth * WIDTH)
        side = tuple(a and (depth == 0 or (len(k) >= depth * WIDTH and k[at] == row[8])) for a, k in zip(above, (low, high), strict=True))
        sides.append(side)
        name = names[side[0]][depth] if any(side) else None
        node.append(name)
        known = parent is not None and node[parent] is None
        out.append(
            [shard, name, *row[:9], *side, row[3] == 0, rows[parent][2] if known else None, None if known or parent is None else node[parent]]
        )
        if len(out) >= 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), SHARD_TYPES, strict=True)], SHARD_NAMES)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), SHARD_TYPES, strict=True)], SHARD_NAMES)


def _cut_twice(edges: DataFrame) -> DataFrame:
    """What each node on a cut between neighbouring shards counted twice: ``node, children, leaves, saved``.

    The nodes on a cut are a path from the root. Along it the sums of the deeper ones count for those above."""
    shards = edges.where("depth = 0").select("shard")  # a row per shard
    following = shards.select("shard", F.lead("shard").over(Window.orderBy("shard")).alias("next"))
    left = edges.where("at_last").join(following.where("next IS NOT NULL"), "shard")
    right = edges.where("at_first").select(F.col("shard").alias("next"), F.col("node").alias("other"))
    cut = left.join(right, (left["next"] == right["next"]) & (left["node"] == right["other"]))
    cut = cut.select("shard", "node", "depth", "last_words", F.col("childless").cast("long").alias("childless"))
    down = Window.partitionBy("shard").orderBy(F.desc("depth"))
    # Every node on a cut but the deepest has the next one as a child in both shards.
    once = cut.select(
        "node",
        (F.row_number().over(down) > 1).cast("long").alias("children"),
        F.sum("childless").over(down).alias("leaves"),
        F.sum(F.when(F.col("depth") > 0, F.col("last_words")).otherwise(0)).over(down).alias("saved"),
    )
    return once.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "saved")])


def trie(sequences: DataFrame, shards: int | None = None) -> DataFrame:
    """The nodes of all prefixes of ``sequences`` (``conv_id, key, words`` as of :func:`rebuilt`, stored): ``conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, turn_id`` (of the last turn, 32 hexadecimal digits).

    A shard holds about ``SHARD_BYTES`` of different keys; one key is never cut, so a conversation's ids (16 bytes a turn) have to fit a row."""
    spark = sequences.sparkSession
    ended = _endings(sequences).join(sequences, "conv_id").select("key", "words", "n", "conv_id", "ends_sha256")
    ended = cut_lineage(ended, "trie-keys")
    if shards is None:
        total = ended.agg(F.sum(F.length("key"))).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_BYTES))
    built = cut_lineage(ended.repartitionByRange(shards, "key").mapInArrow(_shard, SHARD_SCHEMA), "trie-shards")
    edges = built.where("node IS NOT NULL")
    merged = edges.groupBy("node").agg(
        F.min("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.min("conv_id").alias("conv_id"),
        F.coalesce(F.max(F.when(F.col("ends_sha256") != NONE_SHA, F.col("ends_sha256"))), F.lit(NONE_SHA)).alias("ends_sha256"),
        F.max("turn_id").alias("turn_id"),
        F.max("parent_node").alias("parent_node"),
    )
    twice = _cut_twice(edges)
    zero = F.lit(0)
    merged = cut_lineage(
        merged.join(twice, "node", "left")
        .withColumn("n_children", F.col("n_children") - F.coalesce("children", zero))
        .withColumn("n_leaves", F.col("n_leaves") - F.coalesce("leaves", zero))
        .withColumn("saved_tokens", F.col("saved_tokens") + F.coalesce("saved", zero)),
        "trie-edges",
    )
    convs = merged.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", F.lower(F.hex("turn_id")).alias("turn_id")]
    on_edges = merged.join(convs, "parent_node", "left").select(*columns)
    inner = built.where("node IS NULL")
    # Children of spanning nodes find their parent by shard and node, so that the root's children do not meet in one task.
    here = edges.select("shard", "node").join(merged.select("node", F.col("conv_id").alias("_parent")), "node").withColumnRenamed("node", "parent_node")
    below = inner.where("parent_node IS NOT NULL").drop("parent_conv_id").join(here, ["shard", "parent_node"]).withColumnRenamed("_parent", "parent_conv_id")
    nodes = on_edges.unionByName(below.select(*columns)).unionByName(inner.where("parent_node IS NULL").select(*columns))
    return nodes.withColumn("depth", F.col("depth").cast("long"))


def prefixes(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """The trie of the rebuilt ``conversations`` (``conv_id, turn, role, text``; other columns are ignored), one row per node.

    Turns are ordered by ``turn`` with null first, ties by role and then by id, so repeated rows are repeated turns. Null roles and
    texts are empty; rows with a null ``conv_id`` belong to no conversation. An empty table has no nodes; otherwise
    there is a root of depth 0. Remainders of negative ids keep their sign, as in SQL."""
    return trie(cut_lineage(rebuilt(conversations), "trie-sequences"), shards)
