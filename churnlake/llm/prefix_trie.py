"""Conversations that share their first turns, as a trie of whole turns kept in adaptive radix trees.

Every turn (role, text) becomes an id of ``WIDTH`` bytes, big end first, and a conversation the
string of its turns' ids. The strings are dealt out by range, so that a first turn, or a whole
conversation, that very many share is spread over many tasks. Each task puts its strings into one
adaptive radix tree (nodes of 4, 16, 48 or 256 children, runs of bytes without a branch kept in one
node) and reads off the depths that are a whole number of turns.

Only prefixes of a task's first or last string can go on in another task. These open nodes, a few
strings' worth per task, are added up over tasks; all others are finished where they are built.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.session import stage

#: Bytes of a turn's id: the first half of SHA-256.
WIDTH = 16
#: Turns whose strings make one range, on average.
TURNS_IN_RANGE = 200_000
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


class Node:
    """A run of bytes, the conversations that end behind it, and up to 4, 16, 48 or 256 children by their first byte.

    Nodes of 4 and 16 keep sorted bytes beside their children, nodes of 48 the place of each byte, nodes of 256
    the children by byte.
    """

    __slots__ = ("run", "ends", "size", "keys", "children", "like")

    def __init__(self, run: bytes, like: int):
        self.run, self.ends, self.size = run, [], 4
        self.keys, self.children, self.like = bytearray(), [], like  # like: number of any conversation below

    def child(self, byte: int) -> Node | None:
        if self.size <= 16:
            at = self.keys.find(byte)
            return self.children[at] if at >= 0 else None
        if self.size == 48:
            at = self.keys[byte]
            return self.children[at - 1] if at else None
        return self.children[byte]

    def put(self, byte: int, node: Node) -> None:
        """Add a child, or replace the one that starts with ``byte``."""
        if self.size <= 16:
            at = self.keys.find(byte)
            if at >= 0:
                self.children[at] = node
                return
            if len(self.keys) < self.size:
                at = sum(k < byte for k in self.keys)
                self.keys.insert(at, byte)
                self.children.insert(at, node)
                return
        elif self.size == 256 or self.keys[byte]:
            self.children[byte if self.size == 256 else self.keys[byte] - 1] = node
            return
        elif len(self.children) < 48:
            self.children.append(node)
            self.keys[byte] = len(self.children)
            return
        self._grow()
        self.put(byte, node)

    def _grow(self) -> None:
        pairs = list(self.each())
        if self.size == 4:
            self.size = 16
        elif self.size == 16:
            self.size, self.keys = 48, bytearray(256)
            self.children = [c for _, c in pairs]
            for n, (byte, _) in enumerate(pairs):
                self.keys[byte] = n + 1
        else:
            self.size, self.keys, self.children = 256, bytearray(), [None] * 256
            for byte, c in pairs:
                self.children[byte] = c

    def each(self) -> Iterator[tuple[int, Node]]:
        """Children by byte."""
        if self.size <= 16:
            yield from zip(self.keys, self.children)
        elif self.size == 48:
            yield from ((b, self.children[at - 1]) for b, at in enumerate(self.keys) if at)
        else:
            yield from ((b, c) for b, c in enumerate(self.children) if c is not None)


def _shared(a: bytes, b: bytes) -> int:
    """How many first bytes agree."""
    n = min(len(a), len(b))
    differing = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (differing.bit_length() + 7) // 8


def insert(root: Node, key: bytes, number: int) -> None:
    """File conversation ``number`` under ``key``."""
    node, at = root, 0
    while at < len(key):
        below = node.child(key[at])
        if below is None:
            below = Node(key[at:], number)
            node.put(key[at], below)
            node, at = below, len(key)
            continue
        same = len(below.run) if key.startswith(below.run, at) else _shared(below.run, key[at:at + len(below.run)])
        if same < len(below.run):
            upper = Node(below.run[:same], below.like)
            below.run = below.run[same:]
            upper.put(below.run[0], below)
            node.put(key[at], upper)
            below = upper
        node, at = below, at + same
    node.ends.append(number)


class Walk:
    """Reads the nodes at whole turns off a tree, children before parents.

    ``ids``, ``keys`` and ``lengths`` are the conversations in the order of their numbers; ``first`` and ``last`` the
    least and greatest key of the task. Rows of ``closed`` are OUT and the id of an open parent; rows of ``opened``
    are partial counts, see ``_FOUND``.
    """

    def __init__(self, ids: list[int], keys: list[bytes], lengths: list[list[int]]):
        self.ids, self.keys, self.lengths = ids, keys, lengths
        self.first, self.last = min(keys), max(keys)
        self.closed: list[tuple] = []
        self.opened: list[tuple] = []
        self.names = [_names(self.first), _names(self.last)]

    def _open(self, node: Node, depth: int) -> tuple[bool, bool]:
        """Whether the prefix of ``depth`` turns is one of the first key, and of the last."""
        key, end = self.keys[node.like], depth * WIDTH
        return tuple(len(edge) >= end and edge[:end] == key[:end] for edge in (self.first, self.last))

    def run(self, root: Node) -> None:
        # per radix node: [members, least id, children, leaves, saved tokens, rows that wait for their parent's id]
        done: list[list] = []
        work = [(root, 0, False)]
        while work:
            node, end, below = work.pop()
            end += 0 if below else len(node.run)
            if not below:
                work.append((node, end, True))
                work.extend((child, end, False) for _, child in reversed(list(node.each())))
                continue
            n = sum(1 for _ in node.each())
            parts, done = (done[-n:], done[:-n]) if n else ([], done)
            ends = sorted(self.ids[i] for i in node.ends)
            state = [len(ends) + sum(p[0] for p in parts), min([*ends[:1], *(p[1] for p in parts)]),
                     *(sum(p[i] for p in parts) for i in (2, 3, 4)), [w for p in parts for w in p[5]]]
            above = end - len(node.run)
            depths = range(end // WIDTH, above // WIDTH, -1) if end else [0]
            for depth in depths:
                self._emit(node, depth, state, ends if depth * WIDTH == end else [])
            done.append(state)

    def _emit(self, node: Node, depth: int, state: list, ends: list[int]) -> None:
        members, least, children, leaves, saved, waiting = state
        length = self.lengths[node.like][depth - 1] if depth else 0
        edges = self._open(node, depth)
        text = ",".join(map(str, ends))
        if any(edges):
            name = self.names[edges.index(True)]
            self.closed.extend((*row, name[depth]) for row in waiting)
            self.opened.append((name[depth], name[depth - 1] if depth else None, depth, length, least, members, children, leaves, saved,
                                text, *edges))
            state[2], state[5] = 0, []  # open children are counted when tasks are added up; leaves and savings of closed nodes go on
            return
        leaves, saved = leaves or 1, saved + (members - 1) * length
        self.closed.extend((row[0], row[1], least, *row[3:], None) for row in waiting)
        row = (least, depth, None, members, children, leaves, saved, hashlib.sha256(text.encode()).hexdigest())
        state[2:] = [1, leaves, saved, [row]]


def _names(key: bytes) -> list[bytes]:
    """Names of the prefixes of 0, 1, ... whole turns of ``key``."""
    chain, out = hashlib.sha256(), []
    for end in range(0, len(key) + 1, WIDTH):
        chain.update(key[max(end - WIDTH, 0):end])
        out.append(chain.digest()[:WIDTH])
    return out


_FOUND = ("task int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
          "ends_sha256 string, parent binary, name binary, length long, ends string, of_first boolean, of_last boolean")


def _trees(batches):
    """Rows of one range, in order of key: its closed nodes, and what it adds to open ones."""
    ids, keys, lengths = [], [], []
    for batch in batches:
        ids += batch.column(0).to_pylist()
        keys += batch.column(1).to_pylist()
        lengths += batch.column(2).to_pylist()
    if not ids:
        return
    root = Node(b"", 0)
    for number, key in enumerate(keys):
        insert(root, key, number)
    walk = Walk(ids, keys, lengths)
    walk.run(root)
    task = TaskContext.get().partitionId()
    rows = [(task, *row, None, None, None, None, None) for row in walk.closed]
    rows += [(task, least, depth, None, n, children, leaves, saved, None, parent, name, length, ends, first, last)
             for name, parent, depth, length, least, n, children, leaves, saved, ends, first, last in walk.opened]
    schema = pa.schema([(c.split()[0], {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(),
                                        "boolean": pa.bool_()}[c.split()[1]]) for c in _FOUND.split(", ")])
    for start in range(0, len(rows), 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[start:start + 10_000]), schema)], schema=schema)


def _digests(batches):
    """(name, ends_sha256) of rows (name, ends) in order of name and id: one hash at a time, whatever a name's ends amount to."""
    last, digest, empty, out = None, None, True, []
    for batch in batches:
        for name, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if name != last:
                if last is not None:
                    out.append((last, digest.hexdigest()))
                last, digest, empty = name, hashlib.sha256(), True
            if ends:
                digest.update(ends.encode() if empty else b"," + ends.encode())
                empty = False
    if last is not None:
        out.append((last, digest.hexdigest()))
    for start in range(0, len(out), 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[start:start + 10_000]), (pa.binary(), pa.string()))],
                                         names=["name", "ends_sha256"])


def rebuilt(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv_id, key, lengths): per conversation the ids of its rebuilt turns in one string, and the code points of their texts.

    The first h turns come from conversation c - c % 100, h being the CRC-32 of the decimal id modulo 6; the rest
    are the conversation's own from its turn h on. Equal turn numbers are ordered by role and text.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    turns = conversations.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                                                                 role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    turn = F.struct(
        F.row_number().over(order).alias("place"),
        F.substring(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 2 * WIDTH).alias("id"),
        F.char_length("text").cast("long").alias("length"))
    own = stage(turns.select("conv_id", turn.alias("turn")).groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns")), "turns")
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    convs = own.withColumns({"h": head.cast("int"), "base": F.col("conv_id") - F.col("conv_id") % 100})
    first = own.where("conv_id % 100 = 0").select(F.col("conv_id").alias("of"), F.slice("turns", 1, 5).alias("begin"))
    begin = F.coalesce(F.slice("begin", 1, F.col("h")), F.array().cast(dict(own.dtypes)["turns"]))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    both = convs.join(first, F.col("base") == F.col("of"), "left").select("conv_id", F.concat(begin, rest).alias("turns"))
    return both.select("conv_id", F.unhex(F.array_join("turns.id", "")).alias("key"), F.col("turns.length").alias("lengths"))


def _merged(opened: DataFrame) -> DataFrame:
    """OUT and ``name`` of the open nodes, from what the tasks found of them."""
    parts = opened.groupBy("name").agg(
        *[F.first(c).alias(c) for c in ("parent", "depth", "length")], F.min("conv_id").alias("conv_id"), F.min("task").alias("owner"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    below = parts.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("more"))
    parts = stage(parts.join(below, "name", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))), "open")
    # The open nodes under an open node: each is added by the first task that met it, up the one or two strings it is a prefix of.
    gain = parts.select("name", "owner", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaf"),
                        ((F.col("n_convs") - 1) * F.col("length")).alias("saved"))
    edges = opened.select("task", "name", "depth", F.explode(F.array(
        F.struct(F.lit(0).alias("edge"), F.col("of_first").alias("holds"), F.lit(True).alias("counts")),
        F.struct(F.lit(1).alias("edge"), F.col("of_last").alias("holds"), (~F.col("of_first")).alias("counts")))).alias("e")).where("e.holds")
    here = F.col("e.counts") & (F.col("task") == F.col("owner"))
    up = Window.partitionBy("task", "e.edge").orderBy(F.desc("depth"))
    sums = (edges.join(gain, "name").withColumns({c: F.sum(F.when(here, F.col(c)).otherwise(0)).over(up) for c in ("leaf", "saved")})
            .groupBy("name").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")))
    digests = (opened.where("ends != ''").select("name", "ends", "task").repartition("name").sortWithinPartitions("name", "task")
               .select("name", "ends").mapInArrow(_digests, "name binary, ends_sha256 string"))
    parents = parts.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return (parts.join(sums, "name").join(digests, "name", "left").join(parents, "parent", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("n_leaves") + F.col("leaf")).alias("n_leaves"),
                    (F.col("saved_tokens") + F.col("saved")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
                    "name"))


def trie(strings: DataFrame) -> DataFrame:
    """OUT for every distinct prefix of whole turns of ``strings`` (conv_id, key, lengths). ``conv_id`` is not null."""
    stored = stage(strings, "strings")
    turns, rows = stored.agg(F.coalesce(F.sum(F.size("lengths")), F.lit(0)), F.count("*")).first()
    ranges = max(1, math.ceil((turns + rows) / TURNS_IN_RANGE), min(rows // 1000, stored.sparkSession.sparkContext.defaultParallelism))
    dealt = stored.repartitionByRange(ranges, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    found = stage(dealt.mapInArrow(_trees, _FOUND), "trees")
    opened, closed = found.where(F.col("name").isNotNull()), found.where(F.col("name").isNull())
    merged = stage(_merged(opened), "merged")
    parents = merged.select(F.col("name").alias("parent"), F.col("conv_id").alias("met"))
    finished = closed.drop("name").join(parents, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "met"))
    return finished.select(*OUT).union(merged.select(*OUT))


def shared_prefixes(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                    text_col: str = "text") -> DataFrame:
    """The nodes (OUT) of the trie of all rebuilt conversations, see ``rebuilt``.

    Rows without a conversation id take no part. Null roles and texts are empty. Repeated rows are turns of their own.
    A conversation left without turns is a member of the root alone. Other columns are ignored, ids are long.
    An empty table has no nodes. A conversation's string, 16 bytes a turn, is one value in one task.
    """
    return trie(rebuilt(conversations, id_col, turn_col, role_col, text_col))


#: ``shared_prefixes`` in DuckDB; the CRC-32 of a decimal id goes bit by bit.
TRIE_SQL = r"""
WITH RECURSIVE crc AS (
    SELECT conv_id, conv_id::VARCHAR AS s, 0 AS k, 4294967295::BIGINT AS r FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
    UNION ALL
    SELECT conv_id, s, k + 1, CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END
    FROM (SELECT *, CASE WHEN k % 8 = 0 THEN xor(r, ascii(s[k // 8 + 1])::BIGINT) ELSE r END AS x FROM crc) WHERE k < 8 * length(s)),
heads AS (SELECT conv_id, xor(r, 4294967295::BIGINT) % 6 AS h FROM crc WHERE k = 8 * length(s)),
own AS (SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                             ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
whole AS (SELECT o.conv_id, list_concat(coalesce(b.turns[1:h], []), o.turns[h + 1:]) AS turns
          FROM own o JOIN heads USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
p AS (SELECT conv_id, depth, turns[1:depth] AS path, len(turns) = depth AS ends
      FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM whole)),
n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
      FROM p GROUP BY path, depth),
c AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * length(path[depth].text) ELSE 0 END AS saved
      FROM n LEFT JOIN c USING (path, depth)),
s AS (SELECT a.path, a.depth, count(*) FILTER (b.n_children = 0) AS n_leaves, sum(b.saved)::BIGINT AS saved_tokens
      FROM v a JOIN v b ON b.depth >= a.depth AND b.path[1:a.depth] = a.path GROUP BY ALL)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, v.ends_sha256
FROM v JOIN s USING (path, depth) LEFT JOIN n u ON u.depth = v.depth - 1 AND u.path = v.path[1:v.depth - 1]
"""
