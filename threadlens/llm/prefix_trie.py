"""Operator 12: the prefix trie of conversations, in double arrays.

A turn is known by the md5 of its role and text. Conversations with the same
turns throughout are one class; only one of each goes on, with the number of
its members. Classes are dealt by their first turns: all that share a first
turn are one group, and a group of more than GROUP_TURNS turns is parted by its
first two, four, eight ... turns until it is small enough or a single class, so
a prefix that a third of all conversations share ends up in as many tasks as
it needs. A task packs the groups it reads, up to CHUNK_TURNS turns at a time,
into one trie of two arrays over dense turn ids: the child of the node at slot
s by turn t stands at BASE[s] + t, and CHECK there says s. Classes are then
walked through the arrays for members, and the slots are gone over from the
deepest up for the sums over subtrees.

Nodes below the depth at which their group was parted are in one task only and
finished there. Nodes above it (the root at least) may be in several; these
give partial sums by the md5 chain of their turns, which Spark adds up, and
their few levels are summed over the list of each node's ancestors.

A conversation's turn ids (24 bytes a turn) are held by one task; its texts
never are, its turns are numbered by ranges, and the id lists behind
``ends_sha256`` are packed in sorted blocks and streamed into one digest.

Defined results: a null role or text is empty; turns of one number stand in the
order of their md5, a null number first; rows without a conversation id belong
to no conversation; repeated rows are turns like any other; the remainder of a
negative id is negative, as in SQL; an empty table has no nodes; other columns
are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm.common import WORD, mapped, saved
from threadlens.llm.registry import query
from threadlens.operators.index import dense_index

GROUP_TURNS, CHUNK_TURNS = 1 << 16, 1 << 17
BLOCK_IDS = 8192   # ids of a block of text behind a digest
FIT_TRIES = 64     # places tried for the children of a node before the end of the arrays


# --- the double array ---------------------------------------------------------------------
class DoubleArray:
    """BASE and CHECK over dense labels; slot 0 is the root, CHECK of a free
    slot is -1. A base may be negative, a slot is never below 1."""

    def __init__(self, room: int):
        self.base = np.zeros(max(2, room), np.int64)
        self.check = np.full(max(2, room), -1, np.int64)
        self.check[0] = 0
        self.end = 1           # slots from here on are free
        self.gaps: list[int] = []  # some of the free slots before it

    def _grow(self, to: int) -> None:
        if to > len(self.check):
            more = max(to, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate((self.base, np.zeros(more, np.int64)))
            self.check = np.concatenate((self.check, np.full(more, -1, np.int64)))

    def _place(self, parent: int, labels: np.ndarray) -> None:
        """All children of a node: in the first gap that has room, else at the end."""
        first = int(labels[0])
        for g in self.gaps[-FIT_TRIES:]:
            at = labels + (g - first)
            if at[-1] < len(self.check) and (self.check[at] < 0).all():
                break
        else:
            at = labels + (self.end - first)
            self._grow(int(at[-1]) + 1)
        self.base[parent] = at[0] - first
        self.check[at] = parent
        if at[-1] >= self.end:
            free = np.flatnonzero(self.check[self.end:int(at[-1])] < 0) + self.end
            self.gaps += free.tolist()
            self.end = int(at[-1]) + 1

    def add(self, parents: np.ndarray, labels: np.ndarray) -> None:
        """One level: distinct (parent slot, label) pairs, sorted."""
        starts = np.flatnonzero(np.concatenate(([True], parents[1:] != parents[:-1])))
        sizes = np.diff(np.append(starts, len(parents)))
        for i, n in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            self._place(int(parents[i]), labels[i:i + n])
        one = starts[sizes == 1]  # an only child goes anywhere
        slots: list[int] = []
        while self.gaps and len(slots) < len(one):
            g = self.gaps.pop()
            if self.check[g] < 0:
                slots.append(g)
                self.check[g] = 0  # taken, its parent follows
        rest = len(one) - len(slots)
        self._grow(self.end + rest)
        at = np.array(slots + list(range(self.end, self.end + rest)), np.int64)
        self.end += rest
        self.base[parents[one]] = at - labels[one]
        self.check[at] = parents[one]

    def step(self, slots: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The children of slots by labels, -1 where there is none."""
        to = self.base[slots] + labels
        inside = (to > 0) & (to < len(self.check))
        return np.where(inside & (self.check[np.where(inside, to, 0)] == slots), to, -1)


def dense_ids(key: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Ids from 0 of the distinct turns, by first appearance from the root
    down, so that the children of a node have ids close to each other."""
    order = np.argsort(depth, kind="stable")
    _, first, ids = np.unique(key[order], return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first, kind="stable")] = np.arange(len(first))
    out = np.empty(len(key), np.int64)
    out[order] = rank[ids.reshape(-1)]
    return out


def packed(ids: np.ndarray, first: np.ndarray, length: np.ndarray) -> DoubleArray:
    """The trie of sequences ids[first:first + length]."""
    trie = DoubleArray(len(ids) + 1)
    state = np.zeros(len(first), np.int64)
    live = np.flatnonzero(length > 0)
    d = 0
    while len(live):
        pair = np.unique(np.stack((state[live], ids[first[live] + d]), axis=1), axis=0)
        trie.add(pair[:, 0], pair[:, 1])
        state[live] = trie.step(state[live], ids[first[live] + d])
        d += 1
        live = live[length[live] > d]
    return trie


_OUT = pa.schema([("fp", pa.binary()), ("parent_fp", pa.binary()), ("above", pa.list_(pa.binary())), ("depth", pa.int32()), ("conv_id", pa.int64()),
                  ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()),
                  ("words", pa.int64()), ("end_id", pa.int64()), ("end_n", pa.int64())])
_OUT_SQL = ("fp binary, parent_fp binary, above array<binary>, depth int, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
            "n_leaves bigint, saved bigint, words bigint, end_id bigint, end_n bigint")


def trie_rows(rep: np.ndarray, n: np.ndarray, cut: np.ndarray, key: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
    """Turns of whole groups, class after class and in order -> nodes. ``fp``
    is null for a finished node; one above its group's cut has partial sums:
    of its members, and of the finished subtrees right below it."""
    first = np.flatnonzero(np.concatenate(([True], rep[1:] != rep[:-1])))
    length = np.diff(np.append(first, len(rep)))
    depth_of = np.arange(len(rep)) - np.repeat(first, length)
    ids = dense_ids(key, depth_of)
    trie = packed(ids, first, length)
    size = trie.end
    count, conv = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    upto, label = np.zeros(size, np.int64), np.zeros(size, np.int64)  # a row of the node's turn
    ends, end_n = np.zeros(size, np.int64), np.zeros(size, np.int64)
    levels, state, live, d = [], np.zeros(len(first), np.int64), np.arange(len(first)), 0
    while len(live):  # the members of each node, by walking all classes through the arrays
        at = state[live]
        np.add.at(count, at, n[first[live]])
        np.minimum.at(conv, at, rep[first[live]])
        np.maximum.at(upto, at, cut[first[live]])
        levels.append(np.unique(at))
        over = length[live] == d
        ends[at[over]], end_n[at[over]] = rep[first[live[over]]], n[first[live[over]]]
        live = live[~over]
        if len(live):
            state[live] = trie.step(state[live], ids[first[live] + d])
            label[state[live]] = first[live] + d
        d += 1
    nodes = np.concatenate(levels)
    depth = np.zeros(size, np.int64)
    depth[nodes] = np.repeat(np.arange(len(levels)), [len(x) for x in levels])
    upper = depth < upto
    parent = trie.check[:size]
    below = nodes[1:]
    children = np.bincount(parent[below][~upper[below]], minlength=size)
    leaves = np.where(upper, 0, children == 0).astype(np.int64)
    own = np.where(depth > 0, (count - 1) * words[label], 0)
    total = np.where(upper, 0, own)
    for level in levels[:0:-1]:
        low = level[~upper[level]]
        np.add.at(leaves, parent[low], leaves[low])
        np.add.at(total, parent[low], total[low])
    chain: dict[int, tuple[bytes, ...]] = {}  # an upper node's fingerprints from the root down
    for s in nodes[upper[nodes]].tolist():
        chain[s] = (b"",) if s == 0 else (*chain[int(parent[s])], hashlib.md5(chain[int(parent[s])][-1] + key[label[s]].tobytes()).digest())
    shared = [s in chain for s in nodes.tolist()]
    by_parent = [None if s == 0 else chain.get(p) for s, p in zip(nodes.tolist(), parent[nodes].tolist())]
    inside = ~upper[parent[nodes]]
    return pa.RecordBatch.from_arrays([
        pa.array([chain[s][-1] if x else None for s, x in zip(nodes.tolist(), shared)], pa.binary()),
        pa.array([c[-1] if c else None for c in by_parent], pa.binary()),
        pa.array([list(chain[s][:-1]) if x else None for s, x in zip(nodes.tolist(), shared)], pa.list_(pa.binary())),
        pa.array(depth[nodes].astype(np.int32)), pa.array(conv[nodes]), pa.array(conv[parent[nodes]], mask=~inside),
        pa.array(count[nodes]), pa.array(children[nodes].astype(np.int64)), pa.array(leaves[nodes]), pa.array(total[nodes]),
        pa.array(np.where(nodes == 0, 0, words[label[nodes]])), pa.array(ends[nodes], mask=end_n[nodes] == 0), pa.array(end_n[nodes], mask=end_n[nodes] == 0)], schema=_OUT)


def _tries(chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(table: pa.Table):
            t = table.combine_chunks()
            key = np.frombuffer(b"".join(t.column("key").to_pylist()), "V16")
            return trie_rows(*(t.column(c).to_numpy().astype(np.int64) for c in ("rep", "n", "cut")), key, t.column("words").to_numpy().astype(np.int64))

        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for b in batches:
            if not b.num_rows:
                continue
            g = np.stack((b.column("a").to_numpy(), b.column("b").to_numpy()), axis=1)
            change = np.flatnonzero((g[1:] != g[:-1]).any(axis=1)) + 1
            if last is not None and tuple(g[0]) != last:
                change = np.insert(change, 0, 0)
            last = tuple(g[-1])
            if len(change) and size + int(change[-1]) >= chunk:
                at = int(change[-1])
                yield made(pa.Table.from_batches([*held, b.slice(0, at)]))
                held, size, b = [], 0, b.slice(at)
            held.append(b)
            size += b.num_rows
        if size:
            yield made(pa.Table.from_batches(held))
    return run


# --- groups of classes ---------------------------------------------------------------------
def _fingerprint(p: str, key: str) -> list:
    """Two words that stand for a set of numbered turns, whatever the order of the rows."""
    return [F.bit_xor(F.xxhash64(F.col(p), F.col(key))).alias("a"), F.bit_xor(F.xxhash64(F.lit("b"), F.col(key), F.col(p))).alias("b")]


def grouped(rows: DataFrame, classes: DataFrame, limit: int = GROUP_TURNS) -> DataFrame:
    """(rep, cut, a, b): the group of each class (rep, length > 0) by its first
    ``cut`` turns, ``cut`` doubled until a group has at most ``limit`` turns or
    one class. A class that is shorter than that is a group of its own."""
    out, cut, active = None, 1, classes.where("length > 0").select("rep", "length")
    while True:
        head = rows.where(F.col("p") < cut).join(active, "rep").groupBy("rep", "length").agg(*_fingerprint("p", "key"))
        head = saved(head.withColumn("short", F.least("length", F.lit(cut))), "prefixes")
        sizes = saved(head.groupBy("a", "b", "short").agg(F.sum("length").alias("turns"), F.count("*").alias("n")), "groups")
        large = sizes.where(f"turns > {int(limit)} and n > 1").select("a", "b", "short")
        small = head.join(large, ["a", "b", "short"], "left_anti").select("rep", F.lit(cut).alias("cut"), "a", "b")
        out = small if out is None else out.unionByName(small)
        if not large.limit(1).count():
            return out
        active = saved(head.join(large, ["a", "b", "short"], "left_semi").select("rep", "length"), "active")
        cut *= 2


def _blocks(batches):
    def text(rep, ids):
        for lo in range(0, len(ids), BLOCK_IDS):
            part = ids[lo:lo + BLOCK_IDS]
            yield rep, part[0], ",".join(map(str, part))

    for b in batches:
        if not b.num_rows:
            continue
        rep, ids = b.column("rep").to_numpy(), b.column("conv_id").to_pylist()
        cuts = [0, *(np.flatnonzero(rep[1:] != rep[:-1]) + 1).tolist(), len(ids)]
        out = [x for lo, hi in zip(cuts, cuts[1:]) for x in text(int(rep[lo]), ids[lo:hi])]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))], ["rep", "first", "ids"])


def _digests(batches):
    now, h = None, None
    for b in batches:
        out = []
        for rep, ids in zip(b.column("rep").to_pylist(), b.column("ids").to_pylist()):
            if rep != now:
                if h is not None:
                    out.append((now, h.hexdigest()))
                now, h = rep, hashlib.sha256(ids.encode())
            else:
                h.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())], ["end_id", "digest"])
    if h is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([h.hexdigest()], pa.string())], ["end_id", "digest"])


def id_digests(members: DataFrame) -> DataFrame:
    """(end_id, digest): SHA-256 of the comma-joined ids of each class, in
    order. Ids of a large class are sorted and packed in many tasks; the one
    that makes the digest reads blocks and holds one at a time."""
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = mapped(members.repartitionByRange(n, "rep", "conv_id").sortWithinPartitions("rep", "conv_id"), _blocks, "rep bigint, first bigint, ids string")
    return blocks.repartition(n, "rep").sortWithinPartitions("rep", "first").mapInArrow(_digests, "end_id bigint, digest string")


# --- the operator ----------------------------------------------------------------------------
def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, p (from 0), key, words: a thin row a turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), F.unhex(key).alias("key"),
                                                             F.regexp_count(text, F.lit(WORD)).cast("int").alias("words"))
    return dense_index(rows, ["turn", "key"], "p", ["conv_id"]).select("conv_id", F.col("p").cast("int").alias("p"), "key", "words")


def prefix_trie(rows: DataFrame, ids: DataFrame, group_turns: int = GROUP_TURNS, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """The nodes of the trie of conversations. ``rows``: conv_id, p (from 0
    without gaps), key (16 bytes), words; ``ids``: conv_id of every conversation,
    those without a turn too. One row a node: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = rows.sparkSession
    print_ = rows.groupBy("conv_id").agg(*_fingerprint("p", "key"), F.count("*").alias("length"))
    member = ids.join(print_, "conv_id", "left").withColumn("length", F.coalesce("length", F.lit(0)))
    member = saved(member, "conversations")
    classes = saved(member.groupBy("a", "b", "length").agg(F.min("conv_id").alias("rep"), F.count("*").alias("n")), "sequences")
    turns = saved(rows.join(classes.select(F.col("rep").alias("conv_id")), "conv_id", "left_semi").withColumnRenamed("conv_id", "rep"), "turns")
    dealt = grouped(turns, classes, group_turns).join(classes.select("rep", "n"), "rep")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.join(dealt, "rep").repartition(parts, "a", "b").sortWithinPartitions("a", "b", "rep", "p").select("a", "b", "rep", "n", "cut", "key", "words")
    made = saved(mapped(dealt, _tries(chunk_turns), _OUT_SQL), "trie")

    empty = F.lit(b"")
    bare = classes.where("length = 0").select(empty.alias("fp"), F.lit(0).alias("depth"), F.col("rep").alias("conv_id"), F.col("n").alias("n_convs"),
                                              F.col("rep").alias("end_id"), F.col("n").alias("end_n"))
    upper = made.where("fp is not null").unionByName(bare, allowMissingColumns=True).groupBy("fp").agg(
        F.max("parent_fp").alias("parent_fp"), F.max(F.coalesce("above", F.array().cast("array<binary>"))).alias("above"), F.min("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_children", "n_leaves", "saved")],
        F.coalesce(F.max("words"), F.lit(0)).alias("words"), F.max("end_id").alias("end_id"), F.max("end_n").alias("end_n"))
    upper = saved(upper, "upper")
    kids = upper.where("parent_fp is not null").groupBy(F.col("parent_fp").alias("fp")).agg(F.count("*").alias("more"))
    upper = upper.join(kids, "fp", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    # what each upper node adds to itself and to all above it
    gives = upper.select(F.explode(F.concat("above", F.array("fp"))).alias("fp"), (F.col("saved") + (F.col("n_convs") - 1) * F.col("words")).alias("saved"),
                         (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"))
    upper = upper.drop("saved", "n_leaves", "more").join(gives.groupBy("fp").agg(F.sum("saved").alias("saved"), F.sum("n_leaves").alias("n_leaves")), "fp")
    upper = saved(upper, "upper-sums")
    of = upper.where("depth > 0").select(F.col("fp").alias("parent_fp"), F.col("conv_id").alias("_parent"))
    root = upper.where("depth = 0").select("conv_id").first()  # one number
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "end_id", "end_n"]

    def parented(df: DataFrame) -> DataFrame:
        """Nodes right below an upper node: its smallest member, as known by now."""
        top = df.where("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(root[0] if root else None).cast("long")))
        return top.select(*cols).unionByName(df.where("depth > 1").join(of, "parent_fp", "left").withColumn("parent_conv_id", F.col("_parent")).select(*cols))

    low = made.where("fp is null")
    nodes = parented(upper.withColumn("parent_conv_id", F.lit(None).cast("long"))).unionByName(parented(low.where("parent_fp is not null"))).unionByName(low.where("parent_fp is null").select(*cols))
    copies = classes.where("n > 1").select(F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("length").alias("_length"), "rep")
    copies = member.join(copies, member["a"].eqNullSafe(F.col("_a")) & member["b"].eqNullSafe(F.col("_b")) & (F.col("length") == F.col("_length")))
    digest = saved(id_digests(copies.select("rep", "conv_id")), "digests")
    alone = F.when(F.col("end_n") == 1, F.sha2(F.col("end_id").cast("string"), 256)).otherwise(F.sha2(F.lit(""), 256))
    many = F.coalesce("end_n", F.lit(0)) > 1
    out = nodes.where(~many).withColumn("ends_sha256", alone).unionByName(nodes.where(many).join(digest, "end_id").select(*cols, F.col("digest").alias("ends_sha256")))
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")


def rebuilt(turns: DataFrame, block: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(rows, ids) of conversations put on shared heads: conversation c begins
    with the first h turns of c - c % block and goes on with its own after the
    first h; h = crc32(decimal c) % most."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    ids = saved(turns.select("conv_id").distinct().select("conv_id", h.cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % block).alias("base")), "ids")
    heads = turns.where((F.col("conv_id") % block == 0) & (F.col("p") < most - 1)).select(F.col("conv_id").alias("base"), "p", "key", "words")
    head = ids.join(heads, "base").where("p < h").select("conv_id", "p", "key", "words")
    start = ids.join(heads.groupBy("base").agg(F.count("*").alias("there")), "base", "left").select("conv_id", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("start"))
    own = turns.join(start, "conv_id").where("p >= h").select("conv_id", (F.col("p") - F.col("h") + F.col("start")).cast("int").alias("p"), "key", "words")
    return head.unionByName(own), ids.select("conv_id")


# crc32 of the decimal id, bit by bit
_CRC = ("list_reduce(list_concat([CAST(4294967295 AS UBIGINT)], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS UBIGINT))), "
        "lambda s, x: list_reduce(list_concat([xor(s, x)], CAST(range(8) AS UBIGINT[])), lambda u, k: xor(u >> 1, CASE WHEN u % 2 = 1 THEN CAST(3988292384 AS UBIGINT) ELSE CAST(0 AS UBIGINT) END)))")
ORACLE = f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, xor({_CRC}, CAST(4294967295 AS UBIGINT)) % 4 AS h FROM (SELECT DISTINCT c FROM t)),
parts AS (
  SELECT ids.c, 0 AS part, t.p, r, x FROM ids JOIN t ON t.c = ids.c - ids.c % 20 WHERE t.p < h
  UNION ALL
  SELECT ids.c, 1, t.p, r, x FROM ids JOIN t ON t.c = ids.c WHERE t.p >= h),
seq AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, p) AS d, md5(CAST(length(r) AS VARCHAR) || ':' || r || x) AS k,
               len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS words FROM parts),
pre AS (
  SELECT c, d, words, string_agg(k, '') OVER (PARTITION BY c ORDER BY d) AS path FROM seq
  UNION ALL SELECT c, 0, 0, '' FROM ids),
own_len AS (SELECT c, max(d) AS n FROM pre GROUP BY c),
node AS (
  SELECT path, min(d) AS depth, min(pre.c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saves,
         sha256(coalesce(string_agg(CAST(pre.c AS VARCHAR), ',' ORDER BY pre.c) FILTER (WHERE own_len.n = d), '')) AS ends_sha256
  FROM pre JOIN own_len ON own_len.c = pre.c GROUP BY path),
kid AS (SELECT a.path, count(b.path) AS n_children, any_value(up.conv_id) AS parent_conv_id
        FROM node a LEFT JOIN node b ON b.depth = a.depth + 1 AND b.path[:len(a.path)] = a.path
        LEFT JOIN node up ON a.depth > 0 AND up.path = a.path[:len(a.path) - 32] GROUP BY a.path),
below AS (
  SELECT pre.path, sum(node.saves) AS saved_tokens, count(*) FILTER (WHERE kid.n_children = 0) AS n_leaves
  FROM node JOIN kid ON kid.path = node.path JOIN pre ON pre.c = node.conv_id AND pre.d <= node.depth GROUP BY pre.path)
SELECT node.conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM node JOIN kid ON kid.path = node.path JOIN below ON below.path = node.path"""


@query("op12_conversation_trie", ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = saved(turn_rows(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "conversation-turns")
    rows, ids = rebuilt(turns)
    return prefix_trie(saved(rows, "rebuilt"), ids)
