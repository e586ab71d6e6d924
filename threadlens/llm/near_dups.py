"""Operator 1: near-duplicates by an LSH forest over MinHash signatures.

A document's set is the hashes of its distinct word shingles; documents with
one and the same set are one class and go on as one. A class has TREES keys of
DEPTH MinHash values. Each tree is the list of all classes sorted by its key,
dealt by range, so a crowded prefix spreads over as many tasks as it needs.
Candidates are neighbours in a sorted list that agree in at least MIN_DEPTH
values: where few classes share a prefix (REACH + 1 at most) all of them are
compared, and where many do each is compared with the next, which has the
longest common prefix, so the depth follows the region. This is done in FIRST
trees; once the links found so far are joined to components, rows of a crowd up
to REACH apart in any tree are compared where they are in two of them.
Neighbours across two partitions meet through the first and last rows of each.
Candidates whose signatures agree far too little are dropped, the others are
confirmed on full sets; components of the links give the groups.

Where more than REACH + 1 classes agree in the MIN_DEPTH leading values of a
tree, a link may stand between rows further apart. All classes of such crowds
are joined exactly: shingles are put in one order, the rarest among the crowded
classes first, and two linked classes share one of the first n - ceil(t n) + 1
of each, at places that leave room for the overlap wanted. Pairs within a
component of the links found so far need no look. A shingle's classes are dealt
in blocks of BLOCK, of which each two meet in a task.

Classes of a crowd carry the parity of their shingles in each of MARKS bins. The
bins in which two sets differ are at most as many as the shingles only one of
them has, so a pair with too many such bins is no link and is not made a row; no
link is dropped by this.

Chance to miss a link of similarity 0.85 in all lists, by depth alone:
(1 - 0.85^3)^16 = 2e-7.

Defined results: a text without words, or null, has an empty set and is linked
with nothing; texts with fewer words than a shingle are one shingle; exact
copies are in one group; a null id stays null and names a group only if no
other id is in it; repeated ids are judged row by row; an empty table gives no
rows; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm.common import LOWER, PIECE, documents, mapped, mixed, saved, span_hashes, steps, text_bytes, word_bounds
from threadlens.llm.graph import components
from threadlens.llm.registry import query

TREES, DEPTH, MIN_DEPTH, REACH, FIRST = 16, 6, 3, 4, 4
HASHES = TREES * DEPTH
BLOCK = 4096  # classes of one shingle that meet as many others in a task
SLICE = 1 << 18  # pairs of two blocks that go out at once
MARKS = 1024  # bins whose parities stand for a set of a crowd
SLACK = 5.5  # standard deviations below the wanted similarity at which signatures still pass

_RNG = np.random.default_rng(7)
_MUL = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64)
_SHINGLE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    buf = LOWER[buf]
    starts, ends, at = word_bounds(buf, offs)
    h = span_hashes(buf, starts, ends)
    n = len(h)
    full = np.zeros(max(0, n - k + 1), np.uint64)
    for i in range(k if n >= k else 0):
        full += h[i:n - k + 1 + i] * _SHINGLE[i]
    full = mixed(full)
    out = []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= k:
            out.append(np.unique(full[a:b - k + 1]))
        elif b > a:
            out.append(mixed(np.array([(h[a:b] * _SHINGLE[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(s: np.ndarray) -> np.ndarray:
    """HASHES MinHash values (32 bits each) of a set."""
    best = np.full(HASHES, 0xFFFFFFFF, np.uint64)
    for lo in range(0, len(s), 4096):
        v = np.multiply.outer(_MUL, s[lo:lo + 4096])
        v += _ADD[:, None]
        v >>= np.uint64(32)
        np.minimum(best, v.min(axis=1), out=best)
    return best.astype(np.uint32)


def set_key(s: np.ndarray) -> bytes:
    """16 bytes that stand for the whole set."""
    a = mixed(s)
    b = mixed(s ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    return np.array([a.sum(dtype=np.uint64) + np.uint64(len(s)), np.bitwise_xor.reduce(b, initial=np.uint64(0))], np.uint64).tobytes()


def marks_of(s: np.ndarray) -> bytes:
    """Whether the shingles in each of MARKS bins are odd in number."""
    return np.packbits((np.bincount((s & s.dtype.type(MARKS - 1)).astype(np.int64), minlength=MARKS) & 1).astype(bool)).tobytes()


def marked(marks: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(marks.to_pylist()), np.uint64).reshape(-1, MARKS // 64)


def room(n, m, marks, other, num: int, den: int) -> np.ndarray:
    """Whether sizes and marks allow a link: shingles that one of two linked sets
    has are at most (n + m) (den - num) / (den + num)."""
    apart = np.bitwise_count(marks ^ other).sum(axis=-1, dtype=np.int64)
    return (np.minimum(n, m) * den >= np.maximum(n, m) * num) & (apart * (den + num) <= (n + m) * (den - num))


def _signed(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in steps(batch, most=PIECE):
                sets = shingle_sets(*text_bytes(b.column("text")), k)
                sig = [signature(s).astype(">u4").tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()), pa.array(sig, pa.binary())],
                    ["doc_id", "n", "node", "sig"])
    return run


def _tree_rows(batches):
    width = 4 * DEPTH
    for batch in batches:
        nodes, sigs = batch.column("node").to_pylist(), batch.column("sig").to_pylist()
        for t in range(TREES):
            yield pa.RecordBatch.from_arrays([pa.array([t] * len(nodes), pa.int32()), pa.array([s[t * width:(t + 1) * width] for s in sigs], pa.binary()), pa.array(nodes, pa.binary())], ["tree", "key", "node"])


def _neighbours(tree: np.ndarray, key: np.ndarray, node: list[bytes]) -> tuple[list, list]:
    """All pairs among rows in sorted order that agree in MIN_DEPTH leading
    values, where at most REACH + 1 rows do (of those at hand); crowds are left
    to ``apart`` and ``beyond``, which joins them exactly."""
    us, vs = [], []
    new = np.concatenate(([True], (tree[1:] != tree[:-1]) | (key[1:, :MIN_DEPTH] != key[:-1, :MIN_DEPTH]).any(axis=1))) if len(node) else np.zeros(0, bool)
    head = np.cumsum(new) - 1
    few = np.bincount(head)[head] <= REACH + 1
    for o in range(1, REACH + 1):
        if len(node) <= o:
            break
        same = head[o:] == head[:-o]
        for i in np.flatnonzero(same & few[o:]):
            a, b = node[i], node[i + o]
            if a != b:
                us.append(min(a, b))
                vs.append(max(a, b))
    return us, vs


def _rows(batch):
    return (batch.column("tree").to_numpy(zero_copy_only=False),
            np.frombuffer(b"".join(batch.column("key").to_pylist()), ">u4").reshape(-1, DEPTH), batch.column("node").to_pylist())


_PAIR = pa.schema([("u", pa.binary()), ("v", pa.binary()), ("edge", pa.bool_()), ("tree", pa.int32()), ("key", pa.binary())])


def _scan(edges: bool):
    """Sorted rows -> candidate pairs, and (``edges``) the first and last REACH
    rows of the partition, for the neighbours in the partitions beside it."""
    def run(batches):
        def pairs(b):
            us, vs = _neighbours(*_rows(b))
            n = len(us)
            return pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary()), pa.array([False] * n), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=_PAIR)

        def edge(b):
            return pa.RecordBatch.from_arrays([b.column("node").cast(pa.binary()), pa.nulls(b.num_rows, pa.binary()), pa.array([True] * b.num_rows), b.column("tree"), b.column("key").cast(pa.binary())], schema=_PAIR)

        kept, begun = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if edges and begun < REACH:
                yield edge(batch.slice(0, REACH - begun))
                begun += min(batch.num_rows, REACH - begun)
            if kept is not None:
                batch = pa.Table.from_batches([kept, batch]).combine_chunks().to_batches()[0]
            yield pairs(batch)
            kept = batch.slice(max(0, batch.num_rows - REACH))
        if edges and kept is not None:
            yield edge(kept)
    return run


def _apart(num: int, den: int, reach: int):
    """Sorted rows of crowded prefixes -> pairs at most ``reach`` rows apart whose
    components (root) differ and whose sizes and marks allow a link."""
    def run(batches):
        kept = None
        for batch in batches:
            if kept is not None:
                batch = pa.Table.from_batches([kept, batch]).combine_chunks().to_batches()[0]
            tree, key, node = _rows(batch)
            n, marks, us, vs = batch.column("n").to_numpy(), marked(batch.column("marks")), [], []
            root = np.array(batch.column("root").to_pylist() + [None], object)[:-1]
            for o in range(1, min(reach, len(node) - 1) + 1):
                ok = (tree[o:] == tree[:-o]) & (key[o:, :MIN_DEPTH] == key[:-o, :MIN_DEPTH]).all(axis=1) & (root[o:] != root[:-o])
                for i in np.flatnonzero(ok & room(n[o:], n[:-o], marks[o:], marks[:-o], num, den)).tolist():
                    us.append(min(node[i], node[i + o]))
                    vs.append(max(node[i], node[i + o]))
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], ["u", "v"])
            kept = batch.slice(max(0, batch.num_rows - reach))
    return run


def apart(crowd: DataFrame, num: int, den: int, reach: int) -> DataFrame:
    """Distinct pairs (u, v) that stand near each other in a crowded prefix (tree,
    key, node, n, marks, root), are in two components so far and may be links."""
    parts = int(crowd.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return crowd.repartitionByRange(parts, "tree", "key", "node").sortWithinPartitions("tree", "key", "node").mapInArrow(_apart(num, den, reach), "u binary, v binary").distinct()


def candidates(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (u, v) of classes that are neighbours in some tree, and
    the rows (tree, key, node) of classes that may have links beyond: more than
    REACH others agree with them in MIN_DEPTH values."""
    spark = classes.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = mapped(classes.select("node", "sig"), _tree_rows, "tree int, key binary, node binary")
    rows = saved(rows, "forest")
    schema = "u binary, v binary, edge boolean, tree int, key binary"
    found = rows.repartitionByRange(n, "tree", "key", "node").sortWithinPartitions("tree", "key", "node").mapInArrow(_scan(True), schema)
    found = saved(found, "neighbours")
    # 2 REACH rows of each partition: bounded by the number of partitions
    seams = found.where("edge").select("tree", "key", F.col("u").alias("node")).distinct().coalesce(1).sortWithinPartitions("tree", "key", "node").mapInArrow(_scan(False), schema)
    pairs = found.where(~F.col("edge")).select("u", "v").unionByName(seams.select("u", "v")).distinct()
    rows = rows.withColumn("head", F.substring("key", 1, 4 * MIN_DEPTH))
    full = rows.groupBy("tree", "head").count().where(F.col("count") > REACH + 1).select("tree", "head")
    return pairs, rows.join(full, ["tree", "head"], "left_semi").drop("head")


def _agree(least: float):
    def run(batches):
        for b in batches:
            if b.num_rows:
                a, c = (np.frombuffer(b"".join(b.column(x).to_pylist()), np.uint32).reshape(-1, HASHES) for x in ("su", "sv"))
                near = (a == c).mean(axis=1) >= least
                yield b.select(["u", "v"]).filter(pa.array(near))
    return run


def _sets(k: int):
    def run(batches):
        for batch in batches:
            for b in steps(batch, most=PIECE):
                sets = shingle_sets(*text_bytes(b.column("text")), k)
                yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary()),
                                                  pa.array([len(s) for s in sets], pa.int64()), pa.array([marks_of(s) for s in sets], pa.binary())], ["node", "set", "n", "marks"])
    return run


def _confirmed(num: int, den: int):
    def run(batches):
        for batch in batches:
            for b in steps(batch, "set_u", also="set_v"):
                ok = []
                for x, y in zip(b.column("set_u"), b.column("set_v")):
                    s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    if len(s) > len(t):
                        s, t = t, s
                    both = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
                    ok.append(den * both >= num * (len(s) + len(t) - both))
                yield b.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))
    return run


def _exploded(batches):
    for batch in batches:
        for b in steps(batch, "set"):
            sets = b.column("set").to_pylist()
            at = np.repeat(np.arange(len(sets)), [len(x) // 8 for x in sets])
            yield pa.RecordBatch.from_arrays([b.column("node").take(pa.array(at)), pa.array(np.frombuffer(b"".join(sets), np.int64))], ["node", "s"])


def _prefixes(num: int, den: int):
    """Shingles of a class with their frequencies -> those of its prefix that
    other classes have, with their places from behind and the class's marks."""
    def run(batches):
        for b in batches:
            who, ss, ns, lefts, marks = [], [], [], [], []
            for i, x in enumerate(b.column("shingles")):
                s, f = (x.values.field(c).to_numpy(zero_copy_only=False) for c in ("s", "f"))
                n = len(s)
                first = np.lexsort((s, f))[:n - -(-num * n // den) + 1]
                at = np.flatnonzero(f[first] > 1)
                who += [i] * len(at)
                ss.append(s[first[at]])
                ns += [n] * len(at)
                lefts.append(n - at)
                marks.append(marks_of(s))
            if who:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ss)), b.column("node").take(pa.array(who)), b.column("root").take(pa.array(who)),
                                                  pa.array(np.array(ns, np.int64)), pa.array(np.concatenate(lefts).astype(np.int64)), pa.array(marks, pa.binary()).take(pa.array(who))],
                                                 ["s", "node", "root", "n", "rest", "marks"])
    return run


def _met(num: int, den: int):
    """Two blocks of one shingle -> pairs of two components whose sizes, places
    and marks leave room for a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()  # at most 2 BLOCK rows
        side, n, rest = (table.column(c).to_numpy() for c in ("side", "n", "rest"))
        marks = marked(table.column("marks"))
        same = table.column("a")[0].as_py() == table.column("b")[0].as_py()
        nodes = table.column("node").to_pylist()
        order = sorted(range(len(nodes)), key=nodes.__getitem__)
        rank = np.empty(len(nodes), np.int64)
        rank[order] = np.arange(len(nodes))
        node = pa.array([nodes[i] for i in order], pa.binary())
        _, root = np.unique(np.array(table.column("root").to_pylist(), object), return_inverse=True)
        left = np.arange(len(n)) if same else np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        us, vs, held = [], [], 0

        def pairs() -> pa.RecordBatch:
            u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
            return pa.RecordBatch.from_arrays([node.take(pa.array(np.minimum(u, v))), node.take(pa.array(np.maximum(u, v)))], ["u", "v"])

        for i in left.tolist():
            j = right[right > i] if same else right
            most = np.minimum(np.minimum(rest[i], rest[j]), np.minimum(n[i], n[j]))
            j = j[(root[j] != root[i]) & (most * (num + den) >= num * (n[i] + n[j]))]
            j = j[room(n[i], n[j], marks[i], marks[j], num, den)]
            us.append(np.full(len(j), rank[i]))
            vs.append(rank[j])
            held += len(j)
            if held >= SLICE:  # a block of 16 million pairs goes out in slices
                yield pairs()
                us, vs, held = [], [], 0
        yield pairs()
    return run


def beyond(crowded: DataFrame, num: int, den: int, block: int = BLOCK) -> DataFrame:
    """Distinct pairs (u, v) of the classes (node, root, set) that may be links
    and are not in one component yet: no link is left out. Of each shingle's
    classes those of the largest component are not compared with each other."""
    rows = saved(crowded.select("node", "set").mapInArrow(_exploded, "node binary, s bigint"), "crowd-shingles")
    often = saved(rows.groupBy("s").agg(F.count("*").alias("f")).where("f > 1"), "crowd-frequencies")
    known = rows.join(often, "s", "left").select("node", F.struct("s", F.coalesce("f", F.lit(1)).alias("f")).alias("x"))
    known = known.groupBy("node").agg(F.collect_list("x").alias("shingles")).join(crowded.select("node", "root"), "node")
    first = saved(known.mapInArrow(_prefixes(num, den), "s bigint, node binary, root binary, n bigint, rest bigint, marks binary"), "crowd-prefixes")
    by_root = first.groupBy("s", "root").agg(F.count("*").alias("m"))
    most = by_root.groupBy("s").agg(F.max(F.struct("m", "root")).alias("x"), F.sum("m").alias("m"))
    most = most.select("s", F.col("x.root").alias("main"), F.ceil(F.col("x.m") / block).cast("int").alias("mains"), F.ceil((F.col("m") - F.col("x.m")) / block).cast("int").alias("others")).where("others > 0")
    met = first.join(saved(most, "crowd-lists"), "s")
    # blocks of the main component have numbers below 0; each meets all other blocks, these meet each other and themselves
    own = F.when(F.col("root") == F.col("main"), -1 - F.pmod(F.xxhash64("node"), F.col("mains"))).otherwise(F.pmod(F.xxhash64("node"), F.col("others"))).cast("int")
    met = met.withColumn("own", own)
    met = met.withColumn("with", F.explode(F.when(F.col("own") < 0, F.sequence(F.lit(0), F.col("others") - 1)).otherwise(F.sequence(-F.col("mains"), F.col("others") - 1))))
    met = met.select("s", F.least("own", "with").alias("a"), F.greatest("own", "with").alias("b"), (F.col("own") > F.col("with")).cast("int").alias("side"), "node", "root", "n", "rest", "marks")
    return met.groupBy("s", "a", "b").applyInArrow(_met(num, den), "u binary, v binary").distinct()


def near_dups(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept. Two documents are linked if
    den * |intersection| >= num * |union| of their k-word shingle sets."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    d = docs.select("doc_id", "text")
    signed = saved(mapped(d, _signed(k), f"doc_id {id_type}, n bigint, node binary, sig binary"), "signatures")
    classes = signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    classes = saved(classes, "classes")
    least = num / den - SLACK * (num / den * (1 - num / den) / HASHES) ** 0.5
    c = classes.select("node", "n", "sig")

    def likely(pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes and signatures allow a link."""
        return (pairs.join(c.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.col("sig").alias("su")), "u")
                .join(c.select(F.col("node").alias("v"), F.col("n").alias("nv"), F.col("sig").alias("sv")), "v")
                .where(F.least("nu", "nv") * den >= F.greatest("nu", "nv") * num)
                .select("u", "v", "su", "sv").mapInArrow(_agree(least), "u binary, v binary"))

    pairs, crowd = candidates(classes)
    pairs, crowd = saved(likely(pairs), "candidates"), saved(crowd, "crowded")
    crowded = crowd.select("node").distinct()
    nodes = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).unionByName(crowded).distinct()
    reps = classes.join(nodes, "node", "left_semi").select(F.col("rep").alias("_rep")).distinct()
    sets = saved(d.join(reps, d["doc_id"].eqNullSafe(reps["_rep"])).select("text").mapInArrow(_sets(k), "node binary, set binary, n bigint, marks binary"), "sets")

    def linked(pairs: DataFrame) -> DataFrame:
        return (pairs.join(sets.select(F.col("node").alias("u"), F.col("set").alias("set_u")), "u")
                .join(sets.select(F.col("node").alias("v"), F.col("set").alias("set_v")), "v")
                .mapInArrow(_confirmed(num, den), "u binary, v binary").distinct())

    if not crowd.limit(1).count():
        roots = saved(components(linked(pairs)), "roots")
    else:
        def also(roots: DataFrame, links: DataFrame) -> DataFrame:
            """The components with more links; what is joined already is one star each."""
            stars = roots.select(F.col("node").alias("u"), F.col("root").alias("v"))
            return saved(components(stars.unionByName(links)), "roots")

        # marks are exact, so candidates in crowds go to their full sets without a look at signatures
        crowd = crowd.join(sets.select("node", "n", "marks").dropDuplicates(["node"]), "node")
        following = saved(apart(crowd.where(F.col("tree") < FIRST).withColumn("root", F.col("node")), num, den, 1), "crowd-next")
        tried = pairs.unionByName(following).distinct()
        roots = saved(components(linked(tried)), "roots")
        rows = crowd.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        wider = saved(apart(rows, num, den, REACH).join(tried, ["u", "v"], "left_anti"), "crowd-neighbours")
        roots = also(roots, linked(wider))
        members = crowded.join(sets, "node").dropDuplicates(["node"]).join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "set")
        more = beyond(saved(members, "crowd"), num, den).join(tried.unionByName(wider), ["u", "v"], "left_anti")
        roots = also(roots, linked(saved(more, "crowd-pairs")))
    grouped = classes.select("node", "rep").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = saved(grouped.groupBy("root").agg(F.min("rep").alias("component")), "components")  # stored: a large group's join can be split
    named = grouped.join(named, "root").select("node", "component")
    out = signed.select("doc_id", "n", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The documents less all but one of each group, all columns as they are.
    Of rows equal in id and text one stays."""
    kept = near_dups(docs, k, num, den).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    out = docs.join(kept, docs["doc_id"].eqNullSafe(kept["__kept"]), "left_semi")
    if docs.groupBy("doc_id").count().where("count > 1").limit(1).count():
        out = out.dropDuplicates(["doc_id", "text"])
    return out


@query("op1_near_dups")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups(documents(spark, sf_dir), k=3, num=85, den=100)
