"""Operator 8: language-model scores from a hierarchical Pitman-Yor model.

Each word is a context: the words behind it sit in its restaurant, the first
words of texts in that of the end. All contexts share one parent, the word
restaurant; every table of a context is a customer of it. Below it stands a
spelling model: tables of the word restaurant are labelled by spellings, drawn
byte by byte from context restaurants of the last bytes of a word.

Seatings are sampled by Gibbs sweeps: given the word restaurant's probabilities
and each context's tables, the customers of all pairs are seated anew; then
those of the word restaurant by the spelling model, then the spellings. The
predictive probabilities of the sweeps behind the burn-in are averaged.

Scale. Text is read in blocks of about BLOCK bytes. Rows that travel are packed:
one for each block and bucket, holding number arrays. Words are dealt to buckets
by hash; a word's number is its rank in its bucket. Pairs (context, word) are
dealt to a grid, by context and by word, so a frequent context (or word) is
spread over a row (column) of the grid. A pair counted once has one table and is
only counted; the others are seated each sweep by what the words' buckets
send to their row and column. A block gets back the counts of its pairs and the
words' states, and seats its own pairs again by the same draws. The number of
buckets follows the words and tokens, PER_BUCKET of them each.

``score`` has the events of the base score: the words of the training texts,
and "any other word", whose probability is what the word restaurant leaves to
new tables times the spellings no known word has. ``open_score`` spells such
words out.

Spelling contexts are folded to 16 bits, so that model has a bound whatever the
corpus and is sent to all tasks; word contexts are not folded.

The end of a text is the empty word. Its spelling has the first symbol "end".

Defined results: null text has the one token "end"; a null id counts as the
empty string in the split; repeated rows are counted and scored each on its
own; with no training text all counts are 0 and the model is its prior; an
empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm.common import LOWER, PIECE, documents, mapped, mixed, saved, span_hashes, steps, text_bytes, word_bounds
from threadlens.llm.registry import query

BLOCK = 4 << 20
PER_BUCKET = 1 << 20                # words or tokens of blocks that a bucket is meant for
BLOCKS_A_TASK = 1                   # blocks whose rows meet their answers in one task
SWEEPS, BURN_IN = 3, 1
CONTEXT_STRENGTH = 1.0              # theta of the word contexts
STRENGTH = 20.0                     # theta of the word restaurant
DISCOUNTS = (0.3, 0.5, 0.6, 0.7)    # of the context restaurants, by bytes of context
STRENGTHS = (1.0, 1.0, 1.0, 1.0)
END = 256                           # symbol behind the last byte of a word
N_SYMBOLS = 257
HELD_OUT = 1                        # crc32(id) mod 5 of the documents not learned from


# --- seatings ----------------------------------------------------------------

def uniform(x: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on x and salt only, so a task that is run
    again draws the same."""
    return (mixed(x ^ np.uint64((salt * 0x9E3779B97F4A7C15 + 0x1234567) & (2**64 - 1))) >> np.uint64(11)).astype(np.float64) / 2.0**53 + 2.0**-54


def seated(c: np.ndarray, q: np.ndarray, weight: np.ndarray | float, d: float, key: np.ndarray, salt: int) -> np.ndarray:
    """Tables of dishes with c customers each, seated one after another: a
    customer opens a table in proportion to ``weight`` (theta + d * tables of
    the restaurant) times the parent's q, and joins one in proportion to the
    customers of the dish less d for each of its tables. From the 64th on
    customers are seated in groups a tenth as large as those already there."""
    t = np.minimum(c, 1).astype(np.float64)
    many = np.flatnonzero(c > 1)
    many = many[np.argsort(-c[many], kind="stable")]  # who has customers left is a leading part
    left, ws, keys, ts = c[many], np.broadcast_to(weight * q, c.shape)[many], key[many], t[many]
    seated_, step, no, m = 1.0, 1.0, 0, len(many)
    while m:
        w, tables = ws[:m], ts[:m]
        p = w / (w + seated_ + (step - 1) / 2 - d * tables)
        u = uniform(keys[:m], salt + 7919 * no)
        if step == 1.0:
            tables += u < p
        else:  # a group: binomial by its normal limit
            here = np.minimum(step, left[:m] - seated_)
            mean, sd = here * p, np.sqrt(here * p * (1 - p))
            u2 = uniform(keys[:m], salt + 7919 * no + 13)
            z = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * u2)
            tables += np.clip(np.rint(mean + sd * z), 0, here)
        seated_ += step
        step = 1.0 if seated_ < 64 else float(int(seated_ * 0.1))
        no += 1
        m = int(np.searchsorted(-left[:m], -seated_, "left"))
    t[many] = ts
    return np.minimum(t, c)


# --- spelling ------------------------------------------------------------------

def spelled(offs: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context of three bytes, symbol, word) of each byte of the words and
    their ends. A context is 16 bits: the last byte, 5 bits of the one before,
    3 bits of the one before that; its parents are its lower 13, 8, 0 bits."""
    lens = np.diff(offs)
    word = np.repeat(np.arange(len(lens)), lens + 1)
    first = np.concatenate(([0], np.cumsum(lens + 1)))[:-1]
    sym = np.full(len(word), END, np.int64)
    inside = np.ones(len(word), bool)
    inside[np.concatenate((first[1:], [len(word)])) - 1] = False
    sym[inside] = raw
    place = np.arange(len(word)) - first[word]
    last = np.where(sym == END, 0, sym)

    def back(k):
        x = np.zeros(len(word), np.int64)
        x[k:] = last[:-k]
        x[place < k] = 0
        return x

    return back(1) | (back(2) & 31) << 8 | (back(3) & 7) << 13, sym, word


BITS = (0, 8, 13, 16)


class Spelling:
    """Predictive probabilities of the context restaurants: for each length of
    context the cells (context, symbol) and per context the share left to the
    parent."""

    def __init__(self, cells=None):
        self.cells = cells or []  # per level: keys, value (c - d t) / (theta + c.), contexts, rest

    def prob(self, ctx: np.ndarray, sym: np.ndarray) -> np.ndarray:
        p = np.full(len(sym), 1.0 / N_SYMBOLS)
        for level, (keys, value, ctxs, rest) in enumerate(self.cells):
            at = ctx & ((1 << BITS[level]) - 1)
            k = at * N_SYMBOLS + sym
            i = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
            own = np.where(keys[i] == k, value[i], 0.0)
            j = np.minimum(np.searchsorted(ctxs, at), len(ctxs) - 1)
            p = own + np.where(ctxs[j] == at, rest[j], 1.0) * p
        return p

    def words(self, offs, raw) -> np.ndarray:
        """log of the probability of each spelling."""
        ctx, sym, word = spelled(offs, raw)
        return np.bincount(word, np.log(self.prob(ctx, sym)), len(offs) - 1)

    @staticmethod
    def sampled(ctx: np.ndarray, sym: np.ndarray, count: np.ndarray, salt: int, before: "Spelling") -> "Spelling":
        """One Gibbs sweep: the customers of the longest contexts are given;
        each level is seated by the parent's probabilities of the last sweep
        and sends its tables down as customers."""
        levels = []
        for level in range(len(BITS) - 1, -1, -1):
            at = ctx & ((1 << BITS[level]) - 1)
            keys, inv = np.unique(at * N_SYMBOLS + sym, return_inverse=True)
            c = np.bincount(inv, count)
            ctxs, ci = np.unique(keys // N_SYMBOLS, return_inverse=True)
            d, theta = DISCOUNTS[level], STRENGTHS[level]
            parent = Spelling(before.cells[:level])
            q = parent.prob(keys // N_SYMBOLS, keys % N_SYMBOLS)
            # tables of the restaurant as if each dish had one; then as sampled
            tables = np.bincount(ci, np.ones(len(keys)))
            for again in range(2):
                t = seated(c, q, theta + d * tables[ci], d, keys.astype(np.uint64), salt + 101 * level + again)
                tables = np.bincount(ci, t)
            total = np.bincount(ci, c)
            levels.append((keys, (c - d * t) / (theta + total[ci]), ctxs, (theta + d * tables) / (theta + total)))
            ctx, sym, count = keys // N_SYMBOLS, keys % N_SYMBOLS, t
        return Spelling(levels[::-1])


# --- packed rows ---------------------------------------------------------------

def planes(x: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as the largest needs, all lowest bytes
    first, compressed; before them the width and how many numbers there are."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    raw = np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return bytes([width]) + len(x).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def numbers(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[1:9], "little")
    raw = np.frombuffer(pa.decompress(pa.py_buffer(b)[9:], decompressed_size=b[0] * n, codec="zstd"), np.uint8).reshape(b[0], n)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :b[0]] = raw.T
    return out.view("<i8").ravel()


def bits(x: np.ndarray) -> bytes:
    """Floats as planes of their bits: signs, exponents and what repeats shrink,
    and every number comes back as it was."""
    return planes(np.ascontiguousarray(x).view(f"<u{x.dtype.itemsize}").ravel())


def floats(b: bytes, kind) -> np.ndarray:
    return numbers(b).astype(f"<u{np.dtype(kind).itemsize}").view(kind)


_SPELLINGS = pa.Codec("zstd", compression_level=3)


def squeezed(words: bytes) -> bytes:
    """Spellings one after another as they travel; their lengths tell how many bytes come back."""
    return _SPELLINGS.compress(words, asbytes=True) if words else b""


def ranked(c: np.ndarray, gid: np.ndarray) -> bytes:
    """Counts in the order of the words' numbers: these are ranks by count, so
    what is written are the steps down from the count before."""
    c = c[np.argsort(gid)]
    return planes(np.concatenate((c[:1], c[:-1] - c[1:])))


def counts_of(b: bytes, gid: np.ndarray) -> np.ndarray:
    steps_down = numbers(b)
    c = np.empty(len(gid), np.int64)
    c[np.argsort(gid)] = 2 * steps_down[:1].sum() - np.cumsum(steps_down)
    return c


def part(gid: np.ndarray, n: int) -> np.ndarray:
    return (mixed(gid.astype(np.uint64)) % np.uint64(n)).astype(np.int64)


def dealt(dest: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by destination, and where each of the n begins and ends in it."""
    order = np.argsort(dest, kind="stable")
    return order, np.searchsorted(dest[order], np.arange(n + 1))


def batch_of(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def word_bytes(row) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of packed words."""
    offs = np.concatenate(([0], np.cumsum(numbers(row["lens"]))))
    raw = _SPELLINGS.decompress(row["words"], int(offs[-1]), asbytes=True) if row["words"] else b""
    return np.frombuffer(raw, np.uint8), offs


def word_places(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, hashes) of packed words."""
    raw, offs = word_bytes(row)
    return raw, offs, span_hashes(raw, offs[:-1], offs[1:]) if len(raw) else np.zeros(len(offs) - 1, np.uint64)


def picked(raw: np.ndarray, offs: np.ndarray, order: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words in another order: their bytes and offsets."""
    a = pa.Array.from_buffers(pa.large_binary(), len(offs) - 1, [None, pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(raw.tobytes())]).take(pa.array(order))
    out, data = text_bytes(a)[::-1]
    return data.tobytes(), out


def each(batch: pa.RecordBatch):
    """Rows one at a time: a block's row is megabytes, and what it took goes back."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]
        pa.default_memory_pool().release_unused()


def rows_of(table: pa.Table, by: str) -> list[dict]:
    return sorted(table.to_pylist(), key=lambda r: r[by])


def schema_of(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in ddl.split(", "))])


# --- blocks --------------------------------------------------------------------

_BLOCKS = "block string, ids array<{id}>, held array<boolean>, sizes array<int>, toks binary, words binary, lens binary, c binary, n_words bigint, n_tokens bigint"


def _blocks(most: int):
    """Documents -> one row a block: its tokens as numbers in order, most
    frequent words first, with the spellings and training counts of its words."""
    def run(batches):
        from pyspark import TaskContext

        task, no = TaskContext.get().partitionId(), 0
        for batch in batches:
            for b in steps(batch, most=most):
                raw, parts = b"", []
                for piece in steps(b, most=PIECE):
                    buf, offs = text_bytes(piece.column("text"))
                    buf = LOWER[buf]
                    starts, ends, at = word_bounds(buf, offs)
                    parts.append((np.insert(span_hashes(buf, starts, ends), at[1:], np.uint64(0)),  # 0: the end
                                  np.insert(starts + len(raw), at[1:], 0), np.insert(ends + len(raw), at[1:], 0), np.diff(at) + 1))
                    raw += buf.tobytes()
                h, starts, ends, sizes = (np.concatenate(x) for x in zip(*parts))
                held = b.column("held").to_numpy(zero_copy_only=False).astype(bool)
                u, first, inv, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                order = np.argsort(-n, kind="stable")
                lid = np.empty(len(u), np.int64)
                lid[order] = np.arange(len(u))
                toks = lid[inv]
                c = np.bincount(toks, np.repeat(~held, sizes), len(u))
                lo, hi = starts[first[order]], ends[first[order]]
                row = {"block": [f"{task}-{no}"], "ids": pa.array([b.column("doc_id").to_pylist()], pa.list_(batch.schema.field("doc_id").type)), "held": [held.tolist()],
                       "sizes": pa.array([sizes.tolist()], pa.list_(pa.int32())), "toks": [planes(toks)], "words": [squeezed(b"".join(raw[i:j] for i, j in zip(lo.tolist(), hi.tolist())))],
                       "lens": [planes(hi - lo)], "c": [planes(c)], "n_words": [len(u)], "n_tokens": [len(toks)]}
                no += 1
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.binary()) if k in ("toks", "words", "lens", "c") else pa.array(v) if isinstance(v, list) else v for k, v in row.items()], list(row))
    return run


# --- words ---------------------------------------------------------------------

_SENT = "bucket int, block string, words binary, lens binary, c binary, at binary"
_NAMED = "bucket int, block string, words binary, lens binary, c binary, gids binary, at binary, known bigint, once bigint, twice bigint, customers bigint"


def _send_words(k: int):
    schema = schema_of(_SENT)

    def run(batches):
        for b in batches:
            for r in each(b):
                raw, offs, h = word_places(r)
                order, cut = dealt((h % np.uint64(k)).astype(np.int64), k)
                data, offs = picked(raw, offs, order)
                c, lens = numbers(r["c"])[order], np.diff(offs)
                yield batch_of(schema, [{"bucket": i, "block": r["block"], "words": squeezed(data[offs[lo]:offs[hi]]), "lens": planes(lens[lo:hi]), "c": planes(c[lo:hi]), "at": planes(np.diff(order[lo:hi], prepend=0))}
                                        for i, (lo, hi) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())) if hi > lo])
    return run


def _name(k: int):
    """A bucket's words -> one row of all its words by rank, and to each block
    the numbers (rank * k + bucket) and counts of its own, with their places in it."""
    schema = schema_of(_NAMED)

    def run(key, table):
        bucket, rows = key[0].as_py(), rows_of(table, "block")
        got = [word_places(r) for r in rows]
        raw = np.concatenate([g[0] for g in got])
        lens = np.concatenate([np.diff(g[1]) for g in got])
        u, first, inv = np.unique(np.concatenate([g[2] for g in got]), return_index=True, return_inverse=True)
        c = np.bincount(inv, np.concatenate([numbers(r["c"]) for r in rows]), len(u)).astype(np.int64)
        order = np.lexsort((u, -c))
        rank = np.empty(len(u), np.int64)
        rank[order] = np.arange(len(u))
        data, offs = picked(raw, np.concatenate(([0], np.cumsum(lens))), first[order])
        out = [{"bucket": bucket, "words": squeezed(data), "lens": planes(np.diff(offs)), "c": planes(c[order]), "known": int((c > 0).sum()),
                "once": int((c == 1).sum()), "twice": int((c == 2).sum()), "customers": int(c.sum())}]
        gid, at = rank[inv] * k + bucket, 0
        for r, g in zip(rows, got):
            n = len(g[2])
            out.append({"bucket": bucket, "block": r["block"], "gids": planes(gid[at:at + n]), "c": ranked(c[inv[at:at + n]], gid[at:at + n]), "at": r["at"]})
            at += n
        return pa.Table.from_pylist(out, schema)
    return run


# --- pairs ---------------------------------------------------------------------

_PAIRS = "bucket int, block string, x binary, w binary, c binary"
_COUNTED = "bucket int, block string, x binary, w binary, c binary, dest int, gid binary, tw binary, tx binary, more int, once bigint, twice bigint"
_WORDS = "bucket int, words binary, lens binary, c binary, ow binary, ox binary, need binary"


def block_words(r) -> np.ndarray:
    """The words of a block in the order of the buckets' answers."""
    return np.concatenate([np.cumsum(numbers(x["at"])) for x in sorted(r["lex"], key=lambda x: x["bucket"])])


def block_pairs(r, gid: np.ndarray, grid: int):
    """(index of the pair of each token, local context, local word, training
    count of the pairs, their order by bucket, context and word, the bounds)."""
    cur = numbers(r["toks"])
    n = len(gid)
    u, inv = np.unique(np.roll(cur, 1) * n + cur, return_inverse=True)  # a block ends with an end
    lx, lw = u // n, u % n
    c = np.bincount(inv, np.repeat(~np.array(r["held"], bool), r["sizes"]), len(u)).astype(np.int64)
    bucket = part(gid, grid)[lx] * grid + part(gid, grid)[lw]
    rank = np.empty(n, np.int64)
    rank[np.argsort(gid)] = np.arange(n)
    order = np.argsort((bucket * n + rank[lx]) * n + rank[lw]) if grid * grid * n * n < 2**62 else np.lexsort((gid[lw], gid[lx], bucket))
    return inv, lx, lw, c, order, np.searchsorted(bucket[order], np.arange(grid * grid + 1))


def block_gids(r) -> tuple[np.ndarray, np.ndarray]:
    order = block_words(r)
    gid, c = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    lex = sorted(r["lex"], key=lambda x: x["bucket"])
    gids = [numbers(x["gids"]) for x in lex]
    gid[order] = np.concatenate(gids)
    c[order] = np.concatenate([counts_of(x["c"], g) for x, g in zip(lex, gids)])
    return gid, c


def _number(grid: int, schema: pa.Schema):
    """Blocks with the buckets' answers -> pairs for the grid."""
    def run(batches):
        for b in batches:
            for r in each(b):
                gid, _ = block_gids(r)
                _, lx, lw, c, order, cut = block_pairs(r, gid, grid)
                x, w, c = gid[lx[order]], gid[lw[order]], c[order]
                for i in np.flatnonzero(np.diff(cut)).tolist():
                    lo, hi = int(cut[i]), int(cut[i + 1])
                    yield batch_of(schema, [{"bucket": i, "block": r["block"], "x": planes(np.diff(x[lo:hi], prepend=0)), "w": planes(w[lo:hi]), "c": planes(c[lo:hi])}])
    return run


def summed(gids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, inv = np.unique(gids, return_inverse=True)
    return u, np.bincount(inv, values, len(u)).astype(np.int64)


def tables_sent(x, w, t, k: int) -> list[dict]:
    """Tables by word (customers of the parent) and by context, to the buckets of the words."""
    gid = np.unique(np.concatenate((x, w)))
    tw, tx = (np.bincount(np.searchsorted(gid, g), t, len(gid)).astype(np.int64) for g in (w, x))
    order, cut = dealt(gid % k, k)
    gid, tw, tx = gid[order], tw[order], tx[order]
    return [{"dest": i, "gid": planes(gid[lo:hi] // k), "tw": planes(tw[lo:hi]), "tx": planes(tx[lo:hi])}
            for i, (lo, hi) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())) if hi > lo]


def _count(k: int):
    """A grid cell's pairs -> counts to the blocks, pairs of two and more as one
    row, tables of the pairs counted once."""
    schema = schema_of(_COUNTED)

    def run(key, table):
        bucket, rows = key[0].as_py(), rows_of(table, "block")
        x, w = np.concatenate([np.cumsum(numbers(r["x"])) for r in rows]), np.concatenate([numbers(r["w"]) for r in rows])
        counts = [numbers(r["c"]) for r in rows]
        c = np.concatenate(counts)
        order = np.lexsort((w, x))
        new = np.ones(len(x), bool)
        new[1:] = (np.diff(x[order]) != 0) | (np.diff(w[order]) != 0)
        inv = np.empty(len(x), np.int64)
        inv[order] = np.cumsum(new) - 1
        total = np.bincount(inv, c).astype(np.int64)
        ux, uw = x[order][new], w[order][new]
        one, more = total == 1, total > 1
        out = [{"bucket": bucket, "x": planes(np.diff(ux[more], prepend=0)), "w": planes(uw[more]), "c": planes(total[more]), "once": int(one.sum()), "twice": int((total == 2).sum())}]
        out += [r | {"more": 0} for r in tables_sent(ux[one], uw[one], np.ones(int(one.sum())), k)]
        out += [r | {"more": 1} for r in tables_sent(ux[more], uw[more], np.zeros(int(more.sum())), k)]
        at = 0
        for r, mine in zip(rows, counts):
            n = len(mine)
            out.append({"bucket": bucket, "block": r["block"], "c": planes(total[inv[at:at + n]])})
            at += n
        return pa.Table.from_pylist(out, schema)
    return run


def _with_ones():
    """A bucket's words with their tables of pairs counted once (as word, as
    context), and the ranks that are in pairs counted more often."""
    schema = schema_of(_WORDS)

    def run(key, words, sent):
        out = []
        for r in words.to_pylist():
            ow, ox, need = (np.zeros(len(numbers(r["c"])), np.int64) for _ in range(3))
            for y in sent.to_pylist():
                at = numbers(y["gid"])
                ow[at] += numbers(y["tw"])
                ox[at] += numbers(y["tx"])
                need[at] |= y["more"]
            out.append(r | {"ow": planes(ow), "ox": planes(ox), "need": planes(np.flatnonzero(need))})
        return pa.Table.from_pylist(out, schema)
    return run


# --- sweeps --------------------------------------------------------------------

class Model:
    """What all tasks know: discounts, customers, tables of the word restaurant
    and the spelling model of each sweep, buckets of words, grid of pairs."""

    def __init__(self, k: int, grid: int, customers: int, d1: float, d2: float):
        self.k, self.grid, self.customers, self.d1, self.d2 = k, grid, customers, d1, d2
        self.spelling, self.mass, self.seats, self.tables = [Spelling()], [0.0], [0.0], [0.0]

    def new(self, s: int) -> float:
        """Share the word restaurant leaves to new tables after sweep s."""
        return (STRENGTH + self.d1 * self.tables[s]) / (STRENGTH + self.seats[s])

    def unknown(self, s: int) -> float:
        return self.new(s) * max(1.0 - self.mass[s], 1e-12)

    def pair_tables(self, s: int, c, x, w, q, t):
        """Tables of pairs in sweep s, by the state q (of the word), t (of the
        context) of the sweep before."""
        key = mixed(x.astype(np.uint64)) ^ w.astype(np.uint64)
        return seated(c.astype(np.float64), q, CONTEXT_STRENGTH + self.d2 * t, self.d2, key, 6_700_417 * s)


_STATE = "bucket int, q binary, t binary, gid binary, sym bigint, ctx bigint, n bigint, seats bigint, tables bigint, mass bigint"


def _send_state(model: Model):
    """Words of the pairs that are seated: probability to their column, tables to their row of the grid."""
    schema, grid = schema_of("bucket int, role int, gid binary, v binary"), model.grid

    def run(batches):
        for b in batches:
            for r in each(b):
                gid, q, t = numbers(r["gid"]) * model.k + r["bucket"], np.frombuffer(r["q"], np.float32), numbers(r["t"])
                order, cut = dealt(part(gid, grid), grid)
                for i in np.flatnonzero(np.diff(cut)).tolist():
                    at = order[cut[i]:cut[i + 1]]
                    g, p, n = planes(gid[at]), bits(q[at]), planes(t[at])
                    yield batch_of(schema, [{"bucket": j * grid + i, "role": 0, "gid": g, "v": p} for j in range(grid)] + [{"bucket": i * grid + j, "role": 1, "gid": g, "v": n} for j in range(grid)])
    return run


def _seat_pairs(model: Model, s: int):
    schema = schema_of("dest int, gid binary, tw binary, tx binary")

    def run(key, pairs, sent):
        out = []
        rows = sent.to_pylist()
        for r in pairs.to_pylist():
            x, w, c = np.cumsum(numbers(r["x"])), numbers(r["w"]), numbers(r["c"])
            if not len(c):
                continue
            vals = []
            for role, want in ((0, w), (1, x)):
                mine = [y for y in rows if y["role"] == role]
                g = np.concatenate([numbers(y["gid"]) for y in mine])
                v = np.concatenate([floats(y["v"], np.float32).astype(np.float64) if role == 0 else numbers(y["v"]).astype(np.float64) for y in mine])
                o = np.argsort(g)
                vals.append(v[o][np.searchsorted(g[o], want)])
            out += tables_sent(x, w, model.pair_tables(s, c, x, w, *vals), model.k)
        return pa.Table.from_pylist(out, schema)
    return run


def _seat_words(model: Model, s: int):
    """A bucket's words and the tables sent to them -> its state after sweep s
    and the customers of the spelling contexts."""
    schema = schema_of(_STATE)

    def run(key, words, sent):
        out = []
        for r in words.to_pylist():
            raw, offs = word_bytes(r)
            n, c0 = len(offs) - 1, numbers(r["c"])
            c, t = numbers(r["ow"]).astype(np.float64), numbers(r["ox"])
            for y in sent.to_pylist():
                at = numbers(y["gid"])
                c[at] += numbers(y["tw"])
                t[at] += numbers(y["tx"])
            lp = model.spelling[s - 1].words(offs, raw)
            h = np.exp(lp)
            # tables in all: as many as the sweep before had (the first: one a word)
            t1 = seated(c, h, STRENGTH + model.d1 * model.tables[s - 1], model.d1, (np.arange(n) * model.k + r["bucket"]).astype(np.uint64), 1_000_003 * s)
            state = {"bucket": r["bucket"], "q": bits(np.concatenate((np.maximum(c - model.d1 * t1, 0), lp))), "t": planes(t), "gid": r["need"],
                     "seats": int(c.sum()), "tables": int(t1.sum()), "mass": int(h[c0 > 0].sum() * 2**50)}
            ctx, sym, word = spelled(offs, raw)
            cells, inv = np.unique(ctx * N_SYMBOLS + sym, return_inverse=True)
            got = np.bincount(inv, t1[word], len(cells)).astype(np.int64)
            on = got > 0
            m = int(on.sum())
            # one row of state, then the spelling customers
            out.append(pa.Table.from_pylist([state], schema))
            out.append(pa.table({"bucket": pa.nulls(m, pa.int32()), "q": pa.nulls(m, pa.binary()), "t": pa.nulls(m, pa.binary()), "gid": pa.nulls(m, pa.binary()), "sym": cells[on] % N_SYMBOLS,
                                 "ctx": cells[on] // N_SYMBOLS, "n": got[on], "seats": pa.nulls(m, pa.int64()), "tables": pa.nulls(m, pa.int64()), "mass": pa.nulls(m, pa.int64())}, schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()
    return run


def _first_state(model: Model):
    """Before the first sweep: probabilities by counts, as many tables as customers."""
    schema = schema_of("bucket int, q binary, t binary, gid binary")

    def run(batches):
        for b in batches:
            for r in each(b):
                c = numbers(r["c"])
                gid = numbers(r["need"])
                yield batch_of(schema, [{"bucket": r["bucket"], "q": (c[gid] / max(1, model.customers)).astype(np.float32).tobytes(), "t": planes(c[gid]), "gid": r["need"]}])
    return run


def q_of(model: Model, s: int, q: bytes) -> np.ndarray:
    """Logs of the probabilities of a bucket's words after sweep s."""
    own, lp = floats(q, np.float64).reshape(2, -1)
    with np.errstate(divide="ignore"):
        return np.logaddexp(np.log(own / (STRENGTH + model.seats[s])), np.log(model.new(s)) + lp)


def _next_state(model: Model, s: int):
    schema = schema_of("bucket int, q binary, t binary, gid binary")

    def run(batches):
        for b in batches:
            for r in each(b):
                gid = numbers(r["gid"])
                yield batch_of(schema, [{"bucket": r["bucket"], "q": np.exp(q_of(model, s, r["q"])[gid]).astype(np.float32).tobytes(), "t": planes(numbers(r["t"])[gid]), "gid": r["gid"]}])
    return run


def discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / max(1, once + 2 * twice)))


def train(model: Model, words: DataFrame, pairs: DataFrame) -> list[DataFrame]:
    """Gibbs sweeps; the stored state of each."""
    states, now = [], mapped(words, _first_state(model), "bucket int, q binary, t binary, gid binary")
    for s in range(1, SWEEPS + 1):
        sent = mapped(now, _send_state(model), "bucket int, role int, gid binary, v binary")
        tables = pairs.groupBy("bucket").cogroup(sent.groupBy("bucket")).applyInArrow(_seat_pairs(model, s), "dest int, gid binary, tw binary, tx binary")
        state = saved(words.groupBy("bucket").cogroup(tables.withColumnRenamed("dest", "bucket").groupBy("bucket")).applyInArrow(_seat_words(model, s), _STATE), "lm-state")
        seats = state.where("q is not null").agg(F.sum("seats"), F.sum("tables"), F.sum("mass")).first()
        model.seats.append(float(seats[0] or 0))
        model.tables.append(float(seats[1] or 0))
        model.mass.append((seats[2] or 0) / 2**50)
        got = state.where("q is null").groupBy("ctx", "sym").agg(F.sum("n").alias("n")).orderBy("ctx", "sym").toArrow()
        ctx, sym, cnt = (got.column(x).to_numpy().astype(np.int64) for x in ("ctx", "sym", "n"))
        model.spelling.append(Spelling.sampled(ctx, sym, cnt.astype(np.float64), 31 * s, model.spelling[-1]) if len(ctx) else Spelling())
        states.append(state.where("q is not null").select("bucket", "q", "t", "gid"))
        now = mapped(states[-1], _next_state(model, s), "bucket int, q binary, t binary, gid binary")
    return states


# --- scores --------------------------------------------------------------------

def _answers(model: Model):
    """A bucket's states of all sweeps -> to each block what its words need."""
    schema = schema_of("block string, bucket int, q binary, t binary")

    def run(key, asked, states):
        rows = rows_of(states, "s")
        q = np.array([q_of(model, r["s"], r["q"]) for r in rows], np.float32)
        t = np.array([numbers(r["t"]) for r in rows])
        out = []
        for r in asked.to_pylist():
            at = numbers(r["gids"]) // model.k
            out.append({"block": r["block"], "bucket": r["bucket"], "q": bits(q[:, at]), "t": planes(t[:, at].ravel())})
        return pa.Table.from_pylist(out, schema)
    return run


def _scored(model: Model, types: int):
    d, theta = model.d2, CONTEXT_STRENGTH

    def run(batches):
        for batch in batches:
            id_type = batch.schema.field("ids").type.value_type
            for r in each(batch):
                gid, c = block_gids(r)
                order = block_words(r)
                q, t = np.empty((SWEEPS, len(gid))), np.empty((SWEEPS, len(gid)))
                state = sorted(r["state"], key=lambda x: x["bucket"])
                q[:, order] = np.concatenate([floats(x["q"], np.float32).reshape(SWEEPS, -1) for x in state], axis=1)
                t[:, order] = np.concatenate([numbers(x["t"]).reshape(SWEEPS, -1) for x in state], axis=1)
                inv, lx, lw, _, by, _ = block_pairs(r, gid, model.grid)
                n = np.empty(len(lx), np.int64)
                n[by] = np.concatenate([numbers(x["c"]) for x in sorted(r["counts"], key=lambda x: x["bucket"])])
                more = np.flatnonzero(n > 1)
                new = np.flatnonzero(c[lw] == 0)
                p, p_open = np.zeros(len(lx)), np.full(len(new), -np.inf)
                for s in range(BURN_IN + 1, SWEEPS + 1):
                    tables = np.minimum(n, 1).astype(np.float64)
                    tables[more] = model.pair_tables(s, n[more], gid[lx[more]], gid[lw[more]], np.exp(q[s - 2]).astype(np.float32)[lw[more]], t[s - 2][lx[more]])
                    own = (n - d * tables) / (theta + c[lx])
                    rest = (theta + d * t[s - 1]) / (theta + c)
                    p += own + rest[lx] * np.where(c > 0, np.exp(q[s - 1]), model.unknown(s))[lw]
                    p_open = np.logaddexp(p_open, np.log(rest[lx[new]]) + q[s - 1][lw[new]])  # of words nobody counted
                lp = np.log10(p / (SWEEPS - BURN_IN))
                lo = lp.copy()
                lo[new] = (p_open - np.log(SWEEPS - BURN_IN)) / np.log(10)
                cur, sizes = numbers(r["toks"]), np.array(r["sizes"])
                base = np.log10((c + 0.5) / (model.customers + 0.5 * (types + 1)))
                first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
                sums = lambda x: np.add.reduceat(x, first)  # noqa: E731  every document has its end
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["ids"], id_type), pa.array(r["held"], pa.bool_()), pa.array(sizes.astype(np.int64)), pa.array(sums((c[cur] > 0).astype(np.int64))),
                     pa.array(np.full(len(sizes), model.customers, np.int64)), pa.array(sums(base[cur])), pa.array(sums(lp[inv])), pa.array(sums(lo[inv]))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "open_score"])
    return run


def lm_scores(docs: DataFrame, block: int = BLOCK, per_bucket: int = PER_BUCKET) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    open_score, perplexity of every document."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == HELD_OUT
    d = docs.select("doc_id", "text", held.alias("held"))
    blocks = saved(mapped(d, _blocks(block), _BLOCKS.format(id=id_type)), "lm-blocks")
    size = blocks.agg(F.sum("n_words"), F.sum("n_tokens"), F.count("*")).first()
    k, grid = -(-(size[0] or 1) // per_bucket), int(np.ceil(np.sqrt((size[1] or 1) / per_bucket)))

    named = saved(mapped(blocks.select("block", "words", "lens", "c"), _send_words(k), _SENT).groupBy("bucket").applyInArrow(_name(k), _NAMED), "lm-words")
    words = named.where("words is not null").select("bucket", "words", "lens", "c")
    asked = named.where("block is not null").select("block", "bucket", "gids", "c", "at")
    met = named.agg(F.sum("customers"), F.sum("known"), F.sum("once"), F.sum("twice")).first()

    lex = asked.groupBy("block").agg(F.collect_list(F.struct("bucket", "gids", "c", "at")).alias("lex"))
    full = blocks.select("block", "ids", "held", "sizes", "toks").repartition(max(1, -(-size[2] // BLOCKS_A_TASK)), "block").join(lex, "block")
    counted = saved(mapped(full.drop("ids"), _number(grid, schema_of(_PAIRS)), _PAIRS).groupBy("bucket").applyInArrow(_count(k), _COUNTED), "lm-pairs")
    pairs = counted.where("x is not null").select("bucket", "x", "w", "c")
    ones = counted.where("dest is not null").select(F.col("dest").alias("bucket"), "gid", "tw", "tx", "more")
    words = saved(words.groupBy("bucket").cogroup(ones.groupBy("bucket")).applyInArrow(_with_ones(), _WORDS), "lm-vocabulary")
    seen = counted.agg(F.sum("once"), F.sum("twice")).first()

    model = Model(k, grid, int(met[0] or 0), discount(met[2] or 0, met[3] or 0), discount(seen[0] or 0, seen[1] or 0))
    states = train(model, words, pairs)
    every = None
    for s, state in enumerate(states, 1):
        one = state.select("bucket", "q", "t", F.lit(s).alias("s"))
        every = one if every is None else every.unionByName(one)
    answers = (asked.select("block", "bucket", "gids").groupBy("bucket").cogroup(every.groupBy("bucket")).applyInArrow(_answers(model), "block string, bucket int, q binary, t binary")
               .groupBy("block").agg(F.collect_list(F.struct("bucket", "q", "t")).alias("state")))
    counts = counted.where("block is not null").groupBy("block").agg(F.collect_list(F.struct("bucket", "c")).alias("counts"))
    out = full.join(answers, "block").join(counts, "block").drop("block").mapInArrow(
        _scored(model, int(met[1] or 0)), f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, open_score double")
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


@query("op8_lm_score")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir))
