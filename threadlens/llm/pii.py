"""Operator 7: personal data by a character-level bidirectional LSTM with CRF
transitions, beside fixed patterns.

The patterns (email, ip, card, phone) give the base spans. The model is trained
in numpy on labelled spans: a bounded sample, kind by kind, of the windows
around the base spans of all documents, the same windows with the spans written
in other ways (a card with dots, a phone number without its plus sign, "at" for
"@"), and windows with other numbers from a bounded sample of documents. Documents are tiled by windows of SIZE characters that overlap
by half, decoded by Viterbi; every character takes its tag from the window in
whose middle half it stands, and stretches that meet at a tile's edge are
joined. A span that is accepted holds a digit, an "@" or an "at" in brackets or
between spaces, so decoding begins at the tiles with one of these and goes on
to the tiles beside as long as a stretch reaches their edge: the result is that
of decoding every window. Model spans that overlap a base span are dropped, the
others are added if they have the parts their kind needs.

Defined results: null text is empty and has no spans; overlapping base spans of
two kinds both stay; repeated rows are searched each on its own; without any
base span to learn from the model adds nothing; an empty table gives no rows;
extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import logging
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm.common import LOWER, documents, mapped, saved, steps, text_bytes
from threadlens.llm.registry import query

KINDS = ("email", "ip", "card", "phone")
# A match can only begin where a run of its first class does (inside a run it would end at the same place), or
# where the match before ended; so long runs are read once. No part can give characters back to the next one.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
EMAIL_RUN = re.compile(r"(?<![A-Za-z0-9._%+-])" + EMAIL.pattern)
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NEEDED = re.compile(r"[0-9@]|(?i:\(at\)|\[at\]|(?<=\s)at(?=\s))")  # what plausible() asks of a span of any kind

SIZE, STRIDE = 64, 32
MAX_DOCS = 6_000      # documents that windows without a span come from, all of them where there are fewer
MAX_WINDOWS = 2_400   # windows trained on, a quarter of them without a span where there are enough with one
EMBED, HIDDEN, EPOCHS, BATCH, RATE = 12, 16, 10, 32, 0.01
TAGS = 1 + 2 * len(KINDS)  # O, then begin and inside of each kind
N_CHARS = 100


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def byte_sized(digits: str) -> bool:
    """A decimal number of any length is at most 255."""
    d = digits.lstrip("0")
    return len(d) <= 3 and int(d or "0") <= 255


def emails(t: str) -> list[tuple[int, int]]:
    out, m = [], EMAIL_RUN.search(t)
    while m:
        out.append(m.span())
        m = EMAIL.match(t, m.end()) or EMAIL_RUN.search(t, m.end())
    return out


def base_spans(t: str) -> list[tuple[str, int, int]]:
    out = []
    if "@" in t:
        out += [("email", a, b) for a, b in emails(t)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(t) if all(map(byte_sized, m.group().split(".")))]
    for m in CARD.finditer(t):
        d = _digits(m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in t:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(t) if 9 <= len(_digits(m.group())) <= 15]
    return out


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def char_ids(t: str) -> np.ndarray:
    """1 to 95 for printable ASCII, 96 other white space, 97 other letters, 98
    the rest; 0 stands before and behind the text."""
    c = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where((c >= 32) & (c < 127), c - 31, np.where(c < 32, 96, np.where(c >= 0xC0, 97, 98)))
    return out.astype(np.int64)


# --- the network: numpy only, a window a row -------------------------------

def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


class Tagger:
    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        e, h, k = EMBED, HIDDEN, TAGS
        self.p = {"E": r.normal(0, 0.3, (N_CHARS, e)), "U": r.normal(0, 0.2, (2 * h, k)), "c": np.zeros(k), "T": np.zeros((k, k)), "s": np.zeros(k)}
        for d in "fb":
            self.p["W" + d] = r.normal(0, 1 / np.sqrt(e + h), (e + h, 4 * h))
            self.p["b" + d] = np.concatenate((np.ones(h), np.zeros(3 * h)))  # forget, input, output, candidate
        self.p = {n: v.astype(np.float32) for n, v in self.p.items()}

    def _lstm(self, x, d, keep):
        w, b, h = self.p["W" + d], self.p["b" + d], HIDDEN
        n, steps_, e = x.shape
        hs = np.zeros((n, steps_, h), np.float32)
        hp, cp, cache = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32), []
        xw = x.reshape(-1, e) @ w[:e]
        xw = xw.reshape(n, steps_, 4 * h) + b
        for t in (range(steps_) if d == "f" else range(steps_ - 1, -1, -1)):
            z = xw[:, t] + hp @ w[e:]
            s = _sigmoid(z[:, :3 * h])
            f, i, o, g = s[:, :h], s[:, h:2 * h], s[:, 2 * h:], np.tanh(z[:, 3 * h:])
            c = f * cp + i * g
            tc = np.tanh(c)
            if keep:
                cache.append((t, hp, cp, f, i, o, g, tc))
            hp, cp = o * tc, c
            hs[:, t] = hp
        return hs, cache

    def _lstm_back(self, x, d, cache, dhs, grad):
        w, h, e = self.p["W" + d], HIDDEN, EMBED
        dx = np.zeros_like(x)
        dw, db = np.zeros_like(w), np.zeros(4 * h, np.float32)
        dh_next = dc_next = np.zeros((x.shape[0], h), np.float32)
        for t, hp, cp, f, i, o, g, tc in reversed(cache):
            dh = dhs[:, t] + dh_next
            dc = dh * o * (1 - tc * tc) + dc_next
            dz = np.concatenate((dc * cp * f * (1 - f), dc * g * i * (1 - i), dh * tc * o * (1 - o), dc * i * (1 - g * g)), axis=1)
            dw[:e] += x[:, t].T @ dz
            dw[e:] += hp.T @ dz
            db += dz.sum(0)
            dx[:, t] = dz @ w[:e].T
            dh_next, dc_next = dz @ w[e:].T, dc * f
        grad["W" + d], grad["b" + d] = dw, db
        return dx

    def emissions(self, ids, keep=False):
        x = self.p["E"][ids]
        hf, cf = self._lstm(x, "f", keep)
        hb, cb = self._lstm(x, "b", keep)
        hs = np.concatenate((hf, hb), axis=2)
        return hs @ self.p["U"] + self.p["c"], (x, cf, cb, hs)

    def loss_grad(self, ids, tags):
        """Negative log-likelihood of the tag rows, and its gradient."""
        em, (x, cf, cb, hs) = self.emissions(ids, True)
        n, steps_, k = em.shape
        T, s = self.p["T"].astype(np.float64), self.p["s"].astype(np.float64)
        em64 = em.astype(np.float64)

        def lse(a, axis):
            m = a.max(axis=axis, keepdims=True)
            return np.squeeze(m, axis) + np.log(np.exp(a - m).sum(axis=axis))

        alpha = np.zeros((steps_, n, k))
        beta = np.zeros((steps_, n, k))
        alpha[0] = s + em64[:, 0]
        for t in range(1, steps_):
            alpha[t] = lse(alpha[t - 1][:, :, None] + T, 1) + em64[:, t]
        for t in range(steps_ - 2, -1, -1):
            beta[t] = lse(T + (em64[:, t + 1] + beta[t + 1])[:, None, :], 2)
        z = lse(alpha[-1], 1)
        marg = np.exp(alpha + beta - z[None, :, None]).transpose(1, 0, 2)
        rows = np.arange(n)[:, None]
        gold = em64[rows, np.arange(steps_), tags].sum(1) + s[tags[:, 0]] + T[tags[:, :-1], tags[:, 1:]].sum(1)
        grad = {}
        dem = marg.copy()
        dem[rows, np.arange(steps_), tags] -= 1
        ds = dem[:, 0].sum(0)
        dT = np.zeros((k, k))
        for t in range(1, steps_):
            dT += np.exp(alpha[t - 1][:, :, None] + T + (em64[:, t] + beta[t])[:, None, :] - z[:, None, None]).sum(0)
        np.add.at(dT, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1)
        dem = (dem / n).astype(np.float32)
        grad["s"], grad["T"] = (ds / n).astype(np.float32), (dT / n).astype(np.float32)
        grad["U"] = hs.reshape(-1, hs.shape[2]).T @ dem.reshape(-1, k)
        grad["c"] = dem.sum((0, 1))
        dhs = dem @ self.p["U"].T
        dx = self._lstm_back(x, "f", cf, dhs[:, :, :HIDDEN], grad) + self._lstm_back(x, "b", cb, dhs[:, :, HIDDEN:], grad)
        grad["E"] = np.zeros_like(self.p["E"])
        np.add.at(grad["E"], ids.ravel(), dx.reshape(-1, EMBED))
        return float((z - gold).mean()), grad

    def fit(self, ids, tags, epochs=EPOCHS, seed=0):
        r = np.random.default_rng(seed)
        m = {n: np.zeros_like(v) for n, v in self.p.items()}
        v = {n: np.zeros_like(a) for n, a in self.p.items()}
        step, losses = 0, []
        for epoch in range(epochs):
            total, order = 0.0, r.permutation(len(ids))
            rate = RATE * (1 - 0.9 * epoch / max(1, epochs))
            for lo in range(0, len(order), BATCH):
                i = order[lo:lo + BATCH]
                loss, grad = self.loss_grad(ids[i], tags[i])
                total += loss * len(i)
                step += 1
                norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                for n, g in grad.items():
                    g = g * min(1.0, 5.0 / max(norm, 1e-9))
                    m[n] = 0.9 * m[n] + 0.1 * g
                    v[n] = 0.999 * v[n] + 0.001 * g * g
                    self.p[n] = (self.p[n] - rate * (m[n] / (1 - 0.9**step)) / (np.sqrt(v[n] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            losses.append(total / len(order))
        return losses

    def decode(self, ids):
        """The best tag rows (Viterbi)."""
        em, _ = self.emissions(ids)
        n, steps_, k = em.shape
        T = self.p["T"]
        score, back = self.p["s"] + em[:, 0], np.zeros((steps_, n, k), np.int8)
        for t in range(1, steps_):
            a = score[:, :, None] + T
            back[t] = a.argmax(1)
            score = a.max(1) + em[:, t]
        tags = np.zeros((n, steps_), np.int64)
        tags[:, -1] = score.argmax(1)
        for t in range(steps_ - 1, 0, -1):
            tags[:, t - 1] = back[t][np.arange(n), tags[:, t]]
        return tags


# --- training windows -------------------------------------------------------

def rewritten(kind: str, s: str, no: int) -> str:
    """The span in another way of writing (no = 0: as it is)."""
    d = _digits(s)
    if no == 0:
        return s
    if kind == "email":
        return [s.replace("@", " @ "), s.replace("@", "(at)"), s.replace("@", "[at]").replace(".", "[dot]"), s.replace("@", " at ")][no % 4]
    if kind == "ip":
        return [s.replace(".", " . "), s.replace(".", "[.]"), s.replace(".", ","), s][no % 4]
    if kind == "card":
        g = [d[i:i + 4] for i in range(0, len(d), 4)]
        return [".".join(g), "/".join(g), "-".join(g), " ".join(g)][no % 4]
    n = d[-10:]
    return [f"({n[:3]}) {n[3:6]}-{n[6:]}", f"{n[:3]}-{n[3:6]}-{n[6:]}", f"{n[:3]}.{n[3:6]}.{n[6:]}", "00" + d][no % 4]


def _training(batches):
    """Documents -> windows (chars, tags) around base spans (kind 0, 1, ..) and,
    of documents marked ``other``, around other numbers (kind -1)."""
    for batch in batches:
        win, tag, what = [], [], []
        for doc, t, other in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("other").to_pylist()):
            t = t or ""
            spans = base_spans(t)
            if not spans and not other:
                continue
            taken = np.zeros(len(t) + 1, bool)
            for _, a, b in spans:
                taken[a:b] = True
            r = np.random.default_rng(int(hashlib.md5(f"{doc}:{len(t)}".encode()).hexdigest()[:12], 16))
            for kind, a, b in spans:
                if len(re.findall(r"[0-9@]", t[a:b])) == 0 or b - a > SIZE:
                    continue
                for no in (0, int(r.integers(1, 5))):
                    s = rewritten(kind, t[a:b], no)
                    left, right = t[max(0, a - SIZE):a], t[b:b + SIZE]
                    # spans beside it stay only if they are labelled: cut the context there
                    left = left[next((len(left) - i for i in range(len(left)) if taken[a - 1 - i]), 0):]
                    right = right[:next((i for i in range(len(right)) if taken[b + i]), len(right))]
                    off = int(r.integers(4, max(5, SIZE - len(s) - 4)))
                    ids = np.zeros(SIZE, np.int64)
                    row = char_ids(left[-off:] + s + right)
                    at = off - len(left[-off:])
                    row = row[:SIZE - at]
                    ids[at:at + len(row)] = row
                    y = np.zeros(SIZE, np.int64)
                    k = 1 + 2 * KINDS.index(kind)
                    y[off:off + len(s)] = k + 1
                    y[off] = k
                    win.append(ids.astype(np.uint8).tobytes())
                    tag.append(y.astype(np.uint8).tobytes())
                    what.append(KINDS.index(kind))
            if not other:
                continue
            others = [m.start() for m in re.finditer("[0-9]", t) if not taken[m.start()]]
            for p in (others[::40] + ([int(r.integers(0, len(t)))] if t else []))[:4]:
                lo = max(0, p - int(r.integers(8, SIZE - 8)))
                if not taken[lo:lo + SIZE].any():
                    row = char_ids(t[lo:lo + SIZE])
                    ids = np.zeros(SIZE, np.int64)
                    ids[:len(row)] = row
                    win.append(ids.astype(np.uint8).tobytes())
                    tag.append(np.zeros(SIZE, np.uint8).tobytes())
                    what.append(-1)
        yield pa.RecordBatch.from_arrays([pa.array(what, pa.int32()), pa.array(win, pa.binary()), pa.array(tag, pa.binary())], ["kind", "win", "tag"])


def shares(have: dict[int, int], most: int) -> dict[int, int]:
    """How many windows of each kind to take: a quarter of ``most`` without a
    span (-1), the rest dealt evenly; what a kind cannot fill the others get."""
    out, left = {}, most - min(have.get(-1, 0), most // 4)
    for i, k in enumerate(todo := sorted((k for k in have if k >= 0), key=lambda k: have[k])):
        out[k] = min(have[k], left // (len(todo) - i))
        left -= out[k]
    return out | {-1: min(have.get(-1, 0), most - sum(out.values()))}


def train(docs: DataFrame, max_docs: int = MAX_DOCS, max_windows: int = MAX_WINDOWS, epochs: int = EPOCHS) -> Tagger | None:
    """A tagger fitted on at most ``max_windows`` windows: of those around the
    base spans of all documents a share by hash for each kind, and windows
    without a span from about ``max_docs`` documents by hash of their id.
    ``used`` of the tagger, also logged, has the number of each kind."""
    d = docs.select("doc_id", "text")
    every = max(1, -(-d.count() // max_docs))
    d = d.withColumn("other", F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(every)) == 0)
    w = saved(mapped(d, _training, "kind int, win binary, tag binary"), "pii-windows")
    have = {r[0]: r[1] for r in w.groupBy("kind").count().collect()}
    take = shares(have, max_windows)
    if not any(n for k, n in take.items() if k >= 0):
        return None
    rows = [r for k in sorted(take) if take[k] for r in w.where(F.col("kind") == k).orderBy(F.xxhash64("win", "tag"), "win", "tag").limit(take[k]).collect()]
    ids = np.frombuffer(b"".join(r["win"] for r in rows), np.uint8).reshape(-1, SIZE).astype(np.int64)
    tags = np.frombuffer(b"".join(r["tag"] for r in rows), np.uint8).reshape(-1, SIZE).astype(np.int64)
    t = Tagger()
    t.used = {KINDS[k] if k >= 0 else "none": n for k, n in take.items()}
    logging.getLogger(__name__).info("windows trained on: %s (found: %s)", t.used, have)
    t.fit(ids, tags, epochs)
    return t


# --- search -----------------------------------------------------------------

def plausible(kind: str, s: str) -> bool:
    """The parts a span of that kind must have."""
    n = len(_digits(s))
    if kind == "email":
        return bool(re.search(r"[A-Za-z0-9]\s?(@|(?i:\(at\)|\[at\]|\sat\s))\s?[A-Za-z0-9-]+.*(\.|(?i:\[dot\]))\s?[A-Za-z]{2,}", s))
    if kind == "ip":
        p = re.findall("[0-9]+", s)
        return len(p) == 4 and all(map(byte_sized, p))
    if kind == "card":
        return 13 <= n <= 19 and luhn(_digits(s))
    return 9 <= n <= 15 and not re.search("[A-Za-z]", s)


def model_spans(t: str, tagger: Tagger) -> list[tuple[str, int, int]]:
    ids = char_ids(t)
    n = len(ids)
    tiles = -(-n // STRIDE)
    margin = (SIZE - STRIDE) // 2
    padded = np.zeros(tiles * STRIDE + 2 * margin, np.int64)
    padded[margin:margin + n] = ids
    windows = np.lib.stride_tricks.sliding_window_view(padded, SIZE)[::STRIDE]
    want, done = np.zeros(tiles, bool), np.zeros(tiles, bool)
    for m in NEEDED.finditer(t):
        want[m.start() // STRIDE:(m.end() - 1) // STRIDE + 1] = True
    tags = np.zeros(tiles * STRIDE, np.int64)
    while len(pick := np.flatnonzero(want & ~done)):
        for lo in range(0, len(pick), 512):
            part = pick[lo:lo + 512]
            tags.reshape(-1, STRIDE)[part] = tagger.decode(windows[part])[:, margin:margin + STRIDE]
        done[pick] = True
        ends = tags.reshape(-1, STRIDE) > 0
        want[:-1] |= ends[1:, 0]
        want[1:] |= ends[:-1, -1]
    tags = tags[:n]
    kind = (tags + 1) // 2  # 0 nothing, 1.. the kinds
    begins = (tags % 2 == 1) & (np.arange(n) % STRIDE != 0)
    cut = np.ones(n + 1, bool)
    cut[1:n] = (kind[1:] != kind[:-1]) | begins[1:]
    at = np.flatnonzero(cut)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if kind[a]:
            while a < b and t[a] in " \t\n\r.,;:":
                a += 1
            while b > a and t[b - 1] in " \t\n\r.,;:":
                b -= 1
            if b > a:
                out.append((KINDS[kind[a] - 1], a, b))
    return out


def find(t: str, tagger: Tagger | None) -> tuple[list, list]:
    """Base spans and all spans of a text."""
    base = base_spans(t)
    if tagger is None:
        return base, base
    taken = np.zeros(len(t) + 1, bool)
    for _, a, b in base:
        taken[a:b] = True
    more = [(k, a, b) for k, a, b in model_spans(t, tagger) if not taken[a:b].any() and plausible(k, t[a:b])]
    return base, base + more


def _worth(b):
    """Which texts of a batch may hold what a span needs: a digit, an "@", or
    an "at" that is not part of an ASCII word."""
    buf, offs = text_bytes(b.column("text"))
    low = LOWER[buf]
    word = ((low >= 97) & (low <= 122)) | ((buf >= 48) & (buf <= 57))
    need = ((buf >= 48) & (buf <= 57)) | (buf == 64)
    need[1:-2] |= (low[1:-2] == 97) & (low[2:-1] == 116) & ~word[:-3] & ~word[3:]
    hit = np.concatenate(([0], np.cumsum(need)))
    return hit[offs[1:]] > hit[offs[:-1]]


def _search(tagger: Tagger | None):
    def run(batches):
        for batch in batches:
            for b in steps(batch):
                worth, texts = _worth(b), b.column("text")
                rows = []
                for i in range(b.num_rows):
                    base, every = find(texts[i].as_py(), tagger) if worth[i] else ((), ())
                    rows.append((*(sum(k == x for x, _, _ in base) for k in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string()), pa.array(cols[5], pa.string())],
                                                 ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
    return run


def find_pii(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    t = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", "text"), _search(tagger),
                  f"doc_id {t}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def masked(t: str, spans) -> str:
    """The text with every span replaced by its kind in angle brackets;
    overlapping spans are replaced as one, by the first kind."""
    out, at = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [t[at:a], f"<{k.upper()}>"]
        at = max(at, b)
    return "".join(out) + t[at:]


def mask_pii(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """The documents with personal data masked in ``text``; other columns stay."""
    def run(batches):
        for batch in batches:
            for b in steps(batch):
                worth, texts = _worth(b), b.column("text")
                new = [masked(texts[i].as_py(), find(texts[i].as_py(), tagger)[1]) if worth[i] else texts[i].as_py() for i in range(b.num_rows)]
                yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if n == "text" else b.column(n) for n in b.schema.names], b.schema.names)
    return mapped(docs, run, docs.schema)


@query("op7_personal_data")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir)
    return find_pii(d, train(d))
