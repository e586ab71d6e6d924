"""Plain Python versions of the contracts, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SEP = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return SEP.findall(t or "")


def lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def sha(b):
    return hashlib.sha256(b).hexdigest()


def near_dups(rows, k=3, num=85, den=100):
    """rows: (doc_id, text) with distinct ids -> {doc_id: (n, component)}."""
    sets = {}
    for i, t in rows:
        w = words(lower(t))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    by = defaultdict(list)
    for i, s in sets.items():
        by[frozenset(s)].append(i)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def join(a, b):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)

    index = defaultdict(list)
    reps = []
    for s, ids in by.items():
        if s:
            for i in ids[1:]:
                join(ids[0], i)
            reps.append(ids[0])
    order = Counter(x for r in reps for x in sets[r])
    for r in sorted(reps, key=lambda r: len(sets[r])):
        s = sorted(sets[r], key=lambda x: (order[x], x))
        prefix = len(s) - math.ceil(len(s) * num / den) + 1
        seen = set()
        for x in s[:prefix]:
            seen.update(index[x])
            index[x].append(r)
        for q in seen:
            if den * len(sets[q] & sets[r]) >= num * len(sets[q] | sets[r]):
                join(q, r)
    return {i: (len(sets[i]), find(i)) for i in sets}


def byte_spans(texts, n=200):
    """list of texts -> per text the removed byte flags."""
    seen = Counter()
    bs = [(t or "").encode() for t in texts]
    for b in bs:
        seen.update(b[i:i + n] for i in range(len(b) - n + 1))
    out = []
    for b in bs:
        f = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen[b[i:i + n]] > 1:
                f[i:i + n] = b"\1" * n
        out.append(f)
    return out


def byte_row(t, flags):
    b = (t or "").encode()
    spans = sum(1 for i in range(len(flags)) if flags[i] and (i == 0 or not flags[i - 1]))
    return len(b), sum(flags), spans, sha(bytes(x for x, f in zip(b, flags) if not f))


def word_rows(rows, n=50):
    """rows: (doc_id, text) -> {doc_id: (n_words, n_removed, sha)}."""
    first = {}
    ws = [(i, words(t)) for i, t in rows]
    for i, w in ws:
        for j in range(len(w) - n + 1):
            key = tuple(w[j:j + n])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, w in ws:
        f = [False] * len(w)
        for j in range(len(w) - n + 1):
            if first[tuple(w[j:j + n])] < i:
                f[j:j + n] = [True] * n
        out[i] = len(w), sum(f), sha(" ".join(x for x, d in zip(w, f) if not d).encode())
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(t):
    t = t or ""
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(t)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def unigram(rows):
    toks = {i: words(lower(t)) + [None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in toks}
    c = Counter(w for i, w_ in toks.items() if not held[i] for w in w_)
    n, v = sum(c.values()), len(c)
    return {i: (held[i], len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)) for i, w in toks.items()}


def quality(t):
    t = t or ""
    w = words(t)
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    c = Counter(tri)
    hit = {j for i, x in enumerate(tri) if c[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), len(lines) - len(set(lines)), len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))
