"""Documents with everything the contracts name: nulls, empty and very long
texts, ties, repeated rows, copies, extra columns with clashing names."""

import random

import pytest
from pyspark.sql import types as T

EXTRA = ["key", "h", "n", "node", "oid", "spans", "item_ids", "copies", "size", "block", "word", "kept"]


def texts():
    r = random.Random(5)
    vocab = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(1, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(r.choice(vocab) for _ in range(n))

    out = [None, "", " \t\n", "one", "one two", "One TWO", "a b c", "A b c", "ñandú x\u0085y <|endoftext|> z", "x\x0by\x0cz\rw"]
    base = prose(300)
    w = base.split()
    out += [base, base, base.upper(), " ".join(w)]
    for k in (1, 2, 4, 6, 8, 10, 14, 30):  # near copies at several distances
        v = list(w)
        for _ in range(k):
            v[r.randrange(len(v))] = r.choice(vocab)
        out.append(" ".join(v))
    license_ = prose(70)
    out += [f"{prose(r.randint(0, 40))} {license_} {prose(r.randint(0, 60))}" for _ in range(25)]
    out += ["a" * 5000, "ab " * 900, "z" * 199, "z" * 200, "z" * 201, prose(12000), prose(49), prose(50), prose(51)]
    half = prose(80)
    out += [half + "\n" + half, f"{half}\n{prose(20)}\n{half}\n\n{half}"]
    long_ = prose(60)
    out += [f"{long_} {prose(1)}", f"{prose(1)} {long_}", " ".join(long_.split()[5:58])]
    out += ["mail bob@example.com, bob@example.com or +1 (555) 010-9999; card 4111 1111 1111 1111 and 4111 1111 1111 1112, ip 10.0.0.255 or 10.0.0.256 1.2.3.4.5",
            "AT +49 30 1234567 \n+123 a@b a@b.c 999999999999999999999999 0.0.0.0", prose(200) + " x.1@mail.example.org " + prose(30)]
    out += ["!!! ??? ###", "word\n" * 120, "É" * 300, "日本語 テキスト " * 40]
    return out


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in EXTRA]])


def rows():
    r = random.Random(9)
    ids = list(range(1, 400, 3))
    r.shuffle(ids)
    out = []
    for i, t in enumerate(texts()):
        source = None if i % 11 == 0 else ("hot" if i % 3 else f"s{i % 5}")
        out.append((ids[i], t, ["en", "de", None, "xx"][i % 4], source, len(t or ""), *["x"] * len(EXTRA)))
    return out


@pytest.fixture(scope="session")
def small(spark):
    """(DataFrame, {doc_id: text}) with distinct ids."""
    rs = rows()
    return spark.createDataFrame(rs, SCHEMA).repartition(5), {r[0]: r[1] for r in rs}


@pytest.fixture(scope="session")
def odd(spark):
    """The same with null ids, repeated rows, and one id on two texts."""
    rs = rows()
    more = [(None, *rs[10][1:]), (None, *rs[40][1:]), rs[12], rs[12], (rs[20][0], *rs[10][1:]), (None, None, None, None, None, *[None] * len(EXTRA))]
    return spark.createDataFrame(rs + more, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
