"""A fast slice of the driver's check: Spark query vs DuckDB oracle at sf0.001."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from threadlens.plans.fixtures import TABLES

KEYS = ["examples_flagship", "tree_branches", "features_all", "join_attach_labels", "agg_f1_macro",
        "win_early_stop", "txt_processed_text", "src_label_keys", "tree_json_edges", "seq_masks"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_small, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle_or_is_known():
    optional = {k for k in E.queries() if k.startswith("op") or k == "pipeline"}
    assert set(E.queries()) - set(E.oracle_sql()) - optional == {"ml_fit_predict", "ml_learning_curve"}


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_small, con, key):
    df = E.queries()[key](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _digest(df.columns, rows) == _digest(dcols, drows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "branch_id" in df.columns
