"""The queries of this subpackage: OP_QUERIES and OP_ORACLES, filled on import."""

from __future__ import annotations

OP_QUERIES: dict = {}
OP_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        OP_QUERIES[name] = fn
        if oracle is not None:
            OP_ORACLES[name] = oracle
        return fn
    return deco
