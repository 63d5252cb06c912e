"""All registered queries and their DuckDB oracle statements."""

from __future__ import annotations

import importlib

_MODULES = ["weekly", "text", "topics", "models", "trees", "io_stream"]


def _load():
    q, o = {}, {}
    for m in _MODULES:
        mod = importlib.import_module(f"scorecast.plans.{m}")
        for k, v in mod.QUERIES.items():
            if k in q:
                raise RuntimeError(f"duplicate query {k}")
            q[k] = v
        o.update(getattr(mod, "ORACLES", {}))
    return q, o


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
