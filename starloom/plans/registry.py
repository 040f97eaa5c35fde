"""The list of checked queries: a Spark job and, where SQL can say it, its oracle."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.plans.views import Tables, VIEWS, view_ctes


@dataclass
class Query:
    key: str
    run: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def rnd(col, digits: int = 6):
    """Round for comparison; adding zero turns -0.0 into 0.0."""
    return F.round(F.col(col) if isinstance(col, str) else col, digits) + F.lit(0.0)


def scatter_sql(key: str, seed: int) -> str:
    """A whole number below 2147483647, scattered from a whole-number key; the text means the same in both engines."""
    p = 2147483647
    h = f"({key} % {p} * 48271 + {seed} * 16807) % {p}"
    return f"(({h}) * ({h}) + 7919) % {p}"


def _expand(text: str) -> str:
    """``R6(x)`` -> rounded x, as ``rnd`` does."""
    while True:
        m = re.search(r"\bR(\d)\(", text)
        if not m:
            return text
        depth, i = 1, m.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(text[i], 0)
            i += 1
        text = f"{text[:m.start()]}(round({text[m.end():i - 1]}, {m.group(1)}) + 0e0){text[i:]}"


def oracle_text(body: str) -> str:
    body = _expand(" ".join(body.split()))
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", body)]
    ctes = view_ctes(used)
    if not ctes:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ", ".join(ctes) + ", " + body[15:]
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join(ctes) + ", " + body[5:]
    return "WITH " + ", ".join(ctes) + " " + body


def query(key: str, sql: str | None = None):
    def wrap(fn):
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = Query(key, fn, oracle_text(sql) if sql else None)
        return fn

    return wrap
