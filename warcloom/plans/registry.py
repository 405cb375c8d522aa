"""Registry of runnable queries and their independent SQL checks."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle_frames import FRAMES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` is DuckDB SQL that may name any derived frame."""

    def register(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = with_frames(oracle)
        return fn

    return register


def _needed(sql: str, found: list[str]) -> None:
    for name, body in FRAMES.items():
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(body, found)
            found.append(name)


def with_frames(sql: str) -> str:
    """Prefix SQL with the derived frames it names, dependencies first."""
    found: list[str] = []
    _needed(sql, found)
    ctes = ",\n".join(f"{name} AS ({FRAMES[name].strip()})" for name in found)
    body = sql.strip()
    match = re.match(r"(?is)^with\s+(recursive\s+)?", body)
    if not found:
        return body
    if match:
        return f"WITH {match.group(1) or ''}{ctes},\n{body[match.end():]}"
    return f"WITH {ctes}\n{body}"
