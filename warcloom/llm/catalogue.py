"""Registered queries of the training-data operators and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = dict(queries.QUERIES)
ORACLES: dict[str, str] = dict(queries.ORACLES)
