"""Imports every query module so that the registry is filled."""

from . import (  # noqa: F401
    capture_queries,
    curation_queries,
    harvest_queries,
    holding_queries,
    log_queries,
    page_queries,
    reader_queries,
    stream_queries,
    tracking_queries,
    warc_queries,
)
from .registry import ORACLES, QUERIES  # noqa: F401
