"""Registered queries over the test tables, each beside an independent SQL rendering."""

from siltbed.workload import (  # noqa: F401 - importing registers the queries
    cleaning,
    dimensional,
    forecasting,
    layers,
    pages,
    panel,
    quality,
    series,
    storage,
)
from siltbed.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
