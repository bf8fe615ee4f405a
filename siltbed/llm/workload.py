"""All queries of this subpackage."""

from siltbed.llm import queries_native, queries_pages_vectors, queries_python  # noqa: F401 - importing registers the queries
from siltbed.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
