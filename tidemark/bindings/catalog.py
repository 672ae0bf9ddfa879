"""All registered queries; importing the modules registers them."""

from tidemark.bindings import analytics, jobs, ledgers, loads, posts, quality  # noqa: F401
from tidemark.bindings.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
