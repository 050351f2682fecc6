"""The operators bound to the generic test tables, each with an independent SQL counterpart."""

from candlewick.bindings.oracle import ORACLES
from candlewick.bindings.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
