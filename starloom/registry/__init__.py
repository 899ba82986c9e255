"""The operators applied to the order-entry test tables, with an SQL text for each result."""

from .oracles import ORACLES
from .queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
