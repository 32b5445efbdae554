"""The registered queries: how the given tables become transactions, each query, and its SQL twin."""

from ledgerlens.plans.catalog import QUERIES
from ledgerlens.plans.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]
