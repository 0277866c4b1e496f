"""Registered queries over the driver tables (``catalog``) and the
statement-shaped inputs they derive from those tables (``derive``)."""

from spendloom.plans.catalog import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
