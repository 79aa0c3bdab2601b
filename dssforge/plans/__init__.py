"""Analytic query plans: the 22 queries, their variants and the SQL oracle."""

from dssforge.plans.queries import QUERIES
from dssforge.plans.variants import VARIANTS

__all__ = ["QUERIES", "VARIANTS"]
