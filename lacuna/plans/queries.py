"""All registered queries of the curation engine and their SQL."""

from __future__ import annotations

from lacuna.plans import flows, outputs, proofs, rules  # noqa: F401  each registers its own
from lacuna.plans.catalogue import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
