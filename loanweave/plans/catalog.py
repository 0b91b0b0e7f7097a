"""All registered queries and their SQL."""

from __future__ import annotations

from loanweave.plans import (  # noqa: F401  (importing registers the queries)
    catalog_cleaning,
    catalog_functions,
    catalog_long_history,
    catalog_metrics,
    catalog_models,
    catalog_panel,
    catalog_profile,
)
from loanweave.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
