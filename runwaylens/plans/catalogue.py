"""All registered queries; importing the parts fills the registry."""

from __future__ import annotations

from runwaylens.plans import (  # noqa: F401
    catalogue_cleaning,
    catalogue_profile,
    catalogue_reports,
    catalogue_runlog,
    catalogue_storage,
)
from runwaylens.plans.registry import QUERIES, SQL  # noqa: F401
