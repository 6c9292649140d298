"""All registered queries; importing the modules fills the registry."""

from __future__ import annotations

from larder.plans import foods, models, monitoring, stored, streams, texts  # noqa: F401
from larder.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
