"""All registered queries; importing this package fills the registry."""

from tallyframe.catalog import base, changes, checks, features, functions, monitoring, movement, relational
from tallyframe.catalog.base import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES", "base", "changes", "checks", "features", "functions", "monitoring", "movement", "relational",
]
