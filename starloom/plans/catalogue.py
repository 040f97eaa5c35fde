"""All registered queries; importing the modules fills the registry."""

from starloom.plans import q_features, q_filters, q_nested, q_period, q_scans, q_sky, q_stats, q_structure, q_udf  # noqa: F401
from starloom.plans.registry import QUERIES

__all__ = ["QUERIES"]
