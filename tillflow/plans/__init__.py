"""Query plans: the layer builder, the registry and the DuckDB oracle SQL."""

from tillflow.plans import q_codec, q_layers, q_ml, q_reports  # noqa: F401  (registers queries)
from tillflow.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
