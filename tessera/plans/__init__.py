"""Named queries over the driver tables (see ``registry``)."""

from tessera.plans import q_clean, q_distribution, q_fits, q_impute, q_labels, q_models, q_profile, q_stats, q_vectors  # noqa: F401
from tessera.plans.registry import QUERIES, SQLS

__all__ = ["QUERIES", "SQLS"]
