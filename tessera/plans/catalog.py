"""Import every query module so that the registry is complete."""

from tessera.plans import fits_q, ml_q, relational, sources_q, streaming_q, survival_q  # noqa: F401
from tessera.plans.registry import ORACLE, QUERIES  # noqa: F401
