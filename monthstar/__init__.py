"""Monthly star schemas on Spark: staged dimensions, surrogate keys, facts, checks."""

from monthstar.plans import land_extraction, load_dimension, load_fact, run_month, stage_source
from monthstar.specs.spending import SPENDING, SPENDING_WITH_TYPES

__all__ = [
    "SPENDING",
    "SPENDING_WITH_TYPES",
    "land_extraction",
    "load_dimension",
    "load_fact",
    "run_month",
    "stage_source",
]
