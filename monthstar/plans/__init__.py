"""The jobs of a monthly load."""

from monthstar.plans.checks import CHECKS, run_check
from monthstar.plans.dimension import load_dimension
from monthstar.plans.fact import fact_rows, load_fact
from monthstar.plans.landing import land_extraction
from monthstar.plans.month import run_month
from monthstar.plans.staging import distinct_rows, stage_members, stage_source

__all__ = [
    "CHECKS",
    "distinct_rows",
    "fact_rows",
    "land_extraction",
    "load_dimension",
    "load_fact",
    "run_check",
    "run_month",
    "stage_members",
    "stage_source",
]
