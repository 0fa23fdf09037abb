"""The whole monthly load."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

from monthstar.operators.keys import DEFAULT_BUCKETS
from monthstar.operators.lookup import BROADCAST_BYTES
from monthstar.plans.checks import run_check
from monthstar.plans.dimension import load_dimension
from monthstar.plans.fact import load_fact, measured_dimensions
from monthstar.plans.journal import Journal, made_from, raw_files
from monthstar.plans.landing import land_extraction
from monthstar.plans.staging import distinct_rows, shared_passes, stage_source
from monthstar.sources.paged import Paging, Transport
from monthstar.specs.model import Star


def run_month(
    spark: SparkSession,
    root: str,
    star: Star,
    year: int,
    month: int,
    strict: bool = False,
    concurrent_jobs: int = 4,
    broadcast_bytes: int = BROADCAST_BYTES,
    buckets: int = DEFAULT_BUCKETS,
    transport_for: Callable[[str], Transport] | None = None,
    paging: Paging = Paging(),
    fetch_parallel: int | None = 1,
    versioned: bool = False,
    resume: bool = False,
    check_later: bool = False,
) -> dict[str, dict]:
    """Stage, load and check all dimensions, then load and check all facts.

    With ``transport_for`` the month's card vouchers are fetched and landed
    first, from ``fetch_parallel`` tasks that share the calls ``paging`` allows. Each step ends before the next begins; inside a step the tables are
    independent and their jobs share the cluster; facts that are written at the
    same time share ``broadcast_bytes``. A failed check raises and
    stops the run. Running a month again changes nothing but its own fact
    partitions. With ``versioned`` dimensions and facts are versioned tables: a
    run that is lost leaves whole tables, and of two runs at a time one is
    refused; a root keeps one kind. With ``resume`` a run of the same month that
    failed goes on: steps that ended, and whose raw files, specification and
    settings are still the same, are not run again. With ``check_later`` members
    that an earlier such run checked are not compared among themselves again.
    Returns what the checks measured, by table.
    """
    if transport_for is not None:
        day = date(year, month, 1)
        land_extraction(spark, root, "corporate_card_expenses", day, transport_for, paging, fetch_parallel)

    def fold(group):
        families, sources = group
        return distinct_rows(spark, root, families, sources, year, month)

    def stage(side):
        table, source = side
        stage_source(spark, root, table, source, year, month, rows.get(source.name))

    def load_one(table):
        load_dimension(spark, root, table, strict, buckets, versioned)
        ids = table.id_column if check_later else None
        return run_check(spark, root, "dimension_duplicate_keys", table.name, table.keys, id_column=ids)

    def load(table):
        return table.name, journal.once(f"dimension-{table.name}", loaded_from, lambda: load_one(table))

    def write_one(table):
        share = broadcast_bytes // max(1, min(concurrent_jobs, len(star.facts)))
        rejected = load_fact(spark, root, star, table, year, month, share, sizes, versioned)
        found = run_check(
            spark, root, "fact_keys", table.name, table.required, table.max_null_percent, period=(year, month)
        )
        return {**found, "rejected_rows": rejected}

    def write(table):
        raw = raw_files(spark, root, [table.family], year, month)
        written_from = made_from(loaded_from, table, raw)
        return table.name, journal.once(f"fact-{table.name}", written_from, lambda: write_one(table))

    def stage_all():
        # Sources over the same raw files are folded in one pass of the text.
        for part in _together(spark, fold, shared_passes(star), concurrent_jobs):
            rows.update(part)
        sides = [(table, source) for table in star.dimensions for source in table.sources]
        _together(spark, stage, sides, concurrent_jobs)

    rows = {}
    journal = Journal(spark, root, year, month, resume)
    families = [family for table in star.dimensions for source in table.sources for family in source.families]
    staged_from = made_from(star.dimensions, versioned, raw_files(spark, root, families, year, month))
    loaded_from = made_from(staged_from, strict, buckets)
    journal.once("staging", staged_from, stage_all)
    checked = _together(spark, load, star.dimensions, concurrent_jobs)
    sizes = measured_dimensions(spark, root, star) if star.facts else {}
    checked += _together(spark, write, star.facts, concurrent_jobs)
    journal.drop()
    return dict(checked)


def _together(spark: SparkSession, job: Callable, tables: Iterable, concurrent_jobs: int) -> list:
    """Run independent jobs from a few threads; the first failure is raised.

    Each job is wrapped by itself, since a wrapper carries the session's local
    properties and two threads must not share them.
    """
    with ThreadPoolExecutor(max_workers=concurrent_jobs) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job), table) for table in tables]
        return [done.result() for done in running]
