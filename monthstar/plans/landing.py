"""Landing records of a paged service as raw files."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthstar.sinks import land_records, remove
from monthstar.sources.files import LOADING, join_path, paths_like
from monthstar.sources.paged import STEP_COLUMNS, Paging, Transport, fetch_step, runs
from monthstar.sources.requests import extraction

#: Calls of one step, about; a landing that is cut off repeats those of one step at most.
STEP_CALLS = 480
#: Seconds of one step, about, where calls are so quick that more of them are made in a step.
STEP_SECONDS = 20


def land_extraction(
    spark: SparkSession,
    root: str,
    name: str,
    day: date,
    transport_for: Callable[[str], Transport],
    paging: Paging = Paging(),
    max_parallel: int | None = 1,
    step_calls: int = STEP_CALLS,
) -> str:
    """Fetch all records of an extraction for a day and land them as JSON lines.

    ``transport_for`` maps the service path to a transport. Records go from
    the workers to storage; the driver sees none of them. A month's vouchers lie
    in one folder whatever the day, so landing them again replaces them; other
    files of the month, which readers would add to them, are an error. So is a
    page limit, which would land part of the records.

    Pages are fetched in steps of about ``step_calls`` calls, or of more where these
    take less than ``STEP_SECONDS``. What a step fetched
    is kept under ``loading`` with the place that each request has reached, so a
    landing that was cut off goes on from its last whole step when it is called
    again. A landing that ended keeps nothing, and the next fetches anew.
    """
    wanted = extraction(name)
    if paging.limit_pages > 0:
        raise ValueError("a page limit would land part of the records")
    path = join_path(root, wanted.landing(day))
    if wanted.month is not None:
        others = paths_like(spark, join_path(root, wanted.month.format(day=day)))
        others = [other for other in others if other.rstrip("/").rpartition("/")[2] != path.rpartition("/")[2]]
        if others:
            raise FileExistsError(f"the month is landed elsewhere too: {', '.join(sorted(others))}")
    parents = None
    if wanted.needs:
        columns = ", ".join(f"`{column}` string" for column in wanted.parent_columns)
        parents = spark.read.json(join_path(root, extraction(wanted.needs).landing(day)), columns)
    asked = runs(wanted.requests(spark, day, parents), paging)
    journal = join_path(root, LOADING, "landing", f"{path.rpartition('/')[2]}-strides-{paging.strides}")
    fetched = fetch_in_steps(asked, transport_for(wanted.endpoint), paging, journal, max_parallel, step_calls)
    land_records(fetched, path, "record")
    remove(spark, journal)
    return path


def fetch_in_steps(
    asked: DataFrame,
    transport: Transport,
    paging: Paging,
    journal: str,
    max_parallel: int | None = 1,
    step_calls: int = STEP_CALLS,
) -> DataFrame:
    """``(request, page, record)`` of all runs ``asked``, fetched in steps that the folder ``journal`` keeps.

    A step takes as many unfinished runs as it may make calls, and of each as
    many pages as share these calls. It is one write, and counts once that write
    has ended; a step that failed leaves nothing that is read.

    The first step makes ``step_calls`` calls. One that ended in less than half of
    ``STEP_SECONDS`` is followed by one of twice as many, so that the jobs of the
    steps take a bounded share of the time however many calls there are; what a
    cut-off repeats is then some seconds of calls. Where a service or its limit
    makes calls slow, all steps are of ``step_calls``.
    """
    spark = asked.sparkSession
    steps = _whole_steps(spark, journal)
    calls = step_calls
    while True:
        left = asked.join(_reached(spark, steps), ["request", "offset"], "left").where("done is not true")
        some = left.select("request", "offset", "page").orderBy("request", "offset").limit(calls)
        number = some.count()
        if not number:
            return _stored(spark, steps).where("record is not null").select("request", "page", "record")
        step = f"{journal}/step-{len(steps):06d}"
        began = time.monotonic()
        fetch_step(some, transport, paging, max(1, calls // number), max_parallel).write.mode("overwrite").parquet(step)
        steps.append(step)
        took = time.monotonic() - began
        if took < STEP_SECONDS / 2:
            calls *= 2
        elif took > STEP_SECONDS * 2:
            calls = max(step_calls, calls // 2)


def _whole_steps(spark: SparkSession, journal: str) -> list[str]:
    """The steps that ended, in order."""
    marks = paths_like(spark, f"{journal}/step-*/_SUCCESS")
    return sorted(mark.rpartition("/")[0] for mark in marks)


def _stored(spark: SparkSession, steps: list[str]) -> DataFrame:
    if not steps:
        return spark.createDataFrame([], STEP_COLUMNS)
    return spark.read.schema(STEP_COLUMNS).parquet(*steps)


def _reached(spark: SparkSession, steps: list[str]) -> DataFrame:
    """``(request, offset, page, done)``: the place of every run that a step has fetched."""
    told = _stored(spark, steps).where("done is not null")
    last = Window.partitionBy("request", "offset").orderBy(F.desc("done"), F.desc("page"))
    return told.withColumn("n", F.row_number().over(last)).where("n = 1").select("request", "offset", "page", "done")
