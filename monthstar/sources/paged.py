"""Reading paged JSON services.

A request is a set of parameters; its pages are fetched one after another, and
different requests are fetched in parallel. Output rows hold the request and
page they came from and one record as JSON text, kept as it was sent.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from monthstar.errors import FetchError
from monthstar.sources.transports import OK, Reply

Transport = Callable[[Mapping], Reply]

# Fixed value: name of the page parameter.
PAGE_PARAM = "pagina"

COLUMNS = "request string, page int, record string"
_ARROW = pa.schema([("request", pa.string()), ("page", pa.int32()), ("record", pa.string())])


@dataclass(frozen=True)
class Paging:
    """How pages are fetched.

    ``sleep`` seconds pass before every call. ``per_minute`` above 0 is the
    number of calls a minute that all tasks of a fetch share, repeated ones
    included. A failed call is repeated up to ``retries`` times. ``limit_pages`` above 0 is the last page fetched; landing
    refuses it, since a month cut short looks like a whole one.
    ``strides`` above 1 splits a request into that many interleaved runs of
    pages, each ending at its own first empty page; use it where the service
    allows parallel calls.
    """

    retries: int = 5
    sleep: float = 1
    limit_pages: int = 0
    strides: int = 1
    per_minute: float = 0


@dataclass
class Turns:
    """The share that a task has in one budget of calls.

    Time is cut into turns, one for each call that the budget allows, and turn
    ``n`` belongs to the task ``n % shares``. Tasks keep to their own turns, one
    call in each, so they never need to hear of each other; clocks have to agree
    to within a turn. The turns of a task that has ended, or has not begun yet,
    pass unused.
    """

    per_minute: float
    mine: int = 0
    shares: int = 1
    clock: Callable[[], float] = time.time
    sleep: Callable[[float], None] = time.sleep
    _last: int = field(default=-1, init=False)

    def wait(self) -> None:
        """Return when the next call may be made."""
        if self.per_minute <= 0:
            return
        length = 60 / self.per_minute
        first = max(int(self.clock() // length), self._last + 1)
        self._last = first + (self.mine - first) % self.shares
        # Sleeping may end early by a little.
        while (early := self._last * length - self.clock()) > 0:
            self.sleep(early)


def records_of(body: str) -> list[str]:
    """The records of a page (an array), each as the text that was sent.

    Numbers keep their digits. White space between a record's parts is put on
    one line, so that a record is a line of its file.
    """
    decoder, blank = json.JSONDecoder(), " \t\r\n"
    body = body.strip(blank)
    if not (body.startswith("[") and body.endswith("]")):
        raise ValueError("a page is not an array of records")
    scan, between = decoder.scan_once, blank + ","
    records, at, end = [], 1, len(body) - 1
    while True:
        while body[at] in between:
            at += 1
        if at == end:
            break
        start = at
        try:
            _, at = scan(body, start)
        except StopIteration:
            decoder.raw_decode(body, start)
        records.append(body[start:at])
    if "\r" in body or "\n" in body:
        records = [record.replace("\r", " ").replace("\n", " ") for record in records]
    return records


def fetch_page(transport: Transport, params: Mapping, paging: Paging, turns: Turns | None = None) -> list[str]:
    """The records of one page, within the allowed attempts."""
    failure: object = None
    turns = turns or Turns(paging.per_minute)
    for _ in range(paging.retries + 1):
        time.sleep(paging.sleep)
        turns.wait()
        try:
            reply = transport(params)
        except OSError as error:
            failure = error
            continue
        if reply.status == OK:
            return records_of(reply.body)
        failure = f"status {reply.status}"
    raise FetchError(f"no page after {paging.retries + 1} attempts: {failure}")


def pages_of(
    transport: Transport, params: Mapping, paging: Paging, offset: int = 0, turns: Turns | None = None
) -> Iterator[tuple[int | None, list]]:
    """Pages up to the first empty one, or the page limit.

    Parameters without a page number have a single page.
    """
    turns = turns or Turns(paging.per_minute)
    page = params.get(PAGE_PARAM)
    if page is None:
        records = fetch_page(transport, params, paging, turns) if offset == 0 else []
        if records:
            yield None, records
        return
    first = page
    page += offset
    while page == first or paging.limit_pages <= 0 or page <= paging.limit_pages:
        records = fetch_page(transport, {**params, PAGE_PARAM: page}, paging, turns)
        if not records:
            return
        yield page, records
        page += paging.strides


def _batches(
    transport: Transport, request: str, paging: Paging, offset: int, turns: Turns
) -> Iterator[pa.RecordBatch]:
    for page, records in pages_of(transport, json.loads(request), paging, offset, turns):
        count = len(records)
        columns = [[request] * count, [page] * count, records]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _ship_by_value() -> None:
    """Let workers unpickle this code without having the package installed."""
    for name in (FetchError.__module__, Reply.__module__, __name__):
        cloudpickle.register_pickle_by_value(sys.modules[name])


def fetch_pages(
    requests: DataFrame,
    transport: Transport,
    paging: Paging = Paging(),
    max_parallel: int | None = 1,
) -> DataFrame:
    """Fetch every request of a DataFrame, one row per record.

    Each row of ``requests`` is a request, its columns the parameters. They are
    fetched where they lie, never on the driver. ``max_parallel`` bounds the
    number of concurrent calls, 1 by default because services limit calls per
    key; None uses all cores. However many tasks there are, they share the calls
    a minute that ``paging`` allows.
    """
    _ship_by_value()
    placed, shares = _placed(runs(requests, paging), max_parallel)

    def fetch(batches):
        turns = Turns(paging.per_minute, TaskContext.get().partitionId(), shares)
        for batch in batches:
            for row in batch.to_pylist():
                yield from _batches(transport, row["request"], paging, row["offset"], turns)

    return placed.mapInArrow(fetch, COLUMNS)


def runs(requests: DataFrame, paging: Paging) -> DataFrame:
    """``(request, offset)``: each request as JSON, once for each of its strides."""
    packed = requests.select(F.to_json(F.struct(*requests.columns)).alias("request"))
    return packed.select("request", F.explode(F.sequence(F.lit(0), F.lit(paging.strides - 1))).alias("offset"))


def _placed(found: DataFrame, max_parallel: int | None) -> tuple[DataFrame, int]:
    """Runs dealt to tasks, and the number of these."""
    if max_parallel is None:
        max_parallel = found.sparkSession.sparkContext.defaultParallelism
    # A given number of partitions is kept; without one, requests are so small
    # that they would all be put into one task.
    return found.repartition(max_parallel, "request", "offset"), max_parallel


#: Records that a task of a step hands on together, about.
BATCH_RECORDS = 1000
STEP_COLUMNS = "request string, offset int, page int, record string, done boolean"
_STEP = pa.schema(
    [("request", pa.string()), ("offset", pa.int32()), ("page", pa.int32())]
    + [("record", pa.string()), ("done", pa.bool_())]
)


def fetch_step(
    found: DataFrame, transport: Transport, paging: Paging, pages: int, max_parallel: int | None = 1
) -> DataFrame:
    """Up to ``pages`` pages of each run ``(request, offset, page)``, from its ``page`` on.

    A row for each record; and one without a record for each run, which tells its
    next page and whether it is ``done``. A ``page`` of null is a run's first.
    """
    _ship_by_value()
    placed, shares = _placed(found, max_parallel)

    def rows(run: Mapping, pages: list, counts: list[int], records: list, done: bool | None) -> pa.RecordBatch:
        number = len(records)
        columns = [
            pa.repeat(pa.scalar(run["request"], pa.string()), number),
            pa.repeat(pa.scalar(run["offset"], pa.int32()), number),
            pa.array(pages, pa.int32()).take(pa.array(np.repeat(np.arange(len(pages)), counts))),
            pa.array(records, pa.string()),
            pa.repeat(pa.scalar(done, pa.bool_()), number),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=_STEP)

    def fetch(batches):
        turns = Turns(paging.per_minute, TaskContext.get().partitionId(), shares)
        for batch in batches:
            for run in batch.to_pylist():
                params = json.loads(run["request"])
                single = params.get(PAGE_PARAM) is None
                page = None if single else run["page"] or params[PAGE_PARAM] + run["offset"]
                # A request without pages has one answer, which its first stride fetches.
                done = single and run["offset"] > 0
                held, counts, numbers = [], [], []
                for _ in range(pages):
                    if done:
                        break
                    records = fetch_page(transport, params if single else {**params, PAGE_PARAM: page}, paging, turns)
                    done = single or not records
                    held += records
                    counts.append(len(records))
                    numbers.append(page)
                    if len(held) >= BATCH_RECORDS:
                        yield rows(run, numbers, counts, held, None)
                        held, counts, numbers = [], [], []
                    if not single:
                        page += paging.strides
                if held:
                    yield rows(run, numbers, counts, held, None)
                yield rows(run, [page], [1], [None], done)

    return placed.mapInArrow(fetch, STEP_COLUMNS)


@dataclass
class _Runs(InputPartition):
    """Requests fetched by one task, each with the offset of its stride, and the task's share of the calls."""

    runs: list[tuple[str, int]]
    mine: int
    shares: int


class PagedJsonSource(DataSource):
    """``spark.read.format("paged_json")`` for a short, given list of requests.

    Options: ``requests`` (JSON array of parameter objects), ``transport`` (a
    name given to ``register``), ``limitPages``, ``retries``, ``sleep``,
    ``strides``, ``perMinute``, ``maxParallel``. Requests that come from a table go through
    ``fetch_pages``.
    """

    transports: Mapping[str, Transport] = {}

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> DataSourceReader:
        options = {key.lower(): value for key, value in self.options.items()}
        paging = Paging(
            retries=int(options.get("retries", Paging.retries)),
            sleep=float(options.get("sleep", Paging.sleep)),
            limit_pages=int(options.get("limitpages", Paging.limit_pages)),
            strides=int(options.get("strides", Paging.strides)),
            per_minute=float(options.get("perminute", Paging.per_minute)),
        )
        return _PagedReader(
            self.transports[options["transport"]],
            json.loads(options["requests"]),
            paging,
            int(options.get("maxparallel", 1)),
        )


class _PagedReader(DataSourceReader):
    def __init__(self, transport: Transport, requests: list[dict], paging: Paging, max_parallel: int):
        self.transport = transport
        self.requests = [json.dumps(request, ensure_ascii=False) for request in requests]
        self.paging = paging
        self.max_parallel = max_parallel

    def partitions(self) -> list[InputPartition]:
        runs = [(request, offset) for request in self.requests for offset in range(self.paging.strides)]
        slots = max(1, min(self.max_parallel, len(runs)))
        return [_Runs(runs[slot::slots], slot, slots) for slot in range(slots)]

    def read(self, partition: _Runs) -> Iterator[pa.RecordBatch]:
        turns = Turns(self.paging.per_minute, partition.mine, partition.shares)
        for request, offset in partition.runs:
            yield from _batches(self.transport, request, self.paging, offset, turns)


def register(spark: SparkSession, **transports_by_name: Transport) -> None:
    """Make the ``paged_json`` format known, with these transports."""
    _ship_by_value()
    source = type("PagedJsonSource", (PagedJsonSource,), {"transports": dict(transports_by_name)})
    spark.dataSource.register(source)
