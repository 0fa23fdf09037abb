"""Fetching under one budget of calls, and landing that goes on where it was cut off."""

import gzip
import json
import time
from datetime import date
from pathlib import Path

import pytest

from monthstar.plans import land_extraction
from monthstar.plans.landing import fetch_in_steps
from monthstar.sinks import land_records
from monthstar.sources import read_json
from monthstar.sources.paged import Paging, Turns, fetch_pages, runs
from monthstar.sources.transports import RecordedPages, Reply


class Clock:
    def __init__(self):
        self.now = 1000.3

    def __call__(self):
        return self.now

    def sleep(self, seconds):
        self.now += seconds * 0.9 + 1e-4


def test_turns_of_tasks_do_not_meet():
    called = []
    for mine in range(8):
        clock = Clock()
        turns = Turns(30, mine, 8, clock, clock.sleep)
        for _ in range(20):
            turns.wait()
            called.append(int(clock() // 2))
            clock.now += 0.7
    assert len(called) == len(set(called)) == 160
    # One turn in each two seconds, none left out once all tasks have begun.
    assert max(called) - min(called) <= 160 + 8


def test_a_slow_call_skips_turns_and_never_doubles_one():
    clock = Clock()
    turns = Turns(60, 1, 2, clock, clock.sleep)
    used = []
    for late in (0, 5.5, 0, 0):
        turns.wait()
        used.append(int(clock()))
        clock.now += late
    assert len(set(used)) == 4 and all(turn % 2 == 1 for turn in used)


def test_no_budget_does_not_wait():
    Turns(0, sleep=None).wait()


class Logged:
    """Pages of two records for as many pages as the request says; every call is a line of a file."""

    def __init__(self, log, flag=None, fails=None):
        self.log, self.flag, self.fails = str(log), str(flag) if flag else None, fails

    def __call__(self, params):
        with open(self.log, "a") as log:
            log.write(json.dumps([time.time(), params]) + "\n")
        if self.fails is not None and Path(self.flag).exists() and params["lote"] >= self.fails:
            return Reply(500, "")
        lote, page = params["lote"], params.get("pagina")
        if page is not None and page > lote % 4:
            return Reply(200, "[]")
        return Reply(200, json.dumps([{"id": f"{lote}-{page}-{k}"} for k in range(2)]))


def calls(log):
    return [json.loads(line) for line in Path(log).read_text().splitlines()] if Path(log).exists() else []


def requests(spark, number):
    return spark.range(number).selectExpr("cast(id as int) as lote", "1 as pagina")


def expected(number):
    return sorted(f"{lote}-{page}-{k}" for lote in range(number) for page in range(1, lote % 4 + 1) for k in range(2))


def ids(rows):
    return sorted(json.loads(row["record"])["id"] for row in rows.collect())


def test_many_requests_of_eight_tasks_keep_one_rate(spark, tmp_path):
    log, per_minute = tmp_path / "calls", 6000
    found = fetch_pages(requests(spark, 200), Logged(log), Paging(0, 0, per_minute=per_minute), max_parallel=8)
    assert ids(found) == expected(200)
    times = sorted(at for at, _ in calls(log))
    assert len(times) == 500
    # No stretch of time holds more calls than its turns, two at its edges and some lateness of a task let in.
    for width in (50, 200, 400):
        least = min(b - a for a, b in zip(times, times[width:]))
        assert least >= (width - 20) * 60 / per_minute


@pytest.mark.parametrize("strides", [1, 3])
@pytest.mark.parametrize("step_calls", [1, 7, 1000])
def test_steps_fetch_what_one_fetch_does(spark, tmp_path, strides, step_calls):
    number = 3 if step_calls == 1 else 12
    paging = Paging(0, 0, strides=strides)
    asked = runs(requests(spark, number), paging)
    found = fetch_in_steps(asked, Logged(tmp_path / "calls"), paging, str(tmp_path / "journal"), 2, step_calls)
    assert ids(found) == expected(number)


def test_requests_without_pages_are_made_once(spark, tmp_path):
    paging = Paging(0, 0, strides=2)
    asked = runs(spark.range(3).selectExpr("cast(id as int) as lote"), paging)
    found = fetch_in_steps(asked, Logged(tmp_path / "calls"), paging, str(tmp_path / "journal"))
    assert len(ids(found)) == 6 and len(calls(tmp_path / "calls")) == 3


def test_a_landing_that_was_cut_off_fetches_only_the_rest(spark, tmp_path):
    log, flag, journal = tmp_path / "calls", tmp_path / "down", str(tmp_path / "journal")
    flag.touch()
    asked = runs(requests(spark, 40), Paging(0, 0))
    service = Logged(log, flag, fails=30)
    with pytest.raises(Exception, match="no page after"):
        fetch_in_steps(asked, service, Paging(0, 0), journal, 2, step_calls=8)
    kept = list(Path(journal).glob("step-*/_SUCCESS"))
    assert kept
    before = len(calls(log))
    # What a lost write leaves behind is no step.
    stray = Path(journal, f"step-{len(kept):06d}")
    stray.mkdir(exist_ok=True)
    flag.unlink()
    found = fetch_in_steps(asked, service, Paging(0, 0), journal, 2, step_calls=8)
    assert ids(found) == expected(40)
    made = [(p["lote"], p["pagina"]) for _, p in calls(log)[before:]]
    whole = {(lote, page) for lote in range(40) for page in range(1, lote % 4 + 2)}
    assert len(made) == len(set(made)) and len(made) < len(whole)
    # Every call is made once, save those of the step that failed.
    assert len(calls(log)) <= len(whole) + 8 * 4


def test_steps_of_quick_calls_grow_and_stay_few(spark, tmp_path):
    journal = tmp_path / "journal"
    asked = runs(requests(spark, 80), Paging(0, 0))
    found = fetch_in_steps(asked, Logged(tmp_path / "calls"), Paging(0, 0), str(journal), 2, step_calls=2)
    assert ids(found) == expected(80) and len(calls(tmp_path / "calls")) == 200
    assert 3 <= len(list(journal.glob("step-*/_SUCCESS"))) <= 16


def test_recorded_pages_read_the_block_asked_for(tmp_path):
    for block, pages in ((0, (1, 2)), (1, (3, 4)), (2, (5,))):
        folder = tmp_path / f"block={block}"
        folder.mkdir()
        lines = [json.dumps({"page": page, "items": [page, -page]}) for page in pages]
        (folder / "part-0.txt").write_text("\n".join(lines))
    service = RecordedPages(str(tmp_path), block=2)
    assert [json.loads(service({"pagina": page}).body) for page in (1, 2, 3, 4, 5)] == [[p, -p] for p in range(1, 6)]
    assert service({"pagina": 6}).body == service({"pagina": 7}).body == "[]"
    (tmp_path / "block=0" / "part-0.txt").write_text("not read")
    assert json.loads(RecordedPages(str(tmp_path), block=2)({"pagina": 4}).body) == [4, -4]


def test_raw_records_in_compressed_files_of_bounded_length(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = spark.range(0, 25, 1, 2).selectExpr("id", "concat('ação ', id) as name", "if(id = 3, null, id) as amount")
    land_records(rows, path, file_records=4)
    files = list(Path(path).glob("part-*"))
    assert files and all(file.name.endswith(".json.gz") for file in files)
    lines = [gzip.decompress(file.read_bytes()).decode("utf-8").splitlines() for file in files]
    assert max(map(len, lines)) == 4 and sum(map(len, lines)) == 25
    read = read_json(spark, path, "id long, name string, amount long", "unreadable_line")
    assert sorted(read.drop("unreadable_line").collect()) == sorted(rows.collect())
    land_records(rows.selectExpr("to_json(struct(*)) as record"), path, "record", file_records=4)
    assert sorted(read_json(spark, path, "id long, name string, amount long").collect()) == sorted(rows.collect())


class Service:
    """The three extractions over invented agencies; fails at an agency while a flag is there."""

    def __init__(self, endpoint, log, flag):
        self.endpoint, self.log, self.flag = endpoint, str(log), str(flag)

    def __call__(self, params):
        with open(self.log, "a") as log:
            log.write(json.dumps([self.endpoint, params]) + "\n")
        page, agency = params["pagina"], params.get("unidadeGestora")
        if page > 2:
            return Reply(200, "[]")
        if self.endpoint == "/orgaos-siafi":
            return Reply(200, json.dumps([{"codigo": f"{k + 10 * page:05d}"} for k in range(10)]))
        if agency == "00025" and Path(self.flag).exists():
            return Reply(503, "")
        return Reply(200, json.dumps([{"doc": f"{agency}-{params['fase']}-{page}"}]))


def test_landing_agency_documents_goes_on(spark, root, tmp_path):
    log, flag, day = tmp_path / "calls", tmp_path / "down", date(2020, 1, 3)
    flag.touch()

    def land(name):
        return land_extraction(
            spark, root, name, day, lambda path: Service(path, log, flag), Paging(0, 0), max_parallel=2, step_calls=12
        )

    land("government_agencies")
    with pytest.raises(Exception, match="no page after"):
        land("agency_expenses_documents")
    before = len(calls(log))
    assert before > 20
    flag.unlink()
    path = land("agency_expenses_documents")
    documents = sorted(row["doc"] for row in spark.read.json(path).collect())
    assert documents == sorted(f"{a:05d}-{f}-{p}" for a in range(10, 30) for f in (1, 2, 3) for p in (1, 2))
    again = [json.dumps(p) for _, p in calls(log)[before:]]
    assert len(again) < 20 * 3 * 3 and len(again) == len(set(again))
    assert not list(Path(root, "loading", "landing").glob("*"))
    # A landing that ended is fetched anew.
    before = len(calls(log))
    land("agency_expenses_documents")
    assert len(calls(log)) - before == 20 * 3 * 3
