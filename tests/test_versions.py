from concurrent.futures import ThreadPoolExecutor

import pytest

from monthstar import run_month
from monthstar.errors import VersionConflictError
from monthstar.plans.dimension import load_dimension
from monthstar.sinks import commit_partitions, commit_rows, drop_unused, overwrite_table
from monthstar.sources import read_optional, read_period, read_table
from monthstar.sources.files import is_empty, join_path
from monthstar.sources.versions import Version, read_parts, read_version, version_numbers
from tests.test_month import LENIENT, write_february, write_january


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def months(spark, shift=0, only=""):
    rows = spark.range(60).selectExpr(f"id + {shift} as id", "2020 as year", "cast(1 + id % 3 as int) as month")
    return rows.where(only) if only else rows


def ids(df):
    return sorted(row["id"] for row in df.collect())


def test_only_partitions_with_rows_are_replaced(spark, path):
    assert commit_partitions(months(spark), path, gather=True) == 1
    assert commit_partitions(months(spark, 1000, "month = 2"), path) == 2
    want = sorted([i for i in range(60) if i % 3 != 1] + [i + 1000 for i in range(60) if i % 3 == 1])
    table = read_table(spark, path)
    assert ids(table) == want and table.columns == ["id", "year", "month"]
    assert ids(read_parts(spark, path, read_version(spark, path, 1))) == list(range(60))
    assert ids(read_period(spark, path, 2020, 2)) == [i + 1000 for i in range(60) if i % 3 == 1]
    assert read_period(spark, path, 2021, 1).columns == ["id", "year", "month"]
    assert ids(read_period(spark, path, 2021, 1)) == []


def test_filters_on_partitions_reach_the_scan(spark, path):
    commit_partitions(months(spark), path)
    commit_partitions(months(spark, 1000, "month = 2"), path)
    plan = read_table(spark, path).where("month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_rows_are_added(spark, path):
    schema = spark.range(1).schema
    assert ids(read_optional(spark, path, schema)) == []
    commit_rows(spark.range(5), path)
    commit_rows(spark.range(5, 9), path)
    commit_rows(spark.range(0), path)
    assert ids(read_table(spark, path)) == ids(read_optional(spark, path, schema)) == list(range(9))


def test_second_writer_on_a_version_is_refused_and_leaves_nothing(spark, path):
    commit_rows(spark.range(5), path)
    base = read_version(spark, path)
    commit_rows(spark.range(5, 9), path, base)
    with pytest.raises(VersionConflictError):
        commit_rows(spark.range(100), path, base)
    assert ids(read_table(spark, path)) == list(range(9))
    assert drop_unused(spark, path, keep=2) == []


def test_of_writers_at_the_same_time_one_wins(spark, path):
    def write(start):
        try:
            return commit_rows(spark.range(start, start + 10), path, Version())
        except VersionConflictError:
            return None

    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(write, [0, 10, 20, 30]))
    assert sorted(done, key=str) == [1, None, None, None]
    start = 10 * done.index(1)
    assert ids(read_table(spark, path)) == list(range(start, start + 10))


def test_version_before_stays_where_a_write_fails(spark, path):
    commit_partitions(months(spark), path)
    broken = months(spark, 1000).selectExpr("if(id = 1059, raise_error('lost'), id) as id", "year", "month")
    with pytest.raises(Exception, match="lost"):
        commit_partitions(broken, path)
    assert version_numbers(spark, path) == [1] and ids(read_table(spark, path)) == list(range(60))


def test_killed_first_write_is_no_table_yet(spark, path, tmp_path):
    (tmp_path / "table" / "_versions").mkdir(parents=True)
    spark.range(3).write.parquet(f"{path}/data/commit=lost")
    assert is_empty(spark, path)
    assert ids(read_optional(spark, path, spark.range(1).schema)) == []
    with pytest.raises(FileNotFoundError):
        read_table(spark, path)
    commit_rows(spark.range(7), path)
    assert ids(read_table(spark, path)) == list(range(7))
    assert [f.rpartition("=")[2] for f in drop_unused(spark, path)] == ["lost"]


def test_unused_folders_are_dropped(spark, path):
    commit_partitions(months(spark), path)
    commit_partitions(months(spark, 1000, "month = 2"), path)
    want = ids(read_table(spark, path))
    dropped = drop_unused(spark, path)
    assert len(dropped) == 1 and dropped[0].endswith("year=2020/month=2")
    assert version_numbers(spark, path) == [2] and ids(read_table(spark, path)) == want
    assert commit_partitions(months(spark, 2000, "month = 1"), path) == 3


def snapshot(spark, root):
    tables = [("dimension", d.name) for d in LENIENT.dimensions] + [("fact", f.name) for f in LENIENT.facts]
    found = {}
    for table in tables:
        rows = read_table(spark, join_path(root, *table))
        found[table] = sorted(map(str, rows.select(*sorted(rows.columns)).collect()))
    return found


def test_months_of_versioned_tables_equal_plain_ones(spark, tmp_path):
    roots = {versioned: str(tmp_path / str(versioned)) for versioned in (False, True)}
    for versioned, root in roots.items():
        write_january(root)
        run_month(spark, root, LENIENT, 2020, 1, versioned=versioned)
        write_february(root)
        run_month(spark, root, LENIENT, 2020, 2, versioned=versioned)
        run_month(spark, root, LENIENT, 2020, 2, versioned=versioned)
    assert snapshot(spark, roots[True]) == snapshot(spark, roots[False])
    assert read_version(spark, join_path(roots[True], "fact", LENIENT.facts[0].name)).number == 3


def test_dimension_moved_on_while_loading_is_refused(spark, root, monkeypatch):
    from monthstar.plans import dimension as plan

    write_january(root)
    run_month(spark, root, LENIENT, 2020, 1, versioned=True)
    write_february(root)
    table = LENIENT.dimensions[0]
    stored = join_path(root, "dimension", table.name)
    before = read_table(spark, stored).count()

    def late(df, path):
        overwrite_table(df, path)
        commit_rows(read_table(spark, stored).limit(0), stored)

    monkeypatch.setattr(plan, "overwrite_table", late)
    with pytest.raises(VersionConflictError):
        load_dimension(spark, root, table, versioned=True)
    assert read_table(spark, stored).count() == before
