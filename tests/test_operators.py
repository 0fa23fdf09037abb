"""Operators against plain Python on small inputs."""

import random

import pytest
from pyspark.sql import functions as F

from monthstar.errors import DuplicateKeyError, EmptyFactError, NullKeyError, TooFewRowsError
from monthstar.operators import (
    Lookup,
    dedupe_by_key,
    drop_incomplete,
    drop_null_keys,
    duplicate_keys,
    enforce_duplicate_keys,
    enforce_null_keys,
    enforce_rows,
    in_period,
    key_bytes,
    literal_period,
    max_id,
    merge_members,
    new_members,
    next_id_start,
    null_keys,
    number_rows,
    rename,
    resolve,
    row_count,
    split_period,
    union_sources,
)
from monthstar.specs import leaf, text


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


# Half of the rows share one key.
def hot_rows(count=4000, seed=7):
    draw = random.Random(seed)
    return [
        (1 if draw.random() < 0.5 else draw.randrange(400), draw.choice(["a", "b", None]), draw.randrange(50))
        for _ in range(count)
    ]


@pytest.mark.parametrize("repeated", [False, True])
def test_dedupe_keeps_the_fullest_and_then_the_smallest_row(spark, repeated):
    data = hot_rows()
    best = {}
    for key, label, number in data:
        rest = (label is None, label or "", number)
        if key not in best or rest < best[key][0]:
            best[key] = (rest, (key, label, number))
    df = spark.createDataFrame(data, "k int, label string, n int").repartition(7)
    assert rows(dedupe_by_key(df, ["k"], repeated)) == sorted((row for _, row in best.values()), key=str)


def test_dedupe_keeps_column_order(spark):
    df = spark.createDataFrame([("x", 1, "y")], "a string, k int, b string")
    assert dedupe_by_key(df, ["k"]).columns == ["a", "k", "b"]
    assert dedupe_by_key(df.select("k"), ["k"]).collect() == [(1,)]


def test_dedupe_aggregates_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 3 as k", "cast(id as string) as v")
    plan = dedupe_by_key(df, ["k"], repeated=True)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert plan.count("HashAggregate") == 2


def test_null_rules(spark):
    data = [(1, "a", None), (None, "b", "x"), (3, None, "y"), (4, "d", "z")]
    df = spark.createDataFrame(data, "k int, l string, v string")
    assert rows(drop_null_keys(df, ["k", "l"])) == [(1, "a", None), (4, "d", "z")]
    assert rows(drop_incomplete(df)) == [(4, "d", "z")]


def test_new_members_ignore_null_matches(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, l string")
    known = spark.createDataFrame([(1, "a", 9), (2, None, 9), (3, "x", 9)], "k int, l string, id int")
    assert rows(new_members(left, known, ["k", "l"])) == [(2, None), (3, "c")]


def test_union_matches_names_and_keeps_copies(spark):
    left = spark.createDataFrame([(1, "a")], "k int, l string")
    right = spark.createDataFrame([("a", 1)], "l string, k int")
    assert rows(union_sources(left, right, left)) == [(1, "a")] * 3


def test_merge_columns_and_values(spark):
    left = spark.createDataFrame([(1, "L1", "a"), (2, "L2", None), (3, "L3", "c")], "k int, only_l string, s string")
    right = spark.createDataFrame([("R2", 2, "b"), ("R3", 3, "x"), ("R4", 4, "d")], "only_r string, k int, s string")
    merged = merge_members(left, right, ["k"])
    assert merged.columns == ["k", "only_l", "only_r", "s"]
    assert rows(merged) == [(1, "L1", None, "a"), (2, "L2", "R2", "b"), (3, "L3", "R3", "c"), (4, None, "R4", "d")]


@pytest.mark.parametrize("buckets", [1, 3, 64])
def test_numbers_are_dense_and_do_not_depend_on_partitioning(spark, buckets):
    keys = [(f"k{i}", i % 5) for i in range(500)]
    df = spark.createDataFrame(keys, "a string, b int")
    one = number_rows(df.coalesce(1), ["a", "b"], "x_id", start=10, buckets=buckets)
    many = number_rows(df.repartition(9), ["a", "b"], "x_id", start=10, buckets=buckets)
    assert one.columns == ["x_id", "a", "b"]
    assert rows(one) == rows(many)
    assert sorted(row["x_id"] for row in one.collect()) == list(range(11, 511))


def test_numbering_nothing(spark):
    empty = spark.createDataFrame([], "a string")
    assert number_rows(empty, ["a"], "x_id").collect() == []


def test_largest_id(spark):
    assert next_id_start(spark.createDataFrame([], "x_id bigint"), "x_id") == 0
    assert max_id(spark.createDataFrame([(4,), (9,)], "x_id bigint"), "x_id").collect() == [(9,)]


def test_projection_of_structs(spark):
    df = spark.createDataFrame(
        [(1, (("x",),)), (2, None), (3, (None,))], "k int, a struct<b: struct<c: string>>"
    )
    picked = rename(df, [text("key", "k"), leaf("value", "a.b.c")])
    assert rows(picked) == [(1, "x"), (2, None), (3, None)]


def test_headers_with_odd_characters(spark):
    df = spark.createDataFrame([("1", "2")], ["Valor pra R$", "a.b`c"])
    assert rename(df, [text("x", "Valor pra R$"), text("y", "a.b`c")]).collect() == [("1", "2")]


def test_period_split_keeps_every_row_once(spark):
    data = [(1, 2020, 1), (2, 2020, 2), (3, None, None), (4, 2020, None)]
    df = spark.createDataFrame(data, "k int, year int, month int")
    inside, outside = split_period(df, 2020, 1)
    assert rows(inside) == [(1, 2020, 1)]
    assert [row[0] for row in rows(outside)] == [2, 3, 4]
    assert literal_period(df.select("k"), 2020, 8).dtypes == [("k", "int"), ("year", "int"), ("month", "int")]


@pytest.mark.parametrize("year, month", [(2020, 2), (2019, 12), (2020, 1)])
def test_period_of_a_date_column(spark, year, month):
    days = spark.sql("select explode(sequence(date'2019-11-25', date'2020-03-05')) as day")
    want = days.where(f"year(day) = {year} and month(day) = {month}")
    assert rows(days.where(in_period(year, month, "day"))) == rows(want)


LOOKUP_SCHEMA = "k int, l string, n int"


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
@pytest.mark.parametrize("heavy_keys", [1, 5, 10_000])
def test_resolve_with_a_hot_key_and_nulls(spark, broadcast_bytes, heavy_keys):
    facts = spark.createDataFrame(hot_rows(), LOOKUP_SCHEMA).repartition(6)
    members = [(k, l, k * 10 + (l == "b")) for k in range(0, 400, 2) for l in ("a", "b")] + [(1, "a", 7)]
    dimension = spark.createDataFrame(members, "k int, l string, k_id int")
    ids = {(k, l): i for k, l, i in members}
    resolved = resolve(facts, [Lookup(dimension, ("k", "l"), ("k_id",))], ["l"], broadcast_bytes, heavy_keys)
    want = sorted(((k, n, ids.get((k, l))) for k, l, n in hot_rows()), key=str)
    assert resolved.columns == ["k", "n", "k_id"]
    assert rows(resolved) == want


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_lookups_in_a_chain(spark, broadcast_bytes):
    facts = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    first = spark.createDataFrame([(1, 10, 5), (2, 20, 6)], "k int, k_id int, place int")
    second = spark.createDataFrame([(5, 50)], "place int, place_id int")
    lookups = [Lookup(first, ("k",), ("k_id", "place")), Lookup(second, ("place",), ("place_id",))]
    resolved = resolve(facts, lookups, ["place"], broadcast_bytes)
    assert rows(resolved.select("k", "k_id", "place_id")) == [
        (1, 10, 50), (2, 20, None), (3, None, None), (None, None, None)
    ]


def test_lookup_on_keys_of_other_types(spark):
    facts = spark.range(3).selectExpr("cast(id as int) as k")
    dimension = spark.range(3).selectExpr("id as k", "id as k_id")
    with pytest.raises(ValueError, match="another type"):
        resolve(facts, [Lookup(dimension, ("k",), ("k_id",))])


def test_small_lookups_do_not_shuffle_the_facts(spark):
    facts = spark.range(1000).selectExpr("id as k")
    dimension = spark.range(10).selectExpr("id as k", "id as k_id")
    lookup = Lookup(dimension, ("k",), ("k_id",))
    small = resolve(facts, [lookup])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in small and "hashpartitioning" not in small
    large = resolve(facts, [lookup], broadcast_bytes=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in large and "broadcast" not in large


@pytest.mark.parametrize("count", [1, 2, 3])
def test_large_lookups_read_the_facts_once(spark, tmp_path, count):
    path = str(tmp_path / "facts")
    spark.range(100).selectExpr(*[f"id as k{n}" for n in range(count)], "id as amount").write.parquet(path)
    lookups = [
        Lookup(spark.range(50).selectExpr(f"id as k{n}", f"id as k{n}_id"), (f"k{n}",), (f"k{n}_id",))
        for n in range(count)
    ]
    resolved = resolve(spark.read.parquet(path), lookups, broadcast_bytes=0)
    assert resolved._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert resolved.count() == 100


def test_one_broadcast_budget_for_all_lookups(spark):
    facts = spark.range(10).selectExpr("id as a", "id as b")
    lookups = [Lookup(spark.range(5).selectExpr(f"id as {k}", f"id as {k}_id"), (k,), (f"{k}_id",)) for k in "ab"]
    both = resolve(facts, lookups, broadcast_bytes=100, sizes=[60, 50])._jdf.queryExecution().optimizedPlan().toString()
    assert both.count("_salt") and both.count("strategy=broadcast") == 1


def test_hot_keys_are_spread(spark):
    facts = spark.range(9000).selectExpr("if(id % 3 = 0, null, if(id % 3 = 1, 7, id)) as k", "id as n")
    dimension = spark.range(9000).selectExpr("id as k", "id + 1 as k_id")
    resolved = resolve(facts, [Lookup(dimension, ("k",), ("k_id",))], broadcast_bytes=0)
    assert resolved.where("k_id = k + 1").count() == 6000 and resolved.where("k_id is null").count() == 3000
    salted = resolved._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in salted


def test_member_size_counts_rows_and_text(spark):
    empty = spark.createDataFrame([], "k string, i int")
    assert key_bytes([]) == []
    short = spark.createDataFrame([("a", 1)] * 10, "k string, i int")
    long = spark.createDataFrame([("a" * 101, 1)] * 10, "k string, i int")
    sizes = key_bytes([empty, short, long])
    assert sizes[0] == 0
    assert sizes[2] - sizes[1] == 1000


def fact(spark, complete, missing):
    data = [(1, 1)] * complete + [(1, None)] * missing
    return spark.createDataFrame(data, "a int, b int").selectExpr("*", "2020 as year", "1 as month")


def test_null_key_share(spark):
    measured = null_keys(fact(spark, 3, 1), ["a", "b"])
    assert measured.collect() == [(4, 1, 25.0)]
    assert null_keys(fact(spark, 3, 1).limit(0), ["a"]).collect() == [(0, 0, None)]
    with pytest.raises(KeyError):
        null_keys(fact(spark, 1, 1), [])


def test_null_key_threshold(spark):
    assert enforce_null_keys(fact(spark, 98, 2), ["a", "b"], 2, (2020, 1))["null_key_pct"] == 2.0
    with pytest.raises(NullKeyError):
        enforce_null_keys(fact(spark, 97, 3), ["a", "b"], 2, (2020, 1))
    with pytest.raises(KeyError):
        enforce_null_keys(fact(spark, 97, 3), ["a", "b"], 2)
    with pytest.raises(EmptyFactError):
        enforce_null_keys(fact(spark, 98, 0), ["a", "b"], 2, (2020, 2))


def test_row_threshold(spark):
    df = fact(spark, 5, 0)
    assert row_count(df, 5).collect() == [(5, True)]
    assert row_count(df, 6, (2020, 1)).collect() == [(5, False)]
    assert enforce_rows(df, 5)["n_rows"] == 5
    with pytest.raises(TooFewRowsError):
        enforce_rows(df, 1, (2021, 1))
    with pytest.raises(ValueError):
        enforce_rows(df, 6)


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (2, None), (2, None), (None, "x")], "k int, l string")
    assert duplicate_keys(df, ["k", "l"]).collect() == [(1,)]
    assert duplicate_keys(df, ["k"]).collect() == [(2,)]
    with pytest.raises(DuplicateKeyError) as caught:
        enforce_duplicate_keys(df, ["k"], "vendor")
    assert str(caught.value) == "vendor: 2 duplicate keys on ['k']"
    assert enforce_duplicate_keys(df.where(F.col("k") == 1), ["k", "l"]) == {"duplicate_keys": 0}


def test_duplicate_keys_of_later_rows(spark):
    rows = [(1, "a", 1), (2, None, 1), (3, "b", 1), (4, "c", 1), (5, "c", 1)]
    df = spark.createDataFrame(rows, "id long, k string, l int")
    assert duplicate_keys(df, ["k", "l"], "id", 0).collect() == duplicate_keys(df, ["k", "l"]).collect() == [(1,)]
    assert duplicate_keys(df, ["k", "l"], "id", 5).collect() == [(0,)]
    more = spark.createDataFrame([(6, "a", 1), (7, None, 1), (None, "b", 1), (8, "d", 1)], df.schema)
    across = df.where("id < 5").union(more)
    assert duplicate_keys(across, ["k", "l"], "id", 4).collect() == duplicate_keys(across, ["k", "l"]).collect() == [(3,)]
    with pytest.raises(DuplicateKeyError):
        enforce_duplicate_keys(across, ["k", "l"], "vendor", "id", 4)
