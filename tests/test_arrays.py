"""Arrays of records cut at any place: against the standard parser."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from monthstar.sources import read_arrays, read_json
from monthstar.sources.arrays import _Begin, _Cutter, _Measure, records

SCHEMA = "id long, text string, deep struct<items: array<struct<name: string>>>"
NASTY = ['{', '}', '"', "\\", '\\"', '"}', '\\\\"', "[", "]", ",", "é", "漢", "\n", "}{", '{"a":"}"}', "\\u007d"]


def record(rng, k):
    word = "".join(rng.choice(NASTY + list("abc ")) for _ in range(rng.randrange(12)))
    items = [{"name": "".join(rng.choice(NASTY) for _ in range(rng.randrange(3)))} for _ in range(rng.randrange(4))]
    return {"id": k, "text": word, "deep": {"items": items}}


def many(number, seed=1):
    rng = random.Random(seed)
    return [record(rng, k) for k in range(number)]


def wanted(rows):
    return sorted((r["id"], r["text"], [i["name"] for i in r["deep"]["items"]]) for r in rows)


def got(df):
    return sorted((r["id"], r["text"], [i["name"] for i in r["deep"]["items"]]) for r in df.collect())


@pytest.fixture
def small_shares(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("indent, ascii_", [(None, False), (1, False), (None, True)])
def test_one_array_is_read_by_many_tasks(spark, tmp_path, small_shares, indent, ascii_):
    rows = many(900)
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=ascii_), encoding="utf-8")
    df = read_json(spark, str(tmp_path), SCHEMA)
    assert got(df) == wanted(rows)
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() >= 8
    assert read_json(spark, str(tmp_path), SCHEMA, "bad").where("bad is not null").count() == 0


def test_records_longer_than_a_part(spark, tmp_path, small_shares):
    rows = many(40)
    for k in (3, 4, 17, 39):
        rows[k]["text"] = ('{"}' * 9000)[: 20_000 + k]
    rows[20]["deep"]["items"] = [{"name": "}" * 30}] * 900
    (tmp_path / "a.json").write_text(json.dumps(rows))
    assert got(read_arrays(spark, str(tmp_path), SCHEMA)) == wanted(rows)


def test_files_beside_each_other(spark, tmp_path, small_shares):
    first, second, third = many(300, 2), many(200, 3), many(5, 4)
    (tmp_path / "a.json").write_text(json.dumps(first))
    (tmp_path / "b.json").write_text("\n".join(map(json.dumps, second)))
    (tmp_path / "c.json").write_text(json.dumps(third))
    (tmp_path / "d.json").write_text("﻿ \n" + json.dumps(third), encoding="utf-8")
    (tmp_path / "e.json").write_text("")
    (tmp_path / "_ignored").write_text("x" * 9000)
    assert got(read_json(spark, str(tmp_path / "[abc].json"), SCHEMA)) == wanted(first + second + third)
    assert got(read_arrays(spark, str(tmp_path), SCHEMA)) == wanted(first + second + third + third)


def test_arrays_on_many_lines_of_one_file(spark, tmp_path, small_shares):
    rows = many(600)
    lines = [json.dumps(rows[k : k + 50]) for k in range(0, 600, 50)]
    (tmp_path / "a.json").write_text("\n".join(lines) + "\n[]\n")
    assert got(read_json(spark, str(tmp_path), SCHEMA)) == wanted(rows)


def test_what_cannot_be_read_is_kept(spark, tmp_path):
    text = '[{"id": 1, "text": "a"}, oops, {"id": 2, "text": "b"}, {"id": x}, {"id": 3, "text": "c'
    (tmp_path / "a.json").write_text(text)
    rows = read_arrays(spark, str(tmp_path), SCHEMA, "bad").collect()
    assert sorted(r["id"] for r in rows if r["bad"] is None) == [1, 2]
    assert sorted(r["bad"] for r in rows if r["bad"] is not None) == ["oops", '{"id": 3, "text": "c', '{"id": x}']
    (tmp_path / "a.json").write_text('[{"id": 1}, {"id": 2')
    assert sorted(r[0] for r in records(spark, str(tmp_path)).collect()) == ['{"id": 1}', '{"id": 2']
    (tmp_path / "a.json").write_text('[{"id": 1}, {"id": 2}')
    assert sorted(r[0] for r in records(spark, str(tmp_path)).collect()) == ['{"id": 1}', '{"id": 2}']
    (tmp_path / "a.json").write_text("[]")
    assert records(spark, str(tmp_path)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 9), st.lists(st.integers(0, 400), max_size=6))
def test_any_cut_gives_the_same_records(seed, number, cuts):
    rows = many(number, seed)
    text = json.dumps(rows, ensure_ascii=False).encode()
    # The reader's parts end behind a brace.
    places = sorted({text.find(b"}", at) + 1 for at in cuts if text.find(b"}", at) >= 0})
    parts = [p for p in (text[a:b] for a, b in zip([0, *places], [*places, len(text)])) if p]
    begins, now = {}, _Begin(False, 0, None)
    for k, part in enumerate(parts):
        begins["f", k] = _Begin(now.inside, now.open, now.began, k + 1 == len(parts))
        both = [_Measure(False), _Measure(True)]
        for one in both:
            one.feed(part)
        mine = both[now.inside]
        began = now.began if now.open and now.open + mine.least > 0 else k
        open_ = now.open + mine.total - min(0, now.open + mine.least)
        now = _Begin(mine.inside, open_, began if open_ else None)
    cutter = _Cutter(begins)
    for k, part in enumerate(parts):
        cutter.take(("f", k), part if k + 1 == len(parts) else part[:-1])
    cutter.end()
    crossing = {}
    for _, began, first, piece in cutter.out:
        if began is not None:
            crossing.setdefault(began, []).append((first, piece))
    found = [piece for _, began, _, piece in cutter.out if began is None]
    found += [b"".join(piece for _, piece in sorted(pieces)) for pieces in crossing.values()]
    assert sorted(json.loads(r)["id"] for r in found) == list(range(number))
    assert sorted(map(json.dumps, map(json.loads, found))) == sorted(map(json.dumps, rows))
