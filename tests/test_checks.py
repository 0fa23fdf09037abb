"""Checks that go on from the ids that the last one saw."""

import pytest
from pyspark.sql import functions as F

from monthstar.errors import DuplicateKeyError
from monthstar.plans import run_check
from monthstar.sinks import append_dimension
from monthstar.sources.files import DIMENSION, LOADING, join_path, read_table


def add(spark, root, rows):
    append_dimension(spark.createDataFrame(rows, "id long, k string"), join_path(root, DIMENSION, "vendor"))


def check(spark, root, keys=("k",)):
    return run_check(spark, root, "dimension_duplicate_keys", "vendor", keys, id_column="id")


def checked(spark, root):
    return read_table(spark, join_path(root, LOADING, "checked-vendor")).first()["checked"]


def test_a_duplicate_across_the_mark_is_found_again_and_again(spark, root):
    add(spark, root, [(1, "a"), (2, "b")])
    assert check(spark, root) == {"duplicate_keys": 0}
    add(spark, root, [(3, "c"), (4, None)])
    assert check(spark, root) == {"duplicate_keys": 0}
    assert checked(spark, root) == 4
    add(spark, root, [(5, "a"), (6, None), (7, "d")])
    for _ in range(2):
        with pytest.raises(DuplicateKeyError, match="2 duplicate keys"):
            check(spark, root)
    assert checked(spark, root) == 4


def test_rows_added_below_the_mark_are_checked(spark, root):
    add(spark, root, [(1, "a"), (3, "b")])
    check(spark, root)
    add(spark, root, [(2, "b")])
    with pytest.raises(DuplicateKeyError):
        check(spark, root)


def test_other_keys_are_checked_from_the_start(spark, root):
    path = join_path(root, DIMENSION, "vendor")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, k string").withColumn("l", F.lit(1))
    append_dimension(rows, path)
    check(spark, root, ("k",))
    with pytest.raises(DuplicateKeyError):
        check(spark, root, ("l",))
