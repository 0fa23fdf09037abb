from dataclasses import replace

import pytest

from monthstar import SPENDING_WITH_TYPES, run_month
from monthstar.errors import NullKeyError
from monthstar.plans import month as plan
from monthstar.plans.journal import made_from
from monthstar.specs import Star
from tests.test_month import LENIENT, snapshot, write_february, write_january

STRICT_CHECK = Star(LENIENT.dimensions, tuple(replace(fact, max_null_percent=0) for fact in LENIENT.facts))


@pytest.fixture
def steps(monkeypatch):
    """The steps that are really run."""
    done = []
    for name in ("distinct_rows", "stage_source", "load_dimension", "load_fact"):

        def run(*args, _name=name, _real=getattr(plan, name), **options):
            done.append(_name)
            return _real(*args, **options)

        monkeypatch.setattr(plan, name, run)
    return done


def test_a_mended_check_runs_only_what_had_not_ended(spark, root, tmp_path, steps):
    write_january(root)
    with pytest.raises(NullKeyError):
        run_month(spark, root, STRICT_CHECK, 2020, 1)
    steps.clear()
    measured = run_month(spark, root, LENIENT, 2020, 1, resume=True)
    assert set(steps) == {"load_fact"}
    other = str(tmp_path / "other")
    write_january(other)
    assert measured == run_month(spark, other, LENIENT, 2020, 1)
    assert snapshot(spark, root) == snapshot(spark, other)
    # A run that has ended leaves no marks: the next is whole.
    steps.clear()
    run_month(spark, root, LENIENT, 2020, 1, resume=True)
    assert {"stage_source", "load_dimension", "load_fact"} <= set(steps)


def test_another_month_or_changed_files_start_again(spark, root, steps):
    write_january(root)
    for change in (lambda: write_january(root), lambda: write_february(root)):
        with pytest.raises(NullKeyError):
            run_month(spark, root, STRICT_CHECK, 2020, 1)
        change()
        steps.clear()
        month = 2 if change.__code__.co_names[0] == "write_february" else 1
        run_month(spark, root, LENIENT, 2020, month, resume=True)
        assert {"stage_source", "load_dimension", "load_fact"} <= set(steps)


def test_prints_tell_specifications_apart():
    plain, comma = SPENDING_WITH_TYPES, SPENDING_WITH_TYPES.with_number_mode("comma_only")
    assert made_from(plain) == made_from(SPENDING_WITH_TYPES)
    assert made_from(plain.facts) != made_from(comma.facts)
    assert made_from(plain, True) != made_from(plain, False)
