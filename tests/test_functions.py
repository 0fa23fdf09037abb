import math
import random
from datetime import date, datetime

import pytest

from monthstar.functions import all_but_yes, br_date, br_number


def evaluate(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    return [row[1] for row in rows.select("i", expression.alias("v")).orderBy("i").collect()]


DATES = ["05/01/2020", "2020-01-05", "5/1/2020", "31/02/2020", "", " 05/01/2020", None, "29/02/2020"]


def test_br_date(spark):
    want = [date(2020, 1, 5), None, None, None, None, None, None, date(2020, 2, 29)]
    assert evaluate(spark, DATES, br_date("text")) == want


NUMBERS = ["10,50", "1.234,56", "-3,00", " 7,1 ", "-1.000.000,01", "", "abc", "1,2,3", None, "12"]


def test_br_number(spark):
    want = [10.5, 1234.56, -3.0, 7.1, -1000000.01, None, None, None, None, 12.0]
    assert evaluate(spark, NUMBERS, br_number("text")) == want


def test_comma_only_number(spark):
    want = [10.5, None, -3.0, 7.1, None, None, None, None, None, 12.0]
    assert evaluate(spark, NUMBERS, br_number("text", mode="comma_only")) == want


def test_number_in_a_session_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert evaluate(spark, ["abc", "1,5"], br_number("text")) == [None, 1.5]
        assert evaluate(spark, ["31/02/2020"], br_date("text")) == [None]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_unknown_number_mode():
    with pytest.raises(ValueError):
        br_number("text", mode="points")


def test_flag(spark):
    assert evaluate(spark, ["SIM", "NÃO", "sim", "", None], all_but_yes("text")) == [False, True, True, True, True]


def test_not_a_number_text_is_kept_as_the_cast_gives_it(spark):
    (value,) = evaluate(spark, ["NaN"], br_number("text"))
    assert math.isnan(value)


def plain_number(text, thousands):
    text = text.strip(" ")
    if thousands:
        text = text.replace(".", "")
    try:
        return float(text.replace(",", "."))
    except ValueError:
        return None


@pytest.mark.parametrize("mode", ["thousands", "comma_only"])
def test_random_text_as_numbers(spark, mode):
    draw = random.Random(11)
    texts = ["".join(draw.choices("0123456789,.-+E ", k=draw.randrange(9))) for _ in range(3000)]
    texts += [f"{draw.uniform(-1e7, 1e7):,.2f}".translate(str.maketrans(",.", ".,")) for _ in range(1000)]
    want = [plain_number(text, mode == "thousands") for text in texts]
    assert evaluate(spark, texts, br_number("text", mode)) == want


def test_random_text_as_dates(spark):
    draw = random.Random(12)
    texts = [
        f"{draw.randrange(40):0{draw.choice([1, 2, 2, 2])}d}/{draw.randrange(15):02d}/{draw.randrange(1900, 2100)}"
        for _ in range(3000)
    ]

    def plain_date(text):
        try:
            return datetime.strptime(text, "%d/%m/%Y").date() if len(text) == 10 else None
        except ValueError:
            return None

    assert evaluate(spark, texts, br_date("text")) == [plain_date(text) for text in texts]
