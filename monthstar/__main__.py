"""Run one month of the spending star: ``python -m monthstar ROOT YEAR MONTH``.

Meant to be called by whatever schedules jobs, once per month and in order. The
session takes its settings from the environment, as with ``spark-submit``.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import SparkSession

from monthstar import SPENDING, SPENDING_WITH_TYPES, run_month
from monthstar.functions.text import NUMBER_MODES
from monthstar.sources import HttpGet
from monthstar.sources.paged import Paging

# Fixed value: name of the header that holds the key.
KEY_HEADER = "chave-api-dados"
#: Calls a minute that the service allows a key.
CALLS_PER_MINUTE = 30


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="monthstar", description="Run one month of the spending star.")
    parser.add_argument("root", help="folder that holds raw_data and receives the star")
    parser.add_argument("year", type=int)
    parser.add_argument("month", type=int)
    parser.add_argument("--with-types", action="store_true", help="load the expense type dimension too")
    parser.add_argument("--strict", action="store_true", help="drop members with any null column")
    parser.add_argument("--resume", action="store_true", help="go on with this month's run that failed")
    parser.add_argument("--versioned", action="store_true", help="keep dimensions and facts as versioned tables")
    parser.add_argument("--numbers", choices=NUMBER_MODES, default=NUMBER_MODES[0])
    parser.add_argument(
        "--fetch",
        action="store_true",
        help="fetch and land the month's card vouchers first, from the service at MONTHSTAR_SERVICE "
        "with the key in MONTHSTAR_SERVICE_KEY",
    )
    parser.add_argument(
        "--calls-per-minute", type=float, default=CALLS_PER_MINUTE, help="calls that all tasks of a fetch share"
    )
    given = parser.parse_args(arguments)

    options = {"resume": given.resume, "versioned": given.versioned}
    if given.fetch:
        address = os.environ.get("MONTHSTAR_SERVICE")
        if not address:
            parser.error("--fetch needs the service's address in MONTHSTAR_SERVICE")
        headers = {KEY_HEADER: os.environ.get("MONTHSTAR_SERVICE_KEY", "")}
        options["paging"] = Paging(sleep=0, per_minute=given.calls_per_minute)
        options["transport_for"] = lambda path: HttpGet(address.rstrip("/") + path, headers)
    star = (SPENDING_WITH_TYPES if given.with_types else SPENDING).with_number_mode(given.numbers)
    spark = SparkSession.builder.appName("monthstar").getOrCreate()
    measured = run_month(spark, given.root, star, given.year, given.month, strict=given.strict, **options)
    print(json.dumps(measured))


if __name__ == "__main__":
    main()
