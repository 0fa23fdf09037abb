"""What to ask a paged service for."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthstar.functions import request_date, request_month
from monthstar.functions.text import _column

# The phases of an expense document, and parameter names.
PHASES = (1, 2, 3)
PAGE = "pagina"
MONTH_FROM = "mesExtratoInicio"
MONTH_TO = "mesExtratoFim"
ISSUE_DATE = "dataEmissao"
PHASE = "fase"
AGENCY_PARAMS = {"codigo": "unidadeGestora"}


def month_requests(months: DataFrame, day: Column | str = "day") -> DataFrame:
    """One voucher request per distinct month among the given days."""
    distinct = months.select(F.trunc(_column(day), "month").alias("_month")).distinct()
    month = request_month("_month")
    return distinct.select(month.alias(MONTH_FROM), month.alias(MONTH_TO), F.lit(1).alias(PAGE))


def agency_requests(
    agencies: DataFrame, day: Column | str | date, params: Mapping[str, str] = AGENCY_PARAMS
) -> DataFrame:
    """A request per agency and expense phase for documents issued on a day.

    ``params`` maps columns of the agency list to parameter names. An agency
    that is listed twice is asked for once. Phases are generated per row, so
    nothing is joined.
    """
    issued = F.lit(day) if isinstance(day, date) else _column(day)
    listed = agencies.select(
        *[F.col(column).alias(name) for column, name in params.items()], request_date(issued).alias(ISSUE_DATE)
    ).distinct()
    return listed.select(
        *params.values(),
        F.lit(1).alias(PAGE),
        ISSUE_DATE,
        F.explode(F.array(*[F.lit(phase) for phase in PHASES])).alias(PHASE),
    )


@dataclass(frozen=True)
class Extraction:
    """A kind of extraction: the service path, where records land, and the
    requests for a day. ``needs`` names the extraction whose records the
    requests are built from, and ``parent_columns`` the fields read of them.
    ``month`` is the pattern of all folders that a reader of a month takes."""

    name: str
    endpoint: str
    folder: str
    requests: Callable[[SparkSession, date, DataFrame | None], DataFrame]
    needs: str | None = None
    parent_columns: tuple[str, ...] = ()
    month: str | None = None

    def landing(self, day: date) -> str:
        return self.folder.format(day=day)


def _one_day(spark: SparkSession, day: date) -> DataFrame:
    return spark.range(1).select(F.lit(day).alias("day"))


def _voucher_requests(spark: SparkSession, day: date, parents: DataFrame | None) -> DataFrame:
    return month_requests(_one_day(spark, day))


def _plain_requests(spark: SparkSession, day: date, parents: DataFrame | None) -> DataFrame:
    return spark.range(1).select(F.lit(1).alias(PAGE))


def _agency_requests(spark: SparkSession, day: date, parents: DataFrame | None) -> DataFrame:
    if parents is None:
        raise ValueError("agency expense documents need the agency list")
    return agency_requests(parents, day)


# Names, service paths and file names of the extractions.
EXTRACTIONS = {
    extraction.name: extraction
    for extraction in (
        Extraction(
            "corporate_card_expenses",
            "/cartoes",
            "raw_data/credit_card_vouchers/corporate-card-expenses-{day:%Y-%m}",
            _voucher_requests,
            month="raw_data/credit_card_vouchers/corporate-card-expenses-{day:%Y-%m}*",
        ),
        Extraction(
            "government_agencies",
            "/orgaos-siafi",
            "raw_data/credit_card_vouchers/government-agency-{day:%Y-%m-%d}",
            _plain_requests,
        ),
        Extraction(
            "agency_expenses_documents",
            "/despesas/documentos",
            "raw_data/credit_card_vouchers/agency-expenses-{day:%Y-%m-%d}",
            _agency_requests,
            needs="government_agencies",
            parent_columns=tuple(AGENCY_PARAMS),
        ),
    )
}


def extraction(name: str) -> Extraction:
    """The extraction of this name; an unknown one is an error."""
    if name not in EXTRACTIONS:
        raise ValueError(f"unknown extraction {name!r}; known: {', '.join(EXTRACTIONS)}")
    return EXTRACTIONS[name]
