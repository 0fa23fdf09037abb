"""Files, optional tables, paged services, requests, landing."""

import http.client
import json
import urllib.error
from datetime import date
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from monthstar.errors import FetchError
from monthstar.plans import land_extraction
from monthstar.sinks import land_records, overwrite_partitions, scratch_folder
from monthstar.sources import (
    EXTRACTIONS,
    HttpGet,
    RecordedPages,
    Reply,
    agency_requests,
    extraction,
    fetch_pages,
    month_requests,
    read_csv,
    read_family,
    read_json,
    read_optional,
    read_staged,
    register,
)
from monthstar.sources import paged
from monthstar.sources.paged import Paging
from monthstar.specs import Family
from monthstar.specs.spending import PAYMENTS, VOUCHER_SCHEMA, VOUCHERS
from tests.spending_files import EDUCATION, shop, voucher, write_january

def rows_of(df):
    return sorted(tuple(row) for row in df.collect())


QUICK = Paging(retries=2, sleep=0)


class Pages:
    """A transport over given pages; some calls fail before they succeed."""

    def __init__(self, pages, failures=0, error=None):
        self.pages = pages
        self.failures = failures
        self.error = error
        self.calls = []

    def __call__(self, params):
        self.calls.append(dict(params))
        if self.failures:
            self.failures -= 1
            if self.error:
                raise self.error
            return Reply(503, "busy")
        page = params.get("pagina") or 1
        records = self.pages[page - 1] if page <= len(self.pages) else []
        return Reply(200, json.dumps(records))


def fetched(transport, params, paging=QUICK, offset=0):
    pages = paged.pages_of(transport, params, paging, offset)
    return [(page, [json.loads(record) for record in records]) for page, records in pages]


def test_records_stay_as_sent():
    body = ' [ {"a": 12345678901234567.89, "b": 1e400},\n {"t": "x,]\\n",\n "c": 1.10} , 7,"s" ]\n'
    assert paged.records_of(body) == [
        '{"a": 12345678901234567.89, "b": 1e400}', '{"t": "x,]\\n",  "c": 1.10}', "7", '"s"'
    ]
    assert paged.records_of(" [] ") == paged.records_of("[ \n ]") == []
    with pytest.raises(ValueError):
        paged.records_of('{"error": "x"}')


def test_pages_until_an_empty_one():
    service = Pages([[{"a": 1}, {"a": 2}], [{"a": 3}]])
    assert fetched(service, {"pagina": 1, "x": "y"}) == [(1, [{"a": 1}, {"a": 2}]), (2, [{"a": 3}])]
    assert [call["pagina"] for call in service.calls] == [1, 2, 3]
    assert {call["x"] for call in service.calls} == {"y"}


def test_page_limit():
    service = Pages([[1], [2], [3]])
    assert fetched(service, {"pagina": 1}, Paging(0, 0, limit_pages=2)) == [(1, [1]), (2, [2])]
    assert len(service.calls) == 2
    assert fetched(Pages([[1], [2], [3]]), {"pagina": 3}, Paging(0, 0, limit_pages=1)) == [(3, [3])]


def test_request_without_page_number_has_one_page():
    service = Pages([[1, 2]])
    assert fetched(service, {"x": 1}) == [(None, [1, 2])]
    assert len(service.calls) == 1
    assert fetched(Pages([[1]]), {"x": 1}, offset=1) == []


@pytest.mark.parametrize("limit", [0, 3, 4])
@pytest.mark.parametrize("strides", [1, 2, 3, 7])
def test_strides_fetch_the_same_pages(strides, limit):
    pages = [[i] for i in range(5)]
    paging = Paging(0, 0, limit, strides)
    got = [page for offset in range(strides) for page in fetched(Pages(pages), {"pagina": 1}, paging, offset)]
    assert sorted(got) == fetched(Pages(pages), {"pagina": 1}, Paging(0, 0, limit))


@pytest.mark.parametrize("error", [None, ConnectionError("down")])
def test_retries(error):
    assert fetched(Pages([[1]], 2, error), {"pagina": 1})[0] == (1, [1])
    service = Pages([[1]], 3, error)
    with pytest.raises(FetchError):
        fetched(service, {"pagina": 1})
    assert len(service.calls) == 3


def test_sleep_comes_before_every_call(monkeypatch):
    naps = []
    monkeypatch.setattr(paged.time, "sleep", naps.append)
    fetched(Pages([[1], [2]]), {"pagina": 1}, Paging(0, sleep=1.5))
    assert naps == [1.5] * 3


def write_pages(root, lote, pages):
    folder = Path(root, f"lote={lote}")
    folder.mkdir(parents=True)
    lines = [json.dumps({"page": i, "items": items}, ensure_ascii=False) for i, items in enumerate(pages, 1)]
    (folder / "pages.json").write_text("\n".join(lines), encoding="utf-8")


@pytest.mark.parametrize("strides", [1, 3])
@pytest.mark.parametrize("max_parallel", [1, 4, None])
def test_fetching_a_table_of_requests(spark, tmp_path, strides, max_parallel):
    write_pages(tmp_path, 1, [[{"n": "ação"}, {"n": "b"}], [{"n": "c"}]])
    write_pages(tmp_path, 2, [[{"n": "d"}]])
    requests = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "lote int, pagina int")
    paging = Paging(0, 0, strides=strides)
    result = fetch_pages(requests, RecordedPages(str(tmp_path), "lote"), paging, max_parallel)
    rows = sorted((json.loads(r["request"])["lote"], r["page"], r["record"]) for r in result.collect())
    assert rows == [
        (1, 1, '{"n": "ação"}'),
        (1, 1, '{"n": "b"}'),
        (1, 2, '{"n": "c"}'),
        (2, 1, '{"n": "d"}'),
    ]


def test_failed_fetch_fails_the_job(spark):
    requests = spark.createDataFrame([(1,)], "pagina int")
    with pytest.raises(Exception, match="no page after 3 attempts"):
        fetch_pages(requests, Pages([[1]], failures=9), QUICK).collect()


def test_paged_format(spark, tmp_path):
    write_pages(tmp_path, 1, [[{"n": 1}], [{"n": 2}], [{"n": 3}]])
    write_pages(tmp_path, 2, [[{"n": 9}]])
    register(spark, recorded=RecordedPages(str(tmp_path), "lote"))
    reader = (
        spark.read.format("paged_json")
        .option("transport", "recorded")
        .option("requests", json.dumps([{"lote": 1, "pagina": 1}, {"lote": 2, "pagina": 1}]))
        .option("sleep", 0)
        .option("limitPages", 2)
    )
    assert sorted(row["record"] for row in reader.load().collect()) == ['{"n": 1}', '{"n": 2}', '{"n": 9}']
    assert reader.load().rdd.getNumPartitions() == 1
    assert reader.option("maxParallel", 9).load().rdd.getNumPartitions() == 2
    reader.option("limitPages", 0).option("strides", 2)
    assert reader.option("maxParallel", 3).load().rdd.getNumPartitions() == 3
    assert sorted(row["record"] for row in reader.load().collect()) == [f'{{"n": {n}}}' for n in (1, 2, 3, 9)]


def test_paged_format_without_requests(spark, tmp_path):
    register(spark, recorded=RecordedPages(str(tmp_path), "lote"))
    reader = spark.read.format("paged_json").option("transport", "recorded").option("requests", "[]")
    assert reader.load().count() == 0


def test_http_get_builds_the_request(monkeypatch):
    seen = {}

    class Response:
        status = 200

        def __enter__(self):
            return self

        def __exit__(self, *_):
            pass

        def read(self):
            return "[]".encode()

    def urlopen(request, timeout):
        seen.update(url=request.full_url, headers=dict(request.header_items()), timeout=timeout)
        return Response()

    monkeypatch.setattr("urllib.request.urlopen", urlopen)
    reply = HttpGet("http://service/items", {"Key": "k"}, 5)({"mes": "01/2020", "pagina": 2, "none": None})
    assert reply == Reply(200, "[]")
    assert seen == {"url": "http://service/items?mes=01%2F2020&pagina=2", "headers": {"Key": "k"}, "timeout": 5}


def test_http_errors_and_broken_answers(monkeypatch):
    def refused(request, timeout):
        raise urllib.error.HTTPError(request.full_url, 429, "slow down", {}, None)

    def broken(request, timeout):
        raise http.client.IncompleteRead(b"[")

    monkeypatch.setattr("urllib.request.urlopen", refused)
    assert HttpGet("http://service/items")({}) == Reply(429, "")
    monkeypatch.setattr("urllib.request.urlopen", broken)
    with pytest.raises(FetchError, match="after 3 attempts"):
        paged.fetch_page(HttpGet("http://service/items"), {}, QUICK)


def test_month_requests(spark):
    days = spark.createDataFrame([(date(2020, 1, 5),), (date(2020, 1, 9),), (date(2019, 12, 1),)], "day date")
    assert sorted(tuple(row) for row in month_requests(days).collect()) == [
        ("01/2020", "01/2020", 1),
        ("12/2019", "12/2019", 1),
    ]


def test_agency_requests(spark):
    listed = [("26000", "x"), ("36000", "y"), ("36000", "z")]
    agencies = spark.createDataFrame(listed, "codigo string, nome string")
    asked = agency_requests(agencies, date(2020, 1, 20))
    assert asked.columns == ["unidadeGestora", "pagina", "dataEmissao", "fase"]
    assert sorted(tuple(row) for row in asked.collect()) == [
        (code, 1, "20/01/2020", phase) for code in ("26000", "36000") for phase in (1, 2, 3)
    ]


def test_unknown_extraction():
    assert set(EXTRACTIONS) == {"corporate_card_expenses", "government_agencies", "agency_expenses_documents"}
    with pytest.raises(ValueError, match="unknown extraction"):
        extraction("salaries")


class Service:
    """Three service paths; vouchers are asked for by month, documents by agency and phase."""

    def __init__(self, endpoint):
        self.endpoint = endpoint

    def __call__(self, params):
        records = []
        if params["pagina"] == 1 and self.endpoint == "/cartoes":
            assert params["mesExtratoInicio"] == params["mesExtratoFim"] == "01/2020"
            records = [voucher(1, EDUCATION, shop("11", "Padaria Açúcar"))]
        elif params["pagina"] == 1 and self.endpoint == "/orgaos-siafi":
            records = [{"codigo": "26000"}, {"codigo": "36000"}]
        elif params["pagina"] == 1:
            records = [{"doc": f"{params['unidadeGestora']}-{params['fase']}-{params['dataEmissao']}"}]
        return Reply(200, json.dumps(records))


def test_landing(spark, root):
    day = date(2020, 1, 3)
    quick = Paging(0, 0)
    land_extraction(spark, root, "corporate_card_expenses", day, Service, quick)
    landed = read_family(spark, root, VOUCHERS, 2020, 1)
    assert [tuple(r) for r in landed.select("id", "estabelecimento.nome").collect()] == [(1, "Padaria Açúcar")]
    again = land_extraction(spark, root, "corporate_card_expenses", date(2020, 1, 20), Service, quick)
    assert again.endswith("corporate-card-expenses-2020-01")
    assert read_family(spark, root, VOUCHERS, 2020, 1).count() == 1
    with pytest.raises(ValueError, match="page limit"):
        land_extraction(spark, root, "corporate_card_expenses", day, Service, Paging(0, 0, limit_pages=2))
    other = Path(root, "raw_data", "credit_card_vouchers", "corporate-card-expenses-2020-01-20")
    other.mkdir()
    with pytest.raises(FileExistsError, match="2020-01-20"):
        land_extraction(spark, root, "corporate_card_expenses", day, Service, quick)
    with pytest.raises(AnalysisException):
        land_extraction(spark, root, "agency_expenses_documents", day, Service, quick)
    land_extraction(spark, root, "government_agencies", day, Service, quick)
    path = land_extraction(spark, root, "agency_expenses_documents", day, Service, quick, max_parallel=3)
    documents = {row["doc"] for row in spark.read.json(path).collect()}
    assert documents == {f"{code}-{phase}-03/01/2020" for code in ("26000", "36000") for phase in (1, 2, 3)}
    with pytest.raises(ValueError):
        extraction("agency_expenses_documents").requests(spark, day, None)


def test_csv_is_text_with_accents(spark, root):
    write_january(root)
    df = read_csv(spark, f"{root}/raw_data/despesas/2020/Despesas_Empenho_20200101.csv")
    assert {kind for _, kind in df.dtypes} == {"string"}
    row = df.where("`Id Empenho` = 'E1'").first()
    assert row["Órgão"] == "Colégio São João"
    assert row["Valor Original do Empenho"] == "1.234,56"
    assert df.where("`Id Empenho` = 'E6'").first()["Código Favorecido"] is None


def test_csv_files_with_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"Código";"Nome"\n"1";"x"\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text('"Código";"Nome"\n', encoding="utf-8")
    assert rows_of(read_csv(spark, str(tmp_path)).select("`Código`")) == [("1",)]
    (tmp_path / "d.csv").write_text('"Nome";"Código"\n"y";"2"\n', encoding="utf-8")
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path)).select("`Código`").collect()


def test_csv_in_another_encoding(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"Código";"Órgão"\n"1";"ação"\n', encoding="iso-8859-1")
    family = Family("latin", "a*", encoding="ISO-8859-1")
    assert rows_of(read_family(spark, str(tmp_path), family, 2020, 1).select("`Órgão`")) == [("ação",)]


def test_csv_reads_only_the_selected_columns(spark, root):
    write_january(root)
    df = read_family(spark, root, PAYMENTS, 2020, 1).select("`Código Favorecido`")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Código Favorecido:string>" in plan


def test_month_files_are_picked_by_name(spark, root):
    write_january(root)
    assert read_family(spark, root, PAYMENTS, 2020, 1).count() == 3
    with pytest.raises(AnalysisException) as caught:
        read_family(spark, root, PAYMENTS, 2020, 11)
    assert caught.value.getCondition() == "PATH_NOT_FOUND"


def test_json_arrays_lines_and_nothing(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1}, {"id": 2, "portador": {"nome": "é"}}], ensure_ascii=False))
    (tmp_path / "b.json").write_text('{"id": 3}\n{"id": 4, "extra": 1}\n')
    (tmp_path / "c.json").write_text("[]")
    df = read_json(spark, str(tmp_path), VOUCHER_SCHEMA)
    assert len(df.columns) == 8
    assert sorted(tuple(r) for r in df.select("id", "portador.nome").collect()) == [
        (1, None), (2, "é"), (3, None), (4, None)
    ]


SCHEMA = T.StructType([T.StructField("a", T.LongType())])


def test_optional_table(spark, tmp_path):
    absent = read_optional(spark, str(tmp_path / "none"), SCHEMA)
    assert absent.schema == SCHEMA and absent.count() == 0
    unmatched = spark.range(3).toDF("a").join(absent, "a", "left_anti")
    assert "Join" not in unmatched._jdf.queryExecution().executedPlan().toString()
    spark.range(3).toDF("a").write.parquet(str(tmp_path / "some"))
    assert read_optional(spark, str(tmp_path / "some"), SCHEMA).count() == 3


def test_optional_table_left_empty(spark, tmp_path):
    left = tmp_path / "left"
    (left / "_temporary" / "0").mkdir(parents=True)
    table = read_optional(spark, str(left), SCHEMA)
    assert table.schema == SCHEMA and table.count() == 0


def test_optional_table_that_cannot_be_read(spark, tmp_path):
    (tmp_path / "x.parquet").write_text("broken")
    with pytest.raises(Exception):
        read_optional(spark, str(tmp_path), SCHEMA).count()


def test_staged_tables_by_name(spark, tmp_path):
    for name, n in {"expenses_city": 2, "vouchers_city": 3, "vouchers_agency": 9}.items():
        spark.range(n).write.parquet(f"{tmp_path}/staging/{name}")
    assert read_staged(spark, str(tmp_path), "city").count() == 5


@pytest.mark.parametrize("gather", [False, True])
def test_only_touched_partitions_are_replaced(spark, tmp_path, gather):
    path = str(tmp_path / "fact")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    rows = spark.range(90).selectExpr("id", "cast(2019 + id % 2 as int) year", "cast(1 + id % 3 as int) month")
    overwrite_partitions(rows, path, gather=gather)
    overwrite_partitions(rows.where("year = 2020 and month = 2").selectExpr("id + 1000 as id", "year", "month"), path)
    got = {r["id"] for r in spark.read.parquet(path).collect()}
    replaced = {i for i in range(90) if i % 2 == 1 and i % 3 == 1}
    want = set(range(90)) - replaced | {i + 1000 for i in replaced}
    assert got == want
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_landed_json_keeps_text(spark, tmp_path):
    df = spark.createDataFrame([("ação", 1)], "n string, i int")
    land_records(df, str(tmp_path / "rows"))
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "rows").glob("part-*"))
    assert text == '{"n":"ação","i":1}\n'


def test_scratch_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first != second and first.endswith("/x")
    if base:
        assert first.startswith(base.rstrip("/"))
