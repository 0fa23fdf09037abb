"""Sources and sinks: tables written as raw files and read back.

Every query writes into a new folder under the session's checkpoint folder.
"""

from __future__ import annotations

from datetime import date

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthstar.functions import request_date
from monthstar.operators import new_members, number_rows, rename
from monthstar.plans import land_extraction
from monthstar.sinks import (
    append_dimension,
    commit_partitions,
    commit_rows,
    drop_unused,
    land_records,
    overwrite_partitions,
    overwrite_table,
)
from monthstar.sources import (
    RecordedPages,
    fetch_pages,
    read_arrays,
    read_csv,
    read_family,
    read_json,
    read_optional,
    read_staged,
    read_table,
)
from monthstar.sources.paged import Paging
from monthstar.specs import Family, Field, leaf, text
from monthstar.specs.spending import VOUCHERS
from parity.registry import query, scratch, table

RECORDS_PER_PAGE = 100
#: Recorded pages that lie in a folder together, where one request has many.
PAGES_PER_BLOCK = 1000
#: Suppliers that an invented agency has, and that a page of its documents holds.
SUPPLIERS_OF_AGENCY, SUPPLIERS_OF_PAGE = 20, 8


def write_csv(df: DataFrame, path: str, by: str | None = None) -> None:
    """Raw delimited files; ``by`` puts the rows of each value in a folder of their own."""
    if by is not None:
        df = df.hint("rebalance", by)
    writer = df.write.mode("overwrite").option("sep", ";").option("header", True)
    (writer.partitionBy(by) if by else writer).csv(path)


def write_json_arrays(df: DataFrame, path: str) -> None:
    """Raw JSON with an array of records per line, one line per Arrow batch.

    Nothing is grouped by a key, so a line's length is bounded whatever the data.
    """

    def lines(batches):
        for batch in batches:
            line = "[" + ",".join(batch.column(0).to_pylist()) + "]"
            yield pa.RecordBatch.from_pydict({"line": [line]})

    records = df.select(F.to_json(F.struct(*df.columns)).alias("record"))
    records.mapInArrow(lines, "line string").write.mode("overwrite").text(path)


def write_json_array_files(df: DataFrame, path: str) -> None:
    """Raw JSON, one array for each file; a line ends inside of some record, a line for each Arrow batch."""

    def lines(batches):
        begin = "["
        for batch in batches:
            text = begin + ",".join(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_pydict({"line": [text[:-1], text[-1:]]})
            begin = ","
        yield pa.RecordBatch.from_pydict({"line": ["[]" if begin == "[" else "]"]})

    records = df.select(F.to_json(F.struct(*df.columns)).alias("record"))
    records.mapInArrow(lines, "line string").write.mode("overwrite").text(path)


@query("""
    select cast(n_nationkey as varchar) as nation_code, n_name as nation,
        cast(n_regionkey as varchar) as region_code
    from nation
""")
def src_csv_semicolon(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "nation")
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("Código Nação"),
        F.col("n_name").alias("Nação"),
        F.col("n_regionkey").alias("Código Região"),
    )
    write_csv(nation, path)
    fields = [
        text("nation_code", "Código Nação"),
        text("nation", "Nação"),
        text("region_code", "Código Região"),
    ]
    return rename(read_csv(spark, path), fields)


ORDER_FILES = Family("orders", "orders={year}{month:02d}*")


@query("""
    select cast(o_orderkey as varchar) as order_code, strftime(o_orderdate, '%d/%m/%Y') as order_date_text
    from orders where year(o_orderdate) = 1998 and month(o_orderdate) = 3
""")
def src_csv_month_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders written in folders by month, one of them picked by name."""
    root = scratch(spark, "raw")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Código Pedido"),
        request_date("o_orderdate").alias("Data Emissão"),
        F.date_format("o_orderdate", "yyyyMM").alias("orders"),
    )
    write_csv(orders, root, by="orders")
    fields = [text("order_code", "Código Pedido"), text("order_date_text", "Data Emissão")]
    return rename(read_family(spark, root, ORDER_FILES, 1998, 3), fields)


EVENT_SCHEMA = "id bigint, actor struct<code: string>, kind struct<detail: struct<name: string>>, amount string"


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as nested records, the amount as text."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.struct(F.col("user_id").cast("string").alias("code")).alias("actor"),
        F.struct(F.struct(F.col("event_type").alias("name")).alias("detail")).alias("kind"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("amount"),
    )


@query("""
    select event_id as id, cast(user_id as varchar) as actor_code, event_type as kind_name,
        cast(value as decimal(18,2)) as amount
    from events
""")
def src_json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "events")
    write_json_arrays(event_records(spark, sf_dir), path)
    fields = [
        leaf("id", "id"),
        leaf("actor_code", "actor.code"),
        leaf("kind_name", "kind.detail.name"),
        Field("amount", "amount", lambda raw: raw.try_cast("decimal(18,2)")),
    ]
    return rename(read_json(spark, path, EVENT_SCHEMA), fields)


@query("""
    select event_id as id, cast(user_id as varchar) as actor_code, event_type as kind_name,
        cast(value as decimal(18,2)) as amount
    from events
""")
def src_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file one array, whose records run on over its lines: no line can be read by itself."""
    path = scratch(spark, "events")
    write_json_array_files(event_records(spark, sf_dir), path)
    fields = [
        leaf("id", "id"),
        leaf("actor_code", "actor.code"),
        leaf("kind_name", "kind.detail.name"),
        Field("amount", "amount", lambda raw: raw.try_cast("decimal(18,2)")),
    ]
    return rename(read_arrays(spark, path, EVENT_SCHEMA), fields)


@query("select c_custkey, c_name from customer")
def src_parquet_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension's path is absent, so every member is new."""
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType())])
    absent = read_optional(spark, scratch(spark, "dimension/customer"), schema)
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return new_members(customer, absent, ["c_custkey", "c_name"])


@query("""
    select c_custkey as party_code, c_name as party_name from customer
    union all select s_suppkey, s_name from supplier
""")
def src_parquet_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "star")
    for name, code, label in (("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name")):
        fields = [text("party_code", code), text("party_name", label)]
        overwrite_table(rename(table(spark, sf_dir, name), fields), f"{root}/staging/{name}_party")
    return read_staged(spark, root, "party")


def record_pages(df: DataFrame, path: str) -> None:
    """Rows recorded as one request's pages: numbered from 1 without a gap, a page for an Arrow batch's part.

    The pages lie in blocks, so that a task which goes on at some page reads its block and not all that lie before.
    """
    spark = df.sparkSession

    def pages(batches):
        for batch in batches:
            records = batch.column(0).to_pylist()
            for begin in range(0, len(records), RECORDS_PER_PAGE):
                yield pa.RecordBatch.from_pydict({"items": ["[" + ",".join(records[begin : begin + RECORDS_PER_PAGE]) + "]"]})

    items = df.select(F.to_json(F.struct(*df.columns))).mapInArrow(pages, "items string")
    unnumbered = f"{path}.items"
    items.select("items", F.monotonically_increasing_id().alias("place")).write.parquet(unnumbered)
    numbered = number_rows(spark.read.parquet(unnumbered), ["place"], "page")
    line = F.concat(F.lit('{"page": '), "page", F.lit(', "items": '), "items", F.lit("}"))
    block = F.floor((F.col("page") - 1) / PAGES_PER_BLOCK).alias("block")
    numbered.select(line.alias("line"), block).write.partitionBy("block").text(path)


PAGED_EVENT = "event_id bigint, user_id bigint, event_type string"


def fetched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events recorded as pages of 100 and fetched.

    An Arrow batch of events makes a request, so its pages are few whatever the data.
    """
    root = scratch(spark, "pages")

    def recorded(batches):
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            records = batch.column(0).to_pylist()
            begins = range(0, len(records), RECORDS_PER_PAGE)
            pages = [",".join(records[begin : begin + RECORDS_PER_PAGE]) for begin in begins]
            lines = [f'{{"page": {page}, "items": [{items}]}}' for page, items in enumerate(pages, 1)]
            yield pa.RecordBatch.from_pydict({"lote": [f"t{task}_{number}"] * len(lines), "line": lines})

    records = table(spark, sf_dir, "events").select(F.to_json(F.struct("event_id", "user_id", "event_type")))
    records.mapInArrow(recorded, "lote string, line string").write.partitionBy("lote").text(root)
    requests = spark.read.text(root).select("lote", F.lit(1).alias("pagina")).distinct()
    return fetch_pages(requests, RecordedPages(root, "lote"), Paging(sleep=0), max_parallel=None)


@query("select event_id, user_id, event_type from events")
def src_paged_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.from_json("record", PAGED_EVENT).alias("record")
    return fetched_events(spark, sf_dir).select(record).select("record.*")


@query("select event_id, user_id, event_type from events")
def land_paged_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched records landed as they came, then read as raw files."""
    path = scratch(spark, "raw/events")
    land_records(fetched_events(spark, sf_dir), path, "record")
    return read_json(spark, path, PAGED_EVENT)


@query("""
    select event_id as payment_id, cast(value as decimal(18,2)) as payment_amount, event_type as vendor_name
    from events
""")
def land_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month's vouchers landed from recorded pages, twice, and read by the month's family."""
    recorded, root = scratch(spark, "pages"), scratch(spark, "star")
    vouchers = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("valorTransacao"),
        F.struct(F.col("event_type").alias("nome")).alias("estabelecimento"),
    )
    record_pages(vouchers, f"{recorded}/cartoes")
    for day in (date(2020, 1, 20), date(2020, 1, 1)):
        land_extraction(
            spark,
            root,
            "corporate_card_expenses",
            day,
            lambda endpoint: RecordedPages(f"{recorded}{endpoint}", block=PAGES_PER_BLOCK),
            Paging(sleep=0),
        )
    landed = read_family(spark, root, VOUCHERS, 2020, 1)
    fields = [
        leaf("payment_id", "id"),
        Field("payment_amount", "valorTransacao", lambda raw: raw.try_cast("decimal(18,2)")),
        leaf("vendor_name", "estabelecimento.nome"),
    ]
    return rename(landed, fields)


@query("""
    select cast(s_suppkey // 20 as varchar) as agency, phase, s_suppkey as document_id
    from supplier, (select unnest([1, 2, 3]) as phase)
""")
def land_agency_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agencies landed, then the documents of each in every phase, in steps of few calls from several tasks."""
    recorded, root, day = scratch(spark, "pages"), scratch(spark, "star"), date(2020, 1, 20)
    agency = F.floor(F.col("s_suppkey") / SUPPLIERS_OF_AGENCY).cast("string")
    documents = table(spark, sf_dir, "supplier").select(agency.alias("agency"), F.col("s_suppkey").alias("document_id"))
    record_pages(documents.select(F.col("agency").alias("codigo")).distinct(), f"{recorded}/orgaos-siafi")
    # One shuffle, by agency: it serves the window, the pages and the folders, which all cores write, each by one task.
    documents = documents.repartition(spark.sparkContext.defaultParallelism, "agency")
    place = F.row_number().over(Window.partitionBy("agency").orderBy("document_id")) - 1
    page = (F.floor(place / SUPPLIERS_OF_PAGE) + 1).alias("page")
    paged = documents.select("agency", page, F.to_json(F.struct("agency", "document_id")).alias("record"))
    items = F.concat(F.lit(', "items": ['), F.array_join(F.collect_list("record"), ","), F.lit("]}"))
    lines = paged.groupBy("agency", "page").agg(items.alias("items")).select(
        F.col("agency").alias("unidadeGestora"), F.concat(F.lit('{"page": '), "page", "items").alias("line")
    )
    lines.write.partitionBy("unidadeGestora").text(f"{recorded}/despesas/documentos")

    def transport(endpoint: str) -> RecordedPages:
        if "documentos" in endpoint:
            return RecordedPages(f"{recorded}{endpoint}", "unidadeGestora")
        return RecordedPages(f"{recorded}{endpoint}", block=PAGES_PER_BLOCK)

    for name in ("government_agencies", "agency_expenses_documents"):
        path = land_extraction(spark, root, name, day, transport, Paging(sleep=0), max_parallel=4, step_calls=250)
    landed = read_json(spark, path, "agency string, document_id bigint")
    # The recorded service answers alike in every phase; each phase has asked for a document once.
    times = landed.groupBy("agency", "document_id").agg(F.count(F.lit(1)).cast("int").alias("times"))
    return times.select("agency", F.explode(F.sequence(F.lit(1), "times")).alias("phase"), "document_id")


@query("select s_suppkey, s_name from supplier")
def sink_stage_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staging table written twice holds what was written last."""
    path = scratch(spark, "staging/party")
    overwrite_table(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), path)
    overwrite_table(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), path)
    return read_table(spark, path)


@query("select c_custkey, c_name from customer")
def sink_dim_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One segment first, the others after it."""
    path = scratch(spark, "dimension/customer")
    customer = table(spark, sf_dir, "customer")
    first = customer.where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name")
    append_dimension(first, path)
    later = new_members(customer.select("c_custkey", "c_name"), first, ["c_custkey", "c_name"])
    append_dimension(later, path)
    return read_table(spark, path)


@query("""
    select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month,
        case when year(o_orderdate) = 1998 and month(o_orderdate) = 3 then 'v2' else 'v1' end as version,
        count(*) as n_rows
    from orders group by all
""")
def sink_fact_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months as version 1, one month again as version 2."""
    path = scratch(spark, "fact/orders")
    day = F.col("o_orderdate").cast("date")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year(day).alias("year"), F.month(day).alias("month")
    )
    overwrite_partitions(orders.withColumn("version", F.lit("v1")), path, gather=True)
    again = orders.where("year = 1998 and month = 3")
    overwrite_partitions(again.withColumn("version", F.lit("v2")), path)
    return read_table(spark, path).groupBy("year", "month", "version").agg(F.count(F.lit(1)).alias("n_rows"))


@query("select c_custkey, c_name from customer")
def sink_version_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One segment as the first version, the others added by the second."""
    path = scratch(spark, "dimension/customer")
    customer = table(spark, sf_dir, "customer")
    commit_rows(customer.where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name"), path)
    later = new_members(customer.select("c_custkey", "c_name"), read_table(spark, path), ["c_custkey", "c_name"])
    commit_rows(later, path)
    return read_table(spark, path)


@query("""
    select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month,
        case when year(o_orderdate) = 1998 and month(o_orderdate) = 3 then 'v2' else 'v1' end as version,
        count(*) as n_rows
    from orders group by all
""")
def sink_version_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months as one version, one month replaced by the next, the replaced folder dropped."""
    path = scratch(spark, "fact/orders")
    day = F.col("o_orderdate").cast("date")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year(day).alias("year"), F.month(day).alias("month")
    )
    commit_partitions(orders.withColumn("version", F.lit("v1")), path, gather=True)
    again = orders.where("year = 1998 and month = 3")
    commit_partitions(again.withColumn("version", F.lit("v2")), path)
    drop_unused(spark, path)
    return read_table(spark, path).groupBy("year", "month", "version").agg(F.count(F.lit(1)).alias("n_rows"))


@query("select event_id, user_id, event_type from events")
def sink_raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "raw/events")
    land_records(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), path)
    return read_json(spark, path, PAGED_EVENT)
