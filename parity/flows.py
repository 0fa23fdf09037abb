"""Composite jobs run through files: staging, dimension loads, a whole month."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthstar.functions import request_date
from monthstar.operators import Lookup, dedupe_by_key, resolve
from monthstar.plans import load_dimension, run_month, stage_source
from monthstar.sinks import land_records, overwrite_table
from monthstar.sources import read_table
from monthstar.specs import (
    Dimension,
    Fact,
    Family,
    StagedSource,
    Star,
    amount,
    day,
    leaf,
    month_field,
    text,
    year_field,
)
from parity.files import EVENT_SCHEMA, event_records, write_csv, write_json_arrays
from parity.registry import query, scratch, table

YEAR, MONTH = 1998, 3
RUN = f"{YEAR}{MONTH:02d}"


def _known(df: DataFrame, root: str, dimension: Dimension) -> None:
    """Store members as an already loaded dimension."""
    numbered = df.withColumn(dimension.id_column, F.lit(0).cast("bigint"))
    overwrite_table(numbered.select(*dimension.columns), f"{root}/dimension/{dimension.name}")


PARTY_FIELDS = (text("code", "Código"), text("name", "Nome"))
PARTY_FAMILIES = tuple(
    Family(name, "raw_data/" + name + "_{year}{month:02d}*") for name in ("customer", "supplier", "part")
)
PARTY = Dimension("party", ("code", "name"), (StagedSource("party", PARTY_FAMILIES, PARTY_FIELDS),))


@query("""
    select distinct cast(code as varchar) as code, name
    from (select c_custkey as code, c_name as name from customer
          union all select s_suppkey, s_name from supplier
          union all select nullif(p_partkey, 7), p_name from part) u
    where code is not null and not exists (
        select 1 from customer d
        where d.c_mktsegment = 'MACHINERY' and d.c_custkey = u.code and d.c_name = u.name)
""")
def stage_dimension_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three CSV families; a part without code is dropped, one segment is known."""
    root = scratch(spark, "star")
    raw = {
        "customer": ("c_custkey", "c_name"),
        "supplier": ("s_suppkey", "s_name"),
        "part": ("nullif(p_partkey, 7)", "p_name"),
    }
    for name, (code, label) in raw.items():
        rows = table(spark, sf_dir, name).selectExpr(f"{code} as `Código`", f"{label} as Nome")
        write_csv(rows, f"{root}/raw_data/{name}_{RUN}15")
    known = table(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY'")
    _known(known.selectExpr("cast(c_custkey as string) as code", "c_name as name"), root, PARTY)
    stage_source(spark, root, PARTY, PARTY.sources[0], YEAR, MONTH)
    return read_table(spark, f"{root}/staging/party")


KIND_FAMILY = Family("part", "raw_data/part_{year}{month:02d}*")
KIND_FIELDS = (text("type_code", "Código Tipo"), text("brand_code", "Código Marca"))
KIND = Dimension("kind", ("type_code", "brand_code"), (StagedSource("kind", (KIND_FAMILY,), KIND_FIELDS),))


@query("select distinct p_type as type_code, p_brand as brand_code from part where p_brand <> 'Brand#17'")
def stage_dimension_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV family; the kinds of one brand are known."""
    root = scratch(spark, "star")
    part = table(spark, sf_dir, "part")
    write_csv(
        part.selectExpr("p_type as `Código Tipo`", "p_brand as `Código Marca`"),
        f"{root}/raw_data/part_{RUN}15",
    )
    known = part.where("p_brand = 'Brand#17'").selectExpr("p_type as type_code", "p_brand as brand_code")
    _known(known.distinct(), root, KIND)
    stage_source(spark, root, KIND, KIND.sources[0], YEAR, MONTH)
    return read_table(spark, f"{root}/staging/kind")


EVENT_FAMILY = Family("events", "raw_data/events-{year}-{month:02d}*", format="json", schema=EVENT_SCHEMA)
ACTION_FIELDS = (leaf("kind_name", "kind.detail.name"), leaf("actor_code", "actor.code"))
ACTION = Dimension(
    "action", ("kind_name", "actor_code"), (StagedSource("vouchers_action", (EVENT_FAMILY,), ACTION_FIELDS),)
)


@query("""
    select distinct event_type as kind_name, cast(user_id as varchar) as actor_code
    from events where event_type <> 'error'
""")
def stage_dimension_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested JSON; the actions of one kind are known."""
    root = scratch(spark, "star")
    write_json_arrays(event_records(spark, sf_dir), f"{root}/raw_data/events-{YEAR}-{MONTH:02d}-01")
    known = table(spark, sf_dir, "events").where("event_type = 'error'")
    _known(
        known.selectExpr("event_type as kind_name", "cast(user_id as string) as actor_code").distinct(),
        root,
        ACTION,
    )
    stage_source(spark, root, ACTION, ACTION.sources[0], YEAR, MONTH)
    return read_table(spark, f"{root}/staging/vouchers_action")


MERGED = Dimension(
    "customer",
    ("k",),
    (
        StagedSource("expenses_customer", (), (text("k", "k"), text("segment", "segment"))),
        StagedSource("vouchers_customer", (), (text("k", "k"), text("segment", "segment"))),
    ),
    bucket=lambda: F.col("k").cast("bigint"),
)


@query("""
    select row_number() over (order by cast(k as bigint) % 1024, k) as customer_id, k, segment
    from (select coalesce(a.k, b.k) as k, coalesce(a.segment, b.segment) as segment
          from (select cast(c_custkey as varchar) as k, c_mktsegment as segment
                from customer where c_nationkey < 15) a
          full join (select cast(c_custkey as varchar) as k, 'R' as segment
                     from customer where c_nationkey > 9) b on a.k = b.k)
""")
def load_dimension_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members staged by two sources that both know the nations 10 to 14."""
    root = scratch(spark, "star")
    customer = table(spark, sf_dir, "customer").withColumn("k", F.col("c_custkey").cast("string"))
    left = customer.where("c_nationkey < 15").select("k", F.col("c_mktsegment").alias("segment"))
    right = customer.where("c_nationkey > 9").select("k", F.lit("R").alias("segment"))
    overwrite_table(left, f"{root}/staging/expenses_customer")
    overwrite_table(right, f"{root}/staging/vouchers_customer")
    load_dimension(spark, root, MERGED)
    return read_table(spark, f"{root}/dimension/customer")


@query("""
    select row_number() over (order by cast(k as bigint) % 1024, k) as customer_id, k, segment
    from (select coalesce(a.k, b.k) as k, coalesce(a.segment, b.segment) as segment
          from (select cast(c_custkey as varchar) as k, c_mktsegment as segment
                from customer where c_nationkey < 15 and c_mktsegment <> 'BUILDING') a
          full join (select cast(c_custkey as varchar) as k, 'R' as segment
                     from customer where c_nationkey > 9) b on a.k = b.k)
""")
def load_dimension_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source stages a complete and an incomplete record of each member, or for one segment only the latter."""
    root = scratch(spark, "star")
    customer = table(spark, sf_dir, "customer").withColumn("k", F.col("c_custkey").cast("string"))
    left = customer.where("c_nationkey < 15").select("k", F.col("c_mktsegment").alias("segment"))
    left = left.where("segment <> 'BUILDING'").unionAll(left.withColumn("segment", F.lit(None).cast("string")))
    right = customer.where("c_nationkey > 9").select("k", F.lit("R").alias("segment"))
    overwrite_table(dedupe_by_key(left, ["k"]), f"{root}/staging/expenses_customer")
    overwrite_table(right, f"{root}/staging/vouchers_customer")
    load_dimension(spark, root, MERGED, strict=True)
    return read_table(spark, f"{root}/dimension/customer")


SINGLE = Dimension(
    "nation",
    ("nation_code",),
    (StagedSource("vouchers_nation", (), (text("nation_code", "nation_code"), text("nation", "nation"))),),
    bucket=lambda: F.col("nation_code").cast("bigint"),
)


@query("""
    select row_number() over (order by n_nationkey % 1024, cast(n_nationkey as varchar)) as nation_id,
        cast(n_nationkey as varchar) as nation_code, n_name as nation
    from nation
""")
def load_dimension_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "star")
    nation = table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey as string) as nation_code", "n_name as nation"
    )
    overwrite_table(nation, f"{root}/staging/vouchers_nation")
    load_dimension(spark, root, SINGLE)
    return read_table(spark, f"{root}/dimension/nation")


TWICE = Dimension(
    "customer",
    ("customer_code",),
    (StagedSource("vouchers_customer", (), (text("customer_code", "customer_code"),)),),
    bucket=lambda: F.col("customer_code").cast("bigint"),
)


@query("""
    select row_number() over (
            order by case when c_mktsegment = 'BUILDING' then 0 else 1 end, c_custkey % 1024,
                cast(c_custkey as varchar)) as customer_id,
        cast(c_custkey as varchar) as customer_code
    from customer
""")
def surrogate_ids_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One segment is loaded first; then all are staged, and the others follow on."""
    root = scratch(spark, "star")
    customer = table(spark, sf_dir, "customer").withColumn("customer_code", F.col("c_custkey").cast("string"))
    for staged in (customer.where("c_mktsegment = 'BUILDING'"), customer):
        overwrite_table(staged.select("customer_code"), f"{root}/staging/vouchers_customer")
        load_dimension(spark, root, TWICE)
    return read_table(spark, f"{root}/dimension/customer")


# The whole month: orders are the CSV documents, events the JSON vouchers.
DOCUMENT_FILES = Family("documents", "raw_data/documents={year}{month:02d}*")
VOUCHER_FILES = Family(
    "vouchers",
    "raw_data/vouchers-{year}-{month:02d}*",
    format="json",
    schema="""
        id bigint, data string, valor string,
        favorecido struct<codigo: string, nome: string, segmento: string>,
        unidade struct<codigo: string, nome: string, regiao: struct<codigo: string, nome: string>>
    """,
)
STAR_VENDOR = Dimension(
    "vendor",
    ("vendor_code", "vendor_name"),
    (
        StagedSource(
            "expenses_vendor",
            (DOCUMENT_FILES,),
            (text("vendor_code", "Código Favorecido"), text("vendor_name", "Favorecido")),
        ),
        StagedSource(
            "vouchers_vendor",
            (VOUCHER_FILES,),
            (
                leaf("vendor_code", "favorecido.codigo"),
                leaf("vendor_name", "favorecido.nome"),
                leaf("segment", "favorecido.segmento"),
            ),
        ),
    ),
)
STAR_AGENCY = Dimension(
    "agency",
    ("agency_code",),
    (
        StagedSource(
            "expenses_agency",
            (DOCUMENT_FILES,),
            (text("agency_code", "Código Órgão"), text("agency", "Órgão")),
        ),
        StagedSource(
            "vouchers_agency",
            (VOUCHER_FILES,),
            (leaf("agency_code", "unidade.codigo"), leaf("agency", "unidade.nome")),
        ),
    ),
)
STAR_CITY = Dimension(
    "city",
    ("city_code", "city"),
    (
        StagedSource(
            "vouchers_city",
            (VOUCHER_FILES,),
            (leaf("city_code", "unidade.regiao.codigo"), leaf("city", "unidade.regiao.nome")),
        ),
    ),
)
STAR_PAYMENT = Fact(
    "payment",
    DOCUMENT_FILES,
    (
        text("payment_code", "Código Pagamento"),
        day("payment_date", "Data Emissão"),
        amount("payment_amount", "Valor"),
        text("vendor_code", "Código Favorecido"),
        text("vendor_name", "Favorecido"),
        text("agency_code", "Código Órgão"),
        year_field("Data Emissão"),
        month_field("Data Emissão"),
    ),
    ("vendor", "agency"),
    required=("payment_code", "vendor_id", "agency_id"),
    max_null_percent=50,
)
STAR_VOUCHER = Fact(
    "voucher",
    VOUCHER_FILES,
    (
        leaf("payment_id", "id"),
        day("payment_date", "data"),
        amount("payment_amount", "valor"),
        leaf("vendor_code", "favorecido.codigo"),
        leaf("vendor_name", "favorecido.nome"),
        leaf("agency_code", "unidade.codigo"),
        leaf("city_code", "unidade.regiao.codigo"),
        leaf("city", "unidade.regiao.nome"),
    ),
    ("vendor", "agency", "city"),
    row_period=False,
    required=("payment_id", "vendor_id", "agency_id", "city_id"),
    max_null_percent=50,
)
STAR = Star((STAR_VENDOR, STAR_AGENCY, STAR_CITY), (STAR_PAYMENT, STAR_VOUCHER))


def money(column: str) -> Column:
    return F.translate(F.format_number(column, 2), ",.", ".,")


def write_month(spark: SparkSession, sf_dir: str, root: str) -> None:
    """All orders as CSV documents by month, all events as vouchers of the run month.

    Customers of one nation stay without a code, so their rows are unresolved.
    """
    code = F.when(F.col("c_nationkey") != 3, F.col("c_custkey")).cast("string")
    customer = table(spark, sf_dir, "customer").withColumn("code", code)
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    person = ("code", "c_name", "c_mktsegment", "c_nationkey")
    places = [
        Lookup(nation, ("c_nationkey",), ("n_name", "n_regionkey")),
        Lookup(region, ("n_regionkey",), ("r_name",)),
    ]

    buyers = Lookup(customer.withColumnRenamed("c_custkey", "o_custkey"), ("o_custkey",), person)
    documents = resolve(table(spark, sf_dir, "orders"), [buyers, *places]).select(
        F.col("o_orderkey").alias("Código Pagamento"),
        request_date("o_orderdate").alias("Data Emissão"),
        money("o_totalprice").alias("Valor"),
        F.col("code").alias("Código Favorecido"),
        F.col("c_name").alias("Favorecido"),
        F.col("c_nationkey").alias("Código Órgão"),
        F.col("n_name").alias("Órgão"),
        F.date_format("o_orderdate", "yyyyMM").alias("documents"),
    )
    write_csv(documents, f"{root}/raw_data", by="documents")

    users = Lookup(customer.withColumnRenamed("c_custkey", "user_id"), ("user_id",), person)
    vendor = [
        F.col("code").alias("codigo"),
        F.col("c_name").alias("nome"),
        F.col("c_mktsegment").alias("segmento"),
    ]
    city = [F.col("n_regionkey").cast("string").alias("codigo"), F.col("r_name").alias("nome")]
    agency = [
        F.col("c_nationkey").cast("string").alias("codigo"),
        F.col("n_name").alias("nome"),
        F.struct(*city).alias("regiao"),
    ]
    vouchers = resolve(table(spark, sf_dir, "events"), [users, *places]).select(
        F.col("event_id").alias("id"),
        request_date("ts").alias("data"),
        money("value").alias("valor"),
        F.struct(*vendor).alias("favorecido"),
        F.struct(*agency).alias("unidade"),
    )
    land_records(vouchers, f"{root}/raw_data/vouchers-{YEAR}-{MONTH:02d}-01")


def build_month(spark: SparkSession, sf_dir: str) -> str:
    """Run the month and return the folder of the star."""
    root = scratch(spark, "star")
    write_month(spark, sf_dir, root)
    run_month(spark, root, STAR, YEAR, MONTH)
    return root


@query("""
    select 'payment' as fact, 1998 as year, 3 as month, count(*) as n_rows,
        count(*) filter (where c.c_nationkey <> 3) as vendor_rows, count(n.n_nationkey) as agency_rows,
        cast(sum(cast(o.o_totalprice as decimal(18,2))) as double) as amount
    from orders o
    left join customer c on o.o_custkey = c.c_custkey
    left join nation n on c.c_nationkey = n.n_nationkey
    where year(o.o_orderdate) = 1998 and month(o.o_orderdate) = 3
    union all
    select 'voucher', 1998, 3, count(*), count(*) filter (where c.c_nationkey <> 3), count(n.n_nationkey),
        cast(sum(cast(e.value as decimal(18,2))) as double)
    from events e
    left join customer c on e.user_id = c.c_custkey
    left join nation n on c.c_nationkey = n.n_nationkey
""")
def star_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, resolved rows and amounts of both facts after the whole month."""
    root = build_month(spark, sf_dir)
    facts = []
    for fact in STAR.facts:
        stored = read_table(spark, f"{root}/fact/{fact.name}")
        facts.append(
            stored.groupBy(F.lit(fact.name).alias("fact"), "year", "month").agg(
                F.count(F.lit(1)).alias("n_rows"),
                F.count("vendor_id").alias("vendor_rows"),
                F.count("agency_id").alias("agency_rows"),
                F.sum(F.col("payment_amount").cast("decimal(18,2)")).cast("double").alias("amount"),
            )
        )
    return reduce(DataFrame.unionByName, facts)


def _with_keys(spark: SparkSession, root: str, fact: Fact) -> DataFrame:
    """A stored fact with the natural keys its ids stand for."""
    lookups = []
    for name in fact.dimensions:
        dimension = STAR.dimension(name)
        stored = read_table(spark, f"{root}/dimension/{name}")
        lookups.append(Lookup(stored, (dimension.id_column,), dimension.keys))
    ids = [STAR.dimension(name).id_column for name in fact.dimensions]
    return resolve(read_table(spark, f"{root}/fact/{fact.name}"), lookups, drop=ids)


@query("""
    select cast(o.o_orderkey as varchar) as payment_code, cast(o.o_orderdate as date) as payment_date,
        o.o_totalprice as payment_amount,
        case when c.c_nationkey <> 3 then cast(c.c_custkey as varchar) end as vendor_code,
        case when c.c_nationkey <> 3 then c.c_name end as vendor_name,
        cast(c.c_nationkey as varchar) as agency_code, 1998 as year, 3 as month
    from orders o left join customer c on o.o_custkey = c.c_custkey
    where year(o.o_orderdate) = 1998 and month(o.o_orderdate) = 3
""")
def fact_expenses_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month's payment fact, row by row, with the keys behind its ids."""
    return _with_keys(spark, build_month(spark, sf_dir), STAR_PAYMENT)


@query("""
    select e.event_id as payment_id, cast(e.ts as date) as payment_date, e.value as payment_amount,
        case when c.c_nationkey <> 3 then cast(c.c_custkey as varchar) end as vendor_code,
        case when c.c_nationkey <> 3 then c.c_name end as vendor_name,
        cast(n.n_nationkey as varchar) as agency_code, cast(r.r_regionkey as varchar) as city_code,
        r.r_name as city, 1998 as year, 3 as month
    from events e
    left join customer c on e.user_id = c.c_custkey
    left join nation n on c.c_nationkey = n.n_nationkey
    left join region r on n.n_regionkey = r.r_regionkey
""")
def fact_vouchers_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month's voucher fact, row by row, with the keys behind its ids."""
    return _with_keys(spark, build_month(spark, sf_dir), STAR_VOUCHER)
