"""Single operators applied to the tables directly."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthstar.functions import all_but_yes, br_date, br_number, month_of, year_of
from monthstar.operators import (
    Lookup,
    dedupe_by_key,
    drop_incomplete,
    drop_null_keys,
    duplicate_keys,
    in_period,
    literal_period,
    max_id,
    merge_members,
    new_members,
    null_keys,
    number_rows,
    rename,
    resolve,
    row_count,
    union_sources,
)
from monthstar.sources import agency_requests, month_requests, read_table
from monthstar.specs import leaf, text
from parity.registry import ORACLES, query, table


@query("select c_custkey, c_name from customer")
def src_parquet_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/customer.parquet", ["c_custkey", "c_name"])


@query("""
    select cast(n_nationkey as varchar) as agency_code, p.phase, '20/01/2020' as issue_date, 1 as page
    from nation cross join (values (1), (2), (3)) p(phase)
""")
def request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("codigo"))
    agencies = nation.unionAll(nation)
    asked = agency_requests(agencies, date(2020, 1, 20))
    return asked.select(
        F.col("unidadeGestora").alias("agency_code"),
        F.col("fase").alias("phase"),
        F.col("dataEmissao").alias("issue_date"),
        F.col("pagina").alias("page"),
    )


@query("""
    select distinct strftime(o_orderdate, '%m/%Y') as month_from, strftime(o_orderdate, '%m/%Y') as month_to,
        1 as page
    from orders
""")
def request_plan_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = month_requests(table(spark, sf_dir, "orders"), "o_orderdate")
    return asked.toDF("month_from", "month_to", "page")


@query("""
    select o_orderkey as payment_code, o_orderstatus as document_type, o_orderpriority as bidding_mode
    from orders
""")
def proj_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [
        text("payment_code", "o_orderkey"),
        text("document_type", "o_orderstatus"),
        text("bidding_mode", "o_orderpriority"),
    ]
    return rename(table(spark, sf_dir, "orders"), fields)


@query("select c_custkey, case when c_nationkey = 3 then null else c_mktsegment end as segment from customer")
def proj_struct_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four levels deep; a null parent gives a null leaf."""
    market = F.struct(F.struct(F.struct(F.col("c_mktsegment").alias("name")).alias("segment")).alias("market"))
    nested = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") != 3, market).alias("party")
    )
    return rename(nested, [text("c_custkey", "c_custkey"), leaf("segment", "party.market.segment.name")])


@query("""
    select o_orderkey, case when o_orderstatus = 'P' then null else cast(o_orderdate as date) end as order_date
    from orders
""")
def scalar_br_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as dd/MM/yyyy text; those of status P as ISO text, which is not a date here."""
    pattern = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM-dd"))
    written = pattern.otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    texts = table(spark, sf_dir, "orders").select("o_orderkey", written.alias("text"))
    return texts.select("o_orderkey", br_date("text").alias("order_date"))


@query("""
    select o_orderkey, cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month
    from orders
""")
def scalar_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", year_of(day).alias("year"), month_of(day).alias("month")
    )


def _written_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances as text such as 8.112,46."""
    written = F.translate(F.format_number("c_acctbal", 2), ",.", ".,")
    return table(spark, sf_dir, "customer").select("c_custkey", written.alias("text"))


@query("select c_custkey, c_acctbal as amount from customer")
def scalar_br_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written_balances(spark, sf_dir).select("c_custkey", br_number("text").alias("amount"))


@query("select c_custkey, case when abs(c_acctbal) < 1000 then c_acctbal end as amount from customer")
def scalar_comma_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = br_number("text", mode="comma_only")
    return _written_balances(spark, sf_dir).select("c_custkey", parsed.alias("amount"))


@query("""
    select o_orderkey,
        case when case o_orderstatus when 'F' then 'SIM' when 'O' then 'NÃO' end = 'SIM'
            then false else true end as in_budget
    from orders
""")
def scalar_case_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status F is the word yes, O the word no, and P is missing."""
    word = F.when(F.col("o_orderstatus") == "F", "SIM").when(F.col("o_orderstatus") == "O", "NÃO")
    return table(spark, sf_dir, "orders").select("o_orderkey", all_but_yes(word).alias("in_budget"))


@query("select event_id, 2024 as year, 1 as month from events")
def proj_literal_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return literal_period(table(spark, sf_dir, "events").select("event_id"), 2024, 1)


@query("""
    select c_custkey, c_nationkey, c_mktsegment from customer
    where c_nationkey <> 3 and c_mktsegment <> 'BUILDING'
""")
def filter_dropna_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    holes = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.nullif("c_nationkey", F.lit(3)).alias("c_nationkey"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
    )
    return drop_null_keys(holes, ["c_nationkey", "c_mktsegment"])


@query("select s_suppkey, s_name, s_nationkey from supplier where s_nationkey <> 3")
def filter_dropna_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    holes = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", F.nullif("s_nationkey", F.lit(3)).alias("s_nationkey")
    )
    return drop_incomplete(holes)


def _dated_orders(spark: SparkSession, sf_dir: str, period: tuple[int, int] | None = None) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    orders = table(spark, sf_dir, "orders")
    if period is not None:
        orders = orders.where(in_period(*period, "o_orderdate"))
    return orders.select(
        "o_orderkey", "o_custkey", "o_totalprice", year_of(day).alias("year"), month_of(day).alias("month")
    )


@query("select o_orderkey, o_totalprice from orders where year(o_orderdate) = 1998 and month(o_orderdate) = 3")
def filter_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.where(in_period(1998, 3, "o_orderdate")).select("o_orderkey", "o_totalprice")


@query("""
    select c_custkey, c_name from customer c
    where not exists (
        select 1 from customer d
        where d.c_mktsegment = 'MACHINERY' and d.c_custkey = c.c_custkey and d.c_name = c.c_name)
""")
def join_anti_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of one segment are known already."""
    customer = table(spark, sf_dir, "customer")
    known = customer.where("c_mktsegment = 'MACHINERY'")
    return new_members(customer.select("c_custkey", "c_name"), known, ["c_custkey", "c_name"])


@query("""
    select coalesce(a.k, b.k) as k, a.left_only, b.right_only, coalesce(a.segment, b.segment) as segment
    from (select c_custkey as k, c_name as left_only, nullif(c_mktsegment, 'BUILDING') as segment
          from customer where c_nationkey < 15) a
    full join (select c_custkey as k, c_nationkey as right_only, 'R' as segment
               from customer where c_nationkey > 9) b on a.k = b.k
""")
def join_full_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources that both know the nations 10 to 14."""
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "k")
    left = customer.where("c_nationkey < 15").select(
        "k",
        F.col("c_name").alias("left_only"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
    )
    right = customer.where("c_nationkey > 9").select(
        "k", F.col("c_nationkey").alias("right_only"), F.lit("R").alias("segment")
    )
    return merge_members(left, right, ["k"])


@query("""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
    from (select *, row_number() over (
              partition by l_orderkey, l_linenumber
              order by l_partkey nulls first, l_suppkey nulls first, l_quantity nulls first,
                  l_extendedprice nulls first) as rn
          from lineitem)
    where rn = 1
""")
def agg_dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return dedupe_by_key(table(spark, sf_dir, "lineitem").select(*columns), ["l_orderkey", "l_linenumber"])


@query("""
    select l_orderkey, l_suppkey, l_returnflag, l_quantity, l_tax
    from (select *, row_number() over (
              partition by l_orderkey
              order by (l_returnflag is null)::int + (l_quantity is null)::int + (l_tax is null)::int
                      + (l_suppkey is null)::int,
                  l_suppkey nulls first, l_returnflag nulls first, l_quantity nulls first, l_tax nulls first) as rn
          from (select l_orderkey, l_suppkey, nullif(l_returnflag, 'A') as l_returnflag,
                    nullif(l_quantity, 10) as l_quantity, nullif(l_tax, 0) as l_tax from lineitem))
    where rn = 1
""")
def agg_dedup_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with holes: of a key's records the fullest stays."""
    holes = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_suppkey",
        "nullif(l_returnflag, 'A') as l_returnflag",
        "nullif(l_quantity, 10) as l_quantity",
        "nullif(l_tax, 0) as l_tax",
    )
    return dedupe_by_key(holes, ["l_orderkey"])


@query("select distinct l_orderkey, l_linenumber from lineitem")
def agg_dedup_keys_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return dedupe_by_key(table(spark, sf_dir, "lineitem").select(*keys), keys)


@query("select coalesce(max(c_custkey), 0) as max_id from customer")
def agg_max_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_id(table(spark, sf_dir, "customer"), "c_custkey")


@query("""
    select c_custkey as code, c_name as name from customer
    union all select s_suppkey, s_name from supplier
    union all select p_partkey, p_name from part
""")
def union_by_name_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the second source come in another order."""
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey as code", "c_name as name")
    supplier = table(spark, sf_dir, "supplier").selectExpr("s_name as name", "s_suppkey as code")
    part = table(spark, sf_dir, "part").selectExpr("p_partkey as code", "p_name as name")
    return union_sources(customer, supplier, part)


@query("""
    select row_number() over (order by c_custkey % 1024, c_custkey) as customer_id, c_custkey, c_name
    from customer
""")
def surrogate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets by the key itself, which SQL can restate, in place of its hash."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return number_rows(customer, ["c_custkey"], "customer_id", bucket=F.col("c_custkey"))


def _order_fact(
    spark: SparkSession, sf_dir: str, period: tuple[int, int] | None = None, **options
) -> DataFrame:
    """Orders, of one month or all, with ids of their customer and its nation.

    Customers of one nation are missing from the dimension, so that their
    orders stay unresolved.
    """
    vendor = (
        table(spark, sf_dir, "customer")
        .where("c_nationkey <> 3")
        .selectExpr("c_custkey as o_custkey", "c_nationkey", "c_custkey + 1 as vendor_id")
    )
    agency = table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey as c_nationkey", "cast(n_nationkey + 1 as bigint) as agency_id"
    )
    lookups = [
        Lookup(vendor, ("o_custkey",), ("vendor_id", "c_nationkey")),
        Lookup(agency, ("c_nationkey",), ("agency_id",)),
    ]
    orders = _dated_orders(spark, sf_dir, period)
    return resolve(orders, lookups, drop=["o_custkey", "c_nationkey"], **options)


@query("""
    select o.o_orderkey, o.o_totalprice, cast(year(o.o_orderdate) as integer) as year,
        cast(month(o.o_orderdate) as integer) as month, v.c_custkey + 1 as vendor_id,
        cast(n.n_nationkey + 1 as bigint) as agency_id
    from orders o
    left join (select * from customer where c_nationkey <> 3) v on o.o_custkey = v.c_custkey
    left join nation n on v.c_nationkey = n.n_nationkey
""")
def fact_lookup_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_fact(spark, sf_dir)


@query(ORACLES["fact_lookup_two"])
def fact_lookup_two_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with dimensions too large to broadcast."""
    return _order_fact(spark, sf_dir, broadcast_bytes=0)


@query("""
    select e.event_id, cast(e.ts as date) as payment_date, v.c_custkey + 1 as vendor_id,
        cast(n.n_nationkey + 1 as bigint) as agency_id, cast(r.r_regionkey + 1 as bigint) as city_id,
        2024 as year, 1 as month
    from events e
    left join (select * from customer where c_nationkey <> 3) v on e.user_id = v.c_custkey
    left join nation n on v.c_nationkey = n.n_nationkey
    left join region r on n.n_regionkey = r.r_regionkey
""")
def fact_lookup_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events under the run's period, with ids of customer, nation and region."""
    return _event_fact(spark, sf_dir)


@query(ORACLES["fact_lookup_three"])
def fact_lookup_three_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with dimensions too large to broadcast."""
    return _event_fact(spark, sf_dir, broadcast_bytes=0)


def _event_fact(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("date").alias("payment_date"), "user_id"
    )
    vendor = (
        table(spark, sf_dir, "customer")
        .where("c_nationkey <> 3")
        .selectExpr("c_custkey as user_id", "c_nationkey", "c_custkey + 1 as vendor_id")
    )
    agency = table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey as c_nationkey", "n_regionkey", "cast(n_nationkey + 1 as bigint) as agency_id"
    )
    city = table(spark, sf_dir, "region").selectExpr(
        "r_regionkey as n_regionkey", "cast(r_regionkey + 1 as bigint) as city_id"
    )
    lookups = [
        Lookup(vendor, ("user_id",), ("vendor_id", "c_nationkey")),
        Lookup(agency, ("c_nationkey",), ("agency_id", "n_regionkey")),
        Lookup(city, ("n_regionkey",), ("city_id",)),
    ]
    drop = ["user_id", "c_nationkey", "n_regionkey"]
    return resolve(literal_period(events, 2024, 1), lookups, drop, **options)


@query("""
    select count(*) as total_rows,
        count(*) filter (where o.o_orderkey is null or v.c_custkey is null) as null_key_rows,
        count(*) filter (where o.o_orderkey is null or v.c_custkey is null) * 100.0::double / count(*)
            as null_key_pct
    from orders o
    left join (select * from customer where c_nationkey <> 3) v on o.o_custkey = v.c_custkey
    where year(o.o_orderdate) = 1998 and month(o.o_orderdate) = 3
""")
def dq_fact_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_keys(_order_fact(spark, sf_dir, (1998, 3)), ["o_orderkey", "vendor_id"], (1998, 3))


@query("select count(*) as n_rows, count(*) >= 100 as passed from supplier")
def dq_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(table(spark, sf_dir, "supplier"), 100)


@query("""
    select count(*) as duplicate_keys
    from (select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(*) > 1)
""")
def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    select count(*) as duplicate_keys
    from (
      select o_custkey, o_orderdate from orders group by 1, 2
      having count(*) > 1 and max(o_orderkey) > 1000
    )
""")
def dq_duplicate_keys_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"], "o_orderkey", checked=1000)
