"""The spending star itself: its raw families written from the tables, one month run, every table stated in SQL.

Orders of the month are commitments and payments, suppliers are known from
settlements only, parts give expense types, events are vouchers. Customers of one
nation have no vendor code, and their vouchers no establishment.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthstar import SPENDING_WITH_TYPES, run_month
from monthstar.functions import request_date
from monthstar.operators import Lookup, in_period, resolve
from monthstar.sinks import land_records
from monthstar.sources import read_table
from monthstar.specs import Star
from parity.files import write_csv
from parity.flows import money
from parity.registry import query, scratch, table

YEAR, MONTH = 1998, 3
#: Vouchers in a compressed raw file; as plain text they are some 80 MB.
VOUCHERS_PER_FILE = 100_000
STAR = Star(
    SPENDING_WITH_TYPES.dimensions,
    tuple(replace(fact, max_null_percent=60) for fact in SPENDING_WITH_TYPES.facts),
)
_built: dict[tuple[str, str], str] = {}


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    places = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    return customer.join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")).withColumn(
        "code", F.when(F.col("c_nationkey") != 3, F.col("c_custkey")).cast("string")
    )


def _office() -> list[Column]:
    return [
        F.col("r_regionkey").alias("Código Órgão Superior"),
        F.col("r_name").alias("Órgão Superior"),
        F.col("n_nationkey").alias("Código Órgão"),
        F.col("n_name").alias("Órgão"),
        F.col("c_mktsegment").alias("Código Unidade Gestora"),
        F.lower("c_mktsegment").alias("Unidade Gestora"),
    ]


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def write_raw(spark: SparkSession, sf_dir: str, root: str) -> None:
    """All five raw families of the month under their real names and headers."""
    people = _people(spark, sf_dir)
    folder = f"{root}/raw_data/despesas/{YEAR}"
    stamp = f"{YEAR}{MONTH:02d}"
    orders = table(spark, sf_dir, "orders").where(in_period(YEAR, MONTH, "o_orderdate"))
    documents = orders.join(people, F.col("o_custkey") == F.col("c_custkey"))
    vendor = [F.col("code").alias("Código Favorecido"), F.col("c_name").alias("Favorecido")]
    issued = request_date("o_orderdate").alias("Data Emissão")
    commitments = documents.select(
        F.col("o_orderkey").alias("Id Empenho"),
        F.concat(F.lit("NE"), "o_orderkey").alias("Código Empenho"),
        *_office(),
        *vendor,
        issued,
        F.col("o_orderstatus").alias("Tipo Documento"),
        F.col("o_orderpriority").alias("Tipo Empenho"),
        F.lit("Original").alias("Espécie Empenho"),
        F.lower("o_orderpriority").alias("Modalidade de Licitação"),
        money("o_totalprice").alias("Valor Original do Empenho"),
        money("o_totalprice").alias("Valor do Empenho Convertido pra R$"),
        F.lit("1,25").alias("Valor Utilizado na Conversão"),
        F.lit("não lida").alias("Observação"),
    )
    write_csv(commitments, f"{folder}/Despesas_Empenho_{stamp}01")
    outside = F.when(F.col("o_orderstatus") == "F", "SIM").when(F.col("o_orderstatus") == "O", "NÃO")
    payments = documents.select(
        F.concat(F.lit("P"), "o_orderkey").alias("Código Pagamento"),
        *_office(),
        *vendor,
        issued,
        F.col("o_orderpriority").alias("Tipo Documento"),
        outside.alias("Extraorçamentário"),
        money("o_totalprice").alias("Valor Original do Pagamento"),
        money("o_totalprice").alias("Valor do Pagamento Convertido pra R$"),
        F.lit("").alias("Valor Utilizado na Conversão"),
    )
    write_csv(payments, f"{folder}/Despesas_Pagamento_{stamp}01")
    suppliers = table(spark, sf_dir, "supplier").select(
        F.lit("S").alias("Código Órgão Superior"),
        F.lit("Supply").alias("Órgão Superior"),
        F.col("s_nationkey").alias("Código Órgão"),
        F.concat(F.lit("office "), "s_nationkey").alias("Órgão"),
        F.lit("stock").alias("Código Unidade Gestora"),
        F.lit("Stock").alias("Unidade Gestora"),
        F.concat(F.lit("s"), "s_suppkey").alias("Código Favorecido"),
        F.col("s_name").alias("Favorecido"),
        F.lit(f"02/{MONTH:02d}/{YEAR}").alias("Data Emissão"),
    )
    write_csv(suppliers, f"{folder}/Despesas_Liquidacao_{stamp}01")
    items = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("Código Categoria de Despesa"),
        F.upper("p_brand").alias("Categoria de Despesa"),
        F.col("p_size").alias("Código Grupo de Despesa"),
        F.concat(F.lit("size "), "p_size").alias("Grupo de Despesa"),
        F.nullif(F.col("p_type"), F.lit("ECONOMY")).alias("Código Modalidade de Aplicação"),
        F.lower("p_type").alias("Modalidade de Aplicação"),
        F.lit("3").alias("Código Elemento de Despesa"),
        F.lit("Material").alias("Elemento de Despesa"),
        F.lit("9").alias("Código SubElemento de Despesa"),
        F.lit("Papel").alias("SubElemento de Despesa"),
    )
    write_csv(items, f"{folder}/Despesas_ItemEmpenho_{stamp}01")
    events = table(spark, sf_dir, "events").join(people, F.col("user_id") == F.col("c_custkey"), "left")
    landed = f"{root}/raw_data/credit_card_vouchers/corporate-card-expenses-{YEAR}-{MONTH:02d}"
    land_records(_vouchers(events), landed, file_records=VOUCHERS_PER_FILE)


def _vouchers(events: DataFrame) -> DataFrame:
    codes = ("codigoClasse", "codigoDivisao", "codigoGrupo", "codigoSecao", "codigoSubclasse")
    cnae = [
        F.col("c_mktsegment").alias("classe"),
        *[F.lit(str(number)).alias(name) for number, name in enumerate(codes, 1)],
        *[F.concat(F.lit(name[0]), F.lower("c_mktsegment")).alias(name) for name in ("divisao", "grupo", "secao")],
        F.lower("c_mktsegment").alias("subclasse"),
    ]
    town = F.struct(
        _text("n_nationkey").alias("codigoIBGE"),
        F.col("n_name").alias("nomeIBGE"),
        F.lit("BRASIL").alias("pais"),
        F.struct(F.col("r_name").alias("nome"), _text("r_regionkey").alias("sigla")).alias("uf"),
    )
    shop = F.struct(
        F.struct(*cnae).alias("cnae"),
        F.col("code").alias("codigoFormatado"),
        F.concat(F.lit("LOJA "), _text("c_custkey")).alias("complementoEndereco"),
        F.lit("01/02/2001").alias("dataAbertura"),
        F.lit("RUA").alias("descricaoLogradouro"),
        F.lit("LOJA@EXEMPLO").alias("enderecoEletronico"),
        town.alias("municipio"),
        F.col("c_name").alias("nome"),
        F.lit("CENTRO").alias("nomeBairro"),
        F.lit("01000").alias("numeroCEP"),
        _text("c_custkey").alias("numeroEndereco"),
    )
    top = F.struct(
        _text("r_regionkey").alias("codigo"), F.lower("r_name").alias("nome"), F.lit("OS").alias("sigla")
    )
    bound = F.struct(
        F.lit("00.000").alias("cnpj"),
        _text("n_nationkey").alias("codigoSIAFI"),
        F.lit("Executivo").alias("descricaoPoder"),
        F.lower("n_name").alias("nome"),
        top.alias("orgaoMaximo"),
    )
    unit = F.struct(
        F.col("c_mktsegment").alias("codigo"), F.initcap("c_mktsegment").alias("nome"), bound.alias("orgaoVinculado")
    )
    return events.select(
        F.col("event_id").alias("id"),
        request_date("ts").alias("dataTransacao"),
        money("value").alias("valorTransacao"),
        F.when(F.col("code").isNotNull(), shop).alias("estabelecimento"),
        F.when(F.col("c_custkey").isNotNull(), unit).alias("unidadeGestora"),
    )


def spending_root(spark: SparkSession, sf_dir: str) -> str:
    """The star after the month; one run serves all queries of a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        root = scratch(spark, "spending")
        write_raw(spark, sf_dir, root)
        run_month(spark, root, STAR, YEAR, MONTH)
        _built[key] = root
    return _built[key]


def _members(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    dimension = STAR.dimension(name)
    stored = read_table(spark, f"{spending_root(spark, sf_dir)}/dimension/{name}", schema=dimension.schema)
    return stored.drop(dimension.id_column)


def _rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored fact with the natural keys behind its ids."""
    root = spending_root(spark, sf_dir)
    fact = STAR.fact(name)
    found = read_table(spark, f"{root}/fact/{name}")
    for dimension in map(STAR.dimension, fact.dimensions):
        kept = read_table(spark, f"{root}/dimension/{dimension.name}", schema=dimension.schema)
        keys = kept.select(dimension.id_column, *dimension.keys)
        for key in set(dimension.keys) & set(found.columns):
            keys = keys.withColumnRenamed(key, f"{dimension.name}_{key}")
        found = resolve(found, [Lookup(keys, (dimension.id_column,), tuple(keys.columns[1:]))])
        found = found.drop(dimension.id_column)
    return found


# Restated once for all queries: people with their places, documents and vouchers of the month.
_WITH = """
with people as (
    select c_custkey, c_name, c_mktsegment, c_nationkey, n_nationkey, n_name, r_regionkey, r_name,
        case when c_nationkey <> 3 then cast(c_custkey as varchar) end as code
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
document as (
    select * from orders join people on o_custkey = c_custkey
    where year(o_orderdate) = 1998 and month(o_orderdate) = 3),
voucher as (select * from events left join people on user_id = c_custkey),
"""


@query(_WITH + """
csv as (
    select c_mktsegment as branch_code, cast(n_nationkey as varchar) as agency_code,
        cast(r_regionkey as varchar) as highest_department_code, n_name as agency, lower(c_mktsegment) as branch,
        r_name as highest_department
    from document
    union
    select 'stock', cast(s_nationkey as varchar), 'S', 'office ' || s_nationkey, 'Stock', 'Supply' from supplier),
json as (
    select distinct c_mktsegment as branch_code, cast(n_nationkey as varchar) as agency_code,
        cast(r_regionkey as varchar) as highest_department_code, lower(n_name) as agency,
        upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) as branch, lower(r_name) as highest_department
    from voucher where c_custkey is not null)
select branch_code, agency_code, highest_department_code,
    case when j.agency is not null then '00.000' end as agency_document_number,
    case when j.agency is not null then 'Executivo' end as agency_state_power,
    case when j.agency is not null then 'OS' end as highest_department_acronym,
    coalesce(c.agency, j.agency) as agency, coalesce(c.branch, j.branch) as branch,
    coalesce(c.highest_department, j.highest_department) as highest_department
from csv c full join json j using (branch_code, agency_code, highest_department_code)
""")
def spending_agency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _members(spark, sf_dir, "agency")


@query(_WITH + """
csv as (
    select distinct code as vendor_code, c_name as vendor_name from document where code is not null
    union select 's' || s_suppkey, s_name from supplier),
json as (select distinct code as vendor_code, c_name as vendor_name, c_custkey, c_mktsegment, n_nationkey, n_name,
        r_regionkey, r_name from voucher where code is not null)
select vendor_code, vendor_name, c_mktsegment as cnae_class,
    case when c_custkey is not null then '1' end as cnae_class_code,
    case when c_custkey is not null then '2' end as cnae_division_class,
    case when c_custkey is not null then '3' end as cnae_group_code,
    case when c_custkey is not null then '4' end as cnae_section_code,
    case when c_custkey is not null then '5' end as cnae_sub_class_code,
    'd' || lower(c_mktsegment) as cnae_division, 'g' || lower(c_mktsegment) as cnae_group,
    's' || lower(c_mktsegment) as cnae_section, lower(c_mktsegment) as cnae_subclass,
    'LOJA ' || c_custkey as address_compliment, case when c_custkey is not null then '01/02/2001' end as opening_date,
    case when c_custkey is not null then 'RUA' end as street_name,
    case when c_custkey is not null then 'LOJA@EXEMPLO' end as email,
    cast(n_nationkey as varchar) as city_code, n_name as city_name,
    case when c_custkey is not null then 'BRASIL' end as country, r_name as state_name,
    cast(r_regionkey as varchar) as state, case when c_custkey is not null then 'CENTRO' end as neighborhood_name,
    case when c_custkey is not null then '01000' end as zipcode, cast(c_custkey as varchar) as street_number
from csv full join json using (vendor_code, vendor_name)
""")
def spending_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _members(spark, sf_dir, "vendor")


@query(_WITH + """
unused as (select 1)
select distinct cast(n_nationkey as varchar) as city_code, n_name as city, 'BRASIL' as country, r_name as state,
    cast(r_regionkey as varchar) as state_acronym
from voucher where code is not null
""")
def spending_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _members(spark, sf_dir, "city")


@query("""
    select distinct p_brand as expense_type_code, upper(p_brand) as expense_type,
        cast(p_size as varchar) as expense_group_code, 'size ' || p_size as expense_group, p_type as investment_type_code, lower(p_type) as investment_type,
        '3' as expense_element_code, 'Material' as expense_element, '9' as expense_sub_element_code,
        'Papel' as expense_sub_element
    from part where p_type <> 'ECONOMY'
""")
def spending_expense_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _members(spark, sf_dir, "expense_type")


@query(_WITH + """
unused as (select 1)
select cast(o_orderkey as varchar) as commitment_id, 'NE' || o_orderkey as commitment_code,
    cast(o_orderdate as date) as commitment_date, o_totalprice as commitment_amount, o_totalprice as amount_in_rs,
    1.25::double as conversion_rate, o_orderstatus as document_type, o_orderpriority as commitment_type,
    'Original' as commitment_currency, lower(o_orderpriority) as bidding_mode, 1998 as year, 3 as month,
    code as vendor_code, case when code is not null then c_name end as vendor_name, c_mktsegment as branch_code,
    cast(n_nationkey as varchar) as agency_code, cast(r_regionkey as varchar) as highest_department_code
from document
""")
def spending_commitment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir, "commitment")


@query(_WITH + """
unused as (select 1)
select 'P' || o_orderkey as payment_code, cast(o_orderdate as date) as payment_date, o_orderpriority as document_type,
    case o_orderstatus when 'F' then false else true end as payment_in_budget, o_totalprice as payment_amount,
    o_totalprice as payment_amount_in_rs, cast(null as double) as conversion_rate, 1998 as year, 3 as month,
    code as vendor_code, case when code is not null then c_name end as vendor_name, c_mktsegment as branch_code,
    cast(n_nationkey as varchar) as agency_code, cast(r_regionkey as varchar) as highest_department_code
from document
""")
def spending_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir, "payment")


@query(_WITH + """
unused as (select 1)
select cast(ts as date) as payment_date, event_id as payment_id,
    replace(replace(replace(format('{:,.2f}', value), ',', '_'), '.', ','), '_', '.') as payment_value,
    value as payment_amount, 1998 as year, 3 as month, code as vendor_code,
    case when code is not null then c_name end as vendor_name, c_mktsegment as branch_code,
    cast(n_nationkey as varchar) as agency_code, cast(r_regionkey as varchar) as highest_department_code,
    case when code is not null then cast(n_nationkey as varchar) end as city_code,
    case when code is not null then n_name end as city, case when code is not null then 'BRASIL' end as country,
    case when code is not null then r_name end as state,
    case when code is not null then cast(r_regionkey as varchar) end as state_acronym
from voucher
""")
def spending_voucher_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir, "voucher_payment")
