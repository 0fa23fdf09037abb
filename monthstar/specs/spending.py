"""The public spending star: agencies, vendors, cities, expense types, and
the commitment, payment and voucher facts.

Raw exports come as semicolon CSV files per day or month and as nested JSON
vouchers per month.
"""

from __future__ import annotations

from monthstar.specs.model import (
    Dimension,
    Fact,
    Family,
    StagedSource,
    Star,
    amount,
    day,
    flag,
    leaf,
    month_field,
    text,
    year_field,
)

# Schema of the voucher service's records.
VOUCHER_SCHEMA = """
    dataTransacao string,
    estabelecimento struct<
        cnae: struct<
            classe: string, codigoClasse: string, codigoDivisao: string, codigoGrupo: string,
            codigoSecao: string, codigoSubclasse: string, divisao: string, grupo: string,
            secao: string, subclasse: string>,
        codigoFormatado: string, complementoEndereco: string, dataAbertura: string,
        descricaoLogradouro: string, enderecoEletronico: string, localidadePessoa: string,
        municipio: struct<
            codigoIBGE: string, nomeIBGE: string, pais: string,
            uf: struct<nome: string, sigla: string>>,
        naturezaJuridica: struct<
            codigo: string, codigoTipo: string, descricao: string, descricaoTipo: string>,
        nome: string, nomeBairro: string, nomeFantasiaReceita: string, numeroCEP: string,
        numeroEndereco: string, numeroInscricaoSocial: string, numeroTelefone: string,
        razaoSocialReceita: string, tipoCodigo: string, tipoPessoa: string>,
    id bigint,
    mesExtrato string,
    portador struct<codigoFormatado: string, nome: string>,
    tipoCartao struct<codigo: string, descricao: string, id: bigint>,
    unidadeGestora struct<
        codigo: string, nome: string,
        orgaoVinculado: struct<
            cnpj: string, codigoSIAFI: string, descricaoPoder: string, nome: string,
            orgaoMaximo: struct<codigo: string, nome: string, sigla: string>,
            sigla: string>>,
    valorTransacao string
"""

# File names of the exports.
COMMITMENTS = Family("commitments", "raw_data/despesas/{year}/Despesas_Empenho_{year}{month:02d}*")
SETTLEMENTS = Family("settlements", "raw_data/despesas/{year}/Despesas_Liquidacao_{year}{month:02d}*")
PAYMENTS = Family("payments", "raw_data/despesas/{year}/Despesas_Pagamento_{year}{month:02d}*")
COMMITMENT_ITEMS = Family("commitment_items", "raw_data/despesas/{year}/Despesas_ItemEmpenho_{year}{month:02d}*")
VOUCHERS = Family(
    "vouchers",
    "raw_data/credit_card_vouchers/corporate-card-expenses-{year}-{month:02d}*",
    format="json",
    schema=VOUCHER_SCHEMA,
)

# Natural keys of the dimensions.
AGENCY_KEYS = ("branch_code", "agency_code", "highest_department_code")
VENDOR_KEYS = ("vendor_code", "vendor_name")
CITY_KEYS = ("city_code", "city", "country", "state", "state_acronym")
EXPENSE_TYPE_KEYS = (
    "expense_type_code",
    "expense_group_code",
    "investment_type_code",
    "expense_element_code",
    "expense_sub_element_code",
)

# Headers of the exports and the names of the columns they become.
EXPENSES_AGENCY = (
    text("agency_code", "Código Órgão"),
    text("agency", "Órgão"),
    text("branch_code", "Código Unidade Gestora"),
    text("branch", "Unidade Gestora"),
    text("highest_department_code", "Código Órgão Superior"),
    text("highest_department", "Órgão Superior"),
)

EXPENSES_VENDOR = (
    text("vendor_code", "Código Favorecido"),
    text("vendor_name", "Favorecido"),
)

EXPENSE_TYPE = (
    text("expense_type_code", "Código Categoria de Despesa"),
    text("expense_type", "Categoria de Despesa"),
    text("expense_group_code", "Código Grupo de Despesa"),
    text("expense_group", "Grupo de Despesa"),
    text("investment_type_code", "Código Modalidade de Aplicação"),
    text("investment_type", "Modalidade de Aplicação"),
    text("expense_element_code", "Código Elemento de Despesa"),
    text("expense_element", "Elemento de Despesa"),
    text("expense_sub_element_code", "Código SubElemento de Despesa"),
    text("expense_sub_element", "SubElemento de Despesa"),
)

VOUCHER_VENDOR = (
    leaf("cnae_class", "estabelecimento.cnae.classe"),
    leaf("cnae_class_code", "estabelecimento.cnae.codigoClasse"),
    leaf("cnae_division_class", "estabelecimento.cnae.codigoDivisao"),
    leaf("cnae_group_code", "estabelecimento.cnae.codigoGrupo"),
    leaf("cnae_section_code", "estabelecimento.cnae.codigoSecao"),
    leaf("cnae_sub_class_code", "estabelecimento.cnae.codigoSubclasse"),
    leaf("cnae_division", "estabelecimento.cnae.divisao"),
    leaf("cnae_group", "estabelecimento.cnae.grupo"),
    leaf("cnae_section", "estabelecimento.cnae.secao"),
    leaf("cnae_subclass", "estabelecimento.cnae.subclasse"),
    leaf("vendor_code", "estabelecimento.codigoFormatado"),
    leaf("address_compliment", "estabelecimento.complementoEndereco"),
    leaf("opening_date", "estabelecimento.dataAbertura"),
    leaf("street_name", "estabelecimento.descricaoLogradouro"),
    leaf("email", "estabelecimento.enderecoEletronico"),
    leaf("city_code", "estabelecimento.municipio.codigoIBGE"),
    leaf("city_name", "estabelecimento.municipio.nomeIBGE"),
    leaf("country", "estabelecimento.municipio.pais"),
    leaf("state_name", "estabelecimento.municipio.uf.nome"),
    leaf("state", "estabelecimento.municipio.uf.sigla"),
    leaf("vendor_name", "estabelecimento.nome"),
    leaf("neighborhood_name", "estabelecimento.nomeBairro"),
    leaf("zipcode", "estabelecimento.numeroCEP"),
    leaf("street_number", "estabelecimento.numeroEndereco"),
)

VOUCHER_AGENCY = (
    leaf("branch_code", "unidadeGestora.codigo"),
    leaf("branch", "unidadeGestora.nome"),
    leaf("agency_document_number", "unidadeGestora.orgaoVinculado.cnpj"),
    leaf("agency_code", "unidadeGestora.orgaoVinculado.codigoSIAFI"),
    leaf("agency_state_power", "unidadeGestora.orgaoVinculado.descricaoPoder"),
    leaf("agency", "unidadeGestora.orgaoVinculado.nome"),
    leaf("highest_department_code", "unidadeGestora.orgaoVinculado.orgaoMaximo.codigo"),
    leaf("highest_department", "unidadeGestora.orgaoVinculado.orgaoMaximo.nome"),
    leaf("highest_department_acronym", "unidadeGestora.orgaoVinculado.orgaoMaximo.sigla"),
)

VOUCHER_CITY = (
    leaf("city_code", "estabelecimento.municipio.codigoIBGE"),
    leaf("city", "estabelecimento.municipio.nomeIBGE"),
    leaf("country", "estabelecimento.municipio.pais"),
    leaf("state", "estabelecimento.municipio.uf.nome"),
    leaf("state_acronym", "estabelecimento.municipio.uf.sigla"),
)

COMMITMENT_FACT = (
    text("commitment_id", "Id Empenho"),
    text("commitment_code", "Código Empenho"),
    day("commitment_date", "Data Emissão"),
    amount("commitment_amount", "Valor Original do Empenho"),
    amount("amount_in_rs", "Valor do Empenho Convertido pra R$"),
    amount("conversion_rate", "Valor Utilizado na Conversão"),
    text("document_type", "Tipo Documento"),
    text("commitment_type", "Tipo Empenho"),
    text("commitment_currency", "Espécie Empenho"),
    text("highest_department_code", "Código Órgão Superior"),
    text("agency_code", "Código Órgão"),
    text("branch_code", "Código Unidade Gestora"),
    text("vendor_code", "Código Favorecido"),
    text("vendor_name", "Favorecido"),
    text("bidding_mode", "Modalidade de Licitação"),
    year_field("Data Emissão"),
    month_field("Data Emissão"),
)

PAYMENT_FACT = (
    text("payment_code", "Código Pagamento"),
    day("payment_date", "Data Emissão"),
    text("document_type", "Tipo Documento"),
    flag("payment_in_budget", "Extraorçamentário"),
    text("highest_department_code", "Código Órgão Superior"),
    text("agency_code", "Código Órgão"),
    text("branch_code", "Código Unidade Gestora"),
    text("vendor_code", "Código Favorecido"),
    text("vendor_name", "Favorecido"),
    amount("payment_amount", "Valor Original do Pagamento"),
    amount("payment_amount_in_rs", "Valor do Pagamento Convertido pra R$"),
    amount("conversion_rate", "Valor Utilizado na Conversão"),
    year_field("Data Emissão"),
    month_field("Data Emissão"),
)

VOUCHER_PAYMENT_FACT = (
    day("payment_date", "dataTransacao"),
    text("payment_id", "id"),
    leaf("vendor_code", "estabelecimento.codigoFormatado"),
    leaf("vendor_name", "estabelecimento.nome"),
    leaf("branch_code", "unidadeGestora.codigo"),
    leaf("agency_code", "unidadeGestora.orgaoVinculado.codigoSIAFI"),
    leaf("highest_department_code", "unidadeGestora.orgaoVinculado.orgaoMaximo.codigo"),
    leaf("city_code", "estabelecimento.municipio.codigoIBGE"),
    leaf("city", "estabelecimento.municipio.nomeIBGE"),
    leaf("country", "estabelecimento.municipio.pais"),
    leaf("state", "estabelecimento.municipio.uf.nome"),
    leaf("state_acronym", "estabelecimento.municipio.uf.sigla"),
    text("payment_value", "valorTransacao"),
    amount("payment_amount", "valorTransacao"),
)

DOCUMENTS = (COMMITMENTS, SETTLEMENTS, PAYMENTS)

AGENCY = Dimension(
    "agency",
    AGENCY_KEYS,
    (
        StagedSource("expenses_agency", DOCUMENTS, EXPENSES_AGENCY),
        StagedSource("vouchers_agency", (VOUCHERS,), VOUCHER_AGENCY),
    ),
)
VENDOR = Dimension(
    "vendor",
    VENDOR_KEYS,
    (
        StagedSource("expenses_vendor", DOCUMENTS, EXPENSES_VENDOR),
        StagedSource("vouchers_vendor", (VOUCHERS,), VOUCHER_VENDOR),
    ),
)
CITY = Dimension("city", CITY_KEYS, (StagedSource("vouchers_city", (VOUCHERS,), VOUCHER_CITY),))
EXPENSE_TYPES = Dimension(
    "expense_type",
    EXPENSE_TYPE_KEYS,
    (StagedSource("expense_type", (COMMITMENT_ITEMS,), EXPENSE_TYPE),),
)

COMMITMENT = Fact(
    "commitment",
    COMMITMENTS,
    COMMITMENT_FACT,
    ("vendor", "agency"),
    required=("commitment_id", "vendor_id", "agency_id"),
)
PAYMENT = Fact(
    "payment",
    PAYMENTS,
    PAYMENT_FACT,
    ("vendor", "agency"),
    required=("payment_code", "vendor_id", "agency_id"),
)
VOUCHER_PAYMENT = Fact(
    "voucher_payment",
    VOUCHERS,
    VOUCHER_PAYMENT_FACT,
    ("vendor", "agency", "city"),
    row_period=False,
    required=("payment_id", "vendor_id", "agency_id", "city_id"),
)

# The monthly run. Commitment items are a separate export that need not be
# there, so the star with expense types is a second one.
SPENDING = Star((AGENCY, VENDOR, CITY), (COMMITMENT, PAYMENT, VOUCHER_PAYMENT))
SPENDING_WITH_TYPES = Star((AGENCY, VENDOR, CITY, EXPENSE_TYPES), (COMMITMENT, PAYMENT, VOUCHER_PAYMENT))
