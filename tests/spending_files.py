"""Two invented months of raw exports under a root folder."""

import json
from pathlib import Path

DOCUMENT_HEADERS = [
    "Código Órgão Superior",
    "Órgão Superior",
    "Código Órgão",
    "Órgão",
    "Código Unidade Gestora",
    "Unidade Gestora",
    "Código Favorecido",
    "Favorecido",
    "Data Emissão",
]
COMMITMENT_HEADERS = [
    "Id Empenho",
    "Código Empenho",
    *DOCUMENT_HEADERS,
    "Tipo Documento",
    "Tipo Empenho",
    "Espécie Empenho",
    "Modalidade de Licitação",
    "Valor Original do Empenho",
    "Valor do Empenho Convertido pra R$",
    "Valor Utilizado na Conversão",
    "Observação",
]
PAYMENT_HEADERS = [
    "Código Pagamento",
    *DOCUMENT_HEADERS,
    "Tipo Documento",
    "Extraorçamentário",
    "Valor Original do Pagamento",
    "Valor do Pagamento Convertido pra R$",
    "Valor Utilizado na Conversão",
]
ITEM_HEADERS = [
    "Código Categoria de Despesa",
    "Categoria de Despesa",
    "Código Grupo de Despesa",
    "Grupo de Despesa",
    "Código Modalidade de Aplicação",
    "Modalidade de Aplicação",
    "Código Elemento de Despesa",
    "Elemento de Despesa",
    "Código SubElemento de Despesa",
    "SubElemento de Despesa",
]

EDUCATION = {"superior": ("26000", "Educação"), "agency": ("26201", "Colégio São João"), "branch": ("153", "Sede")}
HEALTH = {"superior": ("36000", "Saúde"), "agency": ("36201", "Água Viva"), "branch": ("254", "Núcleo Sul")}
PARKS = {"superior": ("44000", "Ambiente"), "agency": ("44201", "Parques"), "branch": ("443", "Serra")}


def document(office, vendor, issued, **more):
    row = {
        "Código Órgão Superior": office["superior"][0],
        "Órgão Superior": office["superior"][1],
        "Código Órgão": office["agency"][0],
        "Órgão": office["agency"][1],
        "Código Unidade Gestora": office["branch"][0],
        "Unidade Gestora": office["branch"][1],
        "Código Favorecido": vendor[0],
        "Favorecido": vendor[1],
        "Data Emissão": issued,
    }
    return {**row, **more}


def commitment(number, office, vendor, issued, value="10,50", rate="1,00"):
    return document(
        office,
        vendor,
        issued,
        **{
            "Id Empenho": f"E{number}",
            "Código Empenho": f"NE{number}",
            "Tipo Documento": "Nota de Empenho",
            "Tipo Empenho": "Ordinário",
            "Espécie Empenho": "Original",
            "Modalidade de Licitação": "Pregão",
            "Valor Original do Empenho": value,
            "Valor do Empenho Convertido pra R$": value,
            "Valor Utilizado na Conversão": rate,
            "Observação": "não lida",
        },
    )


def payment(number, office, vendor, issued, value="10,50", outside="NÃO"):
    return document(
        office,
        vendor,
        issued,
        **{
            "Código Pagamento": f"P{number}",
            "Tipo Documento": "Ordem Bancária",
            "Extraorçamentário": outside,
            "Valor Original do Pagamento": value,
            "Valor do Pagamento Convertido pra R$": value,
            "Valor Utilizado na Conversão": "1,00",
        },
    )


def item(numbers, labels):
    codes = dict(zip(ITEM_HEADERS[0::2], numbers))
    return {**codes, **dict(zip(ITEM_HEADERS[1::2], labels))}


def voucher(number, office, vendor, spent="05/01/2020", value="1.234,56", town=("3550308", "São Paulo", "SP")):
    place = None
    if town:
        code, name, state = town
        place = {"codigoIBGE": code, "nomeIBGE": name, "pais": "BRASIL", "uf": {"nome": name, "sigla": state}}
    return {
        "id": number,
        "mesExtrato": "01/2020",
        "dataTransacao": spent,
        "valorTransacao": value,
        "tipoCartao": {"id": 1, "codigo": "1", "descricao": "CPGF"},
        "portador": {"codigoFormatado": "***", "nome": "Pessoa"},
        "estabelecimento": vendor and {**vendor, "municipio": place},
        "unidadeGestora": office and {
            "codigo": office["branch"][0],
            "nome": office["branch"][1] + " (cartão)",
            "orgaoVinculado": {
                "codigoSIAFI": office["agency"][0],
                "cnpj": "00.000",
                "sigla": "AG",
                "descricaoPoder": "Executivo",
                "nome": office["agency"][1] + " (cartão)",
                "orgaoMaximo": {"codigo": office["superior"][0], "nome": office["superior"][1], "sigla": "OS"},
            },
        },
    }


def shop(code, name, **more):
    """An establishment with every attribute, unless one is given as None."""
    attributes = {
        "codigoFormatado": code,
        "nome": name,
        "complementoEndereco": "LOJA 1",
        "dataAbertura": "01/02/2001",
        "descricaoLogradouro": "RUA DAS FLORES",
        "enderecoEletronico": "LOJA@EXEMPLO",
        "nomeBairro": "CENTRO",
        "numeroCEP": "01000",
        "numeroEndereco": "10",
        "cnae": {
            "classe": "c",
            "codigoClasse": "1",
            "codigoDivisao": "2",
            "codigoGrupo": "3",
            "codigoSecao": "4",
            "codigoSubclasse": "5",
            "divisao": "d",
            "grupo": "g",
            "secao": "s",
            "subclasse": "u",
        },
    }
    return {**attributes, **more}


def write_csv(path, headers, rows):
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [";".join(f'"{name}"' for name in headers)]
    for row in rows:
        cells = [row.get(name) for name in headers]
        lines.append(";".join("" if cell is None else f'"{cell}"' for cell in cells))
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def write_json(path, records):
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(records, ensure_ascii=False), encoding="utf-8")


def write_files(root, year, month, commitments, settlements, payments, vouchers, items=None):
    folder = Path(root) / "raw_data" / "despesas" / str(year)
    stamp = f"{year}{month:02d}"
    half = len(payments) // 2
    write_csv(folder / f"Despesas_Empenho_{stamp}01.csv", COMMITMENT_HEADERS, commitments)
    write_csv(folder / f"Despesas_Liquidacao_{stamp}01.csv", DOCUMENT_HEADERS, settlements)
    write_csv(folder / f"Despesas_Pagamento_{stamp}01.csv", PAYMENT_HEADERS, payments[:half])
    write_csv(folder / f"Despesas_Pagamento_{stamp}02.csv", PAYMENT_HEADERS, payments[half:])
    if items is not None:
        write_csv(folder / f"Despesas_ItemEmpenho_{stamp}01.csv", ITEM_HEADERS, items)
    cards = Path(root) / "raw_data" / "credit_card_vouchers"
    write_json(cards / f"corporate-card-expenses-{year}-{month:02d}-01.json", vouchers)


BAKER = ("11", "Padaria Açúcar")
BAKER_RENAMED = ("11", "Padaria Mel")
PRINTER = ("22", "Gráfica")
STATION = ("33", "Posto")
FERRY = ("44", "Balsa")


def write_january(root):
    write_files(
        root,
        2020,
        1,
        commitments=[
            commitment(1, EDUCATION, BAKER, "05/01/2020", "1.234,56", "5,25"),
            commitment(2, EDUCATION, BAKER_RENAMED, "06/01/2020", "-3,00"),
            commitment(3, HEALTH, PRINTER, "31/01/2020", ""),
            commitment(4, HEALTH, PRINTER, "31/12/2019"),
            commitment(5, HEALTH, PRINTER, "sem data"),
            commitment(6, HEALTH, (None, "Sem código"), "07/01/2020", "valor"),
        ],
        settlements=[document(PARKS, FERRY, "02/01/2020"), document(PARKS, FERRY, "02/01/2020")],
        payments=[
            payment(1, EDUCATION, BAKER, "08/01/2020", outside="SIM"),
            payment(2, HEALTH, PRINTER, "08/01/2020", outside="NÃO"),
            payment(3, HEALTH, PRINTER, "09/01/2020", outside=None),
        ],
        vouchers=[
            voucher(101, EDUCATION, shop(*BAKER)),
            voucher(102, HEALTH, shop(*STATION, complementoEndereco=None), spent="20/12/2019"),
            voucher(103, HEALTH, shop(None, "Sem código"), town=None),
        ],
        items=[
            item("34133", ["Corrente", "Outras", "Direta", "Material", "Papel"]),
            item("34133", ["Corrente", "Outras", "Direta", "Material", "Papel"]),
            item(["3", "4", None, "3", "3"], ["Corrente", "Outras", "?", "Material", "Papel"]),
        ],
    )


def write_february(root):
    write_files(
        root,
        2020,
        2,
        commitments=[commitment(11, EDUCATION, BAKER, "05/02/2020"), commitment(12, PARKS, FERRY, "06/02/2020")],
        settlements=[document(EDUCATION, ("55", "Novo"), "02/02/2020")],
        payments=[payment(11, PARKS, FERRY, "08/02/2020"), payment(12, EDUCATION, ("55", "Novo"), "08/02/2020")],
        vouchers=[
            voucher(201, PARKS, shop("66", "Mercado"), spent="10/02/2020", town=("3304557", "Rio", "RJ")),
        ],
        items=[item("34190", ["Corrente", "Outras", "Direta", "Serviços", "Frete"])],
    )
