"""Random months through the spending star, against a plain Python model."""

import random
from dataclasses import replace

import pytest

from monthstar import SPENDING, run_month
from monthstar.specs import Star
from monthstar.specs.spending import AGENCY, CITY, VENDOR
from tests.spending_files import commitment, document, payment, shop, voucher, write_files

ANY_SHARE = Star(SPENDING.dimensions, tuple(replace(fact, max_null_percent=100) for fact in SPENDING.facts))
MONTHS = [(2019, 12), (2020, 1), (2020, 2)]


class Months:
    """Random documents; a third of them name one vendor, some lack a key or a date."""

    def __init__(self, seed):
        self.draw = random.Random(seed)
        self.number = 0

    def vendor(self):
        if self.draw.random() < 0.33:
            return "1", "Padaria Açúcar"
        code = str(self.draw.randrange(40))
        name = f"Loja {self.draw.randrange(3)} de {code}"
        return self.draw.choice([(code, name)] * 8 + [(None, name), (code, None)])

    def office(self):
        number = self.draw.randrange(12)
        branch = None if self.draw.random() < 0.05 else f"U{number}"
        return {
            "superior": (f"S{number % 3}", f"Superior {number % 3}"),
            "agency": (f"A{number % 6}", f"Órgão {number % 6}"),
            "branch": (branch, f"Unidade {number}"),
        }

    def day(self, year, month):
        if self.draw.random() < 0.1:
            return self.draw.choice(["01/06/2018", "", "2020-01-01", f"31/02/{year}"])
        return f"{self.draw.randrange(1, 29):02d}/{month:02d}/{year}"

    def town(self):
        number = self.draw.randrange(5)
        return self.draw.choice([(f"T{number}", f"Cidade {number}", "SP")] * 6 + [None])

    def next(self):
        self.number += 1
        return self.number

    def month(self, year, month):
        return {
            "commitments": [
                commitment(self.next(), self.office(), self.vendor(), self.day(year, month)) for _ in range(60)
            ],
            "settlements": [document(self.office(), self.vendor(), self.day(year, month)) for _ in range(40)],
            "payments": [payment(self.next(), self.office(), self.vendor(), self.day(year, month)) for _ in range(80)],
            "vouchers": [
                voucher(self.next(), self.office(), shop(*self.vendor()), self.day(year, month), town=self.town())
                for _ in range(50)
            ],
        }


def document_keys(row):
    vendor = (row["Código Favorecido"], row["Favorecido"])
    agency = (row["Código Unidade Gestora"], row["Código Órgão"], row["Código Órgão Superior"])
    return vendor, agency


def voucher_keys(row):
    place = row["estabelecimento"]["municipio"]
    city = (None,) * 5
    if place:
        city = (place["codigoIBGE"], place["nomeIBGE"], place["pais"], place["uf"]["nome"], place["uf"]["sigla"])
    office = row["unidadeGestora"]
    linked = office["orgaoVinculado"]
    agency = (office["codigo"], linked["codigoSIAFI"], linked["orgaoMaximo"]["codigo"])
    return (row["estabelecimento"]["codigoFormatado"], row["estabelecimento"]["nome"]), agency, city


def known(key):
    return key if None not in key else None


def in_month(text, year, month):
    return len(text) == 10 and text[2:] == f"/{month:02d}/{year}" and int(text[:2]) < 29


class Model:
    """Members by dimension and fact rows by month, as sets of natural keys."""

    def __init__(self):
        self.members = {"vendor": set(), "agency": set(), "city": set()}
        self.facts = {}

    def run(self, year, month, raw):
        documents = raw["commitments"] + raw["settlements"] + raw["payments"]
        seen = [document_keys(row) for row in documents] + [voucher_keys(row) for row in raw["vouchers"]]
        for keys in seen:
            for name, key in zip(("vendor", "agency", "city"), keys):
                self.members[name] |= {known(key)} - {None}
        for fact, rows, number in (
            ("commitment", raw["commitments"], "Id Empenho"),
            ("payment", raw["payments"], "Código Pagamento"),
        ):
            self.facts[fact, year, month] = {
                (row[number], *map(known, document_keys(row)))
                for row in rows
                if in_month(row["Data Emissão"], year, month)
            }
        self.facts["voucher_payment", year, month] = {
            (row["id"], *map(known, voucher_keys(row))) for row in raw["vouchers"]
        }


def stored_members(spark, root, dimension):
    rows = spark.read.parquet(f"{root}/dimension/{dimension.name}").collect()
    found = {row[dimension.id_column]: tuple(row[key] for key in dimension.keys) for row in rows}
    assert len(found) == len(rows)
    return found


def stored_facts(spark, root, members):
    columns = {
        "commitment": ("commitment_id", "vendor", "agency"),
        "payment": ("payment_code", "vendor", "agency"),
        "voucher_payment": ("payment_id", "vendor", "agency", "city"),
    }
    found = {}
    for fact, (number, *dimensions) in columns.items():
        for row in spark.read.parquet(f"{root}/fact/{fact}").collect():
            keys = [members[name].get(row[f"{name}_id"]) for name in dimensions]
            group = found.setdefault((fact, row["year"], row["month"]), [])
            group.append((row[number], *keys))
    return found


def compare(spark, root, model):
    members = {d.name: stored_members(spark, root, d) for d in (VENDOR, AGENCY, CITY)}
    for name, rows in members.items():
        assert set(rows.values()) == model.members[name]
        assert sorted(rows) == list(range(1, len(model.members[name]) + 1))
    facts = stored_facts(spark, root, members)
    assert {key: sorted(rows, key=str) for key, rows in facts.items()} == {
        key: sorted(rows, key=str) for key, rows in model.facts.items()
    }
    return members


@pytest.mark.parametrize("seed, broadcast_bytes", [(1, 1 << 20), (2, 0)])
def test_random_months(spark, root, seed, broadcast_bytes):
    source, model, raw, members = Months(seed), Model(), {}, {}
    for period in MONTHS:
        raw[period] = source.month(*period)
        write_files(root, *period, **raw[period])
        run_month(spark, root, ANY_SHARE, *period, broadcast_bytes=broadcast_bytes)
        model.run(*period, raw[period])
        later = compare(spark, root, model)
        for name, rows in members.items():
            assert rows.items() <= later[name].items()
        members = later

    # A month delivered again with other documents replaces its rows only.
    raw[MONTHS[1]] = source.month(*MONTHS[1])
    write_files(root, *MONTHS[1], **raw[MONTHS[1]])
    run_month(spark, root, ANY_SHARE, *MONTHS[1], broadcast_bytes=broadcast_bytes)
    model.run(*MONTHS[1], raw[MONTHS[1]])
    compare(spark, root, model)
