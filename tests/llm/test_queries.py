"""Registered queries on the smallest tables: against their SQL, or against plain models of their contract."""

import hashlib
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
import xxhash

from monthstar.llm import ORACLES, QUERIES, bpe

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no driver tables")


def table(name):
    return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()


def result(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        duck.sql(f"create view {path.stem} as select * from '{path}'")
    expected = duck.sql(ORACLES[name])
    columns, want = expected.columns, expected.fetchall()
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(columns)
    got = sorted(tuple(row[c] for c in columns) for row in got.collect())
    assert got == sorted(want) and got


def test_bpe_equals_the_tokenizer_library(spark):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {row["doc_id"]: row["text"] or "" for row in table("documents")}
    rows = result(spark, "op3_byte_bpe")
    assert len(rows) == len(texts)
    for row in rows:
        ids = own.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == sha(",".join(map(str, ids)))
        assert row["decoded_sha256"] == sha(texts[row["doc_id"]])


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_simhash_equals_all_pairs(spark):
    docs = table("documents")
    prints = [plain_fingerprint(d["text"]) for d in docs]
    label = [d["doc_id"] for d in docs]
    changed = True
    while changed:
        changed = False
        for i in range(len(docs)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= 3 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    want = sorted((d["doc_id"], f"{p:016x}", c) for d, p, c in zip(docs, prints, label))
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in result(spark, "op8_simhash")]
    assert sorted(got) == want


def test_languages_of_held_out_documents(spark):
    lang = {row["doc_id"]: row["lang"] for row in table("documents")}
    rows = result(spark, "op5_language")
    assert len(rows) == len(lang) and {r["held_out"] for r in rows} == {True, False}
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    judged = [r for r in rows if r["held_out"] and lang[r["doc_id"]] and r["lang_pred"] != "und"]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in judged]) > 0.95


def test_quality_of_held_out_documents(spark):
    quality = {row["doc_id"]: row["quality"] for row in table("labels")}
    rows = result(spark, "op2_quality")
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    judged = [(r["score"], quality[r["doc_id"]]) for r in rows if r["held_out"] and quality.get(r["doc_id"]) is not None]
    good = [s for s, q in judged if q == 1]
    bad = [s for s, q in judged if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9


def test_main_text_is_the_article(spark):
    import html as markup

    pages = {row["page_id"]: row["html"] for row in table("pages")}
    rows = result(spark, "op6_main_text")
    assert len(rows) == len(pages)
    for row in rows:
        article = re.search(r"<article>(.*?)</article>", pages[row["page_id"]], re.S)[1]
        lines = (markup.unescape(re.sub(r"<[^>]*>", " ", part)) for part in re.split(r"</?(?:p|h1)>", article))
        want = "\n".join(line for line in (" ".join(part.split()) for part in lines) if line)
        assert row["text"] == want and row["n_chars"] == len(want)


def plain_matches(text, kinds):
    found = []
    for place, (kind, pattern, keep) in enumerate(kinds):
        found += [(m.start(), place, m.end(), kind) for m in re.finditer(pattern, text) if keep(m)]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


def digits(m):
    return re.sub("[^0-9]", "", m[0])


def luhn(number):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(number))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
)
SECRETS = (
    (
        "assign",
        r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[2]) >= 8,
    ),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
)


@pytest.mark.parametrize("name, kinds", [("op10_pii", PII), ("op9_secrets", SECRETS)])
def test_base_spans_equal_the_patterns(spark, name, kinds):
    texts = {row["doc_id"]: row["text"] or "" for row in table("documents")}
    rows = result(spark, name)
    assert len(rows) == len(texts)
    for row in rows:
        base = plain_matches(texts[row["doc_id"]], kinds)
        assert row["base_sha256"] == sha(",".join(base))
        assert set(base) <= set(row["spans"].split(",")) or not base
        for kind, _, _ in kinds:
            assert row[f"n_{kind}"] == sum(span.startswith(kind + ":") for span in base)
