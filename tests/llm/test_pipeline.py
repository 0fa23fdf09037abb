"""The pipeline against a plain model of its stages, and on odd rows."""

import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from monthstar.llm import bpe, contamination, language, pii
from monthstar.llm.tables import held_out
from tests.llm.cases import extended
from tests.llm.test_queries import plain_fingerprint

FILLER = "one of these words is here and there to fill a line of text"


def rows():
    words = FILLER.split()
    docs = [(i, " ".join(words[(i * k + k // 3) % len(words)] + str(i) for k in range(40)), "en") for i in range(12)]
    docs += [(20, docs[3][1], "en"), (21, docs[3][1].upper(), "en"), (22, "1234 5678 !!!", "en"), (23, None, "en")]
    passage = " ".join(f"secret{k}" for k in range(20))
    docs += [(24, "before " + passage + " after", "en"), (25, "write to a.b@c.example now " + docs[1][1], "en")]
    return [(i, t, lang, "s", len(t or "")) for i, t, lang in docs], passage


@pytest.fixture
def tables(spark, tmp_path):
    docs, passage = rows()
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), docs, passage


@pytest.mark.parametrize("lang", [None, "en"])
def test_documents_stay_where_no_profile_can_be_learned(spark, lang):
    docs = [(i, t, lang) for i, t in ((1, "a clean text"), (2, None), (3, "12 !"), (4, "漢字"))]
    given = spark.createDataFrame(docs, "doc_id long, text string, lang string").where(held_out() | F.lit(lang is None))
    got = corpus_pipeline.identify_language(spark, given, "").collect()
    assert [r["doc_id"] for r in got] == [r["doc_id"] for r in given.collect() if r["doc_id"] in (1, 4)]


def test_pipeline_equals_a_plain_run(spark, tables):
    sf_dir, docs, passage = tables
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    profiles = language.learn(given.where(~held_out()))
    left = [d for d in docs if language.classify(d[1], profiles)[0] != "und"]
    assert {22, 23}.isdisjoint(d[0] for d in left)
    kept, prints = [], {d[0]: plain_fingerprint(d[1]) for d in left}
    label = {d[0]: d[0] for d in left}
    for _ in left:
        for a in label:
            for b in label:
                if (prints[a] ^ prints[b]).bit_count() <= 3:
                    label[a] = min(label[a], label[b])
    left = [d for d in left if label[d[0]] == d[0]]
    windows = {" ".join(passage.split()[k : k + 13]) for k in range(8)}
    for d in left:
        text = " ".join(re.findall("[a-z0-9]+", d[1].lower()))
        if not any(w in text for w in windows):
            kept.append((d[0], pii.redact(d[1], pii.find(d[1], pii.train())[1])))
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["decoded"]) for r in got) == sorted(kept)
    assert all(r["n_tokens"] == len(r["ids"]) > 0 for r in got)
    assert {20, 21, 24}.isdisjoint(r["doc_id"] for r in got)
    assert any("[EMAIL]" in r["decoded"] for r in got)


def test_stages_keep_columns_and_take_odd_rows(spark, tables):
    sf_dir, *_ = tables
    docs = extended(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for given in (docs, docs.limit(0)):
            out = stage(spark, given, sf_dir)
            assert out.dtypes == docs.dtypes
            out.collect()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count()


def test_stage_names_and_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_near_dedup", "benchmark_decontamination", "pii", "byte_bpe"
    ]
    assert contamination.WINDOW_WORDS == 13
    assert bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
