"""Token shards: against the tokenizer library, plain arrays, and awkward tables."""

import uuid
import zlib
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from monthstar.llm import QUERIES, wavelet
from monthstar.llm.tables import shared_folder
from tests.llm import cases

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RNG = np.random.default_rng(12)


@cache
def reference():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture
def plain():
    return reference()


def folder(spark):
    return f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"


def opened(tokens, ends=None):
    ends = np.array([len(tokens)]) if ends is None else ends
    content = wavelet.build(pa.array(range(len(ends))), ends, np.asarray(tokens, np.uint32))
    return wavelet.Shard(lambda offset, size: content[offset : offset + size]), content


WORDS = st.text(st.sampled_from("aZ9é漢😀.,'!-_ \n\t\r\x0b\x0c\x1c\x85\xa0 　​ s"), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30), WORDS), min_size=1, max_size=8))
def test_encoder_equals_the_library(texts):
    plain = reference()
    texts = [t if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    ids, ends = wavelet.Encoder(VOCABULARY)(pa.array(texts, pa.string()))
    got = [part.tolist() for part in np.split(ids, ends[:-1])]
    assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_strings_of_special_tokens_are_text():
    ids, _ = wavelet.Encoder(VOCABULARY)(pa.array(["a <|endoftext|> b"]))
    assert 50256 not in ids.tolist() and len(ids) > 3


def test_forgetting_pieces_changes_nothing(monkeypatch, plain):
    monkeypatch.setattr(wavelet, "KNOWN_PIECES", 3)
    encode = wavelet.Encoder(VOCABULARY)
    wavelet.encoder.cache_clear()
    for text in ("one two three four", "one two five six", "one two three"):
        assert encode(pa.array([text]))[0].tolist() == plain.encode(text).ids


def test_a_piece_met_again_is_learned_once(monkeypatch, plain):
    monkeypatch.setattr(wavelet, "KNOWN_PIECES", 6)
    encode, learned = wavelet.Encoder(VOCABULARY), []
    learn = encode._learn
    monkeypatch.setattr(encode, "_learn", lambda pieces: learned.extend(pieces.to_pylist()) or learn(pieces))
    texts = ["x one two", "x one$$$ one,*** two_", *(f"x one new{k} other{k}" for k in range(9))]
    for text in texts:
        assert encode(pa.array([text]))[0].tolist() == plain.encode(text).ids
    assert learned.count(" one") == learned.count("x") == 1 and learned.count("$$$") == learned.count(",***") == 1
    assert len(encode.known) < 12


def test_words_spelled_for_the_model_equal_the_library(plain):
    letters = [chr(c) for c in range(0x21, 0x250)]
    text = "a " + " ".join("q" + a + b for a, b in zip(letters, letters[1:] + letters[:1]))
    assert wavelet.word_tokenizer(VOCABULARY) is not None
    assert wavelet.Encoder(VOCABULARY)(pa.array([text]))[0].tolist() == plain.encode(text).ids


@pytest.mark.parametrize("n, high", [(0, 2), (1, 1), (1, 50257), (1000, 1), (70_000, 50257), (32768, 5), (40_001, 2)])
def test_questions_equal_plain_arrays(n, high):
    tokens = RNG.integers(0, high, n) if high > 2 else np.repeat([0, 1], [n - n // 3, n // 3])
    tokens = np.minimum(tokens, high - 1)
    shard, _ = opened(tokens)
    assert (shard.tokens() == tokens).all()
    places = RNG.integers(0, n, 200) if n else np.empty(0, int)
    assert (shard.access(places) == tokens[places]).all()
    for token in {0, 1, high - 1, high + 7, -1, *(tokens[:3].tolist())}:
        for first, end in ((0, n), (n // 3, n // 2), (n, n), (0, min(1, n))):
            want = first + np.flatnonzero(tokens[first:end] == token)
            assert shard.count(token, first, end) == len(want)
            assert (shard.occurrences(token, first, end) == want).all()


def test_a_question_reads_few_chunks_of_a_compressed_file():
    tokens = RNG.zipf(1.3, 1 << 20) % 50000
    content = wavelet.build(pa.array([0]), np.array([len(tokens)]), tokens)
    assert len(content) < 2 * len(tokens)
    read = []

    def some(offset, size):
        read.append(size)
        return content[offset : offset + size]

    shard = wavelet.Shard(some)
    assert shard.access(np.array([777_777]))[0] == tokens[777_777]
    assert sum(read) < len(content) / 10
    with pytest.raises(ValueError):
        wavelet.Shard(lambda offset, size: b"x" * size)


def test_awkward_documents(spark, plain):
    docs = cases.extended(spark)
    path = folder(spark)
    listed = wavelet.write(docs, path, VOCABULARY, shard_tokens=50).collect()
    assert [row["shard"] for row in sorted(listed, key=lambda r: r["start"])] == list(range(len(listed)))
    assert len(listed) > 2
    got = sorted(wavelet.read(spark, path).collect(), key=lambda r: r["start"])
    texts = {row[0]: row[1] or "" for row in cases.ROWS}
    assert [r["id"] for r in got] == sorted((row[0] for row in cases.ROWS), key=lambda i: -1 if i is None else i)
    at = 0
    for row in got:
        want = [*plain.encode(texts[row["id"]], add_special_tokens=False).ids, 0]
        assert (row["start"], row["n_tokens"]) == (at, len(want))
        assert np.frombuffer(row["ids"], "<u4").tolist() == want
        at += len(want)


def test_empty_table(spark):
    path = folder(spark)
    docs = cases.documents(spark).limit(0)
    assert wavelet.write(docs, path, VOCABULARY).collect() == []
    assert wavelet.read(spark, path).collect() == []
    assert wavelet.counts(spark, path, [1]).collect() == []


def test_counts_occurrences_and_lookup(spark):
    path = folder(spark)
    docs = spark.createDataFrame([(i, f"alpha beta {i % 7} alpha\n\n" * (i % 5)) for i in range(200)], "doc_id long, text string")
    wavelet.write(docs.repartition(5), path, VOCABULARY, shard_tokens=300)
    rows = sorted(wavelet.read(spark, path).collect(), key=lambda r: r["start"])
    every = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in rows])
    asked = [0, int(every[1]), int(every[2]), 50_000]
    got = {r["token"]: r["n"] for r in wavelet.counts(spark, path, asked).collect()}
    assert got == {t: int((every == t).sum()) for t in asked}
    found = wavelet.occurrences(spark, path, asked[:2]).collect()
    assert sorted((r["token"], r["position"]) for r in found) == sorted(
        (t, int(p)) for t in asked[:2] for p in np.flatnonzero(every == t)
    )
    starts = {r["id"]: r["start"] for r in rows}
    assert all(starts[r["id"]] + r["place"] == r["position"] for r in found)
    positions = spark.createDataFrame([(int(p),) for p in (0, 5, 5, len(every) - 1, len(every), -3)], "position long")
    got = sorted(map(tuple, wavelet.lookup(positions, path).collect()))
    assert got == sorted((p, int(every[p])) for p in (0, 5, 5, len(every) - 1))


def test_files_that_no_ended_task_listed_are_not_read(spark):
    path = folder(spark)
    docs = spark.createDataFrame([(1, "one"), (2, "two")], "doc_id long, text string")
    wavelet.write(docs, path, VOCABULARY)
    before = wavelet.read(spark, path).collect()
    with open(f"{path.removeprefix('file:')}/stray.tokens", "wb") as stray:
        stray.write(b"left by a lost task")
    assert wavelet.read(spark, path).collect() == before


def test_query(spark, plain):
    import pyarrow.parquet as pq

    docs = sorted(
        ((d["doc_id"], d["text"] or "") for d in pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist())
    )
    got = {r["doc_id"]: r for r in QUERIES["op12_token_shards"](spark, "/root/testdata/sf0.001").collect()}
    at = 0
    for doc_id, text in docs:
        ids = [*plain.encode(text, add_special_tokens=False).ids, 0]
        row = got[doc_id]
        assert (row["start"], row["n_tokens"]) == (at, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert len(got) == len(docs)
