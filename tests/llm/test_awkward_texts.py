"""Long and awkward texts: no scan may hang or crash, and faster forms equal the plain patterns."""

import random
import re
import string
import time

import public_tokenizers
import pytest

from monthstar.llm import pii, secrets, simhash
from tests.llm.test_queries import PII, SECRETS, plain_matches

# The shapes that runs set aside have, as patterns; these are too slow for long runs.
IDENTIFIER = re.compile(
    r"(?:[A-Z]?[a-z]{2,}|[A-Z]{2,}|[0-9]+|[A-Za-z](?![A-Za-z0-9]))"
    r"(?:[_/+=-]*(?:[A-Z]?[a-z]{2,}|[A-Z]{2,}|[0-9]+(?![A-Za-z])|[A-Za-z](?![A-Za-z0-9])))*[_/+=-]*"
)
CASED_WORDS = re.compile(r"(?:[A-Z]?[a-z]{3,}|[A-Z]{3,})(?:[A-Z][a-z]{3,}|[A-Z]{3,})+")


def test_identifiers_equal_the_pattern():
    rng = random.Random(1)
    for _ in range(60_000):
        run = "".join(rng.choice("abAB12_-") for _ in range(rng.randrange(1, 9)))
        assert secrets.is_identifier(run) == bool(IDENTIFIER.fullmatch(run)), run


def test_cased_words_equal_the_pattern():
    rng = random.Random(2)
    for _ in range(60_000):
        run = "".join(rng.choice(["a", "A", "abc", "ABC", "Abcd"]) for _ in range(rng.randrange(1, 6)))
        if not run.isupper():
            assert secrets.is_cased_words(run) == bool(CASED_WORDS.fullmatch(run)), run


N = 1_000_000


@pytest.mark.parametrize(
    "text",
    [
        "A" * N + "1a",
        "abc" + "A" * N + "b",
        "config" + "a" * N + "_v2x",
        ("A" * 36 + "4fug4AtAnNIbgBTM0h") * (N // 54),
        "Ab1" * (N // 3),
        "aB_" * (N // 3),
        ("a" * 40 + " password=abcdefgh12 ") * (N // 60),
    ],
    ids=lambda text: text[:12],
)
def test_a_megabyte_is_scanned_for_secrets(text):
    # The tokens of one endless word are the vocabulary's matter, not the scan's.
    began = time.process_time()
    secrets.find(text, lambda run: run[::3])
    assert time.process_time() - began < 5


@pytest.mark.parametrize("text", ["12.34.56.78 " * (N // 12), "a@b.co " * (N // 7), "4111 1111 1111 1111, " * (N // 21)])
def test_a_megabyte_is_scanned_for_personal_data(text):
    began = time.process_time()
    base, spans = pii.find(text, pii.train())
    assert len(base) > 10_000 and len(spans) >= len(base)
    assert time.process_time() - began < 30


def test_parts_of_many_zeros_are_an_address():
    text = "0" * 5000 + ".1.2.3 and 1." + "0" * 9000 + "255.0.0 and 1.2.3." + "0" * 5000 + "256"
    assert [kind for kind, *_ in pii.base_spans(text)] == ["ip", "ip"]
    assert pii.base_spans("0.0.0.0") == [("ip", 0, 7)]


@pytest.mark.parametrize("find, kinds", [(pii.base_spans, PII), (secrets.base_spans, SECRETS)])
def test_base_spans_equal_the_patterns_on_their_own_characters(find, kinds):
    rng = random.Random(3)
    pools = ["0125. -+()", "a@b.c-%", "AKIA0Z", "0af ", "password=:\"' token_key", "0123456789 -", string.ascii_letters]
    for _ in range(4000):
        text = "".join("".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(1, 30))) for _ in range(4))
        assert [f"{k}:{a}:{b}" for k, a, b in find(text)] == plain_matches(text, kinds), text


def test_random_strings_beside_base_spans():
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encode = secrets.encoding(vocabulary, public_tokenizers.PATTERN).encode_ordinary
    key = "xK9qZ3vT7bLw2Rf8HdPs"
    text = f"see {key} and token={key} and {key}"
    base, spans = secrets.find(text, encode)
    assert [k for k, *_ in base] == ["assign"]
    assert [k for k, *_ in spans] == ["random", "assign", "random"]


def brute(weights, n, by_end):
    """The best total over all ways to choose segments that do not overlap."""
    best = 0.0
    todo = [(0, 0.0)]
    while todo:
        at, total = todo.pop()
        best = max(best, total)
        for end in range(at + 1, n + 1):
            for first, found in by_end.get(end, ()):
                if first >= at:
                    for kind in pii.FIELD_KINDS:
                        todo.append((end, total + pii._score(weights, kind, found) - pii.MARGIN))
    return best


def test_segments_are_the_best_of_all():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randrange(1, 6)
        names = [f"f{k}" for k in range(6)]
        weights = {(kind, f): rng.uniform(-2, 4) for kind in pii.FIELD_KINDS for f in names}
        by_end = {}
        for first in range(n):
            for end in range(first + 1, n + 1):
                if rng.random() < 0.5:
                    by_end.setdefault(end, []).append((first, rng.sample(names, 2)))
        chosen = pii.best_segments(weights, n, by_end)
        taken = sorted((first, end) for _, first, end in chosen)
        assert all(a[1] <= b[0] for a, b in zip(taken, taken[1:]))
        found = {(first, end): f for end, rows in by_end.items() for first, f in rows}
        total = sum(pii._score(weights, kind, found[first, end]) - pii.MARGIN for kind, first, end in chosen)
        assert abs(total - brute(weights, n, by_end)) < 1e-9


A, B = "the first text has these words in it", "quite another one that shares no words at all"


def firsts(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark int, key string").repartition(parts)
    return sorted(map(str, simhash.first_of_each(docs).collect()))


def texts(rows):
    return sorted(re.findall(r"doc_id=(\w+), text='(.)", row)[0] for row in rows)


def test_documents_that_share_an_id_but_no_text_stay(spark):
    rows = [(7, A, 1, "k"), (7, B, 2, "k")]
    assert texts(firsts(spark, rows)) == [("7", "q"), ("7", "t")]


def test_one_row_of_each_group_stays_however_rows_are_dealt(spark):
    rows = [(7, A, 1, "k"), (7, B, 2, "k"), (2, B, 3, "k"), (9, A, 4, "k"), (7, A, 1, "k"), (7, A, 5, "k")]
    found = {tuple(firsts(spark, rows, parts)) for parts in (1, 2, 5)}
    assert len(found) == 1
    assert texts(found.pop()) == [("2", "q"), ("7", "t")]


def test_rows_without_an_id_come_last(spark):
    rows = [(None, A, 1, "k"), (None, A, 1, "k"), (None, B, 1, "k"), (4, B, 1, "k")]
    assert texts(firsts(spark, rows)) == [("4", "q"), ("None", "t")]


def test_a_query_leaves_no_table_that_nothing_reads(spark, monkeypatch, tmp_path):
    from monthstar.llm import components, repeats, tables

    monkeypatch.setattr(tables, "shared_folder", lambda spark: str(tmp_path))
    links = spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long")
    found = components.components(links)
    assert {row["component"] for row in found.collect()} == {0} and found.count() == 41
    assert len(list(tmp_path.glob("*/links"))) == 1
    docs = spark.createDataFrame([(k, " ".join(f"w{j}" for j in range(50))) for k in range(3)], "doc_id long, text string")
    out = repeats.without_repeats(repeats.covered(docs))
    assert [row["n_removed"] for row in out.collect()] == [50] * 3
    assert not list(tmp_path.glob("*/anchors"))
    assert spark.conf.get(tables.CLEANUP_SETTING) == "false"
