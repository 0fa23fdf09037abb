"""Secrets in text: fixed patterns, and strings that a tokenizer cannot shorten.

A vocabulary learned on real text holds long pieces of words and of code, so random
strings fall apart into short tokens. Runs of key characters with few characters per
token are reported, after known digests (hexadecimal of a digest's length, UUIDs) and
identifiers (words and numbers joined by separators) have been set aside.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import accumulate

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from monthstar.llm.tables import kind_of, mapped, texts

#: Kinds in the order of results; the last is the token-efficiency test's.
KINDS = ("assign", "access", "hex", "random")
#: Least characters of a run that is tested, and the characters per token below which it is random.
LEAST_CHARS = 20
CHARS_PER_TOKEN = 2.2

# The patterns of the contract. Letters match in either case where the contract says so.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}+")

_RUN = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST_CHARS},}}+")
#: Lengths of hexadecimal digests: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGEST_CHARS = (32, 40, 56, 64, 96, 128)
_HEX_ONLY = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
#: The longest pieces of a run of one kind: capitals, small letters, digits, separators.
_PIECES = re.compile(r"[A-Z]+|[a-z]+|[0-9]+|[_/+=-]+")

Span = tuple[str, int, int]


@cache
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by start and kind."""
    found: list[Span] = []
    lowered = text.lower()
    if any(word in lowered for word in _ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=_order)


def _order(span: Span):
    return span[1], KINDS.index(span[0]), span[2]


def is_identifier(run: str) -> bool:
    """Words (capitalised, upper or lower) of two letters or more and numbers, with separators between some.

    A single letter is a word only where no letter or digit follows, and only a
    number at the very start may have a letter behind it. Every piece is looked
    at once, with the one behind it.
    """
    pieces = _PIECES.findall(run)
    if not pieces or pieces[0][0] in "_/+=-":
        return False
    for k, (piece, behind) in enumerate(zip(pieces, [*pieces[1:], "-"])):
        if piece.isdigit():
            if k and behind.isalpha():
                return False
        elif piece.isalpha() and len(piece) == 1 and behind.isalnum():
            # A capital may begin a word of small letters.
            if not (piece.isupper() and behind.islower() and len(behind) > 1):
                return False
    return True


def is_cased_words(run: str) -> bool:
    """Letters that case cuts into two words or more, each of three small letters (a capital before them) or three capitals."""
    pieces = _PIECES.findall(run)
    words = 0
    for k, piece in enumerate(pieces):
        last = k + 1 == len(pieces)
        if piece.islower():
            if len(piece) < 3:
                return False
            words += 1
            continue
        # The last capital before small letters is theirs.
        capitals = len(piece) if last else len(piece) - 1
        if capitals in (1, 2):
            return False
        words += min(2, capitals // 3)
    return words > 1


def set_aside(run: str) -> bool:
    """Known digests and identifiers, which are no secrets though they may look random.

    Runs of letters only are set aside where case splits them into words; any other is left to the tokens.
    """
    if _HEX_ONLY.fullmatch(run) and len(run) in DIGEST_CHARS or _UUID.fullmatch(run):
        return True
    letters = sum(c.isalpha() for c in run)
    if letters == len(run):
        return not run.isupper() and is_cased_words(run)
    return letters == 0 or is_identifier(run)


def random_spans(text: str, encode, base: list[Span]) -> list[Span]:
    """Runs with few characters per token that overlap no base span."""
    out = []
    starts = [a for _, a, _ in base]
    reach = list(accumulate((b for _, _, b in base), max))
    for m in _RUN.finditer(text):
        run = m[0]
        before = bisect_left(starts, m.end())
        if before and reach[before - 1] > m.start() or set_aside(run):
            continue
        if len(run) < CHARS_PER_TOKEN * len(encode(run)):
            out.append(("random", *m.span()))
    return out


def find(text: str | None, encode) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans; both by start and then kind."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, sorted(base + random_spans(text, encode, base), key=_order)


def scan(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, base, spans)`` of every row, both ``array<struct<kind,start,end>>`` in code points, end exclusive.

    ``vocabulary`` is a rank file that every executor has under this path. Null
    and empty texts have no spans. Repeated rows and null ids keep one result row
    each, other columns are not read. Texts are scanned whole, in linear time.
    Spans that start together stand in the order of their kinds.
    """
    kind = "array<struct<kind:string,start:int,end:int>>"
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def rows(found: list[list[Span]]) -> pa.Array:
        return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in found], spans_type)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(vocabulary, pattern).encode_ordinary
        for ids, values in texts(batches, id_col, text_col):
            found = [find(text, encode) for text in values]
            yield pa.RecordBatch.from_arrays(
                [ids, rows([f[0] for f in found]), rows([f[1] for f in found])], names=[id_col, "base", "spans"]
            )

    return docs.select(id_col, text_col).transform(
        mapped,
        run, f"`{id_col}` {kind_of(docs, id_col)}, base {kind}, spans {kind}"
    )
