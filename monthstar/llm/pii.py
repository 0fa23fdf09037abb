"""Personal data in text: fixed patterns, and a semi-Markov conditional random field.

The patterns find e-mail and IP addresses, payment cards and phone numbers. The
field adds what they miss: written-out e-mail addresses, phone numbers without a
country code, social security numbers and IBANs. It scores whole candidate segments
(how digits and letters are grouped, check sums, the words before) and chooses
boundaries and kinds jointly by dynamic programming over segments of bounded
length. It is trained here, on a small labelled table made from templates.

The field runs only around digits, at-signs and their written forms; elsewhere no
segment of its kinds can lie.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from monthstar.llm.tables import kind_of, mapped, texts

#: Kinds in the order of results; the field adds segments of the last three, and phones.
KINDS = ("email", "ip", "card", "phone", "ssn", "iban")
#: Kinds that the field tells apart.
FIELD_KINDS = ("email", "phone", "ssn", "iban")
#: Tokens of the longest segment, and of the longest one without a written-out address.
LONGEST, SHORT = 40, 14
#: A segment is added when its score exceeds that of no segment by so much (natural logarithm).
MARGIN = 2.0
#: Rounds and step of the training, and examples made from each template.
ROUNDS, STEP, EXAMPLES, PENALTY = 25, 0.2, 12, 1e-3

# The patterns of the contract, written so that no input makes them slow.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+@")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]")
_HOT = re.compile(r"[0-9]+|@|[\[(](?:at|AT|dot|DOT)[\])]")
#: Characters around hot places that the field sees, and between hot places of one region.
_BEFORE, _AFTER, _APART = 40, 40, 24
#: Characters by which the end of what the field sees is moved at most to reach white space.
_WORD = 256

_WORD_BEFORE, _WORD_AFTER = re.compile(r"(?<!\S)\S*\Z"), re.compile(r"\S*")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        value = int(d) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches: from the first character of the run before an at-sign that a domain follows."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        after = _DOMAIN.match(text, at + 1) if start < at else None
        if after:
            yield "email", start, after.end()
            done = after.end()
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by start and kind."""
    found = list(_emails(text))
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=_order)


def _order(span: Span):
    return span[1], KINDS.index(span[0]), span[2]


def _iban(chars: str) -> bool:
    if not (chars.isascii() and 15 <= len(chars) <= 34 and chars[:2].isalpha() and chars[2:4].isdigit()):
        return False
    return int("".join(str(int(c, 36)) for c in chars[4:] + chars[:4])) % 97 == 1


def _plain(token: str) -> bool:
    """Letters or digits of ASCII; other letters and digits are tokens of their own, which no entity holds."""
    return token.isascii() and token.isalnum()


def features(tokens: list[tuple[str, int, int]], text: str, first: int, end: int) -> list[str]:
    """Features of the segment ``tokens[first:end]`` as a whole; none where it cannot be an entity."""
    words = [t for t, _, _ in tokens[first:end]]
    if not (_plain(words[0]) or words[0] == "(") or not _plain(words[-1]):
        return []
    raw = text[tokens[first][1] : tokens[end - 1][2]]
    if "\n" in raw or any(w.isalnum() and not _plain(w) for w in words):
        return []
    numbers = [w for w in words if _plain(w) and w.isdigit()]
    digits = sum(map(len, numbers))
    letters = [w for w in words if _plain(w) and w.isalpha()]
    signs = "".join(sorted({w for w in words if not _plain(w)}))
    lowered = [w.lower() for w in letters]
    written = "at" in lowered and "dot" in lowered
    if digits < 7 and not written and "@" not in signs:
        return []
    shape = "-".join(str(len(n)) for n in numbers) if len(numbers) <= 8 else "many"
    out = [
        "any",
        f"digits={min(digits, 24)}",
        f"letters={min(len(letters), 5)}",
        f"signs={signs}",
        f"shape={shape if not letters else 'mixed'}",
        f"joined={' ' not in raw}",
        f"starts={words[0] if not words[0].isalnum() else 'd' if words[0].isdigit() else 'a'}",
        f"ends={'d' if words[-1].isdigit() else 'a'}",
    ]
    if written:
        bracketed = sum(f"{a}{w}{b}" in raw.lower() for w in ("at", "dot") for a, b in ("[]", "()"))
        tail = len(lowered) - 1 - max(k for k, w in enumerate(lowered) if w == "dot")
        out += [f"written={min(bracketed, 2)}", f"head={min(lowered.index('at'), 3)}", f"tail={min(tail, 2)}"]
        if [t.lower() for t, _, _ in tokens[end : end + 3]] in (["[", "dot", "]"], ["(", "dot", ")"]):
            out.append("goes_on")
    if letters and len(letters[0]) == 2 and letters[0].isupper():
        out.append(f"iban={_iban(''.join(filter(_plain, words)))}")
    if first:
        before = tokens[first - 1][0]
        before = tokens[first - 2][0] if before in ":=#.-" and first > 1 else before
        out.append(f"before={before.lower() if before.isalpha() else 'd' if before.isdigit() else before}")
        if tokens[first - 1][2] == tokens[first][1]:
            out.append(f"touches={'a' if tokens[first - 1][0].isalnum() else tokens[first - 1][0]}")
    if end < len(tokens) and tokens[end - 1][2] == tokens[end][1]:
        out.append(f"followed={'a' if tokens[end][0].isalnum() else tokens[end][0]}")
    return out


def _segments(text: str, tokens: list[tuple[str, int, int]], taken=lambda a, b: False) -> dict[int, list]:
    """Candidate segments by their end: ``(first, features)``."""
    by_end: dict[int, list] = defaultdict(list)
    dots = any(a[0] in "[(" and b[0].lower() == "dot" for a, b in zip(tokens, tokens[1:]))
    for first in range(len(tokens)):
        if not _plain(tokens[first][0]) and tokens[first][0] != "(":
            continue
        for end in range(first + 1, min(len(tokens), first + (LONGEST if dots else SHORT)) + 1):
            word = tokens[end - 1][0]
            if word.isalnum() and not _plain(word) or end - 1 > first and "\n" in text[tokens[end - 2][2] : tokens[end - 1][1]]:
                break
            if taken(tokens[first][1], tokens[end - 1][2]):
                # So is every longer segment.
                break
            if not _plain(word):
                continue
            found = features(tokens, text, first, end)
            if found:
                by_end[end].append((first, found))
    return by_end


Weights = dict[tuple[str, str], float]


def _score(weights: Weights, kind: str, found: list[str]) -> float:
    return sum(weights.get((kind, f), 0.0) for f in found)


def best_segments(weights: Weights, n: int, by_end: dict[int, list]) -> list[tuple[str, int, int]]:
    """The segments of the best reading of ``n`` tokens; a token outside segments scores zero."""
    best = [0.0] * (n + 1)
    back: list[tuple[str, int] | None] = [None] * (n + 1)
    for end in range(1, n + 1):
        best[end] = best[end - 1]
        for first, found in by_end.get(end, ()):
            for kind in FIELD_KINDS:
                score = best[first] + _score(weights, kind, found) - MARGIN
                if score > best[end]:
                    best[end], back[end] = score, (kind, first)
    out, at = [], n
    while at:
        if back[at] is None:
            at -= 1
        else:
            kind, first = back[at]
            out.append((kind, first, at))
            at = first
    return out[::-1]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def _gradient(weights: Weights, n: int, by_end: dict[int, list], gold: set) -> dict[tuple[str, str], float]:
    """Gold minus expected feature counts, by forward and backward sums over all segmentations."""
    scores = {
        (kind, first, end): _score(weights, kind, found)
        for end, segments in by_end.items()
        for first, found in segments
        for kind in FIELD_KINDS
    }
    ending, starting = defaultdict(list), defaultdict(list)
    for segment in scores:
        ending[segment[2]].append(segment)
        starting[segment[1]].append(segment)
    ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
    for end in range(1, n + 1):
        ahead[end] = _log_sum([ahead[end - 1], *(ahead[s[1]] + scores[s] for s in ending[end])])
    for first in range(n - 1, -1, -1):
        behind[first] = _log_sum([behind[first + 1], *(behind[s[2]] + scores[s] for s in starting[first])])
    out: dict[tuple[str, str], float] = defaultdict(float)
    for end, segments in by_end.items():
        for first, found in segments:
            for kind in FIELD_KINDS:
                segment = (kind, first, end)
                p = math.exp(ahead[first] + scores[segment] + behind[end] - ahead[n])
                step = (segment in gold) - p
                if abs(step) > 1e-6:
                    for f in found:
                        out[kind, f] += step
    return out


#: The labelled table: text around one entity, its kind, and forms of it (# a digit, ? a letter).
TEMPLATES = (
    ("call {} today", "phone", ("(###) ###-####", "###-###-####", "### ### ####", "###.###.####")),
    ("phone: {} or write", "phone", ("(###) ###-####", "###-###-####", "0## ### ## ##")),
    ("tel {} , office", "phone", ("(0##) #######", "0##/#######", "### ### ####")),
    ("her ssn is {} on file", "ssn", ("###-##-####",)),
    ("SSN: {} .", "ssn", ("###-##-####", "### ## ####")),
    ("born there , {} , moved", "ssn", ("###-##-####",)),
    ("write to {} soon", "email", ("????? [at] ?????? [dot] com", "???? (at) ?????? (dot) org", "??????[at]?????[dot]net")),
    ("mail {} please", "email", ("?????? [at] ????? [dot] com", "????(at)??????(dot)org", "??? [at] ???? [dot] de")),
    ("reach us at : {} or by post", "email", ("????? (at) ??????? (dot) com", "???? [at] ????? [dot] net")),
    ("contact {} .", "email", ("??????.??? [at] ????? [dot] com", "??? (at) ????? (dot) de")),
    ("mail {} today", "email", ("?????.???? [at] ???? [dot] ??? [dot] ?? [dot] ??", "????.?.????? [at] ????.????.??? [dot] edu")),
    ("write to {} or call", "email", ("???? (at) ???? (dot) ??? (dot) org", "?????[at]????[dot]???[dot]??")),
    ("transfer to {} now", "iban", ("IBAN",)),
    ("iban: {} thanks", "iban", ("IBAN",)),
    ("order {} was sent", None, ("########", "##-####-##", "##########", "################", "###.###.###")),
    ("on {} they met", None, ("####-##-##", "##/##/####", "##.##.####", "#### #### ####")),
    ("version {} of it", None, ("#.##.####", "##.##.##.##", "####.####", "###-####")),
    ("token = {} here", None, ("a#b##c###d####", "##e#f####a##", "??##??##??##", "#### #### #### ####")),
    ("meet at the dot {} of ink", None, ("????", "?????? ????", "at ?? dot ???")),
    ("total {} units and", None, ("# ### ###", "##,###,###", "#.###.###,##", "################", "#######")),
)


def _examples() -> Iterator[tuple[str, Span | None]]:
    rng = random.Random(11)

    def fill(form: str) -> str:
        if form == "IBAN":
            body = "".join(rng.choice("0123456789") for _ in range(18))
            check = 98 - int(body + "131400") % 97
            plain = f"DE{check:02d}{body}"
            return plain if rng.random() < 0.5 else " ".join(plain[i : i + 4] for i in range(0, 22, 4))
        put = {"#": "0123456789", "?": "abcdefghijklmnopqrstuvwxyz"}
        return "".join(rng.choice(put[c]) if c in put else c for c in form)

    for around, kind, forms in TEMPLATES:
        for form in forms:
            for _ in range(max(1, EXAMPLES // len(forms))):
                entity = fill(form)
                start = around.index("{}")
                yield around.format(entity), kind and (kind, start, start + len(entity))


def _tokens(text: str, start: int = 0, end: int | None = None) -> list[tuple[str, int, int]]:
    return [(m[0], *m.span()) for m in _TOKEN.finditer(text, start, len(text) if end is None else end)]


@cache
def train() -> Weights:
    """Weights that maximise the likelihood of the labelled table, by gradient steps in its order."""
    table = []
    for text, span in _examples():
        tokens = _tokens(text)
        gold = set()
        if span:
            inside = [k for k, (_, a, b) in enumerate(tokens) if a >= span[1] and b <= span[2]]
            first = inside[0]
            last = max(k for k in inside if tokens[k][0].isalnum())
            gold = {(span[0], first, last + 1)}
        table.append((len(tokens), _segments(text, tokens), gold))
    weights: Weights = {}
    rng = random.Random(7)
    for _ in range(ROUNDS):
        rng.shuffle(table)
        for n, by_end, gold in table:
            if not by_end:
                continue
            for key, step in _gradient(weights, n, by_end, gold).items():
                old = weights.get(key, 0.0)
                weights[key] = old + STEP * (step - PENALTY * old)
    return weights


def _regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches from the first to the last of hot places that are near each other."""
    start = end = None
    for m in _HOT.finditer(text):
        if end is not None and m.start() - end <= _APART:
            end = m.end()
            continue
        if end is not None:
            yield start, end
        start, end = m.span()
    if end is not None:
        yield start, end


def field_spans(text: str, weights: Weights, base: list[Span]) -> list[Span]:
    """Segments that the field adds; none overlaps a base span."""
    out: list[Span] = []
    starts = [a for _, a, _ in base]
    reach = list(accumulate((b for _, _, b in base), max))

    def taken(first: int, end: int) -> bool:
        """Whether a base span overlaps; base spans come by their start."""
        before = bisect_left(starts, end)
        return before > 0 and reach[before - 1] > first

    done = 0
    for start, end in _regions(text):
        hot = text[start:end]
        if sum(c.isdigit() for c in hot) < 7 and "@" not in hot and "(" not in hot and "[" not in hot:
            continue
        low, high = max(0, start - _BEFORE), min(len(text), end + _AFTER)
        low -= len(_WORD_BEFORE.search(text[max(0, low - _WORD) : low])[0])
        high = _WORD_AFTER.match(text, high, high + _WORD).end()
        low = max(done, low)
        tokens = _tokens(text, low, high)
        by_end = _segments(text, tokens, taken)
        for kind, first, last in best_segments(weights, len(tokens), by_end):
            out.append((kind, tokens[first][1], tokens[last - 1][2]))
            done = tokens[last - 1][2]
    return out


def find(text: str | None, weights: Weights) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans; both by start and then kind."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, sorted(base + field_spans(text, weights, base), key=_order)


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    if not spans:
        return text
    out, done = [], 0
    for kind, start, end in spans:
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, base, spans)`` of every row, both ``array<struct<kind,start,end>>`` in code points, end exclusive.

    Null and empty texts have no spans. Repeated rows and null ids keep one
    result row each, other columns are not read. Spans that start together stand
    in the order of their kinds. What the field adds is of ``LONGEST`` tokens at
    most, and of ``SHORT`` where no address is written out.
    """
    weights = train()
    kind = "array<struct<kind:string,start:int,end:int>>"
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def rows(found: list[list[Span]]) -> pa.Array:
        return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in found], spans_type)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, values in texts(batches, id_col, text_col):
            found = [find(text, weights) for text in values]
            yield pa.RecordBatch.from_arrays(
                [ids, rows([f[0] for f in found]), rows([f[1] for f in found])], names=[id_col, "base", "spans"]
            )

    return docs.select(id_col, text_col).transform(
        mapped,
        run, f"`{id_col}` {kind_of(docs, id_col)}, base {kind}, spans {kind}"
    )


def redacted(docs: DataFrame, text_col: str = "text", size_col: str | None = None) -> DataFrame:
    """All rows and columns of ``docs``, personal data replaced; ``size_col`` gets the new length."""
    weights = train()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            values = batch.column(at).to_pylist()
            clean = [redact(text, find(text, weights)[1]) for text in values]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(clean, batch.schema.field(at).type))
            if size_col is not None:
                size = batch.schema.get_field_index(size_col)
                field = batch.schema.field(size)
                old = batch.column(size).to_pylist()
                lengths = [o if c is v else len(c) for o, c, v in zip(old, clean, values)]
                batch = batch.set_column(size, field, pa.array(lengths, field.type))
            yield batch

    return docs.transform(mapped, run, docs.schema)
