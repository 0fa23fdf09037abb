"""Language identification by rank-order profiles of letter n-grams.

A profile lists the most frequent n-grams of a language, ranked. A document's own
most frequent n-grams are ranked likewise; each lies out of place by the difference
of its two ranks, or by the length of the profile where the profile lacks it. The
language of least total distance is predicted.

N-grams are of one to three characters within a word, the word's ends marked. They
are held as integers, 21 bits a character, so that their order is that of the texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthstar.llm.tables import kind_of, mapped, texts

#: N-grams of a profile, and of a document, that are ranked.
PROFILE_GRAMS = 300
#: Characters of the longest n-gram (three fit into 63 bits).
LONGEST = 3
#: Predicted for texts that are null or hold no letter.
UNDETERMINED = "und"
#: Distinct n-grams that a learning task holds before it hands on its counts.
HELD_GRAMS = 2_000_000
_END = ord("_")

Profiles = dict[str, tuple[np.ndarray, np.ndarray]]


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of the lower-cased words of a text, ascending, and their counts."""
    none = np.empty(0, np.int64)
    if not text:
        return none, none
    chars = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[chars]
    if not letter.any():
        return none, none
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[:-1] |= letter[1:]
    letter = letter[kept]
    chars = np.where(letter, chars[kept], _END).astype(np.int64)
    # A kept place that is no letter ends a word, or begins one, or both.
    one = chars[letter] << 42
    two = ((chars[:-1] << 42) | (chars[1:] << 21))[letter[:-1] | letter[1:]]
    three = ((chars[:-2] << 42) | (chars[1:-1] << 21) | chars[2:])[letter[1:-1]]
    found = np.sort(np.concatenate([one, two, three]))
    starts = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
    return found[starts], np.diff(np.r_[starts, len(found)])


def most_frequent(codes: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` most frequent n-grams by rank; among equal counts the smaller first."""
    return codes[np.lexsort((codes, -counts))[:n]]


def learn(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", n: int = PROFILE_GRAMS
) -> Profiles:
    """Profiles from all rows of ``docs`` with a language: n-grams ascending, and the rank of each.

    Tasks count before the shuffle. The driver gets ``n`` n-grams for each language.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0
        for langs, values in texts(batches, lang_col, text_col):
            for lang, text in zip(langs.to_pylist(), values):
                codes, counts = grams(text)
                held.setdefault(lang, []).append((codes, counts))
                size += len(codes)
            if size > HELD_GRAMS:
                held = {lang: [_summed(parts)] for lang, parts in held.items()}
                size = sum(len(parts[0][0]) for parts in held.values())
                if size > HELD_GRAMS // 2:
                    yield from _counted(held)
                    held, size = {}, 0
        yield from _counted(held)

    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counted = (
        labelled.select(F.col(lang_col).cast("string").alias(lang_col), text_col)
        .transform(mapped, run, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counted.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < n)
    ranked: dict[str, list[tuple[int, int]]] = {}
    for row in top.select("lang", "gram", "rank").collect():
        ranked.setdefault(row["lang"], []).append((row["gram"], row["rank"]))
    return {
        lang: tuple(np.array(column, np.int64) for column in zip(*sorted(found)))
        for lang, found in sorted(ranked.items())
    }


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    counts = np.bincount(place, weights=np.concatenate([n for _, n in parts]), minlength=len(codes))
    return codes, counts.astype(np.int64)


def _counted(held: dict) -> Iterator[pa.RecordBatch]:
    for lang, parts in held.items():
        codes, counts = _summed(parts)
        for start in range(0, len(codes), 50_000):
            some = codes[start : start + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some)), pa.array(some), pa.array(counts[start : start + 50_000])],
                names=["lang", "gram", "n"],
            )


def classify(text: str | None, profiles: Profiles, n: int = PROFILE_GRAMS) -> tuple[str, float]:
    """The language of least distance (the first by name among equals) and how near it is, 0 to 1.

    1 is a document ranked as the profile, 0 one that shares no n-gram with it.
    A text without a letter, or no profile at all, gives ``und`` and 0.
    """
    ranked = most_frequent(*grams(text), n)
    if not len(ranked) or not profiles:
        return UNDETERMINED, 0.0
    places = np.arange(len(ranked))
    best, least = UNDETERMINED, None
    for lang, (codes, ranks) in profiles.items():
        at = np.minimum(np.searchsorted(codes, ranked), len(codes) - 1)
        there = codes[at] == ranked
        distance = int(np.where(there, np.minimum(np.abs(ranks[at] - places), n), n).sum())
        if least is None or distance < least:
            best, least = lang, distance
    return best, 1.0 - least / (n * len(ranked))


def identify(
    docs: DataFrame,
    profiles: Profiles,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = PROFILE_GRAMS,
) -> DataFrame:
    """``(id, lang_pred, score)`` of every row, from the whole text alone.

    Repeated rows and null ids keep one result row each; other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, values in texts(batches, id_col, text_col):
            found = [classify(text, profiles, n) for text in values]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([f[0] for f in found]), pa.array([f[1] for f in found], pa.float64())],
                names=[id_col, "lang_pred", "score"],
            )

    return docs.select(id_col, text_col).transform(
        mapped,
        run, f"`{id_col}` {kind_of(docs, id_col)}, lang_pred string, score double"
    )
