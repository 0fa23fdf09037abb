"""Benchmark passages in documents, found by Wu-Manber search over words.

Every benchmark item gives its windows of consecutive words. Windows of one length
form one search: a table over hashed blocks of two words says how far the search
may jump without passing a window, a block that ends a window selects a bucket of
windows, and direct comparison of all words confirms the occurrence. Text is one
number for each word; words that the benchmark lacks are number 0, which no window
holds. The benchmark is the stated query set: it is broadcast in blocks of bounded
size, and every document is searched for each block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthstar.llm.tables import SLICE_ROWS, kind_of, mapped, stored, texts

#: Words of a window; an item of fewer words is one window.
WINDOW_WORDS = 13
#: A document is contaminated when hit words are at least one in so many.
HIT_SHARE = 20
#: Pairs of window and item that are broadcast at once, about.
BLOCK_PAIRS = 100_000
#: Slots of a shift table, as a power of two.
SHIFT_BITS = 20
#: Bytes of words: digits, letters a-z, and all beyond ASCII; A-Z is lowered, the rest separates.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


def windows(text: bytes | None, length: int = WINDOW_WORDS) -> set[bytes]:
    """The windows of an item, words joined by a space."""
    found = words(text)
    size = min(length, len(found))
    return {b" ".join(found[i : i + size]) for i in range(len(found) - size + 1)} if size else set()


def contaminated(n_words: Column, n_hit: Column) -> Column:
    """The contract's rule: something is hit, and at least one word in ``HIT_SHARE``."""
    return (n_hit > 0) & (n_hit * HIT_SHARE >= n_words)


class WuManber:
    """A search for word windows of one length."""

    def __init__(self, patterns: list[tuple[int, ...]]):
        self.length = len(patterns[0])
        self.block = min(2, self.length)
        self.shift = np.full(1 << SHIFT_BITS, self.length - self.block + 1, dtype=np.int16)
        self.buckets: dict[int, list[tuple[list[int], int]]] = {}
        table = np.array(patterns, dtype=np.int64)
        hashes = self.hashes(table)
        for end in range(hashes.shape[1]):
            np.minimum.at(self.shift, hashes[:, end], hashes.shape[1] - 1 - end)
        for k, suffix in enumerate(hashes[:, -1].tolist()):
            self.buckets.setdefault(suffix, []).append((list(patterns[k]), k))

    def hashes(self, numbers: np.ndarray) -> np.ndarray:
        """Slots of the blocks along the last axis."""
        if self.block == 1:
            mixed = numbers * 0x9E3779B1
        else:
            mixed = numbers[..., :-1] * 0x9E3779B1 + numbers[..., 1:] * 0x85EBCA6B
        return ((mixed ^ (mixed >> 17)) & ((1 << SHIFT_BITS) - 1)).astype(np.int64)

    def search(self, numbers: list[int], array: np.ndarray) -> list[tuple[int, int]]:
        """(first word, pattern) of every occurrence."""
        found: list[tuple[int, int]] = []
        if len(numbers) < self.length:
            return found
        slots = self.hashes(array)
        jumps = self.shift[slots].tolist()
        at, last, span = self.length - self.block, len(jumps), self.length
        while at < last:
            jump = jumps[at]
            if jump:
                at += jump
                continue
            first = at + self.block - span
            piece = numbers[first : first + span]
            for pattern, k in self.buckets.get(int(slots[at]), ()):
                if piece == pattern:
                    found.append((first, k))
            at += 1
        return found


class Benchmark:
    """Searches for a block of windows, one for each window length, and the items of each window."""

    def __init__(self, pairs: Iterable[tuple[bytes, str | None]]):
        items: dict[bytes, set[str | None]] = {}
        for window, item in pairs:
            items.setdefault(window, set()).add(item)
        self.number: dict[bytes, int] = {}
        by_length: dict[int, list[tuple[tuple[int, ...], set[str | None]]]] = {}
        for window, named in sorted(items.items(), key=lambda pair: pair[0]):
            numbers = tuple(
                self.number.setdefault(w, len(self.number) + 1) for w in window.split(b" ")
            )
            by_length.setdefault(len(numbers), []).append((numbers, named))
        self.searches = [
            (WuManber([numbers for numbers, _ in found]), [named for _, named in found])
            for _, found in sorted(by_length.items())
        ]

    def find(self, found_words: list[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Ranges of hit words (first, end) and the items whose windows occur."""
        get = self.number.get
        numbers = [get(w, 0) for w in found_words]
        array = np.array(numbers, dtype=np.int64)
        ranges: list[tuple[int, int]] = []
        items: set[str | None] = set()
        if array.any():
            for search, named in self.searches:
                for first, k in search.search(numbers, array):
                    ranges.append((first, first + search.length))
                    items |= named[k]
        return ranges, items


def merged(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same words in ranges that neither touch nor overlap."""
    out: list[list[int]] = []
    for first, end in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return [(a, b) for a, b in out]


def item_windows(items: DataFrame, id_col: str, text_col: str, length: int, unnamed: bool = False) -> DataFrame:
    """Distinct ``(window binary, item string)``; items without a word have none, those without an id if ``unnamed``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, values in texts(batches, "item", "text", as_bytes=True):
            for item, text in zip(ids.to_pylist(), values):
                found = sorted(windows(text, length))
                for start in range(0, len(found), 10_000):
                    part = found[start : start + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part, pa.binary()), pa.array([item] * len(part), pa.string())],
                        names=["window", "item"],
                    )

    searched = items if unnamed else items.where(F.col(id_col).isNotNull())
    return searched.select(F.col(id_col).cast("string"), text_col).toDF("item", "text").transform(mapped, run, "window binary, item string").distinct()


def blocks(
    items: DataFrame, id_col: str, text_col: str, length: int, block_pairs: int = BLOCK_PAIRS, unnamed: bool = False
) -> Iterator[Benchmark]:
    """The benchmark, a bounded number of pairs of window and item at a time; at least one block."""
    pairs = stored(item_windows(items, id_col, text_col, length, unnamed), "windows")
    n = max(1, -(-pairs.count() // block_pairs))
    for k in range(n):
        mine = pairs.where(F.pmod(F.xxhash64("window", "item"), F.lit(n)) == k)
        yield Benchmark((bytes(row["window"]), row["item"]) for row in mine.collect())


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    length: int = WINDOW_WORDS,
    block_pairs: int = BLOCK_PAIRS,
    unnamed: bool = False,
) -> DataFrame:
    """``(id, n_words, hits array<struct<first,end>>, items array<string>)`` of every row of ``docs``.

    ``hits`` are the word ranges inside occurrences, merged; ``items`` are the
    benchmark items with an occurring window, sorted. Benchmark items without an id
    are searched for if ``unnamed``; together they are one null, after the names. A null or empty text has
    no words. Repeated rows and null ids keep one result row each, other columns
    are not read. Without benchmark windows nothing is hit.
    """
    kind = kind_of(docs, id_col)
    hits_kind = "array<struct<first:int,end:int>>"
    state = docs.select(
        id_col, text_col, F.lit(None).cast(hits_kind), F.lit(None).cast("array<string>")
    ).toDF("id", "text", "hits", "items")
    searches = blocks(items, item_col, item_text_col, length, block_pairs, unnamed)
    block = next(searches)
    while True:
        following = next(searches, None)
        if following is None:
            break
        state = stored(_searched(state, block, kind, True), "hits")
        block = following
    out = _searched(state, block, kind, False)
    return out.withColumnRenamed("id", id_col)


def _searched(state: DataFrame, block: Benchmark, kind: str, keep_text: bool) -> DataFrame:
    spark = state.sparkSession
    sent = spark.sparkContext.broadcast(block)
    hits_type = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = sent.value.find
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                counts, hits, items = [], [], []
                for text, old_hits, old_items in zip(
                    part.column(1).cast(pa.binary()).to_pylist(),
                    part.column(2).to_pylist(),
                    part.column(3).to_pylist(),
                ):
                    found_words = words(text)
                    ranges, named = find(found_words)
                    ranges += [(h["first"], h["end"]) for h in old_hits or ()]
                    counts.append(len(found_words))
                    hits.append([{"first": a, "end": b} for a, b in merged(ranges)])
                    items.append(sorted(named.union(old_items or ()), key=lambda item: (item is None, item or "")))
                columns = {"id": part.column(0)}
                columns |= {"text": part.column(1)} if keep_text else {"n_words": pa.array(counts, pa.int64())}
                columns |= {"hits": pa.array(hits, hits_type), "items": pa.array(items, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    middle = "text string" if keep_text else "n_words long"
    return state.transform(
        mapped,
        run, f"id {kind}, {middle}, hits array<struct<first:int,end:int>>, items array<string>"
    )


def clean(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    length: int = WINDOW_WORDS,
    block_pairs: int = BLOCK_PAIRS,
    unnamed: bool = False,
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all their columns untouched and nothing shuffled.

    The blocks of the benchmark are searched for one after another; where there
    are several, the ranges hit so far go along with the rows.
    """
    mark = "__hits"
    while mark in docs.columns:
        mark += "_"
    state = docs.withColumn(mark, F.lit(None).cast("array<int>"))
    searches = blocks(items, item_col, item_text_col, length, block_pairs, unnamed)
    block = next(searches)
    while (following := next(searches, None)) is not None:
        state = stored(_marked(state, block, text_col, mark, False), "hits")
        block = following
    return _marked(state, block, text_col, mark, True).drop(mark)


def _marked(state: DataFrame, block: Benchmark, text_col: str, mark: str, last: bool) -> DataFrame:
    sent = state.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = sent.value.find
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                at = part.schema.get_field_index(mark)
                values = part.column(part.schema.get_field_index(text_col)).cast(pa.binary()).to_pylist()
                marks, keep = [], []
                for text, old in zip(values, part.column(at).to_pylist()):
                    found_words = words(text)
                    ranges = find(found_words)[0] + list(zip((old or ())[::2], (old or ())[1::2]))
                    ranges = merged(ranges)
                    hit = sum(end - first for first, end in ranges)
                    marks.append([place for both in ranges for place in both])
                    keep.append(not (hit > 0 and hit * HIT_SHARE >= len(found_words)))
                if last:
                    yield part.filter(pa.array(keep, pa.bool_()))
                else:
                    yield part.set_column(at, part.schema.field(at), pa.array(marks, part.schema.field(at).type))

    return state.transform(mapped, run, state.schema)
