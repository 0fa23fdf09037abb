"""Passages that recur across documents or within one, found by phrase automata.

A window is a run of consecutive words; it recurs if its words also start anywhere
else. Each window has an anchor, the run of words inside it with the least hash, so
equal windows have equal anchors. The steps:

1. All documents give their anchors, about one for every twelve words. Anchors that
   occur once cannot lie in a recurring window and go no further.
2. Documents meet their remaining anchors again and send the stretch of words around
   each to the shard of that anchor.
3. A shard takes its stretches in chunks of whole anchors, confirms the phrases that
   recur, compiles them into an Aho-Corasick automaton over word numbers and streams
   the stretches through it. Every occurrence is a covered range of words.
4. An anchor with very many stretches is dealt to several shards, also where they are
   all of one document. Such a shard also
   hands on each phrase once; phrases of different shards meet by their hash, and
   occurrences that were alone in their shard are confirmed there.

Automata are compiled from what a shard has received, and documents are not streamed
to shards that cannot match them, so the work grows with the input and not with its
square. Nothing is broadcast and the driver gets no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthstar.llm.tables import SLICE_ROWS, discard, kind_of, mapped, stored

#: Contract of the query: words to a window.
WINDOW_WORDS = 35
#: Words of an anchor; a window holds ``WINDOW_WORDS - ANCHOR_WORDS + 1`` runs of so many words.
ANCHOR_WORDS = 12
#: Stretches of one anchor that go to one shard, about; beyond it the anchor has several.
SHARD_STRETCHES = 20_000
#: Words of stretches after which a shard's chunk is closed (at the end of an anchor).
CHUNK_WORDS = 400_000
#: Words whose hash a task remembers.
KNOWN_WORDS = 1_000_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class WordHashes:
    """64-bit hashes of words, the same in every task."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of every run of ``length`` words."""
    n = len(hashes)
    up = np.cumprod(np.full(n, _BASE, np.uint64))
    down = np.cumprod(np.full(n, _INVERSE, np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)])
    mixed = (total[length:] - total[:-length]) * down[: n - length + 1]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def anchors(hashes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each anchor of a document, and the first and last window start it belongs to."""
    if len(hashes) < window:
        none = np.empty(0, np.int64)
        return none, none, none
    runs = run_hashes(hashes, anchor)
    places = np.arange(len(runs), dtype=np.uint64)
    least = (runs & np.uint64(0xFFFFFFFF00000000)) | places
    span, width = 1, window - anchor + 1
    while span * 2 <= width:
        least = np.minimum(least[: len(least) - span], least[span:])
        span *= 2
    rest = width - span
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    lasts = np.r_[starts[1:], len(at)] - 1
    return runs[at[starts]].view(np.int64), starts, lasts


_LISTS = "anchors array<long>, firsts array<int>, lasts array<int>"


def anchor_lists(docs: DataFrame, id_col: str, text_col: str, window: int, anchor: int) -> DataFrame:
    """``(id, mark, n_words, anchors, firsts, lasts)``; ``mark`` is a hash of the text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                counts, found = [], []
                for text in part.column(2).cast(pa.binary()).to_pylist():
                    words = text.split() if text else []
                    counts.append(len(words))
                    found.append(anchors(hashed(words), window, anchor))
                ends = pa.array(np.r_[0, np.cumsum([len(f[0]) for f in found])], pa.int32())
                lists = [
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate([f[k] for f in found]), kind))
                    for k, kind in enumerate((pa.int64(), pa.int32(), pa.int32()))
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(counts, pa.int64()), *lists],
                    names=["id", "mark", "n_words", "anchors", "firsts", "lasts"],
                )

    return _keyed(docs, id_col, text_col).transform(
        mapped,
        run, f"id {kind_of(docs, id_col)}, mark long, n_words long, {_LISTS}"
    )


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, mark, text)``: id and mark together tell rows apart, save exact repetitions."""
    return docs.select(
        F.col(id_col), F.xxhash64(text_col), F.col(text_col)
    ).toDF("id", "mark", "text")


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return (a["mark"] == b["mark"]) & a["id"].eqNullSafe(b["id"])


def covered(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW_WORDS,
    anchor: int = ANCHOR_WORDS,
    shard_stretches: int = SHARD_STRETCHES,
) -> DataFrame:
    """``(id, mark, text, ranges)`` of every row: word ranges ``struct<first,end>`` inside recurring windows, merged.

    Rows that repeat a document wholly are occurrences of their own. Null and
    empty texts, and texts shorter than a window, have no range. Null ids keep
    their rows; other columns are not read. ``mark`` is a hash of the text.
    """
    rows = _keyed(docs, id_col, text_col)
    listed = stored(anchor_lists(docs, id_col, text_col, window, anchor), "anchors")
    counts = (
        listed.select(F.explode("anchors").alias("anchor")).groupBy("anchor").count().where(F.col("count") > 1)
    )
    shards = F.ceil(F.col("count") / shard_stretches).cast("int")
    recurring = counts.select("anchor", shards.alias("shards"))
    places = listed.select(
        "id", "mark", F.explode(F.arrays_zip("anchors", "firsts", "lasts")).alias("a")
    ).select("id", "mark", F.col("a.anchors").alias("anchor"), F.col("a.firsts").alias("first"), F.col("a.lasts").alias("last"))
    wanted = (
        places.join(recurring, "anchor")
        .groupBy("id", "mark")
        .agg(F.collect_set(F.struct("first", "last", "anchor", "shards")).alias("places"))
    )
    met = rows.join(wanted, _same_row(rows, wanted), "left").select(
        rows["id"], rows["mark"], rows["text"], wanted["places"]
    )
    met = stored(met.withColumn("row", F.monotonically_increasing_id()), "documents")
    discard(listed)
    stretches = _stretches(met.where(F.col("places").isNotNull()), window)
    near = stored(_confirmed(stretches, window), "ranges")
    lone = near.where(F.col("phrase").isNotNull())
    far = _confirmed_across(lone)
    ranges = (
        near.where(F.col("phrase").isNull()).select("row", "first", "end").unionByName(far)
        .groupBy("row")
        .agg(F.array_sort(F.collect_set(F.struct("first", "end"))).alias("ranges"))
    )
    kind = "array<struct<first:int,end:int>>"
    shown = ["id", "mark", "text"]
    touched = met.where(F.col("places").isNotNull()).join(ranges, "row", "left")
    out = touched.select(*shown, _merged("ranges").alias("ranges")).unionByName(
        met.where(F.col("places").isNull()).select(*shown, F.lit(None).cast(kind).alias("ranges"))
    )
    return out.select(*shown, F.coalesce("ranges", F.array().cast(kind)).alias("ranges")).toDF(
        id_col, "mark", text_col, "ranges"
    )


def _merged(ranges: str) -> Column:
    """Sorted ranges, those that touch or overlap joined."""
    kind = "array<struct<first:int,end:int>>"

    def add(done: Column, one: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["first"].alias("first"), F.greatest(last["end"], one["end"]).alias("end"))
        return (
            F.when(F.size(done) == 0, F.array(one))
            .when(one["first"] <= last["end"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined)))
            .otherwise(F.concat(done, F.array(one)))
        )

    return F.aggregate(ranges, F.array().cast(kind), add)


def _stretches(met: DataFrame, window: int) -> DataFrame:
    """The words around each recurring anchor: ``(anchor, shard, shards, row, first, words)``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "shard", "shards", "row", "first", "words"]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            numbers = batch.column(0).to_pylist()
            ends = batch.column(2).offsets.to_pylist()
            firsts, lasts, marks, shards = (column.to_pylist() for column in batch.column(2).values.flatten())
            out = []
            for k, (number, text) in enumerate(zip(numbers, batch.column(1).cast(pa.binary()).to_pylist())):
                words = text.split()
                for at in range(ends[k], ends[k + 1]):
                    line = b" ".join(words[firsts[at] : lasts[at] + window])
                    shard = 0
                    if shards[at] > 1:
                        # Stretches are dealt to the shards of a very frequent anchor by row and place.
                        place = number.to_bytes(8, "big") + firsts[at].to_bytes(4, "big")
                        shard = xxhash.xxh32_intdigest(place) % shards[at]
                    out.append((marks[at], shard, shards[at], number, firsts[at], line))
                    if len(out) > 5000:
                        yield batch_of(out)
                        out = []
            if out:
                yield batch_of(out)

    return met.select("row", "text", "places").transform(
        mapped,
        run, "anchor long, shard int, shards int, row long, first int, words binary"
    )


def _confirmed(stretches: DataFrame, window: int) -> DataFrame:
    """Ranges of recurring windows within each shard: ``(row, first, end)``.

    For anchors of several shards, also a row with ``phrase`` (a hash) for one
    occurrence of every window, ``alone`` where its shard has no other.
    """
    names = ["row", "first", "end", "phrase", "alone"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _whole_anchors(batches):
            out = list(shard_ranges(chunk, window))
            for start in range(0, len(out), 20_000):
                columns = zip(*out[start : start + 20_000])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return (
        stretches.repartition("anchor", "shard")
        .sortWithinPartitions("anchor", "shard")
        .transform(mapped, run, "row long, first int, end int, phrase binary, alone boolean")
    )


def _whole_anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Chunks of stretches; those of one anchor and shard stay together."""
    chunk: list[tuple] = []
    size = 0

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns))

    for _, group in groupby(rows(), key=itemgetter(0, 1)):
        for row in group:
            chunk.append(row)
            size += row[5].count(b" ")
        if size >= CHUNK_WORDS:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def shard_ranges(chunk: list[tuple], window: int) -> Iterator[tuple]:
    """Occurrences of the recurring windows of a chunk.

    Equal stretches are one line with several places, and all its windows recur.
    Anchors with different lines share an automaton over word numbers, compiled
    from the windows that recur among them; every line is streamed through it.
    """
    lines: list[tuple[bytes, list[tuple]]] = []
    mixed: list[tuple[bytes, list[tuple]]] = []
    for _, group in groupby(chunk, key=itemgetter(0, 1)):
        places: dict[bytes, list[tuple]] = {}
        for row in group:
            places.setdefault(row[5], []).append(row)
        (mixed if len(places) > 1 else lines).extend(places.items())
    several: list[tuple[list[bytes], list[tuple], set[int]]] = []
    for line, rows in lines:
        size = line.count(b" ") + 1
        if len(rows) > 1:
            for row in rows:
                yield row[3], row[4], row[4] + size, None, None
        if rows[0][2] > 1:
            several.append((line.split(b" "), rows, set() if len(rows) == 1 else set(range(size))))

    number: dict[bytes, int] = {}
    numbered = [tuple([number.setdefault(w, len(number) + 1) for w in line.split(b" ")]) for line, _ in mixed]
    once: set[tuple] = set()
    often: set[tuple] = set()
    for line, (_, rows) in zip(numbered, mixed):
        phrases = [line[k : k + window] for k in range(len(line) - window + 1)]
        if len(rows) > 1:
            often.update(phrases)
            continue
        for phrase in phrases:
            if phrase in once:
                often.add(phrase)
            else:
                once.add(phrase)
    # Windows of a line with one place that a line with several has too are in ``often`` already.
    if often:
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
        for phrase in often:
            automaton.add_word(phrase)
        automaton.make_automaton()
    for line, (text, rows) in zip(numbered, mixed):
        starts = [end - window + 1 for end, _ in automaton.iter(line)] if often else []
        for first, end in _joined(starts):
            for row in rows:
                yield row[3], row[4] + first, row[4] + end + window - 1, None, None
        if rows[0][2] > 1:
            several.append((text.split(b" "), rows, set(starts)))

    # Once for each shard, though a chunk may hold several shards of an anchor.
    handed: set[tuple[tuple, bytes]] = set()
    for words, rows, near in several:
        for k in range(len(words) - window + 1):
            mark = xxhash.xxh128_digest(b" ".join(words[k : k + window]))
            if (rows[0][:2], mark) not in handed:
                handed.add((rows[0][:2], mark))
                yield rows[0][3], rows[0][4] + k, rows[0][4] + k + window, mark, k not in near


def _joined(starts: Iterable[int]) -> list[tuple[int, int]]:
    """Ranges (first start, last start + 1) of consecutive starts."""
    out: list[list[int]] = []
    for start in starts:
        if out and start == out[-1][1]:
            out[-1][1] = start + 1
        else:
            out.append([start, start + 1])
    return [(a, b) for a, b in out]


def _confirmed_across(lone: DataFrame) -> DataFrame:
    """Occurrences that were alone in their shard and have another in a different one."""
    twice = lone.groupBy("phrase").count().where(F.col("count") > 1).select("phrase")
    return lone.where("alone").join(twice, "phrase").select("row", "first", "end")




def without_repeats(found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, n_removed, kept)`` of every row of ``covered``: the words outside the ranges, joined by a space."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                counts, removed, kept = [], [], []
                for text, ranges in zip(part.column(1).cast(pa.binary()).to_pylist(), part.column(2).to_pylist()):
                    words = text.split() if text else []
                    counts.append(len(words))
                    removed.append(sum(r["end"] - r["first"] for r in ranges))
                    rest, done = [], 0
                    for r in ranges:
                        rest += words[done : r["first"]]
                        done = r["end"]
                    kept.append(b" ".join(rest + words[done:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(counts, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    names=[id_col, "n_words", "n_removed", "kept"],
                )

    return found.select(id_col, text_col, "ranges").transform(
        mapped,
        run, f"`{id_col}` {kind_of(found, id_col)}, n_words long, n_removed long, kept string"
    )
