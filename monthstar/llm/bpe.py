"""Byte-level BPE: texts to token ids and back.

A task reads its documents in blocks of bounded size, numbers the distinct words
(matches of the pattern) it meets, and hands Spark one row per block with the words
that are new in it. There each distinct word is encoded once: a higher-order fold
over the array of its bytes merges, step by step, the adjacent pair of lowest rank,
which it looks up in a literal map of the ranks. The ids of the words are then put
together in the order of the documents, in the same task. Nothing is shuffled.
Bytes are held as characters U+0000 to U+00FF, the map is cut into buckets by crc32
so that a lookup reads a few entries.
"""

from __future__ import annotations

import base64
import itertools
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthstar.llm.tables import kind_of, mapped, texts

#: Characters of text after which a block is closed.
BLOCK_CHARS = 1_000_000
#: Distinct words that a task remembers; beyond it the task numbers words anew.
TASK_WORDS = 1_000_000
#: Buckets of the literal rank map, a power of two.
BUCKETS = 1 << 16
#: The lower half of a long, and what stands for the rank of a pair that is no token.
MASK = (1 << 32) - 1
NO_RANK = (MASK >> 1) << 32


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The ranks as a literal ``array<map<string,int>>``; a token is in the bucket of its crc32."""
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for token, rank in ranks.items():
        chars = token.decode("latin-1")
        buckets[zlib.crc32(chars.encode("utf-8")) % BUCKETS][chars] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def _rank(table: Column, chars: Column) -> Column:
    bucket = F.crc32(chars.cast("binary")).bitwiseAND(F.lit(BUCKETS - 1).cast("long")).cast("int")
    return F.try_element_at(F.get(table, bucket), chars)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once; unlike a transform, a fold copies no value."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda kept, _: kept, use)


def word_ids(table: Column, word: Column) -> Column:
    """Token ids of a word: its own rank, or what the fold of merges leaves.

    The state is an array of longs, one for each part of the word and one for its
    end. The lower half says where the part begins, the upper half holds the rank of
    the pair that it begins, or of ``NO_RANK`` where that is no token. So the least
    entry is the leftmost pair of lowest rank. A step takes out the entry of that
    pair's second part and looks up the two pairs beside the merge.
    """

    def begin(cell: Column) -> Column:
        return cell.bitwiseAND(F.lit(MASK))

    def part(cells: Column, first: Column, last: Column) -> Column:
        start = begin(F.get(cells, first)).cast("int")
        return F.substring(word, start, begin(F.get(cells, last)).cast("int") - start)

    def cell(chars: Column, start: Column) -> Column:
        ranked = F.shiftleft(_rank(table, chars).cast("long"), 32)
        return F.coalesce(ranked, F.lit(NO_RANK)).bitwiseOR(start)

    def step(cells: Column, _: Column) -> Column:
        def merge(second: Column) -> Column:
            def beside(old: Column, i: Column) -> Column:
                left = cell(part(cells, second - 2, second + 1), begin(old))
                right = cell(part(cells, second - 1, second + 2), begin(old))
                return F.when(i >= second, old).when(i + 1 == second, right).when(i + 2 == second, left).otherwise(old)

            return F.transform(F.filter(cells, lambda _, i: i != second), beside)

        def join(start: Column) -> Column:
            return _let(F.size(F.filter(cells, lambda other: begin(other) <= start)), merge)

        def lowest(least: Column) -> Column:
            return F.when(least < F.lit(NO_RANK), _let(begin(least), join)).otherwise(cells)

        return _let(F.array_min(cells), lowest)

    def fold(size: Column) -> Column:
        def first(i: Column) -> Column:
            start = i.cast("long")
            pair = cell(F.substring(word, i, F.lit(2)), start)
            return F.when(i < size, pair).otherwise(F.lit(NO_RANK).bitwiseOR(start))

        return F.aggregate(
            F.sequence(F.lit(2), size),
            F.transform(F.sequence(F.lit(1), size + 1), first),
            step,
            lambda cells: F.transform(
                F.sequence(F.lit(0), F.size(cells) - 2), lambda i: _rank(table, part(cells, i, i + 1))
            ),
        )

    return _let(
        _rank(table, word),
        lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(_let(F.length(word), fold)),
    )


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    task_words: int = TASK_WORDS,
) -> DataFrame:
    """``(id, ids array<int>)`` of every row; the array is empty for a null or empty text.

    Repeated rows and null ids keep one result row each, other columns are not
    read. A word of any length is encoded whole; the fold costs its square in
    copied array entries. There are at most as many tasks as cores, since a task
    encodes a word once however often it reads it; ``task_words`` bounds what it
    remembers, and with it its memory.
    """
    kind = kind_of(docs, id_col)
    cores = docs.sparkSession.sparkContext.defaultParallelism
    blocks = (
        docs.select(id_col, text_col)
        .coalesce(cores)
        .transform(
            mapped,
            _blocks(id_col, text_col, pattern, task_words),
            f"doc array<{kind}>, n_words array<int>, at array<int>, fresh boolean, words array<string>",
        )
    )
    words = F.col("words")
    codes = _let(rank_map(ranks), lambda table: F.transform(words, lambda word: word_ids(table, word)))
    coded = blocks.select("doc", "n_words", "at", "fresh", codes.alias("codes"))
    return coded.transform(mapped, _put_together(id_col), f"`{id_col}` {kind}, ids array<int>")


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of an array of token ids: their binary pieces one after another."""
    pieces = [""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token.hex()
    table = F.from_json(F.lit(json.dumps(pieces)), "array<string>")

    def joined(kept: Column) -> Column:
        return F.array_join(F.transform(ids, lambda i: F.element_at(kept, i + 1)), "")

    return F.unhex(_let(table, joined))


def narrowed(pattern: str) -> str | None:
    """The pattern for texts below U+0100, its Unicode classes spelled out for the faster standard matcher.

    None where it uses other classes than letters, numbers and white space.
    """
    kinds = {r"\p{L}": "", r"\p{N}": "", r"\s": ""}
    for kind in kinds:
        kinds[kind] = "".join(f"\\x{c:02x}" for c in range(256) if regex.fullmatch(kind, chr(c)))
    out, inside, at = [], False, 0
    while at < len(pattern):
        kind = next((k for k in kinds if pattern.startswith(k, at)), None)
        if kind is not None:
            out.append(kinds[kind] if inside else f"[{kinds[kind]}]")
            at += len(kind)
        elif pattern.startswith(r"\S", at) and not inside:
            out.append("[^" + kinds[r"\s"] + "]")
            at += 2
        elif pattern[at] == "\\":
            return None
        else:
            inside = pattern[at] == "[" or inside and pattern[at] != "]"
            out.append(pattern[at])
            at += 1
    return "".join(out)


def _matcher(pattern: str):
    """All matches of the pattern in a text."""
    wide = regex.compile(pattern).findall
    spelled = narrowed(pattern)
    if spelled is None:
        return wide
    narrow = re.compile(spelled).findall

    def words(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return wide(text)
        return narrow(text)

    return words


def _numbers() -> defaultdict[str, int]:
    """Numbers words from 0 as they are asked for; refers to nothing that refers to it, so it goes when it is dropped."""
    return defaultdict(itertools.count().__next__)


def _blocks(id_col: str, text_col: str, pattern: str, task_words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _matcher(pattern)
        held: list[pa.Array] = []
        counts: list[int] = []
        places: list[np.ndarray] = []
        number, sent = _numbers(), 0
        chars, fresh = 0, True

        def block() -> pa.RecordBatch:
            new = [*itertools.islice(reversed(number), len(number) - sent)][::-1]
            lists = [
                pa.concat_arrays(held),
                pa.array(counts, pa.int32()),
                pa.array(np.concatenate(places) if places else [], pa.int32()),
                pa.array([w.encode("utf-8").decode("latin-1") for w in new], pa.string()),
            ]
            doc, n_words, at, fresh_words = (
                pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values) for values in lists
            )
            return pa.RecordBatch.from_arrays(
                [doc, n_words, at, pa.array([fresh]), fresh_words], names=["doc", "n_words", "at", "fresh", "words"]
            )

        for ids, values in texts(batches, id_col, text_col):
            held.append(ids)
            for text in values:
                found = words(text) if text else ()
                counts.append(len(found))
                if found:
                    places.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
                chars += len(text or "")
            if chars >= BLOCK_CHARS:
                yield block()
                held, counts, places, chars, fresh = [], [], [], 0, False
                if len(number) > task_words:
                    number, fresh = _numbers(), True
                sent = len(number)
        if held:
            yield block()

    return run


def _put_together(id_col: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = flat = np.empty(0, np.int32)
        for batch in batches:
            for row in range(batch.num_rows):
                doc, n_words, at = (batch.column(k)[row].values for k in range(3))
                if batch.column(3)[row].as_py():
                    sizes = flat = np.empty(0, np.int32)
                codes = batch.column(4)[row].values
                sizes = np.concatenate([sizes, np.diff(codes.offsets.to_numpy())])
                flat = np.concatenate([flat, codes.flatten().to_numpy(zero_copy_only=False)])
                starts = np.cumsum(sizes, dtype=np.int64) - sizes
                at = at.to_numpy(zero_copy_only=False)
                count = sizes[at].astype(np.int64)
                before = np.cumsum(count) - count
                take = np.repeat(starts[at] - before, count) + np.arange(int(count.sum()))
                ends = np.r_[0, np.cumsum(count)][np.r_[0, np.cumsum(n_words.to_numpy(zero_copy_only=False))]]
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat[take], pa.int32()))
                for start in range(0, len(doc), 1024):
                    yield pa.RecordBatch.from_arrays(
                        [doc.slice(start, 1024), ids.slice(start, 1024)], names=[id_col, "ids"]
                    )

    return run
