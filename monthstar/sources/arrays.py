"""JSON arrays of any length on one line, read by many tasks.

Spark's text reader splits files at a closing brace as it does at line ends, so every
task gets a part of a file that begins behind a brace. Whether that place lies inside
a string, and how many objects are open there, depends on all that comes before. A
first pass measures each part twice, once for either answer to the first question;
folding these measures in order tells where every part begins. A second pass cuts out
the records. One that crosses parts is put together from its pieces.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_QUOTE, _BACKSLASH, _OPEN, _CLOSE = b'"\\{}'
#: What may stand between records: white space, commas and the brackets of arrays.
_BETWEEN = b" \t\r\n,[]}\xef\xbb\xbf"
#: Characters of text that are looked at together.
_LOOK = 4 << 20


@dataclass
class Borders:
    """Where records begin and end in a text that comes piece by piece.

    A record is an object that lies in no other. A closing brace where nothing is
    open counts for nothing. ``lowest`` is the smallest sum of braces in the last piece.
    """

    inside: bool = False
    open: int = 0
    lowest: int = 0

    def feed(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The places of the braces that open and close records. The next piece begins with a brace."""
        chars = np.frombuffer(text, np.uint8)
        quotes = np.flatnonzero(chars == _QUOTE)
        slashes = np.flatnonzero(chars == _BACKSLASH)
        if len(slashes) and len(quotes):
            # A quote is escaped behind an odd run of backslashes.
            starts = np.flatnonzero(np.r_[True, np.diff(slashes) != 1])
            lengths = np.diff(np.r_[starts, len(slashes)])
            escaped = (slashes[starts] + lengths)[lengths % 2 == 1]
            quotes = np.setdiff1d(quotes, escaped, assume_unique=True)
        braces = np.flatnonzero((chars == _OPEN) | (chars == _CLOSE))
        braces = braces[(np.searchsorted(quotes, braces) + self.inside) % 2 == 0]
        self.inside = bool((len(quotes) + self.inside) % 2)
        raw = self.open + np.cumsum(np.where(chars[braces] == _OPEN, 1, -1))
        self.lowest = min(self.open, int(raw.min())) if len(raw) else self.open
        if not len(raw):
            return braces, braces
        depth = raw - np.minimum(np.minimum.accumulate(raw), 0)
        was = np.r_[self.open, depth[:-1]]
        self.open = int(depth[-1])
        return braces[(was == 0) & (depth == 1)], braces[(was == 1) & (depth == 0)]


class _Measure:
    """The braces of a part, counted without a floor, if it begins outside or inside a string."""

    def __init__(self, inside: bool):
        self.inside, self.total, self.least = inside, 0, 0

    def feed(self, text: bytes) -> None:
        high = 1 << 40
        borders = Borders(self.inside, high)
        borders.feed(text)
        self.least = min(self.least, self.total + borders.lowest - high)
        self.total += borders.open - high
        self.inside = borders.inside


@dataclass(frozen=True)
class _Begin:
    """How a part begins, and whether the brace that ended its last piece is the reader's and not the file's."""

    inside: bool
    open: int
    began: int | None
    unended: bool = False


def read_arrays(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, unreadable: str | None = None
) -> DataFrame:
    """Records of files that hold arrays of objects, on one line or on many, under a given schema.

    Files are split like any text, whatever their lines. A record that does not
    fit the schema's form becomes a row of nulls, and ``unreadable`` names a column that
    then holds it, as it does text between records that is neither white space, a
    comma nor a bracket. A record that is never closed ends with its file.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    found = records(spark, path)
    options = {} if unreadable is None else {"columnNameOfCorruptRecord": unreadable}
    if unreadable is not None:
        declared = T.StructType([*declared.fields, T.StructField(unreadable, T.StringType())])
    return found.select(F.from_json("record", declared, options).alias("r")).select("r.*")


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(record)``: the text of every record of some files."""
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("first"),
        F.col("_metadata.file_size").alias("size"),
        "value",
    )
    sent = spark.sparkContext.broadcast(_begins(pieces))
    cut = pieces.mapInArrow(_cutter(sent), "file string, began long, first long, record string")
    whole = cut.where("began is null").select("record")
    pairs = F.array_sort(F.collect_list(F.struct("first", "record")))
    joined = cut.where("began is not null").groupBy("file", "began").agg(pairs.alias("pieces"))
    crossing = joined.select(F.array_join(F.transform("pieces", lambda piece: piece["record"]), "").alias("record"))
    return whole.unionByName(crossing)


def _stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], int, bytes]]:
    """The part, its file's size, and text of the part, of bounded length; a part's next stretch begins behind a brace."""
    for batch in batches:
        files, firsts, sizes = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
        values = batch.column(3).cast(pa.binary()).to_pylist()
        begin, held = 0, 0
        for k, value in enumerate(values):
            held += len(value)
            ends = k + 1 == len(values) or files[k + 1] != files[k] or firsts[k + 1] != firsts[k]
            if ends or held > _LOOK:
                yield (files[k], firsts[k]), sizes[k], b"}".join(values[begin : k + 1])
                begin, held = k + 1, 0


def _begins(pieces: DataFrame) -> Mapping[tuple[str, int], _Begin]:
    """How each part begins, found by folding the measures of all parts of its file in order.

    One short row for each part comes to the driver, which plans one task for each anyway.
    """
    names = ["file", "first", "size", "chars", "inside0", "total0", "least0", "inside1", "total1", "least1"]
    counts = "inside0 boolean, total0 long, least0 long, inside1 boolean, total1 long, least1 long"

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], tuple[list[int], list[_Measure]]] = {}
        for part, size, text in _stretches(batches):
            known = part in found
            told, both = found.setdefault(part, ([size, 0], [_Measure(False), _Measure(True)]))
            told[1] += len(text) + 1
            for one in both:
                one.feed(b"}" + text if known else text)
        rows = []
        for part, (told, both) in found.items():
            for one in both:
                one.feed(b"}")
            rows.append([*part, *told, *[v for one in both for v in (one.inside, one.total, one.least)]])
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in rows])

    measured = pieces.mapInArrow(measure, f"file string, first long, size long, chars long, {counts}")
    begins: dict[tuple[str, int], _Begin] = {}
    file, chars, now, last = None, 0, _Begin(False, 0, None), None
    for row in measured.orderBy("file", "first").toLocalIterator():
        if row["file"] != file:
            file, chars, now = row["file"], 0, _Begin(False, 0, None)
        last = file, row["first"]
        chars += row["chars"]
        # A file that does not end with a brace seems to have one character more than it has.
        begins[last] = _Begin(now.inside, now.open, now.began, chars == row["size"] + 1)
        inside, total, least = row[7:10] if now.inside else row[4:7]
        began = now.began if now.open and now.open + least > 0 else row["first"]
        open_ = now.open + total - min(0, now.open + least)
        now = _Begin(inside, open_, began if open_ else None)
    return begins


class _Cutter:
    """Cuts the records out of one part after another."""

    def __init__(self, begins: Mapping[tuple[str, int], _Begin]):
        self.begins, self.part, self.out = begins, None, []

    def take(self, part: tuple[str, int], text: bytes) -> None:
        if part == self.part:
            self._cut(b"}" + text)
            return
        self.end()
        self.part, self.begin = part, self.begins[part]
        self.borders, self.began, self.held = Borders(self.begin.inside, self.begin.open), self.begin.began, []
        self._cut(text)

    def end(self) -> None:
        """The part has no more text; what is open goes on in the next."""
        if self.part is None:
            return
        if not self.begin.unended:
            self._cut(b"}")
        if self.held:
            self.out.append((self.part[0], self.began, self.part[1], b"".join(self.held)))
        self.part = None

    def _cut(self, text: bytes) -> None:
        was_open, at = self.borders.open, 0
        opens, closes = self.borders.feed(text)
        if was_open:
            at = int(closes[0]) + 1 if len(closes) else len(text)
            self.held.append(text[:at])
            if not len(closes):
                return
            # A record that began in this part is whole, others are put together later.
            crosses = self.began != self.part[1]
            place = (self.part[0], self.began, self.part[1]) if crosses else (None, None, None)
            self.out.append((*place, b"".join(self.held)))
            closes, self.held = closes[1:], []
        for first, end in zip(opens, closes):
            self._between(text[at:first])
            self.out.append((None, None, None, text[first : end + 1]))
            at = int(end) + 1
        if len(opens) > len(closes):
            self._between(text[at : opens[-1]])
            self.began, self.held = self.part[1], [text[opens[-1] :]]
        else:
            self._between(text[at:])

    def _between(self, text: bytes) -> None:
        """Text between records that is no part of an array is a record of its own, which nothing can read."""
        left = text.strip(_BETWEEN)
        if left:
            self.out.append((None, None, None, left))

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
        arrays = [pa.array(list(c), k) for c, k in zip(zip(*self.out), kinds)]
        self.out = []
        return pa.RecordBatch.from_arrays(
            [*arrays[:3], arrays[3].cast(pa.string())], names=["file", "began", "first", "record"]
        )


def _cutter(sent):
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _Cutter(sent.value)
        for part, _, text in _stretches(batches):
            cutter.take(part, text)
            if len(cutter.out) > 2000:
                yield cutter.batch()
        cutter.end()
        if cutter.out:
            yield cutter.batch()

    return cut
