"""Token ids as wavelet matrices: one compressed file per shard.

Documents are encoded in ascending order of their ids, and their tokens are cut into
shards between documents. A shard's file holds one succinct bit-plane for each bit of
an id, the highest first; on each plane the tokens with a zero come before those with
a one. With the ones counted before every chunk of a plane, rank and select answer
which token stands at a place, how often a token occurs in a range, and where, from
the few chunks that they touch. Planes are compressed chunk by chunk.

Tasks write files under names of their own, and a table lists those of the tasks that
ended well, so what a lost executor or a second attempt left behind is never read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthstar.llm.tables import BATCH_BYTES, mapped

#: Id that ends every document.
END_ID = 0
#: Tokens after which a shard is closed, at the end of a document.
SHARD_TOKENS = 1 << 22
#: Bits of a chunk of a plane; a multiple of 64.
CHUNK_BITS = 1 << 15
#: Distinct pieces of text whose ids a worker remembers; beyond it those go that were met in one batch only.
KNOWN_PIECES = 700_000

# The first bytes of a file, and what follows them (bytes of the header).
MAGIC = b"MSWM0001"
_HEAD = struct.Struct("<8sI")

#: Texts whose spaces may not be cut as ``Encoder`` does: white space that meets a space,
#: three line ends, white space twice at the end, white space beyond ASCII, and the mark of a cut.
_UNUSUAL = (
    r"[\t\x0b\f\r ][\t-\r ]|\n[\t\x0b\f\r ]|\n\n\n|[\t-\r ][\t-\r ]\z"
    r"|[\x00\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"
)
#: Marks a cut, signs behind a letter or digit before one, and pieces between which the library cuts by itself.
#: The signs are ASCII without the apostrophe, and the letters are such by every version of Unicode.
_CUT = "\0"
_LETTERS = r"A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}"
_STOPPED = rf"([0-9{_LETTERS}])([!-&(-/:-@\[-`{{-~]+)\x00"
_WORD = rf"\A [{_LETTERS}]+\z"
_JOINED = r"(?s)\A[ \n].*[^\t-\r ]\z"


@cache
def tokenizer(path: str):
    """The tokenizer of a file, one for each worker; strings of special tokens are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.encode_special_tokens = True
    return out


@cache
def token_bytes(path: str) -> np.ndarray:
    """The bytes of each token; a byte-level vocabulary spells each byte as one character."""
    words = tokenizer(path).get_vocab()
    out = np.zeros(max(words.values()) + 1, np.int64)
    out[list(words.values())] = list(map(len, words))
    return out


@cache
def word_tokenizer(path: str):
    """The model of a tokenizer file by itself, and how it spells each byte.

    It takes spelled words, each behind a space, and cuts before each space. None
    where the tokenizer does more to such words than to spell their bytes.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    whole = tokenizer(path)
    if whole.normalizer is not None or whole.pre_tokenizer is None:
        return None
    # Two bytes that are no text by themselves are found in the spelling of a letter.
    spelled: dict[int, str] = {}
    for code in range(0x21, 0x250):
        parts = whole.pre_tokenizer.pre_tokenize_str(chr(code))
        spelled.update(zip(chr(code).encode(), "".join(part for part, _ in parts)))
    space = "".join(part for part, _ in whole.pre_tokenizer.pre_tokenize_str(" a"))[:-1]
    if len(space) != 1 or [part for part, _ in whole.pre_tokenizer.pre_tokenize_str(" ab é")][1:] != [
        space + "".join(map(spelled.get, "é".encode()))
    ]:
        return None
    out = Tokenizer(whole.model)
    out.pre_tokenizer = pre_tokenizers.Split(space, "merged_with_next")
    return out, spelled | {0x20: space}


class Encoder:
    """Ids of texts by a byte-level tokenizer of the tokenizers library, without special tokens.

    Such a tokenizer cuts a text before every space or line end that follows a
    visible character, and between a letter and the signs behind it, so the pieces
    between these cuts are encoded once each and remembered. Texts with other white
    space are handed to the library whole.
    """

    def __init__(self, path: str):
        self.tokenizer, self.bytes, self.words = tokenizer(path), token_bytes(path), word_tokenizer(path)
        self.known = pa.array([], pa.string())
        self.met = np.empty(0, bool)
        self.starts, self.sizes, self.flat = (np.empty(0, np.int32) for _ in range(3))

    def _forget(self) -> None:
        """Keeps the pieces that were met again since the last time, the latest half of what may be remembered at most."""
        again = np.flatnonzero(self.met)
        again = again[max(0, len(again) - KNOWN_PIECES // 2) :]
        self.known = self.known.take(pa.array(again))
        self.flat, self.sizes = self._ids(again)
        self.starts = np.cumsum(self.sizes, dtype=np.int32) - self.sizes
        self.met = np.zeros(len(again), bool)

    def _add(self, pieces: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        first = len(self.flat)
        self.known = pa.concat_arrays([self.known, pieces])
        self.met = np.concatenate([self.met, np.zeros(len(pieces), bool)])
        self.starts = np.concatenate([self.starts, first + np.cumsum(sizes) - sizes], dtype=np.int32)
        self.sizes = np.concatenate([self.sizes, sizes], dtype=np.int32)
        self.flat = np.concatenate([self.flat, ids], dtype=np.int32)

    def _ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered pieces one after another, and how many each has."""
        sizes = self.sizes[at]
        before = np.cumsum(sizes, dtype=np.int32) - sizes
        place = np.repeat(self.starts[at] - before, sizes)
        place += np.arange(len(place), dtype=np.int32)
        return self.flat[place], sizes

    def _learn(self, pieces: pa.Array) -> np.ndarray:
        """New pieces, handed to the library as one text where it cuts that text between them; returns their numbers."""
        first = len(self.known)
        kind = pc.match_substring_regex(pieces, _JOINED).to_numpy(zero_copy_only=False).astype(np.int8)
        if self.words is not None:
            kind[pc.match_substring_regex(pieces, _WORD).to_numpy(zero_copy_only=False)] = 2
        places = [np.flatnonzero(kind == k) for k in range(3)]
        apart, joined, words = (pieces.take(pa.array(place)) for place in places)
        if len(apart):
            coded = self.tokenizer.encode(apart.to_pylist(), is_pretokenized=True, add_special_tokens=False)
            numbers = np.array(coded.word_ids, np.int64)
            self._add(apart, np.bincount(numbers, minlength=len(apart)), np.array(coded.ids, np.int32))
        if len(joined):
            self._add_joined(joined, self.tokenizer, _join(joined))
        if len(words):
            model, spelled = self.words
            self._add_joined(words, model, _join(words).encode().decode("latin-1").translate(spelled))
        out = np.empty(len(pieces), np.int64)
        out[np.concatenate(places)] = first + np.arange(len(pieces))
        return out

    def _add_joined(self, pieces: pa.Array, by, text: str) -> None:
        """Adds pieces that a tokenizer gets as one text."""
        ids = np.array(by.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
        reached = np.cumsum(self.bytes[ids])
        ends = np.cumsum(pc.binary_length(pieces).to_numpy(), dtype=np.int64)
        stops = np.searchsorted(reached, ends) + 1
        if stops[-1] > len(ids) or (reached[stops - 1] != ends).any():
            raise ValueError("the tokenizer does not cut texts before white space")
        self._add(pieces, np.diff(np.r_[0, stops]), ids)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts one after another, and where each text's end."""
        if len(self.known) > KNOWN_PIECES:
            self._forget()
        texts = pc.fill_null(texts.cast(pa.string()), "")
        unusual = pc.match_substring_regex(texts, _UNUSUAL)
        odd = np.flatnonzero(unusual.to_numpy(zero_copy_only=False))
        cut = pc.if_else(unusual, "", texts) if len(odd) else texts
        for blank in " \n":
            cut = pc.replace_substring(cut, blank, _CUT + blank)
        cut = pc.replace_substring_regex(cut, _STOPPED, rf"\1{_CUT}\2{_CUT}")
        lists = pc.split_pattern(cut, _CUT)
        ends = lists.offsets.to_numpy()
        words = lists.flatten().dictionary_encode()
        pieces = words.dictionary
        # The table of strings is made of the pieces, which are fewer than those known.
        there = pc.fill_null(pc.index_in(self.known, value_set=pieces), -1).to_numpy(zero_copy_only=False)
        found = np.flatnonzero(there >= 0)
        self.met[found] = True
        at = np.full(len(pieces), -1, np.int32)
        at[there[found]] = found
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = self._learn(pieces.take(pa.array(new)))
        ids, sizes = self._ids(at[words.indices.to_numpy()])
        cuts = np.r_[0, np.cumsum(sizes, dtype=np.int64)][ends - ends[0]]
        if not len(odd):
            return ids, cuts[1:]
        whole = self.tokenizer.encode_batch_fast(texts.take(pa.array(odd)).to_pylist(), add_special_tokens=False)
        parts = np.split(ids, cuts[1:-1])
        for k, coded in zip(odd, whole):
            parts[k] = np.array(coded.ids, np.int32)
        return np.concatenate(parts), np.cumsum([len(part) for part in parts])


def _join(pieces: pa.Array) -> str:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces), "")[0].as_py()


@cache
def encoder(path: str) -> Encoder:
    """One for each worker, so that its tasks share what they have learned."""
    return Encoder(path)


def _kind(width: int) -> type:
    """The smallest type of whole numbers of so many bits; there are no more than 32."""
    return np.uint16 if width <= 16 else np.uint32


def build(ids: pa.Array, ends: np.ndarray, tokens: np.ndarray) -> bytes:
    """The file of a shard: its documents, where their tokens end, and the tokens."""
    n = len(tokens)
    width = max(1, int(tokens.max()).bit_length()) if n else 1
    squeeze = zstandard.ZstdCompressor(level=3).compress
    zeros, chunks, ones = [], [], []
    rest = tokens.astype(_kind(width))
    for bit in reversed(range(width)):
        low, high = [rest[:0]], [rest[:0]]
        counted = 0
        for at in range(0, n, CHUNK_BITS):
            part = rest[at : at + CHUNK_BITS]
            bits = (part & rest.dtype.type(1 << bit)).astype(bool)
            low.append(part.take(np.flatnonzero(~bits)))
            high.append(part.take(np.flatnonzero(bits)))
            ones.append(counted)
            counted += len(high[-1])
            chunks.append(squeeze(np.packbits(bits, bitorder="little").tobytes()))
        zeros.append(n - counted)
        rest = np.concatenate(low + high)
    table = pa.table({"id": ids, "end": pa.array(ends, pa.int64())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    documents = squeeze(sink.getvalue().to_pybytes())
    places = np.cumsum([0, *map(len, chunks)]).astype("<i8")
    directory = squeeze(np.concatenate([places, np.array(ones, "<i8")]).tobytes())
    header = json.dumps(
        {
            "tokens": n,
            "zeros": zeros,
            "chunk_bits": CHUNK_BITS,
            "documents": len(documents),
            "directory": len(directory),
            "chunks": len(chunks),
        }
    ).encode()
    return b"".join([_HEAD.pack(MAGIC, len(header)), header, documents, directory, *chunks])


class Shard:
    """A shard's file, of which a question reads the chunks that it touches only.

    ``read(offset, size)`` returns bytes of the file.
    """

    def __init__(self, read: Callable[[int, int], bytes]):
        magic, size = _HEAD.unpack(read(0, _HEAD.size))
        if magic != MAGIC:
            raise ValueError("not a shard of tokens")
        about = json.loads(read(_HEAD.size, size))
        self.n, self.zeros, self.bits = about["tokens"], about["zeros"], about["chunk_bits"]
        at = _HEAD.size + size
        grow = zstandard.ZstdDecompressor()
        self._grow = lambda part: grow.decompress(part, max_output_size=self.bits // 8)
        documents = grow.decompress(read(at, about["documents"]))
        table = pa.ipc.open_stream(documents).read_all()
        self.ids, self.ends = table.column("id").combine_chunks(), table.column("end").to_numpy()
        at += about["documents"]
        directory = np.frombuffer(grow.decompress(read(at, about["directory"])), "<i8")
        self._read, self._at = read, at + about["directory"]
        self._places, self._ones = directory[: about["chunks"] + 1], directory[about["chunks"] + 1 :]
        self._each = -(-self.n // self.bits)
        self._known: dict[int, np.ndarray] = {}

    def _chunk(self, k: int) -> np.ndarray:
        """The bits of a chunk, a byte for each."""
        if k not in self._known:
            first, end = int(self._places[k]), int(self._places[k + 1])
            raw = np.frombuffer(self._grow(self._read(self._at + first, end - first)), np.uint8)
            self._known[k] = np.unpackbits(raw, bitorder="little")
        return self._known[k]

    def tokens(self) -> np.ndarray:
        """All tokens in order: from the lowest plane up, zeros and ones go back to their places."""
        width = len(self.zeros)
        out = np.zeros(self.n, _kind(width))
        for plane in reversed(range(width)):
            first = plane * self._each
            begin, end = int(self._places[first]), int(self._places[first + self._each])
            held = self._read(self._at + begin, end - begin)
            cuts = (self._places[first : first + self._each + 1] - begin).tolist()
            back = np.empty_like(out)
            zero, one = 0, self.zeros[plane]
            # A chunk at a time, so that places stay in the processor's cache.
            for at, a, b in zip(range(0, self.n, self.bits), cuts[:-1], cuts[1:]):
                here = back[at : at + self.bits]
                raw = np.frombuffer(self._grow(held[a:b]), np.uint8)
                bits = np.unpackbits(raw, bitorder="little", count=len(here)).view(bool)
                low, high = np.flatnonzero(~bits), np.flatnonzero(bits)
                here[low] = out[zero : zero + len(low)]
                here[high] = out[one : one + len(high)] | out.dtype.type(1 << (width - 1 - plane))
                zero, one = zero + len(low), one + len(high)
            out = back
        return out

    def _rank(self, plane: int, places: np.ndarray) -> np.ndarray:
        """Ones of a plane before each place."""
        total = self.n - self.zeros[plane]
        out = np.full(len(places), total, np.int64)
        chunk = places // self.bits
        for k in np.unique(chunk[places < self.n]):
            mine = chunk == k
            before = np.r_[0, np.cumsum(self._chunk(plane * self._each + int(k)), dtype=np.int64)]
            out[mine] = self._ones[plane * self._each + k] + before[places[mine] - k * self.bits]
        return out

    def _select(self, plane: int, bit: int, order: np.ndarray) -> np.ndarray:
        """The places of the ``order``-th (from 0) zeros or ones of a plane."""
        first = np.arange(self._each)
        ones = self._ones[plane * self._each : (plane + 1) * self._each]
        before = ones if bit else first * self.bits - ones
        chunk = np.searchsorted(before, order, "right") - 1
        out = np.empty(len(order), np.int64)
        for k in np.unique(chunk):
            mine = chunk == k
            there = np.flatnonzero(self._chunk(plane * self._each + int(k)) == bit)
            out[mine] = k * self.bits + there[order[mine] - before[k]]
        return out

    def access(self, places: np.ndarray) -> np.ndarray:
        """The tokens at some places."""
        at = np.asarray(places, np.int64).copy()
        out = np.zeros(len(at), np.uint32)
        for plane, zeros in enumerate(self.zeros):
            ones = self._rank(plane, np.concatenate([at, at + 1]))
            here, after = ones[: len(at)], ones[len(at) :]
            bit = after > here
            out = out << np.uint32(1) | bit
            at = np.where(bit, zeros + here, at - here)
        return out

    def _range(self, token: int, first: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a token in a range stand below the lowest plane."""
        if token < 0 or token >> len(self.zeros) or first >= end:
            return 0, 0
        at = np.array([first, end], np.int64)
        for plane, zeros in enumerate(self.zeros):
            ones = self._rank(plane, at)
            at = zeros + ones if token >> (len(self.zeros) - 1 - plane) & 1 else at - ones
        return int(at[0]), int(at[1])

    def count(self, token: int, first: int = 0, end: int | None = None) -> int:
        """How often a token occurs in a range of places."""
        low, high = self._range(token, first, self.n if end is None else end)
        return high - low

    def occurrences(self, token: int, first: int = 0, end: int | None = None) -> np.ndarray:
        """The places in a range at which a token stands, ascending."""
        low, high = self._range(token, first, self.n if end is None else end)
        at = np.arange(low, high)
        for plane in reversed(range(len(self.zeros))):
            if not len(at):
                break
            bit = token >> (len(self.zeros) - 1 - plane) & 1
            at = self._select(plane, bit, at - self.zeros[plane] if bit else at)
        return np.sort(at)


def _system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path that all executors share, and the path on it."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(re.sub(r"^s3a:", "s3:", re.sub(r"^file:/+", "file:///", path)))
    return fs.LocalFileSystem(), path


def open_shard(path: str) -> Shard:
    system, where = _system(path)
    file = system.open_input_file(where)

    def read(offset: int, size: int) -> bytes:
        return file.read_at(size, offset)

    return Shard(read)


_LISTED = "task int, place int, file string, documents long, tokens long, bytes long"


def write(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Encode documents and write their shards under ``path``; returns the table of shards.

    ``vocabulary`` is a tokenizer file that every executor has under this path.
    Documents stand in ascending order of ids, null ids first, documents that
    share an id by a hash of their text. Each ends with ``END_ID``, which is all
    that a null or empty text has. A document is never cut, so a shard has
    ``shard_tokens`` tokens and one document more at most. A table without rows
    has no shard. ``path`` lies in a folder that all executors share and must be
    new; other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("mark"),
        F.monotonically_increasing_id().alias("row"),
    )
    tasks = max(1, rows.rdd.getNumPartitions())
    order = ["id", "mark", "row"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        system, folder = _system(path)
        system.create_dir(folder, recursive=True)
        names: list[pa.Array] = []
        sizes: list[np.ndarray] = []
        held: list[np.ndarray] = []
        count, place = 0, 0

        def close() -> pa.RecordBatch:
            ends = np.cumsum(np.concatenate(sizes))
            content = build(pa.concat_arrays(names), ends, np.concatenate(held))
            file = f"{uuid.uuid4().hex}.tokens"
            with system.open_output_stream(f"{folder}/{file}") as out:
                out.write(content)
            told = [TaskContext.get().partitionId(), place, file, len(ends), int(ends[-1]), len(content)]
            return pa.RecordBatch.from_pylist([dict(zip(listed.names, told))], schema=listed)

        for batch in batches:
            for start, end in _cuts(batch.column(1)):
                part = batch.slice(start, end - start)
                ids, ends = encode(part.column(1))
                lengths = np.diff(np.r_[0, ends])
                ids = np.insert(ids, ends, END_ID)
                first = 0
                stops = np.cumsum(lengths + 1)
                while first < len(stops):
                    begun = int(stops[first - 1]) if first else 0
                    last = int(np.searchsorted(stops, begun + shard_tokens - count))
                    last = min(max(last, first) + 1, len(stops))
                    names.append(part.column(0).slice(first, last - first))
                    sizes.append(lengths[first:last] + 1)
                    held.append(ids[begun : int(stops[last - 1])])
                    count += len(held[-1])
                    first = last
                    if count >= shard_tokens:
                        yield close()
                        names, sizes, held, count, place = [], [], [], 0, place + 1
        if names:
            yield close()

    listed = pa.schema(
        [("task", pa.int32()), ("place", pa.int32()), ("file", pa.string())]
        + [(name, pa.int64()) for name in ("documents", "tokens", "bytes")]
    )
    placed = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("id", "text")
    placed.transform(mapped, run, _LISTED).write.parquet(f"{path}/shards")
    # A table without rows keeps the type of the ids.
    docs.select(id_col).where(F.lit(False)).write.parquet(f"{path}/ids")
    return shards(docs.sparkSession, path)


def _cuts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of a batch's texts that are encoded together, some millions of bytes each."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    part = np.cumsum(size) // (BATCH_BYTES)
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(size)]
    return ((a, b) for a, b in zip(edges[:-1], edges[1:]) if a < b)


def shards(spark: SparkSession, path: str) -> DataFrame:
    """``(shard, start, file, documents, tokens, bytes)``: a row for each shard, in order, ``start`` tokens before it."""
    listed = spark.read.schema(_LISTED).parquet(f"{path}/shards")
    order = Window.orderBy("task", "place")
    return listed.select(
        (F.row_number().over(order) - 1).alias("shard"),
        (F.sum("tokens").over(order) - F.col("tokens")).alias("start"),
        F.concat(F.lit(f"{path}/"), "file").alias("file"),
        "documents",
        "tokens",
        "bytes",
    )


def _asked(spark: SparkSession, path: str, ask, schema: str, columns: tuple[str, ...] = ()) -> DataFrame:
    """``ask(shard, start)`` of every shard, a task for each; it yields batches."""
    listed = shards(spark, path).select("file", "start")
    number = max(1, spark.read.schema(_LISTED).parquet(f"{path}/shards").count())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from ask(open_shard(row["file"]), row["start"])

    return listed.repartition(number, "file").transform(mapped, run, schema)


def _id_type(spark: SparkSession, path: str) -> str:
    return spark.read.parquet(f"{path}/ids").schema[0].dataType.simpleString()


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(id, start, n_tokens, ids)`` of every document from its shard; ``ids`` are little-endian unsigned 32-bit integers."""

    def ask(shard: Shard, start: int) -> Iterator[pa.RecordBatch]:
        raw = memoryview(shard.tokens().astype("<u4").tobytes())
        ends = shard.ends
        firsts = np.r_[0, ends[:-1]]
        part = ends // (BATCH_BYTES // 4)
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(ends)]
        for a, b in zip(edges[:-1], edges[1:]):
            if a == b:
                continue
            base = int(firsts[a])
            offsets = pa.py_buffer(((np.r_[firsts[a], ends[a:b]] - base) * 4).astype("<i4").tobytes())
            data = pa.py_buffer(raw[base * 4 : int(ends[b - 1]) * 4])
            yield pa.RecordBatch.from_arrays(
                [
                    shard.ids.slice(a, b - a),
                    pa.array(start + firsts[a:b]),
                    pa.array(ends[a:b] - firsts[a:b]),
                    pa.BinaryArray.from_buffers(pa.binary(), b - a, [None, offsets, data]),
                ],
                names=["id", "start", "n_tokens", "ids"],
            )

    return _asked(spark, path, ask, f"id {_id_type(spark, path)}, start long, n_tokens long, ids binary")


def counts(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """``(token, n)``: how often each of some tokens occurs in all shards, by rank alone."""

    def ask(shard: Shard, start: int) -> Iterator[pa.RecordBatch]:
        found = [shard.count(token) for token in tokens]
        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array(found)], names=["token", "n"])

    return _asked(spark, path, ask, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """``(token, id, place, position)``: every occurrence of some tokens, its place in the document and among all tokens."""

    def ask(shard: Shard, start: int) -> Iterator[pa.RecordBatch]:
        for token in tokens:
            at = shard.occurrences(token)
            doc = np.searchsorted(shard.ends, at, "right")
            first = np.r_[0, shard.ends[:-1]][doc] if len(at) else at
            for k in range(0, len(at), 20_000):
                some = slice(k, k + 20_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at[some]), token)),
                        shard.ids.take(pa.array(doc[some])),
                        pa.array(at[some] - first[some]),
                        pa.array(start + at[some]),
                    ],
                    names=["token", "id", "place", "position"],
                )

    return _asked(spark, path, ask, f"token long, id {_id_type(spark, path)}, place long, position long")


def lookup(positions: DataFrame, path: str, column: str = "position") -> DataFrame:
    """``(position, token)`` of every row of ``positions`` that lies inside, by access to the shards it meets.

    Positions meet shards by ranges of ``SHARD_TOKENS``; a shard is opened once
    for each batch of positions that lies in it.
    """
    spark = positions.sparkSession
    listed = shards(spark, path).where("tokens > 0")
    covers = listed.select(
        "file",
        "start",
        (F.col("start") + F.col("tokens")).alias("end"),
        F.explode(
            F.sequence(
                F.floor(F.col("start") / SHARD_TOKENS), F.floor((F.col("start") + F.col("tokens") - 1) / SHARD_TOKENS)
            )
        ).alias("part"),
    )
    asked = positions.select(F.col(column).cast("long").alias("position")).withColumn(
        "part", F.floor(F.col("position") / SHARD_TOKENS)
    )
    met = asked.join(covers, "part").where("position >= start and position < end")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = np.array(batch.column(0).to_pylist())
            places = batch.column(2).to_numpy() - batch.column(1).to_numpy()
            for file in np.unique(files):
                mine = np.flatnonzero(files == file)
                found = open_shard(str(file)).access(places[mine]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).take(pa.array(mine)), pa.array(found)], names=["position", "token"]
                )

    return (
        met.select("file", "start", "position").repartition("file", F.floor(F.col("position") / (SHARD_TOKENS // 16)))
        .sortWithinPartitions("file", "position")
        .transform(mapped, run, "position long, token long")
    )
