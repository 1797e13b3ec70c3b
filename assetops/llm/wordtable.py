"""Look-ups by word for every word position of a corpus, without a shuffle row
per position.

Documents are read in chunks of a bounded number of words.  A chunk numbers its
distinct words in order of appearance and sends each of them once to the word
partition its hash names.  There every distinct word of the corpus lives in
exactly one partition and is answered once; the answers return to the chunks,
where they meet the positions again.  A frequent word travels once per chunk,
so no word makes a partition large, and the number of word partitions grows
with ``spark.sql.shuffle.partitions``.

Chunks are named by a hash of their rows: positions and words are made in two
passes over the same input, and an input that changes between them is an error,
not a wrong answer.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame

from assetops.llm.shingles import give_back

CHUNK_WORDS = 2_000_000

_WORDS = pa.schema(
    [("part", pa.int32()), ("chunk", pa.int64()), ("words", pa.binary()), ("local", pa.binary()), ("uses", pa.binary())]
)
_WORDS_SQL = "part int, chunk bigint, words binary, local binary, uses binary"
_ANSWERS = pa.schema([("chunk", pa.int64()), ("local", pa.binary()), ("answers", pa.binary())])
_ANSWERS_SQL = "chunk bigint, local binary, answers binary"
_ROWS = pa.schema(
    [("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("lens", pa.binary()), ("positions", pa.binary()), ("measured", pa.binary())]
)
_ROWS_SQL = "chunk bigint, ids array<bigint>, lens binary, positions binary, measured binary"


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes."""
    v = np.ascontiguousarray(values)
    planes = v.view(np.uint8).reshape(len(v), v.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, dtype=np.uint32) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


class _Numbering(dict):
    """Numbers words as they appear."""

    def __missing__(self, word: str | bytes) -> int:
        number = self[word] = len(self)
        return number


class Chunk:
    def __init__(self) -> None:
        self.numbers, self.ids, self.lens, self.positions, self.texts = _Numbering(), [], [], [], []
        self.size, self.hash = 0, xxhash.xxh64()

    def add(self, row_id: int | None, text: str, found: list[str] | list[bytes]) -> None:
        self.texts.append(text)
        self.positions.append(np.fromiter(map(self.numbers.__getitem__, found), np.uint32, len(found)))
        self.ids.append(row_id)
        self.lens.append(len(found))
        self.size += len(found) + 1
        self.hash.update(struct.pack("<?q", row_id is None, row_id or 0))
        self.hash.update(text.encode("utf-8", "surrogatepass"))

    @property
    def name(self) -> int:
        return struct.unpack("<q", self.hash.digest())[0]


def chunks(batches: Iterator[pa.RecordBatch], split: Callable[[str], list]) -> Iterator[Chunk]:
    """Chunks of (id, text) rows; a NULL text is empty."""
    chunk = Chunk()
    for batch in batches:
        for row_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            chunk.add(row_id, text, split(text))
            if chunk.size >= CHUNK_WORDS:
                yield chunk
                chunk = Chunk()
                give_back()
    if chunk.ids:
        yield chunk
    chunk = None
    give_back()


def _word_rows(split, parts: int, counted: Callable[[int | None], bool] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, split):
            words = [w if isinstance(w, bytes) else w.encode("utf-8", "surrogatepass") for w in chunk.numbers]
            uses = np.zeros(len(words), np.int64)
            if counted is not None:
                of = [p for p, i in zip(chunk.positions, chunk.ids) if counted(i)]
                if of:
                    uses += np.bincount(np.concatenate(of), minlength=len(words))
            part = np.fromiter((zlib.crc32(w) % parts for w in words), np.int32, len(words))
            order = np.argsort(part, kind="stable")
            bounds = np.searchsorted(part[order], np.arange(parts + 1))
            compress = zstandard.ZstdCompressor(level=3).compress
            for p in range(parts):
                local = order[bounds[p] : bounds[p + 1]]
                if len(local):
                    blob = b"\n".join([words[i] for i in local])
                    row = [[p], [chunk.name], [compress(blob)], [pack(np.diff(local.astype(np.uint32), prepend=np.uint32(0)))], [pack(uses[local])]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, _WORDS)], schema=_WORDS)

    return run


def word_rows(rows: DataFrame, split, counted=None) -> DataFrame:
    """The distinct words of every chunk, by word partition.  ``uses`` counts a
    word's positions in documents whose id ``counted`` accepts."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.mapInArrow(_word_rows(split, parts, counted), _WORDS_SQL)


def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[bytes], list[np.ndarray], np.ndarray, list[bytes]]]:
    """For each word partition: chunks, their local numbers, their words as
    numbers into the partition's distinct words, total uses, distinct words."""
    decompress = zstandard.ZstdDecompressor().decompress
    part, state = None, None
    for batch in batches:
        for p, chunk, blob, local, uses in zip(*(c.to_pylist() for c in batch.columns)):
            if p != part:
                if state is not None:
                    yield state[0], state[1], state[2], _totals(state[2], state[3], len(state[4])), list(state[4])
                part, state = p, ([], [], [], [], _Numbering())
            found = decompress(blob).split(b"\n")
            state[0].append(chunk)
            state[1].append(local)
            state[2].append(np.fromiter(map(state[4].__getitem__, found), np.uint32, len(found)))
            state[3].append(unpack(uses, np.int64))
    if state is not None:
        yield state[0], state[1], state[2], _totals(state[2], state[3], len(state[4])), list(state[4])


def _totals(numbers: list[np.ndarray], uses: list[np.ndarray], size: int) -> np.ndarray:
    total = np.zeros(size, np.int64)
    for n, u in zip(numbers, uses):
        total[n] += u  # a chunk names a word once
    return total


def dealt(words: DataFrame) -> DataFrame:
    """Word rows in their partitions."""
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return words.repartition(parts, "part").sortWithinPartitions("part")


def answered(words: DataFrame, answer: Callable[[list[bytes], np.ndarray], Callable[[np.ndarray], bytes]]) -> DataFrame:
    """(chunk, local, answers): ``answer`` gets a partition's distinct words and
    total uses and returns what packs the answers of numbered words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, local, numbers, totals, words in by_part(batches):
            packed = answer(words, totals)
            for chunk, at, n in zip(names, local, numbers):
                row = [[chunk], [at], [packed(n)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, _ANSWERS)], schema=_ANSWERS)

    return dealt(words).mapInArrow(run, _ANSWERS_SQL)


def position_rows(rows: DataFrame, split, measure: Callable[[list[str]], bytes] | None = None) -> DataFrame:
    """One row per chunk: its documents, their positions' local numbers, and
    what ``measure`` makes of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, split):
            measured = b"" if measure is None else measure(chunk.texts)
            at = np.concatenate(chunk.positions)
            row = [[chunk.name], [chunk.ids], [pack(np.array(chunk.lens, np.uint32))], [pack(at)], [measured]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, _ROWS)], schema=_ROWS)

    return rows.mapInArrow(run, _ROWS_SQL)


def met(rows: DataFrame, answers: DataFrame, combine, schema: str, other: str | None = None) -> DataFrame:
    """``combine(ids, lens, positions, measured, [(local numbers, answers), ...])``
    of every chunk, as record batches of ``schema``.  Answers may be to something
    else than words, in column ``other``: a last argument [(other, answers), ...]."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs = [
            (np.cumsum(unpack(a), dtype=np.int64), b)
            for a, b in zip(right.column("local").to_pylist(), right.column("answers").to_pylist())
            if a is not None
        ]
        others = []
        if other is not None:
            others = [[(a, b) for a, b in zip(right.column(other).to_pylist(), right.column("answers").to_pylist()) if a is not None]]
        size = sum(len(a) for a, _ in pairs)
        out = []
        for ids, lens, positions, measured in zip(*(left.column(c).to_pylist() for c in _ROWS.names[1:])):
            at = unpack(positions)
            if len(at) and int(at.max()) >= size:
                raise ValueError("the input changed between two passes: write it to a table first")
            out.append(combine(ids, unpack(lens).astype(np.int64), at, measured, pairs, *others))
        if not out:
            raise ValueError("the input changed between two passes: write it to a table first")
        return pa.Table.from_batches(out)

    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)
