"""Fill-in-the-middle examples by a piece table.

A document is never moved while it is cut and arranged: it is a list of
descriptors (buffer, start, length) over two buffers that never change, the
text's bytes and the sentinels.  Cutting at two unit borders splits its one
descriptor into prefix, middle and suffix; an arrangement puts these and the
sentinels' descriptors in an order; hashes read the descriptors one after
another.  Restoring finds the sentinels in the finished output, which gives
descriptors over the output, and undoes the arrangement.

Units are lines with their line feed.  Borders and form come from a hash of the
id, so a retried task makes the same example and rows that repeat an id and text
are alike.  A NULL text is empty; empty texts and texts that hold a sentinel stay
plain; a NULL id hashes as the empty string.  An empty table gives an empty
result; other columns keep their values and are read only by ``transformed``.
Every row is one step of its own: there is no shuffle and no state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED = 7
PLAIN_FROM = 100  # examples with h3 % 100 at or above this stay plain
SPM_BELOW = 50  # of the others those with h4 % 100 below this begin with the suffix
BATCH_ROWS = 1024

#: The sentinel buffer and its descriptors.
SENTINELS = b"<P><S><M>"
MARKS = {"P": (1, 0, 3), "S": (1, 3, 3), "M": (1, 6, 3)}

#: What stands where in the output: sentinels by letter, pieces by name.
ARRANGEMENTS = {
    "plain": ("prefix", "middle", "suffix"),
    "psm": ("P", "prefix", "S", "suffix", "M", "middle"),
    "spm": ("S", "suffix", "P", "prefix", "M", "middle"),
}
PIECES = ARRANGEMENTS["plain"]

Descriptor = tuple[int, int, int]


@dataclass(frozen=True)
class Example:
    """One document as descriptors; ``n`` units, ``form`` of its arrangement."""

    n: int
    form: str
    prefix: Descriptor
    middle: Descriptor
    suffix: Descriptor

    def arranged(self) -> list[Descriptor]:
        own = {"prefix": self.prefix, "middle": self.middle, "suffix": self.suffix}
        return [own[name] if name in own else MARKS[name] for name in ARRANGEMENTS[self.form]]


def split(piece: Descriptor, length: int) -> tuple[Descriptor, Descriptor]:
    """The descriptor cut in two after ``length`` bytes."""
    buffer, start, whole = piece
    return (buffer, start, length), (buffer, start + length, whole - length)


def example(doc_id: int | None, text: memoryview, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW, seed: int = SEED) -> Example:
    """Cuts and arranges one text, given as UTF-8 bytes.  A line feed is one
    byte that no other character contains, so borders are found in the bytes."""
    data = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero(data == 10) + 1
    if len(data) and (not len(ends) or ends[-1] != len(data)):
        ends = np.append(ends, len(data))
    n = len(ends)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    at = [0, *ends.tolist()]
    prefix, rest = split((0, 0, len(data)), at[first])
    middle, suffix = split(rest, at[second] - at[first])
    raw = bytes(text) if b"<"[0] in data else b""
    marked = any(SENTINELS[s : s + size] in raw for _, s, size in MARKS.values())
    form = "plain" if not len(data) or marked or h3 % 100 >= plain_from else "spm" if h4 % 100 < spm_below else "psm"
    return Example(n, form, prefix, middle, suffix)


def read(pieces: list[Descriptor], text: memoryview) -> Iterator[memoryview]:
    """The bytes behind the descriptors, without a copy."""
    buffers = (text, memoryview(SENTINELS))
    for buffer, start, length in pieces:
        yield buffers[buffer][start : start + length]


def digest_of(pieces: list[Descriptor], text: memoryview) -> str:
    found = hashlib.sha256()
    for part in read(pieces, text):
        found.update(part)
    return found.hexdigest()


def restore(output: bytes, form: str) -> list[Descriptor]:
    """Descriptors over ``output`` that give the text back.  A sentinel is in no
    piece, so its first place in the output is its only one."""
    order, at, found = ARRANGEMENTS[form], 0, {}
    if form == "plain":
        return [(0, 0, len(output))]
    for name, after in zip(order, (*order[1:], None)):
        if name in MARKS:
            at += MARKS[name][2]
        else:
            _, start, size = MARKS[after] if after else (1, 0, 0)
            end = output.index(SENTINELS[start : start + size], at) if after else len(output)
            found[name] = (0, at, end - at)
            at = end
    return [found[name] for name in PIECES]


def _chars(piece: Descriptor, data: np.ndarray) -> int:
    """Code points behind a descriptor: bytes that do not continue a character."""
    _, start, length = piece
    return int(np.count_nonzero((data[start : start + length] & 0xC0) != 0x80))


def _texts(column: pa.Array) -> Iterator[memoryview]:
    """Every text's bytes in the column's own buffer."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    view = memoryview(data) if data is not None else memoryview(b"")
    valid = column.is_valid().to_pylist()
    for i, ok in enumerate(valid):
        yield view[at[i] : at[i + 1]] if ok else view[:0]


_LONG, _TEXT = (T.LongType(), pa.int64()), (T.StringType(), pa.string())
_DIGEST = {"n": _LONG, "form": _TEXT, "prefix_chars": _LONG, "middle_chars": _LONG, "output_sha256": _TEXT, "restored_sha256": _TEXT}
_EXAMPLE = {"form": _TEXT, "output": _TEXT}


def _schema(kept: list[T.StructField], made: dict) -> T.StructType:
    return T.StructType([*kept, *(T.StructField(name, kind) for name, (kind, _) in made.items())])


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters: int) -> DataFrame:
    """Per row: id, ``n`` units, form, lengths and the hashes of the output and
    of the text restored from it."""
    rows = docs.select(F.col(id_col).alias("kept"), F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut_up(batches):
            out: list[tuple] = []
            for i, text in zip(batch.column(1).to_pylist(), _texts(batch.column(2))):
                e = example(i, text, **parameters)
                data, pieces = np.frombuffer(text, np.uint8), e.arranged()
                output = b"".join(read(pieces, text))
                own = (None, None) if e.form == "plain" else (_chars(e.prefix, data), _chars(e.middle, data))
                back = digest_of(restore(output, e.form), memoryview(output))
                out.append((e.n, e.form, *own, digest_of(pieces, text), back))
            yield _batch([batch.column(0)], [id_col], out, _DIGEST)

    return rows.mapInArrow(run, _schema([docs.schema[id_col]], _DIGEST))


def _batch(kept: list[pa.Array], names: list[str], rows: list[tuple], made: dict) -> pa.RecordBatch:
    values = zip(*rows) if rows else [[]] * len(made)
    columns = [pa.array(list(c), kind) for c, (_, kind) in zip(values, made.values())]
    return pa.RecordBatch.from_arrays([*kept, *columns], names=[*names, *made])


def _cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def transformed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters: int) -> DataFrame:
    """The rows with ``form`` and ``output``, the arranged text."""
    schema = docs.schema
    if clash := {"form", "output"} & set(schema.names):
        raise ValueError(f"the input already has the columns {sorted(clash)}")
    places = {name: i for i, name in enumerate(schema.names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut_up(batches):
            ids = pc.cast(batch.column(places[id_col]), pa.int64()).to_pylist()
            out = []
            for i, text in zip(ids, _texts(batch.column(places[text_col]))):
                e = example(i, text, **parameters)
                out.append((e.form, b"".join(read(e.arranged(), text)).decode()))
            yield _batch(batch.columns, batch.schema.names, out, _EXAMPLE)

    return docs.mapInArrow(run, _schema(schema.fields, _EXAMPLE))


def restored(examples: DataFrame, out_col: str = "restored") -> DataFrame:
    """Rows of ``transformed`` with the text rebuilt from output and form alone."""
    schema = examples.schema
    if out_col in schema.names:
        raise ValueError(f"the input already has the column {out_col}")
    places = {name: i for i, name in enumerate(schema.names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut_up(batches):
            forms, out = batch.column(places["form"]).to_pylist(), []
            for form, output in zip(forms, _texts(batch.column(places["output"]))):
                out.append((b"".join(read(restore(bytes(output), form), output)).decode(),))
            yield _batch(batch.columns, batch.schema.names, out, {out_col: _TEXT})

    return examples.mapInArrow(run, _schema(schema.fields, {out_col: _TEXT}))
