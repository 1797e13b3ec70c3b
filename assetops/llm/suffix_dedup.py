"""Removal of byte strings that occur earlier, by families of sparse suffix arrays.

Every 100-byte string of a text picks one anchor, the least of its 32-byte grams
under a hash order, so equal strings pick equal anchors at equal offsets.  Only
suffixes that begin at anchors (about 3 % of all) are indexed; each carries the
bytes of the strings that picked it.

Documents come in batches.  First each batch sends its distinct anchors, 64-bit
hashes, to their hash ranges.  A range keeps a logarithmic family of sorted arrays:
a new batch is merge-scanned against every level for equal anchors, becomes a
level itself, and levels of about equal size merge, so an anchor is moved a
logarithmic number of times.  One bit an anchor goes back: whether another batch
has it.  Then a batch sends the bytes of the suffixes whose anchors occur again,
and only these are compared, whole suffixes by fingerprint and then string by
string; only the earliest occurrence of a string is not removed.

Inside a batch equal suffixes are sent once, so a passage that many documents
share costs a range one row per batch and distinct surrounding.  The number of
ranges follows ``spark.sql.shuffle.partitions``.

Suffixes are taken as equal by their anchor's hash and a 64-bit fingerprint of
all their bytes, strings by 128-bit fingerprints.  Texts are UTF-8; a NULL text is
empty; nothing of a text under ``length`` bytes is removed.  NULL ids come after
all others; rows that repeat an id are ordered by batch and row; an empty table
gives an empty result; other columns are not read.  Batches are named by a hash
of their rows: an input that changes between the two passes is an error.  Of
batches with the same rows, and so of one name, one is scanned; the others, which
come after it, lose every string.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetops.llm.shingles import give_back, mix, ranges
from assetops.llm.wordtable import pack, unpack

LENGTH, GRAM = 100, 32
BATCH_BYTES = 8 << 20
SEGMENT = 1 << 19  # bytes of a text that are hashed at once; under 2 ** 20
GROUP = 1 << 15  # bytes of shorter texts that are hashed together: arrays of 8 bytes each stay near the CPU
RANGES = 12  # hash ranges per shuffle partition
_LAST = (1 << 63) - 1  # stands for a NULL id
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
_powers: dict[tuple, np.ndarray] = {}

_SUFFIXES_SQL = "part int, batch bigint, anchors binary, fields binary, texts binary"
_SUFFIXES = pa.schema([("part", pa.int32()), ("batch", pa.int64()), ("anchors", pa.binary()), ("fields", pa.binary()), ("texts", pa.binary())])
_ANCHORS_SQL = "part int, batch bigint, anchors binary"
_ANCHORS = pa.schema([("part", pa.int32()), ("batch", pa.int64()), ("anchors", pa.binary())])
_BITS_SQL = "batch bigint, part int, bits binary"
_BITS = pa.schema([("batch", pa.int64()), ("part", pa.int32()), ("bits", pa.binary())])
_HITS_SQL = "batch bigint, hits binary"
_HITS = pa.schema([("batch", pa.int64()), ("hits", pa.binary())])
_BATCHES_SQL = "batch bigint, ids array<bigint>, lens binary, texts binary"
_BATCHES = pa.schema([("batch", pa.int64()), ("ids", pa.list_(pa.int64())), ("lens", pa.binary()), ("texts", pa.binary())])


class Batch:
    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.texts: list[bytes] = []
        self.size, self.hash = 0, xxhash.xxh64()

    def add(self, row_id: int | None, text: bytes) -> None:
        self.ids.append(row_id)
        self.texts.append(text)
        self.size += len(text) + 64
        self.hash.update(struct.pack("<?qq", row_id is None, row_id or 0, len(text)))
        self.hash.update(text)

    @property
    def name(self) -> int:
        return struct.unpack("<q", self.hash.digest())[0]


def batches_of(rows: Iterator[pa.RecordBatch]) -> Iterator[Batch]:
    out = Batch()
    for batch in rows:
        for row_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            out.add(row_id, (text.as_py() or "").encode("utf-8", "surrogatepass"))
            if out.size >= BATCH_BYTES:
                yield out
                out = Batch()
                give_back()
    if out.ids:
        yield out
    out = None
    give_back()


def _power(base: np.uint64, n: int, inverse: bool) -> np.ndarray:
    key = (int(base), inverse)
    if key not in _powers or len(_powers[key]) < n:
        p = np.full(n, pow(int(base), -1, 1 << 64) if inverse else base, np.uint64)
        p[0] = 1
        _powers[key] = np.cumprod(p, dtype=np.uint64)
    return _powers[key][:n]


class Prints:
    """Fingerprints of substrings of ``data`` from prefix sums.  ``place`` is each
    byte's place in its own text, if substrings stay inside texts: the powers
    are then as many as the longest text has bytes."""

    def __init__(self, data: np.ndarray, which: int = 0, place: np.ndarray | None = None):
        base = _BASES[which]
        n = len(data) + 1 if place is None else int(place.max(initial=0)) + 1
        self.place, self.back, power = place, _power(base, n, True), _power(base, n, False)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        for at in range(0, len(data), GROUP):
            end = min(at + GROUP, len(data))
            own = data[at:end].astype(np.uint64)
            own += np.uint64(1)
            own *= power[at:end] if place is None else power[place[at:end]]
            np.cumsum(own, out=own)
            np.add(own, self.sums[at], out=self.sums[at + 1 : end + 1])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts if self.place is None else self.place[starts]])

    def runs(self, width: int) -> np.ndarray:
        """Of all substrings of ``width`` bytes, without ``place``."""
        out = self.sums[width:] - self.sums[:-width]
        out *= self.back[: len(out)]
        return mix(out)


def _segments(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (text number, offset, bytes) of at most about ``GROUP`` bytes; a text
    longer than ``SEGMENT`` is cut into parts that share ``length - 1`` bytes."""
    group, size = [], 0
    for i, text in enumerate(texts):
        at = 0
        while len(text) - at >= length:
            part = text[at : at + SEGMENT]
            if group and size + len(part) > GROUP:
                yield group
                group, size = [], 0
            group.append((i, at, part))
            size += len(part)
            at += max(1, len(part) - length + 1)
    if group:
        yield group


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by runs of doubled width."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def suffixes(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """The indexed suffixes of a batch: ``anchor`` hash, text number ``row``, the
    first string's ``start`` in it, the number of strings ``n``, a ``print`` of
    all their bytes and of their place, and the anchor's ``offset``."""
    out: dict[str, list[np.ndarray]] = {c: [] for c in ("anchor", "row", "start", "n", "print", "offset")}
    for group in _segments(texts, length):
        data = np.frombuffer(b"".join(part for *_, part in group), np.uint8)
        lens = np.array([len(part) for *_, part in group])
        ends = np.cumsum(lens)
        begins = ends - lens
        prints = Prints(data)
        hashes = prints.runs(gram)
        low = np.uint64((1 << 20) - 1)
        least = hashes & ~low
        least |= np.arange(len(least), dtype=np.uint64)
        least = _least(least, length - gram + 1)  # the leftmost of equal grams
        new = np.ones(len(least), bool)
        np.not_equal(least[1:], least[:-1], out=new[1:])
        new[begins] = True
        new[ranges(ends[:-1] - length + 1, np.full(len(ends) - 1, length - 1))] = False  # strings of two texts
        start = np.flatnonzero(new)
        owner = np.searchsorted(ends, start, "right")
        end = ends[owner] - length + 1
        n = np.minimum(np.append(start[1:], end[-1]), end) - start
        anchor = (least[start] & low).astype(np.int64)
        offset = anchor - start
        out["anchor"].append(hashes[anchor])
        out["row"].append(np.array([g[0] for g in group])[owner])
        out["start"].append(start - begins[owner] + np.array([g[1] for g in group])[owner])
        out["n"].append(n)
        out["offset"].append(offset)
        out["print"].append(mix(prints.of(start, start + n + length - 1) ^ (offset * 256 + n).astype(np.uint64)))
    return {c: np.concatenate(v) if v else np.zeros(0, np.uint64 if c in ("anchor", "print") else np.int64) for c, v in out.items()}


def _order(ids: list[int | None]) -> np.ndarray:
    return np.array([_LAST if i is None else i for i in ids], np.int64)


def _earliest(s: dict[str, np.ndarray], rank: np.ndarray) -> np.ndarray:
    """True for the earliest of equal suffixes, by ``rank``."""
    out = np.ones(len(rank), bool)
    by = np.argsort(s["print"])
    same = s["print"][by[1:]] == s["print"][by[:-1]]
    if same.any():
        some = by[np.append(False, same) | np.append(same, False)]
        some = some[np.lexsort((rank[some], s["print"][some], s["anchor"][some]))]
        a, p = s["anchor"][some], s["print"][some]
        out[some[1:][(a[1:] == a[:-1]) & (p[1:] == p[:-1])]] = False
    return out


def _ranked(*keys: np.ndarray) -> np.ndarray:
    """Position in the order of the keys, the last key first."""
    out = np.empty(len(keys[0]), np.int64)
    out[np.lexsort(keys)] = np.arange(len(out))
    return out


def _sent(batch: Batch, length: int, gram: int) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """A batch's suffixes and which of them are sent: the earliest of equal ones."""
    s = suffixes(batch.texts, length, gram)
    # Starts take 40 bits at most.
    rank = (_ranked(np.arange(len(batch.ids)), _order(batch.ids))[s["row"]] << 40) + s["start"]
    return s, _earliest(s, rank)


def _part(anchors: np.ndarray, parts: int) -> np.ndarray:
    """Anchors are least hashes, so most are small: their ranges are of the hash
    mixed again."""
    return (mix(anchors) >> np.uint64(32)).astype(np.int64) * parts >> 32


def _known(anchors: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct anchors by range, bounds of the ranges)."""
    found = np.unique(anchors)
    part = _part(found, parts)
    by = np.argsort(part, kind="stable")
    return found[by], np.searchsorted(part[by], np.arange(parts + 1))


def _anchor_rows(parts: int, length: int, gram: int):
    """First pass: every batch's distinct anchors, by hash range."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches_of(rows):
                s, sent = _sent(batch, length, gram)
                found, bounds = _known(s["anchor"][sent], parts)
                own = [(p, found[a:b]) for p, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if b > a]
                columns = [[p for p, _ in own], [batch.name] * len(own), [pack(np.diff(f, prepend=np.uint64(0))) for _, f in own]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ANCHORS)], schema=_ANCHORS)

    return run


def _met(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which of a batch's anchors another batch has, one bit each; rows come sorted
    by range and batch."""
    part, held = None, []

    def ready() -> pa.RecordBatch:
        bounds = np.cumsum([0] + [len(a) for _, a in held])
        family = Family(bounds[-1])
        for at, (_, anchors) in zip(bounds, held):
            family.add(anchors, np.arange(at, at + len(anchors)))
        bits = [np.packbits(family.met[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
        columns = [[name for name, _ in held], [part] * len(held), [pack(np.frombuffer(x, np.uint8)) for x in bits]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _BITS)], schema=_BITS)

    for rb in rows:
        for p, batch, anchors in zip(*(c.to_pylist() for c in rb.columns)):
            if p != part and held:
                yield ready()
                held = []
            if p == part and held and held[-1][0] == batch:
                continue  # an equal batch
            part = p
            held.append((batch, np.cumsum(unpack(anchors, np.uint64), dtype=np.uint64)))
    if held:
        yield ready()


def _rebuilt(ids: list[int | None], lens: bytes, blob: bytes) -> Batch:
    data, ends = zstandard.ZstdDecompressor().decompress(blob), np.cumsum(unpack(lens).astype(np.int64))
    batch = Batch()
    for row_id, a, b in zip(ids, np.concatenate([[0], ends[:-1]]), ends):
        batch.add(row_id, data[a:b])
    return batch


def _suffix_rows(parts: int, length: int, gram: int):
    """Second pass: the suffixes of a batch whose anchor occurs again, with their bytes."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0:
            raise ValueError("the input changed between two passes: write it to a table first")
        compress = zstandard.ZstdCompressor(level=3).compress
        # Of equal batches one is scanned.
        batch = _rebuilt(*(left.column(c)[0].as_py() for c in ("ids", "lens", "texts")))
        out: list[tuple] = []
        with np.errstate(over="ignore"):
            s, sent = _sent(batch, length, gram)
            found, bounds = _known(s["anchor"][sent], parts)
            again = np.zeros(len(found), bool)
            answers = dict(zip(right.column("part").to_pylist(), right.column("bits").to_pylist()))
            if set(answers) != set(np.flatnonzero(np.diff(bounds)).tolist()):
                raise ValueError("the input changed between two passes: write it to a table first")
            for p, bits in answers.items():
                n = bounds[p + 1] - bounds[p]
                again[bounds[p] : bounds[p + 1]] = np.unpackbits(unpack(bits, np.uint8), count=n).astype(bool)
            by = np.argsort(found, kind="stable")
            place = by[np.searchsorted(found[by], s["anchor"][sent])]
            # So do anchors that the batch itself has in several surroundings.
            again |= np.bincount(place, minlength=len(found)) > 1
            keep = np.flatnonzero(sent)[again[place]]
            part = _part(s["anchor"][keep], parts)
            by = np.lexsort((s["anchor"][keep], part))
            keep, part = keep[by], part[by]
            data = np.frombuffer(b"".join(batch.texts), np.uint8)
            lens = np.array([len(t) for t in batch.texts])
            begin, order = np.cumsum(lens) - lens, _order(batch.ids)
            bounds = np.searchsorted(part, np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(bounds)).tolist():
                e = keep[bounds[p] : bounds[p + 1]]
                n = s["n"][e]
                texts = data[ranges(begin[s["row"][e]] + s["start"][e], n + length - 1)]
                fields = np.array([order[s["row"][e]], s["row"][e], s["start"][e], n, s["offset"][e]], np.int64)
                anchors = np.diff(s["anchor"][e], prepend=np.uint64(0))
                out.append((p, batch.name, pack(anchors), pack(fields.ravel()), compress(texts.tobytes())))
        columns = zip(*out) if out else [[]] * len(_SUFFIXES)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SUFFIXES)], schema=_SUFFIXES)

    return run


class Family:
    """Sorted arrays of (anchor, suffix number), about halving in size."""

    def __init__(self, suffixes: int) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.met = np.zeros(suffixes, bool)  # suffixes that met an equal anchor

    def add(self, anchors: np.ndarray, numbers: np.ndarray) -> None:
        """A new batch, sorted by anchor."""
        same = np.flatnonzero(anchors[1:] == anchors[:-1])
        self.met[numbers[same]] = self.met[numbers[same + 1]] = True
        for level, known in self.levels:
            left, right = np.searchsorted(level, anchors), np.searchsorted(level, anchors, "right")
            hit = right > left
            self.met[numbers[hit]] = True
            # An anchor that the batch has many times is one run of the level.
            left, once = np.unique(left[hit], return_index=True)
            self.met[known[ranges(left, right[hit][once] - left)]] = True
        while self.levels and len(self.levels[-1][0]) <= 2 * len(anchors):
            level, known = self.levels.pop()
            anchors, numbers = np.concatenate([level, anchors]), np.concatenate([known, numbers])
            by = np.argsort(anchors, kind="stable")
            anchors, numbers = anchors[by], numbers[by]
        self.levels.append((anchors, numbers))


def _places(spans: np.ndarray) -> np.ndarray:
    """Each byte's place in its own suffix."""
    return ranges(np.zeros(len(spans), np.int64), spans).astype(np.int32)


def _covered(held: list[tuple[int, np.ndarray, np.ndarray, bytes]], length: int) -> Iterator[tuple[int, np.ndarray]]:
    """(batch, [row, start, count] of removed strings) of one range."""
    anchor, fields, texts, owner = [], [], [], []
    decompress = zstandard.ZstdDecompressor().decompress
    for i, (_, anchors, f, blob) in enumerate(held):
        anchor.append(anchors)
        fields.append(f)
        owner.append(np.full(len(anchors), i))
        texts.append(np.frombuffer(decompress(blob), np.uint8))
    order, row, start, n, offset = np.concatenate(fields, axis=1)
    owner, data = np.concatenate(owner), np.concatenate(texts)
    name = np.array([b for b, *_ in held], np.int64)[owner]
    rank = _ranked(start, row, name, order)
    spans = n + length - 1
    at = np.cumsum(spans) - spans
    first = Prints(data, 0, _places(spans))
    s = {"anchor": np.concatenate(anchor), "print": mix(first.of(at, at + spans) ^ (offset * 256 + n).astype(np.uint64))}
    earliest = _earliest(s, rank)
    # Equal suffixes: all strings of all but the earliest are removed.
    hits = [(owner[~earliest], row[~earliest], start[~earliest], n[~earliest])]
    # The others string by string, where an anchor has several.
    left = np.flatnonzero(earliest)
    left = left[np.argsort(s["anchor"][left], kind="stable")]
    a = s["anchor"][left]
    several = np.concatenate([[False], a[1:] == a[:-1]]) | np.concatenate([a[1:] == a[:-1], [False]])
    left = left[several]
    if len(left):
        suffix = np.repeat(left, n[left])
        inside = ranges(np.zeros(len(left), np.int64), n[left])
        data, place = data[ranges(at[left], spans[left])], _places(spans[left])
        from_ = np.repeat(np.cumsum(spans[left]) - spans[left], n[left]) + inside
        del first
        one, two = (Prints(data, k, place).of(from_, from_ + length) for k in (0, 1))
        by = np.lexsort((inside, rank[suffix], two, one))
        again = np.concatenate([[False], (one[by][1:] == one[by][:-1]) & (two[by][1:] == two[by][:-1])])
        gone = by[again]
        hits.append((owner[suffix[gone]], row[suffix[gone]], start[suffix[gone]] + inside[gone], np.ones(len(gone), np.int64)))
    owner, *found = (np.concatenate(c) for c in zip(*hits))
    for i in np.unique(owner):
        yield held[i][0], np.array([c[owner == i] for c in found], np.int64)


def _scanned(length: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []

        def ready() -> Iterator[pa.RecordBatch]:
            for batch, found in _covered(held, length):
                yield pa.RecordBatch.from_arrays([pa.array([batch], pa.int64()), pa.array([pack(found.ravel())], pa.binary())], schema=_HITS)

        with np.errstate(over="ignore"):
            for rb in rows:
                for p, batch, anchors, fields, texts in zip(*(c.to_pylist() for c in rb.columns)):
                    if p != part and held:
                        yield from ready()
                        held = []
                    if p == part and held and held[-1][0] == batch:
                        continue  # an equal batch: ``cut_batch`` removes its strings
                    part = p
                    f = unpack(fields, np.int64).reshape(5, -1)
                    held.append((batch, np.cumsum(unpack(anchors, np.uint64), dtype=np.uint64), f, texts))
            if held:
                yield from ready()

    return run


def _batch_rows(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compress = zstandard.ZstdCompressor(level=3).compress
    for batch in batches_of(rows):
        row = [[batch.name], [batch.ids], [pack(np.array([len(t) for t in batch.texts], np.uint32))], [compress(b"".join(batch.texts))]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, _BATCHES)], schema=_BATCHES)


def kept_bytes(text: bytes, starts: np.ndarray, counts: np.ndarray, length: int) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, maximal removed runs)."""
    if not len(starts):
        return text, 0, 0
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + counts + length - 1, -1)
    gone = np.cumsum(change)[:-1] > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), spans


def deduped(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, texts: bool = True
) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and,
    if asked for, the bytes that are ``kept``."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
    parts = RANGES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts_of = rows.mapInArrow(_batch_rows, _BATCHES_SQL)
    anchors = rows.mapInArrow(_anchor_rows(parts, length, gram), _ANCHORS_SQL)
    bits = anchors.repartition(parts, "part").sortWithinPartitions("part", "batch").mapInArrow(_met, _BITS_SQL)
    sent = texts_of.groupBy("batch").cogroup(bits.groupBy("batch")).applyInArrow(_suffix_rows(parts, length, gram), _SUFFIXES_SQL)
    ranges = sent.repartition(parts, "part").sortWithinPartitions("part", "batch")
    hits = ranges.mapInArrow(_scanned(length), _HITS_SQL)

    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if texts else [])]
    schema = ", ".join(f"`{c}` {t}" for c, t in zip(names, ["bigint", "bigint", "bigint", "bigint", "string", "binary"]))

    def cut_batch(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0:
            raise ValueError("the input changed between two passes: write it to a table first")
        found = [unpack(h, np.int64).reshape(3, -1) for h in right.column("hits").to_pylist()]
        out: list[tuple] = []
        with np.errstate(over="ignore"):
            for twin, (ids, lens, blob) in enumerate(zip(*(left.column(c).to_pylist() for c in ("ids", "lens", "texts")))):
                batch = _rebuilt(ids, lens, blob)
                # Equal suffixes of one batch were not sent: all but the earliest go.
                # Of equal batches the first has the hits; the others repeat all it has.
                s, earliest = _sent(batch, length, gram)
                gone = ~earliest if twin == 0 else np.ones(len(earliest), bool)
                own = [np.array([s[c][gone] for c in ("row", "start", "n")], np.int64)]
                row, start, count = np.concatenate(own + (found if twin == 0 else []), axis=1)
                by = np.argsort(row, kind="stable")
                row, start, count = row[by], start[by], count[by]
                bounds = np.searchsorted(row, np.arange(len(ids) + 1))
                for i, text in enumerate(batch.texts):
                    own = slice(bounds[i], bounds[i + 1])
                    kept, removed, spans = kept_bytes(text, start[own], count[own], length)
                    out.append((ids[i], len(text), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
        columns = list(zip(*out))[: len(names)]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return texts_of.groupBy("batch").cogroup(hits.groupBy("batch")).applyInArrow(cut_batch, schema)
