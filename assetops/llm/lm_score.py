"""Language-model scores by logistic mixing of context bit predictors.

A text is its UTF-8 bytes and one end symbol, each read as eight binary
decisions.  Four predictors, of the last one to four bytes, count the ones and
zeros that followed each context and the bits before, in all training documents.
A mixer adds the predictors' log odds with weights chosen by a gate (the bit and
how much the long contexts have seen).  The weights are learned online, in passes
over the training events in which every event is predicted without its own
count; parallel passes are averaged.  A last table, adapted to the mixer's
output under the bits before, refines the probability.  A text's score is the
log10 of its probability.

Every context has counts of its own, at any size of the corpus.  Events are
gathered as distinct byte grams with their counts.  A chunk of documents sends
each of its grams once to the part that the gram's last three context bytes
name; a part has all that followed these and longer contexts and scores each of its
grams once; then the chunks' grams pass their part again, one chunk at a time, and
take their scores back.  No row and no task holds the grams of all chunks.  The counts after one and two
bytes travel to all tasks: at most 2^24 keys, as many as there are three bytes
in a row, whatever the corpus.

Beside it stands the base score, by token counts with one added (see
``wordtable``).  A NULL text is empty: the end token and the end symbol only.
A NULL id is a training document.  Rows that repeat an id are scored one by
one and each counts in training; without training documents every count is 0;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetops.llm import wordtable
from assetops.llm.shingles import mix
from assetops.storage import cut

ORDERS = (1, 2, 3, 4)
NEAR = 2  # orders whose counts travel to all tasks
PARTS = 4  # parts of the grams per shuffle partition
STEP = 10_000  # grams whose bits the mixer learns in turn
END = 255  # no UTF-8 text has this byte
ROUNDS = 2  # passes of the mixer
RATE = 0.02
BLOCK = 1 << 20  # bytes that are scored at once
BUCKETS = 33  # of the refining table, over log odds from -8 to 8
_GATES = 8 * 5 * 5
_SEGMENT = 1 << 16


def held_out(row_id: int | None) -> bool:
    return row_id is not None and zlib.crc32(str(row_id).encode()) % 7 == 2


def training(row_id: int | None) -> bool:
    return not held_out(row_id)


def tokens(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, and one end."""
    return [*text.encode("utf-8", "surrogatepass").lower().split(), b""]


def _encoded(texts: list[str] | list[bytes]) -> list[bytes]:
    return [t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass") for t in texts]


def grams(texts: list[str] | list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(four bytes before and the byte itself as one number, bounds per text)."""
    encoded = _encoded(texts)
    gap, end = bytes(4), bytes([END])
    data = np.frombuffer(b"".join(gap + e + end for e in encoded), np.uint8).astype(np.int64)
    packed = data.copy()
    for back in range(1, 5):
        packed[back:] |= data[:-back] << (8 * back)
    lens = np.array([len(e) + 1 for e in encoded], np.int64)
    bounds = np.concatenate([[0], np.cumsum(lens)])
    keep = np.repeat(4 * np.arange(1, len(lens) + 1), lens) + np.arange(bounds[-1])
    return packed[keep], bounds


def blocks(texts: list) -> Iterator[list]:
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK or i == len(texts) - 1:
            yield texts[at : i + 1]
            at, size = i + 1, 0


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys ascending, their sums)."""
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, n, len(found)).astype(np.int64)


def _packed(ascending: np.ndarray) -> bytes:
    return wordtable.pack(np.diff(ascending, prepend=0))


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(wordtable.unpack(data, np.int64))


_GRAMS = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("grams", pa.binary()), ("uses", pa.binary())])
_GRAMS_SQL = "part int, chunk bigint, grams binary, uses binary"
_PARTS = pa.schema([("part", pa.int32()), ("grams", pa.binary()), ("n", pa.binary())])
_PARTS_SQL = "part int, grams binary, n binary"
_FOLD = 1 << 20  # grams that wait before they are added to a part's


def _gram_rows(parts: int):
    """The distinct grams of every chunk, by part; ``uses`` are those in training."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in wordtable.chunks(batches, tokens):
            found, at = [], 0
            for block in blocks(chunk.texts):
                gram, bounds = grams(block)
                counted = np.repeat([training(i) for i in chunk.ids[at : at + len(block)]], np.diff(bounds))
                found.append(_summed(gram, counted))
                at += len(block)
            gram, uses = _summed(*(np.concatenate(c) for c in zip(*found)))
            with np.errstate(over="ignore"):
                spread = mix((gram >> 8 & 0xFFFFFF).astype(np.uint64)) >> np.uint64(32)
            part = spread.astype(np.int64) * parts >> 32
            by = np.argsort(part, kind="stable")
            bounds = np.searchsorted(part[by], np.arange(parts + 1))
            own = [(p, by[a:b]) for p, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if b > a]
            columns = [[p for p, _ in own], [chunk.name] * len(own), [_packed(gram[e]) for _, e in own], [wordtable.pack(uses[e]) for _, e in own]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _GRAMS)], schema=_GRAMS)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per part: its distinct grams and their counts; rows come sorted by
    part.  What is held follows the part's distinct grams, not its chunks."""
    part, waiting, size = None, [], 0
    gram, n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def folded() -> tuple[np.ndarray, np.ndarray]:
        found, uses = zip((gram, n), *waiting)
        return _summed(np.concatenate(found), np.concatenate(uses))

    def ready() -> pa.RecordBatch:
        row = [[part], [_packed(gram)], [wordtable.pack(n)]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, _PARTS)], schema=_PARTS)

    for batch in batches:
        for p, found, uses in zip(*(batch.column(c).to_pylist() for c in ("part", "grams", "uses"))):
            if p != part and part is not None:
                gram, n = folded()
                yield ready()
                gram, n, waiting, size = gram[:0], n[:0], [], 0
            part = p
            waiting.append((_unpacked(found), wordtable.unpack(uses, np.int64)))
            size += len(waiting[-1][0])
            if size >= max(_FOLD, len(gram)):
                gram, n = folded()
                waiting, size = [], 0
    if part is not None:
        gram, n = folded()
        yield ready()


def _parts(spark) -> int:
    return PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))


def gram_rows(rows: DataFrame) -> DataFrame:
    """The distinct grams of every chunk of (_id, _text), by part, written once for
    the two passes over them."""
    return cut(rows.mapInArrow(_gram_rows(_parts(rows.sparkSession)), _GRAMS_SQL))


def gram_parts(sent: DataFrame) -> DataFrame:
    """The distinct grams of every part with their counts."""
    dealt = sent.select("part", "grams", "uses").repartition(_parts(sent.sparkSession), "part")
    return cut(dealt.sortWithinPartitions("part").mapInArrow(_merged, _PARTS_SQL))


class Counts:
    """What followed each context of one order in training, from grams and counts."""

    def __init__(self, order: int, gram: np.ndarray, n: np.ndarray):
        self.order = order
        used = n > 0
        self.keys, totals = _summed(self.key(gram[used]), n[used])
        self.until = np.concatenate([[0], np.cumsum(totals)])

    def __getstate__(self) -> dict:
        return {"order": self.order, "keys": _packed(self.keys), "until": _packed(self.until)}

    def __setstate__(self, state: dict) -> None:
        self.order, self.keys, self.until = state["order"], _unpacked(state["keys"]), _unpacked(state["until"])

    def key(self, gram: np.ndarray) -> np.ndarray:
        return gram & ((1 << (8 * self.order + 8)) - 1)

    def of(self, gram: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
        """(zeros, ones) after each gram's context and the first ``bit`` bits of its byte."""
        left = self.key(gram) >> (8 - bit) << (8 - bit)
        ends = (left, left + (1 << (7 - bit)), left + (1 << (8 - bit)))
        low, middle, high = (self.until[np.searchsorted(self.keys, e)] for e in ends)
        return middle - low, high - middle


def _events(gram: np.ndarray, tables: list[Counts]) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[tuple]]]:
    """For each bit: (number, ones, bits before, (zeros, ones) counted per order)."""
    byte = gram & 255
    for bit in range(8):
        before = (byte | 256) >> (8 - bit)  # a leading one, then the bits before
        yield bit, (byte >> (7 - bit)) & 1, before, [t.of(gram, bit) for t in tables]


def _dense(arrays: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Numbered arrays as compressed segments, zero segments left out."""
    compress = zstandard.ZstdCompressor(level=3).compress
    for number, array in arrays:
        for s, at in enumerate(range(0, len(array), _SEGMENT)):
            part = array[at : at + _SEGMENT]
            if part.any():
                row = [pa.array([number * 4096 + s], pa.int32()), pa.array([compress(part.tobytes())], pa.binary())]
                yield pa.RecordBatch.from_arrays(row, names=["segment", "counts"])


_DENSE_SQL = "segment int, counts binary"


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    decompress = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for s, counts in zip(*(c.to_pylist() for c in batch.columns)):
            found = np.frombuffer(decompress(counts), np.float64)
            total[s] = total[s] + found if s in total else found
    compress = zstandard.ZstdCompressor(level=3).compress
    out = [pa.array(total.keys(), pa.int32()), pa.array([compress(c.tobytes()) for c in total.values()], pa.binary())]
    yield pa.RecordBatch.from_arrays(out, names=["segment", "counts"])


def _gathered(partial: DataFrame, shapes: list[int]) -> list[np.ndarray]:
    """Sums of numbered arrays over all tasks; their sizes are parameters."""
    out = [np.zeros(n) for n in shapes]
    decompress = zstandard.ZstdDecompressor().decompress
    for s, counts in partial.repartition("segment").mapInArrow(_added, _DENSE_SQL).collect():
        part, at = np.frombuffer(decompress(bytes(counts)), np.float64), s % 4096 * _SEGMENT
        out[s // 4096][at : at + len(part)] = part
    return out


class Model:
    """Counts of the near orders, mixer weights per gate, and the refining table."""

    def __init__(self, near: list[Counts]):
        self.near = near
        self.far: list[Counts] = []
        self.weights = np.full((_GATES, len(ORDERS) + 1), 0.3, np.float32)
        self.weights[:, -1] = 0
        self.refined: np.ndarray | None = None

    def tables(self, gram: np.ndarray, n: np.ndarray) -> list[Counts]:
        """Counts per order, of a part that has ``gram`` ``n`` times."""
        return self.near + [Counts(order, gram, n) for order in ORDERS[NEAR:]]

    def inputs(self, bit: int, ones: np.ndarray, counted: list[tuple], own: int) -> tuple[np.ndarray, np.ndarray]:
        """(log odds of a one per predictor and a bias, gate), without ``own``
        of the event's own count."""
        x = np.empty((len(ones), len(ORDERS) + 1), np.float32)
        x[:, -1] = 0.3
        seen = []
        for o, (zeros, ones_) in enumerate(counted):
            zero, one = zeros - own * (1 - ones), ones_ - own * ones
            x[:, o] = np.clip(np.log((one + 0.2) / (zero + 0.2)), -8, 8)
            seen.append(np.minimum(np.log2(zero + one + 1) / 2, 4).astype(np.int64))
        return x, bit * 25 + seen[-1] * 5 + seen[-2]

    def mixed(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return np.clip(np.einsum("ij,ij->i", x, self.weights[gate]), -12, 12)

    def probability(self, odds: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Of a one: the mixer's, averaged with the refining table's."""
        p = 1 / (1 + np.exp(-odds.astype(np.float64)))
        if self.refined is not None:
            p = (p + self.refined[before * BUCKETS + bucket(odds)]) / 2
        return np.clip(p, 1e-6, 1 - 1e-6)

    def log10(self, gram: np.ndarray, tables: list[Counts] | None = None) -> np.ndarray:
        """log10 of the probability of each gram's byte after its context."""
        out = np.zeros(len(gram))
        for bit, ones, before, counted in _events(gram, tables or self.near + self.far):
            x, gate = self.inputs(bit, ones, counted, 0)
            p = self.probability(self.mixed(x, gate), before)
            out += np.log10(np.where(ones == 1, p, 1 - p))
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        """(log10 probability, bytes) of every text, of a model with all counts."""
        return text_scores(texts, lambda gram: self.log10(gram))


def text_scores(texts: list[str] | list[bytes], log10: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """(log10 probability, bytes) of every text, from that of distinct grams."""
    scores, sizes = [], []
    for block in blocks(texts):
        gram, bounds = grams(block)
        distinct, at = np.unique(gram, return_inverse=True)
        scores.append(np.add.reduceat(log10(distinct)[at], bounds[:-1]))
        sizes.append(np.diff(bounds) - 1)
    return np.array([np.concatenate(scores), np.concatenate(sizes)])


def bucket(odds: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((odds + 8) * ((BUCKETS - 1) / 16)), 0, BUCKETS - 1).astype(np.int64)


def _trained(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[Counts]]]:
    """(grams, counts, tables) of the parts' training grams, spread, in steps."""
    for batch in batches:
        for grams_, n_ in zip(batch.column("grams").to_pylist(), batch.column("n").to_pylist()):
            gram, n = _unpacked(grams_), wordtable.unpack(n_, np.int64)
            tables = model.tables(gram, n)
            with np.errstate(over="ignore"):
                by = np.argsort(mix(gram.astype(np.uint64)), kind="stable")
            by = by[n[by] > 0]
            for at in range(0, len(by), STEP):
                e = by[at : at + STEP]
                yield gram[e], n[e].astype(np.float64), tables


def _learned(model: Model):
    """One online pass: the weights after it and their mass, per gate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, mass = model.weights.astype(np.float64), np.zeros(_GATES)
        for gram, n, tables in _trained(model, batches):
            for bit, ones, _, counted in _events(gram, tables):
                x, gate = model.inputs(bit, ones, counted, 1)
                for at in range(0, len(gram), 4096):
                    xs, g, w = x[at : at + 4096], gate[at : at + 4096], n[at : at + 4096]
                    odds = np.clip(np.einsum("ij,ij->i", xs, weights[g]), -12, 12)
                    error = ones[at : at + 4096] - 1 / (1 + np.exp(-odds))
                    seen = np.bincount(g, w, _GATES)
                    for j in range(xs.shape[1]):
                        weights[:, j] += RATE * np.bincount(g, w * error * xs[:, j], _GATES) / np.maximum(seen, 1) * np.minimum(seen, 8)
                    mass += seen
        yield from _dense([(0, (weights * mass[:, None]).ravel()), (1, mass)])

    return run


def _refining(model: Model):
    """Ones and all events by bits before and bucket of the mixed odds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones_at, all_at = np.zeros(256 * BUCKETS), np.zeros(256 * BUCKETS)
        for gram, n, tables in _trained(model, batches):
            for bit, ones, before, counted in _events(gram, tables):
                x, gate = model.inputs(bit, ones, counted, 1)
                at = before * BUCKETS + bucket(model.mixed(x, gate))
                ones_at += np.bincount(at, n * ones, len(ones_at))
                all_at += np.bincount(at, n, len(all_at))
        yield from _dense([(0, ones_at), (1, all_at)])

    return run


def _near_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The training counts of the near orders' keys, per part."""
    for batch in batches:
        for gram, n in zip(batch.column("grams").to_pylist(), batch.column("n").to_pylist()):
            key, total = _summed(_unpacked(gram) & ((1 << (8 * NEAR + 8)) - 1), wordtable.unpack(n, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(key[total > 0]), pa.array(total[total > 0])], names=["gram", "n"])


def learned(parts: DataFrame) -> Model:
    """The model of ``gram_parts``, without the far orders' counts."""
    parts = parts.select("grams", "n")
    near = parts.mapInArrow(_near_grams, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    gram, n = (near.column(c).to_numpy() for c in ("gram", "n"))
    model = Model([Counts(order, gram, n) for order in ORDERS[:NEAR]])
    shape = model.weights.shape
    for _ in range(ROUNDS):
        total, mass = _gathered(parts.mapInArrow(_learned(model), _DENSE_SQL), [shape[0] * shape[1], shape[0]])
        weights = total.reshape(shape) / np.maximum(mass, 1e-9)[:, None]
        model.weights = np.where(mass[:, None] > 0, weights, model.weights).astype(np.float32)
    ones, seen = _gathered(parts.mapInArrow(_refining(model), _DENSE_SQL), [256 * BUCKETS] * 2)
    center = 1 / (1 + np.exp(-(np.arange(BUCKETS) * 16 / (BUCKETS - 1) - 8)))
    prior = np.tile(center, 256)
    model.refined = (ones + 8 * prior) / (seen + 8)
    return model


_ANSWERS = pa.schema([("chunk", pa.int64()), ("grams", pa.binary()), ("answers", pa.binary())])
_ANSWERS_SQL = "chunk bigint, grams binary, answers binary"


def _gram_answers(model: Model):
    """The log10 probabilities of the chunks' grams, one row per part and chunk.
    Rows come sorted by part, the part's own grams and counts first, and the
    chunks pass them one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=3).compress
        gram = logs = None
        for batch in batches:
            for chunk, packed, n in zip(*(batch.column(c).to_pylist() for c in ("chunk", "grams", "n"))):
                if n is not None:
                    gram = _unpacked(packed)
                    logs = model.log10(gram, model.tables(gram, wordtable.unpack(n, np.int64)))
                    continue
                found = logs[np.searchsorted(gram, _unpacked(packed))]
                row = [[chunk], [packed], [compress(found.tobytes())]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, _ANSWERS)], schema=_ANSWERS)

    return run


def gram_answers(sent: DataFrame, parts: DataFrame, model: Model) -> DataFrame:
    """(chunk, grams, answers) of every chunk and part."""
    both = sent.select("part", "chunk", "grams").unionByName(parts, allowMissingColumns=True)
    dealt = both.repartition(_parts(sent.sparkSession), "part")
    first = F.col("n").isNull()
    return dealt.sortWithinPartitions("part", first).mapInArrow(_gram_answers(model), _ANSWERS_SQL)


def _stored(texts: list[str]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(e + bytes([END]) for e in _encoded(texts)))


def _measured(stored: bytes, answers: list[tuple[bytes, bytes]]) -> np.ndarray:
    """(log10 probability, bytes) of a chunk's texts, from its grams' answers."""
    decompress = zstandard.ZstdDecompressor().decompress
    texts = decompress(stored).split(bytes([END]))[:-1]
    gram = np.concatenate([_unpacked(g) for g, _ in answers])
    logs = np.concatenate([np.frombuffer(decompress(a)) for _, a in answers])
    by = np.argsort(gram)
    gram, logs = gram[by], logs[by]

    def log10(distinct: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(gram, distinct), len(gram) - 1)
        if (gram[at] != distinct).any():
            raise ValueError("the input changed between two passes: write it to a table first")
        return logs[at]

    return text_scores(texts, log10)


_COUNTS_SQL = "chunk bigint, local binary, answers binary, tokens bigint, words bigint"


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks' words' training counts, and each partition's totals."""
    names = ["chunk", "local", "answers", "tokens", "words"]
    types = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    for chunks, local, numbers, totals, _ in wordtable.by_part(batches):
        rows = [(None, None, None, int(totals.sum()), int((totals > 0).sum()))]
        rows += [(c, at, wordtable.pack(totals[n]), None, None) for c, at, n in zip(chunks, local, numbers)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score``, ``bits_per_byte``."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
    counts = cut(wordtable.dealt(wordtable.word_rows(rows, tokens, training)).mapInArrow(_token_counts, _COUNTS_SQL))
    # Two numbers.
    n, v = counts.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    sent = gram_rows(rows)
    parts = gram_parts(sent)
    model = learned(parts)
    denominator = np.log10(n + v + 1)

    def combine(ids, lens, positions, stored, pairs, others) -> pa.RecordBatch:
        size = sum(len(local) for local, _ in pairs)
        count = np.zeros(size, np.int64)
        for local, answer in pairs:
            count[local] = wordtable.unpack(answer, np.int64)
        starts = np.cumsum(lens) - lens  # every text has its end token
        known = np.add.reduceat((count > 0)[positions].astype(np.int64), starts)
        base = np.add.reduceat((np.log10(count + 1) - denominator)[positions], starts)
        score, size = _measured(stored, others)
        columns = [
            pa.array(ids, pa.int64()),
            pa.array([held_out(i) for i in ids]),
            pa.array(lens, pa.int64()),
            pa.array(known, pa.int64()),
            pa.array(np.full(len(ids), n), pa.int64()),
            pa.array(base),
            pa.array(score),
            pa.array(-score / np.log10(2) / np.maximum(size, 1)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    names = [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
    types = ["bigint", "boolean", "bigint", "bigint", "bigint", "double", "double", "double"]
    schema = ", ".join(f"`{c}` {t}" for c, t in zip(names, types))
    words = counts.where("chunk is not null").select("chunk", "local", "answers")
    scores = gram_answers(sent, parts, model)
    answers = words.unionByName(scores, allowMissingColumns=True)
    return wordtable.met(wordtable.position_rows(rows, tokens, _stored), answers, combine, schema, "grams")
