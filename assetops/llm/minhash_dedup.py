"""Near-duplicate classes by improved consistent weighted sampling.

Texts become weighted sets of five-word shingles: term frequency times inverse
document frequency.  Frequencies are counted per shingle over all documents: a
chunk of documents sends each of its shingles once to the hash range that holds
it, and the counts return to the chunks.  A text's weights are stored with its
samples and travel with it.  Each text gets
``BANDS * ROWS`` weighted samples; texts that agree on a band are candidates and
are verified by their exact weighted Jaccard similarity.

Buckets are verified exactly, whatever their size, in three steps.  Every member
meets its bucket's leader, the smallest member.  One minus the similarity is a
metric, so a member that is linked to the leader can only be linked to an unlinked
one if both lie near the leader's rim; only such members, and unlinked ones, stay
open, and buckets whose open members are of one class already are closed.  Then the
members outside their bucket's largest class meet some members of other classes,
spread by hash.  What is left is finished between classes: the members outside a
bucket's largest class are cut into blocks by total weight, and its members pass
the blocks of those weights that a link allows.
No link between classes of a bucket is lost, and none is capped.

Nodes are distinct texts (by MD5), so copies, however many, cost one row each.
A class is named by its smallest id.  NULL texts are empty; texts without words
are linked to equal texts only.  Rows that repeat an id, and NULL ids, follow
their texts; an empty table gives an empty result; other columns are not read.
Chunks are named by a hash of their rows: an input that changes between the two
passes is an error; chunks of the same rows get the same answers.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetops.llm.common import whole
from assetops.llm.shingles import BATCH_CHARS, counted, give_back, mix, of_texts, ranges
from assetops.llm.wordtable import pack, unpack
from assetops.storage import cut

SIMILARITY = 0.8
BANDS, ROWS = 10, 3  # a pair at the threshold shares a band with probability 0.999
CHUNK_CHARS = 8 << 20  # texts that send their shingles together
RANGES = 4  # hash ranges of the shingles per shuffle partition
IDF_SHARE = 0.25  # the rarest shingles weigh this much more than the commonest
LEADERS = 8  # of an open bucket in the second step
PART = 1024  # shingles that are sampled together
BLOCK = 128  # members that all others of their bucket pass at once in the third


def rows_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = whole(F.col(text_col))
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.unhex(F.md5(text)).alias("node"), text.alias("text"))


def _texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return batch.column(column).to_pylist()


def inverse(documents: np.ndarray, n: int) -> np.ndarray:
    """Inverse document frequency, from 1 to 1 + ``IDF_SHARE`` with the logarithm's
    share of its largest value; a wider range would part near copies whose changed
    words are rare."""
    return (1 + IDF_SHARE * np.log((n + 1) / (np.minimum(documents, n) + 1)) / np.log(n + 2)).astype(np.float32)


_SENT = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("shingles", pa.binary()), ("documents", pa.binary())])
_SENT_SQL = "part int, chunk bigint, shingles binary, documents binary"
_ANSWERS = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("documents", pa.binary())])
_ANSWERS_SQL = "part int, chunk bigint, documents binary"
_CHUNKS = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("nodes", pa.list_(pa.binary())), ("texts", pa.binary())])
_CHUNKS_SQL = "chunk bigint, ids array<bigint>, nodes array<binary>, texts binary"
_SIGNATURES_SQL = "id bigint, node binary, bands array<bigint>, weights binary, total double"
_END = b"\xff"  # no UTF-8 text has this byte


def _chunks(batches: Iterator[pa.RecordBatch], kept: Callable[[list[str]], object]) -> Iterator[tuple[int, list, list[bytes], list]]:
    """(name, ids, nodes, what is ``kept`` of the texts, group by group) of bounded
    size; a text goes as soon as its group is full."""
    ids, nodes, group, done, held, size, name = [], [], [], [], 0, 0, xxhash.xxh64()
    for batch in batches:
        for i, node, text in zip(batch.column("id").to_pylist(), batch.column("node").to_pylist(), batch.column("text")):
            ids.append(i)
            nodes.append(node)
            group.append(text.as_py())
            held += len(group[-1])
            size += len(group[-1]) + 64
            name.update(struct.pack("<?q", i is None, i or 0) + node)
            if held >= BATCH_CHARS or size >= CHUNK_CHARS:
                done.append(kept(group))
                group, held = [], 0
            if size >= CHUNK_CHARS:
                yield struct.unpack("<q", name.digest())[0], ids, nodes, done
                ids, nodes, done, size, name = [], [], [], 0, xxhash.xxh64()
                give_back()
        batch = text = None  # the next is read without it
    if ids:
        if group:
            done.append(kept(group))
        yield struct.unpack("<q", name.digest())[0], ids, nodes, done
        ids = nodes = group = done = None
    give_back()


def _sets(texts: list[str]) -> np.ndarray:
    """The distinct shingles of each text, one text after another."""
    return np.concatenate([counted(h)[0] for h in of_texts(texts)])


def _distinct(sets: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingles ascending, documents that have them) of documents' sets."""
    s = np.concatenate([np.zeros(0, np.uint64), *sets])
    s.sort()  # a chunk's largest array: no copy
    first = np.flatnonzero(np.concatenate([np.ones(min(len(s), 1), bool), s[1:] != s[:-1]])).astype(np.uint32)
    return s[first], np.diff(first, append=np.uint32(len(s)))


def _bounds(found: np.ndarray, parts: int) -> np.ndarray:
    """Where each hash range begins in ascending shingles, and their number."""
    least = np.array([-(-(p << 32) // parts) << 32 for p in range(parts)], np.uint64)
    return np.append(np.searchsorted(found, least), len(found))


def _sent(parts: int):
    """The distinct shingles of every chunk, by hash range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, _, _, sets in _chunks(batches, _sets):
            found, documents = _distinct(sets)
            bounds = _bounds(found, parts)
            own = [(p, slice(a, b)) for p, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if b > a]
            shingles = [pack(np.diff(found[e], prepend=np.uint64(0))) for _, e in own]
            columns = [[p for p, _ in own], [chunk] * len(own), shingles, [pack(documents[e]) for _, e in own]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SENT)], schema=_SENT)

    return run


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of all chunks for each chunk's shingles; rows come sorted by part."""
    part, held = None, []

    def ready() -> pa.RecordBatch:
        chunks, found, documents = zip(*held)
        distinct, at = np.unique(np.concatenate(found), return_inverse=True)
        total = np.bincount(at, np.concatenate(documents), len(distinct))[at].astype(np.uint32)
        ends = np.cumsum([len(f) for f in found])
        answers = [pack(a) for a in np.split(total, ends[:-1])]
        columns = [[part] * len(held), chunks, answers]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ANSWERS)], schema=_ANSWERS)

    for batch in batches:
        for p, chunk, found, documents in zip(*(c.to_pylist() for c in batch.columns)):
            if p != part and held:
                yield ready()
                held = []
            part = p
            held.append((chunk, np.cumsum(unpack(found, np.uint64), dtype=np.uint64), unpack(documents)))
    if held:
        yield ready()


def _encoded(texts: list[str]) -> bytes:
    return b"".join(t.encode("utf-8", "surrogatepass") + _END for t in texts)


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compress = zstandard.ZstdCompressor(level=3).compress
    for chunk, ids, nodes, texts in _chunks(batches, _encoded):
        row = [[chunk], [ids], [nodes], [compress(b"".join(texts))]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, _CHUNKS)], schema=_CHUNKS)


def signed(rows: DataFrame) -> DataFrame:
    """(id, node, bands, weights, total) of every row: band keys, NULL without
    shingles, the packed weights of its distinct shingles ascending, and the sum of
    weights and frequencies."""
    parts = RANGES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = rows.count()
    sent = rows.mapInArrow(_sent(parts), _SENT_SQL).repartition(parts, "part").sortWithinPartitions("part")
    answers = sent.mapInArrow(_answered, _ANSWERS_SQL)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        give_back()
        # Chunks of the same rows have the same answers.
        answer = dict(zip(right.column("part").to_pylist(), right.column("documents").to_pylist()))
        idf = inverse(np.concatenate([np.zeros(0, np.uint32), *(unpack(answer[p]) for p in sorted(answer))]), n)
        out = []
        decompress = zstandard.ZstdDecompressor().decompress
        with np.errstate(over="ignore"):
            for ids, nodes, blob in zip(*(left.column(c).to_pylist() for c in _CHUNKS.names[1:])):
                texts = [t.decode("utf-8", "surrogatepass") for t in decompress(blob).split(_END)[:-1]]
                sets = [counted(h) for h in of_texts(texts)]
                known = _distinct(found for found, _ in sets)[0]
                if len(known) != len(idf):
                    raise ValueError("the input changed between two passes: write it to a table first")
                packed = []
                for k, (found, uses) in enumerate(sets):
                    own = idf[np.searchsorted(known, found)]
                    sets[k] = found, uses * own.astype(np.float64)
                    packed.append(pack(own))
                out.extend(zip(ids, nodes, _bands(sets), packed, (float(weight.sum()) for _, weight in sets)))
        if not out:
            raise ValueError("the input changed between two passes: write it to a table first")
        types = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.float64()]
        names = ["id", "node", "bands", "weights", "total"]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    chunks = rows.mapInArrow(_chunk_rows, _CHUNKS_SQL)
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, _SIGNATURES_SQL)


def _own(fingerprints: np.ndarray, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A text's distinct shingles ascending, by their own stored weights."""
    found, uses = counted(fingerprints)
    return found, uses * unpack(packed, np.float32).astype(np.float64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity; 0 without shingles."""
    total = a[1].sum() + b[1].sum()
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    same = a[0][at] == b[0]
    shared = np.minimum(a[1][at[same]], b[1][same]).sum()
    return float(shared / (total - shared))


_SEEDS = mix(np.arange(1, 3 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(3, -1)
_MARGIN = np.float32(1.001)  # more than the rounding errors of 32-bit numbers
_FIRST = 4  # times the mean of the least value: 98 in 100 are less


def _mixed(bits: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """``mix(bits ^ seeds)``; the first step of ``mix`` is done before they meet."""
    h = (bits ^ (bits >> np.uint64(30))) ^ (seeds ^ (seeds >> np.uint64(30)))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _unit(numbers: np.ndarray) -> np.ndarray:
    """16-bit numbers as numbers strictly between 0 and 1."""
    return (numbers.astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-16)


def _drawn(bits: np.ndarray, b: np.ndarray, log_weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ln c - r (t - b + 1), t); ``bits`` are 32 of r and then 32 of c."""
    halves = bits.view(np.uint32)
    logs = np.log(_unit(halves >> np.uint32(16)) * _unit(halves & np.uint32(0xFFFF)))
    r, c = -logs[::2], -logs[1::2]
    t = np.floor(log_weight / r + b)
    return np.log(c) - r * (t - b + 1), t


def _least(u: np.ndarray, weight: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(least value, its shingle, its level), one row per sample and one column per
    set of ``lens`` shingles; see ``samples_of``."""
    size, total = BANDS * ROWS, len(u)
    log_weight, begins = np.log(weight).astype(np.float32), np.cumsum(lens) - lens
    bits = _mixed(u, _SEEDS[0][:, None])
    halves = bits.view(np.uint32)
    products = ((halves >> np.uint32(16)) * (halves & np.uint32(0xFFFF))).astype(np.float32)
    # Rounded down: half a unit more in each factor is at most 2 ** 16 in a product.
    bound = np.float32(2.0**32 - 2.0**16) - products[:, 1::2]
    bound *= products[:, ::2]
    bound *= (2.0**-64 / weight).astype(np.float32)
    best, chosen, level = np.full(size * len(lens), np.inf, np.float32), np.zeros(size * len(lens), np.uint64), np.zeros(size * len(lens), np.float32)
    row = np.repeat(np.arange(size), len(lens))
    at, n = row * total + np.tile(begins, size), np.tile(lens, size)

    def draw(near: np.ndarray, of: np.ndarray) -> None:
        """Draws the shingles at ``near`` in full; ``of`` are the results they belong to."""
        starts = np.searchsorted(near, at[of])
        n = np.diff(starts, append=len(near))
        sample = np.repeat(row[of], n)
        i = near - sample * total
        b = (_mixed(u[i], _SEEDS[1][sample]) >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
        a, t = _drawn(bits.ravel()[near], b, log_weight[i])
        least = np.minimum.reduceat(np.append(a, np.float32(np.inf)), starts)
        hits = np.flatnonzero(a == np.repeat(least, n))
        some = np.flatnonzero(n)
        hit, to = hits[np.searchsorted(hits, starts[some])], of[some]  # the first of equal values
        best[to], chosen[to], level[to] = a[hit], u[i[hit]], t[hit]

    under = (_FIRST / np.add.reduceat(weight, begins)).astype(np.float32)
    draw(np.flatnonzero(bound <= np.repeat(under, lens)), np.arange(len(best)))
    # Whose least value is not under the bound that was looked at, once more.
    need = np.exp(best) * _MARGIN
    more = np.flatnonzero(need > np.tile(under, size))
    if len(more):
        near = ranges(at[more], n[more])
        draw(near[bound.ravel()[near] <= np.repeat(need[more], n[more])], more)
    return tuple(x.reshape(size, -1) for x in (best, chosen, level))


def samples(shingles: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The samples of one set; see ``samples_of``."""
    return samples_of([(shingles, weight)])[0]


def samples_of(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """One (shingle, level) fingerprint per sample, a row for each set of shingles and
    weights, none of them empty, by improved consistent weighted sampling: r and c
    are Gamma(2, 1), b is uniform, all drawn from the shingle and the sample's number;
    t = floor(ln w / r + b); the shingle with the least ln c - r (t - b + 1) is drawn,
    together with t.

    That value is at least ln c - ln w - r.  r and c are minus the logarithms of
    products of two units, so with c's product p no shingle goes below its bound,
    the logarithm of (1 - p) exp(-r) / w, which takes no logarithm to compare.
    Only shingles whose bound is under the least value found are drawn in full."""
    out, group, held = [], [], 0
    # Long sets are cut; the least of the parts' values counts.
    parts = [(k, f[at : at + PART], w[at : at + PART]) for k, (f, w) in enumerate(sets) for at in range(0, len(f), PART)]
    for j, part in enumerate(parts):
        group.append(part)
        held += len(part[1])
        if held >= PART or j == len(parts) - 1:
            lens = np.array([len(f) for _, f, _ in group])
            out.append(_least(np.concatenate([f for _, f, _ in group]), np.concatenate([w for *_, w in group]), lens))
            group, held = [], 0
    if not out:
        return np.zeros((0, BANDS * ROWS), np.uint64)
    best, chosen, level = (np.concatenate(c, axis=1) for c in zip(*out))
    owner = np.array([k for k, *_ in parts])
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    n = np.diff(first, append=len(owner))
    for k in np.flatnonzero(n > 1):
        at = slice(first[k], first[k] + n[k])
        i = np.arange(len(best)), first[k] + np.argmin(best[:, at], axis=1)
        chosen[:, first[k]], level[:, first[k]] = chosen[i], level[i]
    chosen, level = chosen[:, first], level[:, first]
    return mix(chosen ^ mix((level.astype(np.int64) + (1 << 20)).astype(np.uint64) ^ _SEEDS[2][:, None])).T


def _bands(sets: list[tuple[np.ndarray, np.ndarray]]) -> list[list[int] | None]:
    """Band keys of each set; NULL of an empty one."""
    s = samples_of([x for x in sets if len(x[0])]).reshape(-1, BANDS, ROWS)
    keys = s[:, :, 0]
    for j in range(1, ROWS):
        keys = mix(keys ^ s[:, :, j]) + np.uint64(j)
    found = iter(keys.view(np.int64).tolist())
    return [next(found) if len(x[0]) else None for x in sets]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Similarity of each text with its leader; rows come sorted by leader."""
    leader, leader_set = None, None
    with np.errstate(over="ignore"):
        for batch in batches:
            out = []
            leaders = zip(*(batch.column(c) for c in ("leader", "leader_text", "leader_weights", "weights")))
            for (node, text, theirs, mine), h in zip(leaders, of_texts(_texts(batch))):
                if node.as_py() != leader:
                    leader, leader_set = node.as_py(), _own(next(of_texts([text.as_py()])), theirs.as_py())
                out.append(similarity(leader_set, _own(h, mine.as_py())))
            columns = [batch.column("node"), batch.column("leader"), pa.array(out, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "leader", "sim"])


def _finished(least: float):
    """Links between classes; rows come sorted by block, its own members first.
    A block is all that is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, label = None, [], {}
        with np.errstate(over="ignore"):
            for batch in batches:
                out = []
                columns = [batch.column(c).to_pylist() for c in ("band", "key", "bin", "block", "role", "node", "label", "minor", "weights")]
                for (*at, role, node, mine, minor, packed), h in zip(zip(*columns), of_texts(_texts(batch))):
                    if at != block:
                        block, held, label = at, [], {}
                    own = _own(h, packed)
                    if role == 0:
                        held.append((node, mine, own))
                        continue
                    for other, theirs, its in held:
                        # Two members outside the largest class meet in both their blocks.
                        if minor and node <= other:
                            continue
                        old, new = label.get(theirs, theirs), label.get(mine, mine)
                        if old != new and similarity(its, own) >= least:
                            out.append((node, other))
                            label = {k: new if v == old else v for k, v in label.items()} | {theirs: new, old: new}
                found = list(zip(*out)) if out else [[], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in found], names=["node", "leader"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in ``edges`` (node, leader): the least node
    that it reaches, by least neighbours and jumps over labels."""
    pairs = edges.select(F.col("node").alias("a"), F.col("leader").alias("b"))
    both = cut(pairs.union(pairs.select("b", "a")).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels.node == near.a).select("node", "label", F.least("label", "near").alias("low"))
        jump = lower.alias("x").join(labels.alias("y"), F.col("x.low") == F.col("y.node"))
        best = F.least("x.low", "y.label")
        new = cut(jump.select("x.node", best.alias("label"), (best != F.col("x.label")).alias("moved")))
        labels = new.select("node", "label")
        if not new.where("moved").limit(1).count():
            return labels


def _open(active: DataFrame, found: DataFrame) -> DataFrame:
    """(band, key, node, label, minor) of buckets with members of two classes;
    ``minor`` members are outside the bucket's largest class."""
    labelled = cut(active.join(components(found), "node", "left").withColumn("label", F.coalesce("label", "node")))
    sizes = labelled.groupBy("band", "key", "label").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("band", "key").agg(
        F.max(F.struct("n", "label"))["label"].alias("largest"), F.sum("n").alias("all_"), F.max("n").alias("most")
    )
    held = labelled.join(largest.where("all_ > most"), ["band", "key"])
    minor = F.col("label") != F.col("largest")
    return cut(held.select("band", "key", "node", "label", minor.alias("minor"), (F.col("all_") - F.col("most")).alias("n")))


def _similarities(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, leader, sim) of distinct pairs, each compared once."""
    a, b = F.least("node", "leader"), F.greatest("node", "leader")
    pairs = pairs.select(b.alias("node"), a.alias("leader")).distinct()
    leader_texts = texts.select(F.col("node").alias("leader"), F.col("text").alias("leader_text"), F.col("weights").alias("leader_weights"))
    both = pairs.join(texts, "node").join(leader_texts, "leader")
    both = both.select("node", "text", "weights", "leader", "leader_text", "leader_weights")
    return cut(both.mapInArrow(_compared, "node binary, leader binary, sim double"))


def _led(active: DataFrame, texts: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(links of members with their buckets' leaders, members that stay open)."""
    first = active.groupBy("band", "key").agg(F.min("node").alias("leader"))
    led = cut(active.join(first, ["band", "key"]).where("node != leader"))
    compared = _similarities(led, texts)
    near, reach = F.col("sim") >= least, 1 - least
    # The leader is its bucket's least member, so pairs are in order already.
    judged = cut(led.join(compared, ["node", "leader"]))
    # A member within reach of the leader has no link to anything farther from it
    # than reach + reach, and to nothing nearer than its rim allows.
    rim = judged.where(~near & (1 - F.col("sim") <= 2 * reach + 1e-9)).groupBy("band", "key").agg(F.max("sim").alias("rim"))
    settled = near & (F.col("rim").isNull() | (1 - F.col("sim") < 1 - F.col("rim") - reach - 1e-9))
    stays = judged.join(rim, ["band", "key"], "left").where(~settled).select("band", "key", "node")
    # The leader has met every member.
    return compared.where(near).select("node", "leader"), cut(stays)


def _between(open_: DataFrame, texts: DataFrame, leaders: int, least: float) -> DataFrame:
    """Links of the members outside their bucket's largest class with some members
    of other classes.  Members of one class have nothing to learn from each other,
    so a bucket of near copies sends only its stragglers."""
    salt = F.pmod(F.xxhash64("node", F.lit(leaders)), F.lit(leaders))
    first = open_.groupBy("band", "key", salt.alias("salt")).agg(F.min(F.struct("node", "label")).alias("first"))
    first = first.select("band", "key", F.col("first.node").alias("leader"), F.col("first.label").alias("their"))
    met = open_.where("minor").join(first, ["band", "key"]).where("label != their")
    return _similarities(met.select("node", "leader"), texts).where(F.col("sim") >= least).select("node", "leader")


def links(rows: DataFrame, signatures: DataFrame, least: float) -> DataFrame:
    """(node, leader): verified links that connect every class of nodes."""
    # Copies are one node: its smallest id lends the text.
    nodes = signatures.where("bands is not null").groupBy("node").agg(F.min("id").alias("id"), F.first("bands").alias("bands"))
    members = cut(nodes.select("node", "id", F.posexplode("bands").alias("band", "key")))
    shared = members.groupBy("band", "key").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("all_"), F.min("node").alias("one")
    )
    # Buckets of the same members, in several bands, are looked at once.
    once = shared.where("n > 1").groupBy("n", "all_", "one").agg(F.min(F.struct("band", "key")).alias("b")).select("b.band", "b.key")
    active = cut(members.join(once, ["band", "key"]).select("band", "key", "node", "id"))
    own = signatures.groupBy("node").agg(F.first("weights").alias("weights"), F.first("total").alias("total"))
    wanted = active.select("node", "id").distinct().join(own, "node").hint("merge")
    same = (F.col("r.node") == F.col("w.node")) & F.col("r.id").eqNullSafe(F.col("w.id"))
    texts = cut(rows.alias("r").join(wanted.alias("w"), same).select("r.node", "text", "weights", "total"), "zstd")
    found, active = _led(active.drop("id"), texts.drop("total"), least)
    found = cut(found.union(_between(_open(active, found), texts.drop("total"), LEADERS, least)))
    return found.union(_between_classes(_open(active, found), texts.dropDuplicates(["node"]), least))


def _between_classes(rest: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The links that are left between classes.  Two texts of a link differ in total
    weight by a factor of ``1 / least`` at most.  So a bucket's members are dealt by
    the logarithm of their weight: those outside its largest class into blocks of
    their bin, and all members past the blocks of their own and the next bins."""
    bin_ = F.floor(F.log("total") / math.log(1 / least) * (1 - 1e-6))
    placed = cut(rest.drop("n").join(texts.select("node", "total"), "node").withColumn("bin", bin_).drop("total"))
    at = ["band", "key", "bin"]
    blocks = placed.where("minor").groupBy(*at).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = placed.where("minor").join(blocks, at).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    near = placed.withColumn("bin", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1))).join(blocks, at)
    passing = near.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    both = own.withColumn("role", F.lit(0)).unionByName(passing.withColumn("role", F.lit(1))).drop("blocks")
    dealt = both.join(texts.drop("total"), "node").repartition(*at, "block").sortWithinPartitions(*at, "block", "role")
    return cut(dealt.mapInArrow(_finished(least), "node binary, leader binary"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """Per row: its id, ``class_id`` (the class's smallest id), ``class_size``
    (rows of the class) and ``_node``, its text's MD5."""
    rows = rows_of(docs, id_col, text_col)
    signatures = cut(signed(rows))
    labels = components(cut(links(rows, signatures, least)))
    # Nodes first: copies, however many, are one row in every join of nodes.
    nodes = signatures.groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    named = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    of_class = named.groupBy("label").agg(F.min("id").alias("class_id"), F.sum("n").alias("class_size"))
    of_node = named.join(of_class, "label").select("node", "class_id", "class_size")
    return (
        signatures.select("id", "node")
        .join(of_node.hint("merge"), "node")
        .select(F.col("id").alias(id_col), "class_id", "class_size", F.col("node").alias("_node"))
    )


def deduped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row of each class, that of its smallest id, with all columns.  Rows
    that repeat that id with another text of the class go too; equal rows stay
    one; of rows with NULL ids only, one text stays."""
    found = classes(docs, id_col, text_col, least)
    first = found.where(F.col(id_col).eqNullSafe(F.col("class_id"))).groupBy(F.col("class_id").alias("_id")).agg(F.min("_node").alias("_node"))
    text = F.unhex(F.md5(whole(F.col(f"d.`{text_col}`"))))
    same = F.col(f"d.`{id_col}`").eqNullSafe(F.col("f._id")) & (text == F.col("f._node"))
    return docs.alias("d").join(first.alias("f"), same, "left_semi")
