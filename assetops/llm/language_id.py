"""Language identification by bit-sliced Bloom filters of character n-grams.

Every language has one Bloom filter of the n-grams that belong to it; the filters
share their size and hashes and are stored bit-sliced, so that a slot holds one
bit per language.  The AND of an n-gram's slots names every language that contains
it.  A text's score for a language is the number of its n-grams in that filter,
less the false positives its fill makes us expect; the largest corrected share
wins, equal ones in the order of the language names.

An n-gram belongs to a language if at least one in ``RATE`` of the n-grams of its
length in that language's texts is it.  So a language has at most ``RATE`` n-grams
of each length however large the corpus is, which bounds the filters and what the
driver holds, and a few foreign texts under a label add nothing.  All labelled
texts are counted, in Spark; held-out ones are not read for learning.

Texts are lower-cased and split into runs of letters; n-grams have one to four
characters and may begin or end with the border of a word.  Only distinct words
are looked up.  A text that is NULL or has no letter is ``und`` with score 0, as is
every text if no language was learned.  A NULL id has the checksum of the empty
string, 0, so it is held out.  Rows that repeat an id are judged each on its own
and counted as often as they occur; an empty table gives an empty result; columns
besides id, text and language are not read, and for a prediction only the text is.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetops.llm.shingles import mix
from assetops.storage import cut

ORDERS = (1, 2, 3, 4)
RATE = 1 << 14
HASHES = 4
SLOTS_PER_GRAM = 16  # of the language with the most n-grams
HELD_OUT, FOLDS = 0, 5
CHUNK_WORDS = 1 << 18  # distinct words whose n-grams are counted at once
UNKNOWN = "und"

_RUNS = re.compile(r"[^\W\d_]+").findall
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[str]:
    """Runs of letters, in lower case.  A run may hold number signs that are no
    digits; ``grams`` drops those."""
    return _RUNS(text.lower())


def grams(distinct: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(order, hash, word number) of the n-grams of every word; a blank stands for
    a word's border."""
    plain = [w if w.isalpha() else "".join(c for c in w if c.isalpha()) for w in distinct]
    codes = np.frombuffer(" ".join(["", *plain, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    blank = codes == 32
    number = np.cumsum(blank) - 1  # of the word that a place lies in, or whose border it is
    with np.errstate(over="ignore"):
        for order in ORDERS:
            size = len(codes) - order + 1
            if size <= 0:
                continue
            total = np.full(size, order, np.uint64)
            for j in range(order):
                total = (total ^ codes[j : j + size]) * _BASE
            inner = np.zeros(size, bool)
            for j in range(1, order - 1):
                inner |= blank[j : j + size]
            # Neither a border inside, nor borders alone.
            edges = blank[:size] & blank[order - 1 : order - 1 + size] if order < 3 else np.zeros(size, bool)
            at = np.flatnonzero(~(inner | edges))
            yield order, mix(total[at]), number[at]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


_COUNTS = pa.schema([("lang", pa.string()), ("n_gram", pa.int64()), ("size", pa.int32()), ("n", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences per language and n-gram, from the distinct words of a stretch."""
    held: dict[str, Counter] = {}

    def counted() -> Iterator[pa.RecordBatch]:
        for lang, found in held.items():
            distinct, times = list(found), np.fromiter(found.values(), np.int64, len(found))
            for order, hashes, number in grams(distinct):
                keys, places = np.unique(hashes, return_inverse=True)
                sums = np.bincount(places, weights=times[number], minlength=len(keys)).astype(np.int64)
                columns = [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64))]
                columns += [pa.array(np.full(len(keys), order, np.int32)), pa.array(sums)]
                yield pa.RecordBatch.from_arrays(columns, schema=_COUNTS)
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.setdefault(lang, Counter()).update(words(text))
            if sum(map(len, held.values())) >= CHUNK_WORDS:
                yield from counted()
    yield from counted()


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, n_gram, size, n) over all rows of (lang, text)."""
    found = labelled.mapInArrow(_count, "lang string, n_gram bigint, size int, n bigint")
    return found.groupBy("lang", "size", "n_gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Filters:
    """The filters of all languages: ``slots[i]`` has one bit per language."""

    languages: list[str]
    slots: np.ndarray  # (slots, bytes of a row) of uint8
    false_positive: np.ndarray  # per language

    def containing(self, hashes: np.ndarray) -> np.ndarray:
        """(n-grams, bytes of a row): the languages of every n-gram."""
        out = None
        for places in _places(hashes, len(self.slots)):
            found = self.slots[places]
            out = found if out is None else out & found
        return out

    def rows(self) -> list[np.ndarray]:
        """The slots as columns of whole numbers, up to 64 languages in each."""
        size = self.slots.shape[1]
        width = next((w for w in (1, 2, 4) if size <= w), 8)
        padded = np.zeros((len(self.slots), -(-size // width) * width), np.uint8)
        padded[:, :size] = self.slots
        return list(np.ascontiguousarray(padded).view(f"<u{width}").T.copy())

    def hits(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(words, languages) n-grams found, and (words,) n-grams in all."""
        hits, total = np.zeros((len(distinct), len(self.languages))), np.zeros(len(distinct), np.int64)
        columns = self.rows()
        each = 8 * columns[0].itemsize
        for _, hashes, number in grams(distinct):
            total += np.bincount(number, minlength=len(distinct))
            places = list(_places(hashes, len(self.slots)))
            for c, column in enumerate(columns):
                masks = column[places[0]]
                for more in places[1:]:
                    masks &= column[more]
                for i in range(each * c, min(each * (c + 1), len(self.languages))):
                    # The bit of one language in every mask, counted by word.
                    bit = (masks >> masks.dtype.type(i - each * c)) & masks.dtype.type(1)
                    hits[:, i] += np.bincount(number, weights=bit, minlength=len(distinct))
        return hits, total

    def shares(self, hits: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Corrected share of a text's n-grams in each language, 0 to 1."""
        fp = self.false_positive
        return np.clip((hits - fp * total[:, None]) / np.maximum((1 - fp) * total[:, None], 1e-12), 0, 1)


def _places(hashes: np.ndarray, slots: int) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        step = mix(hashes ^ _BASE) | np.uint64(1)
        for i in range(HASHES):
            yield ((hashes + np.uint64(i) * step) >> np.uint64(20)) & np.uint64(slots - 1)


def bit_sliced(grams_of: dict[str, np.ndarray]) -> Filters:
    """The filters of given n-gram hashes per language."""
    languages = sorted(grams_of)
    most = max((len(g) for g in grams_of.values()), default=0)
    size = 1 << max(10, (SLOTS_PER_GRAM * most - 1).bit_length())
    slots = np.zeros((size, -(-len(languages) // 8) or 1), np.uint8)
    fill = np.zeros(len(languages))
    for i, lang in enumerate(languages):
        for places in _places(grams_of[lang], size):
            slots[places, i // 8] |= np.uint8(1 << i % 8)
        fill[i] = np.count_nonzero(slots[:, i // 8] & (1 << i % 8)) / size
    return Filters(languages, slots, fill**HASHES)


def learned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Filters:
    """The filters of the labelled documents that are not held out."""
    training = docs.where(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = cut(gram_counts(training.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))))
    totals = counts.groupBy("lang", "size").agg(F.sum("n").alias("total"))
    # Four totals per language; at most RATE rows per language and size pass.
    frequent = counts.join(F.broadcast(totals), ["lang", "size"]).where(F.col("n") * RATE >= F.col("total"))
    found = frequent.select("lang", "n_gram").toArrow()
    hashes = found.column("n_gram").combine_chunks().to_numpy().view(np.uint64)
    names = np.array(found.column("lang").to_pylist(), object)
    return bit_sliced({lang: np.unique(hashes[names == lang]) for lang in set(names)})


_PREDICTED = pa.schema([("lang_pred", pa.string()), ("score", pa.float64())])


class _Numbering(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _predict(filters: Filters, texts: list[str | None]) -> pa.RecordBatch:
    number = _Numbering()
    found, lens = [], []
    for text in texts:
        own = words(text or "")
        found.append(np.fromiter(map(number.__getitem__, own), np.int64, len(own)))
        lens.append(len(own))
    hits, total = filters.hits(list(number))
    at, owner = np.concatenate(found), np.repeat(np.arange(len(texts)), lens)
    sums, sizes = np.zeros((len(texts), hits.shape[1])), np.bincount(owner, weights=total[at], minlength=len(texts))
    for i in range(hits.shape[1]):
        sums[:, i] = np.bincount(owner, weights=hits[:, i][at], minlength=len(texts))
    shares = filters.shares(sums, sizes)
    best = shares.argmax(axis=1)
    known = sizes > 0
    names = [filters.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
    score = np.where(known, shares[np.arange(len(texts)), best], 0.0)
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(score)], schema=_PREDICTED)


BATCH_CHARS = 1 << 22


def predicted(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, lang_pred, score) of every row; the text alone decides."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    if not filters.languages:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at, size = batch.column(2).to_pylist(), 0, 0
            for i, text in enumerate(texts):
                size += len(text or "")
                if size >= BATCH_CHARS or i + 1 == len(texts):
                    made = _predict(filters, texts[at : i + 1])
                    kept = batch.slice(at, i + 1 - at)
                    yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), *made.columns], names=["doc_id", "held_out", *_PREDICTED.names])
                    at, size = i + 1, 0

    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learns from the labelled documents and predicts every document's language."""
    return predicted(docs, learned(docs, id_col, text_col, lang_col), id_col, text_col)
