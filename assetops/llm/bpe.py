"""BPE encoding and decoding over a distinct-word table.

Texts are split into the tokenizer's words; every distinct word is encoded once
in its word partition (see ``wordtable``) and the ids return to the positions.
Decoding joins ids with the vocabulary's pieces, a table bounded by the
vocabulary.  The tokenizer is a file whose path is a parameter; its text goes to
the tasks with the plan.

A NULL text is empty and has no ids.  Rows that repeat an id are encoded row by
row; NULL ids stay; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetops.llm import wordtable

_loaded: dict = {}


class Words:
    """A text's words as the tokenizer splits them: its special tokens, and the
    matches of its pattern in the normalized text between them."""

    def __init__(self, spec: str):
        parsed = json.loads(spec)
        self.pattern = parsed["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.special = [t["content"] for t in parsed["added_tokens"]]

    def __call__(self, text: str) -> list[str]:
        key = (self.pattern, *self.special)
        if key not in _loaded:
            either = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
            _loaded[key] = regex.compile(self.pattern).findall, re.compile(f"({either})").split if either else None
        findall, split = _loaded[key]
        if split is None or "<" not in text:
            return findall(_normal(text))
        out: list[str] = []
        for i, piece in enumerate(split(text)):
            out.extend([piece] if i % 2 else findall(_normal(piece)))
        return out


def _normal(text: str) -> str:
    """NFC and lower case, letter by letter: a final sigma is not special."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def _tokenizer(spec: str):
    key = hash(spec)
    if key not in _loaded:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(spec)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _loaded[key] = tokenizer
    return _loaded[key]


def _pieces(spec: str) -> pa.Array:
    """Piece by id."""
    key = ("pieces", hash(spec))
    if key not in _loaded:
        tokenizer = _tokenizer(spec)
        size = max(tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        _loaded[key] = pa.array([tokenizer.id_to_token(i) or "" for i in range(size)])
    return _loaded[key]


def _encode(spec: str):
    """Encodes a partition's distinct words, each once."""

    def answer(words: list[bytes], _):
        tokenizer = _tokenizer(spec)
        ids, lens = [], []
        for at in range(0, len(words), 4096):
            batch = [w.decode("utf-8", "surrogatepass") for w in words[at : at + 4096]]
            for found in tokenizer.encode_batch(batch, add_special_tokens=False):
                lens.append(len(found.ids))
                ids.extend(found.ids)
        lens, ids = np.array(lens, np.int64), np.array(ids, np.uint32)
        starts = np.cumsum(lens) - lens

        def packed(numbers: np.ndarray) -> bytes:
            n = lens[numbers]
            first, second = wordtable.pack(n.astype(np.uint32)), wordtable.pack(ids[_ranges(starts[numbers], n)])
            return len(first).to_bytes(8, "little") + first + second

        return packed

    return answer


def _ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after another."""
    ends = np.cumsum(lens)
    return np.repeat(starts - ends + lens, lens) + np.arange(ends[-1] if len(ends) else 0)


def _join(ids, lens, positions, _, pairs) -> pa.RecordBatch:
    """Puts the words' ids at their positions."""
    size = sum(len(local) for local, _ in pairs)
    word_lens, word_starts, at = np.zeros(size, np.int64), np.zeros(size, np.int64), 0
    pool = []
    for local, answer in pairs:
        cut = 8 + int.from_bytes(answer[:8], "little")
        n, found = wordtable.unpack(answer[8:cut]).astype(np.int64), wordtable.unpack(answer[cut:])
        word_lens[local], word_starts[local] = n, at + np.cumsum(n) - n
        at += len(found)
        pool.append(found)
    flat = np.concatenate(pool) if pool else np.zeros(0, np.uint32)
    n = word_lens[positions]
    tokens = flat[_ranges(word_starts[positions], n)].astype(np.int32)
    per_word = np.concatenate([[0], np.cumsum(n)])
    offsets = per_word[np.concatenate([[0], np.cumsum(lens)])].astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists], names=["_id", "ids"])


def encode(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``_id``, ``ids``) of every row; ``spec`` is the tokenizer file's text."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
    words = Words(spec)
    answers = wordtable.answered(wordtable.word_rows(rows, words), _encode(spec))
    return wordtable.met(wordtable.position_rows(rows, words), answers, _join, "_id bigint, ids array<int>")


def _decoded(ids: pa.ListArray, spec: str) -> pa.Array:
    """Pieces by id, joined as the library does without a decoder: by blanks."""
    pieces = pc.take(_pieces(spec), ids.flatten())
    offsets = pc.subtract(ids.offsets, ids.offsets[0]) if len(ids) else pa.array([0], pa.int32())
    blank = pa.scalar(" ", pa.large_string())
    return pc.binary_join(pa.ListArray.from_arrays(offsets.cast(pa.int32()), pieces.cast(pa.large_string())), blank)


def _sliced(batch: pa.RecordBatch, tokens: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of at most about so many tokens; one long document may have more."""
    at, held = 0, 0
    lens = pc.list_value_length(batch.column("ids")).to_pylist()
    for i, n in enumerate(lens):
        if held and held + n > tokens:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += n
    if len(lens) > at:
        yield batch.slice(at)


def decode(encoded: DataFrame, spec: str) -> DataFrame:
    """(``_id``, ``text``): the library's decode with special tokens kept."""
    schema = pa.schema([("_id", pa.int64()), ("text", pa.large_string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _sliced(batch):
                yield pa.RecordBatch.from_arrays([part.column("_id"), _decoded(part.column("ids"), spec)], schema=schema)

    return encoded.select("_id", "ids").mapInArrow(run, "_id bigint, text string")


def digest(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens`` and digests of the ids and of the decoded text."""
    schema = pa.schema([(id_col, pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _sliced(batch):
                ids = part.column("ids")
                flat, offsets = np.asarray(ids.values, dtype="<u4"), np.asarray(ids.offsets)
                shas = [hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])]
                texts = [hashlib.sha256(t.as_buffer()).hexdigest() for t in _decoded(ids, spec)]
                columns = [part.column("_id"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(shas), pa.array(texts)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    out = f"`{id_col}` bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return encode(docs, spec, id_col, text_col).mapInArrow(run, out)
