"""BPE against the tokenizers library; language-model scores against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import edge
import numpy as np
import pytest
from edge import SCHEMA, frame, texts

from assetops.llm import bpe, lm_score, wordtable
from assetops.llm.queries import tokenizer_file

ODD = [
    "a <|endoftext|>b<|startoftext|> ΟΔΥΣΣΕΥΣ İx don't we'LL x\u0085y z\x1cq\x1fr ​q ﬁ é 5½Ⅷ٣ \U0001f600‍! 　",
    "!'s ''s 's's",
    "한글 한 <|endof",
    "x" * 20_000 + " " + "É" * 3000,
    "\x00\x01 tab\tnew\nline\r\n",
]


@pytest.fixture(scope="module")
def spec():
    return tokenizer_file()


@pytest.fixture(scope="module")
def library(spec):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(spec)


def test_bpe_like_the_library(spark, spec, library):
    rows = texts() + [(300 + i, t) for i, t in enumerate(ODD)]
    df = frame(spark, rows).repartition(6)
    wanted = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        wanted.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((str(r[0]), *r[1:]) for r in bpe.digest(df, spec).collect()) == sorted(wanted)
    encoded = bpe.encode(df, spec)
    decoded = bpe.decode(encoded, spec)
    assert sorted((str(r[0]), r.text) for r in decoded.collect()) == sorted(
        (str(i), library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False)) for i, t in rows
    )
    assert bpe.digest(frame(spark, []), spec).count() == 0


def test_words_are_the_librarys_words(spec, library):
    words = bpe.Words(spec)
    for text in ODD:
        ids = [i for w in words(text) for i in library.encode(w, add_special_tokens=False).ids]
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_an_input_that_changes_is_an_error(spark):
    rows = frame(spark, texts()).select("doc_id", "text")
    other = frame(spark, texts()[:7]).select("doc_id", "text")
    answers = wordtable.answered(wordtable.word_rows(rows, lm_score.tokens), lambda words, _: lambda n: b"")
    with pytest.raises(Exception, match="changed between two passes"):
        wordtable.met(wordtable.position_rows(other, lm_score.tokens), answers, None, "a int").collect()


def fitted(rows):
    """The model of the training rows of (_id, _text) with all its counts in this
    process; ``scored`` leaves the counts of the far orders in their parts."""
    parts = lm_score.gram_parts(lm_score.gram_rows(rows))
    model = lm_score.learned(parts)
    found = [(lm_score._unpacked(bytes(g)), wordtable.unpack(bytes(n), np.int64)) for g, n in parts.select("grams", "n").collect()]
    gram, n = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    model.far = model.tables(gram, n)[lm_score.NEAR :]
    return model


def brute_base(rows):
    split = [re.findall(r"[^\x20\x09-\x0D]+", edge.lower(t or "")) + [None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    c = Counter(w for words, h in zip(split, held) if not h for w in words)
    n, v = sum(c.values()), len(c)
    for (i, _), words, h in zip(rows, split, held):
        score = sum(math.log10((c[w] + 1) / (n + 1 * (v + 1))) for w in words)
        yield str(i), h, len(words), sum(c[w] > 0 for w in words), n, round(score, 6)


def test_base_score(spark):
    rows = texts() + [(400 + i, edge.prose(i, 40)) for i in range(30)]
    got = lm_score.scored(frame(spark, rows).repartition(4)).collect()
    assert sorted((str(r[0]), *r[1:5], round(r.base_score, 6)) for r in got) == sorted(brute_base(rows))
    assert all(r.score < 0 for r in got)


def test_no_training_rows_and_no_rows(spark):
    only = [i for i in range(200) if lm_score.held_out(i)][:3]
    got = lm_score.scored(frame(spark, [(i, "some text") for i in only])).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens) for r in got} == {(3, 0, 0)}
    assert lm_score.scored(frame(spark, [])).count() == 0


def test_the_model_is_a_distribution_and_predicts_held_out_text(spark):
    rows = [(i, edge.prose(1000 + i, 150)) for i in range(300)]
    model = fitted(spark.createDataFrame(rows, "_id bigint, _text string").repartition(3))
    context = int.from_bytes(b"alph", "big") << 8
    with np.errstate(over="ignore"):
        total = (10 ** model.log10(context + np.arange(256))).sum()
    assert abs(total - 1) < 1e-9
    texts_out = [t for i, t in rows if lm_score.held_out(i)]
    score, size = model.score(texts_out)
    bits = -score.sum() / math.log10(2) / size.sum()
    data = "".join(texts_out).encode()
    order0 = -sum(n * math.log2(n / len(data)) for n in Counter(data).values()) / len(data)
    assert bits < 0.6 * order0


def brute_counts(rows, order, context, prefix):
    """(zeros, ones) that follow ``context`` and the bits ``prefix`` in the training texts."""
    out = [0, 0]
    for i, t in rows:
        if lm_score.training(i):
            data = bytes(4) + t.encode() + bytes([lm_score.END])
            for at in range(4, len(data)):
                if data[at - order : at] == context and format(data[at], "08b").startswith(prefix):
                    out[format(data[at], "08b")[len(prefix)] == "1"] += 1
    return tuple(out)


def test_every_context_has_counts_of_its_own(spark):
    """More contexts than 2^20 slots hold apart: counts equal brute force, and the
    queries' scores those of the whole model, also of a part that comes twice."""
    draw = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzäöüßéèñçøåæœабвгдежзийклмно0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    rows = [(i, "".join(draw.choice(letters, 6000))) for i in range(40)]
    df = spark.createDataFrame(rows, "_id bigint, _text string").repartition(3).cache()
    model = fitted(df)
    assert sum(len(np.unique(model.far[-1].keys >> (8 - bit))) for bit in range(8)) > 1 << 20
    text = rows[3][1].encode()
    for at in range(50, 1000, 97):
        for order, table in zip(lm_score.ORDERS, model.near + model.far):
            bit = at % 8
            gram = np.array([int.from_bytes(text[at - 4 : at + 1], "big")])
            zeros, ones = table.of(gram, bit)
            assert (zeros[0], ones[0]) == brute_counts(rows, order, text[at - order : at], format(text[at], "08b")[:bit])
    docs = df.selectExpr("_id doc_id", "_text text")
    twice = docs.coalesce(1).union(docs.coalesce(1))
    model = fitted(twice.selectExpr("doc_id _id", "text _text"))
    wanted = sorted([(i, round(s, 4)) for (i, _), s in zip(rows, model.score([t for _, t in rows])[0])] * 2)
    assert sorted((r.doc_id, round(r.score, 4)) for r in lm_score.scored(twice).collect()) == wanted


def slow_score(text, training, weights, refined):
    """log10 probability of a text, symbol by symbol and bit by bit, from counts
    that are taken from the training texts anew for every bit."""

    def symbols(t):
        return [0, 0, 0, 0, *t.encode(), 255]

    followed = {}  # (order, context) -> symbols that followed
    for t in training:
        data = symbols(t)
        for at in range(4, len(data)):
            for order in (1, 2, 3, 4):
                followed.setdefault((order, tuple(data[at - order : at])), []).append(data[at])
    total, data = 0.0, symbols(text)
    for at in range(4, len(data)):
        bits = f"{data[at]:08b}"
        for k in range(8):
            odds, seen = [], []
            for order in (1, 2, 3, 4):
                after = [f"{s:08b}" for s in followed.get((order, tuple(data[at - order : at])), [])]
                after = [s[k] for s in after if s[:k] == bits[:k]]
                one, zero = after.count("1"), after.count("0")
                odds.append(min(8.0, max(-8.0, math.log((one + 0.2) / (zero + 0.2)))))
                seen.append(int(min(math.log2(zero + one + 1) / 2, 4)))
            own = weights[k * 25 + seen[3] * 5 + seen[2]]
            mixed = sum(o * float(w) for o, w in zip(odds, own)) + 0.3 * float(own[4])
            mixed = min(12.0, max(-12.0, mixed))
            place = min(32, max(0, round((mixed + 8) * 2)))
            before = int("1" + bits[:k], 2)
            p = (1 / (1 + math.exp(-mixed)) + float(refined[before * 33 + place])) / 2
            p = min(1 - 1e-6, max(1e-6, p))
            total += math.log10(p if bits[k] == "1" else 1 - p)
    return total


def test_scores_like_a_slow_mixer(spark):
    """The weights are the learned ones; counts, gates, odds and products are done anew."""
    rows = [(i, edge.prose(600 + i, 25)) for i in range(20)] + [(50, "é\U0001f600 ß"), (51, ""), (52, "unseen QZX")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    model = lm_score.learned(lm_score.gram_parts(lm_score.gram_rows(df.selectExpr("doc_id _id", "text _text").cache())))
    training = [t for i, t in rows if not (zlib.crc32(str(i).encode()) % 7 == 2)]
    got = {r.doc_id: r.score for r in lm_score.scored(df).collect()}
    again = {r.doc_id: r.score for r in lm_score.scored(df).collect()}
    assert all(abs(got[i] - again[i]) < 1e-4 for i in got)
    for i, t in [*rows[:4], *rows[-3:]]:
        assert abs(got[i] - slow_score(t, training, model.weights, model.refined)) < 2e-3 * max(1, len(t))
