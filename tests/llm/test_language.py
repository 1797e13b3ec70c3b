"""Bit-sliced filters against sets, learning against brute-force counts, held-out accuracy."""

import random
import zlib
from collections import Counter

import edge
import numpy as np
from pyspark.sql import functions as F

from assetops.llm import language_id as ident

SCHEMA = "doc_id bigint, text string, lang string, source string, n_gram bigint, score int"

SYLLABLES = {
    "aa": "ka to mi ra shi no ha".split(),
    "bb": "sch ung er ein lich ver ß".split(),
    "cc": "ов ия на ст ри по".split(),
    "dd": "人 口 大 小 中 日 月 山 川".split(),
}


def prose(lang, seed, n=60):
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 4))) for _ in range(n)) + ". 12 ²"


def rows(n=200):
    return [(i, prose(lang, i), lang) for i in range(n) for lang in [sorted(SYLLABLES)[i % 4]]]


def frame(spark, found):
    return spark.createDataFrame([(i, t, lang, "s", 1, 2) for i, t, lang in found], SCHEMA)


def brute_grams(text):
    """Every n-gram of every word, as text, with a blank for a border."""
    out = Counter()
    for w in ident.words(text):
        w = "".join(c for c in w if c.isalpha())
        if w:
            padded = f" {w} "
            for n in ident.ORDERS:
                found = [padded[i : i + n] for i in range(len(padded) - n + 1)]
                out.update(g for g in found if g.strip() and " " not in g[1:-1])
    return out


def is_held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0


def hash_of(gram):
    """The operator's hash of one n-gram, through a word that has it."""
    padded = f" {gram.strip()} "
    for order, hashes, _ in ident.grams([gram.strip()]):
        own = [padded[i : i + order] for i in range(len(padded) - order + 1)]
        own = [g for g in own if g.strip() and " " not in g[1:-1]]
        for g, h in zip(own, hashes):
            if g == gram:
                return h
    raise KeyError(gram)


def test_grams_of_words():
    texts = ["ka", "a", "naïve", "x²y", "人口", "²"]
    seen = Counter()
    for order, hashes, number in ident.grams(texts):
        seen.update((int(n), order, int(h)) for n, h in zip(number, hashes))
    per_word = Counter()
    for (n, order, _), times in seen.items():
        per_word[n, order] += times
    for n, text in enumerate(texts):
        wanted = Counter()
        for g, times in brute_grams(text).items():
            wanted[len(g)] += times
        assert {o: per_word[n, o] for o in ident.ORDERS if per_word[n, o]} == dict(wanted), text
    # Equal n-grams have equal hashes, different ones different hashes.
    grams = {g for t in texts for g in brute_grams(t)}
    assert len({int(hash_of(g)) for g in grams}) == len(grams)


def test_counts_and_members_like_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ident, "RATE", 40)
    found = rows() + [(1001, None, "aa"), (1002, "", "aa"), (1003, "no label", None), (None, "held out", "bb")]
    filters = ident.learned(frame(spark, found).repartition(3))
    assert filters.languages == sorted(SYLLABLES)
    for place, lang in enumerate(filters.languages):
        counts = Counter()
        for i, t, label in found:
            if label == lang and t and not is_held_out(i):
                counts.update(brute_grams(t))
        members = set()
        for size in ident.ORDERS:
            total = sum(n for g, n in counts.items() if len(g) == size)
            members |= {g for g, n in counts.items() if len(g) == size and n * 40 >= total}
        assert members
        masks = filters.containing(np.array([hash_of(g) for g in sorted(members)], np.uint64))
        assert (masks[:, place // 8] >> place % 8 & 1).all()  # no false negative
        others = [g for g in counts if g not in members]
        wrong = filters.containing(np.array([hash_of(g) for g in others], np.uint64))[:, 0] >> place & 1
        assert wrong.mean() < 0.05


def test_filters_of_many_languages_and_their_correction():
    draw = np.random.default_rng(3)
    sets = {f"l{i:02}": np.unique(draw.integers(0, 2**63, 400 + 40 * i).astype(np.uint64)) for i in range(19)}
    filters = ident.bit_sliced(sets)
    assert filters.slots.shape[1] == 3
    for i, lang in enumerate(filters.languages):
        assert (filters.containing(sets[lang])[:, i // 8] >> i % 8 & 1).all()
    foreign = draw.integers(0, 2**63, 400_000).astype(np.uint64)
    masks = filters.containing(foreign)
    seen = np.array([(masks[:, i // 8] >> i % 8 & 1).mean() for i in range(19)])
    assert np.allclose(seen, filters.false_positive, atol=4e-4) and filters.false_positive.max() > 1e-4
    # Hits that only false positives explain leave no share.
    total = np.array([1000])
    assert np.allclose(filters.shares(filters.false_positive * 1000, total), 0)
    assert np.allclose(filters.shares(np.full((1, 19), 1000), total), 1)


def test_held_out_accuracy_and_plain_cases(spark):
    odd = [(2000, None, "aa"), (2001, "", "aa"), (2002, "12 34 !? ²½", "aa"), (2003, "ка", None), (None, prose("bb", 7), None)]
    odd += [(2004, prose("cc", 1) * 400, None), (2004, prose("aa", 2), None)]
    out = ident.identified(frame(spark, rows() + odd).repartition(4)).collect()
    assert len(out) == 200 + len(odd)
    assert all(r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 for r in out)
    truth = {i: lang for i, _, lang in rows()}
    judged = [(r.lang_pred, truth[r.doc_id]) for r in out if r.held_out and r.doc_id in truth]
    assert len(judged) > 20 and all(a == b for a, b in judged)
    by = {(r.doc_id, r.lang_pred) for r in out}
    assert {(2000, "und"), (2001, "und"), (2002, "und"), (None, "bb"), (2004, "cc"), (2004, "aa")} <= by


def test_a_few_wrong_labels_change_nothing(spark):
    noisy = rows(400) + [(5000 + i, prose("cc", 900 + i), "aa") for i in range(2)]
    out = ident.identified(frame(spark, noisy)).where("doc_id < 400").collect()
    assert all(r.lang_pred == sorted(SYLLABLES)[r.doc_id % 4] for r in out)


def test_nothing_learned_and_empty(spark):
    unlabelled = frame(spark, [(i, prose("aa", i), None) for i in range(10)])
    assert {(r.lang_pred, r.score) for r in ident.identified(unlabelled).collect()} == {("und", 0.0)}
    assert ident.identified(frame(spark, [])).count() == 0


def test_language_and_id_are_no_inputs_of_a_prediction(spark):
    docs = frame(spark, rows(60))
    filters = ident.learned(docs)
    once = {r.doc_id: (r.lang_pred, r.score) for r in ident.predicted(docs, filters).collect()}
    moved = docs.withColumn("doc_id", F.col("doc_id") + 1000).withColumn("lang", F.lit("zz"))
    again = {r.doc_id - 1000: (r.lang_pred, r.score) for r in ident.predicted(moved, filters).collect()}
    assert once == again


def test_texts_of_the_edge_table(spark):
    docs = edge.frame(spark, edge.texts()).withColumn("lang", F.lit("xx"))
    out = ident.identified(docs).collect()
    assert len(out) == len(edge.texts()) and {r.lang_pred for r in out} == {"xx", "und"}


def test_hits_of_words_in_many_languages():
    """Popcounts by word equal the bits of every n-gram, for one, 19 and 130 languages."""
    words = ["ka", "shino", "日本", "a" * 50, "ж"]
    for n in (1, 8, 19, 130):
        sets = {f"l{i:03}": np.array(sorted({int(h) for _, hs, _ in ident.grams(words[i % 5 :]) for h in hs[:: 1 + i % 3]}), np.uint64) for i in range(n)}
        filters = ident.bit_sliced(sets)
        hits, total = filters.hits(words)
        wanted, sizes = np.zeros((5, n)), np.zeros(5)
        for _, hashes, number in ident.grams(words):
            masks = filters.containing(hashes)
            for row, word in zip(masks, number):
                sizes[word] += 1
                for i in range(n):
                    wanted[word, i] += row[i // 8] >> i % 8 & 1
        assert (hits == wanted).all() and (total == sizes).all() and hits.any()
