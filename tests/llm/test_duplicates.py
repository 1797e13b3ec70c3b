"""Near duplicates, benchmark search and repeated strings against brute force."""

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter

import edge
import numpy as np
import pytest
from edge import SCHEMA, frame, texts

from assetops.llm import decontaminate, minhash_dedup, suffix_dedup
from assetops.llm.shingles import of_texts
from assetops.llm.wordtable import pack, unpack


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def bags(texts):
    """Five-word shingles of each text as word tuples with their counts, from words up."""
    for text in texts:
        words = re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", text.lower())
        grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)][: bool(words)]
        yield Counter(grams)


def brute_weights(rows, share=0.25):
    """Weight of every shingle: 1 + share * log((n + 1) / (documents + 1)) / log(n + 2)."""
    documents = Counter()
    for bag in bags([t or "" for _, t in rows]):
        documents.update(bag.keys())
    n = len(rows)
    return {g: 1 + share * math.log((n + 1) / (d + 1)) / math.log(n + 2) for g, d in documents.items()}


def jaccard(a, b, weight):
    both = sum(min(n, b[g]) * weight[g] for g, n in a.items() if g in b)
    total = sum(n * weight[g] for g, n in a.items()) + sum(n * weight[g] for g, n in b.items())
    return both / (total - both) if a and b else 0.0


def brute_classes(rows, weight=None, least=0.8):
    """(id, smallest id of its class) of every row, comparing all pairs of texts."""
    weight = brute_weights(rows) if weight is None else weight
    distinct = sorted({t or "" for _, t in rows})
    sets = list(bags(distinct))
    parent = list(range(len(distinct)))
    for a in range(len(distinct)):
        for b in range(a):
            if jaccard(sets[a], sets[b], weight) >= least:
                parent[find(parent, a)] = find(parent, b)
    number = {t: find(parent, i) for i, t in enumerate(distinct)}
    least_id = {}
    for i, t in rows:
        n = number[t or ""]
        if i is not None:
            least_id[n] = min(i, least_id.get(n) if least_id.get(n) is not None else i)
        else:
            least_id.setdefault(n, None)
    return sorted((str(i), str(least_id[number[t or ""]])) for i, t in rows)


def near(seed, words, edits):
    draw = random.Random(seed)
    base = edge.prose(words, words).split(" ")
    for at in draw.sample(range(len(base)), edits):
        base[at] = f"edit{draw.randrange(10**6)}"
    return " ".join(base)


def test_classes(spark):
    rows = texts() + [(1000 + i, near(i, 250, i % 9)) for i in range(60)] + [(2000, "three words only"), (2001, "Three words, only!")]
    rows += [(3000 + i, edge.prose(3000 + i, 120)) for i in range(40)]
    df = frame(spark, rows).repartition(4)
    got = sorted((str(r.doc_id), str(r.class_id)) for r in minhash_dedup.classes(df).collect())
    assert got == brute_classes(rows)
    out = minhash_dedup.deduped(df)
    assert out.columns == df.columns
    classes = {c for _, c in got if c != "None"}
    assert sorted({r.doc_id for r in out.collect() if r.doc_id is not None}) == sorted(map(int, classes))
    assert minhash_dedup.classes(frame(spark, [])).count() == 0 and minhash_dedup.deduped(frame(spark, [])).count() == 0


@pytest.mark.parametrize("block", [64, 3])
def test_no_link_is_lost_inside_a_bucket(spark, monkeypatch, block):
    """All nodes in one bucket, chained: each is similar to its neighbours only."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    monkeypatch.setattr(minhash_dedup, "LEADERS", 3)
    words = edge.prose(5, 900).split()
    rows = [(i, " ".join(words[7 * i : 7 * i + 100])) for i in range(25)]
    rows += [(100 + i, " ".join(words[500 + 15 * i : 600 + 15 * i])) for i in range(8)]
    # Lengths that grow by just under and just over what a link allows.
    rows += [(200 + i, " ".join(words[: int(60 * 1.24**i)])) for i in range(10)] + [(300 + i, " ".join(words[880 - int(50 * 1.27**i) : 880])) for i in range(9)]
    df = minhash_dedup.rows_of(frame(spark, rows), "doc_id", "text")
    sets = {t: len(bag) for (_, t), bag in zip(rows, bags([t for _, t in rows]))}
    flat = [(i, hashlib.md5(t.encode()).digest(), [7], pack(np.ones(sets[t], np.float32)), float(sum(next(bags([t])).values()))) for i, t in rows]
    signatures = spark.createDataFrame(flat, "id bigint, node binary, bands array<bigint>, weights binary, total double")
    found = minhash_dedup.links(df, signatures, 0.8)
    labels = {bytes(r.node): bytes(r.label) for r in minhash_dedup.components(found).collect()}
    md5 = {i: hashlib.md5(t.encode()).digest() for i, t in rows}
    got = {}
    for i, _ in rows:
        got.setdefault(labels.get(md5[i], md5[i]), []).append(str(i))
    wanted = {}
    for i, c in brute_classes(rows, Counter({g: 1 for _, t in rows for g in next(bags([t]))})):
        wanted.setdefault(c, []).append(i)
    assert sorted(sorted(g) for g in got.values()) == sorted(sorted(w) for w in wanted.values())


def test_samples_estimate_weighted_similarity():
    draw = np.random.default_rng(3)
    agree = exact = 0.0
    with np.errstate(over="ignore"):
        for _ in range(60):
            items = np.sort(draw.integers(0, 2**63, 90, dtype=np.uint64))
            weight = draw.uniform(0.3, 4, 90)
            a, b = (items[:70], weight[:70]), (items[20:], weight[20:] * draw.choice([1.0, 2.0], 70))
            agree += (minhash_dedup.samples(*a) == minhash_dedup.samples(*b)).mean()
            exact += minhash_dedup.similarity(a, b)
    assert abs(agree - exact) / 60 < 0.04


def test_few_shingles_are_drawn_in_full(monkeypatch):
    """The samples of sets of any size and weight are those of drawing every shingle."""
    drawn, wanted, draw = [], minhash_dedup._drawn, np.random.default_rng(4)
    monkeypatch.setattr(minhash_dedup, "_drawn", lambda bits, b, w: drawn.append(len(w)) or wanted(bits, b, w))
    sizes = [1, 2, 700, 400, 1023, 1024, 1025, 5000, 3] * 3
    sets = [(np.sort(draw.integers(0, 2**64, n, dtype=np.uint64)), draw.uniform(1, 1.25, n) * draw.choice([1, 1, 1, 40], n)) for n in sizes]
    with np.errstate(over="ignore"):
        got = minhash_dedup.samples_of(sets)
        assert sum(drawn) < 0.2 * sum(sizes) * minhash_dedup.BANDS * minhash_dedup.ROWS
        for (u, w), own in zip(sets, got):
            bits, second = (minhash_dedup._mixed(u, minhash_dedup._SEEDS[k][:, None]) for k in (0, 1))
            b = (second >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
            a, t = (x.reshape(b.shape) for x in wanted(bits.ravel(), b.ravel(), np.tile(np.log(w).astype(np.float32), len(b))))
            level = t[np.arange(len(b)), np.argmin(a, axis=1)].astype(np.int64) + (1 << 20)
            assert (own == minhash_dedup.mix(u[np.argmin(a, axis=1)] ^ minhash_dedup.mix(level.astype(np.uint64) ^ minhash_dedup._SEEDS[2]))).all()


def test_a_chunk_holds_no_texts_beside_its_shingles():
    words = np.array([f"w{i}" for i in range(200000)])
    draw = np.random.default_rng(0)
    rows = [(i, " ".join(words[draw.integers(0, len(words), 300)])) for i in range(4500)]
    batches = [minhash_dedup.pa.record_batch([[i], [b"%016d" % i], [t]], names=["id", "node", "text"]) for i, t in rows]
    with np.errstate(over="ignore"):
        list(minhash_dedup._sent(8)(iter(batches[:5])))
        tracemalloc.start()
        for _ in minhash_dedup._sent(8)(iter(batches)):
            pass
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60e6


def test_every_shingle_has_a_frequency_of_its_own(spark):
    """Weights equal those of independently counted documents, where a table of
    2^20 buckets is shared, and with a part that comes twice."""
    draw = random.Random(6)
    rows = [(i, " ".join(str(draw.randrange(10**9)) for _ in range(9000)) + " " + edge.SHARED) for i in range(25)]
    rows += [(100 + i, t) for i, t in enumerate([rows[0][1], rows[0][1] + " and more", "", "one", "one"])]
    docs = frame(spark, rows).coalesce(1)
    df = docs.union(docs)
    documents = Counter()
    sets = {t: np.unique(h) for t, h in zip((t for _, t in rows), of_texts([t for _, t in rows]))}
    for _, t in rows:
        documents.update(sets[t].tolist())
    n, found = 2 * len(rows), minhash_dedup.signed(minhash_dedup.rows_of(df, "doc_id", "text")).collect()
    md5 = {hashlib.md5(t.encode()).digest(): t for _, t in rows}
    assert sorted(r.id for r in found) == sorted(i for i, _ in rows * 2)
    for r in found:
        own = sets[md5[bytes(r.node)]].tolist()
        wanted = [1 + minhash_dedup.IDF_SHARE * math.log((n + 1) / (2 * documents[h] + 1)) / math.log(n + 2) for h in own]
        assert np.allclose(unpack(bytes(r.weights), np.float32), wanted, rtol=1e-6) and (r.bands is None) == (not own)


def test_frequent_shingles_weigh_less(spark):
    rows = [(i, edge.SHARED + " " + edge.prose(i, 30)) for i in range(300)]
    weight = brute_weights(rows)
    common, rare = next(bags([edge.SHARED])), next(bags([edge.prose(7, 30)]))
    assert max(weight[g] for g in common) < min(weight[g] for g in rare) and 1 <= min(weight.values()) <= max(weight.values()) <= 1.25
    found = minhash_dedup.signed(minhash_dedup.rows_of(frame(spark, rows), "doc_id", "text")).where("id = 7").first()
    own = next(bags([rows[7][1]]))
    assert np.allclose(np.sort(unpack(bytes(found.weights), np.float32)), sorted(weight[g] for g in own), rtol=1e-6)


def test_a_large_group_of_near_copies_sends_stragglers_only(spark):
    """Half of a bucket is linked to its leader; the rest finds its class without all pairs."""
    rows = [(i, near(77, 300, 0) + " " + " ".join(f"x{i}y{j}" for j in range(30 + 25 * (i % 2)))) for i in range(120)]
    df = frame(spark, rows)
    got = sorted((str(r.doc_id), str(r.class_id)) for r in minhash_dedup.classes(df).collect())
    assert got == brute_classes(rows) and len({c for _, c in got}) > 1


ITEMS = [
    (0, edge.prose(501, 30)), (1, edge.prose(502, 12)), (2, "just four little words"), (3, "one"), (4, ""), (5, None), (6, " .,; "),
    (7, edge.prose(503, 300)), (8, edge.prose(501, 30)), (9, "Wörter mit Ümläuten sind auch Wörter, nicht wahr"), (None, edge.prose(504, 20)),
]


def shingle_set(text, width):
    import re

    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}, len(w)


def leaky():
    draw = random.Random(4)
    rows = texts()
    for j, (_, text) in enumerate(ITEMS):
        for share in (1.0, 0.9, 0.8, 0.5):
            w = (text or "").split()
            part = " ".join(w[: round(len(w) * share)])
            rows.append((600 + 10 * j + int(share * 10) % 10, f"{edge.prose(draw.randrange(10**6), 700)} {part.upper()}! {edge.prose(j, 50)}"))
    return rows + [(600, ITEMS[0][1]), (900, "One."), (901, ITEMS[7][1] * 40)]


def test_benchmark_pairs(spark):
    rows = leaky()
    items = spark.createDataFrame([(i, t, "clash") for i, t in ITEMS], "item_id bigint, text string, doc_id string")
    wanted = {}
    for item, text in ITEMS:
        size = shingle_set(text, 1)[1]
        if not size:
            continue
        own = shingle_set(text, min(5, size))[0]
        for i, t in rows:
            share = len(own & shingle_set(t, min(5, size))[0]) / len(own)
            if share >= 0.8:
                key = (str(i), str(item))
                wanted[key] = (max(round(share, 9), wanted.get(key, (0,))[0]), len(own))
    got = decontaminate.pairs(frame(spark, rows), items)
    assert {(str(r.doc_id), str(r.item_id)): (round(r.containment, 9), r.n_shingles) for r in got.collect()} == wanted
    clean = decontaminate.clean(frame(spark, rows), items)
    assert clean.columns == SCHEMA.replace(",", "").split()[::2]
    assert clean.count() == sum(not any(shingle_set(x, 1)[1] and len(shingle_set(x, n)[0] & shingle_set(t, n)[0]) >= 0.8 * len(shingle_set(x, n)[0]) for x, n in ((x, min(5, shingle_set(x, 1)[1])) for _, x in ITEMS) if n) for _, t in rows)
    none = items.where("item_id = 4")
    assert decontaminate.pairs(frame(spark, rows), none).count() == 0 and decontaminate.clean(frame(spark, rows), none).count() == len(rows)
    assert decontaminate.pairs(frame(spark, []), items).count() == 0


def test_benchmark_beyond_the_broadcast_bound(spark, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    small = sorted(map(str, decontaminate.pairs(frame(spark, leaky()), items).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert sorted(map(str, decontaminate.pairs(frame(spark, leaky()), items).collect())) == small


def brute_removed(rows, length):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            s = b[k : k + length]
            gone[k : k + length] |= s in seen
            seen.add(s)
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((str(i), len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("length, gram", [(100, 32), (40, 12)])
def test_repeated_strings(spark, length, gram):
    passage = edge.prose(77, 40)
    # Equal ids with unequal texts have no order of their own.
    rows = [r for r in texts() if r[0] not in (51, None)] + [(None, edge.prose(9, 70))]
    rows += [(500 + i, f"{edge.prose(i, 9)} {passage[i:200 - i]}\n{edge.prose(i + 50, 20)}") for i in range(30)]
    rows += [(700, "ab" * 400), (701, "a" * 500 + passage), (702, "ab" * 60), (703, passage * 3)]
    got = suffix_dedup.deduped(frame(spark, rows).repartition(7), length=length, gram=gram)
    seen = [(str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()]
    assert sorted(seen) == brute_removed(rows, length)
    assert suffix_dedup.deduped(frame(spark, [])).count() == 0


def test_equal_batches_keep_one_copy(spark):
    """Equal long rows alone in their partitions, and a part delivered three times."""
    one = [(1, edge.prose(21, 60))]
    part = [(i, f"{edge.prose(800 + i, 40)} {one[0][1][30:250]} {edge.prose(900 + i % 2, 30)}") for i in range(5)] + [(7, "short"), (8, None)]
    for rows, times in ((one, 2), (part, 3)):
        docs = frame(spark, rows).coalesce(1)
        df = docs
        for _ in range(times - 1):
            df = df.union(docs)
        got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.deduped(df).collect())
        assert got == brute_removed(rows * times, 100)
    assert sorted(r.kept for r in suffix_dedup.deduped(frame(spark, one).union(frame(spark, one))).collect()) == [b"", one[0][1].encode()]


def test_long_texts_are_cut_into_segments(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 4096)
    text = edge.prose(3, 3000).encode()
    with np.errstate(over="ignore"):
        s = suffix_dedup.suffixes([b"x", text, text])
        monkeypatch.setattr(suffix_dedup, "SEGMENT", 1 << 19)
        whole = suffix_dedup.suffixes([b"x", text, text])
    for found in (s, whole):
        starts = sorted((r, a + j) for r, a, n in zip(found["row"], found["start"], found["n"]) for j in range(n))
        assert starts == [(r, k) for r in (1, 2) for k in range(len(text) - 99)]


def test_short_texts_are_hashed_in_small_groups(monkeypatch):
    """Groups stay near the CPU and do not change the suffixes; strings are
    fingerprinted twice only where an anchor has several surroundings."""
    texts = [edge.prose(i, 20 + 7 * (i % 40)).encode() for i in range(300)] + [edge.prose(3, 3000).encode(), b"", b"a" * 99, b"a" * 100]
    sizes = [sum(len(part) for *_, part in group) for group in suffix_dedup._segments(texts[:300], 100)]
    assert len(sizes) > 1 and max(sizes) <= suffix_dedup.GROUP
    with np.errstate(over="ignore"):
        found = suffix_dedup.suffixes(texts)
        monkeypatch.setattr(suffix_dedup, "GROUP", 1 << 19)
        whole = suffix_dedup.suffixes(texts)
        assert all(np.array_equal(found[c], whole[c]) for c in whole)
        assert suffix_dedup._least(np.array([5, 3, 4, 9, 8, 7, 1], np.uint64), 3).tolist() == [3, 3, 4, 7, 1]
        second, own = [], suffix_dedup.Prints.__init__
        monkeypatch.setattr(suffix_dedup.Prints, "__init__", lambda self, data, which=0, place=None: second.append(len(data) * which) or own(self, data, which, place))
        held = []
        for name, extra in ((1, b""), (2, b"X")):
            batch = suffix_dedup.Batch()
            for i, t in enumerate(texts[:300]):
                batch.add(1000 * name + i, t if i else t[:200] + extra + t[200:])
            s, _ = suffix_dedup._sent(batch, 100, 32)
            by = np.argsort(s["anchor"], kind="stable")
            fields = np.array([suffix_dedup._order(batch.ids)[s["row"]], s["row"], s["start"], s["n"], s["offset"]], np.int64)[:, by]
            bytes_ = b"".join(batch.texts[r][a : a + n + 99] for r, a, n in fields[1:4].T)
            held.append((name, s["anchor"][by], fields, suffix_dedup.zstandard.ZstdCompressor().compress(bytes_)))
        removed = list(suffix_dedup._covered(held, 100))
        assert [b for b, _ in removed] == [2] and 0 < sum(second) < len(bytes_) / 4


def test_family_merges_and_finds_every_meeting():
    draw = np.random.default_rng(1)
    family, anchors = suffix_dedup.Family(2000), draw.integers(0, 3000, 2000, dtype=np.uint64)
    for at in range(0, 2000, 50):
        part = np.arange(at, at + 50)
        part = part[np.argsort(anchors[part], kind="stable")]
        family.add(anchors[part], part)
    value, uses = np.unique(anchors, return_counts=True)
    assert set(np.flatnonzero(family.met)) == set(np.flatnonzero(np.isin(anchors, value[uses > 1])))
    assert len(family.levels) <= 8
