"""The pipeline, stage by stage against plain Python, and as a whole."""

import hashlib
import random
import re

import edge
import numpy as np
import pytest
from edge import SCHEMA
from test_duplicates import brute_classes, near, shingle_set
from test_text_rules import counts, without_lines

import corpus_pipeline
from assetops.llm.queries import tokenizer_file

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row int, _text string"


def corpus():
    """Unique ids; clean, copied, near, shouting, symbolic, repetitive and leaking documents."""
    draw = random.Random(11)
    out = [edge.prose(5000 + i, draw.randrange(60, 200)) for i in range(40)]
    out += [out[3], out[3], out[4]] + [near(300 + i, 260, i % 4) for i in range(8)]
    out += [f"{edge.prose(6000 + i, 80)}\n{edge.SHARED}\n{edge.prose(6100 + i, 60)}" for i in range(7)]
    out += ["", None, "too short", " ".join("LOUD! words!" for _ in range(60)), " ".join(f"a{i} ### $$" for i in range(80)), "a b c d " * 40]
    out += ["\n".join(["same old line of some words"] * 9 + [edge.prose(1, 70)]), "word" * 900, ("longword" * 3 + " ") * 80]
    out += [f"{edge.prose(7000, 90)} {item} {edge.prose(7001, 90)}" for item in LEAKS]
    return list(enumerate(out))


LEAKS = [edge.prose(9000, 30), edge.prose(9001, 45)]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", "src0", len(t or ""), 1, "clash") for i, t in corpus()]
    spark.createDataFrame(rows, COLUMNS).repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(LEAKS)), "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def rejected(text):
    n, chars, symbols, dup, repeats = counts(text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = len((text or "").split("\n"))
    return (
        n < 50 or 100 * repeats > 50 * n or 10 * symbols > n or not 3 * n <= chars <= 10 * n
        or 100 * sum(w.endswith("!") for w in words) > 30 * n or dup >= 4 and 100 * dup > 30 * lines
    )


def brute():
    docs = [(i, t) for i, t in corpus() if not rejected(t)]
    yield docs
    docs = [(i, text) for _, i, _, _, text in without_lines(docs)]
    yield docs
    first = {int(c) for _, c in brute_classes(docs)}
    docs = [(i, t) for i, t in docs if i in first]
    yield docs
    items = [shingle_set(t, 5)[0] for t in LEAKS]
    yield [(i, t) for i, t in docs if all(len(item & shingle_set(t, 5)[0]) < 0.8 * len(item) for item in items)]


def test_every_stage_and_the_whole(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    last = None
    for (name, stage), wanted in zip(corpus_pipeline.STAGES, brute()):
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert sorted((r.doc_id, r.text) for r in rows) == sorted(wanted), name
        assert all(r._text == "clash" and r.n_chars == len(r.text) for r in rows), name
        docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
        last = wanted
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(tokenizer_file())
    tokens = []
    for i, t in last:
        ids = library.encode(t, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        tokens.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted(tokens)
    assert 20 < len(tokens) < len(corpus()) - 10


def test_stages_of_empty_and_null_rows(spark, sf_dir):
    empty = spark.createDataFrame([], COLUMNS)
    odd = spark.createDataFrame([(None, None, None, None, None, None, None), (1, "", None, "s", 0, 1, "x"), (1, "", None, "s", 0, 1, "x")], COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0, name
        left = stage(spark, odd, sf_dir).count()
        assert left == {"quality_rules": 0, "minhash_dedup": 2}.get(name, 3), name


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "minhash_dedup", "decontaminate", "bpe"]
    assert SCHEMA and corpus_pipeline.ORACLE_SQL is None
