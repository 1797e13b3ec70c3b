"""Fill-in-the-middle examples against brute force on strings, and back again."""

import hashlib
import re

import pytest
from edge import frame, texts

from assetops.llm import fill_in_middle as fim

ODD = [
    (300, "a\nb\nc <P> d\n"),
    (301, "<S>"),
    (302, "x<M>\n"),
    (303, "\n\n\n"),
    (304, "é\r\nñ\n\U0001f600"),
    (305, "<P\n>\n<M \n"),
    (306, "one line"),
    (307, "line\n" * 5000),
    (-308, "a\n\nb"),
]


def brute(i, t, plain_from=100, spm_below=50, seed=7):
    """(n, form, prefix, middle, suffix) with plain strings."""
    t = t or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", t)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    lo, hi = sorted(x % (n + 1) for x in h[:2])
    form = "spm" if h[3] % 100 < spm_below else "psm"
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= plain_from:
        form = "plain"
    return n, form, "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])


def output(form, prefix, middle, suffix):
    if form == "plain":
        return prefix + middle + suffix
    return f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows():
    return texts() + ODD + [(400 + i, f"{i}\nb\nc\nd\ne") for i in range(60)]


@pytest.mark.parametrize("parameters", [{}, {"plain_from": 40, "spm_below": 10, "seed": 3}])
def test_like_brute_force(spark, parameters):
    got = fim.digest(frame(spark, rows()).repartition(4), **parameters).collect()
    wanted = []
    for i, t in rows():
        n, form, p, m, s = brute(i, t, **parameters)
        lens = (None, None) if form == "plain" else (len(p), len(m))
        wanted.append((str(i), n, form, *map(str, lens), sha(output(form, p, m, s)), sha(t or "")))
    assert sorted((str(r[0]), r[1], r[2], str(r[3]), str(r[4]), r[5], r[6]) for r in got) == sorted(wanted)
    assert {w[2] for w in wanted} == {"plain", "psm", "spm"}


def test_texts_and_back(spark):
    made = fim.transformed(frame(spark, rows()))
    assert made.columns == [*frame(spark, []).columns, "form", "output"]
    wanted = sorted((str(i), output(*brute(i, t)[1:])) for i, t in rows())
    assert sorted((str(r.doc_id), r.output) for r in made.collect()) == wanted
    # Only form and output are needed for the way back.
    back = fim.restored(made.select("doc_id", "form", "output"))
    assert sorted((str(r.doc_id), r.restored) for r in back.collect()) == sorted((str(i), t or "") for i, t in rows())


def test_descriptors_cover_the_text_once():
    text = memoryview("α\nβγ\nδ".encode())
    for i in range(50):
        e = fim.example(i, text)
        pieces = [d for d in e.arranged() if d[0] == 0]
        assert sorted(pieces)[0][1] == 0 and sum(d[2] for d in pieces) == len(text)
        assert b"".join(fim.read([e.prefix, e.middle, e.suffix], text)) == bytes(text)


def test_empty_table_and_clashing_names(spark):
    assert fim.digest(frame(spark, [])).count() == 0 and fim.transformed(frame(spark, [])).count() == 0
    with pytest.raises(ValueError, match="already has"):
        fim.transformed(frame(spark, []).withColumnRenamed("node", "form"))
