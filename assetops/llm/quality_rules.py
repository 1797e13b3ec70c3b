"""Quality rules as a short-circuit cascade.

Every rule is one SQL expression over the text.  A bounded sample of whole
documents gives each rule's cost (wall seconds) and rejection rate; the rules
then run in order of rejection per cost, and a document that one rule rejects
is not shown to the rules after it.  The order changes the work and the name of
the first failed rule, never the verdict.

NULL and empty texts have no words and are rejected.  Repeated rows are judged
alike, each on its own; an empty table gives an empty result; columns besides
the text are neither read nor changed.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetops.llm.common import let, whole, words
from assetops.storage import cut

SAMPLE_ROWS = 1000  # documents that the cost and rejection estimates read
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Column, Column], Column]  # of the text and its words


def word_chars(w: Column) -> Column:
    return F.length(F.array_join(w, "")).cast("bigint")


def symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("bigint")


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    full = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(full, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("bigint")


def repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.  Windows are
    sorted by fingerprint, so equal ones are neighbours."""

    def covered(s: Column) -> Column:
        last = F.size(s) - 1

        def same(i: Column, j: Column) -> Column:
            return F.get(s, i)["h"] == F.get(s, j)["h"]

        twice = F.filter(
            F.sequence(F.lit(0), last),
            lambda k: F.when(k > 0, same(k, k - 1)).otherwise(F.lit(False))
            | F.when(k < last, same(k, k + 1)).otherwise(F.lit(False)),
        )
        starts = F.transform(twice, lambda k: F.get(s, k)["i"])
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))

    def count(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(F.sort_array(pairs), covered))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
    )
    return F.when(F.size(w) < 3, 0).otherwise(let(windows, count)).cast("bigint")


def _mean_length(text: Column, w: Column) -> Column:
    chars = word_chars(w)
    return (chars < 3 * F.size(w)) | (chars > 10 * F.size(w))


def _shouting(text: Column, w: Column) -> Column:
    return 100 * F.size(F.filter(w, lambda x: x.endswith("!"))) > 30 * F.size(w)


def _dup_lines(text: Column, w: Column) -> Column:
    lines = F.size(F.split(text, "\n"))
    return let(dup_lines(text), lambda n: (n >= 4) & (100 * n > 30 * lines))


#: Bounds that reject a text; the first and the last are the base rules.
RULES = (
    Rule("words", lambda text, w: F.size(w) < 50),
    Rule("symbols", lambda text, w: 10 * symbols(text) > F.size(w)),
    Rule("mean_length", _mean_length),
    Rule("shouting", _shouting),
    Rule("dup_lines", _dup_lines),
    Rule("repeats", lambda text, w: 100 * repeat_words(w) > 50 * F.size(w)),
)


def ordered(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by falling rejection per second on about ``rows`` documents.
    Only the order of evaluation depends on the sample."""
    total = docs.count()
    share = min(1.0, 1.5 * rows / max(1, total))
    sample = cut(docs.select(whole(F.col(text_col)).alias("_text")).sample(share, seed=9).limit(rows)).coalesce(1)
    rate: dict[str, float] = {}
    sample.agg(F.count("*")).first()
    for rule in rules:
        rejected = first_failed(F.col("_text"), [rule]).isNotNull()
        start = time.perf_counter()
        failed = sample.agg(F.coalesce(F.sum(rejected.cast("int")), F.lit(0)).alias("n")).first()["n"]
        rate[rule.name] = (failed + 0.5) / (time.perf_counter() - start)
    return sorted(rules, key=lambda rule: -rate[rule.name])


def first_failed(text: Column, rules: list[Rule] | tuple[Rule, ...]) -> Column:
    """Name of the first rule, in the given order, that rejects; NULL if none."""

    def chain(w: Column) -> Column:
        out = F.lit(None).cast("string")
        for rule in reversed(rules):
            out = F.when(rule.rejects(text, w), F.lit(rule.name)).otherwise(out)
        return out

    return let(words(text), chain)


def kept(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns."""
    return docs.where(first_failed(whole(F.col(text_col)), ordered(docs, text_col, rules)).isNull())


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: the id, the counts, ``base_failed``, ``kept`` and
    ``failed_rule``, the first failed one in the cascade's order."""
    order = ordered(docs, text_col, rules)
    texts = docs.select(F.col(id_col), whole(F.col(text_col)).alias("_text"))
    text = F.col("_text")

    def verdict(w: Column, n: Column) -> Column:
        out = F.lit(None).cast("string")
        for rule in reversed(order):
            # The base rules' counts are in the result anyway.
            rejects = 100 * n > 50 * F.size(w) if rule.name == "repeats" else rule.rejects(text, w)
            out = F.when(rejects, F.lit(rule.name)).otherwise(out)
        return out

    counts = let(
        words(text),
        lambda w: let(
            repeat_words(w),
            lambda n: F.struct(
                F.size(w).cast("bigint").alias("n_words"),
                word_chars(w).alias("word_chars"),
                n.alias("n_repeat_words"),
                verdict(w, n).alias("failed_rule"),
            ),
        ),
    )
    c = texts.select(id_col, counts.alias("c"), symbols(text).alias("n_symbols"), dup_lines(text).alias("n_dup_lines"))
    failed = (F.col("c.n_words") < 50) | (100 * F.col("c.n_repeat_words") > 50 * F.col("c.n_words"))
    return c.select(
        id_col,
        "c.n_words",
        "c.word_chars",
        "n_symbols",
        "n_dup_lines",
        "c.n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.col("c.failed_rule").isNull()).alias("kept"),
        "c.failed_rule",
    )
