"""Secret scans over an incremental blob ledger.

Every version of a document is addressed by the SHA-256 of its text.  The
ledger records which rule versions have seen which blob and what they found; a
run scans only (blob, rule version) pairs that the ledger lacks, appends them,
and joins the findings back to every path with that blob.  Rules are regular
expressions; the positions of their matches follow from the lengths of the
pieces between them, so everything stays in SQL expressions.

The ledger only grows: a run adds rows to its folder and replaces none, so a run
that is repeated, or whose name is used again, adds what is unseen and loses
nothing.  Every stored span names the rule version that found it, and a report
takes the spans of its own rule versions only.

Spans are code points, end exclusive.  A NULL text is empty; empty texts have
no spans; rows that repeat an id or a text are all returned; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetops.llm.common import let, whole
from assetops.storage import cut

SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"
STORED = "array<struct<start:int,rank:int,end:int,kind:string,rule:string>>"


@dataclass(frozen=True)
class SecretRule:
    """Matches of ``pattern``, leftmost and without overlap, whose ``group`` has
    ``least`` code points or more.  A new ``version`` scans every blob again."""

    kind: str
    rank: int
    pattern: str
    least: int = 0
    group: int = 0
    version: int = 1

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


#: Runs shorter than the bound can't hold a longer match, so the two simple
#: patterns ask for the bound at once.  ``assign`` must consume failing matches.
BASE = (
    SecretRule(
        "assign",
        0,
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=12,
        group=2,
    ),
    SecretRule("access", 1, r"AKIA[A-Z0-9]{14,}"),
    SecretRule("hex", 2, r"[0-9a-f]{16,}"),
)
MORE = (
    SecretRule("private_key", 3, r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    SecretRule("jwt", 4, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    SecretRule("url_login", 5, r"[a-z][a-z0-9+.-]{1,15}://[^\s:/@]{1,64}:[^\s:/@]{3,64}@"),
)
RULES = BASE + MORE


def spans(text: Column, rule: SecretRule) -> Column:
    """The rule's spans in one text."""
    pattern, none = F.lit(rule.pattern), F.array().cast(SPAN)

    def place(found: Column, sized: Column) -> Column:
        def walk(parts: Column) -> Column:
            def step(state: Column, i: Column) -> Column:
                start = state["at"] + F.length(F.get(parts, i))
                end = start + F.length(F.get(found, i))
                span = F.array(F.struct(start.alias("start"), F.lit(rule.rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind")))
                out = F.when(F.length(F.get(sized, i)) >= rule.least, F.concat(state["out"], span.cast(SPAN))).otherwise(state["out"])
                return F.struct(end.alias("at"), out.alias("out"))

            start = F.struct(F.lit(0).alias("at"), none.alias("out"))
            return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), start, step, lambda state: state["out"])

        return F.when(F.size(found) == 0, none).otherwise(let(F.split(text, rule.pattern, -1), walk))

    def sized(found: Column) -> Column:
        if not rule.group:
            return place(found, found)
        groups = F.regexp_extract_all(text, pattern, F.lit(rule.group))
        return F.when(F.size(found) == 0, none).otherwise(let(groups, lambda g: place(found, g)))

    return let(F.regexp_extract_all(text, pattern, F.lit(0)), sized)


def _read(spark: SparkSession, ledger: str) -> DataFrame | None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.parquet(f"{ledger}/*") if system.exists(path) else None


def scan(texts: DataFrame, ledger: str, run: str, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """Adds to ``ledger`` what ``rules`` find in the blobs of ``texts``
    (``_text``) that they have not seen, in folder ``run``.  Returns the ledger's
    (blob, spans) for the rule versions given, one row per blob."""
    spark = texts.sparkSession
    known = _read(spark, ledger)
    blobs = texts.select(F.sha2("_text", 256).alias("blob"), "_text")
    wanted = F.array(*(F.lit(rule.id) for rule in rules))
    if known is None:
        unseen = blobs.withColumn("_todo", wanted)
    else:
        seen = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("checked"))).alias("_seen"))
        unseen = (
            blobs.join(seen, "blob", "left")
            .withColumn("_todo", F.array_except(wanted, F.coalesce("_seen", F.array().cast("array<string>"))))
            .where(F.size("_todo") > 0)
            .drop("_seen")
        )
    # Copies of a blob, however many, are reduced before the shuffle.
    once = unseen.dropDuplicates(["blob"])
    def stored(rule: SecretRule) -> Column:
        named = F.transform(spans(F.col("_text"), rule), lambda s: s.withField("rule", F.lit(rule.id)))
        none = F.array().cast(STORED)
        return F.when(F.array_contains("_todo", rule.id), named.cast(STORED)).otherwise(none)

    found = F.concat(*(stored(rule) for rule in rules))
    once.select("blob", F.col("_todo").alias("checked"), found.alias("spans")).write.mode("append").parquet(f"{ledger}/{run}")
    ids = [rule.id for rule in rules]
    current = (
        spark.read.parquet(f"{ledger}/*")
        .where(F.arrays_overlap("checked", wanted))
        .groupBy("blob")
        .agg(F.flatten(F.collect_list(F.filter("spans", lambda s: s["rule"].isin(ids)))).alias("spans"))
    )
    plain = F.transform("spans", lambda s: s.dropFields("rule")).cast(SPAN)
    return current.select("blob", F.sort_array(F.array_distinct(plain)).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(
    docs: DataFrame, ledger: str, run: str, id_col: str = "doc_id", text_col: str = "text", rules: tuple[SecretRule, ...] = RULES
) -> DataFrame:
    """Every row of ``docs`` with its blob and ``spans``."""
    texts = docs.select(F.col(id_col), whole(F.col(text_col)).alias("_text"))
    # Most blobs have no spans and need not travel back.  Written out, so that
    # the join reads two plain exchanges and a hot blob's paths are split.
    findings = cut(scan(texts, ledger, run, rules).where(F.size("spans") > 0))
    paths = texts.select(id_col, F.sha2("_text", 256).alias("blob"))
    return paths.join(findings, "blob", "left").select(id_col, "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans"))


def digest(docs: DataFrame, ledger: str, run: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, their digest, and all spans as text."""
    found = report(docs, ledger, run, id_col, text_col)
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))

    def count(rule: SecretRule) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == rule.kind)).cast("bigint").alias(f"n_{rule.kind}")

    counts = [count(rule) for rule in BASE]
    return found.select(
        id_col, *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), "blob"
    )
