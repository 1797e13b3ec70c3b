"""Exact URL filters as a cascade of Bloom filters.

The key universe is every host, every parent domain and every host with its path
in the corpus.  Level 1 holds the listed keys; level 2 those other keys of the
universe that level 1 lets through by mistake; level 3 the listed keys that level 2
lets through; and so on until a level has no false positive.  For keys of the
universe the depth of the first level that refuses a key answers membership
exactly, so rows are judged without a join.

A level is built in Spark and written as one row, an array of 64-bit words, which
becomes a session variable: the plan names it, and its value travels as one
literal.  All levels together are bounded by ``MAX_BYTES``.
A list beyond that is judged another exact way: its keys are joined with the keys
of the universe, and those that are blocked with the distinct URLs.

A NULL URL, or one without ``://``, has an empty host and path: no rule and no
listed key fits, so it is allowed.  Repeated rows are judged alike; an empty
table or list gives filters that hold nothing; other columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetops.llm.common import lower_ascii, whole
from assetops.storage import cut

BITS_PER_KEY, HASHES = 10, 4
MAX_BYTES = 64 << 20  # of all levels together
MAX_LEVELS = 64
CHUNK_WORDS = 1 << 12  # words of a filter that one row gathers

#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: The list of the query, which reads no list of its own: hosts whose first label is
#: one of these, and one in sixteen of the pages, by the MD5 of host and path.
BAD_LABELS = ("adult-x", "spam-farm", "cheap-pills", "ads-track", "casino-win", "free-bets")
BAD_DIGEST = "0"


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(whole(url), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(whole(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffixes(host: Column) -> Column:
    """The host and its parent domains, longest first."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))


def _positions(key: Column, level: int, bits: int) -> list[Column]:
    """Bit positions by double hashing; each level hashes anew."""
    start, step = (F.pmod(F.xxhash64(F.lit(2 * level + i), key), F.lit(bits)) for i in range(2))
    return [F.pmod(start + i * step, F.lit(bits)) for i in range(HASHES)]


class Level:
    """One Bloom filter: its words, written as one row, as a session variable."""

    def __init__(self, number: int, words: DataFrame | None, size: int):
        self.number, self.bits = number, 64 * size
        self.name = self.words = None
        if words is not None:
            self.name, self.spark = f"filter_{uuid.uuid4().hex}", words.sparkSession
            words.createOrReplaceTempView(f"{self.name}_words")
            self.spark.sql(f"DECLARE VARIABLE {self.name} ARRAY<BIGINT>")
            self.spark.sql(f"SET VAR {self.name} = (SELECT words FROM {self.name}_words)")
            self.spark.catalog.dropTempView(f"{self.name}_words")
            self.words = F.expr(self.name)

    def holds(self, key: Column) -> Column:
        if self.words is None:
            return F.lit(False)
        out = F.lit(True)
        for p in _positions(key, self.number, self.bits):
            word = F.get(self.words, F.floor(p / 64).cast("int"))
            out = out & (F.bit_get(word, F.pmod(p, F.lit(64)).cast("int")) == 1)
        return out

    def release(self) -> None:
        """Drops the variable; frames that name it already keep its value."""
        if self.name is not None:
            self.spark.sql(f"DROP TEMPORARY VARIABLE IF EXISTS {self.name}")


class TooLarge(ValueError):
    """A list whose filters need over ``MAX_BYTES``."""


def _level(keys: DataFrame, number: int, spent: int) -> tuple[Level, int, int]:
    """The filter of ``keys`` (``key``, distinct), their number, and the bytes of all levels so far."""
    n = keys.count()
    size = -(-n * BITS_PER_KEY // 64)
    spent += 8 * size
    if spent > MAX_BYTES:
        raise TooLarge(f"the list needs over {MAX_BYTES} bytes of filters")
    if not n:
        return Level(number, None, 0), 0, spent
    place = keys.select(F.explode(F.array(*_positions(F.col("key"), number, 64 * size))).alias("p"))
    words = place.select(F.floor(F.col("p") / 64).cast("int").alias("w"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("bits"))
    empty = keys.sparkSession.range(size).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("bigint").alias("bits"))
    full = words.union(empty).groupBy("w").agg(F.bit_or("bits").alias("bits"))

    def gathered(rows: DataFrame, at: str, value: str) -> Column:
        pairs = F.sort_array(F.collect_list(F.struct(at, value)))
        return F.transform(pairs, lambda x: x[value])

    chunks = full.groupBy(F.floor(F.col("w") / CHUNK_WORDS).alias("chunk")).agg(gathered(full, "w", "bits").alias("words"))
    # One row of at most MAX_BYTES.
    return Level(number, cut(chunks.agg(F.flatten(gathered(chunks, "chunk", "words")).alias("words"))), size), n, spent


class Cascade:
    """Exact membership in ``listed`` for every key of ``universe``."""

    def __init__(self, universe: DataFrame, listed: DataFrame):
        listed = listed.select("key").distinct()
        inside = universe.select("key").distinct().join(listed, "key", "left_semi")
        outside = universe.select("key").distinct().join(listed, "key", "left_anti")
        self.levels: list[Level] = []
        include, exclude, spent = cut(inside), cut(outside), 0
        while True:
            level, n, spent = _level(include, len(self.levels) + 1, spent)
            if not n:
                break
            self.levels.append(level)
            if len(self.levels) > MAX_LEVELS:
                raise ValueError("the cascade does not end: raise BITS_PER_KEY")
            include, exclude = cut(exclude.where(level.holds(F.col("key")))), include

    def holds(self, key: Column) -> Column:
        """True for listed keys: the number of levels passed is odd."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            out = F.when(self.levels[i].holds(key), out).otherwise(F.lit(i % 2 == 1))
        return out


def rule_of(host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; NULL if none."""
    name = verdict = F.lit(None).cast("string")
    for what, domain, prefix in sorted(RULES, key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        name, verdict = F.when(fits, domain + prefix).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def keys_of(host: Column, path: Column) -> Column:
    """What may be listed of a URL: its host, the parent domains, host and path."""
    return F.array_append(suffixes(host), F.concat(F.lit("/"), host, path))


def universe(urls: DataFrame) -> DataFrame:
    """(key): every key of ``urls`` (``host``, ``path``).  A page's key begins with
    a slash, so it is no host."""
    hosts = urls.where("host != ''").select("host").distinct().select(F.explode(suffixes(F.col("host"))).alias("key"))
    whole_pages = urls.where("host != ''").select(F.concat(F.lit("/"), "host", "path").alias("key"))
    return hosts.union(whole_pages).distinct()


def listed_keys(keys: DataFrame) -> DataFrame:
    """The list that this corpus has: domains whose first label is a bad one, and
    pages whose digest begins with ``BAD_DIGEST``."""
    page = F.col("key").startswith("/")
    digest = F.md5(F.substring("key", 2, 1 << 30)).startswith(BAD_DIGEST)
    return keys.where(F.when(page, digest).otherwise(F.split("key", r"\.")[0].isin(*BAD_LABELS)))


def _by_join(urls: DataFrame, keys: DataFrame, listed: DataFrame) -> DataFrame:
    """``urls`` with ``listed``, for lists of any size: the listed keys of the
    universe, then the distinct hosts and paths that have one."""
    bad = cut(keys.join(listed.select("key").distinct(), "key", "left_semi"))
    distinct = urls.where("host != ''").select("host", "path").distinct()
    found = distinct.select("host", "path", F.explode(keys_of(F.col("host"), F.col("path"))).alias("key")).join(bad, "key", "left_semi")
    # Written out, so that a hot URL's rows are split.
    hit = cut(found.select("host", "path").distinct().withColumn("_hit", F.lit(True)))
    return urls.join(hit, ["host", "path"], "left").withColumn("listed", F.coalesce("_hit", F.lit(False))).drop("_hit")


def judged(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", listed: DataFrame | None = None) -> DataFrame:
    """Per row: id, host, path, the rule that fits and the verdict: the rule's,
    else block if a key of the URL is listed (``listed``: ``key``), else allow."""
    urls = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    keys = cut(universe(urls))
    listed = listed_keys(keys) if listed is None else listed
    try:
        cascade = Cascade(keys, listed)
        blocked = (F.col("host") != "") & F.exists(keys_of(F.col("host"), F.col("path")), cascade.holds)
        urls = urls.withColumn("listed", blocked)
        for level in cascade.levels:
            level.release()
    except TooLarge:
        urls = _by_join(urls, keys, listed)
    rule, verdict = rule_of(F.col("host"), F.col("path"))
    return urls.select(
        id_col, "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict")
    )
