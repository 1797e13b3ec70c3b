"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are partitioned by their number of distinct shingles; each partition
has its own sketch size.  An item's sketch is the bottom-k of its shingle
hashes, a uniform sample of the item, so the share of the sketch that occurs in
a document estimates the item's containment, however long the document is.
Documents are probed with all their shingles; items whose estimate is far below
the threshold are discarded, the others are verified by exact containment of
shingles.  Everything is a SQL expression.

The sketches, rows of fixed width, are broadcast only while they have
``BROADCAST_ROWS`` rows or less; beyond that the same join shuffles.  The items'
shingle strings, whose size follows the items' length, are joined as the optimizer
sees fit by the size of their written table.  Words are runs of letters and digits in
lower case; a shingle has five words, or all of an item with fewer.  A NULL or
empty item, or one without words, is in no document; a NULL or empty document
has no item.  Equal pairs are returned once; rows that repeat an id are searched
one by one, NULL ids stay; empty tables give an empty result; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetops.llm.common import keyed, let, same_row, whole
from assetops.storage import cut

WIDTH = 5
CONTAINMENT = 0.8
#: Sketch size by the partition's largest item, in distinct shingles.  Items of
#: the first partitions are their own sketches.
PARTITIONS = ((8, 8), (16, 16), (32, 16), (64, 24), (256, 32), (1 << 31, 64))
#: An estimate under this share of the threshold is discarded.  With 16 of 32
#: shingles drawn, an item at the threshold is below it once in a million times.
SLACK = 0.35
BROADCAST_ROWS = 1 << 20  # of (hash, item) pairs, 16 bytes each


def item_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _windows(w: Column, width: int, of) -> Column:
    """``of`` the words of every window; none if the text is shorter."""
    starts = F.sequence(F.lit(0), F.size(w) - width)
    full = F.transform(starts, lambda i: of([F.get(w, i + j) for j in range(width)]))
    return F.when(F.size(w) >= width, F.array_distinct(full)).otherwise(F.slice(F.array(of([F.lit("")])), 1, 0))


def hashes(w: Column, width: int) -> Column:
    return _windows(w, width, lambda window: F.xxhash64(*window))


def shingles(w: Column, width: int) -> Column:
    return _windows(w, width, lambda window: F.concat_ws(" ", *window))


def _by_width(w: Column, width: Column, of) -> Column:
    out = of(w, WIDTH)
    for i in range(1, WIDTH):
        out = F.when(width == i, of(w, i)).otherwise(out)
    return out


def items_of(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, width, shingles, hashes, sketch) of every item with words."""
    rows = benchmark.select(F.col(id_col).alias("item"), item_words(whole(F.col(text_col))).alias("w")).distinct()
    rows = rows.where(F.size("w") > 0).withColumn("width", F.least(F.size("w"), F.lit(WIDTH)))
    rows = rows.select(
        "item",
        "width",
        _by_width(F.col("w"), F.col("width"), shingles).alias("shingles"),
        F.sort_array(_by_width(F.col("w"), F.col("width"), hashes)).alias("hashes"),
    )
    size = F.lit(PARTITIONS[-1][1])
    for most, k in reversed(PARTITIONS[:-1]):
        size = F.when(F.size("shingles") <= most, k).otherwise(size)
    return rows.withColumn("sketch", F.slice("hashes", F.lit(1), size))


def _small(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast only within the bound; beyond it the joins shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def candidates(rows: DataFrame, items: DataFrame, least: float) -> DataFrame:
    """(_id, _key, item, width) whose sketch is estimated to be contained."""
    sketch = cut(items.select("item", "width", F.size("sketch").alias("k"), F.explode("sketch").alias("hash")))
    n = sketch.count()
    widths = sorted(r["width"] for r in sketch.select("width").distinct().collect())  # WIDTH values at most
    found = None
    for width in widths:
        probes = rows.select("_id", "_key", F.explode(let(item_words(F.col("_text")), lambda w: hashes(w, width))).alias("hash"))
        hits = probes.join(_small(sketch.where(F.col("width") == width), n), "hash").groupBy("_id", "_key", "item", "width", "k").agg(
            F.count("*").alias("hits")
        )
        found = hits if found is None else found.union(hits)
    if found is None:
        return rows.select("_id", "_key", F.lit(None).cast("bigint").alias("item"), F.lit(0).alias("width")).limit(0)
    # A row that is repeated whole probes several times.
    return found.where(F.col("hits") >= least * SLACK * F.col("k")).select("_id", "_key", "item", "width")


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least: float = CONTAINMENT,
) -> DataFrame:
    """(_id, _key, item, containment, n_shingles) of every contained item."""
    rows = keyed(docs, id_col, text_col)
    items = cut(items_of(benchmark, item_col, item_text_col))
    found = cut(candidates(rows, items, least))
    # The candidates grow with the corpus: never a broadcast.
    hit = found.groupBy("_id", "_key").agg(F.collect_set(F.struct("item", "width")).alias("wanted"))
    texts = rows.alias("r").join(hit.hint("merge").alias("f"), same_row("r", "f")).select("r._id", "r._key", "r._text", "f.wanted")
    # Words are made once per document, then shared by its items.
    word_rows = texts.select("_id", "_key", item_words(F.col("_text")).alias("w"), F.explode("wanted").alias("c"))
    compared = word_rows.join(
        items.select("item", "width", "shingles"),
        F.col("c.item").eqNullSafe(F.col("item")) & (F.col("c.width") == F.col("width")),
    )
    common = F.size(F.array_intersect("shingles", _by_width(F.col("w"), F.col("width"), shingles)))
    share = common / F.size("shingles")
    return (
        compared.select("_id", "_key", "item", share.alias("containment"), F.size("shingles").cast("bigint").alias("n_shingles"))
        .where(F.col("containment") >= least)
        .dropDuplicates(["_id", "_key", "item", "n_shingles"])
    )


def pairs(docs: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """(doc_id, item_id, containment, n_shingles), one row per pair of ids: the
    highest containment if ids repeat."""
    found = matches(docs, benchmark, **columns)
    return found.groupBy(F.col("_id").alias(columns.get("id_col", "doc_id")), F.col("item").alias(columns.get("item_col", "item_id"))).agg(
        F.max("containment").alias("containment"), F.max("n_shingles").alias("n_shingles")
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns) -> DataFrame:
    """The rows of ``docs`` without a contained item, with all their columns."""
    hit = matches(docs, benchmark, id_col, text_col, **columns).select("_id", "_key").distinct()
    key = F.xxhash64(whole(F.col(f"d.`{text_col}`")))
    same = F.col(f"d.`{id_col}`").eqNullSafe(F.col("h._id")) & (key == F.col("h._key"))
    return docs.alias("d").join(hit.hint("merge").alias("h"), same, "left_anti")
