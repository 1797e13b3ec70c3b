"""Line deduplication without moving text.

Lines become (fingerprint, document, row key, position).  They are
range-partitioned by fingerprint and document and sorted inside each partition,
so one pass streams over every fingerprint's documents, largest id first,
holding at most the few documents before the threshold.  A fingerprint that is
cut by a partition border (a hot line) is decided by its totals over all
partitions, of which there are two per partition at most.  The answer is one
compressed bitmap per document that has lines to drop.

A NULL or empty text is one empty line.  Rows that repeat an id count as one
document for the threshold and are cut row by row; rows with a NULL id count as
one document, below all others.  An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from assetops.llm.common import SPACE, keyed, lower_ascii, same_row
from assetops.storage import cut

MIN_CHARS, MIN_DOCS = 40, 5

#: ``edge`` is set on rows that only the totals over partitions decide; ``n`` on
#: the totals themselves (documents of that hash in one partition, largest id).
_DECIDED = pa.schema(
    [("_id", pa.int64()), ("_key", pa.int64()), ("pos", pa.int32()), ("edge", pa.binary()), ("n", pa.int64())]
)
_DECIDED_SQL = "_id bigint, _key bigint, pos int, edge binary, n bigint"
_BATCH = 20_000


def lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """(hash, _id, _key, pos) of the lines whose key is long enough."""
    split = rows.select("_id", "_key", F.posexplode(F.split("_text", "\n")).alias("pos", "line"))
    line = F.btrim(F.col("line"), F.lit(SPACE))
    return split.where(F.length(line) >= min_chars).select(
        F.unhex(F.md5(lower_ascii(line))).alias("hash"), "_id", "_key", "pos"
    )


def _stream(min_docs: int):
    """Streams one sorted partition.  The first hash may have begun in the
    partition before, so its rows stay open; the last one may go on in the next,
    so its rows stay open while fewer than ``min_docs`` documents hold it."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = top = doc = None
        docs = 0  # documents of the current hash so far
        waiting: list[tuple] = []  # rows of fewer than min_docs documents
        out: list[tuple] = []

        def ready() -> pa.RecordBatch:
            columns = zip(*out) if out else [[]] * len(_DECIDED)
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _DECIDED)], schema=_DECIDED)
            out.clear()
            return batch

        for batch in batches:
            for h, i, k, p in zip(*(c.to_pylist() for c in batch.columns)):
                if h != last:
                    if last is not None and last == first:
                        out.append((top, None, None, first, docs))
                    waiting.clear()
                    first = h if first is None else first
                    last, docs, doc, top = h, 1, i, i
                elif i != doc:
                    docs, doc = docs + 1, i
                if h == first:
                    out.append((i, k, p, h, None))
                elif docs >= min_docs:
                    # The largest id comes first and keeps its lines.
                    out.extend((*row, None, None) for row in waiting if row[0] != top)
                    waiting.clear()
                    out.append((i, k, p, None, None))
                else:
                    waiting.append((i, k, p))
                if len(out) >= _BATCH:
                    yield ready()
        if last is not None:
            if last != first:
                out.extend((*row, last, None) for row in waiting)
            out.append((top, None, None, last, docs))
        yield ready()

    return stream


def dropped_lines(rows: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(_id, _key, pos) of every line to drop."""
    order = [F.col("hash"), F.col("_id").desc_nulls_last()]
    dealt = lines(rows, min_chars).repartitionByRange(*order).sortWithinPartitions(*order, "_key", "pos")
    # Written once: a second run could draw other range borders.
    decided = cut(dealt.mapInArrow(_stream(min_docs), _DECIDED_SQL))
    totals = (
        decided.where("n is not null").groupBy("edge").agg(F.sum("n").alias("docs"), F.max("_id").alias("top"))
    ).where(F.col("docs") >= min_docs)
    rows = decided.where("n is null")
    # At most two hashes per partition, so the totals are small at any size.
    open_rows = rows.where("edge is not null").join(F.broadcast(totals), "edge")
    open_rows = open_rows.where(~F.col("_id").eqNullSafe(F.col("top")))
    return rows.where("edge is null").select("_id", "_key", "pos").union(open_rows.select("_id", "_key", "pos"))


@F.pandas_udf(BinaryType())
def _pack(dropped):
    """Keep bits up to the byte of the last dropped line, compressed; lines after it stay."""

    def one(positions) -> bytes:
        keep = np.ones(-(-(int(max(positions)) + 1) // 8) * 8, np.uint8)
        keep[np.asarray(positions)] = 0
        return zlib.compress(np.packbits(keep).tobytes())

    return dropped.map(one)


@F.pandas_udf(StringType())
def _apply(text, bitmap):
    def one(t, b):
        if t is None or b is None:
            return t
        keep = np.unpackbits(np.frombuffer(zlib.decompress(b), np.uint8))
        split = t.split("\n")
        return "\n".join(line for i, line in enumerate(split) if i >= len(keep) or keep[i])

    return text.combine(bitmap, one)


def keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """(_id, _key, n_dropped, keep): one row per document with lines to drop."""
    drops = dropped_lines(keyed(docs, id_col, text_col), min_chars, min_docs)
    # One document's positions at a time, bounded by its own length.
    packed = drops.groupBy("_id", "_key").agg(F.collect_set("pos").alias("dropped"))
    return packed.select("_id", "_key", F.size("dropped").cast("bigint").alias("n_dropped"), _pack("dropped").alias("keep"))


def with_bitmaps(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``rows`` (with ``_id``, ``_key``) plus ``n_dropped`` and ``keep``, NULL
    without a bitmap.  Bitmaps grow with the corpus: the join is never a broadcast."""
    joined = rows.alias("r").join(bitmaps.hint("merge").alias("b"), same_row("r", "b"), "left")
    return joined.select("r.*", "b.n_dropped", "b.keep")


def cut_text(text: str, keep: str):
    """Column: the text without its dropped lines; only cut texts leave the JVM."""
    return F.when(F.col(keep).isNull(), F.col(text)).otherwise(
        _apply(F.when(F.col(keep).isNotNull(), F.col(text)), F.col(keep))
    )


def deduped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bounds: int) -> DataFrame:
    """``docs`` with the repeated lines gone from ``text_col``; other columns,
    whatever their names, and rows without such lines are unchanged."""
    marked = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"),
        F.col(id_col).alias("_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_key"),
        F.col(text_col).alias("_text"),
    )
    joined = with_bitmaps(marked, keep_bitmaps(docs, id_col, text_col, **bounds)).withColumn("_text", cut_text("_text", "keep"))
    return joined.select(*(F.col("_text" if c == text_col else f"_row.`{c}`").alias(c) for c in docs.columns))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bounds: int) -> DataFrame:
    """Per row: id, ``n_lines``, ``n_dropped``, ``kept_sha256``."""
    rows = with_bitmaps(keyed(docs, id_col, text_col), keep_bitmaps(docs, id_col, text_col, **bounds))
    return rows.select(
        F.col("_id").alias(id_col),
        F.size(F.split("_text", "\n")).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("bigint")).alias("n_dropped"),
        F.sha2(cut_text("_text", "keep"), 256).alias("kept_sha256"),
    )
