"""Small expressions the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that separate words and are stripped from lines.
SPACE = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body
    names it, and wherever the optimizer moves the whole expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole(text: Column) -> Column:
    """NULL counts as the empty text."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """The runs without white space, in order."""
    return F.array_remove(F.split(text, SPACES), "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(``_id``, ``_text``, ``_key``) of every row.  ``_key`` fingerprints the
    text, so rows that repeat an id stay apart unless they are equal."""
    text = whole(F.col(text_col))
    return docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_key"))


def same_row(left: str, right: str) -> Column:
    """Join condition for two frames with ``_id`` and ``_key``; NULL ids match."""
    return F.col(f"{left}._id").eqNullSafe(F.col(f"{right}._id")) & (F.col(f"{left}._key") == F.col(f"{right}._key"))
