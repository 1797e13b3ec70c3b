"""Text assembly in which an absent value counts as an empty string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined(*parts: Column | str) -> Column:
    """Concatenate; literals are plain ``str``; NULL parts vanish."""
    return F.concat(
        *(F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts)
    )


def described(row: str, columns: list[str]) -> Column:
    """``Key: value, Key: value`` over fields of the struct column ``row``."""
    parts: list[Column | str] = []
    for i, name in enumerate(columns):
        parts += [("" if i == 0 else ", ") + name + ": ", F.col(f"{row}.{name}")]
    return joined(*parts)
