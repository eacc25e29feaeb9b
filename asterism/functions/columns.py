"""Column expressions used across operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """A column reference that tolerates any character in the name (``,`` ``/`` ``&`` …)."""
    return F.col("`" + name.replace("`", "``") + "`")


def all_not_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [quoted(c).isNotNull() for c in cols])


def any_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [quoted(c).isNull() for c in cols])


def regex_literal(text: str) -> str:
    """Quote ``text`` so that Spark's regex functions match it literally.

    A character of punctuation gets a backslash, by which Java splits without a regex.
    """
    if len(text) == 1 and text.isascii() and text.isprintable() and not text.isalnum():
        return "\\" + text
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def hour_start(ts: Column) -> Column:
    """The timestamp truncated to the hour, kept zone-free (TIMESTAMP_NTZ)."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                F.lit(0), F.lit(0))
