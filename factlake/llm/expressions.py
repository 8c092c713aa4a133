"""Column helpers shared by the native operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words are maximal runs of anything but space and U+0009 to U+000D.
NOT_WORD = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]"


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), NOT_WORD + "+"), lambda w: w != "")
