"""Levels as they stand in rules tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def level_number(column: str) -> Column:
    """A level as an int, without the edge quotes and blanks the format check lets pass.

    Null where it is no number.
    """
    text = F.regexp_replace(F.col(column).cast("string"), r'\A"|"\z', " ")
    return F.trim(text).try_cast("int")
