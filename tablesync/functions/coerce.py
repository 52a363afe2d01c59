"""Coercions between vendors' types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_nul(c: Column) -> Column:
    return F.replace(c, F.decode(F.unhex(F.lit("00")), "UTF-8"), F.lit(""))


def char_to_smallint(c: Column) -> Column:
    """The code of the first character; empty values stay null."""
    return F.when(F.length(c) > 0, F.ascii(c)).cast("smallint")


def smallint_to_char(c: Column) -> Column:
    return F.chr(c.cast("bigint"))


def to_numeric_or_codepoint(c: Column) -> Column:
    """A number, else the code of the text's first character; empty: null."""
    return F.when(F.length(c) > 0, F.coalesce(c.try_cast("decimal(30,8)"), F.ascii(c).cast("decimal(30,8)")))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))
