"""Standard forms of single values. None of these raises on bad input, with ANSI mode on or off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabulint.functions.row_hash import quoted


def as_date(column: str) -> Column:
    """The date a text spells; NULL where it spells none."""
    return F.try_to_date(quoted(column))


def unparsable_date(column: str) -> Column:
    """There is a text and it spells no date."""
    return quoted(column).isNotNull() & as_date(column).isNull()


def days_between(start: str, end: str) -> Column:
    """Whole days from ``start`` to ``end``: negative when they are swapped, NULL when one is missing."""
    return F.datediff(as_date(end), as_date(start))


def tidy_code(column: str) -> Column:
    """Upper case without outer spaces."""
    return F.upper(F.trim(quoted(column)))


def tidy_name(column: str) -> Column:
    """Title case by word, without outer spaces; words are split at spaces only."""
    return F.initcap(F.trim(quoted(column)))


def as_number(column: str) -> Column:
    """The number a text spells; NULL where it spells none."""
    return quoted(column).try_cast("double")


def as_whole(column: str) -> Column:
    """The whole number a text spells, also as ``80.0``; NULL where it spells none or a fraction."""
    number = as_number(column)
    return F.when(number == F.floor(number), number.try_cast("int"))
