"""Bring dates, codes and names to their standard forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tabulint.functions import standard_forms as forms
from tabulint.functions.rules import Standards


def standardize_dates(df: DataFrame, *columns: str) -> DataFrame:
    """Text to DATE; text that spells no date becomes NULL."""
    return standardize(df, Standards(dates=columns))


def add_day_span(df: DataFrame, name: str, start: str, end: str) -> DataFrame:
    """Add the whole days from ``start`` to ``end`` as ``name``."""
    return standardize(df, Standards(day_spans={name: (start, end)}))


def standardize_codes(df: DataFrame, *columns: str) -> DataFrame:
    """Trim spaces and upper-case."""
    return standardize(df, Standards(codes=columns))


def standardize_names(df: DataFrame, *columns: str) -> DataFrame:
    """Trim spaces and title-case."""
    return standardize(df, Standards(names=columns))


def standardize(df: DataFrame, standards: Standards) -> DataFrame:
    """Apply all standard forms in one projection. Each form reads the input column, not another form."""
    formed: dict[str, Column] = {}
    formed |= {c: forms.as_date(c) for c in standards.dates}
    formed |= {c: forms.days_between(start, end) for c, (start, end) in standards.day_spans.items()}
    formed |= {c: forms.tidy_code(c) for c in standards.codes}
    formed |= {c: forms.tidy_name(c) for c in standards.names}
    formed |= {c: forms.as_number(c) for c in standards.numbers}
    formed |= {c: forms.as_whole(c) for c in standards.integers}
    return df.withColumns(formed) if formed else df
