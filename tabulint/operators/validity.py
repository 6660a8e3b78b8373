"""Row filters built from rules."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabulint.functions.rules import Rule, Stage


def keep_valid(df: DataFrame, *rules: Rule) -> DataFrame:
    """Keep the rows that pass all rules. No shuffle; null tests and ranges reach the Parquet scan."""
    return df.filter(Stage("", rules).accepts())
