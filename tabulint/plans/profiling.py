"""The whole profile of a table as one tidy DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulint.functions.rules import InRange, Matches, RuleSet
from tabulint.functions.standard_forms import unparsable_date
from tabulint.operators import profile as p


def profile_report(df: DataFrame, rules: RuleSet, guard: Column | None = None) -> DataFrame:
    """(section, metric, value) with sections

    * ``shape``: rows and columns;
    * ``null_count``, ``null_rate``: columns that hold NULLs; the rate is a share of all rows;
    * ``duplicates``: rows beyond the number of distinct keys;
    * ``invalid_format``: malformed texts per pattern rule;
    * ``out_of_range``: per range rule that found something, over the rows where ``guard`` holds;
    * ``unparsable_date``: texts of the date columns that spell no date, where there are any;
    * ``rows_per_year``: rows per year of the key's order column, 'unknown' without a readable date.

    Three scans: one global aggregate over all columns, and two narrow ones (the key, the order
    column) that need a grouping of their own.
    """
    formats = [r for r in rules.rules if isinstance(r, Matches)]
    ranges = [r for r in rules.rules if isinstance(r, InRange)]
    dates = rules.standards.dates

    n_rows = F.count(F.lit(1))
    # (section, metric, aggregate, reported only when above zero)
    measures: list[tuple[str, str, Column, bool]] = [
        ("shape", "rows", n_rows, False),
        *(("null_count", c, p.null_count(c), True) for c in df.columns),
        *(("invalid_format", r.column, F.count_if(r.malformed()), False) for r in formats),
        *(("out_of_range", r.counter_name, p.out_of_range_count(r, guard), True) for r in ranges),
        *(("unparsable_date", c, F.count_if(unparsable_date(c)), True) for c in dates),
    ]
    summary = df.agg(
        *(value.cast("double").alias(f"m{i}") for i, (_, _, value, _) in enumerate(measures)),
    )

    def cell(section: str, metric: str, value: Column, hide_zero: bool) -> Column:
        return F.struct(
            F.lit(section).alias("section"),
            F.lit(metric).alias("metric"),
            value.alias("value"),
            F.lit(hide_zero).alias("hide_zero"),
        )

    cells = [cell("shape", "columns", F.lit(float(len(df.columns))), False)]
    for i, (section, metric, _, hide_zero) in enumerate(measures):
        cells.append(cell(section, metric, F.col(f"m{i}"), hide_zero))
        if section == "null_count":
            cells.append(cell("null_rate", metric, F.try_divide(F.col(f"m{i}"), F.col("m0")), True))
    measured = (
        summary.select(F.inline(F.array(*cells)))
        .filter(~F.col("hide_zero") | (F.col("value") > 0))
        .drop("hide_zero")
    )

    keys = rules.key.columns
    duplicates = p.surplus_rows(df, keys).select(
        F.lit("duplicates").alias("section"),
        F.lit(", ".join(keys)).alias("metric"),
        F.col("duplicate_rows").cast("double").alias("value"),
    )
    years = (
        df.groupBy(F.year(rules.key.order_value()).alias("year"))
        .agg(n_rows.alias("n_rows"))
        .select(
            F.lit("rows_per_year").alias("section"),
            F.coalesce(F.col("year").cast("string"), F.lit("unknown")).alias("metric"),
            F.col("n_rows").cast("double").alias("value"),
        )
    )
    return measured.unionByName(duplicates).unionByName(years)
