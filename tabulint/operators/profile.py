"""Profiles: measurements of a table. Each is a small DataFrame; nothing is printed or collected."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulint.functions.row_hash import quoted
from tabulint.functions.rules import InRange, Matches
from tabulint.functions.standard_forms import as_date

N_ROWS = "n_rows"


def row_count(df: DataFrame) -> DataFrame:
    """One row: ``n_rows``."""
    return df.agg(F.count(F.lit(1)).alias(N_ROWS))


def shape(df: DataFrame) -> DataFrame:
    """One row: ``n_rows`` and ``n_columns``; the latter is schema metadata."""
    return df.agg(F.count(F.lit(1)).alias(N_ROWS)).select(N_ROWS, F.lit(len(df.columns)).alias("n_columns"))


def null_count(column: str) -> Column:
    return F.count_if(quoted(column).isNull())


def null_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """(column, n_null) for every column, from one global aggregate."""
    names = list(columns or df.columns)
    return df.agg(*(null_count(c).alias(c) for c in names)).unpivot([], [quoted(c) for c in names], "column", "n_null")


def null_rates(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """(column, n_null, null_rate) of the columns that hold NULLs; the rate is a share of all rows."""
    names = list(columns or df.columns)
    counted = df.agg(F.count(F.lit(1)).alias("__dq_rows"), *(null_count(c).alias(c) for c in names))
    return (
        counted.unpivot(["__dq_rows"], [quoted(c) for c in names], "column", "n_null")
        .filter(F.col("n_null") > 0)
        .select("column", "n_null", (F.col("n_null") / F.col("__dq_rows")).alias("null_rate"))
    )


def surplus_rows(
    df: DataFrame, keys: tuple[str, ...], *, digest: bool = False, relative_error: float | None = None
) -> DataFrame:
    """One row: ``duplicate_rows``, the rows beyond the number of distinct keys.

    A row with a NULL in its key has no distinct key, so it counts as surplus. ``digest`` compares
    SHA-256 digests, for long text keys: the shuffle then moves 64 characters per key. With a
    ``relative_error`` the distinct count is estimated without any shuffle of keys, and an estimate
    above the number of rows counts as no surplus.
    """
    columns = [F.sha2(quoted(c).cast("string").cast("binary"), 256) if digest else quoted(c) for c in keys]
    if relative_error is not None:
        complete = F.when(~F.greatest(*(c.isNull() for c in columns), F.lit(False)), F.struct(*columns))
        distinct = F.approx_count_distinct(F.xxhash64(complete) if len(columns) > 1 else columns[0], relative_error)
    else:
        distinct = F.count_distinct(*columns)
    return df.agg(F.greatest(F.count(F.lit(1)) - distinct, F.lit(0).cast("bigint")).alias("duplicate_rows"))


def malformed_count(df: DataFrame, rule: Matches) -> DataFrame:
    """One row: ``n_invalid``, the rows whose text is present but malformed."""
    return df.agg(F.count_if(rule.malformed()).alias("n_invalid"))


def out_of_range_count(rule: InRange, guard: Column | None = None) -> Column:
    return F.count_if(rule.out_of_range() if guard is None else rule.out_of_range() & guard)


def out_of_range_counts(df: DataFrame, rules: tuple[InRange, ...], guard: Column | None = None) -> DataFrame:
    """One row with a count per rule, over the rows where ``guard`` holds (default: all rows)."""
    rows = df if guard is None else df.filter(guard)
    return rows.agg(*(out_of_range_count(rule).alias(rule.counter_name) for rule in rules))


def out_of_range_nonzero(df: DataFrame, rules: tuple[InRange, ...], guard: Column | None = None) -> DataFrame:
    """(field, n_out_of_range) for the rules that found something."""
    counters = [rule.counter_name for rule in rules]
    return (
        out_of_range_counts(df, rules, guard)
        .unpivot([], counters, "field", "n_out_of_range")
        .filter(F.col("n_out_of_range") > 0)
    )


def year_counts(df: DataFrame, column: str) -> DataFrame:
    """(year, n_rows), ascending; rows without a readable date form the NULL year, which comes first."""
    return (
        df.groupBy(F.year(as_date(column)).alias("year"))
        .agg(F.count(F.lit(1)).alias(N_ROWS))
        .orderBy(F.asc_nulls_first("year"))
    )
