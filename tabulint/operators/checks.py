"""Checks: the offending keys or rows, with what is wrong with them.

Reports are sorted by default, as a reader expects. A global sort reads its input twice (once to
sample) and adds a shuffle: pass ``ordered=False`` when the result is only written or joined.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulint.functions.row_hash import quoted, row_hash, sortable_columns, with_origin
from tabulint.functions.rules import InRange, Matches, UniqueKey

ORIGIN = "__dq_origin"


def _sorted(df: DataFrame, *order: Column) -> DataFrame:
    """Global sort whose range partitions can be cut inside a run of equal sort keys."""
    within = row_hash([*sortable_columns(df), ORIGIN])
    return with_origin(df, ORIGIN).orderBy(*order, within).drop(ORIGIN)


def duplicate_keys(
    df: DataFrame, key: UniqueKey, *, earliest: str = "earliest", latest: str = "latest", ordered: bool = True
) -> DataFrame:
    """Keys that occur more than once: count, first and last order value; most frequent first.

    NULL keys are one group. Text dates are compared as dates, which also keeps the aggregation
    buffers fixed-width, so Spark uses a hash aggregate and combines a hot key before the shuffle.
    """
    when = key.order_value()
    found = (
        df.groupBy(*map(quoted, key.columns))
        .agg(F.count(F.lit(1)).alias("occurrence_count"), F.min(when).alias(earliest), F.max(when).alias(latest))
        .filter(F.col("occurrence_count") > 1)
    )
    if not ordered:
        return found
    return found.orderBy(F.desc("occurrence_count"), *(quoted(c).asc_nulls_first() for c in key.columns))


def format_failures(
    df: DataFrame, rule: Matches, ids: tuple[str, ...], *, status: str = "status", ordered: bool = True
) -> DataFrame:
    """Rows whose text is missing or malformed, with the status; sorted by status and id."""
    bad = df.filter(quoted(rule.column).isNull() | rule.malformed()).select(
        *map(quoted, ids), quoted(rule.column), rule.status().alias(status)
    )
    if not ordered:
        return bad
    return _sorted(bad, F.asc(status), *(quoted(c).asc_nulls_first() for c in ids))


def format_status(df: DataFrame, rule: Matches, *, status: str = "status") -> DataFrame:
    """Number of rows per status: MISSING, INVALID_FORMAT, VALID."""
    return df.groupBy(rule.status().alias(status)).agg(F.count(F.lit(1)).alias("n_rows"))


def range_failures(
    df: DataFrame,
    rules: tuple[InRange, ...],
    ids: tuple[str, ...],
    *,
    flagged: str = "flagged_fields",
    ordered: bool = True,
) -> DataFrame:
    """Rows with a value out of range: id, the checked values and the failing labels, ', '-joined.

    A NULL is not out of range here, whatever the rule's ``null_ok``.
    """
    values = [quoted(rule.column) for rule in rules]
    labels = F.concat_ws(", ", *(F.when(rule.out_of_range(), F.lit(rule.name)) for rule in rules))
    any_bad = reduce(or_, (rule.out_of_range() for rule in rules), F.lit(False))
    bad = df.filter(any_bad).select(*map(quoted, ids), *values, labels.alias(flagged))
    if not ordered:
        return bad
    return _sorted(bad, *(quoted(c).asc_nulls_first() for c in ids))
