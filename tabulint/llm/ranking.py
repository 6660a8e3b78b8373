"""Gapless numbers inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1024


def ranked(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str = "rank", *, before: Column | None = None
) -> DataFrame:
    """Adds ``name``, a number from 0 without gaps inside each group; ``df`` must be stored, as it is read twice.

    Rows with a smaller ``before``, an integer of few values, come first; else the order is a hash's.

    No task holds a group: rows go to one of ``BUCKETS`` hash buckets of their group, are numbered
    there, and start behind the rows that earlier buckets of the group hold. Rows that agree in
    ``order`` share a bucket, so ``order`` has to tell most rows apart.
    """
    bucket = F.pmod(F.xxhash64(*order), F.lit(BUCKETS)).cast("int")
    if before is not None:
        bucket = before.cast("int") * BUCKETS + bucket
    rows = df.withColumn("__bucket", bucket)
    keys = [*groups, "__bucket"]
    earlier = Window.partitionBy(*groups).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(*keys, F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__start"))
    )
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    numbered = rows.withColumn("__inside", inside)
    same = _same([numbered[k] for k in keys], [starts[k] for k in keys])
    return numbered.join(starts, same).select(
        *[numbered[c] for c in df.columns], (F.col("__start") + F.col("__inside") - 1).alias(name)
    )


def _same(left: list[Column], right: list[Column]) -> Column:
    condition = F.lit(True)
    for a, b in zip(left, right):
        condition = condition & a.eqNullSafe(b)
    return condition
