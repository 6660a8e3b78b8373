"""One row per key, and the marking of the rows that lose."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulint.functions.row_hash import quoted, refuse_reserved, row_hash, sortable_columns, with_origin
from tabulint.functions.rules import UniqueKey

# Helper columns; input tables must not use these names.
RANK = "__dq_rn"
SLICE = "__dq_slice"
ORIGIN = "__dq_origin"
WINNER = "__dq_winner"
HOT = ("__dq_hot_1", "__dq_hot_2")
SLICES = "__dq_slices"
DIGEST = ("__dq_digest_1", "__dq_digest_2")
ROWS = "__dq_rows"
GRADE = "__dq_grade"

# Below every date as a day number.
NO_DATE = -(1 << 32)

# What a BIGINT needs to be above 0, and a power of ten above the sum.
LEAST_TIE = Decimal((1 << 63) + 1)
TIES = Decimal(10**20)


def _names(columns: list[str] | tuple[str, ...]) -> list[Column]:
    return [quoted(c) for c in columns]


def _latest_first(df: DataFrame, key: UniqueKey, leading: tuple[str, ...]) -> list[Column]:
    deciding = key.deciding_columns(df, leading)
    return [c.desc_nulls_last() for c in (key.order_value(), *_names(deciding))]


def keep_latest(df: DataFrame, key: UniqueKey, leading: tuple[str, ...] = ()) -> DataFrame:
    """Keep the latest row of every key.

    The ``rank = 1`` filter directly on the window lets Spark cut every key to its best row inside
    each map task, before the shuffle, so a key that holds a third of the table sends one row per map
    task and not its whole group. ``leading`` names columns to compare first on ties.
    """
    refuse_reserved(df, RANK)
    per_key = Window.partitionBy(*_names(key.columns)).orderBy(*_latest_first(df, key, leading))
    return df.withColumn(RANK, F.row_number().over(per_key)).filter(F.col(RANK) == 1).drop(RANK)


def latest_grade(df: DataFrame, key: UniqueKey, grade: Column, grades: int) -> DataFrame:
    """Per key ``ROWS``, its number of rows, and ``GRADE``, the grade of the row ``keep_latest`` keeps.

    ``grade`` is an integer in ``0 .. grades - 1``, and the kept row is the one ``keep_latest`` finds when
    the grade leads the tie-break; the columns compared after it cannot change the answer. It is a
    partial aggregation over a few narrow values, with no window. When the order is a date, date, a
    whole-number tie-break and grade fit one number, which Spark can keep in a hash aggregate.
    """
    n_rows = F.count(F.lit(1)).alias(ROWS)
    by_date = key.order_as_date or isinstance(df.schema[key.order_by].dataType, T.DateType)
    whole = len(key.tiebreak) == 1 and isinstance(df.schema[key.tiebreak[0]].dataType, T.IntegralType)
    if by_date and (whole or not key.tiebreak):
        day = F.coalesce(F.unix_date(key.order_value()).cast("bigint"), F.lit(NO_DATE))
        value, kind = day, "bigint"
        if whole:
            # NULL comes below every number; a day times TIES and a number fit 38 digits with the grade behind
            tie = F.coalesce(quoted(key.tiebreak[0]).cast("decimal(20,0)") + F.lit(LEAST_TIE), F.lit(0).cast("decimal(20,0)"))
            value, kind = (day.cast("decimal(11,0)") * F.lit(TIES) + tie).cast("decimal(33,0)"), "decimal(38,0)"
        best = F.max((value * F.lit(grades) + grade).cast(kind))
        return df.groupBy(*_names(key.columns)).agg(n_rows, F.pmod(best, F.lit(grades)).cast("int").alias(GRADE))
    best = F.max(F.struct(key.order_value().alias(RANK), *_names(key.tiebreak), grade.alias(GRADE)))
    return df.groupBy(*_names(key.columns)).agg(n_rows, best[GRADE].alias(GRADE))


def mark_superseded(
    df: DataFrame,
    key: UniqueKey,
    flag: str,
    leading: tuple[str, ...] = (),
    *,
    hot_share: float = 1e-5,
    hot_rows: int = 1_000_000,
    slice_rows: int = 250_000,
    origin: Column | None = None,
) -> DataFrame:
    """Every input row plus boolean ``flag``: true for the rows that ``keep_latest`` drops.

    All rows are needed here, so the pruning of ``keep_latest`` cannot apply and a hot key would put
    its whole group into one task. Hot keys, those with more than ``hot_rows`` rows and more than
    ``hot_share`` of the table, are therefore ranked in slices:

    1. count rows per key (partial aggregation on the key columns) and keep the hot keys, each with as
       many slices as it has ``slice_rows``. There are fewer than ``1 / hot_share`` hot keys whatever the
       table holds, and their digests, not the keys themselves, are broadcast: a few megabytes at most;
    2. find the slice that holds each hot key's best row, again by partial aggregation;
    3. rank rows per (key, slice) in one shuffle. A row is kept if it is first in its slice and the
       slice is the winning one. Other keys have a single slice, 0.

    The slice of a row depends on its contents and its file, so all steps agree also when tasks are
    lost and run again. Exact copies share a slice only within one file. When ``df`` comes out of a
    shuffle, its rows have no file: store it first if a hot key may consist of exact copies, or give
    an ``origin`` column that tells copies apart.
    """
    refuse_reserved(df, RANK, SLICE, ORIGIN, WINNER, SLICES, *DIGEST, *HOT)
    columns = df.columns
    # 128 bits in two hashes; the NULL flags tell (NULL, x) from (x, NULL)
    parts = [part for c in _names(key.columns) for part in (c, c.isNull())]
    digest = [F.xxhash64(F.lit(salt), *parts) for salt in (1, 2)]
    located = with_origin(df, ORIGIN, origin).withColumns(dict(zip(DIGEST, digest)))
    counts = df.groupBy(*_names(key.columns)).agg(F.count(F.lit(1)).alias(RANK))
    table_rows = counts.agg(F.sum(RANK).alias(RANK)).scalar()
    is_hot = F.col(RANK) > F.greatest(F.lit(float(hot_rows)), table_rows * F.lit(hot_share))
    hot_keys = counts.filter(is_hot).select(*(d.alias(h) for d, h in zip(digest, HOT)), F.ceil(F.col(RANK) / F.lit(slice_rows)).alias(SLICES))
    is_key = [F.col(d) == F.col(h) for d, h in zip(DIGEST, HOT)]
    own_slice = F.pmod(row_hash([*sortable_columns(df), ORIGIN]), F.col(SLICES))

    best = F.max(
        F.struct(
            key.order_value().alias(RANK),
            *_names(key.deciding_columns(df, leading)),
            own_slice.alias(SLICE),
        )
    )
    winners = (
        located.join(F.broadcast(hot_keys), is_key)
        .groupBy(*HOT, SLICES)
        .agg(best[SLICE].alias(WINNER))
    )

    sliced = located.join(F.broadcast(winners), is_key, "left").select(
        *_names(columns),
        F.when(F.col(WINNER).isNotNull(), own_slice).otherwise(0).alias(SLICE),
        F.coalesce(WINNER, F.lit(0)).alias(WINNER),
    )
    per_slice = Window.partitionBy(*_names(key.columns), SLICE).orderBy(*_latest_first(df, key, leading))
    superseded = (F.col(RANK) > 1) | (F.col(SLICE) != F.col(WINNER))
    return sliced.withColumn(RANK, F.row_number().over(per_slice)).select(
        *_names(columns), superseded.alias(flag)
    )
