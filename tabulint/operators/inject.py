"""Plant known defects in any table, to measure what the rules find.

Rows are picked by a digest of a key, not by a random stream: a run is repeatable on any
partitioning, and a lost task plants the same defects again. All but ``select_k_rows`` are
projections: one scan, no shuffle.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterable
from decimal import ROUND_CEILING, ROUND_FLOOR, Context, Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulint.functions.row_hash import quoted
from tabulint.functions.rules import InRange

# Hexadecimal digits of a digest that make a row's number: 60 bits, so that a number fits a BIGINT.
DIGITS = 15
NUMBERS = 16**DIGITS
# Numbers are tallied without their last bits, by their leading 20.
TALLY_BITS = 40

# Helper columns; input tables must not use these names.
COPY = "__dq_copy"
PLACE = "__dq_place"
AT = "__dq_at"
UP_TO = "__dq_up_to"


def scramble(key: Column, seed: int = 0) -> Column:
    """A repeatable pseudo-random number below ``NUMBERS`` for any key; NULL is a key too."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("NULL")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("bigint")


def one_in(key: Column, every: int, seed: int = 0) -> Column:
    """True for about one row in ``every``, however large that is."""
    return F.pmod(scramble(key, seed), F.lit(every)) == 0


def inject_duplicates(df: DataFrame, selected: Column, copies: int = 1) -> DataFrame:
    """Append ``copies`` exact copies of each selected row, in the same pass over the table."""
    times = F.when(selected, F.lit(copies + 1)).otherwise(F.lit(1))
    return df.withColumn(COPY, F.explode(F.sequence(F.lit(1), times))).drop(COPY)


def inject_nulls(df: DataFrame, selected: Column, variant: Column, columns: Iterable[str]) -> DataFrame:
    """Blank one of ``columns`` in each selected row; ``variant`` (an integer, NULL being 0) decides which."""
    names = list(columns)
    place = F.pmod(F.coalesce(variant, F.lit(0)), F.lit(len(names)))
    hit = {c: selected & (place == i) for i, c in enumerate(names)}
    return df.withColumns({c: F.when(~F.coalesce(hit[c], F.lit(False)), quoted(c)) for c in names})


def inject_invalid_codes(
    df: DataFrame, selected: Column, variant: Column, column: str, bad_values: Iterable[str]
) -> DataFrame:
    """Replace the code of each selected row by one of ``bad_values``; ``variant`` (NULL being 0) decides which."""
    values = list(bad_values)
    place = F.pmod(F.coalesce(variant, F.lit(0)), F.lit(len(values)))
    pick = F.element_at(F.array(*map(F.lit, values)), (place + 1).cast("int"))
    return df.withColumn(column, F.when(selected, pick).otherwise(quoted(column)))


def inject_out_of_range(
    df: DataFrame, selected: Column, variant: Column, rules: Iterable[InRange], distance: float = 1
) -> DataFrame:
    """Move every ruled field of each selected row ``distance`` below or above its range.

    The side alternates from field to field and with ``variant``, NULL being 0. Column types are kept: where
    one has no value at that distance, the next one away from the range is taken. A type that has
    none beyond both ends of a range is refused.
    """
    moved = {}
    for i, rule in enumerate(rules):
        below, above = (F.lit(v).cast(df.schema[rule.column].dataType) for v in beyond(df.schema[rule.column].dataType, rule, distance))
        side = F.when(F.pmod(F.coalesce(variant, F.lit(0)) + F.lit(i), F.lit(2)) == 0, below).otherwise(above)
        moved[rule.column] = F.when(selected, side).otherwise(quoted(rule.column))
    return df.withColumns(moved)


# Bytes of the whole-number types.
WHOLE_BYTES = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8}


def beyond(kind: T.DataType, rule: InRange, distance: float) -> tuple[object, object]:
    """The values of a type that lie ``distance`` below and above the range of ``rule``, or next to that outwards."""
    if not distance > 0:
        raise ValueError("values out of range lie at a distance above 0")
    low, high = (Decimal(str(end)) for end in (rule.lo, rule.hi))
    ends = low - Decimal(str(distance)), high + Decimal(str(distance))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        single = isinstance(kind, T.FloatType)
        return _outwards(float(ends[0]), float(rule.lo), -math.inf, single), _outwards(float(ends[1]), float(rule.hi), math.inf, single)
    if isinstance(kind, T.IntegralType):
        limit = 2 ** (8 * WHOLE_BYTES[type(kind)] - 1)
        ends = math.floor(ends[0]), math.ceil(ends[1])
        fits = -limit <= ends[0] and ends[1] < limit
    elif isinstance(kind, T.DecimalType):
        step, exact = Decimal(1).scaleb(-kind.scale), Context(prec=100)
        ends = ends[0].quantize(step, ROUND_FLOOR, exact), ends[1].quantize(step, ROUND_CEILING, exact)
        fits = max(map(abs, ends)) < Decimal(10) ** (kind.precision - kind.scale)
    else:
        return rule.lo - distance, rule.hi + distance
    if not fits:
        raise ValueError(f"{kind.simpleString()} of column {rule.column} has no values {distance} beyond {rule.lo} and {rule.hi}")
    return ends


def _outwards(value: float, end: float, away: float, single: bool) -> float:
    """The number nearest to ``value`` that the type has and that lies beyond ``end``."""

    def held(x: float) -> float:
        return struct.unpack("f", struct.pack("f", x))[0] if single else x

    step = abs(value) * 2.0**-24 if single else 0.0
    while (held(value) >= end) if away < 0 else (held(value) <= end):
        value = math.nextafter(value + math.copysign(step, away), away)
    return held(value)


def select_k_rows(df: DataFrame, k: int, key: str, seed: int = 0) -> DataFrame:
    """Exactly ``k`` rows, or all if there are fewer: those whose keys have the lowest numbers.

    No task sees the whole choice. A tally of rows by the leading bits of their numbers, at most
    2**20 rows whatever the table holds, tells in which step the k-th number lies;
    the numbers of that step alone, about a millionth of all, are put in order to find it; and a filter
    takes the rows up to it. Two narrow scans and one of whole rows, which are not shuffled.
    ``key`` tells rows apart, NULL being a key like any other. Where rows share the key at which the
    choice would have to stop, no choice of ``k`` is defined by keys, and the query raises an error.
    """
    if k <= 0:
        return df.limit(0)
    place = scramble(quoted(key), seed)
    numbers = df.select(place.alias(PLACE))
    step = F.shiftright(PLACE, TALLY_BITS)
    tally = numbers.groupBy(step.alias(PLACE)).agg(F.count(F.lit(1)).alias(AT))
    up_to = F.sum(AT).over(Window.orderBy(PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edge = (
        tally.withColumn(UP_TO, up_to)
        .filter(F.col(UP_TO) >= k)
        .agg(F.min(F.struct(PLACE, (F.col(UP_TO) - F.col(AT)).alias(AT))).alias(UP_TO))
    )
    edge_step = edge.select(F.col(UP_TO)[PLACE]).scalar()
    before_edge = edge.select(F.col(UP_TO)[AT]).scalar()

    at_edge = numbers.filter(step == edge_step).groupBy(PLACE).agg(F.count(F.lit(1)).alias(AT))
    stop = (
        at_edge.withColumn(UP_TO, up_to + before_edge)
        .filter(F.col(UP_TO) >= k)
        .agg(F.min(F.struct(PLACE, UP_TO)).alias(UP_TO))
        .select(
            F.when(F.col(UP_TO).isNull(), F.lit(NUMBERS))
            .when(F.col(UP_TO)[UP_TO] == k, F.col(UP_TO)[PLACE])
            .otherwise(F.raise_error(F.lit(f"rows share the key at which a choice of {k} rows stops")).cast("bigint"))
        )
        .scalar()
    )
    return df.filter(place <= stop)
