"""A hash of a row that is the same every time the row is read, used to split hot groups.

It covers the row's contents, which spread different rows of one key, and the file the row was read
from, which spreads exact copies. Both are properties of the stored row, so a task that is run again
computes the same hash; row numbers or random values would not promise that after a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """The column of this very name, dots and all."""
    return F.col(f"`{name.replace('`', '``')}`")


def _comparable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_comparable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _comparable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def sortable_columns(df: DataFrame) -> list[str]:
    """Columns that Spark can compare and hash: those without a map or variant inside, at any depth.

    Maps and variants take no part in ties: of rows that differ only in them any may be chosen.
    """
    return [f.name for f in df.schema.fields if _comparable(f.dataType)]


def refuse_reserved(df: DataFrame, *names: str) -> None:
    """Raises if the table has a column that a run needs for itself."""
    taken = sorted(set(names) & set(df.columns))
    if taken:
        raise ValueError(f"columns with reserved names: {', '.join(taken)}")


def with_origin(df: DataFrame, name: str, origin: Column | None = None) -> DataFrame:
    """Add ``name``: ``origin`` if given, else the file the row was read from.

    Spark cannot name the file of a row that comes out of a join, and names none after a shuffle. The
    column is then empty and a hash rests on contents alone.
    """
    if origin is not None:
        return df.withColumn(name, origin)
    try:
        return df.withColumn(name, F.input_file_name())
    except AnalysisException:
        return df.withColumn(name, F.lit(""))


def row_hash(columns: Iterable[str]) -> Column:
    return F.xxhash64(*map(quoted, columns))
