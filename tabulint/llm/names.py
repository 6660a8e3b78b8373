"""Names for columns that an operator needs for a while, beside whatever columns a table has."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_``, ``name__``, ... that is no column of ``df``, upper or lower case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
