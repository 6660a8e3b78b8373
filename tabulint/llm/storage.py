"""Intermediate tables: each is written once to the folder that all machines share, and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabulint.sources import tables


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back.

    Cuts the lineage: a lost executor costs only the tasks that were running, and no later step
    recomputes ``df``. The files stay until the folder is cleared, as those of ``checkpoint()`` do.
    """
    spark = df.sparkSession
    path = tables.scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
