"""Sources and sinks. Parquet is the default; CSV is kept for exchange."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CSV_CORRUPT = "_corrupt_record"

# Quotes are doubled inside a quoted field, as most writers of CSV do.
CSV_FORMAT = {"header": "true", "quote": '"', "escape": '"'}

# Spark reads a field equal to its null marker as NULL, and the default marker is '', which would turn
# quoted empty fields into NULL as well. An unquoted empty field is NULL under any marker.
NO_TEXT = "\0"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; projections and filters on it reach the scan."""
    return spark.read.parquet(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    keep_corrupt: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header line. An empty field is NULL, a quoted empty one is ''.

    With a declared ``schema`` the data is read once. Without one Spark reads it all beforehand to infer
    types: a fallback for exploring. A field that does not fit its type is read as NULL;
    ``keep_corrupt`` adds the whole line as ``_corrupt_record`` for such rows. ``multi_line`` allows
    line breaks inside quoted fields, at the price of one task per file.
    """
    reader = spark.read.options(
        **CSV_FORMAT, nullValue=NO_TEXT, mode="PERMISSIVE", multiLine=str(multi_line).lower()
    )
    if schema is None:
        return reader.csv(path, inferSchema=True)
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CSV_CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CSV_CORRUPT)
    return reader.option("enforceSchema", "false").csv(path, schema=schema)


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with CSV parts, each with a header line.

    Every task writes its own part, so the directory is the table. Outer blanks are kept; NULL is an
    empty field and '' a quoted one, so they stay apart when read back.
    """
    df.write.mode("overwrite").options(
        **CSV_FORMAT, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Overwrite ``path`` with a Parquet table."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def register_view(df: DataFrame, name: str) -> None:
    """Let SQL text of the session see ``df`` as ``name``."""
    df.createOrReplaceTempView(name)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for intermediate tables in the shared folder that ``spark.checkpoint.dir`` names.

    What is written there stays until its owner clears the folder. Where the setting is missing, a
    session on one machine (``local[n]``) gets a new temporary folder; on a cluster, whose machines
    do not see each other's folders, it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
