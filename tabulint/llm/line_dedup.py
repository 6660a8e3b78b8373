"""Operator 10: overlapping three-line windows, hashed, looked up globally; later occurrences go."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulint.llm.names import free_name

WINDOW_LINES = 3
CUT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_removed", T.LongType())])


def window_digests(lines: Column) -> Column:
    """The 128-bit digests of all overlapping windows, in order; none for fewer lines than a window has."""
    n = F.greatest(F.size(lines) - (WINDOW_LINES - 1), F.lit(0))
    beside = F.arrays_zip(*[F.slice(lines, F.lit(k + 1), n).alias(f"line{k}") for k in range(WINDOW_LINES)])
    return F.transform(
        beside,
        lambda w: F.unhex(F.md5(F.concat_ws("\n", *[w[f"line{k}"] for k in range(WINDOW_LINES)]).cast("binary"))),
    )


def later_windows(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, positions): the windows of each document that occurred before, in a smaller key or further up.

    Copies are counted before the shuffle, and a digest that many documents share is joined with the
    one row of its first occurrence, which adaptive execution can split.
    """
    lines = docs.filter(F.col("text").isNotNull()).select(F.col(key).alias("id"), F.split("text", "\n", -1).alias("l"))
    windows = lines.select("id", F.posexplode(window_digests(F.col("l"))).alias("pos", "digest"))
    repeated = (
        windows.groupBy("digest")
        .agg(F.min(F.struct("id", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", F.col("first.id").alias("first_id"), F.col("first.pos").alias("first_pos"))
    )
    later = windows.join(repeated, "digest").filter(
        ~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("pos") == F.col("first_pos")))
    )
    return later.groupBy(F.col("id").alias(key)).agg(F.collect_list("pos").alias("positions"))


def covered(n_lines: int, positions: np.ndarray) -> np.ndarray:
    """Which lines the windows at ``positions`` cover, overlaps merged."""
    edges = np.zeros(n_lines + 1, np.int64)
    np.add.at(edges, positions, 1)
    np.add.at(edges, positions + WINDOW_LINES, -1)
    return np.cumsum(edges[:-1]) > 0


@F.pandas_udf(CUT)
def _cut(texts: pd.Series, positions: pd.Series) -> pd.DataFrame:
    kept, removed = [], []
    for text, at in zip(texts, positions):
        if text is None or at is None:
            kept.append(text)
            removed.append(0)
            continue
        lines = text.split("\n")
        gone = covered(len(lines), np.unique(np.asarray(at, np.int64)))
        kept.append("\n".join([line for line, g in zip(lines, gone) if not g]))
        removed.append(int(gone.sum()))
    return pd.DataFrame({"text": kept, "n_removed": removed})


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with the lines removed that a later occurrence of a three-line window covers.

    Lines end at a line feed. Windows are judged on the input, and overlapping later windows remove the
    lines they cover together. The first occurrence, by key and then by position, stays. Adds n_lines
    and n_removed (long). A NULL text stays NULL with no lines; a text without line feeds has one line,
    and texts of fewer than three lines are kept whole. The key must tell documents apart: rows that
    share a key and a text lose the same lines, if any. A document all of whose lines go has an empty text. Columns that have the new names are replaced.
    """
    docs = docs.drop("n_lines", "n_removed")
    of, positions, cut = (free_name(docs, name) for name in ("__of", "__positions", "__cut"))
    found = later_windows(docs, key).toDF(of, positions)
    joined = docs.join(found, docs[key].eqNullSafe(found[of]), "left")
    result = joined.withColumn(cut, _cut("text", positions))
    n_lines = F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0))
    return result.select(
        *[docs[c] for c in docs.columns if c != "text"],
        F.col(f"{cut}.text").alias("text"),
        n_lines.cast("long").alias("n_lines"),
        F.col(f"{cut}.n_removed").alias("n_removed"),
    )
