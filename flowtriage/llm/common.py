"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtriage.operators.graph import connected_components as components
from flowtriage.runtime import materialise, release

__all__ = ["SPACE", "WORD", "components", "free_names", "hash128", "materialise", "release", "row_key", "table"]

#: The white space of the word pattern ``[^\x20\x09-\x0D]+``.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash128(*cols: Column) -> list[Column]:
    """Two independent 64-bit hashes of the columns (null skips, as in xxhash64)."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit(0x5EED), *cols)]


def row_key(*cols: Column) -> list[Column]:
    """128-bit key of a row, never null; nulls differ from empty strings."""
    marked = [x for c in cols for x in (c.isNull(), c)]
    return [c.alias(n) for c, n in zip(hash128(*marked), ("_k1", "_k2"))]


def free_names(df: DataFrame, *made: str) -> DataFrame:
    """Drop extra input columns whose names clash with the operator's own."""
    low = {m.lower() for m in made}
    return df.drop(*[c for c in df.columns if c.lower() in low])
