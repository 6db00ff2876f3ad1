"""Loaders for parquet tables and the rule by which repeated deliveries count once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def role(column: Column | str = "role") -> Column:
    """A role without case and outer blanks."""
    c = F.col(column) if isinstance(column, str) else column
    return F.lower(F.trim(c))


def latest(df: DataFrame, key: str | list[str], by: str = "ingested_at") -> DataFrame:
    """One row per key: the delivery with the latest ``by``; ties fall to the smallest row hash.

    Aggregates instead of ranking, so a key that is delivered millions of times is combined
    before the shuffle. Null keys form one group. An empty table stays empty.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*rest)
    order = F.struct(F.col(by), F.xxhash64(*rest))
    return df.groupBy(*keys).agg(F.max_by(row, order).alias("_row")).select(*keys, "_row.*").select(*df.columns)
