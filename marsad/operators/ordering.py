"""Order-dependent operators: apportionment, cyclic assignment, seeded samples and family splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marsad.session import cut


def apportion(weights: DataFrame, total: int) -> DataFrame:
    """(key, weight) -> (key, quota): largest remainders, ties by key; quotas sum to ``total``.

    One row per key is expected, a short list. Null and negative weights count as 0; with no positive
    weight every quota is 0.
    """
    w = weights.select("key", F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("weight"))
    everything = Window.partitionBy()
    raw = F.when(F.col("sum") > 0, F.lit(total) * F.col("weight") / F.col("sum")).otherwise(0.0)
    parts = w.withColumn("sum", F.sum("weight").over(everything)).withColumn("raw", raw).withColumn("base", F.floor("raw")).withColumn("rest", F.col("raw") - F.col("base"))
    left = F.when(F.col("sum") > 0, F.lit(total) - F.sum("base").over(everything)).otherwise(0)
    place = F.row_number().over(Window.partitionBy().orderBy(F.desc("rest"), "key"))
    return parts.withColumn("left", left).withColumn("place", place).select("key", (F.col("base") + (F.col("place") <= F.col("left")).cast("long")).cast("long").alias("quota"))


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """Number rows from 0 in a total order, spread over tasks.

    Rows are range-partitioned and sorted; each task numbers its own rows and adds the counts of the
    tasks before it, so no single task sees all rows.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_local", F.monotonically_increasing_id())
    spread = cut(spread)
    counts = spread.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_local").alias("_first"))
    # as many rows as partitions
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy().orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    joined = spread.join(F.broadcast(before.select("_part", "_first", "_before")), "_part")
    return joined.withColumn(name, F.col("_local") - F.col("_first") + F.col("_before")).drop("_part", "_local", "_first", "_before")


def placed(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Number the rows of each group from 0 in an order: all rows are numbered over all tasks, less the group's first number."""
    n = numbered(df, [*group, *order], "_n")
    first = n.groupBy(*group).agg(F.min("_n").alias("_first"))
    same = None
    for c in group:
        test = F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
        same = test if same is None else same & test
    return n.alias("x").join(first.alias("y"), same).select(*(F.col(f"x.{c}") for c in df.columns), (F.col("x._n") - F.col("y._first")).alias("place"))


def sample_key(seed: int, *columns: Column) -> Column:
    """A seeded order that any engine can repeat: the SHA-256 of seed and columns."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *(c.cast("string") for c in columns)), 256)


def family_split(df: DataFrame, family: str, fraction: float, seed: int) -> DataFrame:
    """(family, split): families in the order of their hash; max(1, round(n * fraction)) of n > 1 are validation.

    Rounding is half to even. Null families form no family. Families are counted once however many rows they have.
    """
    f = df.select(F.col(family).alias("family")).filter("family is not null").distinct().withColumn("k", sample_key(seed, F.col("family")))
    ranked = numbered(f, ["k"], "place")
    n = f.agg(F.count("*").alias("n"))
    wanted = F.when((F.lit(fraction) > 0) & (F.col("n") > 1), F.greatest(F.lit(1), F.bround(F.col("n") * fraction))).otherwise(0)
    # n is one row
    return ranked.join(F.broadcast(n)).select("family", F.when(F.col("place") < wanted, "validation").otherwise("train").alias("split"))
