"""Recipes and plans as plain documents: what they must hold, and loops that run until a target is met."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_document(spark: SparkSession, path: str) -> dict:
    """One small JSON document."""
    return json.loads(spark.read.text(path, wholetext=True).first().value)


def recipe_faults(recipe: dict, suites: set[str]) -> list[str]:
    """What is wrong with a recipe's list of jobs, in order: names, their uniqueness, suites, options of no suite."""
    out, seen = [], set()
    for job in recipe.get("jobs") or []:
        name = str(job.get("name") or "")
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", name):
            out.append(f"{name or '(none)'}: not a plain folder name")
        if name in seen:
            out.append(f"{name}: named twice")
        seen.add(name)
        if job.get("suite") not in suites:
            out.append(f"{name}: unknown suite")
        if job.get("limit") is not None and (not isinstance(job["limit"], int) or job["limit"] < 1):
            out.append(f"{name}: limit below one")
    return out


def plan_faults(topics: DataFrame, concurrency: int, attempts: int, bounds: dict[str, tuple[int, int]]) -> DataFrame:
    """(fault, n) of a plan (topic_id, exchanges): repeated or missing topics, and numbers outside their bounds."""
    low, high = bounds["exchanges"]
    repeated = topics.filter("topic_id is not null").groupBy("topic_id").count().filter("count > 1").agg(F.count("*").alias("n")).select(F.lit("repeated topic").alias("fault"), "n")
    rows = topics.agg(F.count_if(F.col("topic_id").isNull()).alias("a"), F.count_if(~F.coalesce(F.col("exchanges").between(low, high), F.lit(False))).alias("b"))
    single = rows.select(F.explode(F.array(F.struct(F.lit("no topic").alias("fault"), F.col("a").alias("n")), F.struct(F.lit("exchanges out of bounds").alias("fault"), F.col("b").alias("n")))).alias("s")).select("s.*")
    given = [(f"{k} out of bounds", 1) for k, v in (("concurrency", concurrency), ("attempts", attempts)) if not bounds[k][0] <= v <= bounds[k][1]]
    return repeated.unionByName(single).unionByName(topics.sparkSession.createDataFrame(given, "fault string, n long")).filter("n > 0")


def until_target(batch: Callable[[int], DataFrame | None], passes: Callable[[DataFrame], DataFrame], target: int, target_path: str, order: str) -> DataFrame:
    """Write batch after batch until ``target`` rows pass, or there is no further batch; the first ``target`` rows in order.

    Each batch is written before it is counted, so a lost executor costs one batch at most.
    """
    have, number, spark, schema = 0, 0, None, None
    while have < target and (df := batch(number)) is not None:
        spark = df.sparkSession
        good = passes(df)
        schema = good.schema
        good.write.mode("overwrite").parquet(f"{target_path}/batch={number}")
        have += spark.read.schema(schema).parquet(f"{target_path}/batch={number}").count()
        number += 1
    if spark is None:
        raise ValueError("there is no batch")
    return spark.read.parquet(target_path).drop("batch").orderBy(order).limit(target)
