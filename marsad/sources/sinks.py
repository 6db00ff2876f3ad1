"""Writers: all rows, those that pass, splits with a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_export(rows: DataFrame, target: str, flag: str = "screening_passed") -> DataFrame:
    """Write every row and, apart, those whose flag is true; return one row of counts. The commit protocol makes each write whole or absent."""
    rows.write.mode("overwrite").json(f"{target}/all")
    rows.filter(F.col(flag).eqNullSafe(True)).write.mode("overwrite").json(f"{target}/passing")
    return rows.agg(F.count("*").alias("n"), F.count_if(F.col(flag).eqNullSafe(True)).alias("passing"), F.count_if(~F.col(flag).eqNullSafe(True)).alias("flagged"))


def write_splits(rows: DataFrame, target: str, split: str = "split") -> DataFrame:
    """Write one folder per split; return (split, n_rows, content_sum).

    ``content_sum`` adds 48 bits of every row's hash: it changes when a row changes, is lost or comes twice,
    and does not depend on the order of the rows.
    """
    rows.write.mode("overwrite").partitionBy(split).json(target)
    content = F.sha2(F.to_json(F.struct(*sorted(c for c in rows.columns if c != split))), 256)
    return rows.groupBy(split).agg(F.count("*").alias("n_rows"), F.sum(F.conv(F.substring(content, 1, 12), 16, 10).cast("decimal(38,0)")).alias("content_sum"))


def dataset_info(rows: DataFrame, batch: int, epochs: int) -> DataFrame:
    """(train_rows, steps_per_epoch, max_steps) of a training table."""
    return rows.agg(F.count("*").alias("train_rows")).select("train_rows", F.ceil(F.col("train_rows") / batch).alias("steps_per_epoch"), (F.ceil(F.col("train_rows") / batch) * epochs).alias("max_steps"))


def write_report(rows: DataFrame, target: str, split: str = "split", category: str = "domain") -> DataFrame:
    """Write splits with a one-row report and a card beside them; return the report (n, splits, categories)."""
    write_splits(rows, f"{target}/data", split)
    report = rows.agg(F.count("*").alias("n"), F.count_distinct(split).alias("splits"), F.count_distinct(category).alias("categories"))
    report.coalesce(1).write.mode("overwrite").json(f"{target}/report")
    table(rows.groupBy(split, category).agg(F.count("*").alias("n"))).coalesce(1).write.mode("overwrite").text(f"{target}/card")
    return report


def table(df: DataFrame) -> DataFrame:
    """A small aggregate as lines of a Markdown table, head first."""
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    lines = df.select(F.lit(2).alias("k"), F.concat(F.lit("| "), F.concat_ws(" | ", *(cell(c) for c in df.columns)), F.lit(" |")).alias("value"))
    head = df.sparkSession.createDataFrame([(0, "| " + " | ".join(df.columns) + " |"), (1, "|" + " --- |" * len(df.columns))], "k int, value string")
    return head.unionByName(lines).orderBy("k", "value").select("value")


def write_annotations(annotations: DataFrame, target: str) -> None:
    """Annotations as JSON Lines."""
    annotations.write.mode("overwrite").json(target)


ANNOTATION = "record_sha256 string, target string, reviewer string, verdict string, updated_at string"


def import_annotations(lines: DataFrame, verdicts: list[str]) -> tuple[DataFrame, DataFrame]:
    """JSON Lines of annotations (value) -> the last valid one per (record, target, reviewer), and (reason, n) of the others.

    Blank lines are skipped. The first rule that a line breaks is its reason: it does not parse, its hash is not 64 hex
    digits, its target is neither the conversation nor a number, its verdict is unknown, its time does not parse.
    """
    r = lines.filter(F.trim("value") != "").select(F.from_json("value", ANNOTATION + ", _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r")).select("r.*")
    at = F.try_to_timestamp("updated_at")
    holds = lambda c: F.coalesce(c, F.lit(False))
    reason = (
        F.when(F.col("_corrupt_record").isNotNull(), "malformed")
        .when(~holds(F.col("record_sha256").rlike("^[a-f0-9]{64}$")), "bad hash")
        .when(~holds(F.col("target").rlike("^(conversation|[0-9]+)$")), "bad target")
        .when(~holds(F.col("verdict").isin(verdicts)), "unknown verdict")
        .when(at.isNull(), "bad time")
    )
    judged = r.withColumn("reason", reason).withColumn("at", at)
    key = ["record_sha256", "target", "reviewer"]
    valid = judged.filter("reason is null").groupBy(*key).agg(F.max_by(F.struct("verdict", "updated_at"), F.struct("at", "verdict")).alias("last")).select(*key, "last.*")
    return valid, judged.filter("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))
