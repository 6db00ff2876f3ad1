"""Evaluation runs: status and metrics files, joined under a hash of the command, collected as they come."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STATUS = "sampler_path string, step bigint, returncode int, command_hash string"
METRICS = "status int, metrics map<string,string>"


def _named(df: DataFrame) -> DataFrame:
    """Add job and run, the two folders above a file."""
    parts = F.split("_metadata.file_path", "/")
    return df.select("*", F.element_at(parts, -3).alias("job"), F.element_at(parts, -2).alias("run"))


def read_status(spark: SparkSession, root: str) -> DataFrame:
    """(job, run, sampler_path, step, returncode, command_hash) of root/<job>/<run>/status.json."""
    return _named(spark.read.schema(STATUS).option("multiLine", True).json(f"{root}/*/*/status.json"))


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """(job, run, status, metrics) of root/<job>/<run>/metrics.json; values stay text until they are used."""
    return _named(spark.read.schema(METRICS).option("multiLine", True).json(f"{root}/*/*/metrics.json"))


def command_hash(arguments: Column) -> Column:
    """16 hex digits of the hash of a list of arguments joined by NUL."""
    return F.left(F.sha2(F.encode(F.array_join(arguments, "\x00"), "UTF-8"), 256), F.lit(16))


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def joined(status: DataFrame, metrics: DataFrame, jobs: DataFrame, suites: list[str]) -> DataFrame:
    """(job, run, step, metric, value) of completed runs.

    jobs: (job, command array<string>) of enabled jobs. A run counts where it and its metrics ended with 0, it has a
    sampler path and a step, and its hash is that of its job's command with sampler path and step added; finite values of
    the given suites count. Null fields never match.
    """
    expected = command_hash(F.concat("command", F.array(F.col("sampler_path"), F.col("step").cast("string"))))
    ran = status.filter("returncode = 0 and step is not null and coalesce(sampler_path, '') <> ''").join(jobs, "job").filter(F.col("command_hash") == expected)
    value = F.col("value").try_cast("double")
    rows = metrics.filter("status = 0").select("job", "run", F.explode("metrics").alias("metric", "value"))
    known = F.split_part("metric", F.lit("/"), F.lit(1)).isin(suites) & F.col("metric").contains("/")
    rows = rows.filter(known).select("job", "run", "metric", value.alias("value")).filter(finite(F.col("value")))
    return ran.select("job", "run", "step").join(rows, ["job", "run"])


def collect_new(spark: SparkSession, root: str, jobs: DataFrame, suites: list[str], target: str, state: str) -> DataFrame:
    """Add the trend rows of status files that were not seen before to a table, and read the table.

    The file source remembers what it has read in ``state``; a run whose metrics come later than its status
    is found when its status is written again.
    """
    stream = _named(spark.readStream.schema(STATUS).option("multiLine", True).json(f"{root}/*/*/status.json"))
    rows = joined(stream, read_metrics(spark, root), jobs, suites)
    q = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(rows.schema).parquet(target)


def pending(log: DataFrame, status: DataFrame) -> DataFrame:
    """Entries of a checkpoint log, (checkpoint_id, command_hash, ...), without a run of the same id and hash that ended with 0."""
    done = status.filter("returncode = 0").select(F.col("run").alias("checkpoint_id"), "command_hash").distinct()
    return log.join(done, ["checkpoint_id", "command_hash"], "left_anti")


def new_run(before: DataFrame, after: DataFrame) -> str:
    """The one name that a listing (name) has and an earlier one has not; none or several are an error."""
    names = [r.name for r in after.select("name").subtract(before.select("name")).limit(2).collect()]
    if len(names) != 1:
        raise ValueError("there is not exactly one new run")
    return names[0]
