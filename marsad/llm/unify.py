"""Problem 2: bring text to one consistent form and match records that show alike."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marsad.functions.text import word_count
from marsad.llm import forms
from marsad.session import cut
from marsad.tables import load, role

#: A group with more records than this is paired in a salted join rather than within one task.
LONG_GROUP = 1_000
SALTS = 32


def with_consistent_form(df: DataFrame, columns: list[str], suffix: str = "_form") -> DataFrame:
    """Add the consistent form of each text column. Null stays null, empty stays empty, rows are kept."""
    @F.pandas_udf("string")
    def form(s: pd.Series) -> pd.Series:
        return s.map(forms.consistent, na_action="ignore")

    for c in columns:
        df = df.withColumn(c + suffix, form(F.col(c)))
    return df


def skeletons(texts: DataFrame) -> DataFrame:
    """(record_table, record_key, text) -> (record_table, record_key, skeleton, stored): two 128-bit hashes a record.

    ``skeleton`` is equal for texts that show alike, ``stored`` for equal strings. Null and blank
    texts give no row, and rows without a table match nothing. Extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in forms.slices(batches):
            table, key, skel, raw = [], [], [], []
            for t, k, x in zip(*(b.column(i).to_pylist() for i in range(3))):
                if x is None or not (y := forms.consistent(x)).strip():
                    continue
                table.append(t)
                key.append(k)
                raw.append(d := forms.digest128(x))
                skel.append(d if y is x else forms.digest128(y))
            yield pa.RecordBatch.from_arrays([pa.array(table, pa.string()), pa.array(key, pa.int64()), pa.array(skel, pa.binary()), pa.array(raw, pa.binary())], names=["record_table", "record_key", "skeleton", "stored"])

    return texts.select("record_table", "record_key", "text").mapInArrow(run, "record_table string, record_key long, skeleton binary, stored binary")


def alike_groups(texts: DataFrame) -> DataFrame:
    """Membership: (record_table, skeleton, stored, record_key) of records of which another one shows alike but differs.

    Repeated deliveries of a record count once. Groups are found by partial aggregation, so one
    skeleton that a third of all rows share is combined before the shuffle.
    """
    s = cut(skeletons(texts))
    variants = s.groupBy("record_table", "skeleton", "stored").agg(F.count("*").alias("n"))
    groups = variants.groupBy("record_table", "skeleton").agg(F.count("*").alias("variants")).filter("variants > 1")
    members = cut(s.join(groups, ["record_table", "skeleton"]).dropDuplicates(["record_table", "skeleton", "stored", "record_key"]))
    sizes = members.groupBy("record_table", "skeleton").agg(F.count_distinct("record_key").alias("records"))
    return members.join(sizes, ["record_table", "skeleton"])


def alike_pairs(members: DataFrame, expand_records: int | None = None, long_group: int = LONG_GROUP) -> DataFrame:
    """Pairs (record_table, key_a, key_b), key_a < key_b, of records whose strings differ and show alike.

    Every group gives all its pairs. Only a caller that sets ``expand_records`` gets links instead from
    groups of more records: each record with the smallest key of the first form it does not have itself,
    which takes one row a record and connects the whole group, but leaves out its other pairs.
    """
    m = members.select("record_table", "skeleton", "stored", "record_key", "records")
    whole = m if expand_records is None else m.filter(F.col("records") <= expand_records)

    def both(part: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
        return tuple(part.select(*on, F.col("stored").alias(f"stored_{x}"), F.col("record_key").alias(f"key_{x}")) for x in "ab")

    on = ["record_table", "skeleton"]
    a, b = both(whole.filter(F.col("records") <= long_group), on)
    pairs = a.join(b, on)
    a, b = both(whole.filter(F.col("records") > long_group), on)
    on = [*on, "salt"]
    # a fixed number of partitions, as adaptive execution would put the salts of few bytes back into one task
    a = a.withColumn("salt", F.pmod(F.hash("key_a"), F.lit(SALTS))).repartition(SALTS, *on)
    b = b.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).repartition(SALTS, *on)
    pairs = pairs.unionByName(a.join(b, on).drop("salt")).filter("key_a < key_b and stored_a <> stored_b").select("record_table", "key_a", "key_b")
    if expand_records is None:
        return pairs.distinct()
    large = m.filter(F.col("records") > expand_records)
    reps = large.groupBy("record_table", "skeleton", "stored").agg(F.min("record_key").alias("rep"))
    two = reps.groupBy("record_table", "skeleton").agg(F.min(F.struct("rep", "stored")).alias("one"), F.max(F.struct("rep", "stored")).alias("other"))
    links = (
        large.join(two, ["record_table", "skeleton"])
        .withColumn("rep", F.when(F.col("stored") != F.col("one.stored"), F.col("one.rep")).otherwise(F.col("other.rep")))
        .select("record_table", F.least("record_key", "rep").alias("key_a"), F.greatest("record_key", "rep").alias("key_b"))
    )
    return pairs.unionByName(links).distinct()


def project_texts(spark: SparkSession, directory: str) -> DataFrame:
    """The texts that this project compares, as (record_table, record_key, text)."""

    def of(table: str, df: DataFrame, key: str, text: str) -> DataFrame:
        return df.select(F.lit(table).alias("record_table"), F.col(key).cast("long").alias("record_key"), F.col(text).alias("text"))

    messages = load(spark, directory, "messages").filter(role() == "assistant")
    return (
        of("seed_pool", load(spark, directory, "seed_pool"), "seed_index", "question")
        .unionByName(of("mcq_items", load(spark, directory, "mcq_items"), "item_no", "input_text"))
        .unionByName(of("messages", messages, "message_id", "content"))
    )


def p2_found(spark: SparkSession, directory: str) -> DataFrame:
    """Pairs that show alike, of messages those of at least ten words."""
    texts = project_texts(spark, directory)
    return alike_pairs(alike_groups(texts.filter((F.col("record_table") != "messages") | (word_count(F.col("text")) >= 10))))


def p2_consistent_texts(spark: SparkSession, directory: str) -> DataFrame:
    """Every text in its consistent form, as (record_table, record_key, text, form)."""
    texts = project_texts(spark, directory).filter("text is not null")
    return with_consistent_form(texts, ["text"], "_form").select("record_table", "record_key", "text_form").distinct()


def p2_groups(spark: SparkSession, directory: str) -> DataFrame:
    """Membership of the groups that show alike: (record_table, group_key, record_key, records)."""
    m = alike_groups(project_texts(spark, directory))
    return m.select("record_table", F.hex("skeleton").alias("group_key"), "record_key", "records")
