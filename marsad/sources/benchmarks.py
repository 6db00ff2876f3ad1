"""Benchmark tables of several shapes as items: (id, input_text, choices, gold_index, subset).

A gold index is null where the key names no option; rows are never dropped but by the stated filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marsad.operators.ordering import numbered


def _items(df: DataFrame, ident: Column, text: Column, choices: Column, gold: Column, subset: Column) -> DataFrame:
    return df.select(ident.alias("id"), text.alias("input_text"), choices.alias("choices"), gold.cast("int").alias("gold_index"), subset.alias("subset"))


def in_order(df: DataFrame, order: list[str]) -> Column | DataFrame:
    """Add ``n``, the place of each row in an order, for benchmarks whose ids are places."""
    return numbered(df, order, "n")


def letter_index(key: Column, letters: str) -> Column:
    """The place of an answer letter; null for anything else."""
    place = F.instr(F.lit(letters), F.trim(key))
    return F.when((F.length(F.trim(key)) == 1) & (place > 0), place - 1)


def with_context(df: DataFrame, order: list[str], subset: str, options: list[str]) -> DataFrame:
    """Columns Context, Question, options and a letter key: the context stands before the question where it is not blank; empty options go."""
    text = F.when(F.trim(F.coalesce("Context", F.lit(""))) != "", F.concat("Context", F.lit("\n\n"), "Question")).otherwise(F.col("Question"))
    choices = F.filter(F.array(*(F.col(f"`{c}`") for c in options)), lambda x: x.isNotNull() & (x != ""))
    n = in_order(df, order)
    return _items(n, F.concat(F.lit("id"), "n"), text, choices, letter_index(F.col("`Answer Key`"), "ABCDEFGHIJ"), F.lit(subset))


def with_numbers(df: DataFrame, order: list[str], subject: str) -> DataFrame:
    """Columns question, choices and a number as the answer."""
    n = in_order(df, order)
    return _items(n, F.concat(F.lit(f"id-{subject}-"), "n"), F.col("question"), F.col("choices"), F.col("answer").try_cast("int"), F.lit(subject))


def by_id_prefix(df: DataFrame, subject: str, letters: str = "ABCD") -> DataFrame:
    """Columns id, question, one column a letter and a letter as the answer: rows whose id begins with the subject and whose answer is one of the letters."""
    mine = df.filter((F.split_part("id", F.lit("-"), F.lit(1)) == subject.replace("_", " ")) & F.col("answer").isin(list(letters)))
    return _items(mine, F.col("id"), F.col("question"), F.array(*letters), letter_index(F.col("answer"), letters), F.lit(subject))


def by_category(df: DataFrame, order: list[str], category: str, letters: str = "أبج") -> DataFrame:
    """Columns Category, Question, A, B, C and Answer: options begin with their letter and a bracket, which go; an option without them is an error.

    The bare alef of an answer stands for the one with hamza.
    """
    options = F.filter(F.array("A", "B", "C"), lambda x: x.isNotNull() & (x != ""))
    marks = F.array(*(F.lit(f"{x})") for x in letters))
    stripped = F.transform(options, lambda x, i: F.when(F.trim(x).startswith(F.get(marks, i)), F.trim(F.regexp_replace(x, r"^[^)]*\)", ""))).otherwise(F.raise_error(F.concat(F.lit("an option without its letter: "), x)).cast("string")))
    answer = F.when(F.trim("Answer") == "ا", "أ").otherwise(F.trim("Answer"))
    n = in_order(df, order).filter(F.col("Category") == category.replace("_", " "))
    return _items(n, F.concat(F.lit("id"), "n"), F.col("Question"), stripped, letter_index(answer, letters), F.lit(category))


def with_candidates(df: DataFrame) -> DataFrame:
    """Columns id, question, candidates, gold_answer -> (id, input_text, target, subset): free answers from given contexts."""
    text = F.concat(F.lit("السؤال:\n"), "question", F.lit("\n\nالسياقات المقترحة:\n"), "candidates", F.lit("\n"))
    return df.select("id", text.alias("input_text"), F.col("gold_answer").alias("target"), F.lit("contexts").alias("subset"))
