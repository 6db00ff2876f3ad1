"""Scores of replies: choices natively, n-gram and fuzzy scores in Arrow batches."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Option letters in order.
LETTERS = ["أ", "ب", "ج", "د", "هـ"]


def extract_choice(c: Column) -> Column:
    """The first option letter anywhere in a reply; null without one."""
    return F.nullif(F.regexp_extract(F.trim(c), "(" + "|".join(LETTERS) + ")", 1), F.lit(""))


def chosen_text(letter: Column, choices: Column) -> Column:
    place = F.array_position(F.array(*(F.lit(x) for x in LETTERS)), letter)
    return F.when(place > 0, F.try_element_at(choices, place.cast("int")))


def is_correct(reply: Column, choices: Column, gold: Column) -> Column:
    """Whether the chosen text equals the gold text; equal choice texts all count; no gold, no letter: false."""
    right = F.when((gold >= 0) & (gold < F.size(choices)), F.try_element_at(choices, gold + 1))
    return F.coalesce(F.trim(chosen_text(extract_choice(reply), choices)) == F.trim(right), F.lit(False))


def judge_score(c: Column) -> Column:
    """The first numeric word of a judgement, divided by ten and held within 0 and 1; 0 without one."""
    first = F.try_element_at(F.filter(F.split(F.trim(c), r"\s+"), lambda w: w.rlike(r"^(\d+\.?\d*|\.\d+)$")), F.lit(1))
    return F.coalesce(F.least(F.lit(1.0), F.greatest(F.lit(0.0), first.cast("double") / 10)), F.lit(0.0))


def split_words(c: Column) -> Column:
    """Words between white space, in order; case counts. Null gives no words."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda w: w != "")


def word_runs(w: Column, n: int) -> Column:
    """All runs of n words, repeats included, of a bound list of words."""
    if n == 1:
        return w
    runs = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))
    return F.when(F.size(w) >= n, runs).otherwise(F.array().cast("array<string>"))


def bound(value: Column, f) -> Column:
    """``f`` of a value that is bound as a lambda variable, so that no rewrite of the plan evaluates it again at each use."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _count(x: Column, g: Column) -> Column:
    return F.size(F.filter(x, lambda y: y == g))


def shared_runs(a: Column, b: Column) -> Column:
    """How many runs two bound lists share, each as often as both have it."""
    return F.aggregate(F.array_intersect(a, b), F.lit(0), lambda total, g: total + F.least(_count(a, g), _count(b, g)))


def overlap_f1(a: Column, b: Column, n: int) -> Column:
    """F1 of the shared runs of n words of two bound lists of words; 0 where one side has no run."""

    def score(s: Column) -> Column:
        x, y = s["x"], s["y"]
        return F.when((F.size(x) > 0) & (F.size(y) > 0), 2 * shared_runs(x, y) / (F.size(x) + F.size(y))).otherwise(F.lit(0.0))

    return bound(F.struct(word_runs(a, n).alias("x"), word_runs(b, n).alias("y")), score)


def _texts(reply: Column, references: Column) -> Column:
    refs = F.filter(F.transform(F.filter(references, lambda r: r.isNotNull()), split_words), lambda r: F.size(r) > 0)
    return F.struct(split_words(reply).alias("w"), refs.alias("refs"))


def rouge12(reply: Column, references: Column) -> tuple[Column, Column]:
    """ROUGE-1 and ROUGE-2 against the best of several references, in built-in expressions; 0 without words or references."""

    def best(n: int) -> Column:
        return bound(_texts(reply, references), lambda s: F.coalesce(F.array_max(F.transform(s["refs"], lambda r: overlap_f1(s["w"], r, n))), F.lit(0.0)))

    return best(1), best(2)


def bleu(reply: Column, references: Column) -> Column:
    """Sentence BLEU of up to four words, each count raised by one, with a penalty for replies shorter than the closest reference; 0 without words or references.

    A run counts at most as often as the reference that has it most often.
    """

    def logs(s: Column, n: int) -> Column:
        runs = F.struct(word_runs(s["w"], n).alias("mine"), F.transform(s["refs"], lambda r: word_runs(r, n)).alias("theirs"))

        def one(t: Column) -> Column:
            most = lambda g: F.coalesce(F.array_max(F.transform(t["theirs"], lambda r: _count(r, g))), F.lit(0))
            hits = F.aggregate(F.array_distinct(t["mine"]), F.lit(0), lambda total, g: total + F.least(_count(t["mine"], g), most(g)))
            return F.log((hits + 1.0) / (F.size(t["mine"]) + 1.0)) / 4

        return bound(runs, one)

    def score(s: Column) -> Column:
        size = F.size(s["w"])
        # of lengths as close, the shorter one
        closest = F.array_min(F.transform(s["refs"], lambda r: F.struct(F.abs(F.size(r) - size).alias("away"), F.size(r).alias("length"))))["length"]
        penalty = F.when(size >= closest, F.lit(1.0)).otherwise(F.exp(1 - closest / size))
        return F.when((size > 0) & (F.size(s["refs"]) > 0), F.exp(logs(s, 1) + logs(s, 2) + logs(s, 3) + logs(s, 4)) * penalty).otherwise(F.lit(0.0))

    return bound(_texts(reply, references), score)


def common_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence; a bit of one long integer stands for each word of ``a``."""
    at: dict[str, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        if w in at:
            u = row & at[w]
            row = (row + u | row - u) & full
    return len(a) - row.bit_count()


def rouge_l_of(reply: str | None, references: list[str]) -> float:
    """F1 of the longest common subsequence with the best reference."""
    p, best = (reply or "").split(), 0.0
    for r in references:
        q = r.split()
        if hit := common_length(p, q):
            best = max(best, 2 * hit / (len(p) + len(q)))
    return best


def fuzzy_of(reply: str | None, references: list[str]) -> float:
    """1 where a reference is at least 0.85 like the reply or a stretch of it as long as the reference, else 0.

    Likeness is that of matching blocks, reference first, stretch second: the order matters. Case, punctuation
    and repeated blanks don't count.
    """
    plain = lambda x: " ".join(re.sub(r"[^\w\s]", " ", (x or "").casefold()).split())
    p = plain(reply)
    for t in filter(None, map(plain, references)):
        if not p:
            break
        if t in p:
            return 1.0
        for at in range(max(1, len(p) - len(t) + 1)):
            m = SequenceMatcher(None, t, p[at : at + len(t)])
            if m.real_quick_ratio() >= FUZZY and m.quick_ratio() >= FUZZY and m.ratio() >= FUZZY:
                return 1.0
    return 0.0


# From this likeness on a fuzzy match counts.
FUZZY = 0.85


def _per_reply(f) -> object:
    """A pandas function over (reply, references) for what has no built-in expression; null references are left out."""

    def run(replies: pd.Series, references: pd.Series) -> pd.Series:
        return pd.Series([f(p, [] if r is None else [x for x in r if x is not None]) for p, r in zip(replies, references)], dtype=float)

    run.__annotations__ = {"replies": pd.Series, "references": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "double")


def rouge_l(reply: Column, references: Column) -> Column:
    return _per_reply(rouge_l_of)(reply, references)


def fuzzy(reply: Column, references: Column) -> Column:
    return _per_reply(fuzzy_of)(reply, references)


def primary(metric: Column, bleu_: Column, rouge_l: Column, accuracy: Column) -> Column:
    """The score that counts for a metric; an unknown metric is an error."""
    return F.when(metric == "bleu", bleu_).when(metric == "rouge", rouge_l).when(metric == "accuracy", accuracy).otherwise(F.raise_error(F.concat(F.lit("unknown metric "), metric)).cast("double"))


#: Scorers by name: (reply, references) -> score.
SCORERS = {"bleu": bleu, "rouge": rouge_l, "accuracy": fuzzy, "rouge1": lambda p, r: rouge12(p, r)[0], "rouge2": lambda p, r: rouge12(p, r)[1]}


def scorer(name: str):
    """Register a scorer, a function of (reply, references) that gives a column."""

    def add(f):
        SCORERS[name] = f
        return f

    return add


def scored(df: DataFrame, names: list[str], reply: str = "reply", references: str = "references") -> DataFrame:
    """Add a column a scorer; an unknown name is an error before anything runs."""
    unknown = [n for n in names if n not in SCORERS]
    if unknown:
        raise ValueError(f"no scorer named {', '.join(unknown)}")
    return df.select("*", *(SCORERS[n](F.col(reply), F.col(references)).alias(n) for n in names))
