"""Items, prompts, answers and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from marsad.functions import scoring as S
from marsad.functions import text as T
from marsad.operators.ordering import numbered
from marsad.plans.catalog import query
from marsad.plans.explorer import MSG
from marsad.tables import load, role

LET = "['أ', 'ب', 'ج', 'د', 'هـ']"


@query("mcq_prompts", f"SELECT item_no, input_text || chr(10) || array_to_string(list_transform(range(1, len(choices) + 1), lambda i: coalesce({LET}[i], i::varchar) || '. ' || choices[i]), chr(10)) || chr(10) || 'Answer:' AS prompt FROM mcq_items WHERE input_text IS NOT NULL AND choices IS NOT NULL")
def mcq_prompts(spark, sf):
    """Question, lettered options and an answer line."""
    letters = F.array(*(F.lit(x) for x in S.LETTERS))
    # options past the fifth letter are numbered
    lines = F.array_join(F.transform("choices", lambda x, i: F.concat(F.coalesce(F.get(letters, i), (i + 1).cast("string")), F.lit(". "), x)), "\n")
    return load(spark, sf, "mcq_items").filter("input_text is not null and choices is not null").select("item_no", F.concat("input_text", F.lit("\n"), lines, F.lit("\nAnswer:")).alias("prompt"))


@query("items_by_subset", "SELECT string_split(subset, ':')[1] AS family, split_part(split_part(subset, ':', 2), '=', 2) AS subject, count(*) AS n, count(*) FILTER (gold_index IS NULL OR gold_index < 0 OR gold_index >= len(choices)) AS bad_gold FROM mcq_items GROUP BY ALL")
def items_by_subset(spark, sf):
    """Items by family and subject out of their run entry, and how many have no usable answer key."""
    i = load(spark, sf, "mcq_items")
    args = F.str_to_map(F.split_part("subset", F.lit(":"), F.lit(2)), F.lit(","), F.lit("="))
    bad = F.coalesce((F.col("gold_index") < 0) | (F.col("gold_index") >= F.size("choices")), F.lit(True))
    return i.groupBy(F.split_part("subset", F.lit(":"), F.lit(1)).alias("family"), F.coalesce(args["subject"], F.lit("")).alias("subject")).agg(F.count("*").alias("n"), F.count_if(bad).alias("bad_gold"))


# replies of a model stand in the answers of the chats: the n-th item is answered by the n-th reference text
ANSWERS = f"""a AS (SELECT subset, i.item_no, i.choices, i.gold_index, r.assistant AS reply FROM mcq_items i JOIN (SELECT assistant, row_number() OVER (ORDER BY id) - 1 AS n FROM hybrid_references) r ON r.n = i.item_no % (SELECT count(*) FROM hybrid_references))"""


def item_answers(spark, sf):
    """Items with texts that stand for a model's replies: free text, in which an option letter may stand or not."""
    r = numbered(load(spark, sf, "hybrid_references").select("id", F.col("assistant").alias("reply")), ["id"], "n")
    # one row
    size = load(spark, sf, "hybrid_references").agg(F.count("*").alias("size"))
    i = load(spark, sf, "mcq_items").join(F.broadcast(size)).withColumn("n", F.col("item_no") % F.col("size"))
    return i.join(r.select("n", "reply"), "n")


@query(
    "choice_accuracy",
    f"""WITH {ANSWERS}, l AS (SELECT *, list_position({LET}, nullif(regexp_extract(trim(reply), '(أ|ب|ج|د|هـ)', 1), '')) AS k FROM a),
    s AS (SELECT subset, k IS NOT NULL AS said, coalesce(trim(choices[k]) = trim(CASE WHEN gold_index >= 0 AND gold_index < len(choices) THEN choices[gold_index + 1] END), false) AS ok FROM l)
    SELECT subset, count(*) AS n, count(*) FILTER (said) AS with_letter, avg(ok::int) AS accuracy FROM s GROUP BY subset""",
)
def choice_accuracy(spark, sf):
    """Accuracy by subset of free-text replies, by the first option letter in each."""
    ok = S.is_correct(F.col("reply"), F.col("choices"), F.col("gold_index"))
    said = S.extract_choice(F.col("reply")).isNotNull()
    return item_answers(spark, sf).groupBy("subset").agg(F.count("*").alias("n"), F.count_if(said).alias("with_letter"), F.avg(ok.cast("int")).alias("accuracy"))


@query(
    "macro_mean_score",
    f"""WITH {ANSWERS}, l AS (SELECT *, list_position({LET}, nullif(regexp_extract(trim(reply), '(أ|ب|ج|د|هـ)', 1), '')) AS k FROM a),
    s AS (SELECT split_part(subset, ':', 1) AS suite, subset, avg(coalesce(trim(choices[k]) = trim(CASE WHEN gold_index >= 0 AND gold_index < len(choices) THEN choices[gold_index + 1] END), false)::int) AS score FROM l GROUP BY ALL)
    SELECT suite, count(*) AS tasks, avg(score) AS mean_score FROM s GROUP BY suite""",
)
def macro_mean_score(spark, sf):
    """Unweighted mean over the tasks of a suite, however many items each has."""
    s = choice_accuracy(spark, sf).select(F.split_part("subset", F.lit(":"), F.lit(1)).alias("suite"), "accuracy")
    return s.groupBy("suite").agg(F.count("*").alias("tasks"), F.avg("accuracy").alias("mean_score"))


@query(
    "judge_score_parse",
    f"""SELECT message_id, coalesce(least(1.0, greatest(0.0, list_filter(string_split_regex(trim(content), '\\s+'), lambda w: regexp_full_match(w, '\\d+\\.?\\d*|\\.\\d+'))[1]::double / 10)), 0.0) AS score FROM {MSG} WHERE role = 'assistant' AND content IS NOT NULL""",
)
def judge_score_parse(spark, sf):
    """The first number that stands alone in a text, as a score of ten; texts without one score 0."""
    m = load(spark, sf, "messages").filter((role() == "assistant") & F.col("content").isNotNull()).select("message_id", "content").dropDuplicates(["message_id"])
    return m.select("message_id", S.judge_score(F.col("content")).alias("score"))


def answer_pairs(spark, sf):
    """Each answer beside the style reference of the same domain with the smallest id."""
    m = load(spark, sf, "messages").filter((role() == "assistant") & F.col("content").isNotNull()).select("message_id", "content", "domain").dropDuplicates(["message_id"])
    r = load(spark, sf, "hybrid_references").filter("assistant is not null and assistant <> '' and domain is not null").groupBy("domain").agg(F.min_by("assistant", "id").alias("reference"))
    return m.join(r, "domain")


SPLIT = "list_filter(string_split_regex({}, '\\s+'), lambda w: w <> '')"
PAIRS = f"""p AS (SELECT m.message_id, {SPLIT.format('m.content')} AS a, {SPLIT.format('r.reference')} AS b FROM {MSG} m
JOIN (SELECT domain, arg_min(assistant, id) AS reference FROM hybrid_references WHERE assistant <> '' AND domain IS NOT NULL GROUP BY domain) r USING (domain) WHERE m.role = 'assistant' AND m.content IS NOT NULL)"""


def runs_sql(n: int) -> str:
    """Counts of runs of n words of both sides, and the shared ones."""
    runs = lambda c: f"unnest([array_to_string({c}[i:i + {n - 1}], ' ') for i in range(1, len({c}) - {n - 2})])"
    return f"""x{n} AS (SELECT message_id, w, count(*) AS n FROM (SELECT message_id, {runs('a')} AS w FROM p) GROUP BY ALL), y{n} AS (SELECT message_id, w, count(*) AS n FROM (SELECT message_id, {runs('b')} AS w FROM p) GROUP BY ALL),
    h{n} AS (SELECT message_id, sum(least(x{n}.n, y{n}.n)) AS hit FROM x{n} JOIN y{n} USING (message_id, w) GROUP BY message_id)"""


@query(
    "rouge1_reply",
    f"WITH {PAIRS}, {runs_sql(1)} SELECT message_id, round(2 * hit / (len(a) + len(b)), 6) AS rouge1 FROM p JOIN h1 USING (message_id)",
)
def rouge1_reply(spark, sf):
    """Word overlap of answers with a reference, where there is any."""
    one, _ = S.rouge12(F.col("content"), F.array("reference"))
    return answer_pairs(spark, sf).select("message_id", F.round(one, 6).alias("rouge1")).filter("rouge1 > 0")


@query(
    "bleu_rouge_reply",
    f"""WITH {PAIRS}, {', '.join(runs_sql(n) for n in (1, 2, 3, 4))},
    s AS (SELECT p.message_id, len(a) AS m, len(b) AS r, {', '.join(f'coalesce(h{n}.hit, 0) AS s{n}' for n in (1, 2, 3, 4))} FROM p {' '.join(f'LEFT JOIN h{n} ON h{n}.message_id = p.message_id' for n in (1, 2, 3, 4))})
    SELECT message_id, round(CASE WHEN m > 0 AND r > 0 THEN exp({' + '.join(f'ln((s{n} + 1.0) / (greatest(m - {n - 1}, 0) + 1.0)) / 4' for n in (1, 2, 3, 4))}) * CASE WHEN m >= r THEN 1 ELSE exp(1 - r / m) END ELSE 0 END, 6) AS bleu,
    round(CASE WHEN m > 0 AND r > 0 THEN 2 * s1 / (m + r) ELSE 0 END, 6) AS rouge1, round(CASE WHEN m > 1 AND r > 1 THEN 2 * s2 / (m + r - 2) ELSE 0 END, 6) AS rouge2 FROM s""",
)
def bleu_rouge_reply(spark, sf):
    refs = F.array("reference")
    one, two = S.rouge12(F.col("content"), refs)
    return answer_pairs(spark, sf).select("message_id", F.round(S.bleu(F.col("content"), refs), 6).alias("bleu"), F.round(one, 6).alias("rouge1"), F.round(two, 6).alias("rouge2"))


@query("rouge_l_reply")
def rouge_l_reply(spark, sf):
    """Longest common subsequence of answers with a reference; tested on hand-worked values."""
    return answer_pairs(spark, sf).select("message_id", S.rouge_l(F.col("content"), F.array("reference")).alias("rouge_l"))


@query("fuzzy_reply")
def fuzzy_reply(spark, sf):
    """Whether a reply has the gold choice, fuzzily; tested on hand-worked values."""
    i = item_answers(spark, sf).filter("gold_index >= 0 and gold_index < size(choices)")
    return i.select("item_no", S.fuzzy(F.col("reply"), F.array(F.element_at("choices", F.col("gold_index") + 1))).alias("accuracy"))
