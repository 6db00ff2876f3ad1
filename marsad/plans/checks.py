"""Checks of every message of a chat, gathered as one list of issues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marsad.functions import text as T
from marsad.operators.ordering import placed
from marsad.operators.similarity import jaccard_classes
from marsad.plans.catalog import query
from marsad.plans.explorer import CONV, MSG
from marsad.plans.similar import COPIED, close_sql
from marsad.session import cut
from marsad.tables import latest, load, role

FIRST_WORDS, LATER_WORDS, ANSWER_WORDS = 24, 18, 60
URL = r"https?://[^\s)\]>]+"


def placed_messages(messages: DataFrame) -> DataFrame:
    """(message_id, seed_index, role, content, place): messages of each chat but for system ones, numbered from 0 by turn.

    All messages are numbered over all tasks and a chat's first number is taken off, so no chat is ranked in one task.
    """
    m = messages.select("message_id", "seed_index", "turn", role().alias("role"), "content").filter("seed_index is not null").dropDuplicates(["message_id"]).filter("role <> 'system'")
    return placed(m, ["seed_index"], ["turn", "message_id"]).drop("turn")


PLACED = f"p AS MATERIALIZED (SELECT message_id, seed_index, role, content, row_number() OVER (PARTITION BY seed_index ORDER BY turn, message_id) - 1 AS place FROM {MSG} WHERE role <> 'system' AND seed_index IS NOT NULL)"
SQL = f"""{PLACED}, c AS MATERIALIZED (SELECT * FROM {CONV}),
ok AS (SELECT *, CASE WHEN place % 2 = 0 THEN 'user' ELSE 'assistant' END = role AND trim(coalesce(content, '')) <> '' AS fine FROM p),
u AS (SELECT * FROM ok WHERE fine AND role = 'user'), a AS (SELECT ok.*, c.quality_policy.max_answer_words AS most, c.quality_policy.closing_offer_turn AS offer, c.grounding_mode, c.domain FROM ok JOIN c USING (seed_index) WHERE fine AND role = 'assistant'),
link AS (SELECT message_id, seed_index, place, unnest(regexp_extract_all(content, '{URL}')) AS url FROM a),
src AS (SELECT seed_index, unnest(from_json(sources, '[{{"url":"VARCHAR"}}]')).url AS url FROM c WHERE json_valid(sources)),
refs AS (SELECT DISTINCT unnest({T.shingles_sql('w', COPIED)}) AS gram FROM (SELECT {T.words_sql('assistant')} AS w FROM hybrid_references WHERE assistant IS NOT NULL)),
own AS (SELECT seed_index, place, unnest({T.shingles_sql('w', COPIED)}) AS gram FROM (SELECT seed_index, place, {T.words_sql('content')} AS w FROM a)),
{close_sql("SELECT message_id AS id, seed_index, content FROM ok WHERE fine AND role = 'assistant'", T.words_sql("content"), 5, 0.72, "seed_index")},
issues AS (SELECT seed_index, place, 'wrong role or blank' AS issue FROM ok WHERE NOT fine
UNION SELECT seed_index, place, 'first question changed' FROM u JOIN c USING (seed_index) WHERE place = 0 AND content IS DISTINCT FROM first_question
UNION SELECT seed_index, place, 'user too long' FROM u WHERE {T.word_count_sql('content')} > CASE WHEN place = 0 THEN {FIRST_WORDS} ELSE {LATER_WORDS} END
UNION SELECT x.seed_index, x.place, 'repeated question' FROM (SELECT seed_index, place, row_number() OVER (PARTITION BY seed_index, {T.normalized_sql('content')} ORDER BY place) AS r FROM u) x WHERE r > 1
UNION SELECT seed_index, place, 'answer too long' FROM a WHERE {T.word_count_sql('content')} > coalesce(most, {ANSWER_WORDS})
UNION SELECT seed_index, place, 'foreign link' FROM link l WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.seed_index = l.seed_index AND s.url = l.url)
UNION SELECT seed_index, place, 'no link' FROM a WHERE grounding_mode = 'grounded' AND NOT regexp_matches(content, '{URL}')
UNION SELECT seed_index, place, 'unplanned offer' FROM a WHERE place // 2 + 1 <> coalesce(offer, 0) AND regexp_matches(right(regexp_split_to_array(trim(content), '\\n\\s*\\n')[-1], 400), '{T.OFFER}')
UNION SELECT DISTINCT seed_index, place, 'copied reference' FROM own JOIN refs USING (gram)
UNION SELECT p.seed_index, p.place, 'repeated answer' FROM k JOIN z USING (rep) JOIN p ON p.message_id = k.id JOIN k o ON o.rep = z.other JOIN p b ON b.message_id = o.id WHERE b.place < p.place)"""


def message_issues_of(messages: DataFrame, conversations: DataFrame, references: DataFrame) -> DataFrame:
    """(seed_index, place, issue), each once. Messages of the wrong role or without text have that one issue only.

    Chats without a row of their own are checked by the rules that need none. Null addresses, policies and references add nothing.
    """
    c = conversations.select("seed_index", "first_question", "quality_policy", "sources", "grounding_mode")
    p = cut(placed_messages(messages))
    expected = F.when(F.col("place") % 2 == 0, "user").otherwise("assistant")
    fine = (F.col("role") == expected) & (F.trim(F.coalesce("content", F.lit(""))) != "")
    fine = F.coalesce(fine, F.lit(False))
    words = T.word_count(F.col("content"))

    def issue(df: DataFrame, name: str) -> DataFrame:
        return df.select("seed_index", "place", F.lit(name).alias("issue"))

    u = p.filter(fine & (F.col("role") == "user"))
    answers = p.filter(fine & (F.col("role") == "assistant"))
    a = answers.join(c, "seed_index")
    norm = u.select("seed_index", "place", T.normalized(F.col("content")).alias("norm"))
    first = norm.groupBy("seed_index", "norm").agg(F.min("place").alias("first"))
    links = a.select("seed_index", "place", F.explode(F.regexp_extract_all("content", F.lit(URL), F.lit(0))).alias("url"))
    sources = c.select("seed_index", F.explode(F.from_json("sources", "array<struct<url:string>>")).alias("s")).select("seed_index", F.col("s.url").alias("url"))
    grams = lambda df, col: T.with_shingles(df, F.col(col), COPIED, "grams").withColumn("gram", F.explode("grams"))
    theirs = grams(references.filter("assistant is not null"), "assistant").select("gram").distinct()
    own = T.with_hashed_runs(answers.select(F.col("message_id").alias("id"), "seed_index", "content"), F.col("content"), 5, "tokens", F.col("seed_index"))
    close = jaccard_classes(own.select("id", "tokens"), 0.72)
    at = close.members.join(answers.select(F.col("message_id").alias("id"), "seed_index", "place"), "id")
    earliest = at.groupBy("rep").agg(F.min("place").alias("first"))
    least = close.both_ways().join(earliest.toDF("other", "first"), "other").groupBy("rep").agg(F.min("first").alias("first"))
    found = [
        issue(p.filter(~fine), "wrong role or blank"),
        issue(u.filter("place = 0").join(c, "seed_index").filter(~F.col("content").eqNullSafe(F.col("first_question"))), "first question changed"),
        issue(u.filter(words > F.when(F.col("place") == 0, FIRST_WORDS).otherwise(LATER_WORDS)), "user too long"),
        issue(norm.join(first, ["seed_index", "norm"]).filter("place > first"), "repeated question"),
        issue(a.filter(words > F.coalesce("quality_policy.max_answer_words", F.lit(ANSWER_WORDS))), "answer too long"),
        issue(links.join(sources, ["seed_index", "url"], "left_anti"), "foreign link"),
        issue(a.filter((F.col("grounding_mode") == "grounded") & ~F.col("content").rlike(URL)), "no link"),
        issue(a.filter((F.floor(F.col("place") / 2) + 1 != F.coalesce("quality_policy.closing_offer_turn", F.lit(0))) & T.closing_offer(F.col("content"))), "unplanned offer"),
        issue(grams(a, "content").join(theirs, "gram", "left_semi"), "copied reference"),
        issue(at.join(least, "rep").filter("place > first"), "repeated answer"),
    ]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.distinct()


def project_issues(spark, sf) -> DataFrame:
    return message_issues_of(load(spark, sf, "messages"), latest(load(spark, sf, "conversations"), "seed_index"), load(spark, sf, "hybrid_references"))


@query("message_issues", f"WITH {SQL} SELECT seed_index, place, issue FROM issues")
def message_issues(spark, sf):
    """One row per message and issue."""
    return project_issues(spark, sf)


@query("screening_state", f"WITH {SQL}, n AS (SELECT seed_index, count(*) AS n FROM issues GROUP BY seed_index) SELECT screening_passed, coalesce(n, 0) = 0 AS clean, count(*) AS chats, coalesce(sum(n), 0)::bigint AS issues FROM c LEFT JOIN n USING (seed_index) GROUP BY ALL")
def screening_state(spark, sf):
    """Chats by their stored verdict and by what the checks say now."""
    n = project_issues(spark, sf).groupBy("seed_index").agg(F.count("*").alias("n"))
    c = latest(load(spark, sf, "conversations"), "seed_index").select("seed_index", "screening_passed").join(n, "seed_index", "left")
    return c.groupBy("screening_passed", (F.coalesce("n", F.lit(0)) == 0).alias("clean")).agg(F.count("*").alias("chats"), F.coalesce(F.sum("n"), F.lit(0)).alias("issues"))


@query(
    "chat_audit",
    f"WITH {PLACED} SELECT p.seed_index, count(*) AS messages, bool_and(role = CASE WHEN place % 2 = 0 THEN 'user' ELSE 'assistant' END) AS alternates, count(*) = 2 * any_value(c.max_exchanges) AS right_length, max({T.word_count_sql('content')}) AS longest FROM p JOIN {CONV} c ON c.seed_index = p.seed_index GROUP BY p.seed_index",
)
def chat_audit(spark, sf):
    """Length, alternation and longest message of each chat."""
    p = placed_messages(load(spark, sf, "messages"))
    right = F.col("role") == F.when(F.col("place") % 2 == 0, "user").otherwise("assistant")
    t = p.groupBy("seed_index").agg(F.count("*").alias("messages"), F.every(right).alias("alternates"), F.max(T.word_count(F.col("content"))).alias("longest"))
    c = latest(load(spark, sf, "conversations").select("seed_index", "max_exchanges", "ingested_at"), "seed_index")
    return t.join(c, "seed_index").select("seed_index", "messages", "alternates", (F.col("messages") == 2 * F.col("max_exchanges")).alias("right_length"), "longest")


@query(
    "training_examples",
    f"WITH {PLACED}, s AS (SELECT seed_index, place, role, length(content) AS chars, sum(length(coalesce(content, ''))) OVER (PARTITION BY seed_index ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM p) SELECT seed_index, place AS context_messages, before::bigint AS context_chars, chars AS target_chars FROM s WHERE role = 'assistant' AND place > 0 AND chars > 0",
)
def training_examples(spark, sf):
    """One training example per answer: how much of its chat stands before it, and its own length.

    Running sums come from prefix sums over all tasks, less what stands before the chat.
    """
    p = placed_messages(load(spark, sf, "messages")).select("seed_index", "place", "role", F.length(F.coalesce("content", F.lit(""))).alias("chars"))
    x = prefix_sums(p, ["seed_index", "place"], "chars", "before")
    first = x.filter("place = 0").select("seed_index", F.col("before").alias("base"))
    return x.filter("role = 'assistant' and place > 0 and chars > 0").join(first, "seed_index").select("seed_index", F.col("place").alias("context_messages"), (F.col("before") - F.col("base")).alias("context_chars"), F.col("chars").alias("target_chars"))


def prefix_sums(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """The sum of a value over all rows before each one in a total order, spread over tasks like ``numbered``."""
    from pyspark.sql import Window

    spread = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    whole = spread.groupBy("_part").agg(F.sum(value).alias("_sum"))
    # as many rows as partitions
    earlier = whole.select("_part", F.coalesce(F.sum("_sum").over(Window.partitionBy().orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inner = F.coalesce(F.sum(value).over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return spread.withColumn("_inner", inner).join(F.broadcast(earlier), "_part").withColumn(name, F.col("_inner") + F.col("_before")).drop("_part", "_inner", "_before")


@query("repair_contract", f"WITH m AS (SELECT seed_index, turn, role, content FROM {MSG}), r AS (SELECT seed_index, turn, role, CASE WHEN role = 'assistant' THEN regexp_replace(content, '[ \\t]+', ' ', 'g') ELSE trim(content) END AS content FROM m WHERE trim(coalesce(content, '')) <> '') SELECT m.seed_index, count(*) AS n, count(*) FILTER (r.role IS NULL) AS lost, count(*) FILTER (m.role = 'user' AND r.role IS NOT NULL AND m.content IS DISTINCT FROM r.content) AS protected_changes, count(*) FILTER (r.role IS NOT NULL AND m.content IS DISTINCT FROM r.content) AS changes FROM m LEFT JOIN r USING (seed_index, turn, role) GROUP BY m.seed_index")
def repair_contract(spark, sf):
    """A repair closes up blanks in answers, drops blank messages and trims user turns: what was lost, changed, and changed against the rule that user turns stay."""
    m = load(spark, sf, "messages").select("message_id", "seed_index", "turn", role().alias("role"), "content").dropDuplicates(["message_id"])
    repaired = F.when(F.col("role") == "assistant", F.regexp_replace("content", r"[ \t]+", " ")).otherwise(F.trim("content"))
    r = m.filter(F.trim(F.coalesce("content", F.lit(""))) != "").select("seed_index", "turn", "role", repaired.alias("repaired"), F.lit(True).alias("there"))
    return repair_violations(m, r)


def repair_violations(original: DataFrame, repaired: DataFrame) -> DataFrame:
    """(seed_index, turn, role, content) and (seed_index, turn, role, repaired, there) -> per chat what was compared, lost, changed, and changed in user turns."""
    there = F.coalesce("there", F.lit(False))
    changed = there & ~F.col("content").eqNullSafe(F.col("repaired"))
    return original.join(repaired, ["seed_index", "turn", "role"], "left").groupBy("seed_index").agg(F.count("*").alias("n"), F.count_if(~there).alias("lost"), F.count_if(changed & (F.col("role") == "user")).alias("protected_changes"), F.count_if(changed).alias("changes"))


@query("replaced_answers", f"WITH r AS (SELECT domain, arg_min(assistant, id) AS reference FROM hybrid_references WHERE assistant <> '' AND domain IS NOT NULL GROUP BY domain) SELECT message_id, role, CASE WHEN role = 'assistant' THEN coalesce(reference, content) ELSE content END IS DISTINCT FROM content AS replaced, length(CASE WHEN role = 'assistant' THEN coalesce(reference, content) ELSE content END) AS chars FROM {MSG} m LEFT JOIN r USING (domain)")
def replaced_answers(spark, sf):
    """Answers give way to the reference of their domain; other messages stay."""
    m = load(spark, sf, "messages").select("message_id", role().alias("role"), "content", "domain").dropDuplicates(["message_id"])
    r = load(spark, sf, "hybrid_references").filter("assistant <> '' and domain is not null").groupBy("domain").agg(F.min_by("assistant", "id").alias("reference"))
    new = F.when(F.col("role") == "assistant", F.coalesce("reference", "content")).otherwise(F.col("content"))
    return m.join(r, "domain", "left").select("message_id", "role", (~new.eqNullSafe(F.col("content"))).alias("replaced"), F.length(new).alias("chars"))
