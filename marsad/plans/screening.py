"""Mechanical checks of chats and turns, gathered as issue lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from marsad.functions import text as T
from marsad.operators.ordering import placed
from marsad.plans.catalog import query
from marsad.plans.explorer import CONV, MSG
from marsad.tables import latest, load, role


def turns(spark, sf):
    return load(spark, sf, "messages").select("message_id", "seed_index", "turn", role().alias("role"), "content", "domain").dropDuplicates(["message_id"])


URLS = r"https?://[^\s)\]>]+"


@query(
    "conversation_checks",
    f"""WITH m AS (SELECT * FROM {MSG}), t AS (SELECT seed_index, count(*) FILTER (role = 'user') AS users, count(*) FILTER (role = 'assistant') AS answers,
      count(*) FILTER (role = 'assistant' AND (content IS NULL OR trim(content) = '')) AS blank, coalesce(max({T.word_count_sql('content')}) FILTER (role = 'user'), 0) AS user_words,
      coalesce(max({T.word_count_sql('content')}) FILTER (role = 'assistant'), 0) AS answer_words, coalesce(bool_or(contains(content, '{T.GREETING}')) FILTER (role = 'assistant'), false) AS greets,
      coalesce(bool_or(regexp_matches(content, '{URLS}')) FILTER (role = 'assistant'), false) AS cites, arg_min(content, turn) FILTER (role = 'user' AND content IS NOT NULL) AS starter FROM m GROUP BY seed_index),
    x AS (SELECT c.seed_index, list_filter([CASE WHEN users <> answers THEN 'unequal turns' END, CASE WHEN answers <> max_exchanges THEN 'wrong number of exchanges' END, CASE WHEN blank > 0 THEN 'blank answer' END,
      CASE WHEN user_words > 24 THEN 'long user turn' END, CASE WHEN answer_words > coalesce(quality_policy.max_answer_words, 1000) THEN 'long answer' END, CASE WHEN greets THEN 'greeting' END,
      CASE WHEN cites AND coalesce(json_array_length(CASE WHEN json_valid(sources) THEN sources END), 0) = 0 THEN 'unknown source' END, CASE WHEN starter IS DISTINCT FROM first_question THEN 'changed starter' END], lambda i: i IS NOT NULL) AS issues
      FROM {CONV} c JOIN t USING (seed_index))
    SELECT seed_index, array_to_string(issues, '; ') AS issues, len(issues) AS n_issues FROM x""",
)
def conversation_checks(spark, sf):
    """One row per chat with its issues in a fixed order; none means that it passes."""
    m = turns(spark, sf)
    user, answer = F.col("role") == "user", F.col("role") == "assistant"
    n = T.word_count(F.col("content"))
    t = m.groupBy("seed_index").agg(
        F.count_if(user).alias("users"), F.count_if(answer).alias("answers"), F.count_if(answer & (F.coalesce(F.trim("content"), F.lit("")) == "")).alias("blank"),
        F.coalesce(F.max(F.when(user, n)), F.lit(0)).alias("user_words"), F.coalesce(F.max(F.when(answer, n)), F.lit(0)).alias("answer_words"),
        F.coalesce(F.some(F.when(answer, F.col("content").contains(T.GREETING))), F.lit(False)).alias("greets"), F.coalesce(F.some(F.when(answer, F.col("content").rlike(URLS))), F.lit(False)).alias("cites"),
        F.min_by("content", F.when(user & F.col("content").isNotNull(), F.col("turn"))).alias("starter"),
    )
    c = latest(load(spark, sf, "conversations"), "seed_index").withColumn("n_sources", F.coalesce(F.size(F.from_json("sources", "array<struct<url:string>>")), F.lit(0)))
    checks = [
        (F.col("users") != F.col("answers"), "unequal turns"), (F.col("answers") != F.col("max_exchanges"), "wrong number of exchanges"), (F.col("blank") > 0, "blank answer"),
        (F.col("user_words") > 24, "long user turn"), (F.col("answer_words") > F.coalesce("quality_policy.max_answer_words", F.lit(1000)), "long answer"), (F.col("greets"), "greeting"),
        (F.col("cites") & (F.col("n_sources") <= 0), "unknown source"), (~F.col("starter").eqNullSafe(F.col("first_question")), "changed starter"),
    ]
    issues = F.filter(F.array(*(F.when(test, F.lit(name)) for test, name in checks)), lambda i: i.isNotNull())
    return c.join(t, "seed_index").select("seed_index", F.array_join(issues, "; ").alias("issues"), F.size(issues).alias("n_issues"))


@query("issue_counts", "SELECT issue, count(*) AS n FROM (SELECT unnest(['blank', 'links', 'markdown', 'long']) AS issue, unnest([content IS NULL OR trim(content) = '', regexp_matches(content, 'https?://'), regexp_matches(content, '" + T.MARKDOWN + f"'), {T.word_count_sql('content')} > 60]) AS hit FROM {MSG} WHERE role = 'assistant') WHERE hit GROUP BY issue")
def issue_counts(spark, sf):
    """How many answers are blank, hold links or markdown, or are long."""
    m = turns(spark, sf).filter("role = 'assistant'")
    c = F.col("content")
    found = F.array(F.when(c.isNull() | (F.trim(c) == ""), F.lit("blank")), F.when(c.rlike("https?://"), F.lit("links")), F.when(c.rlike(T.MARKDOWN), F.lit("markdown")), F.when(T.word_count(c) > 60, F.lit("long")))
    return m.select(F.explode(F.filter(found, lambda i: i.isNotNull())).alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))


@query(
    "alternation_violations",
    f"""WITH m AS (SELECT seed_index, turn, role FROM {MSG} WHERE role <> 'system' AND trim(coalesce(content, '')) <> ''), p AS (SELECT seed_index, turn, role, lag(role) OVER (PARTITION BY seed_index ORDER BY turn) AS before FROM m)
    SELECT seed_index, count(*) AS n FROM p WHERE seed_index IS NOT NULL AND (role = before OR (before IS NULL AND role <> 'user')) GROUP BY seed_index""",
)
def alternation_violations(spark, sf):
    """Chats in which, among messages with text, a role follows itself, or which an assistant begins.

    Messages are numbered over all tasks, and neighbours meet in an equi-join on the number before, so no window runs over a long chat.
    """
    m = turns(spark, sf).filter("role <> 'system' and seed_index is not null").filter(F.trim(F.coalesce("content", F.lit(""))) != "")
    p = placed(m.select("seed_index", "turn", "role"), ["seed_index"], ["turn"])
    before = p.select("seed_index", (F.col("place") + 1).alias("place"), F.col("role").alias("before"))
    bad = (F.col("role") == F.col("before")) | (F.col("before").isNull() & (F.col("role") != "user"))
    return p.join(before, ["seed_index", "place"], "left").filter(bad).groupBy("seed_index").agg(F.count("*").alias("n"))


@query("duplicate_user_turns", f"SELECT message_id FROM (SELECT message_id, row_number() OVER (PARTITION BY seed_index, {T.normalized_sql('content')} ORDER BY turn, message_id) AS r FROM {MSG} WHERE role = 'user' AND content IS NOT NULL) WHERE r > 1")
def duplicate_user_turns(spark, sf):
    """User turns that repeat an earlier one of their chat."""
    m = turns(spark, sf).filter("role = 'user' and content is not null").select("message_id", "seed_index", "turn", T.normalized(F.col("content")).alias("norm"))
    first = m.groupBy("seed_index", "norm").agg(F.min(F.struct("turn", "message_id")).alias("f"), F.count("*").alias("n")).filter("n > 1")
    return m.join(first, ["seed_index", "norm"]).filter("message_id <> f.message_id").select("message_id")


@query("closing_offers", f"SELECT message_id FROM {MSG} WHERE role = 'assistant' AND content IS NOT NULL AND regexp_matches(right(regexp_split_to_array(trim(content), '\\n\\s*\\n')[-1], 400), '{T.OFFER}')")
def closing_offers(spark, sf):
    return turns(spark, sf).filter("role = 'assistant' and content is not null").filter(T.closing_offer(F.col("content"))).select("message_id")


@query(
    "dangling_questions",
    f"SELECT seed_index, question FROM (SELECT * FROM seed_pool QUALIFY row_number() OVER (PARTITION BY seed_index ORDER BY ingested_at DESC) = 1) WHERE regexp_matches(question, '^(هل|متى|Does |When )') AND seed_index NOT IN (SELECT seed_index FROM conversations)",
)
def dangling_questions(spark, sf):
    """Seeds with a given opening that no chat has taken up."""
    s = latest(load(spark, sf, "seed_pool"), "seed_index").filter(F.col("question").rlike("^(هل|متى|Does |When )"))
    return s.join(load(spark, sf, "conversations").select("seed_index"), "seed_index", "left_anti").select("seed_index", "question")


@query(
    "pending_context_screen",
    f"""SELECT c.seed_index, coalesce(c.screening_passed, true) AND r.review_status IS DISTINCT FROM 'rejected' AS keep FROM {CONV} c
    LEFT JOIN (SELECT domain, max(review_status) AS review_status FROM hybrid_references GROUP BY domain) r ON r.domain = c.domain""",
)
def pending_context_screen(spark, sf):
    """Verdicts flip a chat's flag; a missing verdict or flag keeps it."""
    r = load(spark, sf, "hybrid_references").groupBy("domain").agg(F.max("review_status").alias("review_status"))
    c = latest(load(spark, sf, "conversations"), "seed_index")
    return c.join(r, "domain", "left").select("seed_index", (F.coalesce("screening_passed", F.lit(True)) & ~F.col("review_status").eqNullSafe("rejected")).alias("keep"))


@query("record_fingerprints", f"SELECT seed_index, count(*) AS n, sum(('0x' || substr(sha256(coalesce(turn::varchar, '') || chr(31) || role || chr(31) || coalesce(content, '')), 1, 12))::bigint)::bigint AS fingerprint FROM {MSG} WHERE seed_index IS NOT NULL GROUP BY seed_index")
def record_fingerprints(spark, sf):
    """A fingerprint of each chat: the sum of 48 bits of the hash of every turn, so no chat is gathered in one place."""
    m = turns(spark, sf).filter("seed_index is not null")
    sha = T.digest(F.concat(F.coalesce(F.col("turn").cast("string"), F.lit("")), F.lit("\x1f"), "role", F.lit("\x1f"), F.coalesce("content", F.lit(""))))
    return m.groupBy("seed_index").agg(F.count("*").alias("n"), F.sum(F.conv(F.substring(sha, 1, 12), 16, 10).cast("long")).alias("fingerprint"))
