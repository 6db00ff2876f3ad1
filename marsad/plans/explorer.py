"""The dataset explorer: rows, filters, pages, summaries and annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marsad.functions import text as T
from marsad.plans.catalog import query
from marsad.tables import latest, load, role

MSG = "(SELECT message_id, any_value(seed_index) AS seed_index, any_value(turn) AS turn, lower(trim(any_value(role))) AS role, any_value(content) AS content, any_value(domain) AS domain FROM messages GROUP BY message_id)"
CONV = "(SELECT * FROM conversations QUALIFY row_number() OVER (PARTITION BY seed_index ORDER BY ingested_at DESC) = 1)"
ROWS = f"""SELECT seed_index, coalesce(arg_min(content, turn) FILTER (role = 'user' AND content IS NOT NULL), '') AS request, coalesce(min(domain), 'general') AS domain,
count(*) FILTER (role = 'assistant') AS exchanges, coalesce(sum({T.word_count_sql('content')}) FILTER (role = 'assistant'), 0)::bigint AS words,
coalesce(max({T.word_count_sql('content')}) FILTER (role = 'assistant'), 0) AS max_reply_words FROM {MSG} WHERE seed_index IS NOT NULL GROUP BY seed_index"""


def conversation_rows(messages: DataFrame) -> DataFrame:
    """One row per chat: first request, domain, answers, words in answers, longest answer.

    Repeated deliveries count once; a chat without a user has an empty request, one without answers 0 words.
    """
    m = messages.select("message_id", "seed_index", "turn", role().alias("role"), "content", "domain").dropDuplicates(["message_id"]).filter("seed_index is not null")
    n, answer = T.word_count(F.col("content")), F.col("role") == "assistant"
    return m.groupBy("seed_index").agg(
        F.coalesce(F.min_by("content", F.when((F.col("role") == "user") & F.col("content").isNotNull(), F.col("turn"))), F.lit("")).alias("request"),
        F.coalesce(F.min("domain"), F.lit("general")).alias("domain"),
        F.count_if(answer).alias("exchanges"),
        F.coalesce(F.sum(F.when(answer, n)), F.lit(0)).alias("words"),
        F.coalesce(F.max(F.when(answer, n)), F.lit(0)).alias("max_reply_words"),
    )


def page(rows: DataFrame, search: str = "", domain: str = "all", status: str = "all", order: str = "dataset", number: int = 0, size: int = 100) -> DataFrame:
    """Filter, sort and cut one page; ``filtered`` is the number of rows that pass the filter.

    The search is for a part of request, scenario and domain, without case; status is pass, flagged or
    all, a missing verdict being neither.
    """
    hay = F.lower(F.concat_ws(" ", "request", "scenario", "domain"))
    keep: Column = hay.contains(search.lower())
    if domain != "all":
        keep = keep & (F.col("domain") == domain)
    if status != "all":
        keep = keep & F.col("screening_passed").eqNullSafe(status == "pass")
    found = rows.filter(keep)
    total = found.agg(F.count("*").alias("filtered"))
    sort = {"dataset": [F.col("seed_index")], "longest": [F.desc("max_reply_words"), F.col("seed_index")], "shortest": [F.asc("max_reply_words"), F.col("seed_index")]}[order]
    return found.orderBy(*sort).offset(max(0, number) * size).limit(size).join(F.broadcast(total))


@query("conversation_index", ROWS)
def conversation_index(spark, sf):
    return conversation_rows(load(spark, sf, "messages"))


@query(
    "explorer_page",
    f"""WITH r AS (SELECT r.*, s.scenario, c.screening_passed FROM ({ROWS}) r LEFT JOIN (SELECT seed_index, scenario FROM seed_pool QUALIFY row_number() OVER (PARTITION BY seed_index ORDER BY ingested_at DESC) = 1) s USING (seed_index) LEFT JOIN {CONV} c USING (seed_index)),
    f AS (SELECT * FROM r WHERE contains(lower(concat_ws(' ', request, scenario, domain)), 'the') AND screening_passed) SELECT *, (SELECT count(*) FROM f) AS filtered FROM f ORDER BY max_reply_words DESC, seed_index LIMIT 100 OFFSET 0""",
)
def explorer_page(spark, sf):
    s = latest(load(spark, sf, "seed_pool").select("seed_index", "scenario", "ingested_at"), "seed_index").drop("ingested_at")
    c = latest(load(spark, sf, "conversations").select("seed_index", "screening_passed", "ingested_at"), "seed_index").drop("ingested_at")
    rows = conversation_rows(load(spark, sf, "messages")).join(s, "seed_index", "left").join(c, "seed_index", "left")
    return page(rows, "the", status="pass", order="longest", number=-1)


@query(
    "explorer_summary",
    f"""SELECT count(*) AS n, count(*) FILTER (screening_passed) AS passed, count(*) FILTER (NOT screening_passed) AS flagged, count(*) FILTER (screening_passed IS NULL) AS unknown,
    median({T.word_count_sql('first_question')}) AS median_words, arg_max(recipe_version, seed_index) FILTER (recipe_version IS NOT NULL) AS last_recipe FROM {CONV}""",
)
def explorer_summary(spark, sf):
    c = latest(load(spark, sf, "conversations"), "seed_index")
    ok = F.col("screening_passed")
    return c.agg(
        F.count("*").alias("n"), F.count_if(ok.eqNullSafe(True)).alias("passed"), F.count_if(ok.eqNullSafe(False)).alias("flagged"), F.count_if(ok.isNull()).alias("unknown"),
        F.median(T.word_count(F.col("first_question"))).alias("median_words"), F.max_by("recipe_version", F.when(F.col("recipe_version").isNotNull(), F.col("seed_index"))).alias("last_recipe"),
    )


@query("domain_counts", f"SELECT coalesce(domain, 'general') AS domain, coalesce(grounding_mode, 'none') AS grounding, count(*) AS n, count(*) FILTER (screening_passed) AS passed FROM {CONV} GROUP BY ALL")
def domain_counts(spark, sf):
    c = latest(load(spark, sf, "conversations"), "seed_index")
    return c.groupBy(F.coalesce("domain", F.lit("general")).alias("domain"), F.coalesce("grounding_mode", F.lit("none")).alias("grounding")).agg(F.count("*").alias("n"), F.count_if(F.col("screening_passed").eqNullSafe(True)).alias("passed"))


@query("reply_length_describe", f"SELECT role, count(*) AS n, median({T.word_count_sql('content')}) AS median, round_even(avg({T.word_count_sql('content')}), 1) AS mean, min({T.word_count_sql('content')}) AS min, max({T.word_count_sql('content')}) AS max FROM {MSG} WHERE content IS NOT NULL GROUP BY role")
def reply_length_describe(spark, sf):
    """Number, median, mean, least and most words by role; the median is exact."""
    m = load(spark, sf, "messages").filter("content is not null").select("message_id", role().alias("role"), T.word_count(F.col("content")).alias("w")).dropDuplicates(["message_id"])
    # the exact median works on counts of lengths, which are few however many rows a role has
    counts = m.groupBy("role", "w").agg(F.count("*").alias("f"))
    return counts.groupBy("role").agg(F.sum("f").alias("n"), F.percentile("w", 0.5, F.col("f")).alias("median"), F.bround(F.sum(F.col("w") * F.col("f")) / F.sum("f"), 1).alias("mean"), F.min("w").alias("min"), F.max("w").alias("max"))


@query("annotation_merge", "SELECT doc_id, labeller, arg_max(subject, (labelled_at, subject)) AS subject, max(labelled_at) AS labelled_at, count(*) AS versions FROM subject_labels GROUP BY doc_id, labeller")
def annotation_merge(spark, sf):
    """The last write of each (document, labeller) wins; equal times fall to the larger subject."""
    return load(spark, sf, "subject_labels").groupBy("doc_id", "labeller").agg(F.max_by("subject", F.struct("labelled_at", "subject")).alias("subject"), F.max("labelled_at").alias("labelled_at"), F.count("*").alias("versions"))


@query(
    "annotation_agreement",
    """WITH m AS (SELECT doc_id, labeller, arg_max(subject, (labelled_at, subject)) AS subject FROM subject_labels GROUP BY ALL),
    d AS (SELECT doc_id, count(DISTINCT subject) AS subjects, count(*) AS labellers FROM m GROUP BY doc_id)
    SELECT labellers, count(*) AS documents, count(*) FILTER (subjects = 1) AS agreed, (SELECT count(DISTINCT doc_id) FROM subject_labels l WHERE NOT EXISTS (SELECT 1 FROM subject_areas a WHERE a.subject = l.subject)) AS invalid FROM d GROUP BY labellers""",
)
def annotation_agreement(spark, sf):
    l = load(spark, sf, "subject_labels")
    m = l.groupBy("doc_id", "labeller").agg(F.max_by("subject", F.struct("labelled_at", "subject")).alias("subject"))
    d = m.groupBy("doc_id").agg(F.count_distinct("subject").alias("subjects"), F.count("*").alias("labellers"))
    invalid = l.join(load(spark, sf, "subject_areas"), "subject", "left_anti").agg(F.count_distinct("doc_id").alias("invalid"))
    return d.groupBy("labellers").agg(F.count("*").alias("documents"), F.count_if(F.col("subjects") == 1).alias("agreed")).join(F.broadcast(invalid))


@query(
    "approved_documents",
    """WITH v AS (SELECT doc_id, bool_and(subject IN (SELECT subject FROM subject_areas)) AS all_known, count(DISTINCT labeller) AS labellers FROM subject_labels GROUP BY doc_id)
    SELECT reason, count(*) AS n FROM (SELECT CASE WHEN d.text IS NULL OR d.text = '' THEN 'empty' WHEN d.family_id IS NULL THEN 'no family' WHEN v.doc_id IS NULL THEN 'no label' WHEN NOT v.all_known THEN 'bad label' WHEN v.labellers < 2 THEN 'one labeller' ELSE 'approved' END AS reason FROM documents d LEFT JOIN v USING (doc_id)) GROUP BY reason""",
)
def approved_documents(spark, sf):
    """The first reason that keeps a document out, counted."""
    l = load(spark, sf, "subject_labels").join(load(spark, sf, "subject_areas").select("subject", F.lit(True).alias("known")), "subject", "left")
    v = l.groupBy("doc_id").agg(F.every(F.coalesce("known", F.lit(False))).alias("all_known"), F.count_distinct("labeller").alias("labellers"))
    reason = (
        F.when(F.col("text").isNull() | (F.col("text") == ""), "empty").when(F.col("family_id").isNull(), "no family").when(F.col("labellers").isNull(), "no label")
        .when(~F.col("all_known"), "bad label").when(F.col("labellers") < 2, "one labeller").otherwise("approved")
    )
    return load(spark, sf, "documents").join(v, "doc_id", "left").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query("opaque_sources", "SELECT seed_index, json_extract_string(sources, '$[0].url') AS first_url, coalesce(json_array_length(sources), 0)::int AS n_sources FROM " + CONV + " WHERE json_valid(sources)")
def opaque_sources(spark, sf):
    """First address and number of sources out of a JSON string; rows that don't parse stay out."""
    c = latest(load(spark, sf, "conversations"), "seed_index").withColumn("s", F.from_json("sources", "array<struct<url:string>>"))
    return c.filter("s is not null").select("seed_index", F.try_element_at("s", F.lit(1))["url"].alias("first_url"), F.size("s").alias("n_sources"))
