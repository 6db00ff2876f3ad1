"""Summaries, describes, annotations by fingerprint and input integrity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marsad.functions import text as T
from marsad.plans.catalog import query
from marsad.plans.explorer import CONV, MSG
from marsad.plans.records import PAGES
from marsad.tables import latest, load, role

COUNTERS = ("domain", "grounding_mode", "max_exchanges", "recipe_version", "family_id")


@query("batch_summary", "WITH c AS (SELECT * FROM " + CONV + "), v AS (" + " UNION ALL ".join(f"SELECT '{x}' AS counter, coalesce({x}::varchar, '(none)') AS value, screening_passed, json_valid(sources) AS sound FROM c" for x in COUNTERS) + ") SELECT counter, value, count(*) AS n, count(*) FILTER (screening_passed) AS passed, count(*) FILTER (screening_passed = false) AS flagged, count(*) FILTER (NOT coalesce(sound, false)) AS malformed FROM v GROUP BY ALL")
def batch_summary(spark, sf):
    """One long table of all counters of a batch: chats, passed, flagged, and those whose sources don't parse."""
    c = latest(load(spark, sf, "conversations"), "seed_index")
    sound = F.from_json("sources", "array<struct<url:string>>").isNotNull()
    values = F.explode(F.array(*(F.struct(F.lit(x).alias("counter"), F.coalesce(F.col(x).cast("string"), F.lit("(none)")).alias("value")) for x in COUNTERS)))
    v = c.select(values.alias("v"), "screening_passed", sound.alias("sound")).select("v.*", "screening_passed", "sound")
    return v.groupBy("counter", "value").agg(F.count("*").alias("n"), F.count_if(F.col("screening_passed").eqNullSafe(True)).alias("passed"), F.count_if(F.col("screening_passed").eqNullSafe(False)).alias("flagged"), F.count_if(~F.col("sound")).alias("malformed"))


def describe(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Number, exact median, mean to one place, least and most of a whole number by group.

    Works on counts of values, which are few however many rows a group has.
    """
    counts = df.groupBy(*by, value).agg(F.count("*").alias("_f"))
    v, f = F.col(value), F.col("_f")
    return counts.groupBy(*by).agg(F.sum("_f").alias("n"), F.percentile(value, 0.5, f).alias("median"), F.bround(F.sum(v * f) / F.sum("_f"), 1).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"))


VARIANTS = f"""m AS (SELECT seed_index, turn, role, {T.word_count_sql('content')} AS w FROM {MSG} WHERE content IS NOT NULL AND role IN ('user', 'assistant') AND seed_index IS NOT NULL),
f AS (SELECT seed_index, role, min(turn) AS first FROM m GROUP BY ALL), x AS (SELECT CASE WHEN turn = first AND role = 'user' THEN 'first user' WHEN turn = first THEN 'first answer' WHEN role = 'user' THEN 'later user' ELSE 'later answer' END AS variant, w FROM m JOIN f USING (seed_index, role))"""


@query("word_lengths_by_variant", f"WITH {VARIANTS} SELECT variant, count(*) AS n, median(w) AS median, round_even(avg(w), 1) AS mean, min(w) AS min, max(w) AS max FROM x GROUP BY variant")
def word_lengths_by_variant(spark, sf):
    """Word lengths of first and later questions and answers."""
    m = load(spark, sf, "messages").filter("content is not null and seed_index is not null").select("message_id", "seed_index", "turn", role().alias("role"), T.word_count(F.col("content")).alias("w")).dropDuplicates(["message_id"]).filter("role in ('user', 'assistant')")
    first = m.groupBy("seed_index", "role").agg(F.min("turn").alias("first"))
    at = F.col("turn") == F.col("first")
    user = F.col("role") == "user"
    variant = F.when(at & user, "first user").when(at, "first answer").when(user, "later user").otherwise("later answer")
    return describe(m.join(first, ["seed_index", "role"]).select(variant.alias("variant"), "w"), ["variant"], "w")


@query("preparation_summary", f"WITH p AS (SELECT topic_id, count(*) FILTER (fetch_error IS NULL AND page_text IS NOT NULL) AS usable FROM {PAGES} GROUP BY topic_id) SELECT count(*) AS topics, count(DISTINCT topic_id) FILTER (usable > 0) AS usable_topics, count(DISTINCT domain) AS categories, count(*) FILTER (coalesce(usable, 0) = 0) AS failed, min(topic_id) FILTER (coalesce(usable, 0) = 0) AS first_failed FROM topics LEFT JOIN p USING (topic_id)")
def preparation_summary(spark, sf):
    """Topics, those with a usable page, their categories, and those without."""
    usable = latest(load(spark, sf, "evidence_pages"), "page_id").groupBy("topic_id").agg(F.count_if(F.col("fetch_error").isNull() & F.col("page_text").isNotNull()).alias("usable"))
    t = load(spark, sf, "topics").join(usable, "topic_id", "left").withColumn("ok", F.coalesce("usable", F.lit(0)) > 0)
    return t.agg(F.count("*").alias("topics"), F.count_distinct(F.when(F.col("ok"), F.col("topic_id"))).alias("usable_topics"), F.count_distinct("domain").alias("categories"), F.count_if(~F.col("ok")).alias("failed"), F.min(F.when(~F.col("ok"), F.col("topic_id"))).alias("first_failed"))


@query("research_calls", f"SELECT t.domain, count(*) AS requests, count(*) FILTER (p.fetch_error IS NOT NULL) AS failed, count(DISTINCT p.url) AS addresses, sum(CASE WHEN p.page_text IS NULL THEN 0 ELSE length(p.page_text) END)::bigint AS chars FROM {PAGES} p JOIN topics t USING (topic_id) GROUP BY t.domain")
def research_calls(spark, sf):
    """Requests for pages by domain: how many, failed, to how many addresses, and what they brought."""
    p = latest(load(spark, sf, "evidence_pages"), "page_id").select("topic_id", "url", "fetch_error", F.coalesce(F.length("page_text"), F.lit(0)).alias("chars"))
    t = load(spark, sf, "topics").select("topic_id", "domain")
    return p.join(t, "topic_id").groupBy("domain").agg(F.count("*").alias("requests"), F.count_if(F.col("fetch_error").isNotNull()).alias("failed"), F.count_distinct("url").alias("addresses"), F.sum("chars").alias("chars"))


@query("selection_counts", "SELECT review_status, edited, role, count(*) AS n FROM hybrid_references GROUP BY ALL")
def selection_counts(spark, sf):
    """References by verdict, whether they were edited, and role."""
    return load(spark, sf, "hybrid_references").groupBy("review_status", "edited", "role").agg(F.count("*").alias("n"))


GROUPS = {"purchase": "accuracy", "view": "efficiency"}


@query("metric_group_means", "WITH g AS (SELECT CASE event_type WHEN 'purchase' THEN 'accuracy' WHEN 'view' THEN 'efficiency' ELSE 'general' END AS metric_group, event_type, avg(value) AS v FROM events WHERE value IS NOT NULL AND isfinite(value) GROUP BY ALL) SELECT metric_group, count(*) AS metrics, round(avg(v), 6) AS mean FROM g GROUP BY metric_group")
def metric_group_means(spark, sf):
    """The mean of each group of metrics over its metrics' means."""
    e = load(spark, sf, "events").filter(F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < F.lit(float("inf"))))
    group = F.coalesce(F.create_map(*(F.lit(x) for pair in GROUPS.items() for x in pair))[F.col("event_type")], F.lit("general"))
    per = e.groupBy(group.alias("metric_group"), "event_type").agg(F.avg("value").alias("v"))
    return per.groupBy("metric_group").agg(F.count("*").alias("metrics"), F.round(F.avg("v"), 6).alias("mean"))


@query("annotation_by_fingerprint", "WITH d AS (SELECT doc_id, sha256(text) AS fingerprint FROM documents WHERE text <> ''), l AS (SELECT d.fingerprint, l.labeller, l.subject FROM d JOIN subject_labels l USING (doc_id)) SELECT d.fingerprint, count(DISTINCT d.doc_id) AS documents, any_value(a.labels) AS labels, any_value(a.by_people) AS by_people, any_value(a.agreed) AS agreed FROM d JOIN (SELECT fingerprint, count(*) AS labels, bool_or(labeller <> 'auto') AS by_people, min(subject) = max(subject) AS agreed FROM l GROUP BY fingerprint) a USING (fingerprint) GROUP BY d.fingerprint")
def annotation_by_fingerprint(spark, sf):
    """Labels meet documents by the fingerprint of the text, so copies share them: any by people, and whether all agree."""
    d = load(spark, sf, "documents").filter("text <> ''").select("doc_id", T.digest(F.col("text")).alias("fingerprint"))
    a = d.join(load(spark, sf, "subject_labels"), "doc_id").groupBy("fingerprint").agg(F.count("*").alias("labels"), F.some(F.col("labeller") != "auto").alias("by_people"), (F.min("subject") == F.max("subject")).alias("agreed"))
    return d.groupBy("fingerprint").agg(F.count_distinct("doc_id").alias("documents")).join(a, "fingerprint")


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds, else 'valid'."""
    out = None
    for name, test in rules:
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("valid")


@query("reference_validation", "SELECT CASE WHEN source_row_sha256 IS NULL OR NOT regexp_matches(source_row_sha256, '^[a-f0-9]{64}$') THEN 'bad hash' WHEN role IS NULL THEN 'no role' WHEN user_message IS NULL OR trim(user_message) = '' THEN 'no prompt' WHEN assistant IS NULL OR trim(assistant) = '' THEN 'no reply' WHEN row_index IS NULL OR row_index < 0 THEN 'bad row' ELSE 'valid' END AS reason, count(*) AS n, min(id) AS first_id FROM hybrid_references GROUP BY 1")
def reference_validation(spark, sf):
    """The first rule that each reference breaks: hash pattern, role, texts, bounds."""
    blank = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    bad = ~F.coalesce(F.col("source_row_sha256").rlike("^[a-f0-9]{64}$"), F.lit(False))
    reason = first_reason([("bad hash", bad), ("no role", F.col("role").isNull()), ("no prompt", blank("user_message")), ("no reply", blank("assistant")), ("bad row", F.col("row_index").isNull() | (F.col("row_index") < 0))])
    return load(spark, sf, "hybrid_references").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


@query(
    "input_integrity",
    f"""SELECT 'mcq_items: repeated id' AS rule, (SELECT count(*) - count(DISTINCT id) FROM mcq_items) AS violations UNION ALL SELECT 'mcq_items: gold outside the choices', (SELECT count(*) FROM mcq_items WHERE gold_index IS NULL OR gold_index < 0 OR gold_index >= len(choices))
    UNION ALL SELECT 'seed_pool: unknown topic', (SELECT count(*) FROM (SELECT DISTINCT seed_index, topic_id FROM seed_pool) WHERE topic_id NOT IN (SELECT topic_id FROM topics)) UNION ALL SELECT 'documents: wrong length', (SELECT count(*) FROM documents WHERE n_chars IS DISTINCT FROM length(text))
    UNION ALL SELECT 'documents: repeated id', (SELECT count(*) - count(DISTINCT doc_id) FROM documents) UNION ALL SELECT 'messages: unknown role', (SELECT count(*) FROM {MSG} WHERE role IS NULL OR role NOT IN ('user', 'assistant', 'system')) UNION ALL SELECT 'messages: no chat', (SELECT count(*) FROM {MSG} m WHERE NOT EXISTS (SELECT 1 FROM conversations c WHERE c.seed_index = m.seed_index))""",
)
def input_integrity(spark, sf):
    """How many rows break each rule on the inputs; a guard fails where a number is not 0."""
    items, docs = load(spark, sf, "mcq_items"), load(spark, sf, "documents")
    m = load(spark, sf, "messages").select("message_id", "seed_index", role().alias("role")).dropDuplicates(["message_id"])
    bad_gold = F.coalesce((F.col("gold_index") < 0) | (F.col("gold_index") >= F.size("choices")), F.lit(True))
    seeds = load(spark, sf, "seed_pool").select("seed_index", "topic_id").distinct().filter("topic_id is not null")

    def rule(name: str, df: DataFrame, n: Column) -> DataFrame:
        return df.agg(n.cast("long").alias("violations")).select(F.lit(name).alias("rule"), "violations")

    rules = [
        rule("mcq_items: repeated id", items, F.count("*") - F.count_distinct("id")),
        rule("mcq_items: gold outside the choices", items, F.count_if(bad_gold)),
        rule("seed_pool: unknown topic", seeds.join(load(spark, sf, "topics").select("topic_id"), "topic_id", "left_anti"), F.count("*")),
        rule("documents: wrong length", docs, F.count_if(~F.col("n_chars").eqNullSafe(F.length("text").cast("long")))),
        rule("documents: repeated id", docs, F.count("*") - F.count_distinct("doc_id")),
        rule("messages: unknown role", m, F.count_if(F.col("role").isNull() | ~F.col("role").isin("user", "assistant", "system"))),
        rule("messages: no chat", m.join(load(spark, sf, "conversations").select("seed_index"), "seed_index", "left_anti"), F.count("*")),
    ]
    out = rules[0]
    for r in rules[1:]:
        out = out.unionByName(r)
    return out


@query("capped_neighbours", f"""WITH w AS (SELECT DISTINCT id, row_index, unnest({T.words_sql('user_message')}) AS word FROM hybrid_references WHERE user_message IS NOT NULL AND row_index IS NOT NULL),
    k AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY word ORDER BY row_index DESC, id) <= 50), p AS (SELECT x.id, y.id AS other, count(*) AS shared FROM k x JOIN k y ON x.word = y.word AND x.id <> y.id GROUP BY ALL)
    SELECT id, other, shared FROM p QUALIFY row_number() OVER (PARTITION BY id ORDER BY shared DESC, other) <= 50""")
def capped_neighbours(spark, sf):
    """At most fifty neighbours of each reference, over posting lists of at most its latest fifty rows; the exact search without caps is ``clone_pairs``. The library is a small fixed table."""
    from pyspark.sql import Window

    w = load(spark, sf, "hybrid_references").filter("user_message is not null and row_index is not null").select("id", "row_index", F.explode(T.words(F.col("user_message"))).alias("word")).distinct()
    k = w.withColumn("r", F.row_number().over(Window.partitionBy("word").orderBy(F.desc("row_index"), "id"))).filter("r <= 50").select("id", "word")
    p = k.join(k.withColumnRenamed("id", "other"), "word").filter("id <> other").groupBy("id", "other").agg(F.count("*").alias("shared"))
    return p.withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("shared"), "other"))).filter("r <= 50").select("id", "other", "shared")


@query("brief_answers", f"SELECT seed_index, count(*) AS answers, min({T.word_count_sql('content')}) AS shortest, count(*) FILTER ({T.word_count_sql('content')} < 15) AS brief FROM {MSG} WHERE role = 'assistant' AND seed_index IS NOT NULL GROUP BY seed_index HAVING count(*) FILTER ({T.word_count_sql('content')} < 15) > 0")
def brief_answers(spark, sf):
    """Chats with an answer below fifteen words."""
    m = load(spark, sf, "messages").filter((role() == "assistant") & F.col("seed_index").isNotNull()).select("message_id", "seed_index", T.word_count(F.col("content")).alias("w")).dropDuplicates(["message_id"])
    return m.groupBy("seed_index").agg(F.count("*").alias("answers"), F.min("w").alias("shortest"), F.count_if(F.col("w") < 15).alias("brief")).filter("brief > 0")


@query("profile_slices", f"SELECT grounding_mode, count(*) AS chats, count(*) FILTER (screening_passed) AS passed, count(*) FILTER (max_exchanges > 2) AS long_chats, count(*) FILTER (quality_policy.closing_offer_turn IS NOT NULL) AS with_offer FROM {CONV} GROUP BY grounding_mode")
def profile_slices(spark, sf):
    """Slices of the chats by how they are grounded."""
    c = latest(load(spark, sf, "conversations"), "seed_index")
    return c.groupBy("grounding_mode").agg(F.count("*").alias("chats"), F.count_if(F.col("screening_passed").eqNullSafe(True)).alias("passed"), F.count_if(F.col("max_exchanges") > 2).alias("long_chats"), F.count_if(F.col("quality_policy.closing_offer_turn").isNotNull()).alias("with_offer"))


@query("writer_context", f"SELECT seed_index, to_json({{'first_question': first_question, 'exchanges': max_exchanges, 'closing': quality_policy.closing_offer_turn, 'first_source': json_extract_string(sources, '$[0].url')}}) AS context FROM {CONV} WHERE first_question IS NOT NULL AND (sources IS NULL OR json_valid(sources))")
def writer_context(spark, sf):
    """What a writer is given of a chat, as one JSON text; a column that holds JSON is parsed first."""
    c = latest(load(spark, sf, "conversations"), "seed_index").filter("first_question is not null")
    parsed = F.from_json("sources", "array<struct<url:string>>")
    c = c.filter(F.col("sources").isNull() | parsed.isNotNull())
    fields = F.struct("first_question", F.col("max_exchanges").alias("exchanges"), F.col("quality_policy.closing_offer_turn").alias("closing"), F.try_element_at(parsed, F.lit(1))["url"].alias("first_source"))
    return c.select("seed_index", F.to_json(fields, {"ignoreNullFields": "false"}).alias("context"))


@query("dataset_listing", "SELECT 'documents' AS name, count(*) AS n, min(created_at) AS first_at FROM documents UNION ALL SELECT 'messages', count(*), min(created_at) FROM messages UNION ALL SELECT 'seed_pool', count(*), min(created_at) FROM seed_pool")
def dataset_listing(spark, sf):
    """The tables that an explorer may open, with their sizes; a name that is not listed is no table."""
    out = None
    for name in ("documents", "messages", "seed_pool"):
        t = load(spark, sf, name).agg(F.count("*").alias("n"), F.min("created_at").alias("first_at")).select(F.lit(name).alias("name"), "n", "first_at")
        out = t if out is None else out.unionByName(t)
    return out
