"""Sources, addresses, releases, ledgers and trends."""

from __future__ import annotations

from pyspark.sql import functions as F

from marsad.functions import text as T
from marsad.operators.ordering import placed
from marsad.plans.catalog import query
from marsad.plans.explorer import CONV, MSG
from marsad.sources import readers as R
from marsad.tables import latest, load, role

PAGES = "(SELECT * FROM evidence_pages QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY ingested_at DESC) = 1)"
HOST = "lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1))"


@query("page_hosts_allowed", f"SELECT p.page_id, {HOST} AS host, coalesce(len(list_filter(t.allowed_domains, lambda d: {HOST} = regexp_replace(lower(trim(d)), '^www\\.', '') OR ends_with({HOST}, '.' || regexp_replace(lower(trim(d)), '^www\\.', '')))) > 0, false) AS allowed FROM {PAGES} p LEFT JOIN topics t USING (topic_id) WHERE url IS NOT NULL")
def page_hosts_allowed(spark, sf):
    """Whether a page's host is a domain of its topic or below one."""
    p = latest(load(spark, sf, "evidence_pages"), "page_id").filter("url is not null").select("page_id", "topic_id", T.host(F.col("url")).alias("host"))
    t = load(spark, sf, "topics").select("topic_id", F.transform("allowed_domains", T.plain_domain).alias("domains"))
    return p.join(t, "topic_id", "left").select("page_id", "host", T.host_allowed(F.col("host"), F.col("domains")).alias("allowed"))


@query("distinct_pages", f"SELECT rtrim(url, '/') AS url, count(*) AS n, min(page_id) AS first_page FROM {PAGES} WHERE url IS NOT NULL GROUP BY 1")
def distinct_pages(spark, sf):
    p = latest(load(spark, sf, "evidence_pages"), "page_id").filter("url is not null")
    return p.groupBy(T.canonical_url(F.col("url")).alias("url")).agg(F.count("*").alias("n"), F.min("page_id").alias("first_page"))


@query(
    "foreign_links",
    f"""WITH s AS (SELECT seed_index, unnest(from_json(sources, '[{{"url":"VARCHAR"}}]')).url AS url FROM {CONV} WHERE json_valid(sources)), a AS (SELECT DISTINCT rtrim(url, '/') AS url FROM evidence_pages)
    SELECT seed_index, rtrim(url, '/') AS link, {HOST} AS host, {HOST} IN (SELECT {HOST} FROM evidence_pages WHERE url IS NOT NULL) AS known_host FROM s WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.url = rtrim(s.url, '/'))""",
)
def foreign_links(spark, sf):
    """Sources of a chat that are no page of the evidence, in canonical form, and whether their host is known there."""
    s = latest(load(spark, sf, "conversations").select("seed_index", "sources", "ingested_at"), "seed_index").select("seed_index", F.explode(F.from_json("sources", "array<struct<url:string>>")).alias("s"))
    l = s.filter("s.url is not null").select("seed_index", T.canonical_url(F.col("s.url")).alias("link"))
    p = load(spark, sf, "evidence_pages").filter("url is not null").select(T.canonical_url(F.col("url")).alias("link")).distinct()
    hosts = p.select(T.host(F.col("link")).alias("host"), F.lit(True).alias("known")).distinct()
    return l.join(p, "link", "left_anti").withColumn("host", T.host(F.col("link"))).join(hosts, "host", "left").select("seed_index", "link", "host", F.coalesce("known", F.lit(False)).alias("known_host"))


@query("evidence_supported", f"SELECT page_id, {T.word_count_sql('content')} >= 5 AND contains(regexp_replace({T.fold_sql('page_text')}, '\\s+', ' ', 'g'), regexp_replace({T.fold_sql('content')}, '\\s+', ' ', 'g')) AS supported FROM {PAGES} WHERE content IS NOT NULL AND page_text IS NOT NULL")
def evidence_supported(spark, sf):
    """Whether a snippet of five words or more stands in its page."""
    p = latest(load(spark, sf, "evidence_pages"), "page_id").filter("content is not null and page_text is not null")
    one = lambda c: F.regexp_replace(T.fold(F.col(c)), r"\s+", " ")
    return p.select("page_id", ((T.word_count(F.col("content")) >= 5) & one("page_text").contains(one("content"))).alias("supported"))


@query("fetch_status", f"SELECT coalesce(fetch_error, 'ok') AS status, count(*) AS n, count(DISTINCT topic_id) AS topics, count(*) FILTER (page_text IS NULL) AS without_text FROM {PAGES} GROUP BY 1")
def fetch_status(spark, sf):
    p = latest(load(spark, sf, "evidence_pages"), "page_id")
    return p.groupBy(F.coalesce("fetch_error", F.lit("ok")).alias("status")).agg(F.count("*").alias("n"), F.count_distinct("topic_id").alias("topics"), F.count_if(F.col("page_text").isNull()).alias("without_text"))


@query("topic_invariants", "SELECT domain, count(*) AS topics, count(DISTINCT topic_id) AS ids, count(DISTINCT subject) AS subjects, sum(len(questions))::bigint AS questions, sum(len(capabilities))::bigint AS capabilities FROM (SELECT * FROM topics UNION ALL SELECT * FROM topics WHERE domain = 'science') GROUP BY domain")
def topic_invariants(spark, sf):
    """Counts of a union of two catalogues, repeated ids included."""
    t = load(spark, sf, "topics")
    u = t.unionByName(t.filter("domain = 'science'"), allowMissingColumns=True)
    size = lambda c: F.sum(F.when(F.col(c).isNotNull(), F.size(c)))
    return u.groupBy("domain").agg(F.count("*").alias("topics"), F.count_distinct("topic_id").alias("ids"), F.count_distinct("subject").alias("subjects"), size("questions").alias("questions"), size("capabilities").alias("capabilities"))


@query("capability_topics", "SELECT capability, count(DISTINCT topic_id) AS topics FROM (SELECT topic_id, unnest(capabilities) AS capability FROM topics) GROUP BY capability")
def capability_topics(spark, sf):
    return load(spark, sf, "topics").select("topic_id", F.explode("capabilities").alias("capability")).groupBy("capability").agg(F.count_distinct("topic_id").alias("topics"))


@query("release_records", f"SELECT 'chat-' || lpad(c.seed_index::varchar, 6, '0') AS id, c.domain AS topic, c.max_exchanges AS exchanges, c.grounding_mode AS grounding, s.intent IS NOT NULL AS has_intent FROM {CONV} c LEFT JOIN (SELECT * FROM seed_pool QUALIFY row_number() OVER (PARTITION BY seed_index ORDER BY ingested_at DESC) = 1) s USING (seed_index) WHERE c.screening_passed")
def release_records(spark, sf):
    """Passing chats in the shape of a release."""
    c = latest(load(spark, sf, "conversations"), "seed_index").filter("screening_passed")
    s = latest(load(spark, sf, "seed_pool"), "seed_index").select("seed_index", "intent")
    return c.join(s, "seed_index", "left").select(F.concat(F.lit("chat-"), F.lpad(F.col("seed_index").cast("string"), 6, "0")).alias("id"), F.col("domain").alias("topic"), F.col("max_exchanges").alias("exchanges"), F.col("grounding_mode").alias("grounding"), F.col("intent").isNotNull().alias("has_intent"))


@query("release_metrics", f"SELECT coalesce(domain, 'general') AS category, count(*) AS chats, count(DISTINCT family_id) AS families, count(*) FILTER (screening_passed) AS passed, median({T.word_count_sql('first_question')}) AS median_words FROM {CONV} GROUP BY 1")
def release_metrics(spark, sf):
    c = latest(load(spark, sf, "conversations"), "seed_index")
    return c.groupBy(F.coalesce("domain", F.lit("general")).alias("category")).agg(F.count("*").alias("chats"), F.count_distinct("family_id").alias("families"), F.count_if(F.col("screening_passed").eqNullSafe(True)).alias("passed"), F.median(T.word_count(F.col("first_question"))).alias("median_words"))


@query("late_deliveries", "SELECT message_id, count(*) AS deliveries, max(ingested_at) AS last_at FROM messages GROUP BY message_id HAVING count(*) > 1")
def late_deliveries(spark, sf):
    return load(spark, sf, "messages").groupBy("message_id").agg(F.count("*").alias("deliveries"), F.max("ingested_at").alias("last_at")).filter("deliveries > 1")


@query("ledger_by_stage", "SELECT event_type AS stage, count(*) AS requests, sum(value::decimal(18,6))::decimal(38,6) AS cost, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def ledger_by_stage(spark, sf):
    """Requests and their cost by stage, summed as decimals."""
    return load(spark, sf, "events").groupBy(F.col("event_type").alias("stage")).agg(F.count("*").alias("requests"), F.sum(F.col("value").cast("decimal(18,6)")).cast("decimal(38,6)").alias("cost"), F.count_distinct("user_id").alias("users"))


@query("ledger_spend_decimal", "SELECT sum(value::decimal(18,6)) FILTER (event_type <> 'error')::decimal(38,6) AS known, coalesce(sum(0.05) FILTER (event_type = 'error'), 0)::decimal(38,6) AS reserved, count(*) FILTER (value IS NULL) AS unknown FROM events")
def ledger_spend_decimal(spark, sf):
    """Known cost and what unresolved requests hold in reserve; a cost that is missing is counted, not guessed."""
    e = load(spark, sf, "events")
    bad = F.col("event_type") == "error"
    return e.agg(F.sum(F.when(~bad, F.col("value").cast("decimal(18,6)"))).cast("decimal(38,6)").alias("known"), F.coalesce(F.sum(F.when(bad, F.lit("0.05").cast("decimal(18,6)"))), F.lit(0)).cast("decimal(38,6)").alias("reserved"), F.count_if(F.col("value").isNull()).alias("unknown"))


TREND = "SELECT 'suite/' || event_type AS metric, dayofyear(ts) AS step, avg(value) AS score FROM events WHERE value IS NOT NULL AND isfinite(value) AND event_type <> 'error' GROUP BY ALL"


@query("trend_points", f"SELECT metric, step, round(score, 6) AS score FROM ({TREND})")
def trend_points(spark, sf):
    """Scores by metric and step, finite values of known suites only."""
    return trend(spark, sf).select("metric", "step", F.round("score", 6).alias("score"))


def trend(spark, sf):
    e = load(spark, sf, "events").filter("event_type <> 'error'")
    finite = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < F.lit(float("inf")))
    return e.filter(finite).groupBy(F.concat(F.lit("suite/"), "event_type").alias("metric"), F.dayofyear("ts").cast("long").alias("step")).agg(F.avg("value").alias("score"))


@query("trend_best_step", f"SELECT metric, arg_max(step, (score, -step)) AS best_step, round(max(score), 6) AS best FROM ({TREND}) GROUP BY metric")
def trend_best_step(spark, sf):
    """The first step of the best score of each metric."""
    return trend(spark, sf).groupBy("metric").agg(F.max_by("step", F.struct("score", -F.col("step"))).alias("best_step"), F.round(F.max("score"), 6).alias("best"))


@query("json_props", "SELECT event_type, count(*) AS n, count(json_extract_string(props, '$.k')) AS with_k, min(json_extract_string(props, '$.k')) AS first_k FROM events GROUP BY event_type")
def json_props(spark, sf):
    k = F.get_json_object("props", "$.k")
    return load(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count(k).alias("with_k"), F.min(k).alias("first_k"))


LOG = "SELECT user_id, event_id, event_type = 'purchase' AS final, sha256(user_id::varchar || ':' || event_id::varchar) AS sampler, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM events"


@query("checkpoint_selection", f"WITH l AS ({LOG}) SELECT user_id, event_id, 'step-' || left(sampler, 12) AS checkpoint_id FROM l WHERE (place % 5 = 0 AND place <= 15) OR final")
def checkpoint_selection(spark, sf):
    """Every fifth entry of each log, at most three, and every final one; entries are numbered over all tasks."""
    e = load(spark, sf, "events").select("user_id", "event_id", "ts", (F.col("event_type") == "purchase").alias("final"))
    n = placed(e, ["user_id"], ["ts", "event_id"]).withColumn("n", F.col("place") + 1)
    sampler = F.sha2(F.concat_ws(":", "user_id", "event_id"), 256)
    return n.filter("(n % 5 = 0 and n <= 15) or final").select("user_id", "event_id", F.concat(F.lit("step-"), F.substring(sampler, 1, 12)).alias("checkpoint_id"))


@query("transcript_roles", "WITH d AS (SELECT doc_id, text FROM documents WHERE regexp_matches(text, '(?m)^(User|Assistant|المستخدم|المساعد):')) SELECT doc_id, len(regexp_extract_all(text, '(?m)^(User|المستخدم):')) AS n_user, len(regexp_extract_all(text, '(?m)^(Assistant|المساعد):')) AS n_assistant FROM d")
def transcript_roles(spark, sf):
    """Turns by role of documents that are labelled transcripts."""
    d = load(spark, sf, "documents").filter(F.col("text").rlike("(?m)^(User|Assistant|المستخدم|المساعد):")).select("doc_id", R.parse_transcript(F.col("text")).alias("m"))
    n = lambda r: F.size(F.filter("m", lambda m: m["role"] == r))
    return d.select("doc_id", n("user").alias("n_user"), n("assistant").alias("n_assistant"))


@query("run_entry_parse", "SELECT split_part(subset, ':', 1) AS family, split_part(split_part(subset, ':', 2), '=', 2) AS subject, count(*) AS n FROM mcq_items WHERE subset IS NOT NULL GROUP BY ALL")
def run_entry_parse(spark, sf):
    """Items by run entry, out of lines in the format of a run configuration."""
    lines = load(spark, sf, "mcq_items").filter("subset is not null").select(F.concat(F.lit('{description: "'), "subset", F.lit('", priority: 1}')).alias("value"))
    return R.run_entries(lines).groupBy("family", F.coalesce(F.col("args")["subject"], F.lit("")).alias("subject")).agg(F.count("*").alias("n"))


@query("training_messages", f"SELECT seed_index, count(*) AS n_messages, sum(length(coalesce(content, '')))::bigint AS chars, bool_and(role IN ('user', 'assistant', 'system') AND trim(coalesce(content, '')) <> '') AS valid FROM {MSG} WHERE seed_index IS NOT NULL GROUP BY seed_index")
def training_messages(spark, sf):
    """Size and validity of each chat as a training example."""
    m = load(spark, sf, "messages").select("message_id", "seed_index", "turn", role().alias("role"), "content").dropDuplicates(["message_id"]).filter("seed_index is not null")
    ok = F.col("role").isin("user", "assistant", "system") & (F.trim(F.coalesce("content", F.lit(""))) != "")
    return m.groupBy("seed_index").agg(F.count("*").alias("n_messages"), F.sum(F.length(F.coalesce("content", F.lit("")))).alias("chars"), F.every(ok).alias("valid"))


@query("batch_profile", f"SELECT batch_file, count(*) AS n, count(*) FILTER (screening_passed) AS passed, avg(max_exchanges) AS mean_exchanges, count(quality_policy.max_answer_words) AS with_limit FROM {CONV} GROUP BY batch_file")
def batch_profile(spark, sf):
    c = latest(load(spark, sf, "conversations"), "seed_index")
    return c.groupBy("batch_file").agg(F.count("*").alias("n"), F.count_if(F.col("screening_passed").eqNullSafe(True)).alias("passed"), F.avg("max_exchanges").alias("mean_exchanges"), F.count("quality_policy.max_answer_words").alias("with_limit"))


@query("family_sizes", f"SELECT family_id, count(*) AS chats, min(seed_index) AS first_seed, max(seed_index) - min(seed_index) AS spread FROM {CONV} WHERE family_id IS NOT NULL GROUP BY family_id")
def family_sizes(spark, sf):
    c = latest(load(spark, sf, "conversations"), "seed_index").filter("family_id is not null")
    return c.groupBy("family_id").agg(F.count("*").alias("chats"), F.min("seed_index").alias("first_seed"), (F.max("seed_index") - F.min("seed_index")).alias("spread"))
