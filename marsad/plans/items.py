"""Item shaping, contracts, classifications and small set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marsad.functions import text as T
from marsad.operators.ordering import numbered, sample_key
from marsad.plans.catalog import query
from marsad.plans.explorer import CONV, MSG
from marsad.plans.records import PAGES
from marsad.plans.similar import SEEDS
from marsad.tables import latest, load, role


def joined_context(context, question):
    """Context, a blank line and the question; the question alone where the context is blank."""
    return F.when(F.trim(F.coalesce(context, F.lit(""))) != "", F.concat(context, F.lit("\n\n"), question)).otherwise(question)


def filled_options(*columns):
    """The options that are neither null nor empty, in order."""
    return F.filter(F.array(*columns), lambda x: x.isNotNull() & (x != ""))


def answer_index(key):
    """0-based place of a Latin answer letter; null for anything else."""
    return F.when(key.rlike("^[A-Z]$"), F.ascii(key) - F.ascii(F.lit("A")))


def columns_like(df: DataFrame, prefix: str) -> list[str]:
    """Columns with a prefix, in the order of the schema."""
    return [c for c in df.columns if c.startswith(prefix)]


@query("context_questions", "SELECT topic_id, CASE WHEN trim(coalesce(subject, '')) <> '' THEN subject || chr(10) || chr(10) || questions[1] ELSE questions[1] END AS prompt FROM topics WHERE len(questions) > 0")
def context_questions(spark, sf):
    return load(spark, sf, "topics").filter(F.size("questions") > 0).select("topic_id", joined_context(F.col("subject"), F.col("questions")[0]).alias("prompt"))


WIDE = "(SELECT item_no, choices[1] AS sol1, choices[2] AS sol2, choices[3] AS sol3, choices[4] AS sol4, choices[5] AS sol5, chr(65 + (item_no % 7)::int) AS answer_key FROM mcq_items)"


def wide_items(spark, sf):
    """Items with one column an option and a letter as the answer key."""
    i = load(spark, sf, "mcq_items")
    return i.select("item_no", *(F.get("choices", F.lit(k)).alias(f"sol{k + 1}") for k in range(5)), F.char((65 + F.col("item_no") % 7).cast("int")).alias("answer_key"))


@query("wide_options", f"SELECT item_no, len(list_filter([sol1, sol2, sol3, sol4, sol5], lambda x: x IS NOT NULL AND x <> '')) AS n_options, ascii(answer_key) - 65 AS gold FROM {WIDE} WHERE regexp_matches(answer_key, '^[A-D]$')")
def wide_options(spark, sf):
    """Options found by their column names, and the place of the answer letter, for keys A to D."""
    w = wide_items(spark, sf)
    options = filled_options(*(F.col(c) for c in columns_like(w, "sol")))
    return w.filter(F.col("answer_key").rlike("^[A-D]$")).select("item_no", F.size(options).alias("n_options"), answer_index(F.col("answer_key")).alias("gold"))


@query("stripped_options", r"SELECT item_no, i - 1 AS place, trim(regexp_replace(c, '^\s*[A-Za-zأ-ي]\s*[).]\s+', '')) AS option, replace(replace(trim(regexp_replace(c, '^\s*[A-Za-zأ-ي]\s*[).]\s+', '')), 'أ', 'ا'), 'إ', 'ا') AS unified FROM (SELECT item_no, unnest(choices) AS c, generate_subscripts(choices, 1) AS i FROM mcq_items) WHERE c IS NOT NULL")
def stripped_options(spark, sf):
    """All options without the marker that some of them have, and with one form of alef."""
    option = F.trim(F.regexp_replace("c", r"^\s*[A-Za-zأ-ي]\s*[).]\s+", ""))
    i = load(spark, sf, "mcq_items").select("item_no", F.posexplode("choices").alias("place", "c")).filter("c is not null")
    return i.select("item_no", "place", option.alias("option"), F.translate(option, "أإ", "اا").alias("unified"))


@query(
    "reference_neighbours",
    f"""WITH w AS (SELECT DISTINCT id, unnest({T.words_sql('user_message')}) AS word FROM hybrid_references WHERE user_message IS NOT NULL),
    p AS (SELECT x.id, y.id AS other, count(*) AS shared FROM w x JOIN w y ON x.word = y.word AND x.id <> y.id GROUP BY ALL)
    SELECT id, other, shared FROM p QUALIFY row_number() OVER (PARTITION BY id ORDER BY shared DESC, other) <= 3""",
)
def reference_neighbours(spark, sf):
    """The three references that share most words with each one; the library is a small fixed table."""
    from pyspark.sql import Window

    w = load(spark, sf, "hybrid_references").filter("user_message is not null").select("id", F.explode(T.words(F.col("user_message"))).alias("word")).distinct()
    p = w.join(w.withColumnRenamed("id", "other"), "word").filter("id <> other").groupBy("id", "other").agg(F.count("*").alias("shared"))
    return p.withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("shared"), "other"))).filter("r <= 3").select("id", "other", "shared")


@query("weighted_exchanges", f"WITH u AS (SELECT seed_index, ('0x' || substr(sha256(concat_ws(':', '11', seed_index::varchar)), 1, 12))::bigint / 281474976710656.0 AS u FROM {SEEDS}) SELECT seed_index, CASE WHEN u < 0.5 THEN 2 WHEN u < 0.8 THEN 3 ELSE 4 END AS exchanges FROM u")
def weighted_exchanges(spark, sf):
    """A weighted choice that a hash of the key makes: cumulative weights 0.5, 0.8 and 1."""
    s = latest(load(spark, sf, "seed_pool"), "seed_index")
    u = F.conv(F.substring(sample_key(11, F.col("seed_index")), 1, 12), 16, 10).cast("long") / F.lit(2.0**48)
    return s.select("seed_index", F.when(u < 0.5, 2).when(u < 0.8, 3).otherwise(4).alias("exchanges"))


@query("new_batches", f"SELECT batch_file, count(*) AS n FROM {CONV} WHERE batch_file IS NOT NULL AND batch_file NOT IN (SELECT batch_file FROM conversations WHERE batch_file IS NOT NULL AND ingested_at < (SELECT min(ingested_at) + INTERVAL 30 DAY FROM conversations)) GROUP BY batch_file")
def new_batches(spark, sf):
    """Batches that the listing of the first thirty days does not have."""
    c = load(spark, sf, "conversations").filter("batch_file is not null")
    # the time of the first delivery is one row
    first = load(spark, sf, "conversations").agg((F.min("ingested_at") + F.expr("interval 30 days")).alias("until"))
    known = c.join(F.broadcast(first)).filter("ingested_at < until").select("batch_file").distinct()
    return latest(c, "seed_index").join(known, "batch_file", "left_anti").groupBy("batch_file").agg(F.count("*").alias("n"))


@query("ordinal_join", f"WITH a AS (SELECT seed_index, row_number() OVER (ORDER BY seed_index) - 1 AS n FROM {SEEDS}), b AS (SELECT seed_index, row_number() OVER (ORDER BY seed_index) - 1 AS n FROM {CONV}) SELECT a.n, a.seed_index AS seed, b.seed_index AS chat FROM a JOIN b USING (n)")
def ordinal_join(spark, sf):
    """Two tables side by side in their orders."""
    a = numbered(latest(load(spark, sf, "seed_pool"), "seed_index").select("seed_index"), ["seed_index"], "n")
    b = numbered(latest(load(spark, sf, "conversations"), "seed_index").select("seed_index"), ["seed_index"], "n")
    return a.withColumnRenamed("seed_index", "seed").join(b.withColumnRenamed("seed_index", "chat"), "n")


@query("annotation_validation", "SELECT coalesce(reason, 'valid') AS reason, count(*) AS n FROM (SELECT CASE WHEN l.doc_id IS NULL OR d.doc_id IS NULL THEN 'no document' WHEN a.subject IS NULL THEN 'unknown subject' WHEN l.labeller NOT IN ('lab_a', 'lab_b', 'auto') OR l.labeller IS NULL THEN 'unknown labeller' WHEN l.labelled_at IS NULL THEN 'no time' END AS reason FROM subject_labels l LEFT JOIN documents d USING (doc_id) LEFT JOIN subject_areas a ON a.subject = l.subject) GROUP BY 1")
def annotation_validation(spark, sf):
    """The first rule that each label breaks, counted."""
    l = load(spark, sf, "subject_labels")
    d = load(spark, sf, "documents").select("doc_id", F.lit(True).alias("has_document"))
    a = load(spark, sf, "subject_areas").select("subject", F.lit(True).alias("has_subject"))
    reason = (
        F.when(F.col("has_document").isNull(), "no document").when(F.col("has_subject").isNull(), "unknown subject")
        .when(~F.coalesce(F.col("labeller").isin("lab_a", "lab_b", "auto"), F.lit(False)), "unknown labeller").when(F.col("labelled_at").isNull(), "no time").otherwise("valid")
    )
    return l.join(d, "doc_id", "left").join(a, "subject", "left").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query("output_contracts", f"WITH t AS (SELECT seed_index, count(*) AS n, bool_and(role IN ('user', 'assistant')) AS roles, bool_and(trim(coalesce(content, '')) <> '') AS filled FROM {MSG} WHERE role <> 'system' GROUP BY seed_index) SELECT n = 2 * max_exchanges AS right_length, roles, filled, count(*) AS chats FROM {CONV} JOIN t USING (seed_index) GROUP BY ALL")
def output_contracts(spark, sf):
    """Chats by the three rules of an output: twice the exchanges long, known roles, no blank."""
    m = load(spark, sf, "messages").select("message_id", "seed_index", role().alias("role"), "content").dropDuplicates(["message_id"]).filter("role <> 'system'")
    t = m.groupBy("seed_index").agg(F.count("*").alias("n"), F.every(F.col("role").isin("user", "assistant")).alias("roles"), F.every(F.trim(F.coalesce("content", F.lit(""))) != "").alias("filled"))
    c = latest(load(spark, sf, "conversations"), "seed_index").join(t, "seed_index")
    return c.groupBy((F.col("n") == 2 * F.col("max_exchanges")).alias("right_length"), "roles", "filled").agg(F.count("*").alias("chats"))


@query("question_kinds", f"SELECT kind, count(*) AS n FROM (SELECT CASE WHEN starts_with(question, 'كيف') OR starts_with(question, 'How') THEN 'how' WHEN starts_with(question, 'هل') OR starts_with(question, 'Does') THEN 'whether' WHEN contains(question, 'الفرق') OR contains(question, 'versus') THEN 'compare' ELSE 'other' END AS kind FROM {SEEDS} WHERE question IS NOT NULL) GROUP BY kind")
def question_kinds(spark, sf):
    q = F.col("question")
    kind = F.when(q.startswith("كيف") | q.startswith("How"), "how").when(q.startswith("هل") | q.startswith("Does"), "whether").when(q.contains("الفرق") | q.contains("versus"), "compare").otherwise("other")
    return latest(load(spark, sf, "seed_pool"), "seed_index").filter("question is not null").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("capability_sets", "SELECT topic_id, list_sort(list_distinct(list_concat(coalesce(capabilities, []::varchar[]), coalesce(allowed_domains, []::varchar[])))) AS both, len(list_filter(coalesce(capabilities, []::varchar[]), lambda c: NOT list_contains(coalesce(allowed_domains, []::varchar[]), c))) AS only_capabilities FROM topics")
def capability_sets(spark, sf):
    none = F.array().cast("array<string>")
    a, b = F.coalesce("capabilities", none), F.coalesce("allowed_domains", none)
    return load(spark, sf, "topics").select("topic_id", F.array_sort(F.array_union(a, b)).alias("both"), F.size(F.filter(a, lambda x: ~F.array_contains(b, x))).alias("only_capabilities"))


@query("batch_labels", "SELECT DISTINCT batch_file, replace(regexp_replace(batch_file, '\\.[^.]*$', ''), '_', ' ') AS label FROM conversations WHERE batch_file IS NOT NULL")
def batch_labels(spark, sf):
    c = load(spark, sf, "conversations").filter("batch_file is not null").select("batch_file").distinct()
    return c.select("batch_file", F.translate(F.regexp_replace("batch_file", r"\.[^.]*$", ""), "_", " ").alias("label"))


@query("cited_positions", f"SELECT message_id, list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(content, '\\d+'), lambda x: try_cast(x AS int)), lambda n: n IS NOT NULL AND n > 1 AND n <= 9 AND n % 2 = 1))) AS positions FROM {MSG} WHERE role = 'user' AND regexp_matches(content, '\\d')")
def cited_positions(spark, sf):
    """Odd positions from 3 to 9 that a text names, in order and once each."""
    m = load(spark, sf, "messages").select("message_id", role().alias("role"), "content").dropDuplicates(["message_id"]).filter((F.col("role") == "user") & F.col("content").rlike(r"\d"))
    n = F.transform(F.regexp_extract_all("content", F.lit(r"\d+"), F.lit(0)), lambda x: x.try_cast("int"))
    return m.select("message_id", F.array_sort(F.array_distinct(F.filter(n, lambda x: x.isNotNull() & (x > 1) & (x <= 9) & (x % 2 == 1)))).alias("positions"))


@query("earlier_messages", "SELECT id, coalesce(len(earlier_user_messages), 0) AS n_earlier, earlier_user_messages[-1] AS last_earlier FROM hybrid_references")
def earlier_messages(spark, sf):
    e = F.col("earlier_user_messages")
    return load(spark, sf, "hybrid_references").select("id", F.greatest(F.coalesce(F.size(e), F.lit(0)), F.lit(0)).alias("n_earlier"), F.try_element_at(e, F.lit(-1)).alias("last_earlier"))


@query("reference_integrity", "SELECT count(*) AS n, count(DISTINCT id) AS ids, count(*) FILTER (trim(coalesce(assistant, '')) = '') AS blank, count(*) FILTER (review_status IS NULL) AS unreviewed, count(DISTINCT source_row_sha256) AS sources FROM hybrid_references")
def reference_integrity(spark, sf):
    r = load(spark, sf, "hybrid_references")
    return r.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.count_if(F.trim(F.coalesce("assistant", F.lit(""))) == "").alias("blank"), F.count_if(F.col("review_status").isNull()).alias("unreviewed"), F.count_distinct("source_row_sha256").alias("sources"))


@query("option_maps", "SELECT item_no, len(map_keys(m)) AS n, m['c'] AS third FROM (SELECT item_no, map_from_entries([(chr((96 + i)::int), choices[i]) for i in range(1, len(choices) + 1)]) AS m FROM mcq_items WHERE len(choices) BETWEEN 1 AND 26)")
def option_maps(spark, sf):
    """Pairs of letter and option as a map."""
    pairs = F.transform("choices", lambda x, i: F.struct(F.char(97 + i), x))
    return load(spark, sf, "mcq_items").filter(F.size("choices").between(1, 26)).select("item_no", F.map_from_entries(pairs).alias("m")).select("item_no", F.size("m").alias("n"), F.col("m")["c"].alias("third"))


@query(
    "topic_facts",
    f"""WITH f AS (SELECT p.topic_id, p.page_id, row_number() OVER (PARTITION BY p.topic_id ORDER BY p.page_id) AS n FROM {PAGES} p WHERE p.content IS NOT NULL AND p.fetch_error IS NULL)
    SELECT t.topic_id, count(f.page_id) AS n_facts, min(f.page_id) AS first_page FROM topics t LEFT JOIN f ON f.topic_id = t.topic_id GROUP BY t.topic_id""",
)
def topic_facts(spark, sf):
    """Usable snippets of each topic, topics without any included; pre-aggregated, as topics are skewed."""
    p = latest(load(spark, sf, "evidence_pages"), "page_id").filter("content is not null and fetch_error is null")
    f = p.groupBy("topic_id").agg(F.count("*").alias("n_facts"), F.min("page_id").alias("first_page"))
    return load(spark, sf, "topics").select("topic_id").join(f, "topic_id", "left").select("topic_id", F.coalesce("n_facts", F.lit(0)).alias("n_facts"), "first_page")


@query("kept_questions", "SELECT topic_id, list_filter(questions, lambda q: length(q) > 40) AS kept, [i for i in range(1, len(questions) + 1) if length(questions[i]) <= 40] AS omitted FROM topics WHERE len(questions) > 0")
def kept_questions(spark, sf):
    """Questions that stay, and the numbers of those that go."""
    q = F.col("questions")
    gone = F.filter(F.transform(q, lambda x, i: F.when(F.length(x) <= 40, i + 1)), lambda n: n.isNotNull())
    return load(spark, sf, "topics").filter(F.size(q) > 0).select("topic_id", F.filter(q, lambda x: F.length(x) > 40).alias("kept"), gone.alias("omitted"))


@query("run_metrics", "SELECT u.user_id, count(*) AS runs, round(avg(v.value), 6) AS mean_value FROM (SELECT DISTINCT user_id, ts::date AS d FROM events WHERE event_type = 'purchase') u JOIN events v ON v.user_id = u.user_id AND v.ts::date = u.d AND v.event_type = 'view' GROUP BY u.user_id")
def run_metrics(spark, sf):
    """Values of runs whose key and day have a completed status."""
    e = load(spark, sf, "events").withColumn("d", F.to_date("ts"))
    u = e.filter("event_type = 'purchase'").select("user_id", "d").distinct()
    return e.filter("event_type = 'view'").join(u, ["user_id", "d"]).groupBy("user_id").agg(F.count("*").alias("runs"), F.round(F.avg("value"), 6).alias("mean_value"))
