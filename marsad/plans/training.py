"""Seeds and their sources, benchmark items, digests, batches and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marsad.functions import text as T
from marsad.operators.ordering import numbered, placed, sample_key
from marsad.plans.catalog import query
from marsad.plans.explorer import CONV
from marsad.plans.planning import key_sql
from marsad.plans.records import HOST, PAGES
from marsad.plans.similar import SEEDS
from marsad.tables import latest, load

SOURCES = f"(SELECT seed_index, unnest(from_json(sources, '[{{\"url\":\"VARCHAR\"}}]')).url AS url FROM {CONV} WHERE json_valid(sources))"


def chat_sources(spark, sf) -> DataFrame:
    c = latest(load(spark, sf, "conversations").select("seed_index", "sources", "ingested_at"), "seed_index")
    return c.select("seed_index", F.explode(F.from_json("sources", "array<struct<url:string>>")).alias("s")).select("seed_index", F.col("s.url").alias("url"))


def pages(spark, sf) -> DataFrame:
    return latest(load(spark, sf, "evidence_pages"), "page_id")


CHAT_HOSTS = f"(SELECT DISTINCT seed_index, {HOST} AS host FROM {SOURCES})"


def chat_hosts(spark, sf) -> DataFrame:
    return chat_sources(spark, sf).select("seed_index", T.host(F.col("url")).alias("host")).distinct()


@query("seed_facts", f"WITH p AS (SELECT page_id, {HOST} AS host, content FROM {PAGES} WHERE content IS NOT NULL AND fetch_error IS NULL), k AS (SELECT host, count(*) AS facts, sum(length(content))::bigint AS chars, min(page_id) AS first_page FROM p GROUP BY host) SELECT s.seed_index, sum(k.facts)::bigint AS facts, count(*) AS used_sources, sum(k.chars)::bigint AS chars, min(k.first_page) AS first_page FROM {CHAT_HOSTS} s JOIN k USING (host) GROUP BY s.seed_index")
def seed_facts(spark, sf):
    """Each chat's list of sources exploded and joined to the packs of their hosts, a pack being all snippets of a host, summed up before the join."""
    p = pages(spark, sf).filter("content is not null and fetch_error is null").select("page_id", T.host(F.col("url")).alias("host"), F.length("content").alias("chars"))
    packs = p.groupBy("host").agg(F.count("*").alias("facts"), F.sum("chars").alias("chars"), F.min("page_id").alias("first_page"))
    return chat_hosts(spark, sf).join(packs, "host").groupBy("seed_index").agg(F.sum("facts").alias("facts"), F.count("*").alias("used_sources"), F.sum("chars").alias("chars"), F.min("first_page").alias("first_page"))


@query("chats_without_evidence", f"SELECT c.seed_index, count(s.host) AS sources FROM {CONV} c LEFT JOIN {CHAT_HOSTS} s USING (seed_index) WHERE NOT EXISTS (SELECT 1 FROM {CHAT_HOSTS} t JOIN {PAGES} p ON {HOST} = t.host WHERE t.seed_index = c.seed_index AND p.page_text IS NOT NULL) GROUP BY c.seed_index")
def chats_without_evidence(spark, sf):
    """Chats none of whose sources' hosts has a page with text: what a guard on missing evidence must reject."""
    s = chat_hosts(spark, sf)
    had = s.join(pages(spark, sf).filter("page_text is not null").select(T.host(F.col("url")).alias("host")).distinct(), "host", "left_semi").select("seed_index")
    c = load(spark, sf, "conversations").select("seed_index").distinct().join(had, "seed_index", "left_anti")
    return c.join(s, "seed_index", "left").groupBy("seed_index").agg(F.count("host").alias("sources"))


def first_match(left: DataFrame, right: DataFrame, key: str, order: str) -> DataFrame:
    """Left join with the first row of ``right`` per key in an order; ``matched`` says whether there was one."""
    rest = [c for c in right.columns if c != key]
    first = right.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_first"))
    return left.join(first, key, "left").withColumn("matched", F.col("_first").isNotNull()).select(*left.columns, *(F.col(f"_first.{c}") for c in rest), "matched")


@query("seed_topics", f"WITH t AS (SELECT topic_id, subject, 1 AS rank FROM topics UNION ALL SELECT topic_id, 'again ' || subject, 2 FROM topics) SELECT s.seed_index, f.subject, f.topic_id IS NOT NULL AS matched FROM {SEEDS} s LEFT JOIN (SELECT topic_id, arg_min(subject, rank) AS subject FROM t GROUP BY topic_id) f USING (topic_id)")
def seed_topics(spark, sf):
    """Seeds with the first catalogue entry of their topic, out of two catalogues that overlap."""
    t = load(spark, sf, "topics").select("topic_id", "subject")
    both = t.withColumn("rank", F.lit(1)).unionByName(t.select("topic_id", F.concat(F.lit("again "), "subject").alias("subject"), F.lit(2).alias("rank")))
    s = latest(load(spark, sf, "seed_pool").select("seed_index", "topic_id", "ingested_at"), "seed_index").select("seed_index", "topic_id")
    return first_match(s, both, "topic_id", "rank").select("seed_index", "subject", "matched")


@query("context_screen", f"SELECT s.seed_index, c.seed_index IS NULL AS pending, coalesce(c.screening_passed, true) AS keep FROM {SEEDS} s LEFT JOIN {CONV} c USING (seed_index) WHERE regexp_matches(s.question, '^(طيب|زين|وإذا|هل|كيف|How|Why|Does|And )')")
def context_screen(spark, sf):
    """Seeds whose opening may point back: which have no verdict yet, and which stay, a missing verdict included; joined on the seed."""
    s = latest(load(spark, sf, "seed_pool").select("seed_index", "question", "ingested_at"), "seed_index").filter(F.col("question").rlike("^(طيب|زين|وإذا|هل|كيف|How|Why|Does|And )"))
    c = latest(load(spark, sf, "conversations").select("seed_index", "screening_passed", "ingested_at"), "seed_index").select("seed_index", "screening_passed", F.lit(True).alias("judged"))
    return s.join(c, "seed_index", "left").select("seed_index", F.col("judged").isNull().alias("pending"), F.coalesce("screening_passed", F.lit(True)).alias("keep"))


@query("evidence_by_url", f"WITH p AS (SELECT page_id, rtrim(url, '/') AS url, content, page_text FROM {PAGES} WHERE url IS NOT NULL), b AS (SELECT url, count(*) AS n FROM p WHERE page_text IS NOT NULL GROUP BY url) SELECT x.page_id, count(*) AS pages, count(*) FILTER (contains(regexp_replace({T.fold_sql('y.page_text')}, '\\s+', ' ', 'g'), regexp_replace({T.fold_sql('x.content')}, '\\s+', ' ', 'g'))) AS supporting FROM p x JOIN p y ON x.url = y.url WHERE y.page_text IS NOT NULL AND {T.word_count_sql('x.content')} >= 5 GROUP BY x.page_id")
def evidence_by_url(spark, sf):
    """Snippets of five words or more against every page text of the same address: how many there are and how many hold the snippet."""
    one = lambda c: F.regexp_replace(T.fold(F.col(c)), r"\s+", " ")
    p = pages(spark, sf).filter("url is not null").withColumn("url", T.canonical_url(F.col("url")))
    x = p.filter(T.word_count(F.col("content")) >= 5).select("page_id", "url", one("content").alias("snippet"))
    y = p.filter("page_text is not null").select("url", one("page_text").alias("text"))
    return x.join(y, "url").groupBy("page_id").agg(F.count("*").alias("pages"), F.count_if(F.col("text").contains(F.col("snippet"))).alias("supporting"))


@query("allowed_addresses", f"SELECT rtrim(url, '/') AS url, min(page_id) AS page_id, any_value({HOST}) AS host FROM {PAGES} p JOIN topics t USING (topic_id) WHERE regexp_matches(url, '^https?://') AND len(list_filter(t.allowed_domains, lambda d: {HOST} = regexp_replace(lower(trim(d)), '^www\\.', '') OR ends_with({HOST}, '.' || regexp_replace(lower(trim(d)), '^www\\.', '')))) > 0 GROUP BY 1")
def allowed_addresses(spark, sf):
    """Web addresses whose host the topic allows, each once."""
    t = load(spark, sf, "topics").select("topic_id", F.transform("allowed_domains", T.plain_domain).alias("domains"))
    p = pages(spark, sf).filter(F.col("url").rlike("^https?://")).select("page_id", "topic_id", "url", T.host(F.col("url")).alias("host")).join(t, "topic_id")
    return p.filter(T.host_allowed(F.col("host"), F.col("domains"))).groupBy(T.canonical_url(F.col("url")).alias("url")).agg(F.min("page_id").alias("page_id"), F.first("host").alias("host"))


def canonical_json(*columns: str) -> Column:
    """The row as JSON without blanks, keys in order, nulls kept, letters as they are."""
    return F.to_json(F.struct(*(F.col(c) for c in sorted(columns))), {"ignoreNullFields": "false"})


@query("canonical_digests", f"SELECT seed_index, sha256(to_json({{'domain': domain, 'family_id': family_id, 'intent': intent, 'question': question, 'seed_index': seed_index, 'topic_id': topic_id}})) AS digest FROM {SEEDS}")
def canonical_digests(spark, sf):
    """SHA-256 of each seed's canonical JSON."""
    s = latest(load(spark, sf, "seed_pool"), "seed_index")
    return s.select("seed_index", T.digest(canonical_json("seed_index", "topic_id", "family_id", "domain", "question", "intent")).alias("digest"))


@query("whole_record_fingerprints", f"SELECT seed_index, sha256(to_json({{'batch_file': batch_file, 'domain': domain, 'first_question': first_question, 'max_exchanges': max_exchanges, 'quality_policy': CASE WHEN quality_policy IS NULL THEN NULL ELSE {{'closing_offer_turn': quality_policy.closing_offer_turn, 'max_answer_words': quality_policy.max_answer_words}} END, 'screening_passed': screening_passed, 'sources': sources}})) AS fingerprint FROM {CONV}")
def whole_record_fingerprints(spark, sf):
    """SHA-256 of a chat's record, nested fields included, in canonical JSON."""
    c = latest(load(spark, sf, "conversations"), "seed_index")
    policy = F.when(F.col("quality_policy").isNotNull(), F.struct("quality_policy.closing_offer_turn", "quality_policy.max_answer_words"))
    c = c.withColumn("quality_policy", policy)
    return c.select("seed_index", T.digest(canonical_json("batch_file", "domain", "first_question", "max_exchanges", "quality_policy", "screening_passed", "sources")).alias("fingerprint"))


@query("command_hashes", "SELECT topic_id, left(sha256(array_to_string(questions, chr(0))), 16) AS command_hash FROM topics WHERE questions IS NOT NULL")
def command_hashes(spark, sf):
    """16 hex digits of the hash of a list of arguments joined by NUL."""
    return load(spark, sf, "topics").filter("questions is not null").select("topic_id", command_hash(F.col("questions")).alias("command_hash"))


def command_hash(arguments: Column) -> Column:
    return F.left(F.sha2(F.encode(F.array_join(arguments, "\x00"), "UTF-8"), 256), F.lit(16))


@query("training_steps", "SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS bigint), try_cast(event_type AS bigint), CASE WHEN event_type = 'purchase' THEN least(dayofyear(ts) * 100 + hour(ts), 20000) END, dayofyear(ts) * 100 + hour(ts)) AS step FROM events")
def training_steps(spark, sf):
    """The step of a log entry: stated, else its name where that is a number, else epoch and batch, held to the last step for final entries."""
    from_epoch = F.dayofyear("ts") * 100 + F.hour("ts")
    stated = F.get_json_object("props", "$.k").try_cast("long")
    e = load(spark, sf, "events")
    return e.select("event_id", F.coalesce(stated, F.col("event_type").try_cast("long"), F.when(F.col("event_type") == "purchase", F.least(from_epoch, F.lit(20_000))), from_epoch).cast("long").alias("step"))


@query("guarded_metrics", "WITH s AS (SELECT user_id, event_type, left(sha256(user_id::varchar || chr(0) || ts::date::varchar), 16) AS command_hash FROM events WHERE event_type = 'purchase'), m AS (SELECT event_id, user_id, value, left(sha256(user_id::varchar || chr(0) || ts::date::varchar), 16) AS command_hash FROM events WHERE event_type = 'view') SELECT m.event_id, m.value FROM m WHERE EXISTS (SELECT 1 FROM s WHERE s.user_id = m.user_id AND s.command_hash = m.command_hash)")
def guarded_metrics(spark, sf):
    """Metrics of runs whose completed status has the same key and the same hash of its command."""
    h = command_hash(F.array(F.col("user_id").cast("string"), F.to_date("ts").cast("string"))).alias("command_hash")
    e = load(spark, sf, "events")
    done = e.filter("event_type = 'purchase'").select("user_id", h).distinct()
    return e.filter("event_type = 'view'").select("event_id", "user_id", "value", h).join(done, ["user_id", "command_hash"], "left_semi").select("event_id", "value")


@query("pending_checkpoints", "SELECT e.event_id, left(sha256(e.user_id::varchar || chr(0) || e.ts::date::varchar), 16) AS command_hash FROM events e WHERE e.event_type = 'view' AND NOT EXISTS (SELECT 1 FROM events d WHERE d.event_type = 'purchase' AND d.user_id = e.user_id AND d.ts::date = e.ts::date)")
def pending_checkpoints(spark, sf):
    """Entries without a completed run of the same key and command."""
    h = command_hash(F.array(F.col("user_id").cast("string"), F.to_date("ts").cast("string"))).alias("command_hash")
    e = load(spark, sf, "events")
    done = e.filter("event_type = 'purchase'").select("user_id", h).distinct()
    return e.filter("event_type = 'view'").select("event_id", "user_id", h).join(done, ["user_id", "command_hash"], "left_anti").select("event_id", "command_hash")


@query("next_batch", f"WITH u AS (SELECT max(seed_index) AS cursor FROM {CONV} WHERE ingested_at < (SELECT min(ingested_at) + INTERVAL 30 DAY FROM conversations) AND batch_file = (SELECT min(batch_file) FROM conversations)) SELECT seed_index FROM {SEEDS} WHERE seed_index > coalesce((SELECT cursor FROM u), -1) ORDER BY seed_index LIMIT 500")
def next_batch(spark, sf):
    """The next five hundred seeds after the last one that the first batch used."""
    c = load(spark, sf, "conversations")
    # one row each
    first = c.agg((F.min("ingested_at") + F.expr("interval 30 days")).alias("until"), F.min("batch_file").alias("batch"))
    used = latest(c.select("seed_index", "batch_file", "ingested_at"), "seed_index").join(F.broadcast(first)).filter("ingested_at < until and batch_file = batch")
    cursor = used.agg(F.coalesce(F.max("seed_index"), F.lit(-1)).alias("cursor"))
    return load(spark, sf, "seed_pool").select("seed_index").distinct().join(F.broadcast(cursor)).filter("seed_index > cursor").select("seed_index").orderBy("seed_index").limit(500)


@query("first_passing", f"SELECT seed_index, domain FROM {CONV} WHERE screening_passed ORDER BY seed_index LIMIT 1000")
def first_passing(spark, sf):
    """The first thousand passing chats."""
    c = latest(load(spark, sf, "conversations").select("seed_index", "domain", "screening_passed", "ingested_at"), "seed_index")
    return c.filter("screening_passed").orderBy("seed_index").limit(1000).select("seed_index", "domain")


SPLIT = "CASE WHEN left(sha256(concat_ws(':', '5', coalesce(family_id, ''))), 1) = '0' THEN 'validation' ELSE 'train' END"


@query("split_shuffle", f"SELECT doc_id, {SPLIT} AS split, row_number() OVER (PARTITION BY {SPLIT} ORDER BY {key_sql(9, 'doc_id')}) - 1 AS place FROM documents")
def split_shuffle(spark, sf):
    """A seeded order within each part of a split by family, numbered over all tasks."""
    d = load(spark, sf, "documents").select("doc_id", F.when(F.left(sample_key(5, F.coalesce("family_id", F.lit(""))), F.lit(1)) == "0", "validation").otherwise("train").alias("split"), sample_key(9, F.col("doc_id")).alias("key"))
    return placed(d, ["split"], ["key"]).select("doc_id", "split", "place")


@query("family_members", f"SELECT family_id, seed_index, row_number() OVER (PARTITION BY family_id ORDER BY seed_index) - 1 AS place, count(*) OVER (PARTITION BY family_id) AS size FROM {CONV} WHERE family_id IS NOT NULL")
def family_members(spark, sf):
    """Chats grouped by family: each with its place in its family and the family's size, no family gathered in one place."""
    c = latest(load(spark, sf, "conversations").select("family_id", "seed_index", "ingested_at"), "seed_index").filter("family_id is not null").select("family_id", "seed_index")
    return placed(c, ["family_id"], ["seed_index"]).join(c.groupBy("family_id").agg(F.count("*").alias("size")), "family_id").select("family_id", "seed_index", "place", "size")


@query("kept_seeds", f"WITH k AS (SELECT DISTINCT seed_index FROM conversations WHERE screening_passed UNION SELECT -1) SELECT k.seed_index, s.seed_index IS NOT NULL AS in_group FROM k LEFT JOIN {SEEDS} s ON s.seed_index = k.seed_index")
def kept_seeds(spark, sf):
    """A keep list held against the group it was chosen from: entries outside the group are marked, so a guard can reject them."""
    keep = load(spark, sf, "conversations").filter("screening_passed").select("seed_index").unionByName(spark.range(1).select(F.lit(-1).cast("long").alias("seed_index"))).distinct()
    group = load(spark, sf, "seed_pool").select("seed_index").distinct().withColumn("there", F.lit(True))
    return keep.join(group, "seed_index", "left").select("seed_index", F.coalesce("there", F.lit(False)).alias("in_group"))


@query("list_differences", "(SELECT domain AS value, 'topics' AS only_in FROM topics WHERE domain IS NOT NULL EXCEPT SELECT subject, 'topics' FROM subject_areas) UNION ALL (SELECT source, 'mix_targets' FROM mix_targets EXCEPT SELECT source, 'mix_targets' FROM documents) UNION ALL (SELECT source, 'documents' FROM documents WHERE source IS NOT NULL EXCEPT SELECT source, 'documents' FROM mix_targets)")
def list_differences(spark, sf):
    """Values that one of two lists has and the other has not."""

    def only(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
        return a.filter("value is not null").subtract(b).select("value", F.lit(name).alias("only_in"))

    col = lambda t, c: load(spark, sf, t).select(F.col(c).alias("value"))
    sources = col("documents", "source").distinct()
    return only(col("topics", "domain"), col("subject_areas", "subject"), "topics").unionByName(only(col("mix_targets", "source"), sources, "mix_targets")).unionByName(only(sources, col("mix_targets", "source"), "documents"))


@query("recipe_weights", f"SELECT t.domain, 2 * count(DISTINCT t.topic_id) AS weight, count(DISTINCT t.topic_id) FILTER (p.topic_id IS NOT NULL) AS with_sources FROM topics t LEFT JOIN (SELECT DISTINCT topic_id FROM {PAGES} WHERE fetch_error IS NULL) p USING (topic_id) WHERE t.domain IS NOT NULL GROUP BY t.domain")
def recipe_weights(spark, sf):
    """Each domain's weight in a recipe, two seats a topic, and how many of its topics have a source."""
    p = pages(spark, sf).filter("fetch_error is null").select("topic_id").distinct().withColumn("has", F.lit(True))
    t = load(spark, sf, "topics").filter("domain is not null").select("domain", "topic_id").distinct().join(p, "topic_id", "left")
    return t.groupBy("domain").agg((2 * F.count("*")).alias("weight"), F.count_if(F.coalesce("has", F.lit(False))).alias("with_sources"))


@query("closing_assignment", f"SELECT seed_index, ['short', 'warm', 'plain'][1 + ((row_number() OVER (ORDER BY seed_index) - 1) % 3)] AS style, left({key_sql(21, 'seed_index')}, 1) = '3' AND request_type IS NOT NULL AS closing FROM {SEEDS}")
def closing_assignment(spark, sf):
    """Styles in turn, and a seeded sixteenth of the eligible seeds for a closing line."""
    s = latest(load(spark, sf, "seed_pool").select("seed_index", "request_type", "ingested_at"), "seed_index").select("seed_index", "request_type")
    n = numbered(s, ["seed_index"], "n")
    styles = F.array(*(F.lit(x) for x in ("short", "warm", "plain")))
    return n.select("seed_index", F.element_at(styles, (F.col("n") % 3 + 1).cast("int")).alias("style"), ((F.left(sample_key(21, F.col("seed_index")), F.lit(1)) == "3") & F.col("request_type").isNotNull()).alias("closing"))


def pinned(spark, root: str, repo: str, revision: str, config: str, split: str) -> DataFrame:
    """Rows of one revision, config and split of a benchmark kept under root/repo, partitioned by those three; an empty choice is an error."""
    df = spark.read.parquet(f"{root}/{repo}").filter((F.col("revision") == revision) & (F.col("config") == config) & (F.col("split") == split)).drop("revision", "config", "split")
    if df.isEmpty():
        raise ValueError(f"{repo} has no rows of {revision}, {config}, {split}")
    return df


def subsets(items: DataFrame, wanted: str | None) -> DataFrame:
    """Items of the subsets of a comma-separated list, all without one; a list without any item is an error."""
    names = [x.strip() for x in (wanted or "").split(",") if x.strip()]
    if not names:
        return items
    chosen = items.filter(F.col("subset").isin(names))
    if chosen.isEmpty():
        raise ValueError(f"no items of {wanted}")
    return chosen


def options_and_gold(items: DataFrame, prefix: str, label: str) -> DataFrame:
    """Options out of all columns of a prefix, in the order of the schema, and the place of the column whose suffix the label names, one-based labels against zero-based places."""
    columns = [c for c in items.columns if c.startswith(prefix)]
    suffixes = F.array(*(F.lit(c[len(prefix) :]) for c in columns))
    place = F.array_position(suffixes, (F.col(label).cast("int") + 1).cast("string"))
    return items.withColumn("options", F.array(*columns)).withColumn("gold", F.when(place > 0, place - 1))


@query("suffix_gold", "SELECT item_no, CASE WHEN gold_index BETWEEN 0 AND 4 THEN gold_index END AS gold, CASE WHEN gold_index BETWEEN 0 AND 4 THEN choices[gold_index + 1] END AS answer FROM mcq_items")
def suffix_gold(spark, sf):
    """Wide items with a column an option: the gold option found through the suffix of its column."""
    i = load(spark, sf, "mcq_items")
    wide = i.select("item_no", "gold_index", *(F.get("choices", F.lit(k)).alias(f"sol{k + 1}") for k in range(5)))
    g = options_and_gold(wide, "sol", "gold_index")
    return g.select("item_no", F.col("gold").cast("int").alias("gold"), F.get("options", F.col("gold").cast("int")).alias("answer"))


@query("subset_items", "SELECT item_no, choices IS NOT NULL AND len(choices) > 0 AS with_system_prompt, CASE WHEN choices IS NOT NULL AND len(choices) > 0 THEN 'Answer with one letter.' ELSE 'Answer in a sentence.' END AS system_prompt FROM mcq_items WHERE subset IN (SELECT subset FROM mcq_items GROUP BY subset ORDER BY subset LIMIT 3)")
def subset_items(spark, sf):
    """Items of three subsets named in a list, with the system prompt that fits their options."""
    i = load(spark, sf, "mcq_items")
    names = ",".join(r.subset for r in i.filter("subset is not null and not contains(subset, ',')").select("subset").distinct().orderBy("subset").limit(3).collect())
    has = F.coalesce(F.size("choices") > 0, F.lit(False))
    return subsets(i, names).select("item_no", has.alias("with_system_prompt"), F.when(has, "Answer with one letter.").otherwise("Answer in a sentence.").alias("system_prompt"))


@query("generation_prompts", f"SELECT topic_id, 'Question: ' || questions[1] || chr(10) || 'Context: ' || coalesce(c.content, '') || chr(10) || 'Answer:' AS prompt FROM topics t LEFT JOIN (SELECT topic_id, arg_min(content, page_id) AS content FROM {PAGES} WHERE content IS NOT NULL GROUP BY topic_id) c USING (topic_id) WHERE len(questions) > 0")
def generation_prompts(spark, sf):
    """A question with the first snippet of its topic as context."""
    c = pages(spark, sf).filter("content is not null").groupBy("topic_id").agg(F.min_by("content", "page_id").alias("content"))
    t = load(spark, sf, "topics").filter(F.size("questions") > 0).join(c, "topic_id", "left")
    return t.select("topic_id", F.concat(F.lit("Question: "), F.col("questions")[0], F.lit("\nContext: "), F.coalesce("content", F.lit("")), F.lit("\nAnswer:")).alias("prompt"))


def tool_arguments(arguments: Column) -> Column:
    """Arguments of a tool call as JSON text; none become an empty object."""
    return F.coalesce(F.when(F.trim(arguments) != "", arguments), F.lit("{}"))


@query("tool_calls", "SELECT event_id, event_type AS name, CASE WHEN trim(coalesce(props, '')) <> '' THEN props ELSE '{}' END AS arguments FROM events")
def tool_calls(spark, sf):
    return load(spark, sf, "events").select("event_id", F.col("event_type").alias("name"), tool_arguments(F.col("props")).alias("arguments"))


@query("address_parts", f"SELECT page_id, string_split(regexp_replace(url, '^[a-z]+://', ''), '/')[1] AS provider, nullif(split_part(regexp_replace(url, '^[a-z]+://', ''), '/', 2), '') AS service FROM {PAGES} WHERE url IS NOT NULL")
def address_parts(spark, sf):
    """The first two of at most three parts of a specification with slashes; the rest stays whole."""
    parts = F.split(F.regexp_replace("url", "^[a-z]+://", ""), "/", 3)
    return pages(spark, sf).filter("url is not null").select("page_id", parts[0].alias("provider"), F.nullif(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), F.lit("")).alias("service"))
