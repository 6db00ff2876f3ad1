"""Quotas, samples, splits and the planning of seeds."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marsad.functions import text as T
from marsad.operators.ordering import apportion, family_split, numbered, placed, sample_key
from marsad.plans.catalog import query
from marsad.plans.similar import SEEDS
from marsad.tables import latest, load

KEY = "sha256(concat_ws(':', '{seed}', {c}::varchar))"


def key_sql(seed: int, c: str) -> str:
    return KEY.format(seed=seed, c=c)


@query(
    "apportion_quota",
    """WITH w AS (SELECT coalesce(domain, 'general') AS key, count(*)::double AS weight FROM topics GROUP BY 1),
    p AS (SELECT key, 500 * weight / sum(weight) OVER () AS raw FROM w),
    q AS (SELECT key, floor(raw) AS base, raw - floor(raw) AS rest FROM p)
    SELECT key, (base + (row_number() OVER (ORDER BY rest DESC, key) <= 500 - sum(base) OVER ())::int)::bigint AS quota FROM q""",
)
def apportion_quota(spark, sf):
    """500 seats over the domains by their topics."""
    w = load(spark, sf, "topics").groupBy(F.coalesce("domain", F.lit("general")).alias("key")).agg(F.count("*").cast("double").alias("weight"))
    return apportion(w, 500)


@query("cyclic_assignment", "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) AS place, ['brief', 'steps', 'table', 'example'][1 + ((row_number() OVER (ORDER BY doc_id) - 1) % 4)] AS style FROM documents")
def cyclic_assignment(spark, sf):
    """Number all documents and give them styles in turn."""
    d = numbered(load(spark, sf, "documents").select("doc_id"), ["doc_id"], "place")
    styles = F.array(*(F.lit(x) for x in ("brief", "steps", "table", "example")))
    return d.select("doc_id", "place", F.element_at(styles, (F.col("place") % 4 + 1).cast("int")).alias("style"))


@query("sampled_entries", f"SELECT subset, item_no FROM mcq_items QUALIFY row_number() OVER (PARTITION BY subset ORDER BY {key_sql(7, 'item_no')}, item_no) <= 10")
def sampled_entries(spark, sf):
    """A seeded sample of at most ten items of every subset."""
    k = sample_key(7, F.col("item_no"))
    w = Window.partitionBy("subset").orderBy(k, "item_no")
    return load(spark, sf, "mcq_items").withColumn("r", F.row_number().over(w)).filter("r <= 10").select("subset", "item_no")


@query("seeded_shuffle_limit", f"SELECT doc_id, {key_sql(42, 'doc_id')} AS shuffle_key FROM documents ORDER BY shuffle_key LIMIT 200")
def seeded_shuffle_limit(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", sample_key(42, F.col("doc_id")).alias("shuffle_key"))
    return d.orderBy("shuffle_key").limit(200)


@query(
    "family_split_hash",
    f"""WITH f AS (SELECT DISTINCT family_id AS family FROM messages WHERE family_id IS NOT NULL),
    r AS (SELECT family, row_number() OVER (ORDER BY {key_sql(42, 'family')}) - 1 AS place, count(*) OVER () AS n FROM f)
    SELECT family, CASE WHEN place < CASE WHEN n > 1 THEN greatest(1, round_even(n * 0.05, 0)) ELSE 0 END THEN 'validation' ELSE 'train' END AS split FROM r""",
)
def family_split_hash(spark, sf):
    return family_split(load(spark, sf, "messages"), "family_id", 0.05, 42)


@query(
    "family_split_rank",
    """WITH f AS (SELECT DISTINCT family_id FROM documents WHERE family_id IS NOT NULL),
    r AS (SELECT family_id, row_number() OVER (ORDER BY family_id) - 1 AS i, count(*) OVER () AS n FROM f),
    s AS (SELECT family_id, CASE WHEN i < n * 0.05 THEN 'test' WHEN i < n * 0.1 THEN 'validation' ELSE 'train' END AS split FROM r)
    SELECT split, count(*) AS documents, count(DISTINCT family_id) AS families FROM documents JOIN s USING (family_id) GROUP BY split""",
)
def family_split_rank(spark, sf):
    """Sizes of a split by the rank of the family; a family never falls into two parts."""
    d = load(spark, sf, "documents").filter("family_id is not null")
    f = d.select("family_id").distinct()
    ranked = numbered(f, ["family_id"], "i").join(F.broadcast(f.agg(F.count("*").alias("n"))))
    split = F.when(F.col("i") < F.col("n") * 0.05, "test").when(F.col("i") < F.col("n") * 0.1, "validation").otherwise("train")
    sizes = d.groupBy("family_id").count()
    return sizes.join(ranked.select("family_id", split.alias("split")), "family_id").groupBy("split").agg(F.sum("count").alias("documents"), F.count("*").alias("families"))


@query(
    "split_leakage",
    f"""WITH f AS (SELECT DISTINCT family_id AS family FROM messages WHERE family_id IS NOT NULL),
    r AS (SELECT family, row_number() OVER (ORDER BY {key_sql(42, 'family')}) - 1 AS place, count(*) OVER () AS n FROM f),
    s AS (SELECT family, place < greatest(1, round_even(n * 0.05, 0)) AS held FROM r)
    SELECT count(*) FILTER (held) AS held_messages, count(*) FILTER (NOT held) AS train_messages,
    (SELECT count(*) FROM (SELECT family FROM s WHERE held INTERSECT SELECT family FROM s WHERE NOT held)) AS families_in_both
    FROM (SELECT DISTINCT message_id, family_id FROM messages) m JOIN s ON s.family = m.family_id""",
)
def split_leakage(spark, sf):
    """Sizes of both parts of a family split and the families that fall into both, which must be none."""
    m = load(spark, sf, "messages").select("message_id", "family_id").dropDuplicates(["message_id"])
    s = family_split(m, "family_id", 0.05, 42)
    held, train = s.filter("split = 'validation'"), s.filter("split = 'train'")
    both = held.join(train, "family", "left_semi").agg(F.count("*").alias("families_in_both"))
    sizes = m.groupBy(F.col("family_id").alias("family")).count().join(s, "family")
    n = sizes.agg(F.sum(F.when(F.col("split") == "validation", F.col("count"))).alias("held_messages"), F.sum(F.when(F.col("split") == "train", F.col("count"))).alias("train_messages"))
    return n.join(both)


@query(
    "diversity_gate",
    f"""WITH t AS (SELECT topic_id, count(*) AS n FROM {SEEDS} WHERE topic_id IS NOT NULL GROUP BY topic_id)
    SELECT max(n) AS most_per_topic, count(*) AS topics, sum(n)::bigint AS seeds, count(*) / sum(n) AS distinct_share,
    (SELECT count(*) FROM {SEEDS} s WHERE topic_id IS NULL OR topic_id NOT IN (SELECT topic_id FROM topics)) AS unknown_topic FROM t""",
)
def diversity_gate(spark, sf):
    s = latest(load(spark, sf, "seed_pool"), "seed_index")
    t = s.filter("topic_id is not null").groupBy("topic_id").agg(F.count("*").alias("n"))
    unknown = s.join(load(spark, sf, "topics").select("topic_id"), "topic_id", "left_anti").agg(F.count("*").alias("unknown_topic"))
    return t.agg(F.max("n").alias("most_per_topic"), F.count("*").alias("topics"), F.sum("n").alias("seeds"), (F.count("*") / F.sum("n")).alias("distinct_share")).join(unknown)


@query(
    "topic_questions",
    f"""SELECT topic_id, q AS question, row_number() OVER (ORDER BY topic_id, i) - 1 AS seed, {T.word_count_sql('q')} AS words
    FROM (SELECT topic_id, unnest(questions) AS q, generate_subscripts(questions, 1) AS i FROM topics) WHERE {T.word_count_sql('q')} BETWEEN 2 AND 18""",
)
def topic_questions(spark, sf):
    """One row per question of 2 to 18 words of a topic, numbered in order."""
    q = load(spark, sf, "topics").select("topic_id", F.posexplode("questions").alias("i", "question")).withColumn("words", T.word_count(F.col("question"))).filter("words between 2 and 18")
    return numbered(q, ["topic_id", "i"], "seed").select("topic_id", "question", "seed", "words")


@query("ready_topics", "SELECT topic_id, coalesce(len(allowed_domains), 0) = 0 OR EXISTS (SELECT 1 FROM evidence_pages e WHERE e.topic_id = t.topic_id AND e.fetch_error IS NULL) AS ready FROM topics t")
def ready_topics(spark, sf):
    """A topic is ready without allowed domains or with a page that was fetched."""
    pages = load(spark, sf, "evidence_pages").filter("fetch_error is null").select("topic_id").distinct().withColumn("has", F.lit(True))
    return load(spark, sf, "topics").join(pages, "topic_id", "left").select("topic_id", ((F.coalesce(F.size("allowed_domains"), F.lit(0)) <= 0) | F.coalesce("has", F.lit(False))).alias("ready"))


@query(
    "theta_reference_match",
    """WITH t AS (SELECT DISTINCT topic_id, domain, request_type FROM topics), m AS (SELECT t.topic_id, r.id FROM t JOIN hybrid_references r ON r.domain = t.domain OR r.request_type = t.request_type),
    a AS (SELECT * FROM m UNION ALL SELECT t.topic_id, r.id FROM t, hybrid_references r WHERE t.topic_id NOT IN (SELECT topic_id FROM m))
    SELECT topic_id, count(DISTINCT id) AS n_references, min(id) AS first_reference FROM a GROUP BY topic_id""",
)
def theta_reference_match(spark, sf):
    """References of the same domain or request type, and all of them for a topic without any.

    The OR is two equi-joins and a union; the fallback needs only the totals of the whole library.
    """
    t = load(spark, sf, "topics").select("topic_id", "domain", "request_type").distinct()
    r = load(spark, sf, "hybrid_references").select("id", "domain", "request_type")
    met = t.select("topic_id", "domain").join(r.select("id", "domain"), "domain").select("topic_id", "id").unionByName(t.select("topic_id", "request_type").join(r.select("id", "request_type"), "request_type").select("topic_id", "id")).distinct()
    per = met.groupBy("topic_id").agg(F.count("*").alias("n"), F.min("id").alias("f"))
    whole = r.agg(F.count_distinct("id").alias("all_n"), F.min("id").alias("all_f"))
    return t.select("topic_id").distinct().join(per, "topic_id", "left").join(F.broadcast(whole)).select("topic_id", F.coalesce("n", "all_n").alias("n_references"), F.coalesce("f", "all_f").alias("first_reference"))


@query(
    "baseline_left_join",
    f"""WITH b AS (SELECT {T.normalized_sql('first_question')} AS norm, seed_index, row_number() OVER (PARTITION BY {T.normalized_sql('first_question')} ORDER BY seed_index DESC) AS r FROM conversations WHERE first_question IS NOT NULL)
    SELECT s.seed_index, b.seed_index AS baseline FROM {SEEDS} s LEFT JOIN (SELECT DISTINCT norm, seed_index FROM b WHERE r = 1) b ON b.norm = {T.normalized_sql('s.question')}""",
)
def baseline_left_join(spark, sf):
    """Every seed with the last conversation of the same normalized question, if any."""
    s = latest(load(spark, sf, "seed_pool").select("seed_index", "question", "ingested_at"), "seed_index").select("seed_index", T.normalized(F.col("question")).alias("norm"))
    b = load(spark, sf, "conversations").filter("first_question is not null").groupBy(T.normalized(F.col("first_question")).alias("norm")).agg(F.max("seed_index").alias("baseline"))
    return s.join(b, "norm", "left").select("seed_index", "baseline")


@query(
    "seed_plan",
    f"""WITH w AS (SELECT domain AS key, count(*)::double AS weight FROM topics WHERE domain IS NOT NULL GROUP BY 1),
    p AS (SELECT key, 300 * weight / sum(weight) OVER () AS raw FROM w), q AS (SELECT key, floor(raw) AS base, raw - floor(raw) AS rest FROM p),
    a AS (SELECT key, (base + (row_number() OVER (ORDER BY rest DESC, key) <= 300 - sum(base) OVER ())::int)::bigint AS quota FROM q),
    s AS (SELECT domain, seed_index, row_number() OVER (PARTITION BY domain ORDER BY {key_sql(3, 'seed_index')}) AS r FROM {SEEDS} WHERE domain IS NOT NULL)
    SELECT s.domain, s.seed_index, s.r - 1 AS ordinal, ['short', 'long', 'mixed'][1 + ((s.r - 1) % 3)] AS depth FROM s JOIN a ON a.key = s.domain WHERE s.r <= a.quota""",
)
def seed_plan(spark, sf):
    """Quota-planned seeds: seats by domain, a seeded choice within it, depths in turn."""
    w = load(spark, sf, "topics").filter("domain is not null").groupBy(F.col("domain").alias("key")).agg(F.count("*").cast("double").alias("weight"))
    quota = apportion(w, 300).select(F.col("key").alias("domain"), "quota")
    s = latest(load(spark, sf, "seed_pool").select("domain", "seed_index", "ingested_at"), "seed_index").filter("domain is not null")
    # all seeds are numbered over all tasks, so no domain is ranked in one
    r = placed(s.select("domain", "seed_index", sample_key(3, F.col("seed_index")).alias("key")), ["domain"], ["key"])
    depths = F.array(*(F.lit(x) for x in ("short", "long", "mixed")))
    return r.join(F.broadcast(quota), "domain").filter("place < quota").select("domain", "seed_index", F.col("place").alias("ordinal"), F.element_at(depths, (F.col("place") % 3 + 1).cast("int")).alias("depth"))
