"""Clones, repetitions, duplicates, overlaps and novelty."""

from __future__ import annotations

from pyspark.sql import functions as F

from marsad.functions import text as T
from marsad.operators.ordering import numbered
from marsad.operators.similarity import equal_pairs, greedy_novel, jaccard_classes
from marsad.plans.catalog import query
from marsad.tables import latest, load, role

THRESHOLD = 0.72


def close_sql(rows: str, words: str, n: int = 5, threshold: float = THRESHOLD, within: str = "") -> str:
    """The sets of ``rows`` (id, ...), their classes ``k`` (id, rep, copies) and all similar pairs ``j`` (a, b) of reps."""
    both = f"AND x.{within} = y.{within}" if within else ""
    keep = f", {within}" if within else ""
    return f"""d AS ({rows}), g AS (SELECT id{keep}, list_sort({T.shingles_sql('w', n)}) AS s FROM (SELECT *, {words} AS w FROM d)),
k AS MATERIALIZED (SELECT id, min(id) OVER (PARTITION BY s{keep}) AS rep, count(*) OVER (PARTITION BY s{keep}) AS copies, s{keep} FROM g WHERE len(s) > 0),
q AS (SELECT * FROM k WHERE id = rep), e AS (SELECT id{keep}, unnest(s) AS gram FROM q),
i AS (SELECT x.id AS a, y.id AS b, count(*) AS hits FROM e x JOIN e y ON x.gram = y.gram AND x.id < y.id {both} GROUP BY ALL),
j AS MATERIALIZED (SELECT a, b FROM i JOIN q u ON u.id = a JOIN q v ON v.id = b WHERE hits / (len(u.s) + len(v.s) - hits) >= {threshold}),
z AS (SELECT a AS rep, b AS other FROM j UNION ALL SELECT b, a FROM j UNION ALL SELECT rep, rep FROM q)"""


DOCS = "WITH " + close_sql("SELECT doc_id AS id, text, created_at FROM documents WHERE text IS NOT NULL", T.words_sql("text"))


def documents(spark, sf):
    return load(spark, sf, "documents").filter("text is not null").select(F.col("doc_id").alias("id"), "text", "source", "created_at")


def close_documents(spark, sf):
    return jaccard_classes(T.with_hashed_runs(documents(spark, sf), F.col("text"), 5, "tokens"), THRESHOLD)


@query(
    "clone_pairs",
    DOCS + f""", f AS (SELECT {T.normalized_sql('text')} AS norm, min(id) AS a FROM d GROUP BY norm)
    SELECT a AS doc_a, b AS doc_b FROM j UNION SELECT rep, id FROM k WHERE id <> rep UNION SELECT f.a, d.id FROM d JOIN f ON f.norm = {T.normalized_sql('d.text')} WHERE d.id > f.a""",
)
def clone_pairs(spark, sf):
    """Pairs by Jaccard of five-word runs between the first documents of equal sets, each copy with its first one; equal normalized texts meet their first copy."""
    equal = equal_pairs(documents(spark, sf).select("id", T.normalized(F.col("text")).alias("value")))
    return close_documents(spark, sf).pairs().unionByName(equal).distinct().select(F.col("a").alias("doc_a"), F.col("b").alias("doc_b"))


@query("clone_flags", DOCS + " SELECT k.id AS doc_id, sum(o.copies)::bigint - 1 AS n_similar FROM k JOIN z ON z.rep = k.rep JOIN (SELECT DISTINCT rep, copies FROM k) o ON o.rep = z.other GROUP BY k.id HAVING sum(o.copies) > 1")
def clone_flags(spark, sf):
    """How many other documents are similar to each document, counted over classes without forming their pairs."""
    c = close_documents(spark, sf)
    sizes = c.members.groupBy("rep").agg(F.count("*").alias("copies"))
    similar = c.both_ways().join(sizes.toDF("other", "copies"), "other").groupBy("rep").agg((F.sum("copies") - 1).alias("n_similar")).filter("n_similar > 0")
    return c.members.join(similar, "rep").select(F.col("id").alias("doc_id"), "n_similar")


CLOSE = "WITH " + close_sql(f"SELECT doc_id AS id, created_at, text FROM documents WHERE text IS NOT NULL AND {T.word_count_sql('text')} >= 40", T.words_sql("regexp_replace(text, '" + T.MARKDOWN_LINK + "', '\\1', 'g')"))


def long_close(spark, sf):
    d = documents(spark, sf).filter(T.word_count(F.col("text")) >= 40)
    return d, jaccard_classes(T.with_hashed_runs(d, T.without_links(F.col("text")), 5, "tokens"), THRESHOLD)


@query("repetition_first_wins", CLOSE + " SELECT k.id AS doc_id, min(z.other) AS first_doc FROM k JOIN z USING (rep) GROUP BY k.id HAVING min(z.other) < k.id")
def repetition_first_wins(spark, sf):
    """Long texts that repeat an earlier one; the earlier one stays."""
    _, c = long_close(spark, sf)
    first = c.both_ways().groupBy("rep").agg(F.min("other").alias("first_doc"))
    return c.members.join(first, "rep").filter("first_doc < id").select(F.col("id").alias("doc_id"), "first_doc")


@query("cross_batch_rejects", CLOSE + ", t AS (SELECT rep, min(created_at::date) AS day FROM k JOIN d USING (id) GROUP BY rep), e2 AS (SELECT z.rep, min(t.day) AS day FROM z JOIN t ON t.rep = z.other GROUP BY z.rep) SELECT k.id AS doc_id FROM k JOIN d USING (id) JOIN e2 ON e2.rep = k.rep WHERE d.created_at::date > e2.day")
def cross_batch_rejects(spark, sf):
    """Of similar rows from different days, all after the first day are rejected."""
    d, c = long_close(spark, sf)
    dated = c.members.join(d.select("id", F.to_date("created_at").alias("day")), "id")
    first = dated.groupBy("rep").agg(F.min("day").alias("day"))
    earliest = c.both_ways().join(first.toDF("other", "first_day"), "other").groupBy("rep").agg(F.min("first_day").alias("first_day"))
    return dated.join(earliest, "rep").filter("day > first_day").select(F.col("id").alias("doc_id"))


@query("exact_duplicates", "SELECT doc_id, sha256(text) AS sha, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) - 1 AS earlier FROM documents WHERE text <> '' QUALIFY earlier > 0")
def exact_duplicates(spark, sf):
    """Rows whose text was seen under a smaller id, with how many came before.

    Hashes that occur once stay out; the others are numbered over all tasks in order of (hash, id), and
    a row's number less its hash's first number is its place, so no hash is ranked in one task.
    """
    d = load(spark, sf, "documents").filter("text <> ''").select("doc_id", T.digest(F.col("text")).alias("sha"))
    repeated = d.groupBy("sha").count().filter("count > 1").select("sha")
    n = numbered(d.join(repeated, "sha"), ["sha", "doc_id"], "n")
    first = n.groupBy("sha").agg(F.min("n").alias("first"))
    return n.join(first, "sha").select("doc_id", "sha", (F.col("n") - F.col("first")).alias("earlier")).filter("earlier > 0")


SEEDS = "(SELECT * FROM seed_pool QUALIFY row_number() OVER (PARTITION BY seed_index ORDER BY ingested_at DESC) = 1)"


@query("normalized_duplicates", f"SELECT norm, count(*) AS n_seeds, min(seed_index) AS first_seed FROM (SELECT seed_index, {T.normalized_sql('question')} AS norm FROM {SEEDS} WHERE question IS NOT NULL) GROUP BY norm HAVING count(*) > 1")
def normalized_duplicates(spark, sf):
    s = latest(load(spark, sf, "seed_pool").select("seed_index", "question", "ingested_at"), "seed_index").filter("question is not null")
    return s.groupBy(T.normalized(F.col("question")).alias("norm")).agg(F.count("*").alias("n_seeds"), F.min("seed_index").alias("first_seed")).filter("n_seeds > 1")


#: Runs of so many words count as copied. The given tables share runs of eight words with references, and none of twelve.
COPIED = 8


@query(
    "reference_overlap",
    f"""WITH m AS (SELECT DISTINCT message_id, content FROM messages WHERE lower(trim(role)) = 'assistant' AND content IS NOT NULL),
    a AS (SELECT message_id, unnest({T.shingles_sql('w', COPIED)}) AS gram FROM (SELECT message_id, {T.words_sql('content')} AS w FROM m)),
    r AS (SELECT DISTINCT id, unnest({T.shingles_sql('w', COPIED)}) AS gram FROM (SELECT id, {T.words_sql('assistant')} AS w FROM hybrid_references WHERE assistant IS NOT NULL))
    SELECT message_id, r.id AS reference_id, count(*) AS n_shared FROM a JOIN r USING (gram) GROUP BY ALL""",
)
def reference_overlap(spark, sf):
    """Answers that share a run of words with a style reference."""
    m = load(spark, sf, "messages").filter((role() == "assistant") & F.col("content").isNotNull()).select("message_id", "content").dropDuplicates(["message_id"])
    a = T.with_shingles(m, F.col("content"), COPIED, "grams").select("message_id", F.explode("grams").alias("gram"))
    r = T.with_shingles(load(spark, sf, "hybrid_references").filter("assistant is not null"), F.col("assistant"), COPIED, "grams").select(F.col("id").alias("reference_id"), F.explode("grams").alias("gram")).distinct()
    return a.join(r, "gram").groupBy("message_id", "reference_id").agg(F.count("*").alias("n_shared"))


NOVEL = f"""WITH RECURSIVE n AS (SELECT min(seed_index) AS id, value FROM (SELECT seed_index, {T.normalized_sql('question')} AS value FROM {SEEDS} WHERE question IS NOT NULL) WHERE value <> '' GROUP BY value),
s AS (SELECT id, list_distinct(string_split(value, ' ')) AS s FROM n), e AS (SELECT id, unnest(s) AS w FROM s),
i AS (SELECT x.id AS a, y.id AS b, count(*) AS hits FROM e x JOIN e y ON x.w = y.w AND x.id < y.id GROUP BY ALL),
j AS MATERIALIZED (SELECT a, b FROM i JOIN s p ON p.id = a JOIN s q ON q.id = b WHERE hits / (len(p.s) + len(q.s) - hits) >= 0.8),
o AS MATERIALIZED (SELECT id, row_number() OVER (ORDER BY id) AS k FROM (SELECT a AS id FROM j UNION SELECT b FROM j)),
r AS (SELECT 0::bigint AS k, []::bigint[] AS kept UNION ALL
  SELECT r.k + 1, CASE WHEN EXISTS (SELECT 1 FROM j WHERE j.b = o.id AND list_contains(r.kept, j.a)) THEN r.kept ELSE list_append(r.kept, o.id) END FROM r JOIN o ON o.k = r.k + 1),
kept AS (SELECT unnest(kept) AS id FROM r ORDER BY k DESC LIMIT 1)
SELECT id AS seed_index FROM n WHERE id NOT IN (SELECT id FROM o) UNION ALL SELECT unnest(kept) FROM (SELECT kept FROM r ORDER BY k DESC LIMIT 1)"""


@query("novel_seeds", NOVEL)
def novel_seeds(spark, sf):
    """Questions in order that are neither equal to nor 0.8 alike in words with an accepted earlier one."""
    s = latest(load(spark, sf, "seed_pool").select("seed_index", "question", "ingested_at"), "seed_index").filter("question is not null").select(F.col("seed_index").alias("id"), T.normalized(F.col("question")).alias("value"))
    s = s.filter("value <> ''")
    # equal questions collapse to the first one, so the pairs of a hot question never form
    first = s.groupBy("value").agg(F.min("id").alias("id"))
    c = jaccard_classes(first.select("id", F.array_distinct(F.split("value", " ")).alias("tokens")), 0.8)
    # all members of a class share one fate but for the first: whatever rejects it rejects them, and else it does
    return greedy_novel(c.members.select(F.col("rep").alias("id")).distinct(), c.links).select(F.col("id").alias("seed_index"))


@query(
    "near_dup_earlier_answer",
    "WITH " + close_sql("SELECT message_id AS id, any_value(domain) AS domain, any_value(content) AS content FROM messages WHERE lower(trim(role)) = 'assistant' AND content IS NOT NULL AND domain IS NOT NULL GROUP BY message_id", T.words_sql("content"), 5, THRESHOLD, "domain")
    + " SELECT k.id AS message_id, min(z.other) AS first_message FROM k JOIN z USING (rep) GROUP BY k.id HAVING min(z.other) < k.id",
)
def near_dup_earlier_answer(spark, sf):
    """Answers whose runs of five words repeat an earlier answer of their own domain."""
    m = load(spark, sf, "messages").filter((role() == "assistant") & F.col("content").isNotNull() & F.col("domain").isNotNull())
    m = m.select(F.col("message_id").alias("id"), "domain", "content").dropDuplicates(["id"])
    # the domain is part of the token, so a domain of any size is joined on its rarest runs like a corpus
    c = jaccard_classes(T.with_hashed_runs(m, F.col("content"), 5, "tokens", F.col("domain")).select("id", "tokens"), THRESHOLD)
    first = c.both_ways().groupBy("rep").agg(F.min("other").alias("first_message"))
    return c.members.join(first, "rep").filter("first_message < id").select(F.col("id").alias("message_id"), "first_message")
