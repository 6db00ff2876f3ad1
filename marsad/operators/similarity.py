"""Set-similarity joins as DataFrame programs, with a prefix filter on the rarest tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marsad.session import cut


class Close:
    """Similar sets: ``members`` (id, rep), rep being the smallest id with an equal set, and ``links`` (a, b, similarity), a < b, of reps.

    Copies of one set are held by their rep, so rows grow with the documents however many copies there are.
    """

    def __init__(self, members: DataFrame, links: DataFrame):
        self.members, self.links = members, links

    def both_ways(self) -> DataFrame:
        """(rep, other) of each link in both directions, and of each rep with itself."""
        l = self.links
        own = self.members.select("rep").distinct().select("rep", F.col("rep").alias("other"))
        return l.select(F.col("a").alias("rep"), F.col("b").alias("other")).unionByName(l.select(F.col("b").alias("rep"), F.col("a").alias("other"))).unionByName(own)

    def pairs(self) -> DataFrame:
        """(a, b), a < b: the links of reps, and each other member with its rep."""
        star = self.members.filter("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
        return self.links.select("a", "b").unionByName(star)


def jaccard_classes(df: DataFrame, threshold: float) -> Close:
    """(id, tokens: array of distinct strings, or of their 64-bit hashes) -> sets at or above a threshold > 0.

    Sets are held as sorted 64-bit hashes, cut and stored once; equal sets collapse first. Tokens are
    ordered by how many sets have them; two similar sets share one of their rarest n - ceil(t * n) + 1
    tokens, so only those meet, and survivors are compared on their whole sets. Null and empty sets
    meet nothing and are no members. Ids must be unique.
    """
    strings = df.schema["tokens"].dataType.elementType.typeName() == "string"
    hashed = F.sort_array(F.transform("tokens", lambda t: F.xxhash64(t)) if strings else F.col("tokens"))
    base = df.filter(F.size("tokens") > 0).select("id", hashed.alias("tokens")).withColumn("n", F.size("tokens"))
    base = cut(base.withColumn("h", F.xxhash64("tokens")).withColumn("g", F.xxhash64(F.lit(1), "tokens")))
    key = ["n", "h", "g"]
    reps = base.groupBy(*key).agg(F.min("id").alias("rep"))
    members = cut(base.select("id", *key).join(reps, key).select("id", "rep"))
    sets = base.join(reps.select(F.col("rep").alias("id")), "id", "left_semi").select("id", "n", "tokens")
    exploded = sets.select("id", "n", F.explode("tokens").alias("token"))
    counts = exploded.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    # tokens of a single set stand first in any order and meet nothing: only their number matters
    shared = exploded.join(counts, "token")
    place = F.row_number().over(Window.partitionBy("id").orderBy("df", "token"))
    total = F.count("*").over(Window.partitionBy("id"))
    ranked = shared.select("id", "n", "token", (place + F.col("n") - total).alias("pos"))
    prefix = cut(ranked.filter(F.col("pos") <= F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1))
    x = prefix.select("token", F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("pos").alias("p_a"))
    y = prefix.select("token", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("pos").alias("p_b"))
    needed = F.ceil(F.lit(threshold / (1 + threshold)) * (F.col("n_a") + F.col("n_b")) - 1e-9)
    met = (
        x.join(y, "token")
        .filter("a < b")
        .filter((F.col("n_a") >= threshold * F.col("n_b") - 1e-9) & (F.col("n_b") >= threshold * F.col("n_a") - 1e-9))
        .filter(F.least(F.col("n_a") - F.col("p_a"), F.col("n_b") - F.col("p_b")) + 1 >= needed)
        .select("a", "b")
        .distinct()
    )
    one, two = sets.select(F.col("id").alias("a"), F.col("tokens").alias("s")), sets.select(F.col("id").alias("b"), F.col("tokens").alias("t"))
    both = F.size(F.array_intersect("s", "t"))
    scored = met.join(one, "a").join(two, "b").select("a", "b", (both / (F.size("s") + F.size("t") - both)).alias("similarity"))
    return Close(members, cut(scored.filter(F.col("similarity") >= threshold - 1e-12)))


def equal_pairs(df: DataFrame) -> DataFrame:
    """(id, value) -> (a, b): every row with the smallest id of an equal value, a < b; null values meet nothing."""
    first = df.filter("value is not null").groupBy("value").agg(F.min("id").alias("a"))
    return df.join(first, "value").filter("id > a").select("a", F.col("id").alias("b"))


def greedy_novel(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Accept rows in order of id unless an accepted earlier row is joined to them by an edge (a < b).

    The result is that of the sequential rule, found in rounds: a row with no undecided or accepted
    earlier neighbour is accepted, its later neighbours are rejected. Each round is cut to the
    checkpoint folder; the rounds end when no row is undecided.
    """
    edges = cut(edges.select("a", "b").distinct())
    undecided = cut(edges.select(F.col("b").alias("id")).distinct())
    rejected = None
    while True:
        open_edges = edges.join(undecided.withColumnRenamed("id", "b"), "b", "left_semi")
        if rejected is not None:
            open_edges = open_edges.join(rejected.withColumnRenamed("id", "a"), "a", "left_anti")
        waiting = open_edges.join(undecided.withColumnRenamed("id", "a"), "a", "left_semi").select(F.col("b").alias("id")).distinct()
        hit = open_edges.join(undecided.withColumnRenamed("id", "a"), "a", "left_anti").select(F.col("b").alias("id")).distinct()
        rejected = cut(hit if rejected is None else rejected.unionByName(hit).distinct())
        undecided = cut(undecided.join(rejected, "id", "left_anti").join(waiting, "id", "left_semi"))
        if undecided.isEmpty():
            return nodes.join(rejected, "id", "left_anti")
