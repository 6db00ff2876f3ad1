import random

from marsad.operators.ordering import apportion, family_split, numbered
from marsad.operators.similarity import equal_pairs, greedy_novel, jaccard_classes
from marsad.tables import latest


def test_jaccard_classes_against_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    sets = []
    for k in range(30):
        base = set(rng.sample(words, 12))
        sets += [base, (base - {next(iter(base))}) | {rng.choice(words)}]
    rows = [(i, sorted(s)) for i, s in enumerate(sets)] + [(900, []), (901, None), (902, ["only"]), (903, ["only"])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    full = [(i, set(s)) for i, s in rows if s]
    reps = {i: min(j for j, u in full if u == s) for i, s in full}
    for t in (0.5, 0.72, 1.0):
        c = jaccard_classes(df, t)
        assert {(r.id, r.rep) for r in c.members.collect()} == set(reps.items())
        assert {(r.a, r.b) for r in c.links.collect()} == {(i, j) for i, s in full for j, u in full if i < j and i == reps[i] and j == reps[j] and len(s & u) >= t * len(s | u) - 1e-12}
        assert (902, 903) in {(r.a, r.b) for r in c.pairs().collect()}


def test_many_copies_of_one_set_give_linear_rows(spark):
    from pyspark.sql import functions as F

    near = [f"w{i}" for i in range(20)]
    copies = spark.range(50_000).select("id", F.array(*(F.lit(w) for w in near)).alias("tokens"))
    others = spark.createDataFrame([(60_000, near[:-1]), (60_001, near[:-1]), (60_002, ["far"])], "id long, tokens array<string>")
    c = jaccard_classes(copies.unionByName(others), 0.72)
    assert c.links.count() == 1 and c.pairs().count() == 49_999 + 1 + 1 and c.members.count() == 50_003


def test_equal_pairs_link_copies_to_the_first(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (4, None), (5, None)], "id long, value string")
    assert {(r.a, r.b) for r in equal_pairs(df).collect()} == {(1, 2), (1, 3)}


def test_greedy_novelty_equals_the_sequential_rule(spark):
    rng = random.Random(5)
    for _ in range(3):
        n = 40
        edges = {tuple(sorted(rng.sample(range(n), 2))) for _ in range(70)}
        kept = []
        for i in range(n):
            if not any((j, i) in edges for j in kept):
                kept.append(i)
        nodes = spark.createDataFrame([(i,) for i in range(n)], "id long")
        e = spark.createDataFrame(sorted(edges), "a long, b long")
        assert sorted(r.id for r in greedy_novel(nodes, e).collect()) == kept
    assert greedy_novel(nodes, e.limit(0)).count() == n


def test_apportion(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 1.0), ("d", None), ("e", -5.0)], "key string, weight double")
    assert {r.key: r.quota for r in apportion(df, 10).collect()} == {"a": 4, "b": 3, "c": 3, "d": 0, "e": 0}
    assert {r.quota for r in apportion(df.filter("key = 'd'"), 10).collect()} == {0}
    assert apportion(df.limit(0), 10).count() == 0


def test_numbered_over_many_partitions(spark):
    df = spark.range(0, 1000).selectExpr("id * 37 % 1000 AS k").repartition(7)
    assert sorted((r.n, r.k) for r in numbered(df, ["k"], "n").collect()) == [(i, i) for i in range(1000)]
    assert numbered(df.limit(0), ["k"], "n").count() == 0


def test_family_split_is_stable_and_disjoint(spark):
    df = spark.createDataFrame([(f"f{i % 40}",) for i in range(400)] + [(None,)], "fam string")
    one = {r.family: r.split for r in family_split(df, "fam", 0.1, 42).collect()}
    assert len(one) == 40 and sum(s == "validation" for s in one.values()) == 4
    assert one == {r.family: r.split for r in family_split(df.repartition(5), "fam", 0.1, 42).collect()}
    assert {r.split for r in family_split(df.filter("fam = 'f1'"), "fam", 0.5, 42).collect()} == {"train"}


def test_latest_delivery_counts(spark):
    df = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "only", 5), (None, "n", 1)], "k long, v string, ingested_at int")
    assert {(r.k, r.v) for r in latest(df, "k").collect()} == {(1, "new"), (2, "only"), (None, "n")}
    assert latest(df.limit(0), "k").count() == 0
