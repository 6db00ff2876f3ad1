import random

import numpy as np

from marsad.llm import forms, neardup
from marsad.llm.neardup import Spec

SCHEMA = "record_table string, record_key long, text string"


def edited(rng, words, vocabulary, n):
    w = list(words)
    for _ in range(n):
        k = rng.randrange(3)
        p = rng.randrange(len(w))
        if k == 0:
            w[p] = rng.choice(vocabulary)
        elif k == 1:
            w.insert(p, rng.choice(vocabulary))
        else:
            del w[p]
    return w


def make(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)]
    rows = []
    for k in range(25):
        base = rng.choices(vocabulary, k=rng.choice([15, 40, 80]))
        for j in range(rng.choice([1, 2, 4])):
            rows.append(("a" if k % 3 else "b", k * 10 + j, " ".join(edited(rng, base, vocabulary, j))))
    rows += [("a", 900, None), ("a", 901, ""), ("a", 902, "v1 v2"), rows[0], ("a", 903, rows[0][2].upper()), ("c", 1, "no rule for this table")]
    return rows


def brute(rows, specs):
    sets = {}
    for t, k, x in rows:
        if t in specs and x:
            s, w = specs[t], forms.marked_words(x)
            if len(w) >= max(s.min_words, s.run):
                sets[t, k] = {tuple(w[i : i + s.run]) for i in range(len(w) - s.run + 1)}
    return {(t, a, b) for t, a in sets for u, b in sets if t == u and a < b and len(sets[t, a] & sets[u, b]) >= specs[t].threshold * len(sets[t, a] | sets[u, b]) - 1e-9}


def run(spark, rows, specs, **kw):
    return [tuple(r) for r in neardup.record_pairs(neardup.similar(spark.createDataFrame(rows, SCHEMA), specs), **kw).collect()]


def test_against_brute_force(spark):
    rows = make()
    for specs in ({"a": Spec(5, 0.6), "b": Spec(1, 0.7)}, {"a": Spec(), "b": Spec(3, 0.5, 20)}):
        got = run(spark, rows, specs)
        assert len(got) == len(set(got))
        want = brute(rows, specs)
        assert want and set(got) == want


def test_many_copies_come_out_in_linear_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [("a", i, text) for i in range(400)] + [("a", 1000 + i, text + " more") for i in range(3)]
    got = run(spark, rows, {"a": Spec()}, expand_pairs=50)
    assert len(got) < 500 and set(got) <= brute(rows, {"a": Spec()})
    found = neardup.similar(spark.createDataFrame(rows, SCHEMA), {"a": Spec()})
    groups = neardup.clusters(found).collect()
    assert len(groups) == 403 and {r.cluster_key for r in groups} == {0} and {r.class_key for r in groups} == {0, 1000}
    assert {r.n_links for r in groups} == {1}


def test_clusters_are_connected_components(spark):
    rows = make(4)
    specs = {"a": Spec(1, 0.6), "b": Spec(1, 0.6)}
    found = neardup.similar(spark.createDataFrame(rows, SCHEMA), specs)
    got = {(r.record_table, r.record_key): r.cluster_key for r in neardup.clusters(found).collect()}
    best = {k: k[1] for k in got}
    pairs = brute(rows, specs)
    for _ in range(50):
        for t, a, b in pairs:
            best[t, a] = best[t, b] = min(best[t, a], best[t, b])
    assert got == best


def test_empty_table_and_extra_columns(spark):
    assert run(spark, [], {"a": Spec()}) == []
    df = spark.createDataFrame([("a", 1, "a b c d e f", 9, "z"), ("a", 2, "a b c d e f", 9, "z")], SCHEMA + ", code int, whole string")
    assert [tuple(r) for r in neardup.record_pairs(neardup.similar(df, {"a": Spec()})).collect()] == [("a", 1, 2)]
    assert neardup.clusters(neardup.similar(df.limit(0), {"a": Spec()})).count() == 0


def test_long_lists_are_compared_in_blocks(spark, monkeypatch):
    rows = make(6)
    specs = {"a": Spec(1, 0.5), "b": Spec(2, 0.5)}
    texts = spark.createDataFrame(rows, SCHEMA)
    plain = neardup.candidates
    monkeypatch.setattr(neardup, "candidates", lambda posts, rules: plain(posts, rules, long_list=2, block=3))
    got = {tuple(r) for r in neardup.record_pairs(neardup.similar(texts, specs)).collect()}
    want = brute(rows, specs)
    assert want and got == want


def test_project_groups_follow_the_definition_of_the_pairs(spark, tmp_path):
    words = [f"w{i}" for i in range(60)]
    edited = words[:20] + ["x"] + words[21:40] + ["y"] + words[41:]  # 46 of 66 runs of five are in both: 0.697
    documents = [(1, " ".join(words)), (2, " ".join(edited)), (3, "short note"), (4, "short note"), (5, None), (3, "short note")]
    seeds = [(1, "how do we brew good coffee at home"), (2, "at home how do we brew coffee"), (3, "tea"), (4, "tea")]
    messages = [(1, "Assistant ", "yes"), (2, "user", "no")]
    for name, rows, schema in (("documents", documents, "doc_id long, text string"), ("seed_pool", seeds, "seed_index long, question string"), ("messages", messages, "message_id long, role string, content string")):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    groups = neardup.p5_groups(spark, str(tmp_path)).collect()
    of = {(r.record_table, r.record_key): r for r in groups}
    assert len(groups) == len(of) == 9  # every record with a text, once
    pairs = {tuple(r) for r in neardup.p5_found(spark, str(tmp_path)).collect()}
    assert pairs == {("documents", 1, 2), ("seed_pool", 1, 2), ("seed_pool", 3, 4)}
    together = {(t, a, b) for t, a in of for u, b in of if t == u and a < b and of[t, a].cluster_key == of[t, b].cluster_key}
    assert together == pairs
    assert of["documents", 3].cluster_key == 3 and of["documents", 3].n_links == 0 and of["messages", 1].cluster_key == 1


def test_a_hot_token_among_sets_of_many_sizes(spark):
    rng = random.Random(8)
    rows = []
    for k in range(300):
        n = rng.choice([6, 9, 14, 22, 35])
        rows.append(("a", k, " ".join(["hot"] + rng.choices([f"v{i}" for i in range(40)], k=n))))
    specs = {"a": Spec(1, 0.6)}
    posts = neardup.postings
    plain = neardup.candidates
    try:
        neardup.candidates = lambda p, r: plain(p, r, long_list=10, block=16)
        # every posting comes twice, as if two tasks had sent each group
        neardup.postings = lambda f: posts(f).unionAll(posts(f))
        got = run(spark, rows, specs)
    finally:
        neardup.candidates, neardup.postings = plain, posts
    assert len(got) == len(set(got)) and set(got) == brute(rows, specs)


def test_the_order_sees_hot_tokens_in_crowded_buckets():
    crowd, hot = 600_000, 5_000
    level = lambda v: int(np.uint16(np.log2(v + 1.0) * neardup.FINE))
    assert level(crowd + hot) > level(crowd + 2_500)  # three deviations of a crowded bucket
    assert level(2.0**60) < 65_536
