import random

import numpy as np

from marsad.llm import forms, leaks

WORDS = [f"w{i}" for i in range(60)]


def make(seed=3):
    rng = random.Random(seed)
    items = [(f"i{k}", " ".join(rng.choices(WORDS, k=20))) for k in range(12)] + [("short", "a b c"), ("null", None), ("i0copy", None)]
    items[-1] = ("i0copy", items[0][1])
    records = []
    for k in range(40):
        base = rng.choices(WORDS, k=30)
        if k % 2:
            cut = items[k % 12][1].split()
            n = rng.choice([11, 12, 15])
            at = rng.randrange(0, 20 - n + 1)
            part = cut[at : at + n]
            if k % 4 == 3:
                part[n // 2] = "changed"
            base[5:5] = part
        records.append(("t", k, " ".join(base)))
    records += [("t", 100, None), ("t", 101, ""), ("t", 102, "w1 w2"), records[1], ("u", 1, items[0][1].upper())]
    return items, records


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def brute(items, records, edits):
    out = {}
    for t, k, x in records:
        w = forms.bare_words(x) if x else []
        for i, y in items:
            v = forms.bare_words(y) if y else []
            for p in range(len(w) - 11):
                for q in range(len(v) - 11):
                    d = distance(w[p : p + 12], v[q : q + 12])
                    if d <= edits:
                        out[t, k, i] = min(d, out.get((t, k, i), 99))
    return out


def run(spark, items, records, plan):
    r = spark.createDataFrame(records, "record_table string, record_id long, text string")
    i = spark.createDataFrame(items, "item_id string, text string")
    return {(x.record_table, x.record_id, x.item_id): x.edits for x in leaks.leaks(r, i, plan).collect()}


def test_literal_windows_against_brute_force(spark):
    items, records = make()
    got = run(spark, items, records, leaks.Plan())
    want = brute(items, records, 0)
    assert want and {k for k, d in got.items() if d == 0} == set(want)


def test_edited_windows_reach_the_recall(spark):
    items, records = make(5)
    plan = leaks.Plan(edits=1)
    got, want = run(spark, items, records, plan), brute(items, records, 1)
    assert set(got) <= set(want)
    assert len(set(got)) >= 0.9 * len(want)
    assert all(d == want[k] for k, d in got.items() if want[k] == 0)


def test_recall_at_one_two_and_three_edits():
    rng = np.random.default_rng(4)
    vocabulary = rng.integers(1, 2**62, 500).astype(np.uint64)
    for edits in (1, 2, 3):
        plan = leaks.Plan(edits=edits)
        one, two = [], []
        while len(one) < 600:
            w = rng.choice(vocabulary, 16)
            v = list(w)
            for _ in range(edits):
                k, p = rng.integers(3), rng.integers(len(v))
                if k == 0:
                    v[p] = rng.choice(vocabulary)
                elif k == 1:
                    v.insert(p, rng.choice(vocabulary))
                else:
                    del v[p]
            one.append(w[:12])
            two.append(v[:12])
        x, y = np.array(one), np.array(two, np.uint64)
        d = leaks.edit_distances(x, y)
        assert d[:50].tolist() == [distance(a, b) for a, b in zip(x[:50].tolist(), y[:50].tolist())]
        x, y = x[d <= edits], y[d <= edits]
        met = np.any([leaks.signatures(x, plan, r) == leaks.signatures(y, plan, r) for r in range(plan.rounds)], axis=0)
        assert met.mean() >= 0.95, (edits, met.mean())


def test_a_passage_shared_by_many_items_and_records(spark):
    shared = "choose the one best answer to each of the questions that follow below and mark it"
    items = [(f"i{k}", f"{shared} item {k}") for k in range(300)]
    records = [("t", k, f"note {k} {shared} now") for k in range(300)]
    for plan in (leaks.Plan(edits=0), leaks.Plan()):
        got = leaks.leaks(spark.createDataFrame(records, "record_table string, record_id long, text string"), spark.createDataFrame(items, "item_id string, text string"), plan)
        assert got.count() == 90_000 and got.filter("edits = 0 and first_word = 2").count() == 90_000
    windows = leaks.item_windows(spark.createDataFrame(items, "item_id string, text string"), leaks.Plan())
    distinct, owners = leaks.owner_sets(windows)
    assert distinct.count() == 6 + 300 and owners.count() == 300 + 300  # owners are held once a set, not once a window


def test_edge_cases(spark):
    text = " ".join(WORDS[:14])
    assert run(spark, [], [("t", 1, text)], leaks.Plan()) == {}
    assert run(spark, [("i", text)], [], leaks.Plan()) == {}
    long = " ".join(["filler"] * 30_000 + WORDS[:14] + ["filler"] * 10)
    assert run(spark, [("i", text)], [("t", 1, long), ("t", 1, long)], leaks.Plan()) == {("t", 1, "i"): 0}
    r = spark.createDataFrame([("t", 1, text, "z")], "record_table string, record_id long, text string, item_id string")
    i = spark.createDataFrame([("i", text, 5)], "item_id string, text string, record_id int")
    assert leaks.leaks(r, i).count() == 1
