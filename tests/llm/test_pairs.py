import random

import numpy as np

from marsad.llm import pairs
from marsad.llm.pair_labels import labelled


def label(spark, rows, **kw):
    df = spark.createDataFrame([("t", str(i), p, r) for i, (p, r) in enumerate(rows)], "record_table string, record_key string, prompt string, reply string")
    return {(x.record_key, x.defect) for x in pairs.label(df).collect()}


def corpus(n=400, seed=2):
    rng = random.Random(seed)
    noun = ["the oven", "the dough", "the broth", "the pan", "the rice", "the yeast", "the salt"]
    rows = []
    for i in range(n):
        a, b, c = rng.sample(noun, 3)
        name = "".join(rng.choices("bdfgklmnprst", k=3)) + "ora"
        s = [f"In {name} work on {a} starts early in the month and leans on {b} quietly", f"When {a} slips in {name}, {b} weakens and {c} grows", f"The reason is that {a} depends on {b} and the plan in short moves"]
        rng.shuffle(s)
        rows.append((f"How do I set up {a} in {name} with {b}?", ". ".join(s) + rng.choice([".", ""])))
    return rows


def test_held_out_pairs_come_out_as_labelled(spark):
    held = labelled(held_out=True)
    assert not {(p, r) for p, r, _ in held} & {(p, r) for p, r, _ in labelled(held_out=False)}
    assert len(held) + len(labelled(held_out=False)) >= 300
    rows = corpus() + [(p, r) for p, r, _ in held]
    got = label(spark, rows)
    for d in pairs.DEFECTS:
        want = {str(400 + i) for i, (_, _, ds) in enumerate(held) if d in ds}
        mine = {k for k, x in got if x == d and int(k) >= 400}
        f1 = 2 * len(want & mine) / (len(want) + len(mine))
        # words that hardly ever end a sentence are learnt from the corpus, and this one is small
        assert f1 >= (0.8 if d == "truncated" else 0.95), (d, f1)
    assert sum(int(k) < 400 for k, _ in got) <= 8  # of 400 sound pairs


def test_truncation_is_learnt_from_complete_sentences(spark):
    rows = corpus()
    broken = []
    for i in range(0, 40):
        p, r = rows[i]
        cut = r.rstrip(".").rsplit(". ", 1)
        words = cut[1].split()
        broken.append((p, cut[0] + ". " + " ".join(words[: len(words) // 2])))
    got = label(spark, rows + broken)
    hit = sum((str(400 + i), "truncated") in got for i in range(40))
    assert hit >= 32
    assert sum((str(i), "truncated") in got for i in range(400)) <= 8


def test_rare_sentence_ends_count(spark):
    replies = ["The amber lamp stands there."] * 60 + ["Nobody wants that amber."] * 2 + ["The wide brass door shuts."] * 60 + ["A dim shed by day."] * 18 + ["We like that shed."] * 2
    frames, idf = pairs.learn(spark.createDataFrame([(r,) for r in replies], "reply string"))
    amber, brass, shed = (pairs.Ids()[w] for w in ("amber", "brass", "shed"))
    assert brass in frames.inner and amber not in frames.inner  # amber is last in 3 %
    assert shed in frames.enders and amber not in frames.enders  # shed is last in 10 %
    assert abs(idf["the"] - (1 + np.log(143 / 121))) < 0.02 and abs(idf["amber"] - (1 + np.log(143 / 63))) < 0.02


def test_replies_that_stop_at_a_list_marker_are_truncated(spark):
    items = "Do it so:\n1. Heat the oven for the dough.\n2. Salt the broth and the rice.\n"
    arabic = "الخطوات:\n١. سخن الفرن قبل العجين.\n٢. أضف الملح إلى المرق.\n"
    cut = [items + "3.", items + "3)", items + "(3)", arabic + "٣.", "Take these:\n- the oven is hot.\n- the pan is cold.\n-", "a. Heat the oven.\nb. Salt the broth.\nc."]
    whole = [items.strip(), arabic.strip(), items + "3. Wait.", "The oven takes, in litres:\n42.", "Fill in this form:\n1.\n2.\n3.", "Take this:\n```\n1.\n```"]
    rows = corpus()
    got = label(spark, rows + [("How do I set up the oven?", r) for r in cut + whole])
    assert [(str(400 + i), "truncated") in got for i in range(len(cut + whole))] == [True] * len(cut) + [False] * len(whole)


def test_label_model_recovers_wrongly_stated_reliabilities():
    rng = np.random.default_rng(0)
    n = 300_000
    kind = rng.choice(3, n, p=[0.95, 0.03, 0.02])
    true = np.array(pairs.MEANING["echo"])
    true[0, 1], true[3, 1] = 0.30, 0.60  # stated 0.98 and 0.91
    patterns = np.where(rng.random((n, 4)) < true[:, kind].T, pairs.YES, pairs.NO)
    patterns[rng.random((n, 4)) < 0.2] = pairs.ABSTAIN
    kinds, counts = np.unique(patterns, axis=0, return_counts=True)
    m = pairs.LabelModel(pairs.MEANING["echo"]).fit(kinds, counts.astype(float))
    assert abs(m.share - 0.03) < 0.003
    assert np.abs(m.yes[:, 1] - true[:, 1]).max() < 0.03
    assert ((m.posterior(patterns) > 0.5) == (kind == 1)).mean() > 0.985


def test_other_scripts_and_fresh_replies():
    q = "How do I brew coffee at home?"
    for r in ("お湯を沸かしてからコーヒーを入れて五分待ちます。", "Вскипятите воду и добавьте кофе.", "물을 끓인 다음 커피를 넣으세요.", "उबलते पानी में कॉफी डालें।"):
        assert pairs.votes(q, r, pairs.Frames())["wrong_language"][0] == pairs.YES, r
    for r in ("You want to know how coffee can be brewed at home.", "The question is how to brew coffee at home."):
        assert pairs.votes(q, r, pairs.Frames())["echo"][3] == pairs.YES, r
    for r in ("I'd rather skip this one. Ask an expert instead.", "That falls outside my expertise.", "I won't be discussing that, please consult a professional."):
        assert pairs.votes(q, r, pairs.Frames())["refusal"][1] == pairs.YES, r


def test_votes_keep_their_widths():
    for p, r in [(None, None), ("", ""), (None, "text"), ("q", "``` "), ("q", "word " * 30_000)]:
        v = pairs.votes(p, r, pairs.Frames())
        assert {d: len(x) for d, x in v.items()} == pairs.WIDTHS
        assert all(pairs.decode(pairs.code(x), len(x)) == x for x in v.values())


def test_one_defect_a_pair_and_dirty_rows(spark):
    df = spark.createDataFrame([("t", "a", "q", None, 1), ("t", "a", "q", None, 1), ("t", "b", None, None, 1), ("t", "c", "hello there friend", "Dear {{name}}, welcome", 1)], "record_table string, record_key string, prompt string, reply string, residue int")
    labels = pairs.label(df)
    best = {(r.record_key, r.defect) for r in pairs.best_defect(labels.filter("not residue")).collect()}
    assert best == {("a", "empty"), ("b", "empty")}
    assert pairs.label(df.limit(0)).count() == 0


def test_long_echoes_are_compared_in_reasonable_time():
    words = " ".join(f"w{i % 50} x" for i in range(20_000))
    assert pairs.votes(words, words, pairs.Frames())["echo"] == [pairs.YES] * 4


def test_echoes_are_compared_in_order_and_whole_at_all_lengths():
    for n in (20, 400):
        w = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n)]
        third = lambda reply: pairs.votes(" ".join(w), " ".join(reply), pairs.Frames())["echo"][2]
        assert third(w[: n // 2] + ["x"] + w[n // 2 + 1 :]) == pairs.YES
        assert third(w[::-1]) == pairs.NO
        assert third(w + [f"y{i}" for i in range(n * 9 // 10)]) == pairs.ABSTAIN


def test_alike_against_the_plain_table():
    rng = random.Random(4)
    for _ in range(100):
        a, b = (rng.choices("abcd", k=rng.randrange(1, 15)) for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert pairs.alike(a, b) == 2 * best[-1][-1] / (len(a) + len(b))


def test_near_duplicate_keys_may_be_null(spark):
    from marsad.llm import neardup, unify

    df = spark.createDataFrame([("a", None, "one two three four five six"), ("a", 1, "one two three four five six"), (None, 2, "x"), ("a", 3, None)], "record_table string, record_key long, text string")
    assert neardup.record_pairs(neardup.similar(df, {"a": neardup.Spec()})).filter("key_a is not null and key_b is not null").count() == 0
    assert unify.alike_pairs(unify.alike_groups(df)).count() == 0
