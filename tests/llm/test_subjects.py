import random

import numpy as np

from marsad.llm import subjects

NOUNS = {"cooking": "oven dough broth pan rice yeast salt".split(), "law": "court judge clause deed appeal fine witness".split(), "sport": "team goal match coach race league referee".split()}
FRAME = ["the {a} depends on the {b} near {n}", "people in {n} linked the {a} with the {b}", "we return to the plan with people from {n}"]


def make(n, seed=1):
    rng = random.Random(seed)
    docs, truth = [], {}
    for i in range(n):
        picked = rng.sample(sorted(NOUNS), rng.choice([1, 1, 2]))
        lines, held = [], {s: 0 for s in picked}
        for j in range(8):
            s = picked[0] if j < 5 else picked[-1]
            a, b = rng.sample(NOUNS[s], 2)
            name = "".join(rng.choices("bdfgklmnprst", k=4)) + "a"
            f = rng.choice(FRAME)
            held[s] += "{a}" in f
            lines.append(f.format(a=a, b=b, n=name))
        rng.shuffle(lines)
        docs.append((i, ". ".join(lines) + "."))
        truth[i] = {s for s, k in held.items() if k >= 2}
    return docs, truth


def run(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    l = spark.createDataFrame(labels, "doc_id long, subject string")
    return subjects.assign(d, l, sorted(NOUNS))


def test_held_out_accuracy_with_noisy_labels(spark):
    docs, truth = make(900)
    rng = random.Random(7)
    labels = []
    for i in range(300):
        for s in truth[i]:
            labels.append((i, s if rng.random() > 0.05 else rng.choice(sorted(NOUNS))))
    got = {(r.doc_id, r.subject) for r in run(spark, docs, labels + labels[:20]).collect() if r.doc_id >= 300}
    want = {(i, s) for i in range(300, 900) for s in truth[i]}
    assert len(got & want) >= 0.95 * len(want) and len(got & want) >= 0.95 * len(got)


def test_every_text_gets_a_subject(spark):
    docs, truth = make(60)
    docs += [(100, None), (101, ""), (102, "  \n"), (103, "?!"), (104, "unknown words only"), (105, "the oven and the dough. " * 20_000), docs[0]]
    labels = [(i, s) for i in range(60) for s in truth[i]] + [(None, "law"), (5, None), (5, "no such subject"), (999, "law")]
    rows = run(spark, docs, labels).collect()
    assert {r.doc_id for r in rows} == set(range(60)) | {103, 104, 105}
    assert len({(r.doc_id, r.subject) for r in rows}) == len(rows)
    assert {r.subject for r in rows if r.doc_id == 105} == {"cooking"}


def test_no_labels_and_no_documents(spark):
    docs, _ = make(5)
    assert run(spark, docs, []).count() == 0 and run(spark, docs, [(999, "law")]).count() == 0
    assert run(spark, [], [(1, "law")]).count() == 0
    d = spark.createDataFrame(docs, "doc_id long, text string")
    assert subjects.assign(d, spark.createDataFrame([], "doc_id long, subject string"), []).count() == 0


def test_calibration_finds_the_middle():
    x = (np.arange(subjects.BINS) + 0.5) / subjects.BINS
    p = 0.02 + 0.88 / (1 + np.exp(-20 * (x - 0.3)))
    table = np.stack([400 * (1 - p), 400 * p], axis=1)[None].repeat(2, axis=0)
    assert np.allclose(subjects.calibrate(table)[:, 1], 0.3, atol=0.03)
