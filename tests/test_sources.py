import hashlib
import json

import pytest
from pyspark.sql import functions as F

from marsad.sources import readers as R
from marsad.sources import sinks


def put(folder, name, lines):
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_chats_of_three_shapes_and_malformed_lines(spark, tmp_path):
    m = [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}]
    put(tmp_path, "chats_a.jsonl", [json.dumps({"seed_index": 1, "conversation": {"messages": m}}), "", json.dumps({"seed_index": 2, "conversation": {"messages": []}, "messages": m}), "{broken", json.dumps({"seed_index": 3, "question": "a", "answer": "b"}), json.dumps({"seed_index": 4})])
    put(tmp_path, "chats_a.passing.jsonl", [json.dumps({"seed_index": 9})])
    good, bad = R.read_chats(spark, str(tmp_path))
    assert {r.seed_index: len(r.resolved) for r in good.collect()} == {1: 2, 2: 2, 3: 2, 4: 0}
    assert [r.line for r in bad.collect()] == ["{broken"]
    n = good.select("seed_index", R.normalized_messages(F.col("resolved")).alias("m"), R.valid_messages(F.col("resolved")).alias("ok")).collect()
    assert {r.seed_index: r.ok for r in n} == {1: False, 2: False, 3: True, 4: False}
    assert {m.content for r in n if r.seed_index == 1 for m in r.m} == {"q", ""}


def test_opaque_lines(spark, tmp_path):
    put(tmp_path, "a.jsonl", ['{"messages": [{"role": "user"}]}', ""])
    assert R.read_opaque(spark, str(tmp_path / "a.jsonl")).collect()[0].messages_json == '[{"role":"user"}]'
    put(tmp_path, "b.jsonl", ['{"messages": []}'])
    with pytest.raises(Exception, match="no messages"):
        R.read_opaque(spark, str(tmp_path / "b.jsonl")).collect()


def test_discovery_and_manifest(spark, tmp_path):
    put(tmp_path, "one.jsonl", ["{}"])
    put(tmp_path, "one.stage.jsonl", ["{}"])
    assert [r.name for r in R.discover(spark, str(tmp_path), [".stage"]).collect()] == ["one.jsonl"]
    want = hashlib.sha256((tmp_path / "one.jsonl").read_bytes()).hexdigest()
    assert {r.name: r.sha256 for r in R.manifest(spark, str(tmp_path)).collect()}["one.jsonl"] == want


def test_run_entries_and_catalogue(spark):
    lines = spark.createDataFrame([('{description: "fam:subject=a,model=x", priority: 1}',), ("# comment",), ('{description: "bare"}',)], "value string")
    assert sorted((r.family, r.args) for r in R.run_entries(lines).collect()) == [("bare", {}), ("fam", {"subject": "a", "model": "x"})]
    topics = spark.createDataFrame([("t1|Subject|q one|q two",), (" ",)], "value string")
    t = R.topic_catalog(topics, "science", "a.example  b.example").collect()
    assert len(t) == 1 and t[0].questions == ["q one", "q two"] and t[0].allowed_domains == ["a.example", "b.example"]
    with pytest.raises(Exception, match="not a topic"):
        R.topic_catalog(spark.createDataFrame([("a|b",)], "value string"), "d", "").collect()


def test_ledger_keeps_decimals(spark, tmp_path):
    for i, c in enumerate(["0.1", "0.2", None]):
        (tmp_path / f"request-a-{i}.json").write_text(json.dumps({"stage": "a", "raw": {"usage": {"cost": c, "prompt_tokens": 3}}}))
    r = R.ledger(spark, str(tmp_path)).agg(F.sum("cost").alias("c"), F.count_if(F.col("cost").isNull()).alias("unknown")).first()
    assert str(r.c.normalize()) == "0.3" and r.unknown == 1


def test_page_text(spark):
    html = "<p title='a > b'>Hello &amp;  <b>you</b></p><!-- <p>gone</p> --><script>var x='</p>'; if (1<2) {}</script><style>p{}</style><noscript><b>on</b></noscript> &lt;end&gt; 1 < 2"
    df = spark.createDataFrame([(html,), (None,), ("",)], "h string")
    assert [r.t for r in df.select(R.page_text(F.col("h")).alias("t")).collect()] == ["Hello & you <end> 1 < 2", None, ""]
    assert len(R.visible_text("x" * 50_000)) == 28_000


def test_transcripts(spark):
    rows = ['[{"role":"user","content":"a"}]', "User: hi\nthere\nAssistant: yes", "المستخدم: سؤال\nالمساعد: جواب", "  SYSTEM : be kind\n user: q"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    got = [[(m.role, m.content) for m in r.m] for r in df.select("i", R.parse_transcript(F.col("t")).alias("m")).orderBy("i").collect()]
    assert got == [[("user", "a")], [("user", "hi\nthere"), ("assistant", "yes")], [("user", "سؤال"), ("assistant", "جواب")], [("system", "be kind"), ("user", "q")]]
    plain = spark.createDataFrame([("just an answer ",)], "t string")
    assert [(m.role, m.content) for m in plain.select(R.parse_transcript(F.col("t"), completion=True).alias("m")).first().m] == [("assistant", "just an answer")]
    for wrong in ("just an answer", " ", None, "[broken"):
        with pytest.raises(Exception, match="conversation|transcript"):
            spark.createDataFrame([(wrong,)], "t string").select(R.parse_transcript(F.col("t"))).collect()


def test_dense_ids_by_file_and_line(spark, tmp_path):
    put(tmp_path, "b.jsonl", [json.dumps({"seed_index": 3, "question": "x"}), "{broken"])
    put(tmp_path, "a.jsonl", ["", json.dumps({"seed_index": 1, "question": "x"}), json.dumps({"seed_index": 2, "question": "y"}), ""])
    put(tmp_path, "notes.jsonl", ["[1]"])
    good, bad = R.indexed_chats(spark, str(tmp_path / "[ab].jsonl"))
    assert sorted((r.id, r.seed_index) for r in good.collect()) == [(0, 1), (1, 2), (2, 3)]
    assert good.filter("id = 1").first().seed_index == 2
    assert {r.file.rsplit("/", 1)[1]: r.malformed for r in bad.collect()} == {"a.jsonl": 0, "b.jsonl": 1}
    assert sorted(r.name for r in R.sniffed(spark, R.discover(spark, str(tmp_path), [])).collect()) == ["a.jsonl", "b.jsonl"]


def test_costs_of_several_ledgers(spark, tmp_path):
    (tmp_path / "one").mkdir()
    (tmp_path / "one/request-1.json").write_text(json.dumps({"stage": "a", "raw": {"usage": {"cost": "0.1"}}}))
    (tmp_path / "one/r2.pending").write_text("x")
    r = R.total_cost(spark, [str(tmp_path / "one"), str(tmp_path / "none")]).first()
    assert float(r.cost) == 0.1
    assert {x.state: x.n for x in R.unresolved(spark, str(tmp_path / "one")).collect()} == {"pending": 1}


def test_evaluation_runs_are_collected_once_and_under_their_hash(spark, tmp_path):
    from marsad.sources import evaluations as E

    jobs = spark.createDataFrame([("j", ["run", "--x"])], "job string, command array<string>")
    right = hashlib.sha256("\0".join(["run", "--x", "s/1", "10"]).encode()).hexdigest()[:16]

    def put_run(job, run, status, metrics):
        d = tmp_path / "evals" / job / run
        d.mkdir(parents=True)
        (d / "status.json").write_text(json.dumps(status))
        (d / "metrics.json").write_text(json.dumps(metrics))

    ok = {"sampler_path": "s/1", "step": 10, "returncode": 0, "command_hash": right}
    put_run("j", "c1", ok, {"status": 0, "metrics": {"suite/a": 0.5, "suite/b": "NaN", "other/c": 1, "suite": 2}})
    put_run("j", "c2", ok | {"command_hash": "0" * 16}, {"status": 0, "metrics": {"suite/a": 1}})
    put_run("j", "c3", ok | {"returncode": 1}, {"status": 0, "metrics": {"suite/a": 1}})
    put_run("k", "c4", ok, {"status": 0, "metrics": {"suite/a": 1}})
    root, out = str(tmp_path / "evals"), (str(tmp_path / "out"), str(tmp_path / "state"))
    first = E.collect_new(spark, root, jobs, ["suite"], *out)
    assert [(r.run, r.step, r.metric, r.value) for r in first.collect()] == [("c1", 10, "suite/a", 0.5)]
    put_run("j", "c5", ok, {"status": 0, "metrics": {"suite/a": 0.75}})
    again = E.collect_new(spark, root, jobs, ["suite"], *out)
    assert sorted((r.run, r.value) for r in again.collect()) == [("c1", 0.5), ("c5", 0.75)]
    log = spark.createDataFrame([("c1", right), ("c2", right), ("c9", right)], "checkpoint_id string, command_hash string")
    assert sorted(r.checkpoint_id for r in E.pending(log, E.read_status(spark, root)).collect()) == ["c2", "c9"]
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "name string")
    assert E.new_run(names("a"), names("a", "b")) == "b"
    with pytest.raises(ValueError):
        E.new_run(names("a"), names("a", "b", "c"))


def test_annotations_are_checked_and_merged(spark, tmp_path):
    h = "a" * 64
    rows = [{"record_sha256": h, "target": "conversation", "reviewer": "x", "verdict": "good", "updated_at": "2026-01-01T00:00:00"}]
    rows += [rows[0] | {"verdict": "bad", "updated_at": "2026-01-02T00:00:00"}, rows[0] | {"record_sha256": "short"}, rows[0] | {"target": "all"}, rows[0] | {"verdict": "?"}, rows[0] | {"updated_at": "then"}]
    lines = spark.createDataFrame([(json.dumps(r),) for r in rows] + [("{broken",), (" ",)], "value string")
    valid, wrong = sinks.import_annotations(lines, ["good", "bad"])
    assert [(r.target, r.verdict) for r in valid.collect()] == [("conversation", "bad")]
    assert {r.reason: r.n for r in wrong.collect()} == {"malformed": 1, "bad hash": 1, "bad target": 1, "unknown verdict": 1, "bad time": 1}
    sinks.write_annotations(valid, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1


def test_pinned_revisions_subsets_and_suffixes(spark, tmp_path):
    from marsad.plans import training as P

    df = spark.createDataFrame([("r1", "c", "test", "s1", "x", "y", 0), ("r2", "c", "test", "s2", "u", "v", 1)], "revision string, config string, split string, subset string, sol1 string, sol2 string, label int")
    df.write.partitionBy("revision", "config", "split").parquet(str(tmp_path / "bench"))
    got = P.pinned(spark, str(tmp_path), "bench", "r2", "c", "test")
    assert [(r.options, r.gold) for r in P.options_and_gold(got, "sol", "label").collect()] == [(["u", "v"], 1)]
    with pytest.raises(ValueError):
        P.pinned(spark, str(tmp_path), "bench", "r3", "c", "test")
    assert P.subsets(df, None).count() == 2 and P.subsets(df, "s1, s9").count() == 1
    with pytest.raises(ValueError):
        P.subsets(df, "s9")


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, True, "train"), (2, False, "train"), (3, None, "test")], "id long, screening_passed boolean, split string")
    n = sinks.write_export(df, str(tmp_path / "x")).first()
    assert (n.n, n.passing, n.flagged) == (3, 1, 2)
    assert spark.read.json(str(tmp_path / "x/passing")).count() == 1
    m = {r.split: r.n_rows for r in sinks.write_splits(df, str(tmp_path / "s")).collect()}
    assert m == {"train": 2, "test": 1} and spark.read.json(str(tmp_path / "s")).count() == 3
    assert tuple(sinks.dataset_info(df, 2, 3).first()) == (3, 2, 6)
    r = sinks.write_report(df.withColumn("domain", F.lit("law")), str(tmp_path / "r")).first()
    assert (r.n, r.splits, r.categories) == (3, 2, 1)
    card = [x.value for x in spark.read.text(str(tmp_path / "r/card")).collect()]
    assert "| split | domain | n |" in card and "| train | law | 2 |" in card


def test_benchmark_tables_of_several_shapes(spark):
    from marsad.sources import benchmarks as B

    wide = spark.createDataFrame([(1, "ctx", "q1", "a", "b", "", None, "B"), (2, " ", "q2", "a", None, "c", None, "?")], "row int, Context string, Question string, `Option 1` string, `Option 2` string, `Option 3` string, `Option 4` string, `Answer Key` string")
    got = B.with_context(wide, ["row"], "s", [f"Option {i}" for i in range(1, 5)]).orderBy("id").collect()
    assert [(r.id, r.input_text, r.choices, r.gold_index) for r in got] == [("id0", "ctx\n\nq1", ["a", "b"], 1), ("id1", "q2", ["a", "c"], None)]
    nums = spark.createDataFrame([(5, "q", ["a", "b"], "1"), (6, "r", ["a"], None)], "row int, question string, choices array<string>, answer string")
    assert [(r.id, r.gold_index) for r in B.with_numbers(nums, ["row"], "law").orderBy("id").collect()] == [("id-law-0", 1), ("id-law-1", None)]
    exams = spark.createDataFrame([("Islamic Studies-1", "q", "1", "2", "3", "4", "C"), ("Islamic Studies-2", "q", "1", "2", "3", "4", "E"), ("Physics-1", "q", "1", "2", "3", "4", "A")], "id string, question string, A string, B string, C string, D string, answer string")
    assert [(r.id, r.gold_index) for r in B.by_id_prefix(exams, "Islamic_Studies").collect()] == [("Islamic Studies-1", 2)]
    trust = spark.createDataFrame([(1, "x y", "q", "أ) one", "ب) two", "ج) three", "ا "), (2, "z", "q", "one", "two", None, "ب")], "row int, Category string, Question string, A string, B string, C string, Answer string")
    r = B.by_category(trust, ["row"], "x_y").first()
    assert (r.choices, r.gold_index, r.id) == (["one", "two", "three"], 0, "id0")
    with pytest.raises(Exception, match="without its letter"):
        B.by_category(trust, ["row"], "z").collect()
    free = spark.createDataFrame([("f1", "why", "c1", "because")], "id string, question string, candidates string, gold_answer string")
    assert "why" in B.with_candidates(free).first().input_text


def test_recipes_plans_and_targets(spark, tmp_path):
    from marsad.sources import recipes as P

    (tmp_path / "r.json").write_text(json.dumps({"jobs": [{"name": "a", "suite": "s"}, {"name": "a", "suite": "t"}, {"name": "../x", "suite": "s", "limit": 0}]}))
    faults = P.recipe_faults(P.read_document(spark, str(tmp_path / "r.json")), {"s"})
    assert faults == ["a: named twice", "a: unknown suite", "../x: not a plain folder name", "../x: limit below one"]
    topics = spark.createDataFrame([("t1", 2), ("t1", 9), (None, None)], "topic_id string, exchanges int")
    got = {r.fault: r.n for r in P.plan_faults(topics, 0, 1, {"exchanges": (1, 6), "concurrency": (1, 100), "attempts": (0, 2)}).collect()}
    assert got == {"repeated topic": 1, "no topic": 1, "exchanges out of bounds": 2, "concurrency out of bounds": 1}
    batch = lambda n: spark.range(n * 10, n * 10 + 10) if n < 5 else None
    kept = P.until_target(batch, lambda d: d.filter("id % 3 = 0"), 6, str(tmp_path / "out"), "id")
    assert [r.id for r in kept.collect()] == [0, 3, 6, 9, 12, 15]
    with pytest.raises(ValueError):
        P.until_target(lambda n: None, lambda d: d, 1, str(tmp_path / "none"), "id")
