import json

from marsad.streaming import watch


def drop(folder, name, entries):
    (folder / name).write_text("\n".join(entries) + "\n")


def entry(run, place, final=False, path=None):
    return json.dumps({"run": run, "name": "step", "place": place, "sampler_path": f"{run}/{place}" if path is None else path, "final": final})


def test_selection_goes_on_after_a_restart(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    drop(log, "1.json", [entry("a", i) for i in range(1, 6)] + [entry("a", 5), entry("a", 99, path=""), '{"run": "a", "pla'])

    def go():
        q = watch.select_every(watch.read_log(spark, str(log)), 2, 3)
        return sorted((r.run, r.place) for r in watch.run_available(q, str(tmp_path / "out"), str(tmp_path / "state")).collect())

    assert go() == [("a", 2), ("a", 4)]
    drop(log, "2.json", [entry("a", i) for i in range(6, 11)] + [entry("a", 11, True), entry("b", 1), entry("b", 2)])
    assert go() == [("a", 2), ("a", 4), ("a", 6), ("a", 11), ("b", 2)]
    assert go() == [("a", 2), ("a", 4), ("a", 6), ("a", 11), ("b", 2)]


def test_windows_close_in_a_stream(spark, tmp_path):
    src = tmp_path / "events"
    src.mkdir()
    drop(src, "1.json", [json.dumps({"at": f"2024-01-0{d}T10:00:00", "event_type": "view", "value": 1.5}) for d in (1, 1, 2, 3)])
    drop(src, "2.json", [json.dumps({"at": "2024-01-09T10:00:00", "event_type": "view", "value": 1.0})])
    schema = "at timestamp, event_type string, value double"
    stream = watch.windows(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(src)), "1 day", "1 day")
    rows = watch.run_available(stream, str(tmp_path / "out"), str(tmp_path / "state")).collect()
    assert sorted((r.start.day, r.n, r.value) for r in rows) == [(1, 2, 3.0), (2, 1, 1.5), (3, 1, 1.5)]
