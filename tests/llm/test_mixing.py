import math
from fractions import Fraction

import pytest

from marsad.llm import mixing

DOCS = "doc_id long, source string, n_tokens long"


def docs():
    rows, k = [], 0
    for source, n, size in (("big", 3000, 40), ("mid", 600, 50), ("small", 60, 30)):
        for i in range(n):
            rows.append((k, source, size + i % 21))
            k += 1
    return rows + [(k, None, 10), (k + 1, "big", 0), (k + 2, "other", 7), rows[0]]


TARGETS = [("m", "big", 5.0, 1), ("m", "mid", 3.0, 3), ("m", "small", 1.0, 8), ("m", "absent", 1.0, 2), ("n", "mid", 1.0, 2), ("n", "small", None, 2), ("x", "absent", 1.0, 1)]


def test_shares_are_reached_within_the_caps(spark):
    chosen, shares = mixing.mix(spark.createDataFrame(docs(), DOCS), TARGETS)
    s = {(r.mix_name, r.source): r for r in shares.collect()}
    assert len(s) == len(TARGETS)
    for (m, source), r in s.items():
        assert r.actual_share == pytest.approx(r.reachable_share, abs=0.01)
        assert r.most_copies <= r.max_repeats
    assert s["m", "absent"].target_share == 0.1 and s["m", "absent"].actual_share == 0
    rows = chosen.collect()
    assert len({(r.mix_name, r.doc_id) for r in rows}) == len(rows)
    assert all(r.source in ("big", "mid", "small") for r in rows)


def test_copies_against_a_running_sum(spark):
    chosen, _ = mixing.mix(spark.createDataFrame(docs(), DOCS), TARGETS)
    got = {(r.mix_name, r.source, r.doc_id): r.copies for r in chosen.collect()}
    unique = {d[0]: d for d in docs() if d[1] and d[2]}
    sizes = {}
    for _, source, n in unique.values():
        sizes[source] = sizes.get(source, 0) + n
    want = {}
    for p in mixing.rates(TARGETS, sizes):
        if not p["rate"]:
            continue
        at = Fraction(mixing.offset(p["mix_name"], p["source"], mixing.SEED))
        for doc_id, source, _ in sorted((d for d in unique.values() if d[1] == p["source"]), key=lambda d: (d[2], d[0])):
            new = at + Fraction(p["rate"])
            if c := math.floor(new) - math.floor(at):
                want[p["mix_name"], source, doc_id] = c
            at = new
    assert {k: v for k, v in got.items() if want.get(k) != v} == {} and len(got) == len(want)


def test_empty_inputs(spark):
    chosen, shares = mixing.mix(spark.createDataFrame([], DOCS), TARGETS)
    assert chosen.count() == 0 and shares.count() == len(TARGETS)
    chosen, shares = mixing.mix(spark.createDataFrame(docs(), DOCS), [])
    assert chosen.count() == 0 and shares.count() == 0


def test_rates_use_the_whole_of_the_limiting_source():
    plan = {r["source"]: r for r in mixing.rates([("m", "a", 1, 2), ("m", "b", 1, 1)], {"a": 10, "b": 100})}
    assert plan["a"]["rate"] == 2.0 and plan["b"]["rate"] == pytest.approx(0.2)


def test_odd_targets_count_as_nothing():
    plan = mixing.rates([("m", "a", float("inf"), 2), ("m", "b", float("nan"), 1), ("m", "c", 1.0, None), ("m", "d", 1.0, 2), (None, "a", 1.0, 1), ("m", None, 1.0, 1)], {"a": 5, "b": 5, "c": 5, "d": 5})
    assert {r["source"]: r["rate"] for r in plan} == {"a": 0.0, "b": 0.0, "c": 0.0, "d": 2.0}
