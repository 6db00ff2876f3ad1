from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from marsad.llm import packing, sizes


def plain_best_fit(items, capacity, limit):
    """The same rule by scanning a list of open bins."""
    bins, used, out = [], 0, []
    for n in items:
        fit = [b for b in bins if b[1] >= n]
        if fit:
            b = min(fit, key=lambda b: b[1])
            left = b[1]
            # of equally tight bins the one changed last
            b = [x for x in bins if x[1] == left][-1]
            bins.remove(b)
        else:
            if len(bins) >= limit:
                least = min(b[1] for b in bins)
                bins.remove([x for x in bins if x[1] == least][-1])
            b = [used, capacity]
            used += 1
        out.append((b[0], capacity - b[1]))
        b[1] -= n
        if b[1]:
            bins.append(b)
    return out


@given(st.lists(st.integers(1, 50), max_size=120), st.integers(1, 6))
@settings(max_examples=150, deadline=None)
def test_packer_against_plain_best_fit(items, limit):
    p = packing.Packer(50, limit)
    assert [p.put(n) for n in items] == plain_best_fit(items, 50, limit)


def sizes_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, n_tokens long")


def check(rows, packed):
    want = {}
    for i, n in rows:
        if n:
            want[i] = n
    got, bins = defaultdict(list), defaultdict(list)
    for r in packed:
        got[r.spec_name, r.item_id].append((r.piece, r.start_token, r.n_tokens))
        bins[r.spec_name, r.sequence_id].append((r.offset_tokens, r.n_tokens, r.capacity_tokens))
    for (s, i), pieces in got.items():
        pieces.sort()
        at = 0
        for _, start, n in pieces:
            assert start == at
            at += n
        assert at == want[i]
    for content in bins.values():
        content.sort()
        at = 0
        for o, n, c in content:
            assert o == at
            at += n
        assert at <= c
    return got


def test_pack_places_every_token_once(spark):
    rows = [(i, (i * 37) % 90 + 1) for i in range(500)] + [(600, 1000), (601, 100), (602, 0), (603, None), (3, 3 * 37 % 90 + 1)]
    packed = packing.pack(sizes_of(spark, rows), [("a", 100), ("b", 64), ("none", 0), (None, 5)], shard_tokens=6000).collect()
    got = check(rows, packed)
    assert {s for s, _ in got} == {"a", "b"} and len(got) == 2 * 502
    assert all(len(p) == 1 for (s, i), p in got.items() if s == "a" and i != 600)
    full = {r.spec_name: r.filled_share for r in packing.fill(packing.pack(sizes_of(spark, rows), [("a", 100)])).collect()}
    assert full["a"] > 0.95


def test_pack_does_not_depend_on_partitions(spark):
    rows = [(i, (i * 53) % 90 + 1) for i in range(300)]
    one = packing.pack(sizes_of(spark, rows).coalesce(1), [("a", 100)]).collect()
    many = packing.pack(sizes_of(spark, rows).repartition(7), [("a", 100)]).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


def test_empty_and_rows_without_id(spark):
    assert packing.pack(sizes_of(spark, []), [("a", 100)]).count() == 0
    assert packing.pack(sizes_of(spark, [(1, 5)]), []).count() == 0
    assert packing.pack(sizes_of(spark, [(None, 5), (None, 5), (None, 7)]), [("a", 10)]).count() == 3


def test_sizes_equal_the_tokenizer(spark):
    c = sizes.counter(sizes.TOKENIZER)
    texts = ["", "It's a test.", "كتب أحمد رسالة\n\n طويلة 123 ", "x" * 5000, "  ½ ² _ _ \t\n"]
    assert [c.size(t) for t in texts] == [len(c.encode(t)) for t in texts]
    df = spark.createDataFrame([(1, t, 9) for t in texts] + [(2, None, 9)], "doc_id long, text string, n_tokens int")
    assert [r.n_tokens for r in sizes.token_sizes(df, ["doc_id"]).collect()] == [len(c.encode(t)) for t in texts] + [0]
