import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from marsad.llm import forms, unify

ARABIC = "كتب أحمد رسالة إلى آل علي ؟"


def test_same_look_becomes_equal():
    same = [
        ("ｆｕｌｌ　ｗｉｄｔｈ", "full width"),
        ("café", "café"),
        ("zero​width⁠", "zerowidth"),
        ("no break", "no break"),
        ("thin space", "thin space"),
        ("аррlе", "apple"),
        ("ﬁne ﬂat", "fine flat"),
        ("ﻻ ﺷﺮﺡ", "لا شرح"),
        ("کتاب", "كتاب"),
        ("قریب", "قريب"),
        ("على" , "علی"),
        ("أ", "أ"),
        ("شدّة", "شدّة"),
        ("مَّ", "مَّ"),
        ("why;", "why;"),
        ("end․", "end."),
        ("trail  \nnext ", "trail\nnext"),
    ]
    for a, b in same:
        assert forms.consistent(a) == forms.consistent(b), (a, b)


def test_seen_differences_stay():
    for a, b in [("أ", "ا"), ("كتب", "كتَب"), ("كتب", "كتـب"), ("A", "a"), ("1", "١"), ("؟", "?"), ("x²", "x2"), ("علي", "على"), ("a b", "a  b")]:
        assert forms.consistent(a) != forms.consistent(b), (a, b)


def test_plain_text_is_left_alone():
    assert forms.consistent(ARABIC) is ARABIC
    assert forms.consistent(None) is None
    assert forms.consistent("") == ""


@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40))
@settings(max_examples=400, deadline=None)
def test_idempotent_and_composed(t):
    f = forms.consistent(t)
    assert forms.consistent(f) == f
    assert unicodedata.normalize("NFC", f) == f


def test_words():
    assert forms.marked_words("Ab_c كتَب، ١٢٣!") == ["ab", "c", "كتَب", "١٢٣"]
    assert forms.bare_words("أكتَبـ Ab!") == ["اكتب", "ab"]


def rows(spark, data):
    return spark.createDataFrame(data, "record_table string, record_key long, text string")


def brute(data):
    out = set()
    for t1, k1, x1 in data:
        for t2, k2, x2 in data:
            if t1 == t2 and k1 < k2 and x1 and x2 and x1 != x2 and forms.consistent(x1) == forms.consistent(x2):
                out.add((t1, k1, k2))
    return out


def test_pairs_against_brute_force(spark):
    data = [("t", 1, "abc d"), ("t", 2, "аbc d"), ("t", 3, "abc d"), ("t", 3, "abc d"), ("t", 4, "ABC d"), ("u", 5, "abc d"), ("t", 6, None), ("t", 7, " "), ("t", 8, "abc d"), ("u", 9, "other")]
    got = {tuple(r) for r in unify.alike_pairs(unify.alike_groups(rows(spark, data))).collect()}
    assert got == brute(data)


def test_large_group_stays_connected_in_linear_rows(spark):
    data = [("t", i, "abc d" if i % 3 else "аbc d") for i in range(300)]
    m = unify.alike_groups(rows(spark, data))
    got = [tuple(r) for r in unify.alike_pairs(m, expand_records=10).collect()]
    assert m.count() == 300 and len(got) <= 300
    assert set(got) <= brute(data)
    parent = list(range(300))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for _, a, b in got:
        parent[find(b)] = find(a)
    assert len({find(i) for i in range(300)}) == 1


def test_groups_of_any_size_give_all_pairs(spark):
    # 150 copies of one form, one each of two others; a record that comes twice counts once
    data = [("t", i, "abc d") for i in range(150)] + [("t", 200, "аbc d"), ("t", 300, "abс d"), ("t", 300, "abс d")]
    m = unify.alike_groups(rows(spark, data))
    assert {r.records for r in m.collect()} == {152}
    want = brute(data)
    assert len(want) == 301 and ("t", 200, 300) in want
    for got in (unify.alike_pairs(m).collect(), unify.alike_pairs(m, long_group=20).collect()):
        assert len(got) == 301 and {tuple(r) for r in got} == want


def test_empty_table_and_extra_columns(spark):
    assert unify.alike_pairs(unify.alike_groups(rows(spark, []))).count() == 0
    df = spark.createDataFrame([("t", 1, "a​b", "x", "y")], "record_table string, record_key long, text string, skeleton string, stored string")
    assert unify.alike_groups(df).count() == 0
    out = unify.with_consistent_form(df, ["text"]).collect()[0]
    assert out.text_form == "ab" and out.skeleton == "x"


def test_short_messages_have_a_form_and_groups_but_no_pairs(spark, tmp_path):
    ten = "one two three four five six seven eight nine ten"
    messages = [(1, "assistant", "yes"), (2, " Assistant", "yеs"), (3, "user", "yes"), (4, "assistant", None), (5, "assistant", ten), (6, "assistant", ten.replace("e", "е"))]
    for name, data, schema in (("messages", messages, "message_id long, role string, content string"), ("seed_pool", [(1, "no"), (2, "nо")], "seed_index long, question string"), ("mcq_items", [(1, "so")], "item_no long, input_text string")):
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    d = str(tmp_path)
    forms_ = {(r.record_table, r.record_key): r.text_form for r in unify.p2_consistent_texts(spark, d).collect()}
    assert forms_ == {("messages", 1): "yes", ("messages", 2): "yes", ("messages", 5): ten, ("messages", 6): ten, ("seed_pool", 1): "no", ("seed_pool", 2): "no", ("mcq_items", 1): "so"}
    assert {(r.record_table, r.record_key) for r in unify.p2_groups(spark, d).collect()} == {("messages", 1), ("messages", 2), ("messages", 5), ("messages", 6), ("seed_pool", 1), ("seed_pool", 2)}
    assert {tuple(r) for r in unify.p2_found(spark, d).collect()} == {("messages", 5, 6), ("seed_pool", 1, 2)}
