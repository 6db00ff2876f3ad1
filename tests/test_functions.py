import hashlib
import re
import unicodedata

import math

import pytest
from pyspark.sql import functions as F

from marsad.functions import scoring as S
from marsad.functions import text as T

TEXTS = ["", "  two  words ", "Straße ßa", "كَتَبَ أحمدُ إلى آلـ ١٢٣", "a_b c-d ９", "x y z\x1cw", "naïve café", None, "one two three four five six", "mark **bold** [l](https://a.example/x)"]


def column(spark, c):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    return [r.v for r in df.select("i", c(F.col("t")).alias("v")).orderBy("i").collect()]


def tokens(t):
    return re.findall(r"\w+", t.lower().replace("ß", "ss"))


def test_words_follow_python(spark):
    assert column(spark, T.words) == [None if t is None else tokens(t) for t in TEXTS]


def test_word_count_follows_split(spark):
    assert column(spark, T.word_count) == [0 if t is None else len(t.split()) for t in TEXTS]


def test_normalized(spark):
    got = column(spark, T.normalized)
    assert got[3] == "كتب احمد الي ال 123".replace("الي", "الي")
    assert got[7] is None and got[0] == ""


def test_shingles(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = [r.g for r in T.with_shingles(df, F.col("t"), 3, "g").orderBy("i").collect()]
    for t, g in zip(TEXTS, got):
        w = tokens(t) if t else []
        assert sorted(g or []) == sorted({" ".join(w[i : i + 3]) for i in range(len(w) - 2)})


def test_addresses(spark):
    df = spark.createDataFrame([("https://A.Example/x/", ["example", "a.example"]), ("https://bexample/", ["example"]), ("https://s.example/%41+b/", ["www.Example"]), (None, ["x"]), ("https://x.example", None)], "u string, d array<string>")
    r = df.select(T.host(F.col("u")).alias("h"), T.host_allowed(T.host(F.col("u")), F.transform("d", T.plain_domain)).alias("ok"), T.canonical_url(F.col("u")).alias("c")).collect()
    assert [x.h for x in r] == ["a.example", "bexample", "s.example", None, "x.example"]
    assert [x.ok for x in r] == [True, False, True, False, False]
    assert r[2].c == "https://s.example/A+b"


def test_closing_offer_and_links(spark):
    assert column(spark, T.links)[-1] == ["https://a.example/x"]
    assert column(spark, T.without_links)[-1] == "mark **bold** l"
    df = spark.createDataFrame([("Body.\n\nWould you like more?",), ("Would you like more?\n\nBody.",)], "t string")
    assert [r.v for r in df.select(T.closing_offer(F.col("t")).alias("v")).collect()] == [True, False]


def test_digest(spark):
    assert column(spark, T.digest)[3] == hashlib.sha256(TEXTS[3].encode()).hexdigest()
    assert unicodedata.is_normalized("NFC", TEXTS[6])


def test_choices(spark):
    rows = [("خيار ب", ["x", "y"], 1), ("ب", ["x", "x"], 0), ("هـ", ["x"], 0), ("none", ["x"], 0), (None, ["x"], 0), ("أ", ["x "], 0), ("أ", ["x"], None), ("أ", ["x"], 5), ("أ", None, 0)]
    df = spark.createDataFrame(rows, "r string, c array<string>, g int")
    assert [x.v for x in df.select(S.is_correct(F.col("r"), F.col("c"), F.col("g")).alias("v")).collect()] == [True, True, False, False, False, True, False, False, False]


def test_judge_score(spark):
    df = spark.createDataFrame([("score 7 of 10",), ("12",), ("none",), (None,), ("-1 .5",)], "t string")
    assert [x.v for x in df.select(S.judge_score(F.col("t")).alias("v")).collect()] == [0.7, 1.0, 0.0, 0.0, 0.05]


def test_text_scores(spark):
    assert S.fuzzy_of("well, the red Cat sat", ["red cat"]) == 1.0
    assert S.fuzzy_of("abc", ["xyz"]) == 0.0 and S.fuzzy_of("", ["a"]) == 0.0 and S.fuzzy_of("a", []) == 0.0
    # 9 of 10 letters in place, 2 * 9 / 20 = 0.9; 7 of 10 give 0.7, which counts nothing
    assert S.fuzzy_of("say abcdeXghij now", ["abcdefghij"]) == 1.0 and S.fuzzy_of("say abcXeXgXij now", ["abcdefghij"]) == 0.0
    assert S.rouge_l_of("a b c", ["a c b"]) == pytest.approx(2 / 3) and S.rouge_l_of("A b", ["a c"]) == 0.0
    rows = [("a b c d e", ["a b c d e"], "bleu"), (None, None, "rouge"), ("a b", ["a b c d"], "bleu"), ("a c b", ["x", "a b c"], "bleu"), ("", ["a"], "bleu"), ("PARIS", ["paris", None], "bleu")]
    df = spark.createDataFrame(rows, "t string, r array<string>, m string")
    one, two = S.rouge12(F.col("t"), F.col("r"))
    out = df.select(S.bleu(F.col("t"), F.col("r")).alias("b"), one.alias("r1"), two.alias("r2"), S.rouge_l(F.col("t"), F.col("r")).alias("rl"), S.fuzzy(F.col("t"), F.col("r")).alias("f")).collect()
    assert [(r.b, r.r1, r.r2, r.f) for r in out[:2]] == [(1.0, 1.0, 1.0, 1.0), (0.0, 0.0, 0.0, 0.0)] and out[0].rl == 1.0
    assert out[2].b == pytest.approx(math.exp(1 - 4 / 2))  # all runs are there, but two words stand against four
    assert (out[3].r1, out[3].r2, out[3].rl) == (1.0, 0.0, pytest.approx(2 / 3))
    assert out[3].b == pytest.approx((4 / 4 * 1 / 3 * 1 / 2 * 1) ** 0.25)
    assert out[4].b == 0 and out[5].r1 == 0 and out[5].f == 1.0  # case counts for words, not for the fuzzy match
    with pytest.raises(Exception, match="unknown metric"):
        df.select(S.primary(F.lit("other"), F.lit(1.0), F.lit(1.0), F.lit(1.0))).collect()


def test_scorers_by_name(spark):
    @S.scorer("same")
    def same(reply, references):
        return F.array_contains(references, reply).cast("int")

    df = spark.createDataFrame([("a b", ["a b", "c"])], "reply string, references array<string>")
    r = S.scored(df, ["same", "rouge1", "rouge2", "accuracy"]).first()
    assert (r.same, r.rouge1, r.rouge2, r.accuracy) == (1, 1.0, 1.0, 1.0)
    with pytest.raises(ValueError):
        S.scored(df, ["none"])
