import os
import random
import sys

from marsad.llm import residue

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


EXEMPLARS = residue.Exemplars()


def kind(text):
    return residue.judge(text, EXEMPLARS)[0]


def test_slots_outside_code():
    for t in ["Dear {{customer_name}}, hi", "see ${TITLE} now", "in {% city %} today", "by [insert title] of", "[[product.name]] is", "<user_name> said", "%(date)s was", "@@TITLE@@ x", "#user_name# y", "__CITY__ line", "مع <<اسم العميل>> اليوم", "في {التاريخ} قبل", "عند #أدخل الرقم# ثم"]:
        assert kind(t) == "slot", t
    for t in ["```python\nprint(f'{name}')\n```", "use `{{name}}` here", "array[i] and f(x)", "see [the page](http://x.example)", "a <b>bold</b> word", "C# and F# are close", "he said [sic] so", "issue #1 and #2", "set {1, 2}", "x_1 and snake_case_name"]:
        assert kind(t) is None, t


def test_filler_alone_and_within():
    for t in ["test test 123", "تجربة تجربة ١٢٣", "سيتم إضافة النص هنا قريباً", "Real words first. سيتم إضافة النص هنا قريباً and then more real words", "Magna dolor lectus amet vitae."]:
        assert kind(t) == "filler", t
    for t in ["Designers call dummy copy greeking and strip it before launch.", "المصمم يسمي النص المؤقت حشواً ويحذفه قبل النشر.", "magna carta was signed", "We test the test bench 123 times a day."]:
        assert kind(t) is None, t


def test_notice_only_as_the_whole_value():
    for t in ["Error 404: the page you asked for was not found", "Home | Contact | About You need to enable scripts and cookies to run this app Site map", "خطأ 404: الصفحة المطلوبة غير موجودة", "فشل تحميل المحتوى [156855]", "الرئيسية | اتصل بنا هذا الموقع لا يعمل بدون تشغيل السكربتات وملفات الارتباط ©"]:
        assert kind(t) == "notice", t
    for t in ["رقم 404 عند فريقنا يعني أن الصفحة نُقلت، والحل تحديث الرابط من لوحة التحكم.", "And if a config file is missing?", "What if the page is not found?", "To turn scripts on in your browser open settings, then privacy, and flip the option there.", "Access denied. That is what the old guard said to all the people who came to the gate in the early morning of the feast.", "", "   "]:
        assert kind(t) is None, t


def test_operator_on_dirty_rows(spark):
    rows = [("m", 1, "content", None), ("m", 2, "content", ""), ("m", 3, "content", "hi {{name}}"), ("m", 3, "content", "hi {{name}}"), ("m", 4, "content", "fine text " * 20_000), ("p", 3, "page_text", "test test 123"), ("p", None, None, "test test 123")]
    df = spark.createDataFrame(rows, "record_table string, record_id long, field_name string, text string").selectExpr("*", "1 as kind", "2 as coverage")
    got = {(r.record_table, r.record_id, r.field_name): r.kind for r in residue.residue(df).collect()}
    assert got == {("m", 3, "content"): "slot", ("p", 3, "page_text"): "filler", ("p", None, None): "filler"}
    assert residue.residue(df.limit(0)).count() == 0


def test_forms_that_the_user_asked_for(spark):
    m = spark.createDataFrame(
        [(1, 1, 0, "User ", "Draft a blank letter and leave brackets for me to fill in"), (2, 1, 1, "assistant", "Dear [name],"), (3, 2, 0, "user", "Write a letter"), (4, 2, 1, "Assistant", "Dear [name],"), (5, 2, None, None, None)],
        "message_id long, seed_index long, turn int, role string, content string",
    )
    assert [r.message_id for r in residue.asked_for_blanks(m).collect()] == [2]


def test_fresh_texts():
    import fresh_residue

    missed = [t for t in fresh_residue.RESIDUE if kind(t) is None]
    false = [t for t in fresh_residue.REAL if kind(t) is not None]
    found = len(fresh_residue.RESIDUE) - len(missed)
    assert found >= 0.9 * len(fresh_residue.RESIDUE), missed
    assert found >= 0.9 * (found + len(false)), false


def test_index_and_windows_lose_nothing():
    rng = random.Random(3)
    idf = residue.Idf({w: rng.uniform(1, 9) for w in EXEMPLARS.vocabulary})
    e = residue.Exemplars(idf)
    by_kind = {k: [i for i, (x, _) in enumerate(e.texts) if x == k] for k in e.kinds}
    hits = 0
    for round_ in range(60):
        k = rng.choice(list(e.kinds))
        t = []
        for _ in range(3):
            x = list(e.texts[rng.choice(by_kind[k])][1])
            for _ in range(rng.randrange(3)):
                n = rng.randrange(len(x) + 1)
                if rng.random() < 0.5:
                    x.insert(n, "other")
                elif len(x) > 1:
                    del x[n % len(x)]
            t += x + ["between"] * rng.randrange(3)
        got = {i for i, _ in e.matches(t, k)}
        want = {i for i in by_kind[k] if any(e.held(i, t[a : a + e.width(i)]) >= residue.CONTAINED - 1e-9 for a in range(len(t)))}
        assert got == want
        hits += len(want)
    assert hits > 100


def test_long_slots_and_real_brackets():
    assert kind("Dear [" + "your name and address " * 30 + "], hello") == "slot"
    for t in ["set {x_1} and {y}", "the array [first draft of a novel by a friend]", "a <custom element> of ours", "see [[Battle of the Bay]]", "run ${HOME}/bin"]:
        assert kind(t) is None, t
