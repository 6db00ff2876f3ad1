"""Labelled pairs for problem 1: one half validates the cutoffs, the other is held out and measures.

The halves share no topic, no refusal, no foreign reply and no lead-in.
"""

from __future__ import annotations

# Fixed values: (prompt, answer in two sentences), the first half of each list for the cutoffs.
TOPICS = [
    ("How do I brew coffee at home?", "Boil the water and let it rest for a minute. Pour it over the ground beans and wait before you press."),
    ("كيف أزرع النعناع في الشرفة؟", "اختر وعاء فيه فتحات وضع فيه تربة خفيفة. اسق النبتة كل يومين وأبعدها عن شمس الظهر."),
    ("Comment réparer une chambre à air ?", "Démontez la roue et cherchez le trou dans une bassine d'eau. Collez la pièce et laissez sécher avant de remonter."),
    ("What is the best way to store old photographs?", "Keep them in boxes without acid and away from the light. Wear gloves when you sort them by year."),
    ("وش الفرق بين البطارية الجافة والسائلة؟", "الجافة ما تحتاج ماء وتدوم أكثر في الحر. السائلة أرخص لكن لازم تفحص الماء كل شهر."),
    ("Why does bread rise in the oven?", "The yeast makes gas that fills the dough with bubbles. The heat sets the crumb before the bubbles can escape."),
    ("كيف أرتب ميزانية الشهر لعائلة صغيرة؟", "اكتب الدخل والمصاريف الثابتة في جدول واحد. خصص عشرة بالمئة للادخار قبل أي مصروف آخر."),
    ("How can I keep my bicycle chain from rusting?", "Wipe it dry after rain and put a drop of oil on each link. Store the bike indoors when the air is damp."),
    ("كيف أنظف زجاج السيارة من البقع؟", "رش محلول الخل المخفف على الزجاج واتركه دقيقتين. امسحه بقطعة قماش ناعمة في اتجاه واحد."),
    ("Comment conserver le basilic frais ?", "Coupez les tiges et placez-les dans un verre d'eau. Changez l'eau chaque jour et gardez le verre loin du froid."),
    ("What should I pack for a week in the mountains?", "Take layers that dry fast and boots you have already worn. Add a map, a lamp and food for one more day."),
    ("وش أفضل وقت لقص أشجار الزيتون؟", "القص يكون بعد جمع الثمار وقبل بداية الربيع. ابدأ بالأغصان اليابسة ثم افتح وسط الشجرة للضوء."),
    ("Why do leaves change their colour in autumn?", "The tree stops making the green pigment when the days grow short. The yellow and red that were hidden then show."),
    ("كيف أعلم طفلي السباحة في الصيف؟", "ابدأ معه في ماء ضحل وعوده على النفخ تحت الماء. استخدم لوح الطفو حتى يتقن حركة الرجلين."),
]
REFUSALS = [
    "Sorry, I can't help with that.", "I'm afraid I am not able to answer this. You may try another source.", "As a language model I hold no view on it.", "My apologies, let us move to another subject.",
    "عذراً، ما أقدر أجاوب على هذا السؤال.", "للأسف لا يمكنني المساعدة في هذا الطلب، وأتمنى تتفهم ذلك.", "سامحني، ما عندي صلاحية أتكلم في هالموضوع.", "Désolé, je ne peux pas répondre à cette demande.",
    "I'd rather skip this one. Ask an expert instead.", "That is outside my scope, please consult a professional.", "I must decline to respond here.", "I won't discuss this topic.",
    "أعتذر عن الإجابة على هذا الطلب.", "هذا الموضوع خارج اختصاصي، راجع مختص.", "لن أجيب على هذا.", "Je préfère ne pas traiter ce sujet.",
]
FOREIGN = [
    "Para esto conviene esperar un poco y luego seguir los pasos con calma.", "Bence en iyi yol önce biraz beklemek ve sonra yeniden denemektir.", "برای این کار بهتر است اول کمی صبر کنید و بعد آن را ادامه دهید.", "Сначала подготовьте всё нужное, а потом действуйте по порядку.",
    "اس کے لیے پہلے کچھ دیر رکیں اور پھر کام کو آہستہ سے شروع کریں۔", "Am besten warten Sie ein wenig und beginnen dann mit der ersten Aufgabe nach der Liste.", "まず必要なものを準備してから順番に進めてください。", "먼저 필요한 것을 준비한 다음 순서대로 진행하세요.",
    "É melhor esperar um pouco e depois fazer uma coisa de cada vez com calma.", "Conviene aspettare un po' e poi fare una cosa alla volta con la lista che hai.", "Het is beter om eerst te wachten en dan met de lijst van de dag te beginnen.", "首先准备好所有的材料然后按照顺序开始。",
    "Lepiej jest najpierw poczekać i dopiero po tym zacząć od tego co jest na liście.", "Πρώτα ετοιμάστε ό,τι χρειάζεται και μετά ξεκινήστε με τη σειρά.", "Önce gerekli olan her şeyi hazırlamak ve sonra bir liste ile başlamak daha iyi.", "पहले सब सामान तैयार करें और फिर क्रम से काम शुरू करें।",
]
LEADS = ["{q}", "You mean {q}", "سؤالك: {q}", "{q} {q}", "Your question: {q}", "تقصد {q}", "{q}\n{q}", "You asked {q}"]
HELPFUL = ["Sorry for the wait, here it is: {a}", "ما أقدر أختار عنك، لكن هذي المقارنة: {a}", "I can't choose for you, but this should help: {a}", "آسف على التأخير، الجواب هو: {a}"]
EMPTY = ["", "...", "```\n```", "-", "…", "** **", "?!", "​"]
ENDS_OPEN = {"ar": ["ثم ضع الوعاء على", "وبعدها تأكد من"], "en": ["After that put the pot on the", "Then make sure that you have"], "fr": ["Ensuite posez le tout sur la", "Puis vérifiez que vous avez le"]}


def language(text: str) -> str:
    return "ar" if any("ء" <= c <= "ي" for c in text) else "fr" if "é" in text or "Comment" in text else "en"


def labelled(held_out: bool) -> list[tuple[str, str, tuple[str, ...]]]:
    """(prompt, reply, defects) of one half."""
    half = lambda x: x[len(x) // 2 :] if held_out else x[: len(x) // 2]
    topics, refusals, foreign, leads, helpful, empty = half(TOPICS), half(REFUSALS), half(FOREIGN), half(LEADS), half(HELPFUL), half(EMPTY)
    out: list[tuple[str, str, tuple[str, ...]]] = []
    for n, (q, a) in enumerate(topics):
        mine = language(q)
        one, two = a.split(". ", 1)
        ask = {"ar": "ترجم لي للإنجليزي: ", "en": "Translate into French: ", "fr": "Traduis en anglais : "}[mine]
        given = {"ar": "Keep the pot away from the sun and water it every other day.", "en": "Gardez le tout dans une boîte sans acide et loin de la lumière.", "fr": "Take the wheel off and look for the hole in a bowl of water."}[mine]
        other = next(x for k in range(1, len(topics)) if language((x := topics[(n + k) % len(topics)])[0]) != mine)
        sound = [a, a.rstrip("."), f"{q} {a}", f"- {one}\n- {two.rstrip('.')}", f"1. {one}.\n2. {two}", f"{one}.\n```\nrun(1)\n```"]
        out += [(q, x, ()) for x in sound] + [(q, h.format(a=a), ()) for h in helpful if language(h) == mine] + [(ask + a, given, ())]
        out += [(q, x.format(q=q if n % 2 else q.rstrip("?؟ ")), ("echo",)) for x in leads if x[0] == "{" or language(x) == mine]
        out += [(q, r, ("refusal",) if language(r) == mine else ("refusal", "wrong_language")) for k in range(4) for r in [refusals[(n + k) % len(refusals)]]]
        out += [(q, foreign[(n + k) % len(foreign)], ("wrong_language",)) for k in range(3)] + [(q, other[1], ("wrong_language",))]
        out += [(q, f"{one}. {ENDS_OPEN[mine][held_out]}", ("truncated",)), (q, f"{one},", ("truncated",)), (q, f"1. {one}.\n2. {two}\n3.", ("truncated",)), (q, f"{one}:\n```python\nfor x in items:\n    total =", ("truncated",))]
        out += [(q, empty[n % len(empty)], ("empty",)), (q, empty[(n + 1) % len(empty)], ("empty",))]
    return out
