"""Problem 1: defective prompt and response pairs by labelling functions and an EM label model."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marsad.llm import forms, residue
from marsad.llm.pair_labels import labelled
from marsad.session import cut
from marsad.tables import load, role

DEFECTS = ("empty", "refusal", "wrong_language", "echo", "truncated")

# Frequent short words of each language.
STOP_WORDS = {
    "ar": "في من على إلى عن مع هذا هذه التي الذي ما لا أن إن أو ثم بعد قبل كل هو هي كان وش اللي لو إذا عند بين كيف ليش متى هل لي لك عشان زي وأنا كم راح بس يا حتى غير أول هذي لكن منذ حول",
    "en": "the of and to in is for with that on at by from as it this be are was or an not you we what which how if then does do when why who can about than into more",
    "fr": "le la les de des du et à en un une est pour avec par sur dans qui que ce cette ou pas plus l d on se sont au aux ne il elle nous vous sans puis selon près comme",
    "es": "el los las de y en un una para que con por lo es del al se su como más pero está hace así lista puedes luego después sus hay primero",
    "tr": "ve bir bu için ile da de çok olan daha en ise gibi kadar sonra önce bence eğer ya ki konuda bütün ardından olarak iyi yol",
    "fa": "از به در که را این با برای است می و یک آن تا هر باید پیش بعد شما من کنید است شد های طبق بهتر دوباره",
    "ur": "کے کی کا میں ہے ہیں سے اور کو نے پر یہ ایک تو آپ پھر اگر گا کریں لیے بہت تھا کر ہو کہ جائے",
    "de": "der die das und ist nicht ein eine zu den mit von auf für im dem sich auch wie oder als bei nach",
    "it": "il lo gli di che è un una per con non sono del della nel alla più come anche ma se",
    "pt": "o os as de que em um uma para com não por mais como mas do da no na ao ser são você",
    "nl": "de het een en van niet is op te dat voor met zijn aan er maar ook als dan bij of uit moet kan wordt",
    "sv": "och att det som en är på för av med den till inte om ett har de eller kan när måste här",
    "pl": "i w na z do nie jest to się że po jak ale przez przed od za co tak już można lub oraz",
    "id": "yang dan di itu dengan untuk dari ini tidak pada adalah akan ke dalam atau bisa juga lebih jika anda",
    "ro": "și în de la cu pe nu este că din pentru mai sau dar care sunt fi după când trebuie",
}
# Letters that mark a language among those of its script. Look-alikes of Arabic letters are left out.
MARK_LETTERS = {"fa": "پچژگ", "ur": "ےںٹڈڑھ", "tr": "ğşıİ", "es": "ñ¿¡", "fr": "èêçœàùîôû", "de": "ßä", "pt": "ãõ"}

# How a reply declines, on bare words.
DECLINES = re.compile(
    r"\b(?:(?:ما|لا|لن|لم|ماني|مب|مو)(?: راح)? (?:اقدر|استطيع|يمكنني|يمكن|قادر|اتمكن|عندي صلاحيه|املك صلاحيه)|لست قادر|غير قادر|(?:يتعذر|تعذر|يصعب) علي|كنموذج لغوي|نموذج لغه|خارج (?:نطاق|قدرتي|اختصاصي|صلاحياتي|مجالي)|"
    r"ما عندي صلاحي\w|ليس من صلاحيا\w+|افضل عدم|افضل الا|اكتفي بهذا|نغير الموضوع|ما اتعامل|غير متاح\w? لي|له اهله|ارفض|لا اود|لا ارغب|ما ودي|"
    r"(?:اعتذر|نعتذر|اعتذاري) عن (?:الاجابه|الإجابة|الاجابة|الرد|المساعدة|المساعده|تقديم|الخوض|الحديث|الكلام|تنفيذ|هذا|هذه)|(?:لن|لا) (?:اجيب|اساعد|ارد|اشارك|اناقش|اتحدث|اخوض|اقدم)|(?:ممنوع|غير مسموح|لا يسمح|لا يحق|ما يحق) (?:علي|لي)|"
    r"(?:can t|cannot|can not|won t|will not|not able to|unable to|not allowed to|not permitted to|not comfortable|not in a position to|couldn t|could not|must not) (?:\w+ )?"
    r"(?:help|assist|answer|continu|discuss|provid|respond|comply|shar|complet|giv|offer|advis|comment|speak|talk|support|engag|fulfil|do\b|be able|say\b|go into|get into|take\b)|"
    r"(?:won t|not) be able|not able to|unable to|have to (?:decline|refuse|pass|say no)|must (?:decline|refuse|pass)|decline (?:this|that|to)|refuse to|language model|goes beyond|beyond what|rather (?:not|skip|pass|leave|avoid|stay)|prefer (?:not|to skip|to pass|to leave|to avoid)|no answer is available|better left to|"
    r"move to another subject|change the subject|isn t something i|not something i|conversation has to stop|against (?:my|the|our) (?:polic|rule|guideline)|hold no view|no comment on|i ll (?:pass|skip)|will (?:pass|skip) on|"
    r"(?:outside|beyond|out of) (?:my|our|the) (?:scope|remit|abilit|expertise|limits|reach|competence|capabilit|field)|not (?:my|a) (?:place|field|topic i|subject i)|(?:don t|do not) (?:discuss|answer|cover|handle|respond|engage|deal)|"
    r"je ne (?:peux pas|suis pas (?:en mesure|autorisé|habilité)|souhaite pas|saurais|répond\w* pas|traite pas)|je (?:dois (?:refuser|décliner)|refuse|préfère (?:ne pas|m abstenir|passer)|préférerais|regrette de ne)|modèle de langage|hors de (?:ma|mes|mon|nos)|pas de mon ressort|impossible (?:pour moi )?de (?:répondre|vous aider|vous répondre))"
)
# Words of which every way to decline above has one; they are quicker to look for.
DECLINE_WORDS = set(forms.bare_words(
    "اقدر استطيع يمكنني يمكن قادر اتمكن عندي املك لست غير يتعذر تعذر يصعب كنموذج نموذج خارج افضل اكتفي نغير اتعامل اهله ارفض اود ارغب ودي اعتذر نعتذر اعتذاري اجيب اساعد ارد اشارك اناقش اتحدث اخوض اقدم ممنوع مسموح يسمح يحق ليس "
    "can cannot won will not unable couldn could must decline refuse language beyond goes rather prefer no better move change isn conversation against hold ll outside out don do "
    "peux suis souhaite saurais réponds répondrai répond traite dois refuse préfère préférerais regrette modèle hors ressort impossible"
))
# Courtesy around a refusal or an answer; such clauses neither help nor decline.
COURTESY = re.compile(
    r"^(?:عذرا|اسف|معليش|سامحني|للاسف|مع الاسف|الصراحه|اعتذر(?:ت|لك|نا)?\b|افهم طلبك|شكرا على|واتمنى تتفهم|اتمنى تتفهم|انصحك تسال|اسال مختص|راجع مختص|استشر|هل عندك سؤال|اقدر اساعدك في|الله يعطيك|جرب مصدر|حسب السياسه|يعطيك العافيه|تفضل|"
    r"sorry|apologies|my apologies|unfortunately|regrettably|i m afraid|i am afraid|hmm|thanks for asking|thanks for the question|thank you|i understand|please (?:ask|consult|contact|see|speak)|ask (?:an?|your|someone)\b|consult|you may try|is there anything|happy to help|have a good|under the current policy|"
    r"désolé|je suis désolé|malheureusement|merci|je comprends|adressez vous|demandez à|consultez)"
)
# Words of which every courtesy above has one.
COURTESY_WORDS = set(forms.bare_words(
    "عذرا اسف معليش سامحني للاسف الاسف الصراحه اعتذر اعتذرت اعتذرلك اعتذرنا افهم شكرا واتمنى اتمنى انصحك اسال راجع استشر عندك اساعدك يعطيك جرب السياسه العافيه تفضل "
    "sorry apologies unfortunately regrettably afraid hmm thanks thank understand please ask consult may anything happy good policy désolé malheureusement merci comprends adressez demandez consultez"
))
LEAD_INS = re.compile(
    r"^(?:سؤالك|تقصد|قصدك|تسال|انت تسال|تريد ان تعرف|تبي تعرف|تبغى تعرف|السؤال هو|السؤال عن|you mean|your question(?: is| was)?|you asked|you are asking|you re asking|so you re asking|you (?:want|would like|wish|need) to know|you re wondering|you wonder|the question (?:is|was)|votre question|vous demandez|vous voulez savoir|tu demandes|tu veux savoir|la question est)\b"
)
OTHER_LANGUAGE_WANTED = re.compile(
    r"(?i)ترجم|بالإنجليزي|بالانجليزي|للإنجليزي|للانجليزي|الإنجليزية|الانجليزية|بالفرنسي|للفرنسي|الفرنسية|بالعربي|للعربي|بالفارسي|بالتركي|بالأوردو|بالإسباني"
    r"|translat|in (?:english|arabic|french|spanish|turkish|persian|urdu|german)|into (?:english|arabic|french|spanish)|tradui|en (?:anglais|arabe|français|espagnol)"
)
# Pieces of which every wish for another language has one, in lower case; they are quicker to look for.
_WANTED_PIECES = ("ترجم", "نجليزي", "فرنسي", "بالعربي", "للعربي", "فارسي", "تركي", "أوردو", "إسباني", "translat", "english", "arabic", "french", "spanish", "turkish", "persian", "urdu", "german", "tradui", "anglais", "arabe", "français", "espagnol")


def other_language_wanted(prompt: str) -> bool:
    low = prompt.lower()
    return any(x in low for x in _WANTED_PIECES) and OTHER_LANGUAGE_WANTED.search(prompt) is not None


_FENCE = re.compile(r"```.*?(?:```|\Z)|`[^`\n]*`", re.S)
_CLAUSE = re.compile(r"[.!?؟،,;؛:\n。۔…]+")
_STOP = ".!?؟。۔．…"
_SENTENCE = re.compile(r"(?<=[.!?؟。۔．…])[\s‎‏]+|\n+")
_BULLET = re.compile(r"^\s*(?:[-*•#>]+|\d+[.)-])\s*")
_MARKER = re.compile(r"[-*•]|\(?(?:(\d{1,3})[.)-]|([^\W\d_])[.)])")
_SHOWN, _DIGIT = re.compile(r"[^\W_]"), re.compile(r"\d")

_STOPS = {k: set(forms.bare_words(v)) for k, v in STOP_WORDS.items()}
_LETTERS = {k: re.compile("[" + v + "]") for k, v in MARK_LETTERS.items()}
_ARABIC, _LATIN = re.compile("[ء-يپچژگکیےںہھٹڈڑ]"), re.compile("[A-Za-zÀ-ɏ]")
_THREE_ARABIC, _THREE_LATIN = (re.compile(f"(?:[{c}][^{c}]*){{3}}") for c in (_ARABIC.pattern[1:-1], _LATIN.pattern[1:-1]))
# any character beyond Latin, combining marks, Arabic, punctuation and symbols
_FARTHER = re.compile("[^\x00-\u02ff\u0300-\u036f\u0600-\u06ff\u0750-\u077f\u1e00-\u1eff\u2000-\u2bff\ufb50-\ufdff\ufe00-\ufeff]")
# Scripts that one language writes together.
_TOGETHER = {"cjk": "east asian", "hiragana": "east asian", "katakana": "east asian"}


_LANGUAGES: dict[str, list[str]] = {}
for _k, _s in _STOPS.items():
    for _w in _s:
        _LANGUAGES.setdefault(_w, []).append(_k)
_ANY_LETTER = re.compile("[" + "".join(MARK_LETTERS.values()) + "]")


@lru_cache(maxsize=20_000)
def script_of(c: str) -> str:
    """The script of a letter by its name in the Unicode database; none for other characters."""
    name = unicodedata.name(c, "").partition(" ")[0].lower() if c.isalpha() else ""
    return _TOGETHER.get(name, name)


def script(text: str) -> str:
    """The script of most letters; none below three letters."""
    if _FARTHER.search(text) is None:
        # a text with letters of one script only needs no more than its first three
        if _LATIN.search(text) is None:
            return "arabic" if _THREE_ARABIC.search(text) else ""
        if _ARABIC.search(text) is None:
            return "latin" if _THREE_LATIN.search(text) else ""
        n = {"arabic": len(_ARABIC.findall(text)), "latin": len(_LATIN.findall(text))}
    else:
        n = Counter(k for c in text if (k := script_of(c)))
    return max(n, key=n.get) if sum(n.values()) >= 3 else ""


def languages(words: list[str]) -> dict[str, float]:
    """The share of words that are frequent words of each language."""
    n = dict.fromkeys(_STOPS, 0)
    for w in filter(_LANGUAGES.__contains__, words):
        for k in _LANGUAGES[w]:
            n[k] += 1
    return {k: v / len(words) for k, v in n.items()} if words else {}


def sentences(text: str) -> list[str]:
    return [s for x in _SENTENCE.split(_FENCE.sub("\n", text)) if (s := _BULLET.sub("", x).strip())]


def hangs(stripped: str) -> bool:
    """Whether a text stops at a bare list marker. Several bare ones in turn are a blank form; a number or letter needs a list that it continues."""
    before, _, end = stripped.rpartition("\n")
    before, m = before.rstrip(), _MARKER.fullmatch(end.strip())
    if not m or not before or _MARKER.fullmatch(before.rpartition("\n")[2].strip()):
        return False
    items = [i for x in before.split("\n") if (i := _MARKER.match(x.strip()))]
    if m.group(1):
        n = int(m.group(1))
        return n == 1 or any(i.group(1) and int(i.group(1)) in (n - 1, n) for i in items)
    return not m.group(2) or any(i.group(2) for i in items)


def closes(stripped: str) -> bool:
    """Whether a text ends with a bracket that has its opening one."""
    pair = {")": "(", "]": "[", "}": "{", "»": "«", "”": "“"}.get(stripped[-1])
    return pair is not None and stripped.count(pair) == stripped.count(stripped[-1])


class Ids(forms.Ids):
    """Word -> 64-bit id, where all numbers of up to four digits share one, and all codes another."""

    def __missing__(self, word: str) -> int:
        shared = residue.masked([word])[0]
        if shared is word or shared == word:
            return super().__missing__(word)
        v = self[word] = self[shared]
        return v


_FIRST, _SKIP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_ALL = (1 << 64) - 1


def openings(w: list[int]) -> list[int]:
    """Ids of the first two words, and of the first and third, for sentences with a name in between."""
    out = [(w[0] * _FIRST ^ w[1]) & _ALL] if len(w) > 1 else []
    return out + [(w[0] * _SKIP ^ w[2]) & _ALL] if len(w) > 2 else out


class Frames:
    """What complete sentences of the corpus look like; words and openings are ids.

    ``needed``: opening -> words that nearly all complete sentences with it have.
    ``last``: opening -> its frequent last words; ``closed``: openings nearly all of whose sentences end in those.
    ``inner``: frequent words that hardly ever end a sentence; ``enders``: words that often do.
    """

    def __init__(self, needed: dict | None = None, last: dict | None = None, closed: set | None = None, inner: set | None = None, enders: set | None = None):
        self.needed, self.last, self.closed, self.inner, self.enders = needed or {}, last or {}, closed or set(), inner or set(), enders or set()

    def cut_off(self, opening: int, words: list[int]) -> bool:
        """Whether words with a known opening lack what complete sentences with it have."""
        needed, last = self.needed[opening], self.last.get(opening, ())
        if words[-1] in last:
            return not set(needed) <= set(words)
        return len(words) < 3 or opening in self.closed and words[-1] not in self.enders or words[-1] in needed or not set(needed) <= set(words)


#: Openings and words below this share of all sentences or words are not learnt. As shares add up to one, the tables
#: have at most 2 / LEAST_SHARE openings and 1 / LEAST_SHARE words at any size of the corpus; LEAST_COUNT only says
#: from how many sentences on a share can be told.
LEAST_SHARE, LEAST_COUNT = 2e-5, 20
_KINDS = ("frame", "last", "has", "word", "end", "known", "bucket", "replies")


def learn(replies: DataFrame) -> tuple[Frames, residue.Idf]:
    """Count sentence frames and document frequencies over all replies, in one pass.

    Only frames and words above a fixed share of all sentences reach the driver, and counts of the
    exemplars' words and of a fixed number of buckets.
    """
    vocabulary = {w: forms.digest(w) for w in residue.Exemplars().vocabulary}
    wanted = np.sort(np.array(list(vocabulary.values()), np.int64).view(np.uint64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids()
        none = np.zeros(0, np.uint64)
        held: dict[int, list] = defaultdict(list)

        def flush() -> pa.RecordBatch:
            out = [np.zeros(0, np.int8)], [none], [none], [np.zeros(0, np.int64)]
            for kind, parts in held.items():
                o, w = (np.concatenate([p[i] for p in parts]) for i in range(2))
                _, at, n = np.unique(o * np.uint64(_FIRST) ^ w, return_index=True, return_counts=True)
                for x, v in zip(out, (np.full(len(at), kind, np.int8), o[at], w[at], n)):
                    x.append(v)
            held.clear()
            kinds, o, w, n = (np.concatenate(x) for x in out)
            return pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(o.view(np.int64)), pa.array(w.view(np.int64)), pa.array(n)], names=["kind", "opening", "word", "n"])

        def add(kind: str, o: np.ndarray | None, w: np.ndarray) -> None:
            held[_KINDS.index(kind)].append((np.zeros(len(w), np.uint64) if o is None else o, w))

        size = 0
        for b in forms.slices(batches):
            words, lengths, complete, reply, n = [], [], [], [], 0
            for x in b.column(0).to_pylist():
                if not x:
                    continue
                s = sentences(forms.bare(forms.consistent(x)))
                for i, y in enumerate(s):
                    w = forms.runs(y)
                    if w:
                        words += w
                        lengths.append(len(w))
                        complete.append(len(w) >= 3 and (i < len(s) - 1 or y[-1] in _STOP))
                        reply.append(n)
                n += 1
            add("replies", None, np.zeros(n, np.uint64))
            if not words:
                continue
            h, lengths, complete = ids.of(words), np.array(lengths), np.array(complete)
            of_reply = np.repeat(np.array(reply, np.uint64), lengths)
            _, at = np.unique(of_reply * np.uint64(_SKIP) ^ h, return_index=True)  # the distinct words of each reply
            seen = h[at]
            place = np.minimum(np.searchsorted(wanted, seen), len(wanted) - 1)
            add("known", None, seen[wanted[place] == seen])
            add("bucket", None, np.unique(of_reply[at] << np.uint64(32) | seen & np.uint64(residue.BUCKETS - 1)) & np.uint64(residue.BUCKETS - 1))
            starts = (np.cumsum(lengths) - lengths)[complete]
            lengths = lengths[complete]
            if not len(starts):
                continue
            of = np.repeat(np.arange(len(starts)), lengths)
            place = np.arange(len(of)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            h = h[np.repeat(starts, lengths) + place]
            first = np.cumsum(lengths) - lengths
            last = h[first + lengths - 1]
            opened = [h[first] * np.uint64(_FIRST) ^ h[first + 1], h[first] * np.uint64(_SKIP) ^ h[first + 2]]
            add("word", None, h)
            add("end", None, last)
            later = np.flatnonzero(place >= 2)
            _, at = np.unique(of[later].astype(np.uint64) * np.uint64(_SKIP) ^ h[later], return_index=True)
            later = later[at]
            for o in opened:
                add("frame", o, np.zeros(len(o), np.uint64))
                add("last", o, last)
                add("has", o[of[later]], h[later])
            size += 5 * len(h)
            if size > 3_000_000:
                yield flush()
                size = 0
        yield flush()

    counts = replies.select("reply").mapInArrow(count, "kind byte, opening long, word long, n long").groupBy("kind", "opening", "word").agg(F.sum("n").alias("n"))
    of = {k: i for i, k in enumerate(_KINDS)}
    sums = cut(counts.filter(~(F.col("kind").isin(of["has"], of["last"]) & (F.col("n") < 3))))

    def kind(name: str) -> DataFrame:
        return sums.filter(F.col("kind") == of[name]).select("opening", "word", "n")

    total = kind("frame").agg(F.sum("n")).first()[0] or 0
    least = max(LEAST_COUNT, total * LEAST_SHARE)
    frames = kind("frame").filter(F.col("n") >= least).select("opening", F.col("n").alias("whole"))
    unsigned = lambda v: v & _ALL
    needed, last = {unsigned(r.opening): set() for r in frames.toLocalIterator()}, defaultdict(dict)
    for r in kind("has").join(frames, "opening").filter(F.col("n") >= 0.96 * F.col("whole")).toLocalIterator():
        needed[unsigned(r.opening)].add(unsigned(r.word))
    for r in kind("last").join(frames, "opening").filter(F.col("n") >= 0.002 * F.col("whole")).toLocalIterator():
        last[unsigned(r.opening)][unsigned(r.word)] = r.n / r.whole
    closed = {o for o, w in last.items() if sum(w.values()) >= 0.9}
    ends = kind("end").select("word", "n")
    words = kind("word").select("word", F.col("n").alias("whole"))
    often = words.filter(F.col("whole") >= max(50, total * 12 * LEAST_SHARE))
    seen = words.filter(F.col("whole") >= max(5, total * LEAST_SHARE / 10))
    enders = {unsigned(r.word) for r in seen.join(ends, "word").filter(F.col("n") >= 0.05 * F.col("whole")).toLocalIterator()}
    inner = {unsigned(r.word) for r in often.join(ends, "word", "left").filter(F.coalesce("n", F.lit(0)) < 0.002 * F.col("whole")).toLocalIterator()}
    documents = kind("replies").agg(F.sum("n")).first()[0] or 0
    known = {r.word: r.n for r in kind("known").toLocalIterator()}
    others = np.zeros(residue.BUCKETS)
    for r in kind("bucket").toLocalIterator():
        others[r.word] = r.n
    idf = residue.Idf({w: 1.0 + math.log((documents + 1) / (known.get(i, 0) + 1)) for w, i in vocabulary.items()}, (1.0 + np.log((documents + 1) / (others + 1))).astype(np.float32))
    return Frames(needed, {o: set(w) for o, w in last.items()}, closed, inner, enders), idf


ABSTAIN, NO, YES = 0, 1, 2


def alike(a: list[str], b: list[str]) -> float:
    """Similarity of two word lists of any length: the words of their longest common subsequence among all.

    A bit of ``row`` stands for a word of ``a`` and is cleared where the subsequence grows by it, so a
    word of ``b`` costs a few operations on one long integer.
    """
    wanted, at = set(b), {}
    for i, w in enumerate(a):
        if w in wanted:
            at[w] = at.get(w, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for w in b:
        if w in at:
            u = row & at[w]
            row = (row + u | row - u) & full
    return 2 * (len(a) - row.bit_count()) / (len(a) + len(b))


def without_code(text: str) -> str:
    """A text without its code, or as it is where it has nothing else."""
    return (_FENCE.sub(" ", text) if "`" in text else text) or text


_PREFIXES = re.compile("^(?:وال|بال|كال|فال|لل|ال|و(?=...)|ب(?=...)|ل(?=...))")
_SUFFIXES = re.compile("(?:ing|ed|es|s|e|ly)$")
_ANY_STOP = {w for s in _STOPS.values() for w in s} | set(forms.bare_words("i me my your do does did so please tell know want brief steps"))


def stem(w: str) -> str:
    """A word without the usual prefixes of Arabic and suffixes of English."""
    if "ء" <= w[0] <= "ي":
        return _PREFIXES.sub("", w)
    return _SUFFIXES.sub("", w) if len(w) > 4 else w


def numbers_alike(words: list[str], text: str) -> list[str]:
    return words if _DIGIT.search(text) is None else ["0" if w.isdigit() else w for w in words]


def votes(prompt: str | None, reply: str | None, frames: Frames, words: list[str] | None = None, ids: Ids | None = None, text: str | None = None) -> dict[str, list[int]]:
    """The labelling functions' votes for each defect; every list has a fixed length.

    ``text`` is the reply's consistent form, ``words`` its bare words without code, where the caller has them.
    """
    ids = Ids() if ids is None else ids
    text = forms.consistent(reply or "") if text is None else text
    blank = _SHOWN.search(text) is None
    v = {"empty": [YES, YES if not any(unicodedata.category(c) == "So" for c in text) else ABSTAIN] if blank else [NO, ABSTAIN]}
    if blank:
        return v | {d: [NO] * n for d, n in (("refusal", 3), ("wrong_language", 3), ("echo", 4), ("truncated", 4))}
    shown = without_code(text)
    bare_q, bare_a = forms.bare_words(prompt or ""), forms.runs(forms.bare(shown)) if words is None else words
    q, a = numbers_alike(bare_q, prompt or ""), numbers_alike(bare_a, shown)
    asked, said = set(q), set(a)

    # refusal: without a word of a declining or courteous phrase all clauses are neither
    might = not DECLINE_WORDS.isdisjoint(said) and DECLINES.search(" ".join(a)) is not None
    if might or not COURTESY_WORDS.isdisjoint(said):
        clauses = [" ".join(w) for c in _CLAUSE.split(forms.bare(shown)) if (w := ["0" if x.isdigit() else x for x in forms.runs(c)])]
        kinds = ["declines" if might and DECLINES.search(c) else "courtesy" if COURTESY.search(c) else "other" for c in clauses]
        other = [w for c, k in zip(clauses, kinds) if k == "other" for w in c.split() if w not in asked]
    else:
        kinds, other = ["other"], [w for w in a if w not in asked]
    declined = "declines" in kinds
    v["refusal"] = [
        YES if declined else NO,
        YES if len(other) <= 4 and (declined or len(a) < 25) else NO if len(other) >= 7 else ABSTAIN,
        YES if "courtesy" in kinds and len(other) <= 6 else NO if not declined and "courtesy" not in kinds else ABSTAIN,
    ]

    # wrong language
    sa = script(shown)
    if not prompt or other_language_wanted(prompt) or len(a) < 3 and sa in ("arabic", "latin", ""):
        v["wrong_language"] = [NO, ABSTAIN, ABSTAIN]
    else:
        sq, lq, la = script(prompt), languages(bare_q), languages(bare_a)
        best_q, best_a = max(lq, key=lq.get, default=""), max(la, key=la.get, default="")
        mine = la.get(best_q, 0.0)
        sure = bool(best_a) and la[best_a] >= 0.12
        # the prompt's language among those of its script, as a prompt may be too short to tell
        family = {"arabic": ("ar",), "latin": ("en", "fr")}.get(sq, ())
        known = best_q if lq.get(best_q, 0) >= 0.12 else family[0] if len(family) == 1 else ""
        marked = set() if _ANY_LETTER.search(shown) is None else {k for k, r in _LETTERS.items() if len(r.findall(shown)) >= 2 and (k not in ("fa", "ur") or sa == "arabic") and not r.search(prompt)}
        v["wrong_language"] = [
            ABSTAIN if not sq or not sa else YES if sq != sa else NO,
            YES if sure and known and best_a != known and la[best_a] > la.get(known, 0) + 0.06 else NO if known and (mine >= 0.06 or la.get(known, 0) >= 0.06) else ABSTAIN,
            YES if marked - {known} and known not in marked else NO if not marked else ABSTAIN,
        ]

    # echo
    led = LEAD_INS.search(" ".join(a[:8]))
    core = a[len(led.group(0).split()) :] if led else a
    new = [w for w in core if w not in asked]
    fresh = len(new) / len(core) if core else 0.0
    back = len(asked & set(core)) / len(asked) if asked else 0.0
    near = q and core and (fresh <= 0.5)
    ratio = alike(q, core) if near else 0.0
    reworded = NO
    if q and core and fresh <= 0.7:
        stems = {stem(w) for w in q}
        content = [w for w in core if w not in _ANY_STOP]
        unseen = sum(stem(w) not in stems for w in content)
        if len(content) >= 2 and unseen <= 0.6 * len(content):
            reworded = YES if unseen <= 0.2 * len(content) and (led or len(core) <= 1.5 * len(q) + 3) else ABSTAIN
    v["echo"] = [
        NO if not q else YES if fresh <= 0.15 or len(core) >= 4 and len(new) <= 1 else NO if fresh > 0.35 else ABSTAIN,
        NO if not q else YES if back >= 0.7 and fresh <= 0.35 else NO if back < 0.5 or fresh > 0.5 else ABSTAIN,
        NO if not near else YES if ratio >= 0.75 else NO if ratio < 0.5 else ABSTAIN,
        reworded,
    ]

    # truncated
    stripped = text.rstrip()
    open_fence = text.count("```") % 2 == 1
    hanging = not open_fence and hangs(stripped)
    stop = not hanging and (stripped[-1] in _STOP or stripped.endswith("```"))
    votes_frame = ABSTAIN
    cutword = ABSTAIN
    if open_fence:
        pass  # the prose before open code may well be complete
    elif hanging:
        votes_frame = YES  # an item of which nothing is there; the one before may well be complete
    elif stop:
        votes_frame, cutword = NO, NO
    else:
        s = sentences(forms.bare(text))
        tail = list(map(ids.__getitem__, forms.runs(s[-1]))) if s else []
        if tail:
            candidates = [tail]
            if ":" in s[-1]:
                candidates.append(list(map(ids.__getitem__, forms.runs(s[-1].rsplit(":", 1)[1]))))
            for t in candidates:
                known = [o for o in openings(t) if o in frames.needed]
                if known:
                    votes_frame = YES if all(frames.cut_off(o, t) for o in known) else NO
            if tail[-1] in frames.inner:
                votes_frame, cutword = (votes_frame if votes_frame == YES else ABSTAIN), YES
            else:
                cutword = YES if len(tail) < 3 and len(s) > 1 else NO if votes_frame == NO else ABSTAIN
    v["truncated"] = [
        YES if open_fence else ABSTAIN if "```" not in text else NO,
        votes_frame,
        cutword,
        YES if open_fence or hanging or stripped[-1] in ",،:;؛(-/" else NO if stop or closes(stripped) else ABSTAIN,
    ]
    return v


# What each labelling function is taken to mean before any data: the chance that it says yes where it
# votes, for a sound pair, for a defective one, and for a sound one that looks defective at first sight (declines and
# then helps, repeats the question and then answers, ends without a stop). Functions are in the order of votes().
MEANING = {
    "empty": [(0.01, 0.98, 0.05), (0.33, 0.98, 0.50)],
    "refusal": [(0.04, 0.90, 0.74), (0.012, 0.98, 0.022), (0.013, 0.83, 0.04)],
    "wrong_language": [(0.001, 0.53, 0.01), (0.007, 0.975, 0.05), (0.01, 0.67, 0.14)],
    "echo": [(0.011, 0.98, 0.03), (0.006, 0.98, 0.05), (0.011, 0.94, 0.04), (0.011, 0.91, 0.03)],
    "truncated": [(0.03, 0.67, 0.10), (0.003, 0.96, 0.05), (0.003, 0.91, 0.05), (0.003, 0.80, 0.40)],
}


class LabelModel:
    """A hidden kind of each pair (sound, defective, sound but alike) per defect; functions vote independently given it.

    Works on counts of vote patterns, which hold all that EM needs to know of any number of rows. A
    function that does not vote says nothing about the kind. Each starts from its stated meaning, which then
    weighs no more than ``strength`` votes a kind against all votes of the data: what is learnt is the data's
    as soon as a kind has some hundred pairs. The third kind takes in the look-alikes that would otherwise
    pull the defective kind away.
    """

    def __init__(self, meaning: list, shares: tuple = (0.96, 0.02, 0.02), strength: float = 20.0):
        self.yes = np.array(meaning)
        self.prior, self.strength = self.yes.copy(), strength
        self.shares = np.array(shares)

    @property
    def share(self) -> float:
        """How many pairs are defective."""
        return float(self.shares[1])

    def kinds(self, patterns: np.ndarray) -> np.ndarray:
        votes = patterns[:, :, None]
        logs = np.log(self.shares) + np.where(votes == YES, np.log(self.yes), np.where(votes == NO, np.log(1 - self.yes), 0.0)).sum(axis=1)
        p = np.exp(logs - logs.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        return self.kinds(patterns)[:, 1]

    def fit(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, still: float = 1e-6) -> LabelModel:
        """EM until no chance changes by more than ``still``, or for ``rounds`` rounds."""
        if not len(counts):
            return self
        for _ in range(rounds):
            w = self.kinds(patterns) * counts[:, None]
            shares = w.sum(axis=0) + 1.0
            yes, voted = ((x[:, :, None] * w[:, None, :]).sum(axis=0) for x in (patterns == YES, patterns != ABSTAIN))
            new = (yes + self.strength * self.prior) / (voted + self.strength)
            moved = np.abs(new - self.yes).max()
            self.shares, self.yes = shares / shares.sum(), np.clip(new, 1e-6, 1 - 1e-6)
            if moved < still:
                break
        return self


def cutoffs(models: dict[str, LabelModel], frames: Frames) -> dict[str, float]:
    """The cutoff of each defect's posterior with the best F1 on the labelled pairs for it; of equal ones the middle."""
    cast = [(votes(p, r, frames), d) for p, r, d in labelled(held_out=False)]
    out = {}
    for name, m in models.items():
        p = m.posterior(np.array([v[name] for v, _ in cast]))
        y = np.array([name in d for _, d in cast])
        grid = np.linspace(0.1, 0.9, 33)
        f1 = [2 * (y & (p >= g)).sum() / max(1, y.sum() + (p >= g).sum()) for g in grid]
        best = [g for g, f in zip(grid, f1) if f >= max(f1) - 1e-9]
        out[name] = float(best[len(best) // 2])
    return out


def code(v: list[int]) -> int:
    return sum(x * 3**i for i, x in enumerate(v))


def decode(n: int, functions: int) -> list[int]:
    return [n // 3**i % 3 for i in range(functions)]


WIDTHS = {d: len(m) for d, m in MEANING.items()}


def cast_votes(pairs: DataFrame, frames: Frames, idf: residue.Idf) -> DataFrame:
    """(record_table, record_key, prompt, reply) -> (record_table, record_key, residue, a vote pattern per defect)."""
    shared = pairs.sparkSession.sparkContext.broadcast(frames)
    residues = pairs.sparkSession.sparkContext.broadcast(residue.Exemplars(idf))
    blanks = re.compile(residue._BLANKS_WANTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exemplars, ids = residues.value, Ids()
        for b in forms.slices(batches):
            left: list[bool] = []
            out: dict[str, list[int]] = {d: [] for d in DEFECTS}
            for p, r in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                text = forms.consistent(r) if r else ""
                words = forms.runs(forms.bare(without_code(text)))
                kind = residue.judge(r, exemplars, words=words if "`" not in r else None)[0] if r else None
                left.append(kind is not None and not (kind == "slot" and p is not None and blanks.search(p) is not None))
                for d, x in votes(p, r, shared.value, words, ids, text).items():
                    out[d].append(code(x))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(left, pa.bool_()), *(pa.array(out[d], pa.int32()) for d in DEFECTS)], names=["record_table", "record_key", "residue", *DEFECTS])

    schema = "record_table string, record_key string, residue boolean, " + ", ".join(f"{d} int" for d in DEFECTS)
    return pairs.select("record_table", "record_key", "prompt", "reply").mapInArrow(run, schema)


def label(pairs: DataFrame) -> DataFrame:
    """(record_table, record_key, prompt, reply) -> (record_table, record_key, residue, defect, posterior).

    A pair has a row for every defect whose posterior exceeds its validated cutoff. A null prompt is an
    unknown prompt, a null reply an empty one. Pairs whose reply is template residue are marked. A key
    that repeats counts once. Extra columns are ignored.
    """
    frames, idf = learn(pairs)
    cast = cut(cast_votes(pairs, frames, idf))
    models = {}
    for d in DEFECTS:
        seen = cast.filter("not residue").groupBy(d).agg(F.count("*").alias("n")).collect()  # at most 3 ** functions rows
        patterns = np.array([decode(r[d], WIDTHS[d]) for r in seen]).reshape(-1, WIDTHS[d])
        models[d] = LabelModel(MEANING[d]).fit(patterns, np.array([r.n for r in seen], float))
    limits = cutoffs(models, frames)
    parts = []
    for d in DEFECTS:
        all_patterns = np.array([decode(n, WIDTHS[d]) for n in range(3 ** WIDTHS[d])])
        post = F.element_at(F.array(*(F.lit(float(p)) for p in models[d].posterior(all_patterns))), F.col(d) + 1)
        parts.append(F.struct(F.lit(d).alias("defect"), post.alias("posterior"), F.lit(limits[d]).alias("cutoff")))
    rows = cast.select("record_table", "record_key", "residue", F.inline(F.array(*parts))).filter("posterior > cutoff")
    return rows.groupBy("record_table", "record_key", "residue", "defect").agg(F.max("posterior").alias("posterior"))


def best_defect(labels: DataFrame) -> DataFrame:
    """One defect a pair: an unusable reply is named by what it is as a whole before how it ends."""
    order = F.array_position(F.array(*(F.lit(d) for d in DEFECTS)), F.col("defect"))
    return labels.groupBy("record_table", "record_key").agg(F.max_by("defect", F.struct(F.round("posterior", 2), -order)).alias("defect"))


def project_pairs(spark: SparkSession, directory: str) -> DataFrame:
    m = load(spark, directory, "messages").withColumn("_role", role())
    users = m.filter("_role = 'user'").select("seed_index", (F.col("turn") + 1).alias("turn"), F.col("content").alias("prompt")).dropDuplicates(["seed_index", "turn"])
    replies = m.filter("_role = 'assistant'").select("seed_index", "turn", F.col("message_id").cast("string").alias("record_key"), F.col("content").alias("reply"))
    chat = replies.join(users, ["seed_index", "turn"]).select(F.lit("messages").alias("record_table"), "record_key", "prompt", "reply")
    style = load(spark, directory, "hybrid_references").select(F.lit("hybrid_references").alias("record_table"), F.col("id").alias("record_key"), F.col("user_message").alias("prompt"), F.col("assistant").alias("reply"))
    return chat.unionByName(style)


def p1_found(spark: SparkSession, directory: str) -> DataFrame:
    return best_defect(label(project_pairs(spark, directory)).filter("not residue")).select("record_table", "record_key", "defect")


def p1_labels(spark: SparkSession, directory: str) -> DataFrame:
    """All defects of each pair with their posteriors, template residue included."""
    return label(project_pairs(spark, directory))
