"""Problem 4: template residue, filler and site notices, found by containment of labelled exemplars.

Exemplars are retrieved through an inverted index on word pairs. An exemplar of features (its words, and
its word pairs, weighted by inverse document frequency) matches where a passage window holds enough of
its weight. Index and windows are lossless: they find whatever a scan of all exemplars over all windows
finds. Filler counts alone or within real text; a notice counts where residue words cover the value;
placeholders are found by their brackets and judged by how much of their content the labelled
placeholders contain.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marsad.llm import exemplars as E
from marsad.llm import forms
from marsad.tables import load, role

#: Share of an exemplar's weight that a window must hold, and of a value's weight that residue must cover.
CONTAINED, COVERAGE = 0.75, 0.7
#: Words that are in no exemplar are counted in so many buckets.
BUCKETS = 1 << 16
#: Passages of so many words are held against the Latin filler.
LATIN_WINDOW = 4

_CODE = re.compile(r"```.*?(?:```|\Z)|`[^`\n]+`", re.S)
# brackets that only templates use, and brackets that stand in real text too
_STRONG = re.compile(r"\{\{([^{}\n]+)\}\}|\{%([^%\n]+)%\}|\{%([^%\n]+?)[}\n]|%\(([^()\n]+)\)s|@@([^@\n]+)@@")
_WEAK = re.compile(
    r"\$\{([^{}\n]+)\}|\[\[([^\[\]\n]+)\]\]|<<([^<>\n]+)>>|(?<!\w)__([^\W_][^\n_]*(?:_[^\n_]+)*)__(?!\w)"
    r"|(?<![\w#])#([^#\s](?:[^#\n]*[^#\s])?)#(?!\w)|(?<![\\\w])\{([^\W\d][\w .]*)\}|<([^\W\d][\w .]*)>|(?<![\w\]])\[([^\W\d][^\[\]\n]*)\](?!\()"
)
_SLOT_SIGN = re.compile(r"[\[{<%#@]|__")
_HEX = re.compile(r"(?=[0-9a-f]*\d)[0-9a-f]{5,}\Z|(?=\w*\d)(?=\w*[a-z])[a-z0-9]{5,}\Z")
_LETTER = re.compile(r"[^\W\d_]")
_BLANKS_WANTED = (
    r"(?i)(نموذج|قالب|استمار|فراغ|اقواس|أقواس|\bblank|\btemplate|\bform\b|placeholder|fill in|brackets|modèle|formulaire|champs? vides?)"
)


def tokens(text: str) -> list[str]:
    """Bare words; numbers become 0, long numbers and codes 0x, so that an exemplar stands for all of them."""
    return masked(forms.bare_words(text))


def masked(words: list[str]) -> list[str]:
    return [("0x" if len(w) > 4 else "0") if w.isdigit() else "0x" if w[0] in "0123456789abcdef" and _HEX.match(w) else w for w in words]


def phrases(block: str) -> list[tuple[str, ...]]:
    return list(dict.fromkeys(t for line in E.expand(block) if (t := tuple(tokens(line.replace("0x", "0a0a0a"))))))


class Idf:
    """Inverse document frequency: exact for the words of the exemplars, by buckets for all others; 1 where nothing was counted."""

    def __init__(self, known: dict[str, float] | None = None, buckets: np.ndarray | None = None):
        self.known, self.buckets, self.ids = known or {}, buckets, forms.Ids()

    def __getitem__(self, word: str) -> float:
        v = self.known.get(word)
        if v is not None:
            return v
        return 1.0 if self.buckets is None else float(self.buckets[self.ids[word] & (BUCKETS - 1)])


class Exemplars:
    """An inverted index from word pairs to the labelled exemplars that hold them."""

    def __init__(self, idf: Idf | None = None):
        self.idf = idf or Idf()
        self.kinds = {"filler": phrases(E.FILLER), "notice": phrases(E.NOTICE), "talk": phrases(E.TALK)}
        self.menu = {w for t in phrases(E.MENU) for w in t}
        self.slot_words = {w for t in phrases(E.SLOT) for w in t}
        self.latin = set(E.LATIN_FILLER.split())
        self.words = {k: {w for t in ts for w in t} for k, ts in self.kinds.items()}
        self.vocabulary = set().union(*self.words.values(), self.menu, self.slot_words)
        self.covering = self.words["notice"] | self.menu
        self.texts: list[tuple[str, tuple[str, ...]]] = []
        self.features: list[dict] = []
        self.total: list[float] = []
        self.index: dict[str, dict[tuple[str, str], list[int]]] = {k: defaultdict(list) for k in self.kinds}
        for kind, ts in self.kinds.items():
            for t in ts:
                f = self.weigh(t)
                i, total = len(self.texts), sum(f.values())
                self.texts.append((kind, t))
                self.features.append(f)
                self.total.append(total)
                # a window without any of these pairs holds too little of the exemplar
                lost = 0.0
                for pair in sorted((x for x in f if isinstance(x, tuple)), key=lambda x: (-f[x], x)):
                    self.index[kind][pair].append(i)
                    lost += f[pair]
                    if lost > (1 - CONTAINED) * total + 1e-9:
                        break
                else:
                    raise ValueError(f"an exemplar needs two words: {t}")

    def weigh(self, t: tuple[str, ...]) -> dict:
        """Each word weighs its idf, each pair of neighbours as much as its two words."""
        f: dict = {w: self.idf[w] for w in t}
        f.update({(a, b): self.idf[a] + self.idf[b] for a, b in zip(t, t[1:])})
        return f

    def width(self, i: int) -> int:
        n = len(self.texts[i][1])
        return n + n // 4

    def held(self, i: int, window: list[str]) -> float:
        """The share of an exemplar's weight in a window."""
        f = self.features[i]
        return (sum(f[w] for w in set(window) if w in f) + sum(f[p] for p in set(zip(window, window[1:])) if p in f)) / self.total[i]

    def matches(self, t: list[str], kind: str) -> Iterator[tuple[int, int]]:
        """(exemplar, first word) of windows that contain an exemplar of a kind; the first window of each exemplar."""
        if len(t) < 2 or self.words[kind].isdisjoint(t):
            return
        index = self.index[kind]
        pairs = list(zip(t, t[1:]))
        here = set(pairs)
        hit = [p for p in here if p in index]
        if not hit:
            return
        here.update(t)
        places: dict[int, list[int]] = defaultdict(list)
        at = defaultdict(list)
        for n, p in enumerate(pairs):
            at[p].append(n)
        for p in hit:
            for i in index[p]:
                places[i] += at[p]
        for i in sorted(places):
            f = self.features[i]
            if sum(v for x, v in f.items() if x in here) < CONTAINED * self.total[i] - 1e-9:
                continue
            width, tried = self.width(i), -1
            for p in sorted(places[i]):
                found = False
                for first in range(max(0, p + 2 - width, tried + 1), p + 1):
                    tried = first
                    if self.held(i, t[first : first + width]) >= CONTAINED - 1e-9:
                        yield i, first
                        found = True
                        break
                if found:
                    break

    def latin_passage(self, t: list[str]) -> bool:
        """Whether a window of LATIN_WINDOW words is contained in the Latin filler."""
        run = 0
        for w in t:
            run = run + 1 if w in self.latin else 0
            if run >= LATIN_WINDOW:
                return True
        return False

    def share(self, words: list[str], among: set[str]) -> float:
        """The share of the words' weight that is among some words."""
        whole = inside = 0.0
        for w in words:
            v = self.idf[w]
            whole += v
            if w in among:
                inside += v
        return inside / whole if whole else 0.0


def slots(text: str, exemplars: Exemplars) -> list[str]:
    """Unfilled placeholders outside code: brackets of templates, and other brackets whose content labelled placeholders contain."""
    if _SLOT_SIGN.search(text) is None:
        return []
    text = _CODE.sub(" ", text) if "`" in text else text
    out = [m.group(0) for m in _STRONG.finditer(text) if _LETTER.search(m.group(m.lastindex))]
    for m in _WEAK.finditer(text):
        inner = masked(forms.bare_words(m.group(m.lastindex)))
        if inner and exemplars.share(inner, exemplars.slot_words) >= CONTAINED:
            out.append(m.group(0))
    return out


def judge(text: str, exemplars: Exemplars, coverage: float = COVERAGE, words: list[str] | None = None) -> tuple[str | None, float]:
    """(kind, share of the value that residue covers); kind is slot, filler, notice or null for real text.

    Filler counts alone or within real text. A notice counts only where an exemplar matches, nothing
    matches that speaks about notices, and words of notices and menus cover ``coverage`` or more of the
    whole value. ``words`` are the bare words of the text without its code, where the caller has them.
    """
    if slots(text, exemplars):
        return "slot", 1.0
    t = masked(words) if words is not None else tokens(_CODE.sub(" ", text) if "`" in text else text)
    if not t:
        return None, 0.0
    if not exemplars.latin.isdisjoint(t) and exemplars.latin_passage(t):
        return "filler", 1.0
    if next(exemplars.matches(t, "filler"), None):
        return "filler", 1.0
    by_count = sum(w in exemplars.covering for w in t) / len(t)
    if by_count < coverage - 0.2:
        return None, 0.0
    share = exemplars.share(t, exemplars.covering)
    if max(share, by_count) < coverage or min(share, by_count) < coverage - 0.2:
        return None, 0.0
    if next(exemplars.matches(t, "notice"), None) and not next(exemplars.matches(t, "talk"), None):
        return "notice", share
    return None, 0.0


def exemplar_idf(texts: DataFrame) -> Idf:
    """Inverse document frequency over all values: a number an exemplar word and a table of fixed size reach the driver."""
    vocabulary = Exemplars().vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Counter = Counter()
        others, n, ids = np.zeros(BUCKETS, np.uint32), 0, forms.Ids()
        for b in forms.slices(batches):
            at = [np.zeros(0, np.uint64)]
            for x in b.column(0).to_pylist():
                if x:
                    n += 1
                    w = set(tokens(x))
                    known.update(vocabulary & w)
                    at.append(np.unique(ids.of(list(w)) & np.uint64(BUCKETS - 1)))
            others += np.bincount(np.concatenate(at).astype(np.int64), minlength=BUCKETS).astype(np.uint32)
        rows = [*known.items(), ("", n)]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows] + [None], pa.string()), pa.array([k for _, k in rows] + [0], pa.int64()), pa.array([None] * len(rows) + [others.tobytes()], pa.binary())], names=["word", "n", "others"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Counter = Counter()
        others = None
        for b in batches:
            for w, k, o in zip(*(b.column(i).to_pylist() for i in range(3))):
                if o is None:
                    known[w] += k
                else:
                    others = np.frombuffer(o, np.uint32).astype(np.uint64) + (0 if others is None else others)
        data = [] if others is None else [others.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([*known, *[None] * len(data)], pa.string()), pa.array([*known.values(), *[0] * len(data)], pa.int64()), pa.array([None] * len(known) + data, pa.binary())], names=["word", "n", "others"])

    kinds = "word string, n long, others binary"
    counts, others = {}, np.zeros(BUCKETS)
    for r in texts.select("text").mapInArrow(count, kinds).repartition("word").mapInArrow(add, kinds).toLocalIterator():
        if r.others is None:
            counts[r.word] = r.n
        else:
            others = np.frombuffer(r.others, np.uint64).astype(float)
    total = counts.pop("", 0)
    known = {w: 1.0 + math.log((total + 1) / (counts.get(w, 0) + 1)) for w in vocabulary}
    return Idf(known, (1.0 + np.log((total + 1) / (others + 1))).astype(np.float32))


def residue(texts: DataFrame, idf: Idf | None = None) -> DataFrame:
    """(record_table, record_id, field_name, text) -> (record_table, record_id, field_name, kind, coverage) of residue.

    Null and blank values are no residue. Values that repeat under one key come out once. Extra
    columns are ignored. ``idf`` is counted over ``texts`` where it is not given.
    """
    shared = texts.sparkSession.sparkContext.broadcast(Exemplars(exemplar_idf(texts) if idf is None else idf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exemplars: Exemplars = shared.value
        for b in forms.slices(batches):
            out: list[list] = [[], [], [], [], []]
            for j, x in enumerate(b.column(3).to_pylist()):
                if not x:
                    continue
                kind, share = judge(x, exemplars)
                if kind:
                    for o, v in zip(out, (b.column(0)[j].as_py(), b.column(1)[j].as_py(), b.column(2)[j].as_py(), kind, share)):
                        o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, (pa.string(), pa.int64(), pa.string(), pa.string(), pa.float64()))], names=["record_table", "record_id", "field_name", "kind", "coverage"])

    found = texts.select("record_table", "record_id", "field_name", "text").mapInArrow(run, "record_table string, record_id long, field_name string, kind string, coverage double")
    return found.groupBy("record_table", "record_id", "field_name").agg(F.max(F.struct("coverage", "kind")).alias("m")).select("record_table", "record_id", "field_name", "m.kind", "m.coverage")


def blanks_wanted(column: Column) -> Column:
    """Whether a user asks for a form or template whose blanks stay open."""
    return column.rlike(_BLANKS_WANTED)


def asked_for_blanks(messages: DataFrame) -> DataFrame:
    """message_id of messages directly after a user message that asks for a blank form."""
    m = messages.withColumn("_role", role())
    asks = m.filter((F.col("_role") == "user") & blanks_wanted(F.col("content"))).select("seed_index", (F.col("turn") + 1).alias("turn"))
    return m.filter(F.col("_role") == "assistant").join(asks.distinct(), ["seed_index", "turn"]).select("message_id")


def message_texts(messages: DataFrame) -> DataFrame:
    return messages.select(F.lit("messages").alias("record_table"), F.col("message_id").alias("record_id"), F.lit("content").alias("field_name"), F.col("content").alias("text"))


def page_texts(pages: DataFrame) -> DataFrame:
    both = F.array(*(F.struct(F.lit(c).alias("field_name"), F.col(c).alias("text")) for c in ("page_text", "content")))
    return pages.select(F.lit("evidence_pages").alias("record_table"), F.col("page_id").alias("record_id"), F.inline(both))


def found_in(spark: SparkSession, directory: str) -> DataFrame:
    messages = load(spark, directory, "messages")
    texts = page_texts(load(spark, directory, "evidence_pages")).unionByName(message_texts(messages))
    found = residue(texts)
    forms_wanted = asked_for_blanks(messages).select(F.lit("messages").alias("record_table"), F.col("message_id").alias("record_id"), F.lit("slot").alias("kind")).distinct()
    return found.join(forms_wanted, ["record_table", "record_id", "kind"], "left_anti")


def p4_found(spark: SparkSession, directory: str) -> DataFrame:
    return found_in(spark, directory).select("record_table", "record_id", "field_name")


def p4_kinds(spark: SparkSession, directory: str) -> DataFrame:
    """How many values of each field are residue, by kind."""
    return found_in(spark, directory).groupBy("record_table", "field_name", "kind").agg(F.count("*").alias("n_values"))
