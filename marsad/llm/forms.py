"""One consistent form for text that shows alike, and the word streams built on it.

The form is a confusables skeleton: decompose canonically, replace every character by the
prototype it shows like, decompose again, and compose the result. Characters that a reader sees as
different (hamza, vowel marks, tatweel, case, digit shapes, punctuation) keep different prototypes.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash

# Compatibility tags of the Unicode Character Database whose mapping shows the same.
SAME_LOOK_TAGS = {"<wide>", "<narrow>", "<initial>", "<medial>", "<final>", "<isolated>", "<noBreak>", "<compat>", "<font>"}

# Letters of other scripts that show as a Latin letter, written as pairs "look-alike prototype".
LATIN_LOOK_ALIKES = """
аa еe оo рp сc уy хx іi јj ѕs ԁd һh ԛq ԝw ӏl ɡg ɑa
АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ІI ЈJ ЅS ԌG ԚQ ԜW ҮY
οo αa νv ρp υu ιi κk ϲc ϳj
ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ϹC ͿJ
աw հh յj նu ոn սu օo զq գq ՕO ՍU Տs
ᎪA ᏴB ᏟC ᎬE ᎻH ᎫJ ᏦK ᏞL ᎷM ᏢP ᎡR ᏚS ᎢT ᏙV ᎳW ᏃZ ᎠD
ꓐB ꓑP ꓓD ꓔT ꓖG ꓗK ꓙJ ꓚC ꓜZ ꓝF ꓟM ꓠN ꓡL ꓢS ꓣR ꓦV ꓧH ꓪW ꓫX ꓬY ꓮA ꓰE ꓲI ꓳO ꓴU
"""

# Arabic-script letters, digits and marks that show as another one.
ARABIC_LOOK_ALIKES = """
کك ڪك ہه ھه ۀۀ ەه ۰٠ ۱١ ۲٢ ۳٣ ۷٧ ۸٨ ۹٩
"""

# Punctuation that shows as an ASCII sign; the first of each pair is the look-alike.
MARK_LOOK_ALIKES = {
    ";": ";", "‐": "-", "‑": "-", "․": ".", "‥": "..", "…": "...", "։": ":",
    "∶": ":", "꞉": ":", "⁄": "/", "∕": "/", "ʼ": "’", "᾽": "’", "·": "·",
}

FARSI_YEH, YEH, DOTLESS_YEH = "ی", "ي", "ى"


def _invisible(o: int) -> bool:
    """Characters that leave no mark: format controls, fillers and variation selectors; never the joined emoji tags."""
    return (
        o in (0x00AD, 0x034F, 0x061C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180E, 0x3164, 0xFEFF, 0xFFA0)
        or 0x200B <= o <= 0x200F
        or 0x202A <= o <= 0x202E
        or 0x2060 <= o <= 0x206F
        or 0xFE00 <= o <= 0xFE0F
        or 0x180B <= o <= 0x180D
        or 0x1D173 <= o <= 0x1D17A
    )


@lru_cache(maxsize=1)
def prototypes() -> dict[int, str]:
    """Code point -> prototype. Built by rule from the character database and the short tables above."""
    table: dict[int, str] = {}
    for o in range(0x80, 0x20000):
        c = chr(o)
        if _invisible(o):
            table[o] = ""
            continue
        tag, _, codes = unicodedata.decomposition(c).partition(" ")
        if tag in SAME_LOOK_TAGS and codes:
            if unicodedata.category(c) in ("No", "Nl") and tag == "<compat>":
                continue  # numbers in brackets and the like are seen as such
            text = unicodedata.normalize("NFKD", c)
            # forms of a lone vowel mark are stored on a space, which does not show
            table[o] = text.strip() or " " if text.startswith(" ") and len(text) > 1 else text
        elif unicodedata.category(c) == "Zs":
            table[o] = " "
    for pair in (LATIN_LOOK_ALIKES + ARABIC_LOOK_ALIKES).split():
        table[ord(pair[0])] = pair[1]
    table.update({ord(k): v for k, v in MARK_LOOK_ALIKES.items()})
    return table


_WORTH = re.compile(
    # texts without any of these are already in the consistent form
    "[^\t\n -~¡-¬®-¶¸-ž،؛؟ء-غـ-يً-ْ٠-٩–—‘-”]"
    "|[ً-ْ]{2}| $|^ | (?=\n)|[\xa8\xaf\xb4\xb5\xb8\u0132\u0133\u013f\u0140\u0149]"
)
_FARSI_INNER = re.compile(FARSI_YEH + "(?=[ً-ٟ]*[ؠ-غف-يٮ-ۓ])")
_LINE_ENDS = re.compile("[ \t]+(?=\n)|[ \t]+\\Z|\\A[ \t]+")


def consistent(text: str | None) -> str | None:
    """The consistent form of a text; null stays null and empty stays empty. Applying it twice changes nothing.

    Blanks at the ends of lines do not show and go; blanks within a line keep their number.
    """
    if not text or _WORTH.search(text) is None:
        return text
    t = unicodedata.normalize("NFD", text).replace("\r\n", "\n")
    t = _FARSI_INNER.sub(YEH, t.translate(_before_joining())).replace(FARSI_YEH, DOTLESS_YEH)
    t = unicodedata.normalize("NFC", unicodedata.normalize("NFD", t))
    return _LINE_ENDS.sub("", t)


@lru_cache(maxsize=1)
def _before_joining() -> dict[int, str]:
    return {o: unicodedata.normalize("NFD", p) for o, p in prototypes().items()}


# Words are runs of letters, digits and vowel marks; the underscore is no letter.
_WORDS = re.compile("[\\ẁ-ͯؐ-ًؚ-ٰٟۖ-ۜ۟-۪ۤۧۨ-ۭ]+")
_UNMARKED_WORDS = re.compile("\\w+")
_BARE = re.compile("[_أإآٱ\u0610-\u061a\u0640\u064b-\u065f\u0670\u06d6-\u06dc]")
_MARKS = re.compile("[\u0610-\u061a\u0640\u064b-\u065f\u0670\u06d6-\u06dc]+")


def marked_words(text: str) -> list[str]:
    """Lower-case words of the consistent form; vowel marks count as part of a word."""
    t = consistent(text).lower()
    return _WORDS.findall(t.replace("_", " ") if "_" in t else t)


def bare(text: str) -> str:
    """A consistent text in lower case without vowel marks, tatweel, underscores and the hamza or madda on alef."""
    t = text.lower()
    if _BARE.search(t) is not None:
        t = _MARKS.sub("", t.replace("أ", "ا").replace("إ", "ا").replace("آ", "ا").replace("ٱ", "ا").replace("_", " "))
    return t


def runs(t: str) -> list[str]:
    """The words of a bare text."""
    return _UNMARKED_WORDS.findall(t)


def bare_words(text: str) -> list[str]:
    """Words of the consistent form without case, vowel marks, tatweel and the hamza or madda on alef."""
    return runs(bare(consistent(text)))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1_000, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Batches cut into pieces of at most ``rows`` rows and about ``size`` bytes, so that a task's words stay few in memory."""
    for b in batches:
        step = max(1, min(rows, int(size * b.num_rows / max(1, b.nbytes))))
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)


class Ids(dict):
    """Word -> 64-bit id; forgets everything when it holds too much, so memory stays bounded."""

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        v = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return v

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def digest(text: str) -> int:
    """A signed 64-bit hash, fit for a LongType column."""
    v = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return v - (1 << 64) if v >= 1 << 63 else v


def digest128(data: bytes | str) -> bytes:
    return xxhash.xxh3_128_digest(data.encode("utf-8", "surrogatepass") if isinstance(data, str) else data)


assert sys.maxunicode > 0xFFFF
