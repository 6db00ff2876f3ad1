"""Text expressions. Each builds one Column from built-in functions; the SQL twin for DuckDB stands beside it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tokens are runs of letters, numbers and the underscore; marks do not belong to them.
TOKEN = r"[\p{L}\p{N}_]+"
# Arabic vowel marks, dagger alef and tatweel.
MARKS = r"[\x{064B}-\x{065F}\x{0670}\x{0640}]"
# Letters and digits that a normalized question unifies, position by position.
UNIFY_FROM, UNIFY_TO = "أإآى٠١٢٣٤٥٦٧٨٩", "اااي0123456789"
# White space as Python's str.split sees it.
SPACE = r"[\s\p{Z}\x1c-\x1f\x85]+"
MARKDOWN = r"(?m)(\*\*[^*\n]+\*\*|^#{1,6} |^\s*[-*] |^\s*\d+\. )"
LINK = r"https?://[^\s)\]>]+"
MARKDOWN_LINK = r"\[([^\]]*)\]\((https?://[^)\s]+)\)"


def fold(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def fold_sql(x: str) -> str:
    return f"replace(lower({x}), 'ß', 'ss')"


def words(c: Column) -> Column:
    """Folded tokens in order; null stays null, a text without tokens is an empty array."""
    return F.regexp_extract_all(fold(c), F.lit(TOKEN), F.lit(0))


def words_sql(x: str) -> str:
    return f"regexp_extract_all({fold_sql(x)}, '{TOKEN}')"


def normalized(c: Column) -> Column:
    """A question without case, marks, tatweel, alef and digit forms and punctuation."""
    t = F.translate(F.regexp_replace(fold(c), MARKS, ""), UNIFY_FROM, UNIFY_TO)
    return F.array_join(F.regexp_extract_all(t, F.lit(TOKEN), F.lit(0)), " ")


def normalized_sql(x: str) -> str:
    return f"array_to_string(regexp_extract_all(translate(regexp_replace({fold_sql(x)}, '{MARKS}', '', 'g'), '{UNIFY_FROM}', '{UNIFY_TO}'), '{TOKEN}'), ' ')"


def word_count(c: Column) -> Column:
    """Words between white space; null counts as 0."""
    return F.coalesce(F.size(F.filter(F.split(c, SPACE), lambda w: w != "")), F.lit(0)).cast("long")


def word_count_sql(x: str) -> str:
    return f"coalesce(len(list_filter(regexp_split_to_array({x}, '{SPACE}'), lambda w: w <> '')), 0)"


def shingles(w: Column, n: int) -> Column:
    """Distinct runs of n words, joined by a blank; empty below n words."""
    runs = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))
    return F.when(F.size(w) >= n, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def with_shingles(df: DataFrame, text: Column, n: int, name: str) -> DataFrame:
    """Add the distinct runs of n words of a text.

    The words are bound as a lambda variable, so that no rewrite of the plan cuts them again for every run.
    """
    return df.withColumn(name, F.transform(F.array(words(text)), lambda w: shingles(w, n))[0])


def with_hashed_runs(df: DataFrame, text: Column, n: int, name: str, *salt: Column) -> DataFrame:
    """Add the 64-bit hashes of the distinct runs of n words of a text, with other columns in the hash where given; empty below n words.

    No string is built for a run: its words are hashed where they stand.
    """

    def runs(w: Column) -> Column:
        hashed = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.xxhash64(*salt, F.slice(w, i, n)))
        return F.when(F.size(w) >= n, F.array_distinct(hashed)).otherwise(F.array().cast("array<bigint>"))

    return df.withColumn(name, F.transform(F.array(words(text)), runs)[0])


def shingles_sql(w: str, n: int) -> str:
    return f"list_distinct([array_to_string({w}[i:i + {n - 1}], ' ') for i in range(1, len({w}) - {n - 2})])"


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(0.0)).otherwise(both / either)


def links(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(LINK), F.lit(0))


def without_links(c: Column) -> Column:
    """Markdown links give way to their text."""
    return F.regexp_replace(c, MARKDOWN_LINK, "$1")


def last_paragraph(c: Column) -> Column:
    return F.element_at(F.split(F.trim(c), r"\n\s*\n"), -1)


def closing_offer(c: Column) -> Column:
    """Whether the last 400 characters of the last paragraph offer further help."""
    return F.right(last_paragraph(c), F.lit(400)).rlike(OFFER)


# Words of an offer of further help.
OFFER = "(?i)(هل تريد|هل تبي|تبيني|تحب أن|تحب أ|تبغى|هل عندك سؤال|أقدر أساعدك|would you like|do you want me|shall i|let me know|is there anything)"
GREETING = "السلام عليكم"


def host(url: Column) -> Column:
    return F.lower(F.parse_url(url, F.lit("HOST")))


def plain_domain(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), r"^www\.", "")


def host_allowed(h: Column, domains: Column) -> Column:
    """Whether a host is one of the domains or below one; no domain, no match."""
    return F.coalesce(F.exists(domains, lambda d: (h == d) | h.endswith(F.concat(F.lit("."), d))), F.lit(False))


def canonical_url(c: Column) -> Column:
    """Percent-decoded and without final slashes; a plus stays a plus."""
    decoded = F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)
    return F.rtrim(decoded, F.lit("/"))


def digest(c: Column) -> Column:
    return F.sha2(F.encode(c, "UTF-8"), 256)
