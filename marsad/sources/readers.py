"""Readers with explicit schemas: JSON Lines of chats, run entries, catalogues, ledgers, transcripts and HTML."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE = "struct<role:string,content:string>"
CHAT_SCHEMA = (
    f"seed_index bigint, domain string, screening_passed boolean, request string, question string, answer string, "
    f"messages array<{MESSAGE}>, conversation struct<messages:array<{MESSAGE}>>, _corrupt_record string"
)


def resolved_messages() -> Column:
    """Messages of any of the three shapes; the first one that is not empty holds."""
    pair = F.array(F.struct(F.lit("user").alias("role"), F.col("question").alias("content")), F.struct(F.lit("assistant").alias("role"), F.col("answer").alias("content")))
    return (
        F.when(F.size("conversation.messages") > 0, F.col("conversation.messages"))
        .when(F.size("messages") > 0, F.col("messages"))
        .when((F.coalesce("question", F.lit("")) != "") | (F.coalesce("answer", F.lit("")) != ""), pair)
        .otherwise(F.array().cast(f"array<{MESSAGE}>"))
    )


def read_chats(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(chats, malformed lines) of JSON Lines files; blank lines are neither. Chats carry file and resolved messages.

    Files named ``*.passing.*`` stay out, as they repeat others.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "").withColumn("file", F.col("_metadata.file_path")).filter(~F.col("file").contains(".passing."))
    rows = lines.select("file", F.from_json("value", CHAT_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r")).select("r.*", "file")
    bad = F.col("_corrupt_record").isNotNull()
    return rows.filter(~bad).withColumn("resolved", resolved_messages()).drop("_corrupt_record"), rows.filter(bad).select("file", F.col("_corrupt_record").alias("line"))


def read_opaque(spark: SparkSession, path: str) -> DataFrame:
    """messages_json of each line, unparsed; a line without messages is an error when it is read."""
    text = spark.read.text(path).filter(F.trim("value") != "")
    m = F.get_json_object("value", "$.messages")
    return text.select(F.when(F.coalesce(F.json_array_length(m), F.lit(0)) > 0, m).otherwise(F.raise_error(F.lit("a line has no messages"))).alias("messages_json"))


def discover(spark: SparkSession, directory: str, excluded: list[str]) -> DataFrame:
    """(name, path, modified, bytes) of JSON Lines files, newest first; names with an excluded part stay out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jsonl").load(directory).select("path", "modificationTime", "length")
    name = F.element_at(F.split("path", "/"), -1)
    keep = F.lit(True)
    for part in excluded:
        keep = keep & ~name.contains(part)
    return files.filter(keep).select(name.alias("name"), "path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes")).orderBy(F.desc("modified"), "name")


def manifest(spark: SparkSession, directory: str) -> DataFrame:
    """(name, bytes, sha256) of every file of a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def run_entries(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines with ``description: "family:key=value,..."`` -> (family, args map); other lines give no row."""
    found = F.regexp_extract(column, r'description:\s*"([^"]+)"', 1)
    d = lines.select(found.alias("d")).filter("d <> ''")
    args = F.substring_index("d", ":", -1)
    return d.select(F.split_part("d", F.lit(":"), F.lit(1)).alias("family"), F.when(F.col("d").contains(":"), F.str_to_map(args, F.lit(","), F.lit("="))).otherwise(F.create_map().cast("map<string,string>")).alias("args"))


def topic_catalog(lines: DataFrame, domain: str, allowed: str, column: str = "value") -> DataFrame:
    """Lines ``id|subject|question|question`` -> topics of a domain; lines of another shape are an error."""
    p = F.split(column, r"\|")
    part = lambda i: F.trim(p[i])
    ok = F.when(F.size(p) == 4, part(0)).otherwise(F.raise_error(F.concat(F.lit("not a topic: "), F.col(column))))
    return lines.filter(F.trim(column) != "").select(ok.alias("topic_id"), F.lit(domain).alias("domain"), part(1).alias("subject"), F.array(part(2), part(3)).alias("questions"), F.filter(F.split(F.lit(allowed), " "), lambda x: x != "").alias("allowed_domains"))


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Request files as (stage, cost decimal, prompt_tokens, completion_tokens, created_at); costs never pass through a double."""
    schema = "stage string, created_at string, raw struct<usage:struct<cost:string,prompt_tokens:bigint,completion_tokens:bigint>>"
    r = spark.read.schema(schema).option("multiLine", True).option("primitivesAsString", True).json(path)
    return r.select("stage", F.col("raw.usage.cost").cast("decimal(38,12)").alias("cost"), "raw.usage.prompt_tokens", "raw.usage.completion_tokens", F.try_to_timestamp("created_at").alias("created_at"))


# a comment, a hidden element up to its end, any other tag, in this order of trial
_MARKUP = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style|noscript)\b[^>]*>.*?(?:</\1\s*>|\Z)|</?[a-z!?](?:[^>\"']|\"[^\"]*\"|'[^']*')*>")
#: A page's text is cut at so many characters.
PAGE_CHARACTERS = 28_000


def visible_text(markup: str | None, most: int = PAGE_CHARACTERS) -> str | None:
    """Text of a page without comments, scripts and styles, entities read, white space collapsed, cut at ``most`` characters.

    Markup is taken out in one pass, then entities are read, so that text about tags stays text. An element that never ends hides the rest.
    """
    if markup is None:
        return None
    return " ".join(html.unescape(_MARKUP.sub(" ", markup)).split())[:most]


def page_text(markup: Column) -> Column:
    def run(s: pd.Series) -> pd.Series:
        return s.map(visible_text, na_action="ignore")

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")(markup)


# Role labels of transcripts in English and Arabic.
ROLE_LABELS = {"user": "user", "assistant": "assistant", "system": "system", "المستخدم": "user", "المساعد": "assistant", "النظام": "system"}
_LABEL = r"(?i)(?:^|\n)\s*(" + "|".join(ROLE_LABELS) + r")\s*:"


def parse_transcript(text: Column, completion: bool = False) -> Column:
    """Messages of a JSON list or of a labelled transcript; labels may be of any case and stand after blanks.

    Other text is one answer where ``completion`` is set, else an error, as are null and blank. Text
    before the first label belongs to no message.
    """
    listed = F.from_json(text, f"array<{MESSAGE}>")
    marked = F.regexp_replace(text, _LABEL, "\x1e$1\x1f")
    pieces = F.filter(F.split(marked, "\x1e"), lambda p: p.contains("\x1f"))
    names = F.create_map(*(F.lit(x) for pair in ROLE_LABELS.items() for x in pair))
    # python's strip, which knows more white space than trim
    stripped = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    labelled = F.transform(pieces, lambda p: F.struct(names[F.lower(F.split_part(p, F.lit("\x1f"), F.lit(1)))].alias("role"), stripped(F.split_part(p, F.lit("\x1f"), F.lit(2))).alias("content")))
    whole = F.array(F.struct(F.lit("assistant").alias("role"), stripped(text).alias("content")))
    wrong = lambda why: F.raise_error(F.lit(why)).cast(f"array<{MESSAGE}>")
    other = whole if completion else wrong("neither a list of messages nor a labelled transcript")
    return F.when(F.coalesce(F.trim(text), F.lit("")) == "", wrong("an empty conversation")).when(F.size(listed) > 0, listed).when(text.rlike(_LABEL), labelled).otherwise(other)


def indexed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(id, file, value): the lines of all files that are not blank, numbered from 0 by file and line, over all tasks.

    Within a block of a file rows come in order, so (file, block, row) is the order of the lines.
    """
    from marsad.operators.ordering import numbered

    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), "value")
    return numbered(lines.filter(F.trim("value") != ""), ["file", "block", "row"], "id").select("id", "file", "value")


def indexed_chats(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(id, file, chat columns, resolved) with dense ids in order of (file, line) over the lines that parse, and (file, malformed) counts."""
    from marsad.operators.ordering import numbered

    rows = indexed_lines(spark, path).filter(~F.col("file").contains(".passing."))
    parsed = rows.select("id", "file", F.from_json("value", CHAT_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r")).select("id", "file", "r.*")
    bad = F.col("_corrupt_record").isNotNull()
    good = parsed.filter(~bad).drop("_corrupt_record").withColumn("resolved", resolved_messages()).withColumnRenamed("id", "line")
    counts = parsed.groupBy("file").agg(F.count_if(bad).alias("malformed"))
    return numbered(good, ["line"], "id").drop("line"), counts


def load_chats(spark: SparkSession, dataset: str, split: str | None = None) -> DataFrame:
    """Chats of a dataset: a folder of splits in parquet where ``split`` names one, else JSON Lines read without parsing the messages."""
    return read_opaque(spark, dataset) if split is None else spark.read.parquet(f"{dataset}/{split}")


def sniffed(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Of ``discover``'s files those whose first line is a chat of one of the known shapes; only first lines are parsed."""
    paths = [r.path for r in files.select("path").limit(10_001).collect()]
    if len(paths) > 10_000:
        raise ValueError("more than 10000 files")
    if not paths:
        return files
    first = _first_lines(spark, paths)
    chat = F.from_json("value", CHAT_SCHEMA)
    shaped = first.select("path", chat.alias("r")).select("path", "r.*").filter(F.size(resolved_messages()) > 0).select("path")
    return files.join(shaped, "path", "left_semi")


def _first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), "value").filter(F.trim("value") != "")
    first = lines.groupBy("file").agg(F.min_by("value", F.struct("block", "row")).alias("value"))
    # both sides name a file by the part of its address after the scheme
    bare = lambda c: F.regexp_replace(c, "^[a-z]+:/+", "/")
    named = spark.createDataFrame([(p,) for p in paths], "path string")
    return named.join(first, bare(F.col("path")) == bare(F.col("file"))).select("path", "value")


def unresolved(spark: SparkSession, directory: str) -> DataFrame:
    """(state, n): requests that were begun and not ended, by the ends of their files' names, ``.pending`` and ``.unresolved``."""
    files = spark.read.format("binaryFile").load(directory).select(F.regexp_extract("path", r"\.(pending|unresolved)$", 1).alias("state"))
    return files.filter("state <> ''").groupBy("state").agg(F.count("*").alias("n"))


def total_cost(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row with the decimal sum of the costs in several ledgers; folders that are not there add nothing."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    there = [p for p in paths if (h := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(h)]
    out = spark.createDataFrame([], "cost decimal(38,12)")
    for p in there:
        out = out.unionByName(ledger(spark, p).select("cost"))
    return out.agg(F.coalesce(F.sum("cost"), F.lit(0)).cast("decimal(38,12)").alias("cost"), F.count_if(F.col("cost").isNull()).alias("unknown"))


def normalized_messages(messages: Column) -> Column:
    """Role and content only; a missing content is empty text."""
    return F.transform(messages, lambda m: F.struct(m["role"].alias("role"), F.coalesce(m["content"], F.lit("")).alias("content")))


def valid_messages(messages: Column) -> Column:
    """Whether all roles are known and no content is blank; no message at all is not valid."""
    ok = F.forall(messages, lambda m: m["role"].isin("user", "assistant", "system") & (F.coalesce(F.trim(m["content"]), F.lit("")) != ""))
    return F.coalesce((F.size(messages) > 0) & ok, F.lit(False))
