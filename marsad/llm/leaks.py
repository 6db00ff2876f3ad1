"""Problem 3: held-out items inside training text, by CGK embedding and repeated bit sampling.

Item texts and records are streams of words. Every window of ``window`` words is embedded by the
random walk of Chakraborty, Goldenberg and Koucky: a pointer walks over the window; at each of
3 * window steps the word under it is written out and a random bit of (step, word) says whether the
pointer moves on. Windows at a small edit distance come out at a small Hamming distance, so hashing a
few sampled places of the output lets them collide; this repeats until the target recall is met.
Every collision is verified by the exact edit distance of the two windows.

Equal windows collapse on both sides before they meet, so a passage that many items and many records
share is embedded, matched and verified once. Windows with the same owners form one set; records
meet sets, and sets expand to items at the very end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marsad.llm import bits as B
from marsad.llm import forms
from marsad.session import cut
from marsad.tables import load

WINDOW = 12
#: Joins on a passage that a large part of all records or items may share are spread over so many keys.
SALTS = 16
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: By number of edits: how many places are sampled, and the chance that the samples of two windows agree. The means
#: measured on random edits are 0.48, 0.33 and 0.23; the lower values here make up for windows below the mean.
SAMPLED = {1: (6, 0.35), 2: (6, 0.18), 3: (6, 0.10)}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Plan:
    """How often to embed and how many places to sample, for windows at up to ``edits`` (0 to 3) word edits.

    One sample of a window and its edited form agrees with the chance in SAMPLED, and
    ``rounds`` independent samples reach the recall. Equal windows always agree, so no edit takes one
    round, which samples the whole first part of the walk.
    """

    window: int = WINDOW
    edits: int = 1
    recall: float = 0.98
    seed: int = 17

    @property
    def bits(self) -> int:
        return 2 * self.window if self.edits == 0 else SAMPLED[self.edits][0]

    @property
    def rounds(self) -> int:
        if self.edits == 0:
            return 1
        return max(1, math.ceil(math.log(1 - self.recall) / math.log(1 - SAMPLED[self.edits][1])))

    def places(self, round_: int) -> list[int]:
        rng = np.random.default_rng([self.seed, round_])
        # places late in the walk are past the window's end; the sample comes from its first two thirds
        return sorted(rng.choice(2 * self.window, size=self.bits, replace=False).tolist())


def bigrams(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _MIX[2] ^ b)


def window_ids(windows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of word ids."""
    h = np.zeros(len(windows), np.uint64)
    for j in range(windows.shape[1]):
        h = mix((h + _MIX[0]) ^ windows[:, j])
    return h


def signatures(windows: np.ndarray, plan: Plan, round_: int) -> np.ndarray:
    """CGK walk and one bit sample for an (n, window) array of word ids."""
    n, width = windows.shape
    padded = np.hstack([windows, np.zeros((n, 1), np.uint64)])
    salt = mix(np.array([plan.seed * 1000 + round_], np.uint64))[0]
    coins = mix(padded ^ salt)
    at = np.arange(n)
    pointer = np.zeros(n, np.int64)
    sample = plan.places(round_)
    out = np.full(n, salt, np.uint64)
    for step in range(sample[-1] + 1):
        if step in sample:
            out = mix((out + _MIX[0]) ^ padded[at, pointer])
        pointer = np.minimum(pointer + ((coins[at, pointer] >> np.uint64(step)) & np.uint64(1)).astype(np.int64), width)
    return out


def edit_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact word edit distances of the rows of two (n, window) arrays, by one table for all rows at once."""
    n, width = a.shape
    last = np.tile(np.arange(width + 1), (n, 1))
    for i in range(width):
        row = np.empty_like(last)
        row[:, 0] = i + 1
        for j in range(width):
            row[:, j + 1] = np.minimum(np.minimum(last[:, j + 1], row[:, j]) + 1, last[:, j] + (a[:, i] != b[:, j]))
        last = row
    return last[:, -1]


def _cuts(words: np.ndarray, window: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(words, window)


def item_windows(items: DataFrame, plan: Plan) -> DataFrame:
    """(item_id, text) -> (item_id, wid, words): every window of an item; shorter and null texts give none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = forms.Ids()
        for b in forms.slices(batches):
            out: list[list] = [[], [], []]
            for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = ids.of(forms.bare_words(x))
                if len(w) >= plan.window:
                    v = np.unique(_cuts(w, plan.window), axis=0)
                    out[0] += [k] * len(v)
                    out[1] += window_ids(v).view(np.int64).tolist()
                    out[2] += [r.tobytes() for r in v]
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, (pa.string(), pa.int64(), pa.binary()))], names=["item_id", "wid", "words"])

    some = items.select("item_id", "text").filter("text is not null and item_id is not null")
    return some.mapInArrow(run, "item_id string, wid long, words binary").dropDuplicates(["item_id", "wid"])


def owner_sets(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item_id, wid, words) -> distinct (wid, set_id, words), and (set_id, item_id).

    Windows with the same owners share a set, named by hashes that add up without gathering the
    owners anywhere; the owners of one window of each set stand for it.
    """
    x, y = F.bit_xor(F.xxhash64("item_id")), F.bit_xor(F.xxhash64(F.lit(1), "item_id"))
    distinct = windows.groupBy("wid").agg(F.first("words").alias("words"), x.alias("x"), y.alias("y"), F.count("*").alias("n"))
    distinct = cut(distinct.select("wid", F.xxhash64("x", "y", "n").alias("set_id"), "words"))
    one = distinct.groupBy("set_id").agg(F.min("wid").alias("wid"))
    return distinct, cut(windows.join(one, "wid").select("set_id", "item_id"))


def signed(windows: DataFrame, plan: Plan) -> DataFrame:
    """(wid, words) -> (sig, wid, words): a row a round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in forms.slices(batches, 10_000):
            if not b.num_rows:
                continue
            w = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint64).reshape(-1, plan.window)
            for r in range(plan.rounds):
                yield pa.RecordBatch.from_arrays([pa.array(signatures(w, plan, r).view(np.int64)), b.column(0), b.column(1)], names=["sig", "wid", "words"])

    return windows.select("wid", "words").mapInArrow(run, "sig long, wid long, words binary")


def near_windows(texts: DataFrame, table: np.ndarray, bits: int, plan: Plan) -> DataFrame:
    """(record_table, record_id, first_word, wid, words) of windows that may be within the edits of an item's window.

    ``table`` holds the bigrams of all items. By the q-gram lemma a window within so many edits of an item's
    window shares all but 2 * edits of its bigrams, so no window is lost and nearly all others go.
    """
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = forms.Ids()
        w = plan.window
        for b in forms.slices(batches):
            rows = [(t, k, y) for t, k, x in zip(*(b.column(i).to_pylist() for i in range(3))) if x and len(y := forms.bare_words(x)) >= w]
            if not rows:
                continue
            lengths = np.array([len(y) for *_, y in rows])
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            words = ids.of([x for *_, y in rows for x in y])
            record = np.repeat(np.arange(len(rows)), lengths)
            good = np.zeros(len(words), np.int32)
            good[1:] = B.held(shared.value, bigrams(words[:-1], words[1:]), bits)
            sums = np.cumsum(good)
            place = np.flatnonzero((sums[w - 1 :] - sums[: len(words) - w + 1] >= w - 1 - 2 * plan.edits) & (record[w - 1 :] == record[: len(words) - w + 1]))
            if len(place):
                v = _cuts(words, w)[place]
                r = record[place]
                out = ([rows[i][0] for i in r], [rows[i][1] for i in r], place - starts[r], window_ids(v).view(np.int64), [x.tobytes() for x in v])
                kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, kinds)], names=["record_table", "record_id", "first_word", "wid", "words"])

    return texts.select("record_table", "record_id", "text").mapInArrow(run, "record_table string, record_id long, first_word int, wid long, words binary")


def verified(pairs: DataFrame, plan: Plan) -> DataFrame:
    """(wid, words, set_id, item_words) -> (wid, set_id, edits) of pairs within the edits, by exact edit distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in forms.slices(batches, 20_000):
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint64).reshape(-1, plan.window) for i in (1, 3))
            d = np.where((x == y).all(axis=1), 0, plan.edits + 1)
            rest = np.flatnonzero(d)
            if plan.edits and len(rest):
                d[rest] = edit_distances(x[rest], y[rest])
            k = pa.array(d <= plan.edits)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(k), b.column(2).filter(k), pa.array(d.astype(np.int32)).filter(k)], names=["wid", "set_id", "edits"])

    return pairs.select("wid", "words", "set_id", "item_words").mapInArrow(run, "wid long, set_id long, edits int")


def spread_join(many: DataFrame, few: DataFrame, on: str, by: list[str]) -> DataFrame:
    """Join on a key that a large part of ``many`` may share: its rows are salted, those of ``few`` repeated."""
    left = many.withColumn("_salt", F.pmod(F.hash(*by), F.lit(SALTS)))
    right = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, [on, "_salt"]).drop("_salt")


def leaks(texts: DataFrame, items: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """(record_table, record_id, text) x (item_id, text) -> (record_table, record_id, item_id, edits, first_word).

    One row per record and item where a window of ``plan.window`` words of the record is within
    ``plan.edits`` word edits of one of the item's; ``edits`` is the least distance found. Records and
    items that are null or shorter than a window give no row; repeated records come out once; extra
    columns are ignored. The texts are read once, whatever the number of items; what is broadcast is a
    table of at most 2 ** 27 bits.
    """
    owned = cut(item_windows(items, plan))
    windows, owners = owner_sets(owned)
    bits = B.size_for(windows.count() * plan.window)

    def pairs_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in forms.slices(batches, 10_000):
            if b.num_rows:
                w = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint64).reshape(-1, plan.window)
                yield pa.RecordBatch.from_arrays([pa.array(bigrams(w[:, :-1], w[:, 1:]).ravel().view(np.int64))], names=["key"])

    table = B.bit_table(windows.select("words").mapInArrow(pairs_of_words, "key long"), bits)
    near = cut(near_windows(texts, table, bits, plan))
    distinct = near.groupBy("wid").agg(F.first("words").alias("words"))
    theirs = signed(windows, plan).select("sig", F.col("wid").alias("item_wid"), F.col("words").alias("item_words"))
    met = signed(distinct, plan).join(theirs, "sig").dropDuplicates(["wid", "item_wid"])
    found = verified(met.join(windows.select(F.col("wid").alias("item_wid"), "set_id"), "item_wid"), plan).groupBy("wid", "set_id").agg(F.min("edits").alias("edits"))
    of_sets = spread_join(near.select("record_table", "record_id", "first_word", "wid"), found, "wid", ["record_table", "record_id"])
    least = F.min(F.struct("edits", "first_word")).alias("m")
    of_sets = of_sets.groupBy("record_table", "record_id", "set_id").agg(least).select("record_table", "record_id", "set_id", "m.*")
    of_items = spread_join(of_sets, owners, "set_id", ["record_table", "record_id"])
    return of_items.groupBy("record_table", "record_id", "item_id").agg(least).select("record_table", "record_id", "item_id", "m.edits", "m.first_word")


def project_records(spark: SparkSession, directory: str) -> DataFrame:
    d = load(spark, directory, "documents").select(F.lit("documents").alias("record_table"), F.col("doc_id").alias("record_id"), "text")
    m = load(spark, directory, "messages").select(F.lit("messages").alias("record_table"), F.col("message_id").alias("record_id"), F.col("content").alias("text"))
    return d.unionByName(m)


def project_items(spark: SparkSession, directory: str) -> DataFrame:
    """An item's text is its question followed by its choices in stored order."""
    text = F.concat_ws(" ", "input_text", F.concat_ws(" ", "choices"))
    return load(spark, directory, "mcq_items").select(F.col("id").alias("item_id"), text.alias("text"))


def p3_found(spark: SparkSession, directory: str) -> DataFrame:
    """Records with twelve consecutive words of an item: the operator at no edit, where one round has full recall."""
    return leaks(project_records(spark, directory), project_items(spark, directory), Plan(edits=0)).select("record_table", "record_id", "item_id")


def p3_items(spark: SparkSession, directory: str) -> DataFrame:
    """Per item, how many records of each table leak it literally or within one edit in a window."""
    found = leaks(project_records(spark, directory), project_items(spark, directory))
    return found.groupBy("item_id", "record_table").agg(F.count("*").alias("records"), F.sum((F.col("edits") == 0).cast("int")).alias("literal_records"))
