"""Problem 6: fill containers of fixed capacity by bounded-space online best fit."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marsad.llm.sizes import token_sizes
from marsad.session import cut
from marsad.tables import load

#: Bins that stay open at once.
OPEN_BINS = 128
#: Items are packed in independent shards of about so many tokens; each leaves at most the open bins unfilled.
SHARD_TOKENS = 40_000_000


class Packer:
    """Online best fit with at most ``open_bins`` open bins.

    Bit f of ``free`` says that some open bin has f units left, so the tightest bin that fits an item
    is the lowest bit from its size on. With no fit and no bin to spare, the fullest bin closes.
    """

    def __init__(self, capacity: int, open_bins: int = OPEN_BINS):
        self.capacity, self.limit = capacity, open_bins
        self.free = 0
        self.bins: dict[int, list[int]] = defaultdict(list)
        self.open = 0
        self.next = 0

    def fresh(self) -> int:
        self.next += 1
        return self.next - 1

    def put(self, size: int) -> tuple[int, int]:
        """(bin, place in it) of an item of 1 to capacity units."""
        fits = self.free >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            b = self._take(left)
        else:
            if self.open >= self.limit:
                self._take((self.free & -self.free).bit_length() - 1)
            left, b = self.capacity, self.fresh()
        if left > size:
            self.bins[left - size].append(b)
            self.free |= 1 << (left - size)
            self.open += 1
        return b, self.capacity - left

    def _take(self, left: int) -> int:
        stack = self.bins[left]
        b = stack.pop()
        if not stack:
            del self.bins[left]
            self.free &= ~(1 << left)
        self.open -= 1
        return b


def pack(sizes: DataFrame, specs: list[tuple[str, int]], open_bins: int = OPEN_BINS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(item_id, n_tokens) -> one row per piece of an item and container spec.

    Columns: spec_name, capacity_tokens, sequence_id, item_id, piece, start_token, n_tokens, offset_tokens.
    An item above the capacity is cut into full containers and a rest; no other item is cut. Items of
    null or 0 tokens take no room and give no row; an id that repeats counts once, rows without an id
    each count. Specs with a null or non-positive capacity give no row. The result doesn't depend on how
    rows are partitioned.
    """
    specs = sorted({(s, int(c)) for s, c in specs if s is not None and c is not None and c > 0})
    schema = "spec_name string, capacity_tokens int, sequence_id long, item_id long, piece int, start_token long, n_tokens long, offset_tokens long"
    if not specs:
        return sizes.sparkSession.createDataFrame([], schema)
    total = sizes.agg(F.sum("n_tokens")).first()[0] or 0
    shards = max(1, math.ceil(total / shard_tokens))
    choice = F.explode(F.array(*(F.struct(F.lit(s).alias("spec_name"), F.lit(c).alias("capacity_tokens")) for s, c in specs)))
    rows = sizes.filter("n_tokens > 0").select("item_id", "n_tokens", F.pmod(F.xxhash64("item_id", F.when(F.col("item_id").isNull(), F.col("n_tokens"))), F.lit(shards)).cast("int").alias("shard"), choice.alias("s"))
    rows = rows.select("s.spec_name", "s.capacity_tokens", "shard", "item_id", "n_tokens")
    keys = ["spec_name", "capacity_tokens", "shard"]
    rows = rows.repartition(len(specs) * shards, *keys).sortWithinPartitions(*keys, F.xxhash64("item_id", F.lit(7)), "item_id", F.desc("n_tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, packer, last = None, None, None
        for b in batches:
            out: list[list] = [[] for _ in range(8)]
            for spec, capacity, shard, item, n in zip(*(b.column(j).to_pylist() for j in range(5))):
                if (spec, shard) != now:
                    now, packer, last = (spec, shard), Packer(capacity, open_bins), None
                if item is not None and item == last:
                    continue
                last = item
                start = 0
                for piece in range((n + capacity - 1) // capacity):
                    size = min(capacity, n - start)
                    bin_, offset = (packer.fresh(), 0) if size == capacity else packer.put(size)
                    for o, v in zip(out, (spec, capacity, (shard << 40) | bin_, item, piece, start, size, offset)):
                        o.append(v)
                    start += size
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, kinds)], names=["spec_name", "capacity_tokens", "sequence_id", "item_id", "piece", "start_token", "n_tokens", "offset_tokens"])

    return rows.mapInArrow(run, schema)


def fill(packed: DataFrame) -> DataFrame:
    """Per spec: sequences, tokens, how full the sequences are, and how many items are cut."""
    return packed.groupBy("spec_name", "capacity_tokens").agg(
        F.count_distinct("sequence_id").alias("sequences"),
        F.sum("n_tokens").alias("tokens"),
        F.sum((F.col("piece") == 1).cast("int")).alias("items_cut"),
    ).withColumn("filled_share", F.col("tokens") / (F.col("sequences") * F.col("capacity_tokens")))


def container_specs(spark: SparkSession, directory: str) -> list[tuple[str, int]]:
    """The container sizes; a list of settings, not data, so a long one is an error."""
    rows = load(spark, directory, "container_specs").select("spec_name", "capacity_tokens").distinct().limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("more than 1000 container specs")
    return [(r.spec_name, r.capacity_tokens) for r in rows]


def p6_sequences(spark: SparkSession, directory: str) -> DataFrame:
    docs = load(spark, directory, "documents").filter("text is not null and text <> ''").withColumnRenamed("doc_id", "item_id")
    return pack(cut(token_sizes(docs, ["item_id"])), container_specs(spark, directory))


def p6_fill(spark: SparkSession, directory: str) -> DataFrame:
    return fill(p6_sequences(spark, directory))
