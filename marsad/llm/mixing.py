"""Problem 7: mix sources to target shares of the size by systematic sampling."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marsad.llm.sizes import token_sizes
from marsad.session import cut
from marsad.tables import load

SEED = 42


def rates(targets: list[tuple], sizes: dict[str, int]) -> list[dict]:
    """Expected copies of a document, by mix and source.

    Weights are relative within a mix. A source without tokens cannot contribute; its share goes to the
    others in proportion and is reported. The mix is as large as it can be while every source keeps its
    share and no document is expected more often than ``max_repeats``. Null, infinite or non-positive weights and
    null or negative repeats count as 0; of repeated rows for one source the largest weight holds.
    """
    mixes: dict[str, dict[str, tuple[float, int]]] = {}
    for mix, source, weight, repeats in targets:
        if mix is None or source is None:
            continue
        old = mixes.setdefault(mix, {}).get(source, (0.0, 0))
        weight = float(weight or 0)
        mixes[mix][source] = max(old, (weight if 0 < weight < math.inf else 0.0, max(0, int(repeats or 0))))
    out = []
    for mix, sources in sorted(mixes.items()):
        whole = sum(w for w, _ in sources.values())
        usable = {s: w for s, (w, r) in sources.items() if w > 0 and r > 0 and sizes.get(s, 0) > 0}
        used = sum(usable.values())
        size = min((sources[s][1] * sizes[s] * used / w for s, w in usable.items()), default=0.0)
        for s, (w, r) in sorted(sources.items()):
            share = usable.get(s, 0.0) / used if used else 0.0
            out.append({
                "mix_name": mix, "source": s, "target_share": w / whole if whole else 0.0, "reachable_share": share, "max_repeats": r,
                "rate": min(float(r), share * size / sizes[s]) if s in usable else 0.0,
            })
    return out


def offset(mix: str, source: str, seed: int) -> float:
    """The one random offset of a source in a mix, in [0, 1)."""
    return int.from_bytes(hashlib.sha256(f"{seed}\0{mix}\0{source}".encode()).digest()[:6], "big") / 2**48


def ranked(sized: DataFrame) -> DataFrame:
    """Number the documents of each source from 1 in order of size, without one task per source.

    Rows are spread by range over (source, size, id); each task counts its own rows, and the counts of
    the tasks before it are added. Order by size makes each stretch of the sample representative of it.
    """
    spread = sized.repartitionByRange("source", "n_tokens", "doc_id").sortWithinPartitions("source", "n_tokens", "doc_id")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen: dict[str, int] = {}
        for b in batches:
            rank = []
            for s in b.column(1).to_pylist():
                seen[s] = seen.get(s, 0) + 1
                rank.append(seen[s])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * len(rank), pa.int32()), pa.array(rank, pa.int64())], names=["doc_id", "source", "n_tokens", "part", "rank"])

    local = cut(spread.select("doc_id", "source", "n_tokens").mapInArrow(number, "doc_id long, source string, n_tokens long, part int, rank long"))
    counts = local.groupBy("part", "source").agg(F.max("rank").alias("rows"))
    # a row a task and source, so the window of a source holds as many rows as its tasks
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "source", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    return local.join(before, ["part", "source"]).select("doc_id", "source", "n_tokens", (F.col("rank") + F.col("before")).alias("rank"))


def mix(sized: DataFrame, targets: list[tuple], seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, n_tokens) and (mix_name, source, weight, max_repeats) -> the mix and its shares.

    The mix has (mix_name, doc_id, source, n_tokens, copies), copies >= 1 and at most max_repeats: the
    running sum of expected copies within a source, shifted by one random offset, gives a copy at each
    whole number it crosses. Documents without a source or tokens are not chosen; a doc_id that repeats, null too,
    counts once. The shares have a row for each target, reached or not.
    """
    spark = sized.sparkSession
    sized = cut(sized.filter("source is not null and n_tokens > 0").groupBy("doc_id").agg(F.min(F.struct("source", "n_tokens")).alias("d")).select("doc_id", "d.source", "d.n_tokens"))
    named = sorted({t[1] for t in targets if t[1] is not None})
    sizes = {r.source: r.n for r in sized.filter(F.col("source").isin(named)).groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    plan = rates(targets, sizes)
    schema = "mix_name string, source string, target_share double, reachable_share double, max_repeats int, rate double, shift double"
    rows = [(*(p[k] for k in ("mix_name", "source", "target_share", "reachable_share", "max_repeats", "rate")), offset(p["mix_name"], p["source"], seed)) for p in plan]
    settings = spark.createDataFrame(rows, schema)
    # the settings are as many rows as the targets: a bounded list
    use = F.broadcast(settings.filter("rate > 0").select("mix_name", "source", "rate", "shift", "max_repeats"))
    chosen = ranked(sized.filter(F.col("source").isin(named))).join(use, "source").withColumn(
        "copies", F.least(F.col("max_repeats").cast("long"), F.floor(F.col("rate") * F.col("rank") + F.col("shift")) - F.floor(F.col("rate") * (F.col("rank") - 1) + F.col("shift")))
    )
    chosen = chosen.filter("copies > 0").select("mix_name", "doc_id", "source", "n_tokens", F.col("copies").cast("int").alias("copies"))
    got = chosen.groupBy("mix_name", "source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("documents"), F.max("copies").alias("most_copies"))
    whole = got.groupBy("mix_name").agg(F.sum("tokens").alias("mix_tokens"))
    shares = settings.join(got, ["mix_name", "source"], "left").join(whole, "mix_name", "left").select(
        "mix_name", "source", "target_share", "reachable_share",
        F.coalesce(F.col("tokens") / F.col("mix_tokens"), F.lit(0.0)).alias("actual_share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"),
        F.coalesce("most_copies", F.lit(0)).alias("most_copies"), "max_repeats",
    )
    return chosen, shares


def project_mix(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    rows = load(spark, directory, "mix_targets").select("mix_name", "source", "weight", "max_repeats").distinct().limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("more than 10000 mix targets")
    docs = load(spark, directory, "documents").filter("source is not null and text is not null and text <> ''")
    return mix(token_sizes(docs, ["doc_id", "source"]), [tuple(r) for r in rows])


def p7_mix(spark: SparkSession, directory: str) -> DataFrame:
    return project_mix(spark, directory)[0]


def p7_shares(spark: SparkSession, directory: str) -> DataFrame:
    return project_mix(spark, directory)[1]
