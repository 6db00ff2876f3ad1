"""Problem 5: near-duplicate records by a grouped prefix join on word runs.

1. A fixed-size count sketch over all texts orders the tokens (runs of k words) from rare to common.
2. Equal token sets collapse into one class; classes with the same prefix of their ordered set and
   the same size collapse into one group.
3. Groups meet on a token of their prefixes; size and position filters drop pairs that cannot reach
   the threshold. The long list of a token is compared in blocks, in order of size.
4. The classes of the remaining groups are compared by bitmaps, which bound their overlap from above,
   then verified on their whole sets, and members expand.

All filters are exact, so no pair at or above the threshold is lost. Sets are compared by 64-bit
hashes of their tokens.
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
from marsad.tables import load, role

#: Classes or pairs of classes of up to so many pairs of records expand to all of them; larger ones to links through representatives.
EXPAND_PAIRS = 2_500
#: Buckets are sent in pieces of so many.
PIECE = 1 << 12
#: 64-bit words of the bitmap of a token set.
MAP_WORDS = 8
#: A token with more groups than this is compared in blocks rather than within one task.
LONG_LIST = 2_000
#: Long lists are compared in blocks of so many postings.
BLOCK = 4_000
#: Steps of the frequency scale to a doubling.
FINE = 1_024


@dataclass(frozen=True)
class Spec:
    """Tokens are runs of ``run`` words; two sets are similar from ``threshold`` on; texts below ``min_words`` words stay out."""

    run: int = 5
    threshold: float = 0.8
    min_words: int = 1

    def prefix(self, n: np.ndarray | int):
        """Tokens of a set of n among which any similar set has one."""
        return n - np.ceil(self.threshold * n - 1e-9).astype(np.int64) + 1

    def indexed(self, n: np.ndarray | int):
        """Tokens of a set of n among which any similar set that is no smaller has one."""
        return n - np.ceil(2 * self.threshold / (1 + self.threshold) * n - 1e-9).astype(np.int64) + 1


def tokens_of(texts: list[str], codes: list[int], specs: list[Spec], ids: forms.Ids) -> list[np.ndarray | None]:
    """The distinct hashed tokens of each text; None where it has too few words or no token."""
    out: list[np.ndarray | None] = [None] * len(texts)
    for c, spec in enumerate(specs):
        least = max(spec.min_words, spec.run)
        # words and the gaps between them take 2 * least - 1 characters at least
        mine = [(i, w) for i, x in enumerate(texts) if codes[i] == c and x and len(x) >= 2 * least - 1 and len(w := forms.marked_words(x)) >= least]
        if not mine:
            continue
        h = ids.of([y for _, w in mine for y in w])
        m = len(h) - spec.run + 1
        t = np.full(m, c + 1, np.uint64)
        for j in range(spec.run):
            t = (t ^ h[j : j + m]) * _ODD
            t ^= t >> np.uint64(29)
        t *= _ODD2
        t ^= t >> np.uint64(32)
        at = 0
        for i, w in mine:
            u = t[at : at + len(w) - spec.run + 1].copy()
            u.sort()
            if len(u) > 1:
                u = u[np.concatenate([_TRUE, u[1:] != u[:-1]])]
            out[i] = u
            at += len(w)
    return out


_TRUE = np.array([True])
_ODD, _ODD2 = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


def sketch_bits(texts: DataFrame) -> int:
    """A bucket for about 64 stored bytes, so the sketch follows the input up to 16 million buckets, and no further."""
    stored = int(str(texts._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(14, min(24, math.ceil(math.log2(max(stored, 1) / 64))))


def token_levels(coded: DataFrame, specs: list[Spec], bits: int) -> np.ndarray:
    """How many texts have a token of each bucket, on a fine logarithmic scale: a table of fixed size.

    A step of the scale is 0.07 %, so that even where a bucket holds a million rare tokens, one of some
    thousand texts raises it visibly above its neighbours and comes late in the order.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = forms.Ids()
        total = np.zeros(1 << bits, np.uint32)
        for b in forms.slices(batches):
            sets = [t for t in tokens_of(b.column(2).to_pylist(), b.column(0).to_pylist(), specs, ids) if t is not None]
            if sets:
                at, n = np.unique((np.concatenate(sets) >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)
                total[at] += n.astype(np.uint32)
        pieces = total.reshape(-1, PIECE)
        some = np.flatnonzero(pieces.any(axis=1))
        # the narrowest type that fits keeps the shuffle small
        data = [p.astype(np.uint8).tobytes() if p.max() < 256 else p.astype(np.uint16).tobytes() if p.max() < 65536 else p.tobytes() for p in pieces[some]]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(data, pa.binary())], names=["piece", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                kind = {1: np.uint8, 2: np.uint16, 4: np.uint32}[len(data) // PIECE]
                v = np.frombuffer(data, kind).astype(np.uint64)
                sums[k] = sums[k] + v if k in sums else v
        levels = [(np.log2(v + 1.0) * FINE).astype(np.uint16).tobytes() for v in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], names=["piece", "levels"])

    pieces = coded.mapInArrow(count, "piece int, counts binary").repartition("piece").mapInArrow(add, "piece int, levels binary")
    out = np.zeros(1 << bits, np.uint16)
    for r in pieces.toLocalIterator():
        out[r.piece * PIECE : (r.piece + 1) * PIECE] = np.frombuffer(r.levels, np.uint16)
    return out


def features(coded: DataFrame, specs: list[Spec], levels: np.ndarray, bits: int) -> DataFrame:
    """(code, key, text) -> (code, key, n, whole, gid, bitmap, prefix).

    ``gid`` names the group of equal code, size, prefix and bitmap folded to 64 bits. The prefix itself comes once per group and
    task, and is null on the other rows, so a group that holds a third of all rows stays small.
    """
    shared = coded.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = forms.Ids()
        sent: set[int] = set()
        for b in forms.slices(batches):
            codes, keys = b.column(0).to_pylist(), b.column(1).to_pylist()
            out: list[list] = [[] for _ in range(7)]
            for c, k, t in zip(codes, keys, tokens_of(b.column(2).to_pylist(), codes, specs, ids)):
                if t is None:
                    continue
                p = int(specs[c].prefix(np.int64(len(t))))
                order = np.argsort(shared.value[t >> np.uint64(64 - bits)], kind="stable")[:p]
                prefix = t[order].tobytes()
                # each bit is the parity of how many tokens fall on it, so bits that differ need as many tokens that differ
                bitmap = np.packbits(np.bincount((t & np.uint64(MAP_WORDS * 64 - 1)).astype(np.int64), minlength=MAP_WORDS * 64).astype(np.uint8) & 1).view(np.int64)
                gid = forms.digest(f"{c} {len(t)} {np.bitwise_xor.reduce(bitmap)} " + prefix.hex())
                first = gid not in sent
                if first:
                    if len(sent) >= 200_000:
                        sent.clear()
                    sent.add(gid)
                for o, v in zip(out, (c, k, len(t), forms.digest128(t.tobytes()), gid, bitmap, prefix if first else None)):
                    o.append(v)
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, kinds)], names=["code", "key", "n", "whole", "gid", "bitmap", "prefix"])

    return coded.mapInArrow(run, "code int, key long, n int, whole binary, gid long, bitmap array<long>, prefix binary")


def postings(feats: DataFrame) -> DataFrame:
    """(token, gid, place, brief): a row per token of a group's prefix.

    ``place`` packs code, size and position; ``brief`` is the bitmap folded to 64 bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in forms.slices(batches):
            out = [[np.zeros(0, np.int64)] for _ in range(4)]
            for c, n, g, x, m in zip(*(b.column(j).to_pylist() for j in range(5))):
                t = np.frombuffer(x, np.int64)
                for o, v in zip(out, (t, np.full(len(t), g), np.arange(len(t)) + ((c << 56) | (n << 28)), np.full(len(t), m))):
                    o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z)) for z in out], names=["token", "gid", "place", "brief"])

    brief = F.col("bitmap")[0]
    for j in range(1, MAP_WORDS):
        brief = brief.bitwiseXOR(F.col("bitmap")[j])
    return feats.filter("prefix is not null").select("code", "n", "gid", "prefix", brief.alias("brief")).mapInArrow(run, "token long, gid long, place long, brief long")


def meet(gid: tuple, place: tuple, brief: tuple, thresholds: np.ndarray) -> np.ndarray:
    """Which pairs of postings of one token survive the size, position and bitmap filters."""
    code = place[0] >> 56
    n, pos = [(p >> 28) & 0xFFFFFFF for p in place], [p & 0xFFFFFFF for p in place]
    swap = (n[0] > n[1]) | ((n[0] == n[1]) & (gid[0] > gid[1]))
    small, large = np.where(swap, n[1], n[0]), np.where(swap, n[0], n[1])
    at = np.where(swap, pos[1], pos[0])
    t = thresholds[code]
    keep = (gid[0] != gid[1]) & (small >= t * large - 1e-9)
    keep &= at < small - np.ceil(2 * t / (1 + t) * small - 1e-9) + 1
    needed = np.ceil(t / (1 + t) * (small + large) - 1e-9)
    keep &= np.minimum(n[0] - pos[0], n[1] - pos[1]) >= needed
    keep &= (small + large - np.bitwise_count((brief[0] ^ brief[1]).view(np.uint64))) / 2 >= needed
    return keep


def candidates(posts: DataFrame, rules: list[Spec], long_list: int = LONG_LIST, block: int = BLOCK) -> DataFrame:
    """(gid_a, gid_b), gid_a < gid_b, of groups that share a token of their prefixes and pass the filters.

    Postings of a group that several tasks sent count once. The list of a token comes in order of size.
    A list of up to ``long_list`` postings is compared in place; a longer one is cut into blocks as it
    streams by, and only blocks that can hold similar sizes meet.
    """
    thresholds = np.array([r.threshold for r in rules])
    lowest = float(thresholds.min()) if len(rules) else 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(token, a, b, sizes=(0, 0), number=0, data=None):
            n = len(a)
            columns = [np.full(n, token), a, b, np.full(n, sizes[0]), np.full(n, sizes[1]), np.full(n, number)]
            return pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int64)) for c in columns), pa.array([data] * n, pa.binary())], names=["token", "gid_a", "gid_b", "least", "most", "number", "data"])

        def pairs(token, gid, place, brief):
            found = [np.zeros((0, 2), np.int64)]
            i = np.arange(len(token))
            step = 1
            while True:
                i = i[i + step < len(token)]
                i = i[token[i] == token[i + step]]
                if not len(i):
                    break
                k = i[meet((gid[i], gid[i + step]), (place[i], place[i + step]), (brief[i], brief[i + step]), thresholds)]
                if len(k):
                    found.append(np.sort(np.column_stack([gid[k], gid[k + step]]), axis=1))
                step += 1
            both = np.unique(np.concatenate(found), axis=0)
            return rows(0, both[:, 0], both[:, 1])

        def cut_off(x, number):
            """A block as one row: sizes from least to most, and its postings."""
            n = (x[1] >> 28) & 0xFFFFFFF
            return rows(int(x[0][0]), np.zeros(1), np.zeros(1), (int(n.min()), int(n.max())), number, np.column_stack([x[2], x[1], x[3]]).tobytes())

        held = [np.zeros(0, np.int64)] * 4
        passing, number = None, 0
        for b in batches:
            now = [np.concatenate([h, b.column(j).to_numpy(zero_copy_only=False)]) for j, h in enumerate(held)]
            if not len(now[0]):
                continue
            # sorted by token, place and group, so repeats are neighbours
            new = np.concatenate([_TRUE, (now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1]) | (now[2][1:] != now[2][:-1])])
            now = [x[new] for x in now]
            starts = np.flatnonzero(np.concatenate([_TRUE, now[0][1:] != now[0][:-1]]))
            ends = np.concatenate([starts[1:], [len(now[0])]])
            is_long = (ends - starts > long_list) | (now[0][starts] == passing)
            short = np.repeat(~is_long, ends - starts)
            short[starts[-1] :] = False
            if short.any():
                yield pairs(*(now[j][short] for j in (0, 2, 1, 3)))
            rest = len(now[0])
            for s, e in zip(starts[is_long], ends[is_long]):
                token = int(now[0][s])
                passing, number = token, number if passing == token else 0
                last = e == len(now[0])
                while e - s >= block or (e > s and not last):
                    yield cut_off([x[s : min(e, s + block)] for x in now], number)
                    number, s = number + 1, min(e, s + block)
                if last:
                    rest = s
            if not is_long[-1]:
                rest = starts[-1]
            held = [x[rest:] for x in now]
        if len(held[0]):
            if passing is not None and held[0][0] == passing:
                yield cut_off(held, number)
            else:
                yield pairs(*(held[j] for j in (0, 2, 1, 3)))

    # token 0 marks a finished pair; the others are blocks of long lists
    kinds = "token long, gid_a long, gid_b long, least long, most long, number long, data binary"
    spread = posts.withColumn("token", F.when(F.col("token") == 0, 1).otherwise(F.col("token"))).select("token", "place", "gid", "brief").repartition("token")
    met = cut(spread.sortWithinPartitions("token", "place", "gid").mapInArrow(run, kinds))
    blocks = met.filter("token <> 0").select("token", "least", "most", "number", "data")
    x, y = (blocks.select("token", *(F.col(c).alias(f"{c}_{z}") for c in ("least", "most", "number", "data"))) for z in "xy")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in forms.slices(batches, 16):
            found = [np.zeros((0, 2), np.int64)]
            for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                p, q = (np.frombuffer(d, np.int64).reshape(-1, 3) for d in (u, v))
                for part in np.array_split(p, max(1, len(p) * len(q) // 500_000)):
                    i, j = (k.ravel() for k in np.indices((len(part), len(q))))
                    k = meet((part[i, 0], q[j, 0]), (part[i, 1], q[j, 1]), (part[i, 2], q[j, 2]), thresholds)
                    found.append(np.sort(np.column_stack([part[i[k], 0], q[j[k], 0]]), axis=1))
            both = np.unique(np.concatenate(found), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["gid_a", "gid_b"])

    # blocks whose sizes are too far apart never meet; the number of tasks is set, as few bytes are much work here
    near = lambda p, q: F.col(f"most_{p}") >= F.lit(lowest) * F.col(f"least_{q}") - 1e-9
    may = (F.col("number_x") <= F.col("number_y")) & near("x", "y") & near("y", "x")
    tasks = int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    from_blocks = x.join(y, "token").filter(may).select("data_x", "data_y").repartition(tasks, "data_x", "data_y").mapInArrow(compare, "gid_a long, gid_b long")
    return met.filter("token = 0").select("gid_a", "gid_b").unionByName(from_blocks).distinct()


class Found:
    """Similar classes of records and their members.

    ``classes``: (code, gid, rep, whole, copies), one row per distinct token set; ``rep`` is its smallest key.
    ``members``: (code, key, whole), one row per record.
    ``links``: (code, rep_a, rep_b, similarity), rep_a < rep_b, of similar classes.
    """

    def __init__(self, names: list[str], classes: DataFrame, members: DataFrame, links: DataFrame):
        self.names, self.classes, self.members, self.links = names, classes, members, links

    def name(self):
        return F.element_at(F.array(*(F.lit(x) for x in self.names)), F.col("code") + 1).alias("record_table")


def similar(texts: DataFrame, specs: dict[str, Spec]) -> Found:
    """Join (record_table, record_key, text) with itself. Tables without a Spec stay out, as do null and short texts.

    Records of different tables never meet. A key that repeats with an equal text counts once; rows
    without a key take part in no pair. Extra columns are ignored.
    """
    names = list(specs)
    rules = [specs[x] for x in names]
    code = F.array_position(F.array(*(F.lit(x) for x in names)), F.col("record_table")).cast("int") - 1
    coded = texts.filter(F.col("record_table").isin(names) & F.col("text").isNotNull() & F.col("record_key").isNotNull()).select(code.alias("code"), F.col("record_key").alias("key"), "text")
    bits = sketch_bits(texts)
    levels = token_levels(coded, rules, bits)
    feats = cut(features(coded, rules, levels, bits))
    members = feats.select("code", "key", "whole").distinct()
    classes = cut(feats.groupBy("code", "gid", "whole", "n").agg(F.min("key").alias("rep"), F.count_distinct("key").alias("copies"), F.first("bitmap").alias("bitmap")))
    met = candidates(postings(feats), rules)
    a = classes.select(F.col("gid").alias("gid_a"), "code", F.col("rep").alias("x"), F.col("n").alias("n_a"), F.col("bitmap").alias("map_a"))
    b = classes.select(F.col("gid").alias("gid_b"), F.col("rep").alias("y"), F.col("n").alias("n_b"), F.col("bitmap").alias("map_b"))
    wide = classes.groupBy("gid").agg(F.count("*").alias("width")).filter("width > 1").select(F.col("gid").alias("gid_a"), F.col("gid").alias("gid_b"))
    pairs = met.join(a, "gid_a").join(b, "gid_b").unionByName(wide.join(a, "gid_a").join(b, "gid_b").filter("x < y"))
    # bits that differ are tokens that only one of the sets has
    apart = sum((F.bit_count(F.col("map_a")[j].bitwiseXOR(F.col("map_b")[j])) for j in range(MAP_WORDS)), F.lit(0))
    t = F.element_at(F.array(*(F.lit(r.threshold) for r in rules)), F.col("code") + 1)
    size = F.col("n_a") + F.col("n_b")
    pairs = pairs.filter((size - apart) / 2 >= t / (1 + t) * size - 1e-9)
    pairs = cut(pairs.select("code", F.least("x", "y").alias("rep_a"), F.greatest("x", "y").alias("rep_b")))
    return Found(names, classes, members, cut(verified(coded, rules, pairs, max(15, min(B.MOST_BITS, bits + 2)))))


def key_hash(code: list[int], key: list[int]) -> np.ndarray:
    return np.array(key, np.int64).view(np.uint64) * _ODD + np.array(code, np.uint64) * _ODD2


def verified(coded: DataFrame, rules: list[Spec], pairs: DataFrame, bits: int) -> DataFrame:
    """Keep the pairs whose whole sets reach the threshold.

    Texts are read again; a filter of fixed size lets those of candidates through, and hardly any others,
    so no text is shuffled.
    """

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(key_hash(b.column(0).to_pylist(), b.column(1).to_pylist()).view(np.int64))], names=["key"])

    wanted = pairs.select("code", F.explode(F.array("rep_a", "rep_b")).alias("key")).mapInArrow(hashes, "key long")
    filter_ = coded.sparkSession.sparkContext.broadcast(B.bit_table(wanted, bits))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = forms.Ids()
        for b in forms.slices(batches):
            if not b.num_rows:
                continue
            codes, keys = b.column(0).to_pylist(), b.column(1).to_pylist()
            keep = B.held(filter_.value, key_hash(codes, keys), bits)
            texts = [x if k else None for x, k in zip(b.column(2).to_pylist(), keep)]
            rows = [(c, k, t.tobytes()) for c, k, t in zip(codes, keys, tokens_of(texts, codes, rules, ids)) if t is not None]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int32(), pa.int64(), pa.binary()))], names=["code", "key", "tokens"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in forms.slices(batches):
            rows = []
            for c, x, y, s, t in zip(*(b.column(j).to_pylist() for j in range(5))):
                p, q = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                if both >= rules[c].threshold * (either := len(p) + len(q) - both) - 1e-9:
                    rows.append((c, x, y, both / either))
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.float64()))], names=["code", "rep_a", "rep_b", "similarity"])

    held = coded.filter("key is not null").mapInArrow(sets, "code int, key long, tokens binary").dropDuplicates(["code", "key"])
    one = held.select("code", F.col("key").alias("rep_a"), F.col("tokens").alias("tokens_a"))
    two = held.select("code", F.col("key").alias("rep_b"), F.col("tokens").alias("tokens_b"))
    return pairs.join(one, ["code", "rep_a"]).join(two, ["code", "rep_b"]).select("code", "rep_a", "rep_b", "tokens_a", "tokens_b").mapInArrow(compare, "code int, rep_a long, rep_b long, similarity double")


def record_pairs(found: Found, expand_pairs: int = EXPAND_PAIRS) -> DataFrame:
    """(record_table, key_a, key_b), key_a < key_b, of similar records, equal texts included.

    Classes, and pairs of classes, with at most ``expand_pairs`` pairs of records give all of them. A
    larger class gives a link from each copy to its representative, and a larger pair of classes the
    link of the two representatives: every record stays linked, in rows that grow with the records.
    """
    c = found.classes.select("code", "rep", "whole", "copies")
    m = found.members
    several = c.filter("copies > 1")
    of_copies = several.join(m, ["code", "whole"]).select("code", "rep", "copies", "key")
    few = F.col("copies") * (F.col("copies") - 1) / 2 <= expand_pairs
    x, y = of_copies.filter(few).select("code", "rep", F.col("key").alias("key_a")), of_copies.filter(few).select("code", "rep", F.col("key").alias("key_b"))
    equal = x.join(y, ["code", "rep"]).filter("key_a < key_b").select("code", "key_a", "key_b")
    star = of_copies.filter(~few & (F.col("key") != F.col("rep"))).select("code", F.col("rep").alias("key_a"), F.col("key").alias("key_b"))
    sizes = c.select("code", "rep", "copies", "whole")
    p = (
        found.links.join(sizes.select("code", F.col("rep").alias("rep_a"), F.col("copies").alias("c_a"), F.col("whole").alias("w_a")), ["code", "rep_a"])
        .join(sizes.select("code", F.col("rep").alias("rep_b"), F.col("copies").alias("c_b"), F.col("whole").alias("w_b")), ["code", "rep_b"])
    )
    single = p.filter("c_a = 1 and c_b = 1").select("code", F.col("rep_a").alias("key_a"), F.col("rep_b").alias("key_b"))
    wide = p.filter((F.col("c_a") * F.col("c_b") > expand_pairs)).select("code", F.col("rep_a").alias("key_a"), F.col("rep_b").alias("key_b"))
    multi = p.filter((F.col("c_a") * F.col("c_b") > 1) & (F.col("c_a") * F.col("c_b") <= expand_pairs))
    cross = (
        multi.join(m.select("code", F.col("whole").alias("w_a"), F.col("key").alias("ka")), ["code", "w_a"])
        .join(m.select("code", F.col("whole").alias("w_b"), F.col("key").alias("kb")), ["code", "w_b"])
        .select("code", F.least("ka", "kb").alias("key_a"), F.greatest("ka", "kb").alias("key_b"))
    )
    return equal.unionByName(star).unionByName(single).unionByName(wide).unionByName(cross).select(found.name(), "key_a", "key_b")


def clusters(found: Found) -> DataFrame:
    """(record_table, record_key, class_key, cluster_key, n_links): one row per record.

    ``class_key`` is the smallest key with an equal token set; ``n_links`` counts the similar classes;
    ``cluster_key`` is the smallest key of the connected group, found by label propagation with
    shortcuts that ends when nothing changes, each round cut to the shared checkpoint folder.
    """
    both = found.links.select("code", F.col("rep_a").alias("u"), F.col("rep_b").alias("v")).unionByName(found.links.select("code", F.col("rep_b").alias("u"), F.col("rep_a").alias("v")))
    edges = cut(both)
    labels = cut(edges.groupBy("code", "u").agg(F.least(F.min("v"), F.first("u")).alias("label")))
    while True:
        near = edges.join(labels.select("code", F.col("u").alias("v"), "label"), ["code", "v"]).groupBy("code", "u").agg(F.min("label").alias("near"))
        step = labels.join(near, ["code", "u"]).select("code", "u", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = step.select("code", F.col("u").alias("label"), F.col("label").alias("further"))
        new = cut(step.join(jump, ["code", "label"], "left").select("code", "u", "old", F.least("label", F.coalesce("further", "label")).alias("label")))
        changed = new.filter("label <> old").limit(1).count()
        labels = new.select("code", "u", "label")
        if not changed:
            break
    degree = edges.groupBy("code", "u").agg(F.count("*").alias("n_links"))
    return (
        found.members.join(found.classes.select("code", "whole", "rep"), ["code", "whole"])
        .join(labels.withColumnRenamed("u", "rep"), ["code", "rep"], "left")
        .join(degree.withColumnRenamed("u", "rep"), ["code", "rep"], "left")
        .select(found.name(), F.col("key").alias("record_key"), F.col("rep").alias("class_key"), F.coalesce("label", "rep").alias("cluster_key"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )


PROJECT = {"documents": Spec(5, 0.6, 40), "messages": Spec(5, 0.6, 40), "seed_pool": Spec(1, 0.7, 1)}


def project_texts(spark: SparkSession, directory: str) -> DataFrame:
    def of(table: str, df: DataFrame, key: str, text: str) -> DataFrame:
        return df.select(F.lit(table).alias("record_table"), F.col(key).alias("record_key"), F.col(text).alias("text"))

    return (
        of("documents", load(spark, directory, "documents"), "doc_id", "text")
        .unionByName(of("messages", load(spark, directory, "messages").filter(role() == "assistant"), "message_id", "content"))
        .unionByName(of("seed_pool", load(spark, directory, "seed_pool"), "seed_index", "question"))
    )


def p5_found(spark: SparkSession, directory: str) -> DataFrame:
    return record_pairs(similar(project_texts(spark, directory), PROJECT))


def p5_groups(spark: SparkSession, directory: str) -> DataFrame:
    """Class, group and number of links of every record with a text, similar as in ``p5_found``; one too short for that is a group of its own."""
    texts = project_texts(spark, directory)
    every = texts.filter("record_key is not null and text is not null").select("record_table", "record_key").distinct()
    own = F.col("record_key")
    return every.join(clusters(similar(texts, PROJECT)), ["record_table", "record_key"], "left").select(
        "record_table", "record_key", F.coalesce("class_key", own).alias("class_key"), F.coalesce("cluster_key", own).alias("cluster_key"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
