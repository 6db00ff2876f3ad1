"""Problem 8: subject areas of documents by complement naive Bayes, EM and calibrated posteriors.

Documents are cut into sentences of hashed words once. Complement naive Bayes learns word weights from
labelled documents; expectation-maximization then spreads each sentence of every document, labelled or
not, over the subjects and learns the weights again. A document's share of a subject is the share of
its sentences with a clear subject that deal with it; a noise-aware logistic curve per subject, fitted
on the labelled documents, turns shares into independent posteriors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marsad.llm import forms
from marsad.session import cut
from marsad.tables import load

BUCKETS = 1 << 16
#: At most so many labelled documents are learnt from, chosen by a hash of their id.
MAX_LABELLED = 200_000
#: EM goes on until no word weight moves by more than this on average, for so many rounds at most.
EM_STILL, EM_ROUNDS = 0.02, 4
#: A sentence is clear from this posterior on.
CLEAR = 0.6
CUTOFF = 0.5
_ENDS = re.compile("[.!?؟\n۔．…]+")


def sentence_words(documents: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, words, lengths): 16-bit word buckets, and how many words each sentence has.

    Null and blank texts give no row; a text without words gives a row without sentences.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = forms.Ids()
        for b in forms.slices(batches):
            out: list[list] = [[], [], []]
            for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not x or x.isspace():
                    continue
                sentences = [w for s in _ENDS.split(x) if (w := forms.bare_words(s))]
                words = ids.of([w for s in sentences for w in s]) & np.uint64(BUCKETS - 1)
                out[0].append(k)
                out[1].append(words.astype(np.uint16).tobytes())
                out[2].append(np.array([len(s) for s in sentences], np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], names=["doc_id", "words", "lengths"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, words binary, lengths binary")


def label_masks(labels: DataFrame, subjects: list[str], most: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, subject) -> (doc_id, mask): bit c says that some label names subject c. Unknown subjects are no labels."""
    bit = F.array_position(F.array(*(F.lit(s) for s in subjects)), F.lower(F.trim("subject"))) - 1
    one = labels.filter("doc_id is not null and subject is not null").select("doc_id", bit.cast("int").alias("c")).filter("c >= 0")
    masks = one.groupBy("doc_id").agg(F.bit_or(F.expr("shiftleft(1L, c)")).alias("mask"))
    n = masks.count()
    if n <= most:
        return masks
    # hashes are spread evenly: those below a bit more than the wanted share hold the first ones, so few are sorted
    below = int(-(2**63) + 2**64 * min(1.0, 1.05 * most / n + 1e-6))
    return masks.filter(F.xxhash64("doc_id") < F.lit(below)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


class Batch:
    """The sentences of a batch of rows as flat arrays."""

    def __init__(self, b: pa.RecordBatch):
        self.doc_ids = b.column(0).to_pylist()
        lengths = [np.frombuffer(x, np.uint32) for x in b.column(2).to_pylist()]
        self.per_doc = np.array([len(x) for x in lengths], np.int64)
        self.lengths = np.concatenate(lengths).astype(np.int64) if lengths else np.zeros(0, np.int64)
        self.words = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).astype(np.int64)
        self.masks = np.array([m or 0 for m in b.column(3).to_pylist()], np.int64)
        self.doc = np.repeat(np.arange(len(self.doc_ids)), self.per_doc)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """(sentences, subjects): summed word weights; computed in slices, so memory stays bounded."""
        out = np.zeros((len(self.lengths), weights.shape[1]), np.float32)
        ends = np.cumsum(self.lengths)
        at = 0
        while at < len(ends):
            first = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, first + 400_000, "right")))
            starts = np.concatenate([[0], ends[at : upto - 1] - first]).astype(np.int64)
            out[at:upto] = np.add.reduceat(weights[self.words[first : ends[upto - 1]]], starts, axis=0)
            at = upto
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def spread(batch: Batch, weights: np.ndarray, use_labels: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """E-step: (posterior of each sentence given its document, whether it is clear, scores)."""
    s = batch.scores(weights)
    k = s.shape[1]
    p = softmax(s)
    clear = p.max(axis=1) >= CLEAR
    tilt = np.ones((len(batch.doc_ids), k))
    if use_labels:
        has = (batch.masks[:, None] >> np.arange(k)) & 1
        tilt = np.where(batch.masks[:, None] != 0, np.where(has == 1, 1.0, 0.1), 1.0)
    share = np.full((len(batch.doc_ids), k), 0.5)
    np.add.at(share, batch.doc[clear], p[clear])
    prior = share / share.sum(axis=1, keepdims=True) * tilt
    q = p * prior[batch.doc]
    return q / np.maximum(q.sum(axis=1, keepdims=True), 1e-30), clear, s


def counted(rows: DataFrame, subjects: int, per_batch) -> np.ndarray:
    """Sum per_batch's (subjects, BUCKETS) arrays over all rows: partial sums per task, then one array per subject."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((subjects, BUCKETS))
        for b in forms.slices(batches):
            if b.num_rows:
                total += per_batch(Batch(b))
        yield pa.RecordBatch.from_arrays([pa.array(range(subjects), pa.int32()), pa.array([t.astype(np.float32).tobytes() for t in total], pa.binary())], names=["c", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in forms.slices(batches):
            for c, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                sums[c] = sums.get(c, 0) + np.frombuffer(x, np.float32).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["c", "counts"])

    out = np.zeros((subjects, BUCKETS))
    summed = rows.select("doc_id", "words", "lengths", "mask").mapInArrow(run, "c int, counts binary").repartition(subjects, "c").mapInArrow(add, "c int, counts binary")
    for r in summed.toLocalIterator():
        out[r.c] = np.frombuffer(r.counts, np.float64)
    return out


def complement_weights(counts: np.ndarray, smooth: float = 0.5, doubt: float = 8.0) -> np.ndarray:
    """(BUCKETS, subjects) weights: minus the log share of a word in all other subjects, centred over the subjects.

    ``doubt`` shrinks words that were hardly seen, such as names.
    """
    total = counts.sum(axis=0)
    rest = total[None, :] - counts + smooth
    w = -np.log(rest / rest.sum(axis=1, keepdims=True))
    w -= w.mean(axis=0, keepdims=True)
    return (w * (total / (total + doubt))[None, :]).T.astype(np.float32).copy()


def from_labels(subjects: int):
    def run(batch: Batch) -> np.ndarray:
        y = ((batch.masks[:, None] >> np.arange(subjects)) & 1).astype(float)
        y /= np.maximum(y.sum(axis=1, keepdims=True), 1)
        weight = np.repeat(y[batch.doc], batch.lengths, axis=0)
        return np.stack([np.bincount(batch.words, weights=weight[:, c], minlength=BUCKETS) for c in range(subjects)])

    return run


def from_spread(weights, subjects: int):
    def run(batch: Batch) -> np.ndarray:
        q, clear, _ = spread(batch, weights.value, use_labels=True)
        q = q * clear[:, None]
        return np.stack([np.bincount(batch.words, weights=np.repeat(q[:, c], batch.lengths), minlength=BUCKETS) for c in range(subjects)])

    return run


def shares_of(batch: Batch, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(share of clear sentences by subject, number of clear sentences, summed scores) of each document."""
    q, clear, s = spread(batch, weights, use_labels=False)
    k = weights.shape[1]
    n, d = len(batch.doc_ids), batch.doc[clear]
    held = np.zeros((n, k))
    np.add.at(held, d, q[clear])
    number = np.bincount(d, minlength=n)
    sums = np.zeros((n, k))
    np.add.at(sums, batch.doc, s)
    return held / np.maximum(number, 1)[:, None], number, sums


BINS = 50


def calibrate(table: np.ndarray) -> np.ndarray:
    """(subjects, BINS, 2) of documents without and with the label -> (subjects, 4): slope, middle, floor, ceiling.

    P(label | share) = floor + (ceiling - floor) * logistic(slope * (share - middle)). Floor and ceiling
    hold wrong and missing labels; the logistic part is the posterior. Fitted by likelihood on a grid;
    a subject with few labels leans on the curve of all subjects together.
    """
    x = (np.arange(BINS) + 0.5) / BINS

    def fit(t: np.ndarray) -> tuple[float, ...]:
        best = (-np.inf, 20.0, 0.25, 0.02, 0.9)
        for floor in (0.005, 0.02, 0.05, 0.1):
            for ceiling in (0.75, 0.8, 0.85, 0.9, 0.95, 0.99):
                for slope in (10.0, 15.0, 20.0, 30.0):
                    for middle in np.arange(0.1, 0.42, 0.02):
                        p = floor + (ceiling - floor) / (1 + np.exp(-slope * (x - middle)))
                        score = (t[:, 0] * np.log(1 - p) + t[:, 1] * np.log(p)).sum()
                        if score > best[0]:
                            best = (score, slope, middle, floor, ceiling)
        return best[1:]

    pooled = fit(table.sum(axis=0))
    prior = table.sum(axis=0) / max(table.sum(), 1) * 400
    return np.array([fit(t + prior) if t.sum() else pooled for t in table])


class Model:
    def __init__(self, subjects: list[str], weights: np.ndarray, curves: np.ndarray, common: int):
        self.subjects, self.weights, self.curves, self.common = subjects, weights, curves, common

    def posteriors(self, share: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.curves[:, 0] * (share - self.curves[:, 1])))


def train(rows: DataFrame, subjects: list[str], rounds: int = EM_ROUNDS) -> Model | None:
    """rows: (doc_id, words, lengths, mask); mask is null or 0 for unlabelled documents. Without a labelled word there is no model."""
    k, sc = len(subjects), rows.sparkSession.sparkContext
    labelled = rows.filter("mask <> 0")
    counts = counted(labelled, k, from_labels(k))
    weights = complement_weights(counts)
    if not counts.any():
        return None
    for _ in range(rounds):
        new = complement_weights(counted(rows, k, from_spread(sc.broadcast(weights), k)))
        moved = float(np.abs(new - weights)[new.any(axis=1)].mean())
        weights = new
        if moved < EM_STILL:
            break
    shared = sc.broadcast(weights)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = np.zeros((k, BINS, 2), np.int64)
        for b in forms.slices(batches):
            if not b.num_rows:
                continue
            batch = Batch(b)
            share, number, _ = shares_of(batch, shared.value)
            some = number > 0
            y = (batch.masks[some, None] >> np.arange(k)) & 1
            at = np.minimum((share[some] * BINS).astype(int), BINS - 1)
            for c in range(k):
                np.add.at(t[c], (at[:, c], y[:, c]), 1)
        yield pa.RecordBatch.from_arrays([pa.array([t.tobytes()], pa.binary())], names=["t"])

    table = np.zeros((k, BINS, 2), np.int64)
    for r in labelled.select("doc_id", "words", "lengths", "mask").mapInArrow(tally, "t binary").toLocalIterator():
        table += np.frombuffer(r.t, np.int64).reshape(table.shape)
    return Model(subjects, weights, calibrate(table), int(counts.sum(axis=1).argmax()))


def classify(rows: DataFrame, model: Model, cutoff: float = CUTOFF) -> DataFrame:
    """(doc_id, subject, share, posterior) of every subject at or above the cutoff, and of the best one in any case.

    A document without a clear sentence gets the subject of the highest summed score; one without any
    known word the most common subject of the labels.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for b in forms.slices(batches):
            if not b.num_rows:
                continue
            batch = Batch(b)
            share, number, sums = shares_of(batch, m.weights)
            post = m.posteriors(share)
            post[number == 0] = 0
            sums[np.abs(sums).sum(axis=1) == 0, m.common] = 1
            best = np.where(number > 0, share.argmax(axis=1), sums.argmax(axis=1))
            keep = post >= cutoff
            keep[np.arange(len(best)), best] = True
            d, c = np.nonzero(keep)
            yield pa.RecordBatch.from_arrays([pa.array([batch.doc_ids[i] for i in d], pa.int64()), pa.array([m.subjects[j] for j in c], pa.string()), pa.array(share[d, c]), pa.array(post[d, c])], names=["doc_id", "subject", "share", "posterior"])

    found = rows.select("doc_id", "words", "lengths", "mask").mapInArrow(run, "doc_id long, subject string, share double, posterior double")
    return found.groupBy("doc_id", "subject").agg(F.max("share").alias("share"), F.max("posterior").alias("posterior"))


def assign(documents: DataFrame, labels: DataFrame, subjects: list[str]) -> DataFrame:
    """Subject areas of every non-blank document.

    Without subjects, or without a label of a document that is there, nothing can be learnt and there is
    no row. A doc_id that repeats, null too, counts once per subject. Extra columns are ignored.
    """
    none = documents.sparkSession.createDataFrame([], "doc_id long, subject string, share double, posterior double")
    if not subjects:
        return none
    masks = cut(label_masks(labels, subjects))
    # at most MAX_LABELLED rows of two numbers: a proven bound
    rows = cut(sentence_words(documents).join(F.broadcast(masks), "doc_id", "left"))
    model = train(rows, subjects)
    return none if model is None else classify(rows, model)


def subject_list(spark: SparkSession, directory: str) -> list[str]:
    rows = load(spark, directory, "subject_areas").select(F.lower(F.trim("subject")).alias("s")).filter("s is not null").distinct().orderBy("s").limit(61).collect()
    if len(rows) > 60:
        raise ValueError("more than 60 subjects")
    return [r.s for r in rows]


def project_subjects(spark: SparkSession, directory: str) -> DataFrame:
    return assign(load(spark, directory, "documents"), load(spark, directory, "subject_labels"), subject_list(spark, directory))


def p8_found(spark: SparkSession, directory: str) -> DataFrame:
    return project_subjects(spark, directory).select("doc_id", "subject")


def p8_composition(spark: SparkSession, directory: str) -> DataFrame:
    """Documents and their characters by subject; a document with several subjects counts under each."""
    sizes = load(spark, directory, "documents").select("doc_id", F.length("text").alias("chars"))
    return project_subjects(spark, directory).join(sizes, "doc_id").groupBy("subject").agg(F.count("*").alias("documents"), F.sum("chars").alias("chars"))
