"""Toxic spans by a linear-chain conditional random field over words.

Words are labelled from labelled documents: a word of a toxic document is toxic if one of its traits
(itself, its beginnings, its end) is significantly tied to toxic documents. The field learns
weights of traits and transitions from these tokens. Forward-backward marginals say how likely each
word of a text is toxic; they give the spans and, summed up, the score of the document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from ledgerloom.llm.common import bounded_batches, chunks
from ledgerloom.llm.quality import sample_of
from ledgerloom.llm.words import Words, scan

SAMPLE_ROWS = 10_000  # labelled documents the field is fitted on, at most
SAMPLE_BYTES = 6 << 20  # and their bytes of text in all
BUCKET_BITS = 20
PREFIXES, SUFFIXES = (4, 5, 6), (5,)
STEPS, RATE, RIDGE = 15, 0.4, 1e-6
SPAN_THRESHOLD = 0.5


def traits(texts: list[bytes]) -> tuple[Words, np.ndarray]:
    """Words, and for each trait and word its bucket; bucket 0 is "none"."""
    words = scan(texts, PREFIXES, SUFFIXES)
    rows = []
    for k, h in enumerate([words.core, *words.parts, *words.tails]):
        bucket = (h ^ np.uint64(0x9E3779B97F4A7C15 * k & (1 << 64) - 1)) >> np.uint64(64 - BUCKET_BITS)
        rows.append(np.where(h == 0, 0, bucket.astype(np.int32) | 1).astype(np.int32))
    return words, np.stack(rows)


def _emission(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the weights of each word's traits."""
    total = np.zeros(rows.shape[1])
    for row in rows:
        total += weights[row]
    return total


def _layout(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts cut into runs of equal length: places [step, run], which are real, runs' number in the text."""
    sizes = np.diff(first)
    length = int(np.clip(np.sqrt(max(sizes.max(initial=0), 1)), 16, 4096))
    runs = -(-sizes // length)
    owner = np.repeat(np.arange(len(sizes)), runs)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    begin = first[owner] + number * length
    place = begin[None, :] + np.arange(length)[:, None]
    return place, place < first[owner + 1][None, :], number


def passes(emission: np.ndarray, transition: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward weight ratios (toxic to clean) of every word, for marginals f b / (1 + f b).

    ``emission`` is the log weight of "toxic" against "clean"; ``transition`` the log weights between
    the two, where a chain starts as if after a clean word. Texts are cut into runs that are
    walked side by side: once to reduce each to a 2x2 product, so that what enters a run is known, and
    once to give every word its ratio. This is exact for chains of any length.
    """
    if not len(emission):
        return np.empty(0), np.empty(0)
    (a00, a01), (a10, a11) = np.exp(transition)
    place, real, number = _layout(first)
    e = np.exp(np.clip(emission, -30, 30))
    e = np.where(real, e[np.minimum(place, len(e) - 1)], 1.0)
    length, n = e.shape
    follows = [np.flatnonzero(number == k) for k in range(1, int(number.max()) + 1)]

    def product(steps, b, c):
        """Product of diag(1, e) [[a00, b], [c, a11]] over the steps, scaled."""
        p = [np.ones(n), np.zeros(n), np.zeros(n), np.ones(n)]
        for t in steps:
            q = [a00 * p[0] + b * p[2], a00 * p[1] + b * p[3], e[t] * (c * p[0] + a11 * p[2]), e[t] * (c * p[1] + a11 * p[3])]
            total = q[0] + q[1] + q[2] + q[3]
            p = [x / total for x in q]
        return p

    def applied(p, own, x):
        return (p[2][own] + p[3][own] * x) / (p[0][own] + p[1][own] * x)

    ratio = np.zeros(n)  # before the first word of each run
    if follows:
        p = product(range(length), a10, a01)
        for own in follows:
            ratio[own] = applied(p, own - 1, ratio[own - 1])
    forward = np.empty_like(e)
    for t in range(length):
        ratio = e[t] * (a01 + a11 * ratio) / (a00 + a10 * ratio)
        forward[t] = ratio

    def backwards(runs, enter):
        """Walk runs from their last real word, where the ratio is ``enter``."""
        ratios = np.empty((length, len(runs)))
        x, started = np.ones(len(runs)), np.zeros(len(runs), dtype=bool)
        for t in range(length - 1, -1, -1):
            ratios[t] = np.where(started, (a10 + a11 * x) / (a00 + a01 * x), enter)
            x = np.where(real[t, runs], e[t, runs] * ratios[t], x)
            started |= real[t, runs]
        return ratios, x

    enter = np.ones(n)  # after the last word of a text both states weigh the same
    if follows:
        ends = np.flatnonzero(np.append(number[1:] == 0, True) & (number > 0))
        weight = np.ones(n)  # of the first word of a run with all that follows
        weight[ends] = backwards(ends, 1.0)[1]
        p = product(range(length - 1, -1, -1), a01, a10)
        for own in reversed(follows):
            enter[own - 1] = (a10 + a11 * weight[own]) / (a00 + a01 * weight[own])
            inner = own[number[own - 1] > 0] - 1
            weight[inner] = applied(p, inner, weight[inner + 1])
    backward, _ = backwards(np.arange(n), enter)
    out = np.empty(len(emission)), np.empty(len(emission))
    out[0][place[real]] = forward[real]
    out[1][place[real]] = backward[real]
    return out


def marginals(emission: np.ndarray, transition: np.ndarray, first: np.ndarray) -> np.ndarray:
    """P(toxic) of every word of the chains first[i]:first[i+1]."""
    forward, backward = passes(emission, transition, first)
    odds = forward * backward
    return odds / (1 + odds)


@dataclass
class Field:
    """Weights of trait buckets, transitions, and the logistic curve from marginals to a score."""

    weights: np.ndarray
    transition: np.ndarray
    curve: np.ndarray

    def words(self, texts: list[bytes]) -> tuple[Words, np.ndarray]:
        words, rows = traits(texts)
        return words, marginals(_emission(self.weights, rows), self.transition, words.first)

    def score(self, words: Words, p: np.ndarray) -> np.ndarray:
        z = np.clip(_summary(words.first, p) @ self.curve, -30, 30)
        return 1 / (1 + np.exp(-z))


def _sums(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def _summary(first: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Per text: constant, log weight of "some word is toxic", expected toxic words."""
    none = _sums(first, -np.log1p(-np.minimum(p, 1 - 1e-9)))
    return np.stack([np.ones(len(none)), np.log(np.expm1(np.minimum(none, 30)) + 1e-6), np.log1p(_sums(first, p))], axis=1)


def label_words(rows: np.ndarray, first: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """0 or 1 for every word: whether it is in a toxic text and has a trait tied to such texts.

    The tie is a likelihood-ratio test of document counts, at a level that few of all the traits
    reach by chance.
    """
    owner = np.repeat(np.arange(len(toxic)), np.diff(first))
    n1, n0 = max(toxic.sum(), 1), max(len(toxic) - toxic.sum(), 1)
    out = np.zeros(len(owner), dtype=bool)
    for row in rows:
        seen = np.unique(row.astype(np.int64) * len(toxic) + owner)
        bucket, text = seen // len(toxic), seen % len(toxic)
        size = (1 << BUCKET_BITS) + 1
        in1 = np.bincount(bucket, toxic[text], size)
        in0 = np.bincount(bucket, 1 - toxic[text], size)
        share = n1 / (n1 + n0)
        with np.errstate(divide="ignore", invalid="ignore"):
            total = in1 + in0
            gain = 2 * (
                np.where(in1 > 0, in1 * np.log(in1 / (total * share)), 0)
                + np.where(in0 > 0, in0 * np.log(in0 / (total * (1 - share))), 0)
            )
        level = 2 * np.log(max(len(np.unique(bucket)), 2)) + 6
        tied = (gain > level) & (in1 / n1 > 10 * in0 / n0)
        tied[0] = False
        out |= tied[row]
    return (out & (toxic[owner] > 0)).astype(float)


def fit_field(texts: list[bytes], toxic: np.ndarray) -> Field:
    """Maximise the likelihood of the word labels. Without both labels: a constant score."""
    weights = np.zeros((1 << BUCKET_BITS) + 1)
    transition = np.zeros((2, 2))
    share = (toxic.sum() + 0.5) / (len(toxic) + 1)
    curve = np.array([np.log(share / (1 - share)), 0.0, 0.0])
    if not len(toxic) or toxic.min() == toxic.max():
        if not len(toxic):
            curve[0] = 0.0
        return Field(weights, transition, curve)
    words, rows = traits(texts)
    first = words.first
    y = label_words(rows, first, toxic)
    used = np.unique(rows)
    rows = np.searchsorted(used, rows).astype(np.int32)
    w = np.full(len(used), -1.0)
    starts = np.zeros(len(y), dtype=bool)
    starts[first[:-1][np.diff(first) > 0]] = True
    before = np.where(starts, 0.0, np.concatenate([[0.0], y[:-1]]))
    observed = np.array([[np.sum((before == i) & (y == j)) for j in (0, 1)] for i in (0, 1)], dtype=float)
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros((2, 2)), np.zeros((2, 2))]
    for step in range(1, STEPS + 1):
        emission = _emission(w, rows)
        f, b = passes(emission, transition, first)
        p = f * b / (1 + f * b)
        slope = np.zeros(len(w))
        for row in rows:
            slope += np.bincount(row, y - p, len(w))
        slope -= RIDGE * len(y) * w
        x = np.exp(np.clip(emission, -30, 30)) * b
        r = np.where(starts, 0.0, np.concatenate([[0.0], f[:-1]]))
        a = np.exp(transition)
        cells = [[a[0, 0] * np.ones_like(x), a[0, 1] * x], [r * a[1, 0], r * a[1, 1] * x]]
        total = cells[0][0] + cells[0][1] + cells[1][0] + cells[1][1]
        expected = np.array([[np.sum(c / total) for c in row] for row in cells])
        for k, (value, g) in enumerate(((w, slope), (transition, observed - expected))):
            state[2 * k] = 0.9 * state[2 * k] + 0.1 * g
            state[2 * k + 1] = 0.99 * state[2 * k + 1] + 0.01 * g * g
            m, v = state[2 * k] / (1 - 0.9**step), state[2 * k + 1] / (1 - 0.99**step)
            value += RATE * m / (np.sqrt(v) + 1e-8)
    weights[used] = w
    field = Field(weights.astype(np.float32), transition, curve)
    features = _summary(first, marginals(_emission(w, rows), transition, first))
    for _ in range(25):  # Newton steps of a ridged logistic regression
        q = 1 / (1 + np.exp(-np.clip(features @ curve, -30, 30)))
        ridge = np.array([0.0, 1.0, 1.0])
        hessian = features.T @ (features * (q * (1 - q))[:, None]) + np.diag(ridge + 1e-6)
        curve = curve + np.linalg.solve(hessian, features.T @ (toxic - q) - ridge * curve)
    field.curve = curve
    return field


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic") -> Field:
    """Fit a field on whole labelled texts, at most SAMPLE_ROWS of them and SAMPLE_BYTES in all.

    Texts are taken in the order of a hash of their id, the first always and then up to the first that
    does not fit, so that long texts are not left out more often than others.
    """
    bounded_batches(docs.sparkSession)
    sample = sample_of(docs, labels, label, learn, SAMPLE_ROWS)
    by_hash = [F.xxhash64("doc_id"), "doc_id", "y"]
    sizes = sample.select("doc_id", "y", F.coalesce(F.length("text"), F.lit(0)).alias("bytes"))
    left, chosen = SAMPLE_BYTES, set()
    for row in sizes.orderBy(*by_hash).limit(SAMPLE_ROWS).collect():
        if chosen and row["bytes"] > left:
            break
        if row["doc_id"] not in chosen:
            left -= row["bytes"]
            chosen.add(row["doc_id"])
    ids = docs.sparkSession.createDataFrame([(i,) for i in sorted(chosen)], "chosen bigint")
    kept = sample.join(F.broadcast(ids), F.col("doc_id") == F.col("chosen")).dropDuplicates(["doc_id", "y"])
    rows = kept.select("y", "text", "doc_id").orderBy("doc_id", "y").collect()
    return fit_field([bytes(r["text"] or b"") for r in rows], np.array([r["y"] for r in rows], dtype=float))


_SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))


def tag(docs: DataFrame, field: Field, threshold: float = SPAN_THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` and ``spans``; columns of these names are replaced.

    ``spans`` are the runs of words with a marginal of at least ``threshold``, as code point offsets
    into the text, the end excluded. Null text scores as the empty one and has no spans.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    added = ["score", "predicted", "spans"]
    docs = docs.drop(*added)
    names = docs.columns
    place = names.index("text")
    model = spark.sparkContext.broadcast(field)

    def spans(text: bytes, begin: int, words: Words, p: np.ndarray, a: int, b: int) -> list[dict]:
        toxic = np.flatnonzero(p[a:b] >= threshold)
        if not len(toxic):
            return []
        points = np.concatenate([[0], np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)])
        out = []
        for run in np.split(toxic, np.flatnonzero(np.diff(toxic) > 1) + 1):
            start, end = words.start[a + run[0]] - begin, words.end[a + run[-1]] - begin
            out.append({"start": int(points[start]), "end": int(points[end])})
        return out

    def task(batches):
        for batch in batches:
            points, found = [], []
            for _, run in chunks(batch.column(place).cast(pa.binary()).to_pylist()):
                words, p = model.value.words(run)
                points.append(model.value.score(words, p))
                begin = 0
                for k, text in enumerate(run):
                    found.append(spans(text, begin, words, p, int(words.first[k]), int(words.first[k + 1])))
                    begin += len(text) + 1
            flat = np.concatenate(points) if points else np.empty(0)
            columns = [batch.column(k) for k in range(len(names))]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns += [pa.array(flat), pa.array((flat >= 0.5).astype(np.int32)), pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *added])

    new = [StructField("score", DoubleType()), StructField("predicted", IntegerType()), StructField("spans", _SPANS)]
    return docs.mapInArrow(task, StructType([*docs.schema.fields, *new]))
