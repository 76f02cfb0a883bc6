"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are complete binary trees kept as flat arrays of features and thresholds; a batch of documents
walks all of them level by level in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ledgerloom.llm.common import bounded_batches, chunks, utf8
from ledgerloom.llm.words import Words, mixed, scan

SAMPLE_ROWS = 20_000  # labelled rows the trees are fitted on, at most
TREES, DEPTH, BINS, RATE, RIDGE = 60, 4, 64, 0.15, 1.0


def _class(characters: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(characters)] = 1
    return out


_ENDS = bytes(range(0x80, 0xC0))
_CLASSES = np.stack(
    [
        1 - _class(_ENDS),  # code points
        _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        _class(b"abcdefghijklmnopqrstuvwxyz"),
        _class(b"0123456789"),
        _class(b" \t\x0b\x0c\r"),
        _class(b"\n"),
        _class(b".,;:"),
        _class(b"!?"),
        _class(b"|/\\_=<>{}[]~^`+"),
        _class(b"#$%&*@"),
        _class(bytes(range(0xC0, 0x100))),
    ],
    axis=1,
)
FEATURES = [
    "log_chars", "log_words", "word_length", "upper", "lower", "digit", "space", "lines", "stops", "shouts", "bars",
    "signs", "other", "distinct_words", "top_word", "repeats", "distinct_pairs", "distinct_triples", "longest_line",
    "distinct_lines",
]


def _distinct(x: np.ndarray) -> float:
    return len(np.unique(x)) / len(x) if len(x) else 1.0


def _word_statistics(h: np.ndarray) -> list[float]:
    if not len(h):
        return [1.0, 0.0, 0.0, 1.0, 1.0]
    _, counts = np.unique(h, return_counts=True)
    pairs = mixed(h[:-1] * np.uint64(3) + h[1:])
    triples = mixed(h[:-2] * np.uint64(9) + h[1:-1] * np.uint64(3) + h[2:])
    return [
        len(counts) / len(h),
        counts.max() / len(h),
        float(np.mean(h[1:] == h[:-1])) if len(h) > 1 else 0.0,
        _distinct(pairs),
        _distinct(triples),
    ]


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of FEATURES per text."""
    out = np.zeros((len(texts), len(FEATURES)))
    for first, run in chunks(texts):
        words: Words = scan(run)
        for k, text in enumerate(run):
            counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256) @ _CLASSES
            h = words.hash[words.first[k] : words.first[k + 1]]
            n, w = max(counts[0], 1), max(len(h), 1)
            lines = text.split(b"\n")
            out[first + k] = [
                np.log1p(counts[0]), np.log1p(len(h)), (counts[0] - counts[4] - counts[5]) / w,
                *(counts[1:5] / n), counts[5] / w, *(counts[6:10] / w), counts[10] / n, *_word_statistics(h),
                np.log1p(max(map(len, lines))), len(set(lines)) / len(lines),
            ]
    return out


@dataclass
class Trees:
    """``feature`` and ``cut`` of inner node i of every tree, children 2i+1 and 2i+2; leaf values."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        n_trees, inner = self.feature.shape
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in range(n_trees):
            node = np.zeros(len(x), dtype=np.int64)
            while inner and node[0] < inner:  # all rows are on one level
                right = x[rows, self.feature[t, node]] > self.cut[t, node]
                node = 2 * node + 1 + right
            total += self.value[t, node - inner]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost trees on histograms of quantile bins. No rows, or one label only: a constant score."""
    inner = (1 << DEPTH) - 1
    rate = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate / (1 - rate))) if len(y) else 0.0
    feature = np.zeros((TREES, inner), dtype=np.int64)
    cut = np.full((TREES, inner), np.inf)
    value = np.zeros((TREES, inner + 1))
    if not len(y) or y.min() == y.max():
        return Trees(base, feature, cut, value)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1)
    margin = np.full(len(y), base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        gradient, curvature = y - p, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(DEPTH):
            width, first = 1 << level, (1 << level) - 1
            best = np.full(width, 1e-6)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                key = (node - first) * BINS + binned[:, f]
                g = np.bincount(key, gradient, width * BINS).reshape(width, BINS).cumsum(axis=1)
                c = np.bincount(key, curvature, width * BINS).reshape(width, BINS).cumsum(axis=1)
                whole = g[:, -1:] ** 2 / (c[:, -1:] + RIDGE)
                gain = g**2 / (c + RIDGE) + (g[:, -1:] - g) ** 2 / (c[:, -1:] - c + RIDGE) - whole
                gain = gain[:, : len(e)]
                at = gain.argmax(axis=1)
                better = gain[np.arange(width), at] > best
                best = np.where(better, gain[np.arange(width), at], best)
                own = first + np.flatnonzero(better)
                feature[t, own] = f
                cut[t, own] = e[at[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > cut[t, node])
        leaf = node - inner
        g = np.bincount(leaf, gradient, inner + 1)
        c = np.bincount(leaf, curvature, inner + 1)
        value[t] = RATE * g / (c + RIDGE)
        margin += value[t, leaf]
    return Trees(base, feature, cut, value)


def sample_of(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int) -> DataFrame:
    """(doc_id, text, y): at most ``rows`` labelled texts that ``learn`` admits, by a hash of the id.

    Only ids and labels are ordered, and at most ``rows`` of them are broadcast.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & learn)
    known = known.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("y")).distinct()
    chosen = known.orderBy(F.xxhash64("__id"), "__id", "y").limit(rows)
    texts = docs.select("doc_id", utf8("text"))
    return texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "y")


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", rows: int = SAMPLE_ROWS) -> Trees:
    """Fit the trees on a bounded sample of the labelled documents that ``learn`` admits."""
    bounded_batches(docs.sparkSession)

    def task(batches):
        for batch in batches:
            x = statistics([t or b"" for t in batch.column(1).to_pylist()])
            columns = [batch.column(0), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "y", "x"])

    sample = sample_of(docs, labels, label, learn, rows).mapInArrow(task, "doc_id bigint, y int, x array<double>")
    # Repeated documents can exceed the bound once more.
    found = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "y", "x").limit(rows).toArrow()
    x = np.array(found.column("x").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    return fit_trees(x, found.column("y").to_numpy().astype(float))


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``; columns of these names are replaced.

    Null text scores as the empty one. Rows are neither dropped nor shuffled.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.drop("score", "predicted")
    names = docs.columns
    place = names.index("text")
    model = spark.sparkContext.broadcast(trees)

    def task(batches):
        for batch in batches:
            texts = batch.column(place).cast(pa.binary()).to_pylist()
            points = model.value.score(statistics([t or b"" for t in texts])) if texts else np.empty(0)
            columns = [batch.column(k) for k in range(len(names))]
            columns += [pa.array(points), pa.array((points >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "score", "predicted"])

    schema = StructType([*docs.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return docs.mapInArrow(task, schema)
