"""Groups of spelling variants: words one edit apart, found by k-d trees over letter counts.

One edit changes the letter counts of a word by at most two: a replaced letter takes one from one
letter and gives one to another, an added letter gives one. Words of one length are therefore searched
for counts that differ by one up and one down, and words of the next length for one up; letter order
is verified on what is left. A small tree, fitted per length on a sample of words, deals the words to
leaves; a word goes as a query to every other leaf whose box it can reach. Each leaf builds a tree of
its own words in its task.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import bounded_batches, stored, utf8

MIN_LENGTH = 5
MIN_COUNT = 3
NOISE_MODULUS = 97
LEAF_WORDS = 1 << 13
SAMPLE_WORDS = 100_000  # bound of the words that the dealing trees are fitted on
SMALL_LEAF = 48
HELD_WORDS = 400_000
_QUERIES = 2048

# Words are handled as Latin-1: one byte is one code point. A-Z become a-z, what is no letter a space.
_FOLD = bytes(b if b >= 0xC0 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
_COLUMN = np.zeros(256, dtype=np.int64)
_COLUMN[_LETTERS] = np.arange(len(_LETTERS))


def noisy_runs(prefix: bytes, runs: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """(run, run without one letter) for the distinct runs that the noise rule changes in this document."""
    start = zlib.crc32(prefix)
    for run in runs:
        code = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if code % NOISE_MODULUS == 0:
            k = code % len(run)
            yield run, run[:k] + run[k + 1 :]


def counted_words(docs: DataFrame, noise: bool = False) -> DataFrame:
    """(word, n): the words of all whole texts, A-Z lower-cased, with how often they occur.

    ``noise`` deletes a letter from the runs that ``noisy_runs`` names, which gives texts misspellings.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def rows(held: Counter) -> pa.RecordBatch:
        long = [(w.decode("latin-1"), n) for w, n in held.items() if n and len(w) >= MIN_LENGTH]
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in long], schema.field(k).type) for k in (0, 1)], schema=schema)

    def task(batches):
        held = Counter()
        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                runs = text.decode("utf-8", "replace").encode("latin-1", "replace").translate(_FOLD).split()
                own = Counter(runs)
                held.update(runs)
                if noise:
                    for run, changed in noisy_runs(f"{doc_id}:".encode(), list(own)):
                        held[run] -= own[run]
                        held[changed] += own[run]
                if len(held) > HELD_WORDS:
                    yield rows(held)
                    held = Counter()
        yield rows(held)

    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")) if noise else F.lit("")
    texts = docs.select(name.alias("doc_id"), F.coalesce(utf8("text"), F.lit(b"")).alias("text"))
    return texts.mapInArrow(task, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") > 0)


def codes(words: list[str]) -> np.ndarray:
    """Words of one length as rows of Latin-1 codes."""
    if not words:
        return np.zeros((0, 1), dtype=np.uint8)
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)


def letter_counts(rows: np.ndarray) -> np.ndarray:
    """How often each letter is in each word; rows are words of one length."""
    n, width = rows.shape
    at = _COLUMN[rows] + (np.arange(n) * len(_LETTERS))[:, None]
    return np.bincount(at.ravel(), minlength=n * len(_LETTERS)).reshape(n, len(_LETTERS)).astype(np.int32)


@dataclass
class Node:
    """An inner node sends counts up to ``cut`` of a letter to ``low`` and others to ``high``."""

    column: int = -1
    cut: int = 0
    low: Node | None = None
    high: Node | None = None
    leaf: int = -1
    rows: np.ndarray | None = None  # of a leaf


def grown(points: np.ndarray, most: float) -> tuple[Node, int]:
    """A k-d tree whose leaves hold at most ``most`` points unless all points of a leaf are equal; its leaves."""
    leaves = 0

    def split(rows: np.ndarray) -> Node:
        nonlocal leaves
        own, best = points[rows], (0, -1, 0)
        if len(rows) > most:
            for cut in range(int(own.max()) if own.size else 0):
                low = (own <= cut).sum(axis=0)
                even = np.minimum(low, len(rows) - low)
                best = max(best, (int(even.max()), -int(even.argmax()), -cut))
                if best[0] * 3 >= len(rows):
                    break  # even enough
        if best[0] == 0:
            leaves += 1
            return Node(leaf=leaves - 1, rows=rows)
        column, cut = -best[1], -best[2]
        low = own[:, column] <= cut
        return Node(column, cut, split(rows[low]), split(rows[~low]))

    return split(np.arange(len(points))), leaves


def reached(tree: Node, points: np.ndarray, up: int, down: int) -> Iterator[tuple[Node, np.ndarray]]:
    """Leaves whose box is within ``up`` added and ``down`` taken letters of some points, with these points."""
    n = len(points)
    # low and high: the box so far; pruning follows how much each point lacks to be inside.
    stack = [(tree, np.arange(n), np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32), {}, {})]
    while stack:
        node, rows, ups, downs, low, high = stack.pop()
        if not len(rows):
            continue
        if node.low is None:
            yield node, rows
            continue
        x, c, cut = points[rows, node.column], node.column, node.cut
        more = downs + np.maximum(x - cut, 0) - np.maximum(x - high.get(c, 1 << 30), 0)
        keep = more <= down
        stack.append((node.low, rows[keep], ups[keep], more[keep], low, high | {c: cut}))
        more = ups + np.maximum(cut + 1 - x, 0) - np.maximum(low.get(c, 0) - x, 0)
        keep = more <= up
        stack.append((node.high, rows[keep], more[keep], downs[keep], low | {c: cut + 1}, high))


def _candidates(tree: Node, points: np.ndarray, queries: np.ndarray, longer: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, point) places whose counts are one up and one down, or one up, apart."""
    for first in range(0, len(queries), _QUERIES):
        some = queries[first : first + _QUERIES]
        for leaf, rows in reached(tree, some, 1, 0 if longer else 1):
            a, b = some[rows].astype(np.float64), points[leaf.rows].astype(np.float64)
            apart = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
            # Lengths are fixed, so squared distances 2 and 1 are these differences and no others.
            q, p = np.nonzero(apart == (1 if longer else 2))
            if len(q):
                yield rows[q] + first, leaf.rows[p]


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_added(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether each long word is the short one with one letter more."""
    head = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= short.shape[1]


def near_pairs(words: list[str], queries: list[str], longer: bool, own: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Places (query, word) of words one edit apart, all ``words`` of one length and all ``queries`` too.

    ``own``: queries are the words themselves, and each pair comes once.
    """
    none = np.zeros(0, dtype=np.int64)
    if not words or not queries:
        return none, none
    index, asked = codes(words), codes(queries)
    points, places = letter_counts(index), letter_counts(asked)
    tree, _ = grown(points, SMALL_LEAF)
    used = np.flatnonzero(points.any(axis=0) | places.any(axis=0))
    column = {int(c): k for k, c in enumerate(used)}

    def narrowed(node: Node) -> Node:
        if node.low is None:
            return node
        return Node(column[node.column], node.cut, narrowed(node.low), narrowed(node.high))

    found = [(none, none)]
    for q, w in _candidates(narrowed(tree), points[:, used], places[:, used], longer):
        if own:
            q, w = q[q < w], w[q < w]
        near = one_added(asked[q], index[w]) if longer else one_replaced(asked[q], index[w])
        found.append((q[near], w[near]))
    return np.concatenate([q for q, _ in found]), np.concatenate([w for _, w in found])


def dealing_trees(words: DataFrame, leaf_words: int = LEAF_WORDS, sample_words: int = SAMPLE_WORDS) -> dict[int, tuple[Node, int]]:
    """A tree for each length, fitted on about ``sample_words`` words at most, so that leaves hold about ``leaf_words``."""
    sizes = {r.length: r.n for r in words.groupBy("length").agg(F.count("*").alias("n")).collect()}
    large = [k for k, n in sizes.items() if n > leaf_words]
    share = max(1, math.ceil(sum(sizes[k] for k in large) / sample_words))
    some = words.where(F.col("length").isin(large) & (F.pmod(F.xxhash64("word"), F.lit(share)) == 0))
    sample = {k: [] for k in large}
    for r in some.select("word", "length").collect():
        sample[r.length].append(r.word)
    trees = {k: (Node(leaf=0), 1) for k in sizes}
    for k in large:
        points = letter_counts(codes(sorted(sample[k]))) if sample[k] else np.zeros((0, len(_LETTERS)), dtype=np.int32)
        tree, leaves = grown(points, max(leaf_words * len(points) / sizes[k], 1))
        trees[k] = (_without_rows(tree), leaves)
    return trees


def _without_rows(node: Node) -> Node:
    if node.low is None:
        return Node(leaf=node.leaf)
    return Node(node.column, node.cut, _without_rows(node.low), _without_rows(node.high))


INDEX, SAME, LONGER = 0, 1, 2
DEALT = "length int, leaf int, role int, word string, n bigint"


def dealt(words: DataFrame, trees: dict[int, tuple[Node, int]]) -> DataFrame:
    """Every word in the leaf that indexes it, and in all leaves that it asks, as rows of DEALT."""
    schema = pa.schema([("length", pa.int32()), ("leaf", pa.int32()), ("role", pa.int32()), ("word", pa.string()), ("n", pa.int64())])

    def task(batches):
        for batch in batches:
            rows = batch.to_pandas()
            for length, own in rows.groupby("length"):
                length = int(length)
                points = letter_counts(codes(own["word"].tolist()))
                home = np.zeros(len(own), dtype=np.int64)
                places = []
                for leaf, at in reached(trees[length][0], points, 0, 0):
                    home[at] = leaf.leaf
                    places.append((length, leaf.leaf, INDEX, at))
                for leaf, at in reached(trees[length][0], points, 1, 1):
                    places.append((length, leaf.leaf, SAME, at[home[at] < leaf.leaf]))
                if length + 1 in trees:
                    places += [(length + 1, leaf.leaf, LONGER, at) for leaf, at in reached(trees[length + 1][0], points, 1, 0)]
                word, n = own["word"].to_numpy(), own["n"].to_numpy()
                for tree, leaf, role, at in places:
                    if len(at):
                        same = [pa.array(np.full(len(at), x, dtype=np.int32)) for x in (tree, leaf, role)]
                        columns = [*same, pa.array(word[at], pa.string()), pa.array(n[at], pa.int64())]
                        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return words.select("word", "n", "length").mapInArrow(task, DEALT)


def links(words: DataFrame, leaf_words: int = LEAF_WORDS, sample_words: int = SAMPLE_WORDS) -> DataFrame:
    """(a, na, b, nb): every pair of ``words`` (word, n, length) that one edit separates, once."""
    trees = dealing_trees(words, leaf_words, sample_words)
    leaves = sum(n for _, n in trees.values())

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        kinds = {k: rows[rows["role"] == k] for k in (INDEX, SAME, LONGER)}
        index, out = kinds[INDEX], []
        for role, asked in kinds.items():
            q, w = near_pairs(index["word"].tolist(), asked["word"].tolist(), role == LONGER, role == INDEX)
            a, b = asked.iloc[q], index.iloc[w]
            out.append(pd.DataFrame({"a": a["word"].to_numpy(), "na": a["n"].to_numpy(), "b": b["word"].to_numpy(), "nb": b["n"].to_numpy()}))
        return pd.concat(out, ignore_index=True)

    shared = dealt(words, trees).repartition(min(max(leaves, 1), 4096), "length", "leaf")
    return shared.groupBy("length", "leaf").applyInPandas(one, "a string, na bigint, b string, nb bigint")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms of ``forms`` (word, form) end; each round doubles the steps taken."""
    chains = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = chains.select(F.col("word").alias("root"), F.col("root").alias("far"))
        chains = stored(chains.select("word", "root").join(ahead, "root", "left"), "spelling-roots")
        if chains.where(F.col("far").isNotNull()).isEmpty():
            return chains.select("word", "root")
        chains = chains.select("word", F.coalesce("far", "root").alias("root"))


def variants(words: DataFrame, leaf_words: int = LEAF_WORDS, sample_words: int = SAMPLE_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for distinct words (word, n).

    ``form`` is the near word of largest n, ties the smallest by code points, if that is at least
    twice the word's own; ``root`` is where following forms ends. Words have letters of Latin-1 only.
    An empty table gives no rows.
    """
    bounded_batches(words.sparkSession, 50_000)
    words = stored(words.select("word", "n", F.length("word").alias("length")), "spelling-words")
    both = links(words, leaf_words, sample_words)
    ways = [F.struct(F.col(a).alias("word"), F.col(b).alias("other"), F.col(n).alias("m")) for a, b, n in (("a", "b", "nb"), ("b", "a", "na"))]
    near = both.select(F.inline(F.array(*ways))).groupBy("word")
    near = near.agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    joined = words.select("word", "n").join(near, "word", "left")
    formed = -F.col("best.m") >= 2 * F.col("n")
    joined = joined.select(
        "word",
        F.when(formed, F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(formed, -F.col("best.m")).alias("form_n"),
    )
    joined = stored(joined, "spelling-forms")
    ends = roots(joined.where(F.col("form").isNotNull()))
    joined = joined.join(ends, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, noise: bool = False) -> DataFrame:
    """Variants of the words of ``docs``: at least five letters and three occurrences overall.

    Null texts have no words, a null id counts as empty in the noise rule, repeated rows count each
    time, and other columns are not read. What ``variants`` returns.
    """
    bounded_batches(docs.sparkSession)
    words = stored(counted_words(docs, noise).where(F.col("n") >= MIN_COUNT), "spelling-counts")
    return variants(words)
