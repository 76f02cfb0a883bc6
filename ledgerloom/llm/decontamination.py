"""Benchmark items inside documents: MinHash containment search, partitioned by item size.

An item's sketch is its smallest shingle hashes (a bottom-k MinHash). k depends on the size partition
of the item: with m shingles and a containment of t, an item has to leave at most m - ceil(t m) of
its shingles out, so of its k = m - ceil(t m) + 1 smallest hashes at least one occurs in every
document that contains it. Documents probe the sketches with all their shingles; the items met are
verified by exact shingle containment. Plain MinHash tables compare minima of both sides, which a
30-shingle item inside a document of 10,000 hardly ever shares; asking for the item's minima inside
the document keeps the search by MinHash and misses nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import bounded_batches, chunks, utf8
from ledgerloom.llm.words import SHINGLE_WORDS, scan, shingle_sets

PERCENT = 75
BLOCK_BYTES = 16 << 20


@dataclass
class Index:
    """Items of one block: sketch hashes in order with their items, and every item's shingles."""

    hashes: np.ndarray
    items: np.ndarray
    sets: list[np.ndarray]
    ids: list[int]
    need: np.ndarray


def needed(size: int, percent: int) -> int:
    return -(-percent * size // 100)


def build_index(ids: list[int], texts: list[bytes | None], percent: int) -> Index:
    """Partition the items by the power of two of their size and sketch each partition's items."""
    sets = []
    for _, run in chunks(texts):
        sets += shingle_sets(scan(run))
    by_size: dict[int, list[int]] = {}
    for k, s in enumerate(sets):
        if len(s):
            by_size.setdefault(int(math.log2(len(s))), []).append(k)
    hashes, items = [], []
    for members in by_size.values():
        for k in members:
            size = len(sets[k])
            sketch = sets[k][: size - needed(size, percent) + 1]  # sets are sorted: the smallest
            hashes.append(sketch)
            items.append(np.full(len(sketch), k))
    flat = np.concatenate(hashes) if hashes else np.empty(0, dtype=np.uint64)
    owner = np.concatenate(items) if items else np.empty(0, dtype=np.int64)
    order = np.argsort(flat, kind="stable")
    need = np.array([needed(len(s), percent) for s in sets], dtype=np.int64)
    return Index(flat[order], owner[order], sets, ids, need)


def search(index: Index, shingles: np.ndarray) -> list[tuple[int, int]]:
    """(item, shared shingles) of the items that the set contains to the given share."""
    left = np.searchsorted(index.hashes, shingles, "left")
    right = np.searchsorted(index.hashes, shingles, "right")
    met = left < right
    if not met.any():
        return []
    items = {int(k) for a, b in zip(left[met], right[met], strict=True) for k in index.items[a:b]}
    out = []
    for k in sorted(items):
        if index.need[k] <= len(shingles):
            shared = len(np.intersect1d(index.sets[k], shingles, assume_unique=True))
            if shared >= index.need[k]:
                out.append((k, shared))
    return out


_ARROW = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_item", pa.int64()), ("n_shared", pa.int64())])


def contaminated(
    docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) for each document that contains an item.

    A document contains an item if it has at least ``percent`` of the item's distinct five-word
    shingles; an item of fewer words is one shingle and is only met as a whole document of the same
    words. Items without words are contained nowhere, and rows with a null id or text take no part.
    Repeated rows give repeated results once: pairs are distinct. The benchmark is taken in blocks of
    about ``block_bytes`` of text, each broadcast as one index; documents are not shuffled.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    items = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    items = items.select(F.col("item_id").cast("bigint"), utf8("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    known = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint"), utf8("text"))
    result = None
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).orderBy("item_id").collect()
        index = spark.sparkContext.broadcast(build_index([r[0] for r in rows], [bytes(r[1]) for r in rows], percent))

        def task(batches, index=index):
            from ledgerloom.llm.words import rolled_shingles

            sketch = np.unique(index.value.hashes)
            for batch in batches:
                ids = batch.column(0).to_pylist()
                found = []
                for first, run in chunks(batch.column(1).to_pylist()):
                    words = scan(run)
                    rolled = rolled_shingles(words)
                    at = np.searchsorted(sketch, rolled)
                    at[at == len(sketch)] = 0
                    hit = sketch[at] == rolled if len(sketch) else np.zeros(len(rolled), dtype=bool)
                    where = np.flatnonzero(hit)
                    # Texts with a hit, and those too short to have a full shingle.
                    owners = set(np.unique(np.searchsorted(words.first, where, "right") - 1).tolist())
                    counts = np.diff(words.first)
                    owners |= set(np.flatnonzero((counts > 0) & (counts < SHINGLE_WORDS)).tolist())
                    for k in sorted(owners):
                        for item, shared in search(index.value, shingle_sets(words, only=k)[0]):
                            found.append((ids[first + k], index.value.ids[item], len(index.value.sets[item]), shared))
                columns = list(zip(*found, strict=True)) if found else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], schema=_ARROW)

        part = known.mapInArrow(task, "doc_id bigint, item_id bigint, n_item bigint, n_shared bigint")
        result = part if result is None else result.unionByName(part)
    # One row per pair even where ids repeat; only the few pairs found are shuffled.
    best = result.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_shared", "n_item")).alias("__best"))
    return best.select(
        "doc_id",
        "item_id",
        F.col("__best.n_item").alias("n_item"),
        F.col("__best.n_shared").alias("n_shared"),
        (F.col("__best.n_shared") / F.col("__best.n_item")).alias("containment"),
    )
