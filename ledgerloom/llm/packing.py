"""Best-fit packing of documents into training sequences under conflicts.

Bins are kept ordered by what they have left and carry bitmaps of the sources and duplicate clusters
they hold. A piece goes to the first bin with enough room, and on to the next larger ones until one
has neither its source nor its cluster: the tightest compatible bin. Documents are dealt to
shards of a bounded size by hash, so hot sources and clusters spread over all shards.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import bounded_batches, chunks, stored, utf8
from ledgerloom.llm.words import scan

CAPACITY = 2048
SHARD_ROWS = 4096


def _bit(codes: np.ndarray) -> np.ndarray:
    """Codes of values that occur at least twice; the others can't conflict and get -1."""
    known, place, counts = np.unique(codes, return_inverse=True, return_counts=True)
    wanted = (counts > 1) & (known >= 0)
    number = np.where(wanted, np.cumsum(wanted) - 1, -1)
    return number[place]


class _Bins:
    """Open bins in the order of their residual, with one bitmap row per bin."""

    def __init__(self, most: int, bits: int):
        self.residual = np.empty(0, dtype=np.int64)  # ascending
        self.bin = np.empty(0, dtype=np.int64)
        self.bitmap = np.zeros((most, bits // 64 + 1), dtype=np.uint64)
        self.used = np.zeros(most, dtype=np.int64)
        self.count = 0

    def _compatible(self, bins: np.ndarray, bits: list[int]) -> np.ndarray:
        free = np.ones(len(bins), dtype=bool)
        for b in bits:
            free &= (self.bitmap[bins, b >> 6] >> np.uint64(b & 63)) & np.uint64(1) == 0
        return free

    def place(self, length: int, bits: list[int], capacity: int) -> tuple[int, int]:
        """Put a piece into its bin; gives the bin and the place in it."""
        at = int(np.searchsorted(self.residual, length))
        step = 16
        while at < len(self.bin):  # successors, in runs of growing length
            free = np.flatnonzero(self._compatible(self.bin[at : at + step], bits))
            if len(free):
                at += int(free[0])
                break
            at, step = at + step, step * 4
        if at >= len(self.bin):
            own, left = self.count, capacity
            self.count += 1
        else:
            own, left = int(self.bin[at]), int(self.residual[at])
            self.residual = np.delete(self.residual, at)
            self.bin = np.delete(self.bin, at)
        for b in bits:
            self.bitmap[own, b >> 6] |= np.uint64(1) << np.uint64(b & 63)
        start = capacity - left
        left -= length
        if left > 0:
            # Equal residuals: the older bin first.
            low, high = np.searchsorted(self.residual, left), np.searchsorted(self.residual, left, "right")
            to = int(low + np.searchsorted(self.bin[low:high], own))
            self.residual = np.insert(self.residual, to, left)
            self.bin = np.insert(self.bin, to, own)
        return own, start


def pack_shard(lengths: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and start of each piece, taken longest first; codes below 0 conflict with nothing."""
    order = np.argsort(-lengths, kind="stable")
    source_bits, cluster_bits = _bit(sources), _bit(clusters)
    n_sources = int(source_bits.max(initial=-1)) + 1
    bins = _Bins(len(lengths), n_sources + int(cluster_bits.max(initial=-1)) + 1)
    out, start = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    for k in order.tolist():
        bits = [int(source_bits[k])] if source_bits[k] >= 0 else []
        if cluster_bits[k] >= 0:
            bits.append(n_sources + int(cluster_bits[k]))
        out[k], start[k] = bins.place(int(lengths[k]), bits, capacity)
    return out, start


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, source, n_tokens, cluster): words plus an end mark, and a hash of the words.

    Texts equal up to white space and A-Z case have one cluster; texts without words have none.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("n_tokens", pa.int64()), ("cluster", pa.int64())])

    def task(batches):
        for batch in batches:
            sizes, clusters = [], []
            for _, run in chunks(batch.column(2).to_pylist()):
                words = scan(run)
                for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
                    sizes.append(b - a + 1)
                    own = xxhash.xxh3_64_intdigest(words.hash[a:b].tobytes()) >> 1
                    clusters.append(own if b > a else None)
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(clusters, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), utf8("text"))
    return texts.mapInArrow(task, "doc_id bigint, source string, n_tokens bigint, cluster bigint")


def _regrouped(sizes: DataFrame, groups: DataFrame) -> DataFrame:
    """``sizes`` with the component of each document as its cluster; texts without words keep none.

    Rows without id have the component of a copy with id, and else the cluster of their words.
    """
    own = groups.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    own = own.agg(F.min("component_id").cast("bigint").alias("component"))
    known = sizes.where(F.col("doc_id").isNotNull()).join(own, "doc_id", "left")
    known = stored(known, "pack-components")
    nameless = sizes.where(F.col("doc_id").isNull())
    copies = known.join(nameless.select("cluster").distinct(), "cluster", "left_semi")
    copies = copies.groupBy("cluster").agg(F.min("component").alias("component"))
    every = known.unionByName(nameless.join(copies, "cluster", "left").select(known.columns))
    # Components are ids; what has none gets a code that is no id of a document.
    code = F.coalesce(F.col("component"), -1 - F.col("cluster"))
    return every.withColumn("cluster", F.when(F.col("cluster").isNotNull(), code)).select(sizes.columns)


PACKED = "doc_id bigint, piece bigint, n_tokens bigint, bin_id string, start bigint"


def sizes_of(groups: DataFrame) -> DataFrame:
    """What ``pack`` needs, from ``similar_groups`` with the source kept: no text is read again.

    Rows without a component are clustered by their shingle set, texts without words not at all.
    """
    # Components are ids; what has none gets a code that is no id of a document.
    code = F.coalesce(F.col("component_id").cast("bigint"), -1 - F.shiftright(F.col("class"), 1).bitwiseAND((1 << 62) - 1))
    return groups.select(
        F.col("doc_id").cast("bigint"),
        F.col("source").cast("string"),
        (F.col("n_words") + 1).alias("n_tokens"),
        F.when(F.col("class").isNotNull(), code).alias("cluster"),
    )


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    shard_rows: int = SHARD_ROWS,
    groups: DataFrame | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """(doc_id, piece, n_tokens, bin_id, start): where every document goes.

    A document counts its words and an end mark, so an empty or null text takes one place. A
    longer one gives pieces of ``capacity`` tokens that fill bins of their own, and the rest is packed. No
    bin holds two documents of one source or of one duplicate cluster; a null source conflicts with
    nothing. Clusters are texts of equal words, or with ``groups`` (doc_id, component_id) the components given
    there; an id with several components has the smallest. Within a shard pieces go longest first, ties by doc_id. Repeated rows are packed as
    documents of their own (and, being duplicates, never together); null ids are kept. ``sizes`` (of
    ``sizes_of``) are used instead of the texts if they are known.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    sizes = stored(measured(docs) if sizes is None else sizes, "pack-sizes")
    if groups is not None:
        sizes = stored(_regrouped(sizes, groups), "pack-clusters")
    shards = max(1, math.ceil(sizes.count() / shard_rows))
    dealt = sizes.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "n_tokens", "source"), F.lit(shards)))
    if sizes.where(F.col("doc_id").isNull()).isEmpty():
        dealt = sizes.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "n_tokens", "cluster", "source"], kind="stable")
        total = rows["n_tokens"].to_numpy(dtype=np.int64)
        full = (total - 1) // capacity  # pieces that fill a bin; the rest is 1..capacity tokens
        sources = pd.factorize(rows["source"])[0]
        clusters = pd.factorize(rows["cluster"])[0]
        bins, start = pack_shard(total - full * capacity, sources, clusters, capacity)
        shard = str(int(rows["shard"].iloc[0]))
        last = pd.DataFrame({"doc_id": rows["doc_id"].to_numpy(), "piece": full, "n_tokens": total - full * capacity})
        last["bin_id"], last["start"] = [f"{shard}-{b}" for b in bins], start
        at = np.repeat(np.arange(len(rows)), full)
        first = np.cumsum(full) - full
        whole = pd.DataFrame({"doc_id": rows["doc_id"].to_numpy()[at], "piece": np.arange(len(at)) - first[at]})
        whole["n_tokens"], whole["start"] = capacity, 0
        whole["bin_id"] = [f"{shard}-full-{k}" for k in range(len(at))]
        out = pd.concat([last, whole], ignore_index=True)
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out[["doc_id", "piece", "n_tokens", "bin_id", "start"]]

    # By number: merged by size, the small rows of all shards would be few tasks.
    return dealt.repartition(shards, "shard").groupBy("shard").applyInPandas(one, PACKED)
