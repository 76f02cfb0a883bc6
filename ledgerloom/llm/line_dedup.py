"""Removing lines that several documents hold, by two Bloom filters.

Every document's distinct line keys are hashed once and stored. Per range of hashes a once-seen and
a twice-seen filter are built; only keys that the twice-seen filter admits are shuffled, counted
exactly and given to the smallest document that holds them.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerloom.llm.common import bounded_batches, stored, utf8
from ledgerloom.llm.filters import contains, seen_filters
from ledgerloom.session import new_path

MIN_KEY_CHARS = 10
FILTER_LOG2_BITS = 26  # 8 MB a filter
KEYS_PER_FILTER = 1 << 23  # beyond this many keys the hashes are dealt to several ranges
SPACE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def _code_points(data: bytes) -> int:
    return len(data) if data.isascii() else sum(b & 0xC0 != 0x80 for b in data)


def _document_keys(text: bytes | None, min_chars: int) -> set[bytes]:
    keys = {line_key(line) for line in set((text or b"").split(b"\n"))}
    return {k for k in keys if len(k) >= min_chars and _code_points(k) >= min_chars}


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _hash(key: bytes) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(key)
    return _signed(value >> 64), _signed(value & 0xFFFFFFFFFFFFFFFF)


_KEYS = pa.schema([("doc_id", pa.int64()), ("high", pa.int64()), ("low", pa.int64())])


def _keys(docs: DataFrame, min_chars: int) -> DataFrame:
    def task(batches):
        for batch in batches:
            ids, high, low = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for key in _document_keys(text, min_chars):
                    a, b = _hash(key)
                    ids.append(doc_id)
                    high.append(a)
                    low.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, high, low)], schema=_KEYS)

    known = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint"), utf8("text"))
    return known.mapInArrow(task, "doc_id bigint, high bigint, low bigint")


def repeated_keys(
    docs: DataFrame,
    min_chars: int = MIN_KEY_CHARS,
    log2_bits: int = FILTER_LOG2_BITS,
    keys_per_filter: int = KEYS_PER_FILTER,
) -> DataFrame:
    """(doc_id, high, low, keeper) for each key of a document that a smaller document holds too.

    The number of ranges follows the number of keys, so a filter's size and load stay the same at any
    size of the corpus; a range is read back from its own folder.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    keys = stored(_keys(docs, min_chars), "line-keys")
    total = keys.count()
    ranges = max(1, math.ceil(total / keys_per_filter))
    if ranges > 1:
        keys = stored(keys.withColumn("range", F.pmod("low", F.lit(ranges))), "line-ranges", "range")
    suspects = new_path(spark, "line-suspects")
    for k in range(ranges):
        part = keys.where(F.col("range") == k).drop("range") if ranges > 1 else keys
        twice = spark.sparkContext.broadcast(seen_filters(part.select("high"), log2_bits)[1])

        def probe(batches, twice=twice):
            for batch in batches:
                high = batch.column(1).to_numpy().view(np.uint64)
                yield batch.filter(pa.array(contains(twice.value, log2_bits, high)))

        # Written before the next range's filter is made: one filter is held at a time.
        part.mapInArrow(probe, part.schema).write.mode("append").parquet(suspects)
        twice.unpersist()
    suspects = spark.read.schema(keys.drop("range").schema).parquet(suspects)
    held = (
        suspects.groupBy("high", "low")
        .agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("__last"))
        .where(F.col("keeper") != F.col("__last"))
        .drop("__last")
    )
    # Stored, so that both sides of the join are shuffled for it and Spark can split a hot key.
    held = stored(held, "line-held")
    return suspects.join(held, ["high", "low"]).where(F.col("doc_id") != F.col("keeper"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_KEY_CHARS, **filter_sizes: int) -> DataFrame:
    """``docs`` with ``text`` less repeated lines, plus n_lines, n_dropped and kept_sha256.

    Lines are split at line feeds; a line's key is the line without white space at its ends and with
    A-Z lower-cased. A key of at least ``min_chars`` code points that two documents hold loses all
    its lines except in the smallest doc_id that holds it. Null text is one empty line and stays
    null; rows without doc_id lose nothing and cost no other row a line; rows with the same doc_id are
    one document. Other columns are kept, except ones named like the three added here, which are
    replaced.
    """
    added = ["n_lines", "n_dropped", "kept_sha256"]
    docs = docs.drop(*added)
    dropped = (
        repeated_keys(docs, min_chars, **filter_sizes)
        .groupBy(F.col("doc_id").alias("__doc"))
        .agg(F.collect_set(F.struct("high", "low")).alias("__dropped"))
    )
    joined = docs.join(dropped, docs["doc_id"] == F.col("__doc"), "left").drop("__doc")
    joined = joined.withColumns({"text": F.col("text").cast("binary")})
    schema = StructType(
        [*docs.schema.fields, StructField("n_lines", LongType()), StructField("n_dropped", LongType()), StructField("kept_sha256", StringType())]
    )
    names = docs.columns
    place = names.index("text")

    def task(batches):
        for batch in batches:
            gone = batch.column(len(names)).to_pylist()
            texts, lines, drops, digests = [], [], [], []
            for text, keys in zip(batch.column(place).to_pylist(), gone, strict=True):
                split = (text or b"").split(b"\n")
                if keys:
                    away = {(k["high"], k["low"]) for k in keys}
                    kept = [x for x in split if len(x) < min_chars or _hash(line_key(x)) not in away]
                else:
                    kept = split
                new = b"\n".join(kept)
                texts.append(None if text is None else new.decode())
                lines.append(len(split))
                drops.append(len(split) - len(kept))
                digests.append(hashlib.sha256(new).hexdigest())
            columns = [batch.column(k) for k in range(len(names))]
            columns[place] = pa.array(texts, pa.string())
            columns += [pa.array(lines, pa.int64()), pa.array(drops, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *added])

    return joined.mapInArrow(task, schema)
