"""Bloom filters of bounded size, built by tasks and merged by segment.

A filter has ``2**log2_bits`` bits and two probes per hash. Its size is a parameter, so its
broadcast is bounded; fuller filters answer "perhaps" more often and never miss a member.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.words import mixed

SEGMENTS = 256
_SEGMENT_SCHEMA = "segment int, once binary, twice binary"
_ARROW = pa.schema([("segment", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])


def _places(hashes: np.ndarray, log2_bits: int) -> tuple[np.ndarray, np.ndarray]:
    shift = np.uint64(64 - log2_bits)
    a = mixed(hashes ^ np.uint64(0xA5A5A5A55A5A5A5A))
    return (a >> shift).astype(np.int64), (mixed(a) >> shift).astype(np.int64)


class _Bits:
    def __init__(self, log2_bits: int):
        self.log2_bits = log2_bits
        self.bits = np.zeros(1 << (log2_bits - 3), dtype=np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        for at in _places(hashes, self.log2_bits):
            np.bitwise_or.at(self.bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))


def contains(bits: np.ndarray, log2_bits: int, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the filter."""
    out = np.ones(len(hashes), dtype=bool)
    for at in _places(hashes, log2_bits):
        out &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return out


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by segment; one segment is held at a time."""
    current, once, twice = None, None, None

    def done():
        return pa.RecordBatch.from_arrays(
            [pa.array([current], pa.int32()), pa.array([once.tobytes()]), pa.array([twice.tobytes()])], schema=_ARROW
        )

    for batch in batches:
        for row in batch.to_pylist():
            new_once = np.frombuffer(zlib.decompress(row["once"]), dtype=np.uint8)
            new_twice = np.frombuffer(zlib.decompress(row["twice"]), dtype=np.uint8)
            if row["segment"] != current:
                if current is not None:
                    yield done()
                current, once, twice = row["segment"], new_once.copy(), new_twice.copy()
            else:
                twice |= new_twice | (once & new_once)
                once |= new_once
    if current is not None:
        yield done()


def seen_filters(hashes: DataFrame, log2_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The once-seen and the twice-seen filter of a one-column table of 64-bit hashes.

    Each task keeps both filters for its rows and sends the segments that are not empty; a bit that
    two tasks have seen once becomes twice-seen in the merge. What reaches the driver is the two
    merged filters, of fixed size.
    """
    name = hashes.columns[0]

    def task(batches):
        once, twice = _Bits(log2_bits), _Bits(log2_bits)
        for batch in batches:
            values = batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            unique, counts = np.unique(values, return_counts=True)
            again = (counts > 1) | contains(once.bits, log2_bits, unique)
            twice.add(unique[again])
            once.add(unique)
        parts = [], [], []
        for k, (a, b) in enumerate(
            zip(np.split(once.bits, SEGMENTS), np.split(twice.bits, SEGMENTS), strict=True)
        ):
            if a.any():
                parts[0].append(k)
                parts[1].append(zlib.compress(a.tobytes(), 1))
                parts[2].append(zlib.compress(b.tobytes(), 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts[0], pa.int32()), pa.array(parts[1], pa.binary()), pa.array(parts[2], pa.binary())],
            schema=_ARROW,
        )

    present = hashes.where(hashes[name].isNotNull())
    rows = (
        present.mapInArrow(task, _SEGMENT_SCHEMA)
        .repartition("segment")
        .sortWithinPartitions("segment")
        .mapInArrow(_merge, _SEGMENT_SCHEMA)
        .collect()
    )
    size = 1 << (log2_bits - 3)
    filters = np.zeros(size, dtype=np.uint8), np.zeros(size, dtype=np.uint8)
    step = size // SEGMENTS
    for row in rows:
        at = row["segment"] * step
        filters[0][at : at + step] = np.frombuffer(row["once"], dtype=np.uint8)
        filters[1][at : at + step] = np.frombuffer(row["twice"], dtype=np.uint8)
    return filters
