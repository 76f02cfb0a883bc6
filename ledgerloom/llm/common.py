"""What the operators of this package share: stored stages, bounded Arrow batches, byte columns."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import new_path

BATCH_ROWS = 500
CHUNK_BYTES = 4 << 20


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Send at most ``rows`` rows at once to Python, so that long texts do not fill its memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    What follows starts from files, so neither a lost executor nor a second reader repeats the work
    before this point.
    """
    path = new_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(name: str) -> Column:
    """A text column as its UTF-8 bytes; null stays null."""
    return F.col(name).cast("binary").alias(name)


def in_training(doc_id: Column, modulus: int, held_out: int) -> Column:
    """Whether a row may be learned from: crc32 of the id as text, never for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus != held_out, F.lit(False))


def is_held_out(doc_id: Column, modulus: int, held_out: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == held_out, F.lit(False))


def chunks(values: Iterable[bytes | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive runs of texts of about ``limit`` bytes in all, with the place of their first.

    A text is never cut: a longer one is a run of its own. Null counts as empty.
    """
    first, run, size = 0, [], 0
    for place, value in enumerate(values):
        value = value or b""
        if run and size + len(value) > limit:
            yield first, run
            first, run, size = place, [], 0
        run.append(value)
        size += len(value)
    if run:
        yield first, run


def stable_hash(text: str) -> int:
    """A small stable hash for names; not for data."""
    return zlib.crc32(text.encode())


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
