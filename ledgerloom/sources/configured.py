"""Sources and targets described by configuration records.

A record has ``container``, ``path``, ``format`` and ``format_options``; ``roots`` maps a container
to the URI it lives under.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def parse_records(text: str) -> list[dict]:
    records = json.loads(text) if text.strip() else []
    return records if isinstance(records, list) else [records]


def location(record: Mapping, roots: Mapping[str, str]) -> str:
    return f"{roots[record['container']].rstrip('/')}/{record['path'].lstrip('/')}"


def read_configured(spark: SparkSession, record: Mapping, roots: Mapping[str, str]) -> DataFrame:
    options = record.get("format_options") or {}
    return spark.read.format(record.get("format", "parquet")).options(**options).load(location(record, roots))


def write_configured(df: DataFrame, record: Mapping, roots: Mapping[str, str]) -> str:
    options = record.get("format_options") or {}
    target = location(record, roots)
    writer = df.write.format(record.get("format", "parquet")).options(**options)
    writer.mode(record.get("mode", "overwrite")).save(target)
    return target


def apply_settings(spark: SparkSession, settings: Mapping[str, str]) -> None:
    for key, value in settings.items():
        spark.conf.set(key, value)
