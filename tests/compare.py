"""Run a query on Spark and its SQL on DuckDB and compare all rows.

``python tests/compare.py SF_DIR [name ..]`` checks the named queries, or all of them.
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None if both sides agree, else a description."""
    got_columns = spark_df.columns
    got = [tuple(r) for r in spark_df.collect()]
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} against {sorted(want_columns)}"
    a, b = _bag(got_columns, got), _bag(want_columns, want)
    if a == b:
        return None
    extra, missing = list((a - b).items())[:3], list((b - a).items())[:3]
    return f"{len(got)} rows against {len(want)}; only Spark {extra}; only SQL {missing}"


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from ledgerloom.queries import ORACLES, QUERIES
    from ledgerloom.session import local_session

    spark = local_session("8", spark__driver__memory="8g")
    con = connect(sf_dir)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problem = differences(df, con, ORACLES[name])
                rows = ""
            else:
                problem, rows = None, f" rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            problem, rows = f"{type(error).__name__}: {str(error).splitlines()[0][:500]}", ""
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok'} {name} {time.time() - start:.2f}s{rows} {problem or ''}", flush=True)
    print(f"{bad} failures")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
