"""Compare every registered query with its SQL on the given tables: python -m tests.check_oracle.

Usage: check_oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, Decimal)):
        number = float(value)
        return None if math.isnan(number) else round(number, 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(normal(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is not None, str(v)) for v in row),
    )


def tables(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS FROM read_parquet('{path}')")
    return connection


def compare(spark, connection, name, sf_dir):
    """The difference between both sides, None if they agree, and the number of rows."""
    result = contract.queries()[name](spark, sf_dir)
    ours = rows_of(result.columns, result.collect())
    reply = connection.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in reply.description]
    theirs = rows_of(columns, reply.fetchall())
    if sorted(result.columns) != sorted(columns):
        return f"columns {sorted(result.columns)} / {sorted(columns)}", len(ours)
    if ours != theirs:
        extra = [row for row in ours if row not in set(theirs)][:3]
        lacking = [row for row in theirs if row not in set(ours)][:3]
        detail = f"{len(ours)} / {len(theirs)} rows; only ours {extra}; only theirs {lacking}"
        return detail, len(ours)
    return (None if ours else "empty result"), len(ours)


if __name__ == "__main__":
    from tests.conftest import make_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = make_session()
    database = tables(folder)
    bad = 0
    for key in sys.argv[2:] or list(contract.queries()):
        began = time.time()
        try:
            difference, _ = compare(session, database, key, folder)
        except Exception as error:  # report and go on with the next query
            difference = f"{type(error).__name__}: {str(error)[:600]}"
        bad += difference is not None
        print(f"{'ok ' if difference is None else 'BAD'} {key} {time.time() - began:.1f}s",
              difference or "", flush=True)
    print(f"{bad} differ")
