"""Compare registered queries with their SQL twins: ``check_oracle.py [folder] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from ledgerloom.plans import QUERIES  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402


def canonical(value):
    """One representation per value, so that only real differences count."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return ("float", repr(value + 0.0))
    if isinstance(value, datetime.datetime):
        return ("time", value.isoformat())
    if isinstance(value, datetime.date):
        return ("date", value.isoformat())
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(canonical(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def open_oracle(folder: str):
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def compare(spark, connection, folder: str, name: str) -> tuple[str, str]:
    query = QUERIES[name]
    frame = query.run(spark, folder)
    spark_columns, spark_rows = rows_of(frame.columns, frame.collect())
    if query.sql is None:
        return "rows", f"{len(spark_rows)} rows"
    cursor = connection.execute(query.sql)
    names = [d[0] for d in cursor.description]
    oracle_columns, oracle_rows = rows_of(names, cursor.fetchall())
    if spark_columns != oracle_columns:
        return "COLUMNS", f"{spark_columns} / {oracle_columns}"
    if spark_rows != oracle_rows:
        only_spark = [r for r in spark_rows if r not in set(oracle_rows)][:3]
        only_oracle = [r for r in oracle_rows if r not in set(spark_rows)][:3]
        return "DIFFER", f"{len(spark_rows)}/{len(oracle_rows)}\n  {spark_columns}\n  spark  {only_spark}\n  oracle {only_oracle}"
    return "ok", f"{len(spark_rows)} rows"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = open_oracle(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            status, note = compare(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            status, note = "ERROR", "".join(traceback.format_exception_only(error))[:1500]
        bad += status not in ("ok", "rows")
        print(f"{status:8} {name:32} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
