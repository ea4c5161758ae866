"""Compare registered queries with their SQL on the same Parquet tables.

Run ``python tests/oracle.py --sf 0.01 [name ...]`` to check and time queries.
"""

from __future__ import annotations

import argparse
import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lodestone import plans  # noqa: E402
from lodestone.session import TABLE_NAMES, build_session  # noqa: E402

DATA = "/root/testdata/sf{}"


def plain(value):
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return repr(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def sql_rows(sql, folder):
    with duckdb.connect() as db:
        for name in TABLE_NAMES:
            db.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
        cursor = db.execute(sql)
        return normal([d[0] for d in cursor.description], cursor.fetchall())


def spark_rows(spark, name, folder):
    df = plans.QUERIES[name](spark, folder)
    return normal(df.columns, [tuple(r) for r in df.collect()])


def difference(spark, name, folder):
    """None when both sides agree, else a short description."""
    got_columns, got = spark_rows(spark, name, folder)
    if name not in plans.ORACLES:
        return None if got else "no rows"
    want_columns, want = sql_rows(plans.ORACLES[name], folder)
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got == want:
        return None if got else "no rows on both sides"
    only_got = sorted(set(got) - set(want))[:3]
    only_want = sorted(set(want) - set(got))[:3]
    return f"rows {len(got)} / {len(want)}; only here {only_got}; only SQL {only_want}"


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--sliced", action="store_true")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"), "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-")}
    if args.sliced:
        conf["spark.lodestone.maxGroupRows"] = "0"
    spark = build_session("oracle", "local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    folder = DATA.format(args.sf)
    names = [n for n in plans.QUERIES if not args.names or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in args.names)]
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, name, folder)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += problem is not None
        kind = "sql " if name in plans.ORACLES else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
