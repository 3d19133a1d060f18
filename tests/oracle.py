"""Run queries next to their SQL and report differences.

    python -m tests.oracle [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _cell(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    return repr(value)


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def compare(spark, con, fn, sql, sf_dir):
    """None when equal, else a description of the difference."""
    df = fn(spark, sf_dir)
    got = as_rows(df.columns, [tuple(r) for r in df.collect()])
    if not got:
        return "no rows"
    if sql is None:
        return None
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    for c, t in df.dtypes:
        if _TYPES.get(t) != types[c]:
            return f"type of {c}: {t} != {types[c]}"
    want = as_rows(rel.columns, rel.fetchall())
    if got == want:
        return None
    extra, missing = set(got) - set(want), set(want) - set(got)
    show = [f"columns {sorted(df.columns)}", f"{len(got)} rows != {len(want)} rows, {len(extra)} only here, {len(missing)} only in SQL"]
    show += [f"  here {str(r)[:600]}" for r in sorted(extra)[:2]] + [f"  sql  {str(r)[:600]}" for r in sorted(missing)[:2]]
    return "\n".join(show)


def main():
    from pyspark.sql import SparkSession

    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--missing-only", action="store_true")
    args = parser.parse_args()
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{args.sf}"
    con, bad = connect(sf_dir), 0
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if args.names and not any(n in name for n in args.names):
            continue
        start = time.time()
        try:
            diff = compare(spark, con, fn, oracles.get(name), sf_dir)
        except Exception:
            diff = traceback.format_exc()[-1800:]
        bad += diff is not None
        note = "" if name in oracles else " (rows only)"
        print(f"{'ok  ' if diff is None else 'DIFF'} {time.time() - start:6.2f}s {name}{note}" + (f"\n{diff}" if diff else ""), flush=True)
    print(f"{bad} differ")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
