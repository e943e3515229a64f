"""Side-by-side run of registered queries and their SQL.

``python tests/compare.py [sf] [names...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

import duckdb
import pyarrow.parquet as pq  # noqa: F401  (keeps parquet support loaded)

ROOT = Path(__file__).resolve().parent.parent
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in data), key=repr)


def difference(got_columns, got, want_columns, want) -> str | None:
    """First difference of two results as text, or None."""
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} / {sorted(want_columns)}"
    a, b = rows(got_columns, got), rows(want_columns, want)
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    for x, y in zip(a, b):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            return f"{sorted(got_columns)}: {x} / {y}"
    return None


SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def type_difference(df, description) -> str | None:
    """Columns whose types differ between the engines, or None."""
    want = {d[0]: str(d[1]) for d in description}
    bad = [(n, t, want[n]) for n, t in df.dtypes if SPARK_TYPES.get(t, t) != want[n]]
    return f"types {bad}" if bad else None


def main() -> None:
    sys.path.insert(0, str(ROOT))
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="compare-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, oracles = contract.queries(), contract.oracle_sql()
    names = sys.argv[2:] or list(queries)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            got = [tuple(r) for r in df.collect()]
            spent = time.time() - start
            if name in oracles:
                result = con.execute(oracles[name])
                columns = [d[0] for d in result.description]
                diff = difference(df.columns, got, columns, result.fetchall())
                diff = diff or type_difference(df, result.description)
            else:
                diff = None
        except Exception as exc:  # noqa: BLE001
            diff, got, spent = str(exc)[:400], [], time.time() - start
        bad += diff is not None
        mark = "ok" if diff is None else "DIFF"
        print(f"{mark:5}{name:22}{len(got):8} rows {spent:6.2f} s {diff or ''}"[:900], flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
