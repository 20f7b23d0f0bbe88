"""Run registered queries against their SQL and report differences.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
# DuckDB type names by Spark type name.
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def local_session(cores: str = "8") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("usagelens")
             .config("spark.sql.shuffle.partitions", cores)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if schema and rows agree, else what differs first."""
    got_types = {n: TYPES.get(t, t) for n, t in df.dtypes}
    answer = con.sql(sql)
    want_types = dict(zip(answer.columns, map(str, answer.types)))
    if got_types != want_types:
        both = {**got_types, **want_types}
        return "schema: " + str({c: (got_types.get(c), want_types.get(c)) for c in both
                                 if got_types.get(c) != want_types.get(c)})
    names = sorted(got_types)
    got = sorted((tuple(r[n] for n in names) for r in df.select(*names).collect()), key=_key)
    order = [answer.columns.index(n) for n in names]
    want = sorted((tuple(r[i] for i in order) for r in answer.fetchall()), key=_key)
    if len(got) != len(want):
        return f"rows: {len(got)} instead of {len(want)}"
    for a, b in zip(got, want):
        for name, x, y in zip(names, a, b):
            same = x == y or (isinstance(x, float) and isinstance(y, float)
                              and math.isnan(x) and math.isnan(y))
            if not same:
                return f"{name}: {x!r} instead of {y!r} in {dict(zip(names, a))}"
    return None


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.getcwd())
    from checks.oracle import ORACLE
    from checks.queries import QUERIES
    from usagelens.session import remove_staged

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con = local_session(), connect(sf_dir)
    failed = 0
    for name in names:
        started = time.time()
        try:
            problem = difference(QUERIES[name](spark, sf_dir), con, ORACLE[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - started:6.2f}s  {problem or 'ok'}", flush=True)
    remove_staged(spark)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
