"""Run registered queries on Spark and DuckDB and compare rows as multisets."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    return round(float(v), 6) if isinstance(v, (int, float)) else str(v) if not isinstance(v, str) else v


def as_multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def difference(spark_rows, con, statement: str) -> str | None:
    """None when both sides agree, else a short account of how they differ."""
    cursor = con.execute(statement)
    names, expected = [d[0] for d in cursor.description], cursor.fetchall()
    if sorted(names) != sorted(spark_rows.columns):
        return f"columns {sorted(spark_rows.columns)} against {sorted(names)}"
    got = as_multiset(spark_rows.columns, spark_rows.collect())
    want = as_multiset(names, expected)
    if got == want:
        return None
    return (f"{sum(got.values())} rows against {sum(want.values())}; "
            f"only Spark {list((got - want).items())[:3]}; only DuckDB {list((want - got).items())[:3]}")


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    session = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    con, statements = connect(sf_dir), entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in statements:
                verdict = difference(query(session, sf_dir), con, statements[name])
            else:
                verdict = f"no statement, {query(session, sf_dir).count()} rows"
        except Exception as error:
            verdict = " ".join(f"{type(error).__name__}: {error}"[:300].split())
        print(f"{'ok  ' if verdict is None else 'FAIL'} {name} {time.time() - start:.1f}s {verdict or ''}", flush=True)
    extra = set(statements) - set(entry.queries())
    print("statements without a query:", extra or "none")
