"""Run registered queries beside their SQL in DuckDB and compare rows, names and values."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rowmill.queries import registry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dict):
        return str(sorted(value.items()))
    return f"{type(value).__name__}:{value}"


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, con, folder: str, name: str) -> str | None:
    """None if both sides give the same rows, else what differs."""
    fn, sql = registry()[name]
    df = fn(spark, folder)
    if sql is None:
        df.collect()
        return None
    result = con.sql(sql)
    if sorted(df.columns) != sorted(result.columns):
        return f"columns {sorted(df.columns)} != {sorted(result.columns)}"
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(result.columns, result.fetchall())
    if ours == theirs:
        return None
    return (f"{sum(ours.values())} rows against {sum(theirs.values())}; "
            f"only Spark {list((ours - theirs).items())[:2]}; "
            f"only SQL {list((theirs - ours).items())[:2]}")


if __name__ == "__main__":
    from rowmill.session import build_session

    folder, chosen = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, wrong = connect(folder), 0
    for name in chosen or registry():
        start = time.time()
        try:
            problem = difference(spark, con, folder, name)
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        wrong += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("wrong:", wrong)
