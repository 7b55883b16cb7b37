"""Compare registered queries with their check SQL: rows, columns and values."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


# Spark type of each SQL type that the checks use.
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir) -> str | None:
    """None if both sides agree, else what differs."""
    df = fn(spark, sf_dir)
    left_cols, left = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    right_cols, right = _rows(rel.columns, rel.fetchall())
    if left_cols != right_cols:
        return f"columns {left_cols} != {right_cols}"
    spark_types = dict(df.dtypes)
    sql_types = {c: TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    if spark_types != sql_types:
        return f"types {[(c, t, sql_types[c]) for c, t in spark_types.items() if t != sql_types[c]]}"
    if not left:
        return "no rows"
    if left != right:
        only_left = sorted(set(left) - set(right))[:3]
        only_right = sorted(set(right) - set(left))[:3]
        return f"{len(left)} rows vs {len(right)}; only here {only_left}; only in SQL {only_right}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as e
    from filelake.session import build_session

    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, fn in e.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            sql = e.oracle_sql().get(name)
            if sql is None:
                problem, note = None, f"rows only: {fn(spark, sf_dir).count()}"
            else:
                problem, note = compare(spark, con, name, fn, sql, sf_dir), ""
        except Exception as error:
            problem, note = f"{type(error).__name__}: {str(error)[:600]}", ""
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {name:24} {time.time() - start:6.1f}s {problem or note}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.path.insert(0, ".")
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
