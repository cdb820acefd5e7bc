"""Run registered queries next to their SQL twins and compare columns, types and rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "bigint", "HUGEINT": "hugeint", "DOUBLE": "double",
    "FLOAT": "float", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _normal(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_normal(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    kinds = {
        c: KINDS.get(str(t), str(t)) for c, t in zip(columns, [r[1] for r in con.execute("describe " + sql).fetchall()])
    }
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    types = dict(df.dtypes)
    wrong = {c: (types[c], kinds[c]) for c in columns if types[c] != kinds[c]}
    if wrong:
        return f"types (spark, sql) {wrong}"
    actual = [tuple(r) for r in df.collect()]
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    left, right = _rows(df.columns, actual), _rows(columns, expected)
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(bad)} rows differ, first {str(bad[0])[:600]}" if bad else None


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    from tamarind.duckdb_twins import ORACLE_SQL
    from tamarind.plans.registry import QUERIES
    from tamarind.session import build_session

    session = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    con = connect(sys.argv[1])
    for name in sys.argv[2:] or QUERIES:
        begin = time.time()
        if name not in ORACLE_SQL:
            print(f"{name:32s} no twin", flush=True)
            continue
        try:
            verdict = difference(QUERIES[name](session, sys.argv[1]), con, ORACLE_SQL[name]) or "ok"
        except Exception as error:  # noqa: BLE001 - report and go on
            verdict = f"FAILED {type(error).__name__}: {str(error)[:500]}"
        print(f"{name:32s} {time.time() - begin:6.2f}s {verdict}", flush=True)
