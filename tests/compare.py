"""Run registered queries next to their checking SQL and compare the results."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
         "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) if not isinstance(v, (list, dict)) else (False, "", str(v)) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark frame and the SQL result; empty when they agree."""
    out = []
    cols = sorted(df.columns)
    rel = con.sql(sql)
    if sorted(rel.columns) != cols:
        return [f"columns: spark {cols} sql {sorted(rel.columns)}"]
    spark_types = dict(df.dtypes)
    sql_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    for c in cols:
        if KINDS.get(spark_types[c], spark_types[c]) != sql_types[c]:
            out.append(f"type {c}: spark {spark_types[c]} sql {sql_types[c]}")
    names = [rel.columns.index(c) for c in cols]
    left = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)
    right = sorted((tuple(r[i] for i in names) for r in rel.fetchall()), key=_key)
    if len(left) != len(right):
        out.append(f"rows: spark {len(left)} sql {len(right)}; first spark {left[:2]} sql {right[:2]}")
        return out
    bad = [(a, b) for a, b in zip(left, right) if not all(_same(x, y) for x, y in zip(a, b))]
    if bad:
        a, b = bad[0]
        cells = [(c, x, y) for c, x, y in zip(cols, a, b) if not _same(x, y)]
        out.append(f"values: {len(bad)} of {len(left)} rows differ, first {cells[:4]} in {a[:4]}")
    return out


def main(argv: list[str]) -> None:
    import __spark_entry__ as entry
    from lendmill.session import build_session

    folder = argv[0]
    wanted = argv[1:]
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    checks = entry.oracle_sql()
    fails = 0
    for name, run in entry.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            problems = compare(df, con, checks[name]) if name in checks else []
            note = "" if name in checks else f" (no check, {df.count()} rows)"
        except Exception as error:  # report every query, also failing ones
            problems, note = [f"{type(error).__name__}: {str(error)[:900]}"], ""
        fails += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s{note}", *problems, sep="\n      " if problems else " ", flush=True)
    print("failures", fails)


if __name__ == "__main__":
    main(sys.argv[1:])
