"""Compare registered queries with their SQL twins (``python tests/oracle.py [name…]``)."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def cell(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(cell(v) for v in value) + "]"
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted("|".join(cell(r[i]) for i in order) for r in rows)


KINDS = {
    "long": "BIGINT", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
}


def compare(spark, con, name, query, sql, sf_dir):
    """None when equal, else a short description of the first difference."""
    df = query(spark, sf_dir)
    got_cols, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want_cols, want = canonical(list(kinds), cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    wrong = [
        (c, t, kinds[c]) for c, t in df.dtypes if KINDS.get(t, kinds[c]) != kinds[c]
    ]
    if wrong:
        return f"types {wrong}"
    if got != want:
        only_got, only_want = sorted(set(got) - set(want)), sorted(set(want) - set(got))
        return (
            f"{len(got)} rows vs {len(want)}; differing {len(only_got)}/{len(only_want)}\n"
            f"  columns {got_cols}\n  spark {only_got[:3]}\n  sql   {only_want[:3]}"
        )
    return f"EMPTY" if not got else None


def main(names, sf_dir="/root/testdata/sf0.01"):
    from sightline.session import local_session
    from __spark_entry__ import oracle_sql, queries

    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    todo, oracles, bad = queries(), oracle_sql(), 0
    for name, query in todo.items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, name, query, oracles[name], sf_dir)
            else:
                rows = query(spark, sf_dir).collect()
                problem = None if rows else "EMPTY"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        kind = "sql " if name in oracles else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.2f}s {name}"
              + (f"  {problem}" if problem else ""), flush=True)
        bad += problem is not None
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    folder = "/root/testdata/sf0.01"
    if args and args[0].startswith("sf"):
        folder = f"/root/testdata/{args.pop(0)}"
    sys.exit(1 if main(args, folder) else 0)
