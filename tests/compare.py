"""Compare registered queries with their DuckDB SQL: ``python tests/compare.py [sf_dir] [query ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if value is None:
        return "\0"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return f"{type(value).__name__}:{value}"


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark, con, sf_dir, fn, sql):
    """None if both sides agree on columns and rows, else a short description."""
    df = fn(spark, sf_dir)
    left_names, left = _rows(df.columns, df.collect())
    result = con.execute(sql)
    right_names, right = _rows([c[0] for c in result.description], result.fetchall())
    if left_names != right_names:
        return f"columns differ: {left_names} / {right_names}"
    if left != right:
        only_left = sorted(set(left) - set(right))[:2]
        only_right = sorted(set(right) - set(left))[:2]
        return f"{len(left)} / {len(right)} rows over {left_names}\n  spark  {only_left}\n  duckdb {only_right}"
    return None if left else "no rows on either side"


def main():
    from perkline.catalogue.oracle import ORACLE
    from perkline.catalogue.queries import QUERIES
    from perkline.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in chosen:
        start = time.time()
        if name not in ORACLE:
            print(f"{name:40s} no SQL")
            continue
        try:
            found = difference(spark, con, sf_dir, QUERIES[name], ORACLE[name])
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:700]}"
        bad += found is not None
        print(f"{name:40s} {time.time() - start:6.2f}s {'ok' if found is None else found}", flush=True)
    print(f"{bad} of {len(chosen)} differ; without query: {sorted(set(ORACLE) - set(QUERIES))}")


if __name__ == "__main__":
    main()
