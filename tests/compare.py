"""Side-by-side runs of a query in Spark and its SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is None, str(type(v)), v if v is not None else "") for v in r),
    )


def compare(spark, con, query, sql, sf_dir):
    """None when equal, else a text naming the first difference."""
    return difference(query(spark, sf_dir), con, sql)


def difference(df, con, sql):
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}; {mine[:2]} {theirs[:2]}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ {sorted(names)}\n  {bad[0][0]}\n  {bad[0][1]}"
    return None


def main():
    """python tests/compare.py SF-or-folder [name or prefix* ...] [spark.conf=value ...]"""
    import tempfile

    sys.path.insert(0, "/root/repo")
    from tillroll.plans import load
    from tillroll.session import build_session

    sf, only = sys.argv[1], [a for a in sys.argv[2:] if "=" not in a]
    extra = dict(a.split("=", 1) for a in sys.argv[2:] if "=" in a)
    sf_dir = sf if "/" in sf else f"/root/testdata/sf{sf}"
    spark = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-"), **extra},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = load()
    names = [n for n in queries if not only or any(n == o or (o.endswith("*") and n.startswith(o[:-1])) for o in only)]
    failed = []
    for name in names:
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, queries[name], oracles[name], sf_dir)
            else:
                n = len(queries[name](spark, sf_dir).collect())
                problem = None if n else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        kind = "sql " if name in oracles else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {name} {time.time() - start:.2f}s", flush=True)
        if problem:
            failed.append(name)
            print("    " + problem, flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} ok; failed: {failed}")
    spark.stop()


if __name__ == "__main__":
    main()
