"""Run registered queries next to their SQL and compare the rows.

    python tests/compare.py [sf] [name-prefix ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canon(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(canon(v) for v in value) + "]"
    return str(value)


def spark_rows(df):
    names = sorted(df.columns)
    got = df.select(*[f"`{n}`" for n in names]).collect()
    return names, sorted("|".join(canon(v) for v in r) for r in got)


def duck_rows(con, sql):
    rel = con.execute(sql)
    cols = [c[0] for c in rel.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = rel.fetchall()
    return [cols[i] for i in order], sorted("|".join(canon(r[i]) for i in order) for r in rows)


def main(argv):
    from framelearn.plans import catalog
    from framelearn.session import get_spark

    sf = argv[0] if argv else "0.01"
    prefixes = argv[1:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_spark(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
                                  "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = []
    for name, fn in catalog.QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            cols, rows = spark_rows(fn(spark, sf_dir))
            t1 = time.time()
            if name in catalog.SQL:
                dcols, drows = duck_rows(con, catalog.SQL[name])
                ok = cols == dcols and rows == drows
                note = "OK" if ok else "MISMATCH"
                if not ok:
                    bad.append(name)
                    diff = [(a, b) for a, b in zip(rows, drows) if a != b][:2]
                    note += f" {cols} {dcols} {len(rows)} {len(drows)} {str(diff)[:600]}"
            else:
                note = f"rows only {str(rows[:1])[:200]}"
            print(f"{name:36s} {len(rows):8d} rows  spark {t1 - t0:6.2f}s sql {time.time() - t1:6.2f}s  {note}", flush=True)
        except Exception as e:  # report and go on with the next query
            bad.append(name)
            print(f"{name:36s} FAILED {type(e).__name__}: {str(e)[:900]}", flush=True)
        for rdd in spark.sparkContext._jsc.getPersistentRDDs().values():
            rdd.unpersist()
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    main(sys.argv[1:])
