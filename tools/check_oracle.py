"""Run catalogue queries on Spark and their oracle SQL on DuckDB; compare.

usage: python tools/check_oracle.py [sf_dir] [name-substring ...]
"""

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from lodestar.plans import registry  # noqa: E402
from lodestar.session import checkpoint_dir, get_spark  # noqa: E402
from lodestar.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def rows_of(df_pd):
    cols = sorted(df_pd.columns)
    out = []
    for rec in df_pd[cols].itertuples(index=False):
        out.append(tuple(norm(x) for x in rec))
    return cols, sorted(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 and sys.argv[1].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in sys.argv[1:] if not a.startswith("/")]
    registry.load_all()
    spark = get_spark("local[8]", "check", shuffle_partitions=8, conf={"spark.driver.memory": "8g"})
    checkpoint_dir(spark)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    ok = bad = 0
    for name, fn in registry.QUERIES.items():
        if pats and not any(p in name for p in pats):
            continue
        sql = registry.ORACLES.get(name)
        t0 = time.time()
        try:
            sp = fn(spark, sf).toPandas()
        except Exception:
            print(f"[SPARK-ERR] {name}\n{traceback.format_exc()[-1500:]}")
            bad += 1
            continue
        ts = time.time() - t0
        if sql is None:
            print(f"[rows-only] {name}: {len(sp)} rows ({ts:.1f}s)")
            continue
        t1 = time.time()
        try:
            dk = con.execute(sql).df()
        except Exception as e:
            print(f"[SQL-ERR] {name}: {e}")
            bad += 1
            continue
        td = time.time() - t1
        c1, r1 = rows_of(sp)
        c2, r2 = rows_of(dk)
        if c1 != c2:
            print(f"[COLS] {name}: spark={c1} sql={c2}")
            bad += 1
        elif r1 != r2:
            diff1 = [r for r in r1 if r not in set(r2)][:3]
            diff2 = [r for r in r2 if r not in set(r1)][:3]
            print(f"[DIFF] {name}: rows {len(r1)} vs {len(r2)}; spark-only {diff1} sql-only {diff2}")
            bad += 1
        else:
            print(f"[ok] {name}: {len(r1)} rows (spark {ts:.1f}s, duckdb {td:.1f}s)")
            ok += 1
    print(f"ok={ok} bad={bad}")


if __name__ == "__main__":
    main()
