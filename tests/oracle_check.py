"""Run queries beside their SQL in DuckDB: python tests/oracle_check.py [name part ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def table_of(cols, rows):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in idx], sorted(tuple(norm(r[i]) for i in idx) for r in rows)


def kinds(pairs):
    alias = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double",
             "FLOAT": "float", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp", "DATE": "date",
             "timestamp_ntz": "timestamp", "HUGEINT": "hugeint"}
    return {n: alias.get(str(t), str(t)) for n, t in pairs}


def compare(spark, con, sf, fn, sql) -> str | None:
    df = fn(spark, sf)
    got_cols, got = table_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want_cols, want = table_of(cols, cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    k1 = kinds((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    k2 = kinds((d[0], d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall())
    types = {c: (k1[c], k2[c]) for c in k1 if k1[c] != k2[c]}
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        return (f"rows {len(got)} vs {len(want)}; {len(a)} only here {sorted(a)[:3]}; "
                f"{len(b)} only in SQL {sorted(b)[:3]}; cols {got_cols}; types {types}")
    if types:
        return f"types {types}"
    if not got:
        return "EMPTY on both sides"
    return None


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from voxledger.session import build_session

    sf = "/root/testdata/sf0.01"
    if argv and argv[0].startswith("sf"):
        sf = f"/root/testdata/{argv.pop(0)}"
    spark = build_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf), oracle_sql(), 0
    for name, fn in queries().items():
        if argv and not any(name.startswith(a) or a == name for a in argv):
            continue
        t = time.time()
        try:
            if name in sqls:
                msg = compare(spark, con, sf, fn, sqls[name])
                tag = "ok" if msg is None else "BAD"
            else:
                df = fn(spark, sf)
                df.write.format("noop").mode("overwrite").save()  # a count would leave columns out
                n = df.count()
                msg, tag = (None if n else "no rows"), f"rows {n}"
        except Exception as e:  # noqa: BLE001
            msg, tag = f"{type(e).__name__}: {str(e)[:1500]}", "ERR"
        bad += msg is not None
        print(f"{tag:6} {time.time() - t:6.2f}s {name} {msg or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
