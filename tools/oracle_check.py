"""Compare registered Spark queries with their oracle SQL (DuckDB).

Usage: python tools/oracle_check.py [SF_DIR] [name-prefix ...]

Rows are compared as multisets after sorting columns by name; values are
normalised (dates/timestamps to ISO text, decimals to float, sequences to
tuples).  Prints one line per query and a summary.
"""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from tessera.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return tuple(norm(x) for x in v)
    return v


def kind(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int):
        return "int"
    if isinstance(v, float):
        return "float"
    return type(v).__name__


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    kinds = {}
    for r in out:
        for c, v in zip(cols, r):
            k = kind(v)
            if k is not None:
                kinds.setdefault(c, k)
    return cols, out, kinds


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
                 "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
                 "timestamp": "TIMESTAMP WITH TIME ZONE"}


def spark_type(dt_) -> str:
    s = dt_.simpleString()
    if s.startswith("array<"):
        return spark_type(dt_.elementType) + "[]"
    if s.startswith("decimal"):
        return s.upper()
    return SPARK_TO_DUCK.get(s, s)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, q, sf_dir, show=5):
    t0 = time.time()
    df = q.fn(spark, sf_dir)
    s_rows = df.collect()
    s_names = df.columns
    t1 = time.time()
    if q.sql is None:
        return "NOSQL", f"{len(s_rows)} rows", t1 - t0
    res = con.execute(q.sql)
    d_names = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sr, sk = canon(s_names, s_rows)
    dc, dr, dk = canon(d_names, d_rows)
    if sc != dc:
        return "SCHEMA", f"spark={sc} duck={dc}", t1 - t0
    if len(sr) != len(dr):
        return "COUNT", f"spark={len(sr)} duck={len(dr)}", t1 - t0
    s_types = {f.name: spark_type(f.dataType) for f in df.schema.fields}
    d_types = {d[0]: str(d[1]) for d in res.description}
    kinds_bad = {c: (s_types[c], d_types[c]) for c in sc if s_types[c] != d_types[c]}
    cs, cd = collections.Counter(sr), collections.Counter(dr)
    if cs != cd:
        only_s = list((cs - cd).elements())[:show]
        only_d = list((cd - cs).elements())[:show]
        return "VALUES", f"cols={sc}\n  spark-only={only_s}\n  duck-only={only_d}", t1 - t0
    if kinds_bad:
        return "TYPES", f"{kinds_bad}", t1 - t0
    return "OK", f"{len(sr)} rows", t1 - t0


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and "/" in argv[1] else "/root/testdata/sf0.01"
    prefixes = [a for a in argv[1:] if "/" not in a]
    from tessera.queries import load_all
    from tessera.session import get_spark
    spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    reg = load_all()
    stats = collections.Counter()
    for name, q in sorted(reg.items()):
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        try:
            status, info, secs = compare(spark, con, q, sf_dir)
        except Exception as exc:  # report and go on
            status, info, secs = "ERROR", repr(exc)[:600], 0.0
        stats[status] += 1
        print(f"{status:7s} {name:32s} {secs:6.2f}s {info}", flush=True)
    print("SUMMARY", dict(stats))


if __name__ == "__main__":
    main(sys.argv)
