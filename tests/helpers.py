import math
from pathlib import Path

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(v))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat())
    return (3, str(v))


def rows_of(df):
    cols = df.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in df.collect()), sorted(cols)


def duck(sf_dir, sql):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}/**' )" if p.is_dir()
                        else f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in cur.fetchall()), sorted(cols)
