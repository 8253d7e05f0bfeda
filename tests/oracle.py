"""Spark rows against DuckDB's."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(sf_dir, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    out = con.execute(sql)
    names = [c[0] for c in out.description]
    return canonical(names, out.fetchall())


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    show = lambda v: "" if v is None else f"{v:.10g}" if isinstance(v, float) else str(v)
    return sorted(names), sorted(tuple(show(float(r[i]) if isinstance(r[i], int) and not isinstance(r[i], bool) else r[i]) for i in order) for r in rows)


def same(df, sf_dir, sql):
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    want = rows_of(sf_dir, sql)
    assert got[0] == want[0]
    assert got[1] == want[1]
