import math
from collections import Counter


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def rows_of(cols, rows):
    """Multiset of rows keyed by column name (column order independent)."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    rel = con.sql(sql)
    return rows_of(rel.columns, rel.fetchall()), rel.columns


def assert_same(df, con, sql):
    got = spark_rows(df)
    want, cols = duck_rows(con, sql)
    assert sorted(df.columns) == sorted(cols)
    missing = want - got
    extra = got - want
    assert not missing and not extra, f"missing={list(missing.items())[:3]} extra={list(extra.items())[:3]}"
