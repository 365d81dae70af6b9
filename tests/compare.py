"""Run queries and their SQL answers side by side and compare the rows."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(r[i] for i in order) for r in rows], key=repr), [columns[i] for i in order]


def differences(df, con, sql: str) -> str | None:
    """None when names and rows agree, else what differs."""
    result = con.execute(sql)
    want, want_cols = _rows([d[0] for d in result.description], result.fetchall())
    got, got_cols = _rows(df.columns, [tuple(r) for r in df.collect()])
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        missing = [r for r in want if r not in set(got)][:3]
        return f"rows {len(got)} vs {len(want)}\n  only Spark: {extra}\n  only SQL: {missing}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    import __spark_entry__ as spec
    from conftest import make_session

    sf_dir = f"/root/testdata/{sys.argv[1]}"
    spark, con = make_session(), connect(sf_dir)
    chosen = sys.argv[2:] or list(spec.queries())
    bad = []
    for name in chosen:
        start = time.time()
        try:
            df = spec.queries()[name](spark, sf_dir)
            diff = differences(df, con, spec.oracle_sql()[name])
        except Exception as e:  # report and go on
            diff = f"{type(e).__name__}: {str(e)[:700]}"
        print(f"{name}: {'ok' if diff is None else 'DIFF ' + diff} ({time.time() - start:.1f}s)", flush=True)
        if diff:
            bad.append(name)
    print(f"{len(chosen) - len(bad)} of {len(chosen)} agree; differing: {bad}")
