"""Run registered queries beside their oracle SQL and compare names, rows and values.

    python tests/compare.py /root/testdata/sf0.01 [name-part ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.plans.trucking import GIVEN  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or value != value:
        return None
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


def _order(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    names = sorted(df.columns)
    ours = [tuple(_cell(v) for v in row) for row in df.select(*names).collect()]
    cur = con.execute(sql)
    theirs_names = [d[0] for d in cur.description]
    if sorted(theirs_names) != names:
        return f"columns {names} vs {sorted(theirs_names)}"
    place = [theirs_names.index(n) for n in names]
    theirs = [tuple(_cell(row[i]) for i in place) for row in cur.fetchall()]
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    ours.sort(key=_order)
    theirs.sort(key=_order)
    if ours == theirs:
        return None
    mine, other = set(ours) - set(theirs), set(theirs) - set(ours)
    return (f"{len(mine)} of {len(ours)} rows differ: {names} {sorted(mine, key=_order)[:2]} vs "
            f"{sorted(other, key=_order)[:2]}")


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import build_session

    sf_dir, parts = sys.argv[1], sys.argv[2:]
    spark = build_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sqls:
                problem = difference(df, con, sqls[name])
                n = ""
            else:
                problem, n = None, f" rows-only {df.count()}"
        except Exception as exc:  # noqa: BLE001  (report and go on)
            problem, n = f"{type(exc).__name__}: {str(exc).strip().splitlines()[0][:400]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s{n} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
