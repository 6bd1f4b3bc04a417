"""Compare registered queries with their SQL in DuckDB.

    python tests/oracle.py /root/testdata/sf0.01 [name …]
"""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return str(value) if value is not None and not isinstance(value, (int, str, bool)) else value


def sortable(rows):
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


def compare(df, con, sql):
    """None if equal, else a short account of the difference."""
    names = sorted(df.columns)
    got = sortable(tuple(plain(value) for value in row) for row in df.select(*names).collect())
    result = con.execute(sql)
    have = [column[0] for column in result.description]
    if sorted(have) != names:
        return f"columns {names} versus {sorted(have)}"
    order = [have.index(name) for name in names]
    want = sortable(tuple(plain(row[at]) for at in order) for row in result.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows versus {len(want)}; first {got[:2]} versus {want[:2]}"
    for mine, theirs in zip(got, want):
        if mine != theirs:
            return f"{dict(zip(names, mine))} versus {dict(zip(names, theirs))}"
    return None if got else "both are empty"


def main(sf_dir, *wanted):
    from pulsegrain.session import local_session
    import __spark_entry__ as entry

    spark = local_session("8", "oracle")
    con = connect(sf_dir)
    sql, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            verdict = compare(df, con, sql[name]) if name in sql else f"no SQL, {df.count()} rows"
        except Exception as problem:  # noqa: BLE001
            verdict = f"{type(problem).__name__}: {str(problem)[:700]}"
        bad += verdict is not None and not verdict.startswith("no SQL")
        print(f"{name:28s} {time.time() - start:6.2f}s {verdict or 'ok'}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(*sys.argv[1:])
