"""Runs registered queries against their expected SQL in DuckDB and compares whole results."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plan_of(df) -> str:
    """The physical plan as text."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def plain(value):
    """A value whose repr is comparable between the engines."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, Decimal):
        return ("dec", str(value))
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr([plain(row[i]) for i in order]) for row in rows)
    return [columns[i] for i in order], lines


def spark_result(df):
    return table_of(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return table_of(columns, cursor.fetchall())


def difference(got, want) -> str | None:
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] == want[1]:
        return None
    only_got = sorted(set(got[1]) - set(want[1]))[:3]
    only_want = sorted(set(want[1]) - set(got[1]))[:3]
    return f"{len(got[1])} vs {len(want[1])} rows\n  spark {only_got}\n  duck  {only_want}"


def main() -> None:
    import __spark_entry__ as entry
    from tidemark.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(sys.argv[2:])
    settings = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    spark = build_session("compare", "local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), entry.oracle_sql(), []
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            got = spark_result(run(spark, sf_dir))
            took = time.time() - started
            note = "no sql"
            if name in oracles:
                note = difference(got, duck_result(con, oracles[name])) or "ok"
        except Exception as error:  # report and go on with the next query
            took, note = time.time() - started, f"ERROR {str(error)[:700]}"
        rows = len(got[1]) if not note.startswith("ERROR") else 0
        print(f"{name:32s} {took:6.2f}s {rows:7d} {note}", flush=True)
        if note not in ("ok", "no sql") or (rows == 0 and name in oracles):
            bad.append(name)
    print("PROBLEMS:", bad)


if __name__ == "__main__":
    main()
