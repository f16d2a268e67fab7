"""Run queries on Spark and their SQL on DuckDB and compare the sorted rows.

python -m checks.compare [folder] [name ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pyarrow as pa
from pyspark.sql import SparkSession

from .oracle import ORACLE
from .queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def differences(con, got: pa.Table, sql: str) -> str | None:
    """Compare as bags of rows, columns by name."""
    con.register("got", got)
    con.execute(f"CREATE OR REPLACE TEMP TABLE want AS {sql}")
    names = sorted(r[0] for r in con.execute("DESCRIBE want").fetchall())
    if sorted(got.column_names) != names:
        return f"columns {sorted(got.column_names)} != {names}"
    cols = ", ".join(f'"{n}"' for n in names)
    extra, missing = (
        con.execute(f"SELECT {cols} FROM {x} EXCEPT ALL SELECT {cols} FROM {y}").fetchall()
        for x, y in (("got", "want"), ("want", "got"))
    )
    if extra or missing:
        sample = "\n    ".join(str(r) for r in sorted(extra[:2] + missing[:2], key=str))
        return f"{len(extra)} rows too many, {len(missing)} missing of {got.num_rows}\n    {sample}"
    return None


def check(spark: SparkSession, con, folder: str, name: str) -> str | None:
    got = QUERIES[name](spark, folder).toArrow()
    if name not in ORACLE:
        return None if got.num_rows else "no rows"
    return differences(con, got, ORACLE[name])


def main(argv: list[str]) -> int:
    folder = argv[0] if argv else "/root/testdata/sf0.01"
    from weekloom import build_session

    spark = build_session(
        "checks", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in argv[1:] or QUERIES:
        t = time.time()
        try:
            problem = check(spark, con, folder, name)
        except Exception as e:  # noqa: BLE001  report and go on
            problem = f"{type(e).__name__}: {str(e)[:500]}"
        bad += problem is not None
        kind = "sql " if name in ORACLE else "rows"
        print(f"{'FAIL' if problem else 'ok':5}{kind} {name:28}{time.time() - t:6.1f}s {problem or ''}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
