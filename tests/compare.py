"""Run registered queries and their SQL twins and compare all values.

``python -m tests.compare [sf_dir] [name …]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{Path(sf_dir) / name}.parquet')")
    return con


def _canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        kind = frame[c].dtype
        if pd.api.types.is_datetime64_any_dtype(kind):
            frame[c] = frame[c].astype("datetime64[us]").astype(str)
        elif pd.api.types.is_numeric_dtype(kind):
            frame[c] = frame[c].astype("float64")
        else:
            frame[c] = frame[c].map(lambda v: None if v is None or v != v else str(v)[:10] if hasattr(v, "year") else str(v))
        frame[c] = frame[c].astype(object).where(frame[c].notna() & (frame[c].astype(str) != "NaT"), None)
    keys = frame.apply(lambda row: tuple((v is not None, v if v is not None else 0) for v in row), axis=1)
    return frame.loc[keys.sort_values(kind="stable").index].reset_index(drop=True) if len(frame) else frame


def spark_types(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree in columns, rows and every value."""
    ours = df.toPandas()
    theirs = con.execute(sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns differ: {sorted(set(ours.columns) ^ set(theirs.columns))}"
    if len(ours) != len(theirs):
        return f"rows differ: {len(ours)} and {len(theirs)}"
    a, b = _canonical(ours), _canonical(theirs)
    for c in a.columns:
        off = [(x, y) for x, y in zip(a[c], b[c]) if x != y]
        if off:
            return f"{c}: {len(off)} of {len(a)} values differ, first {off[0]}"
    return None


def type_notes(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    names = {"int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}
    wanted = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [f"{c}: {t} / {wanted.get(c)}" for c, t in df.dtypes if names.get(t, t.upper()) != wanted.get(c)]


def main() -> int:
    import __spark_entry__ as entry
    from cardfeat.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark: SparkSession = build_session(
        "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g", spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                fault = compare(df, con, oracle[name])
                notes = type_notes(df, con, oracle[name])
            else:
                fault, notes = (None if df.count() else "no rows"), ["rows only"]
        except Exception as error:  # noqa: BLE001 - report and go on
            fault, notes = f"{type(error).__name__}: {str(error)[:1500]}", []
        bad += fault is not None
        print(f"{'ok ' if fault is None else 'BAD'} {name} {time.time() - start:.1f}s {fault or ''} {notes or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
