"""Run registered queries beside their DuckDB statements and compare the rows."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks.oracles import ORACLES
from checks.queries import QUERIES
from lawgrain.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, every value as text, rows sorted."""
    frame = frame[sorted(frame.columns)]

    def text(value: object) -> str:
        if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
            return "~"
        if isinstance(value, float) and value.is_integer():
            return str(int(value))
        if hasattr(value, "isoformat"):
            stamp = pd.Timestamp(value)
            return stamp.isoformat()
        return str(value)

    out = frame.astype(object).map(text)
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def differences(name: str, spark, con, sf_dir: str) -> list[str]:
    """What differs between a query and its statement; empty when equal."""
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = con.execute(ORACLES[name]).df()
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} / {sorted(want.columns)}"]
    if len(got) != len(want):
        return [f"rows {len(got)} / {len(want)}"]
    left, right = canonical(got), canonical(want)
    wrong = [column for column in left.columns if not left[column].equals(right[column])]
    notes = []
    for column in wrong:
        at = (left[column] != right[column]).idxmax()
        notes.append(f"{column} row {at}: {left.loc[at].to_dict()} / {right.loc[at].to_dict()}")
    return notes


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "local[8]", **{"spark__sql__shuffle__partitions": "8", "spark__ui__enabled": "false", "spark__ui__showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            notes = differences(name, spark, con, sf_dir) if name in ORACLES else ["no statement"]
        except Exception as failure:  # report every query, then fail
            notes = [f"{type(failure).__name__}: {str(failure)[:600]}"]
        bad += bool(notes)
        print(f"{'ok  ' if not notes else 'FAIL'} {name} {time.time() - start:.1f}s", *notes, sep="\n     " if notes else " ")
    print(f"{len(names) - bad} of {len(names)} equal")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
