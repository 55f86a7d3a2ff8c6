"""Run a check query in Spark and its SQL in DuckDB, and compare all rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _canonical(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)]
    out = pd.DataFrame(index=pdf.index)
    for c in pdf.columns:
        col = pdf[c]
        if str(col.dtype).startswith(("datetime", "date")):
            col = pd.to_datetime(col).dt.strftime("%Y-%m-%d %H:%M:%S")
        out[c] = [
            "∅" if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v)
            else f"{float(v):.15g}" if isinstance(v, (int, float)) and not isinstance(v, bool)
            else str(v)
            for v in col.tolist()
        ]
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def difference(spark, con, query, sql, folder: str) -> str | None:
    """None if both give the same rows, else a short description."""
    df = query(spark, folder)
    mine = _canonical(df.toPandas())
    rel = con.sql(sql)
    theirs = _canonical(rel.df())
    if list(mine.columns) != list(theirs.columns):
        return f"columns {list(mine.columns)} != {list(theirs.columns)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    bad = (mine != theirs).any(axis=1)
    if bad.any():
        i = bad.idxmax()
        return f"{int(bad.sum())} rows differ, first {mine.loc[i].to_dict()} != {theirs.loc[i].to_dict()}"
    types = dict(zip(rel.columns, map(str, rel.types)))
    return None if len(mine) else f"no rows (types {types})"


def main():
    from bioobs.session import build_session
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name, query in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            result = difference(spark, con, query, sql, folder) if sql else f"rows only: {query(spark, folder).count()}"
        except Exception as e:  # report and go on with the next query
            result = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{'ok  ' if result is None else 'DIFF'} {time.time() - start:6.2f}s {name} {result or ''}", flush=True)


if __name__ == "__main__":
    main()
