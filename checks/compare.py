"""Run every query in Spark and its SQL in DuckDB and compare the rows.

    python -m checks.compare [folder] [query ...]
"""

import sys
import time

import duckdb
import pandas as pd

from checks.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def kind(dtype: str) -> str:
    dtype = dtype.lower()
    for prefix, name in (("decimal", "decimal"), ("varchar", "string")):
        if dtype.startswith(prefix):
            return name
    return {"integer": "int", "int32": "int", "int64": "bigint", "hugeint": "hugeint"}.get(dtype, dtype)


def rows_of(pdf: pd.DataFrame, whole: set[str]) -> list[tuple]:
    """Rows as text; `whole` are the integer columns, which pandas turns to floats where they hold nulls."""
    names = sorted(pdf.columns)

    def cell(name, v):
        if v is None or (isinstance(v, float) and v != v) or v is pd.NA:
            return "NULL"
        if name in whole:
            return str(int(v))
        return repr(v + 0.0) if isinstance(v, float) else str(v)

    return sorted(tuple(map(cell, names, row)) for row in pdf[names].astype(object).itertuples(index=False))


def compare(spark, folder: str, query, sql: str | None, con) -> str:
    df = query(spark, folder)
    got = df.toPandas()
    if sql is None:
        return f"rows only: {len(got)}"
    relation = con.sql(sql)
    want = relation.df()
    if sorted(df.columns) != sorted(relation.columns):
        return f"DIFFERS columns {sorted(df.columns)} {sorted(relation.columns)}"
    types = {n: kind(str(t)) for n, t in zip(relation.columns, relation.types)}
    odd = {n: (t, types[n]) for n, t in df.dtypes if kind(t) != types[n]}
    whole = {n for n, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint")}
    a, b = rows_of(got, whole), rows_of(want, whole)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        return f"DIFFERS {len(a)} vs {len(b)} rows; {sorted(df.columns)}\n   spark {only_a}\n   sql   {only_b}"
    return f"ok {len(a)}" + (f" types {odd}" if odd else "")


def main() -> None:
    from checks.oracle import oracle_sql
    from checks.workload import queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark, con, sql = local_session(), database(folder), oracle_sql()
    for name in names:
        start = time.time()
        try:
            result = compare(spark, folder, queries()[name], sql.get(name), con)
        except Exception as error:  # report and go on with the next query
            result = f"ERROR {str(error)[:700]}"
        print(f"{name:28s} {time.time() - start:6.2f}s  {result}", flush=True)


if __name__ == "__main__":
    main()
