"""Run a registered query and its SQL oracle side by side."""

from __future__ import annotations

import glob
import math
import os

import duckdb
from pyspark.sql import SparkSession


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _cell(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(v).lower()
    if hasattr(v, "as_tuple"):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return str(int(v)) if v == int(v) and abs(v) < 1e15 else repr(v)
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def run_one(spark, sf_dir: str, name: str, run, sql: str | None) -> str:
    """'ok <rows>' when both sides agree, 'rows <n>' without an oracle, else what differs."""
    df = run(spark, sf_dir)
    got = _rows(df.columns, df.collect())
    if sql is None:
        return f"rows {len(got)}"
    con = duck(sf_dir)
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = _rows(cols, cur.fetchall())
    if sorted(cols) != sorted(df.columns):
        return f"COLUMNS spark={sorted(df.columns)} sql={sorted(cols)}"
    if got != want:
        diff = [(a, b) for a, b in zip(got, want) if a != b][:3]
        only = list(set(got) - set(want))[:2], list(set(want) - set(got))[:2]
        return f"DIFF rows spark={len(got)} sql={len(want)} first={diff} only={only}"
    return f"ok {len(got)}"
