"""Query against SQL oracle on the driver's small tables."""

import numbers
import os

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings generacion_real niveles_embalses precio_bolsa fact_demanda_real fact_generacion_real dim_agente embalses data_quality_results agentes plantas plantas_reservorios eval_items mix_targets".split()
DIR = "/root/testdata/sf0.001"


def cell(v):
    if v is None or v is pd.NA or v != v:
        return "NULL"
    if isinstance(v, numbers.Number) and not isinstance(v, (bool, np.bool_)):
        return repr(float(v))
    return str(v).removesuffix(" 00:00:00")


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(map(cell, r)) for r in df[cols].astype(object).itertuples(index=False))


def compare(spark, query, sql):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{DIR}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    got, want = rows(query(spark, DIR).toPandas()), rows(con.execute(sql).df())
    assert got[0] == want[0]
    assert got[1] == want[1]
