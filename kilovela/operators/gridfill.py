"""Irregular readings onto a regular hourly grid, gaps filled by low-rank factorisation.

The matrix of sources by hours is approximated by alternating least squares: with the hour factors fixed each source's
factor solves a small ridge system, then the reverse. A system's sums are plain aggregates over the observed cells, so
they combine on the map side and a hot source or hour is no single task's burden; only the r x r solves run in Arrow
batches. Observed cells stay exact; a missing cell of a source or hour without enough support is marked, not filled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilovela.session import join_small, stage

RANK = 4
BLOCK = 1024
OBSERVED, FILLED, UNSUPPORTED = "observado", "estimado", "sin_soporte"


def hourly(df: DataFrame, keys: list[str], when: str, value: str, row_key: str) -> DataFrame:
    """(keys, h, y, n): one mean value per clock hour; wholly repeated rows (same ``row_key``, time and value) count once.
    Rows with NULL or NaN value or NULL time give no reading; NULL series keys form a series of their own."""
    h = F.floor(F.unix_micros(F.col(when).cast("timestamp")) / F.lit(3_600_000_000)).cast("long")
    d = df.select(*keys, h.alias("h"), F.col(value).cast("double").alias("_v"), F.col(row_key).alias("_k"), F.unix_micros(F.col(when).cast("timestamp")).alias("_t"))
    d = d.where(F.col("h").isNotNull() & F.col("_v").isNotNull() & ~F.isnan("_v"))
    one = d.groupBy(*keys, "h", "_t", "_k", "_v").agg(F.lit(1).alias("_"))
    return one.groupBy(*keys, "h").agg(F.avg("_v").alias("y"), F.count("*").alias("n"))


def grid(obs: DataFrame, keys: list[str]) -> DataFrame:
    """Every hour from the first to the last observed one of each series. Spans are cut into blocks of hours, which are spread over the
    tasks before they are written out, so a series with a stray date is no single task's burden."""
    ends = obs.groupBy(*keys).agg(F.min("h").alias("_a"), F.max("h").alias("_b"))
    blocks = ends.select(*keys, "_b", F.explode(F.sequence("_a", "_b", F.lit(BLOCK))).alias("_a")).repartition(*keys, "_a")
    return blocks.select(*keys, F.explode(F.sequence(F.col("_a"), F.least(F.col("_a") + (BLOCK - 1), F.col("_b")))).alias("h"))


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    c = a["h"] == b["h"] if "h" in a.columns and "h" in b.columns else F.lit(True)
    for k in keys:
        c = c & a[k].eqNullSafe(b[k])
    return c


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _solve(sums: pd.Series) -> pd.Series:
    """Ridge solutions of rows [upper triangle of sum(f f'), sum(f z), ridge]."""
    r, out = RANK, []
    iu = np.triu_indices(r)
    m = np.asarray(sums.tolist(), dtype=float).reshape(len(sums), -1)
    if not len(m):
        return pd.Series([], dtype=object)
    a = np.zeros((len(m), r, r))
    t = len(iu[0])
    a[:, iu[0], iu[1]] = m[:, :t]
    a[:, iu[1], iu[0]] = m[:, :t]
    a += m[:, -1][:, None, None] * np.eye(r)
    out = np.linalg.solve(a, m[:, t : t + r, None])[:, :, 0]
    return pd.Series(list(out))


def _half_step(cells: DataFrame, factor: DataFrame, side: str, other: str, ridge: float, prior: Column | None = None) -> DataFrame:
    """New factors of ``side`` given those of ``other`` (column ``f``), drawn towards ``prior`` (else 0) by the ridge."""
    x = join_small(cells, factor, [other], "inner", salt_of=side)
    f = [F.col("f")[i] for i in range(RANK)]
    sums = [F.sum(f[i] * f[j]) for i in range(RANK) for j in range(i, RANK)] + [F.sum(f[i] * F.col("z")) for i in range(RANK)]
    g = x.groupBy(side).agg(*[s.alias(f"_{k}") for k, s in enumerate(sums)], F.count("*").alias("apoyo"))
    n = len(sums) - RANK
    pull = [F.col(f"_{n + i}") + (prior[i] * ridge if prior is not None else F.lit(0.0)) for i in range(RANK)]
    packed = F.array(*[F.col(f"_{k}") for k in range(n)], *pull, F.lit(ridge))
    return g.select(side, _solve(packed).alias("f"), "apoyo")


def _moved(old: DataFrame, new: DataFrame) -> float:
    """Root mean square change of the hour factors, as a share of their size."""
    f = [(F.col("f")[i], F.col("_g")[i]) for i in range(RANK)]
    j = join_small(new.select("h", "f"), old.select("h", F.col("f").alias("_g")), ["h"], "inner")
    r = j.agg(F.sum(sum((a - b) ** 2 for a, b in f)).alias("d"), F.sum(sum(a * a for a, _ in f)).alias("n")).first()  # two numbers
    return (r["d"] / r["n"]) ** 0.5 if r["n"] else 0.0


def _start(h: Column) -> Column:
    """First hour factors and what hour factors are drawn towards: level and daily harmonics."""
    a = h * F.lit(2 * np.pi / 24)
    return F.array(F.lit(1.0), F.cos(a), F.sin(a), F.cos(a * 2))


def fill(df: DataFrame, keys: list[str], when: str, value: str, row_key: str, rounds: int = 10, still: float = 0.01, ridge: float = 0.5, daily: float = 20.0, least: int = 8) -> DataFrame:
    """(keys, h, valor, estado) for every hour between a series' first and last observed hour.

    Values are factorised as standardised deviations from the source's mean; hour factors are drawn towards the daily
    pattern by the weight ``daily``, so an hour with few readings falls back on it. Rounds end when the hour factors stand ``still``. A source needs ``least`` observed hours, an
    hour one observed cell of such a source. An empty table gives an empty grid. Series are numbered by a 64-bit hash of
    their keys together with the keys, so equal hashes of different keys share a factor but never a cell.
    """
    obs = stage(hourly(df, keys, when, value, row_key), "obs").withColumn("s", F.xxhash64(*keys))
    stats = stage(obs.groupBy("s").agg(F.avg("y").alias("m"), F.coalesce(F.stddev_pop("y"), F.lit(0.0)).alias("d"), F.count("*").alias("k")).where(F.col("k") >= least), "stats")
    z = F.when(F.col("d") > 0, (F.col("y") - F.col("m")) / F.col("d")).otherwise(F.lit(0.0))
    cells = stage(obs.join(stats, "s").select("s", "h", z.alias("z")), "cells")
    hours = cells.select("h").distinct().select("h", _start(F.col("h")).alias("f"), F.lit(0).cast("long").alias("apoyo"))
    for _ in range(rounds):
        sources = stage(_half_step(cells, hours, "s", "h", ridge), "src")
        new = stage(_half_step(cells, sources, "h", "s", daily, _start(F.col("h"))), "hrs")
        moved, hours = _moved(hours, new), new
        if moved < still:
            break
    all_cells = grid(obs, keys).withColumn("s", F.xxhash64(*keys))
    y = all_cells.join(obs.select(*keys, "h", "y"), _same(all_cells, obs, keys), "left").select(*[all_cells[k] for k in keys], all_cells["h"], all_cells["s"], "y")
    u = sources.select("s", F.col("f").alias("_u")).join(stats.select("s", "m", "d"), "s")
    v = hours.select("h", F.col("f").alias("_v"))
    est = sum((F.col("_u")[i] * F.col("_v")[i] for i in range(RANK)), F.lit(0.0)) * F.col("d") + F.col("m")
    seen = F.col("y").isNotNull()
    full = y.join(u, "s", "left").join(v, "h", "left")
    valor = F.when(seen, F.col("y")).otherwise(est)
    estado = F.when(seen, F.lit(OBSERVED)).when(est.isNotNull(), F.lit(FILLED)).otherwise(F.lit(UNSUPPORTED))
    return full.select(*keys, "h", valor.alias("valor"), estado.alias("estado"))


def hour_number(h: Column) -> Column:
    """yyyymmddhh of an hour count since 1970."""
    t = F.timestamp_seconds(h * 3600)
    return F.date_format(t, "yyyyMMddHH").cast("long")


def holdout(df: DataFrame, keys: list[str], when: str, value: str, row_key: str, every: int = 10, **kw) -> DataFrame:
    """Held-out accuracy: hides about one observed hour in ``every`` (by hash), fills, and returns RMSE of the fill and of
    the source mean."""
    h = F.floor(F.unix_micros(F.col(when).cast("timestamp")) / F.lit(3_600_000_000)).cast("long")
    hide = F.pmod(F.xxhash64(*keys, h), F.lit(every)) == 0
    truth = hourly(df, keys, when, value, row_key).where(F.pmod(F.xxhash64(*keys, F.col("h")), F.lit(every)) == 0)
    got = fill(df.where(~hide), keys, when, value, row_key, **kw).where(F.col("estado") == FILLED)
    means = hourly(df.where(~hide), keys, when, value, row_key).groupBy(*keys).agg(F.avg("y").alias("m"))
    j = truth.join(got, [*keys, "h"]).join(means, keys)
    return j.agg(F.count("*").alias("n"), F.sqrt(F.avg((F.col("y") - F.col("valor")) ** 2)).alias("rmse"), F.sqrt(F.avg((F.col("y") - F.col("m")) ** 2)).alias("rmse_media"))
