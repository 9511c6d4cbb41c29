"""Semantic-model measures as aggregates; the filter context is given by ``by`` (the columns a visual groups on)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def divide(a: Column, b: Column, default: float | None = None) -> Column:
    """NULL, or the default, where the denominator is 0 or NULL."""
    q = F.when(b != 0, a / b)
    return q if default is None else F.coalesce(q, F.lit(default))


def sums(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.sum(F.col(c).cast("decimal(24,6)")).cast("double").alias(c) for c in cols])


def max_then_sum(df: DataFrame, by: list[str], entity: str, value: str, out: str) -> DataFrame:
    """Sum over entities of the entity's highest value (a capacity, which repeats on every row)."""
    return df.groupBy(*by, entity).agg(F.max(value).alias("_x")).groupBy(*by).agg(F.sum("_x").alias(out))


def sum_then_avg(df: DataFrame, by: list[str], day: str, value: str, out: str) -> DataFrame:
    """Mean over days of the day's total."""
    return df.groupBy(*by, day).agg(F.sum(F.col(value).cast("decimal(24,6)")).alias("_x")).groupBy(*by).agg(F.avg(F.col("_x").cast("double")).alias(out))


def capacity_factor(df: DataFrame, by: list[str], energy_gwh: str, capacity_mw: str) -> DataFrame:
    """Energy over capacity times 24 hours, over the rows with a positive capacity."""
    d = df.where(F.col(capacity_mw) > 0).groupBy(*by).agg(F.sum(F.col(energy_gwh).cast("decimal(24,6)")).cast("double").alias("_e"), F.sum(F.col(capacity_mw).cast("decimal(24,6)")).cast("double").alias("_c"))
    return d.select(*by, F.round(divide(F.col("_e") * 1000, F.col("_c") * 24), 8).alias("factor_capacidad"))


def at_latest(df: DataFrame, by: list[str], day: str, values: list[str]) -> DataFrame:
    """Semi-additive values: totals on the last day of the context."""
    per = df.groupBy(*by, day).agg(*[F.sum(F.col(v).cast("decimal(24,6)")).cast("double").alias(v) for v in values])
    return per.groupBy(*by).agg(F.max(day).alias(day), *[F.max_by(v, day).alias(v) for v in values])


def complete_days(df: DataFrame, day: str, hours: str, least: int = 24) -> DataFrame:
    """Days on which even the entity with the fewest hours has all of them."""
    return df.groupBy(day).agg(F.min(hours).alias("_h")).where(F.col("_h") == least).agg(F.count("*").alias("dias_completos"))


def last_run(runs: DataFrame, by_time: str, values: list[str]) -> DataFrame:
    return runs.agg(*[F.max_by(v, F.struct(by_time, "run_id")).alias(v) for v in values])


def distinct_union(frames: list[DataFrame], col: str) -> DataFrame:
    return reduce(DataFrame.union, [f.select(col) for f in frames]).distinct()


def zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def _total(c: str) -> Column:
    return F.sum(F.col(c).cast("decimal(24,6)")).cast("double")


def system(daily: DataFrame, by: list[str], gen: str, demand: str, avail: str, cut: str) -> DataFrame:
    """Margin, margin share, utilisation and TWh of the comparable days, and the cut-off date; ratios are NULL on a zero denominator."""
    t = daily.groupBy(*by).agg(_total(gen).alias("g"), _total(demand).alias("d"), _total(avail).alias("a"), F.max(cut).alias("fecha_corte"))
    g, d, a = F.col("g"), F.col("d"), F.col("a")
    return t.select(*by, F.round(g - d, 6).alias("margen_gwh"), F.round(divide(g - d, d), 8).alias("margen_parte"), F.round(divide(g, a) * 100, 6).alias("utilizacion_pct"), F.round(g / 1000, 9).alias("generacion_twh"), F.round(d / 1000, 9).alias("demanda_twh"), F.round(a / 1000, 9).alias("disponibilidad_twh"), "fecha_corte")


def plants(plant_day: DataFrame, by: list[str]) -> DataFrame:
    """Generation of plants (0 where there is none), utilisation, and how many plants generated in an hour at least."""
    t = plant_day.groupBy(*by).agg(_total("generacion_gwh").alias("g"), _total("disponibilidad_gwh").alias("a"), F.countDistinct(F.when(F.col("horas_generacion") > 0, F.col("planta_key"))).alias("plantas_activas"))
    return t.select(*by, F.round(zero(F.col("g")), 6).alias("generacion_gwh"), F.round(zero(F.col("g")) / 1000, 9).alias("generacion_twh"), F.round(divide(F.col("g"), F.col("a")), 8).alias("utilizacion"), "plantas_activas")


def daily_or_blank(plant_day: DataFrame, by: list[str]) -> DataFrame:
    """Generation, blank where no hour has data, so that a chart shows a gap and no zero."""
    t = plant_day.groupBy(*by).agg(_total("generacion_gwh").alias("g"), F.sum("horas_generacion").alias("h"))
    return t.select(*by, F.when(F.col("h") > 0, F.round("g", 6)).alias("generacion_gwh"))


def health(alerts: DataFrame, sources: DataFrame, tasks: DataFrame) -> DataFrame:
    """One row: open alerts, largest lag, share of sources within their limit, mean task duration."""
    a = alerts.agg(F.count_if(F.col("status") == "OPEN").alias("alertas_abiertas"))
    s = sources.agg(F.max("dias_rezago").alias("mayor_rezago"), F.round(divide(F.count_if("cumple").cast("double"), F.count("*").cast("double")) * 100, 6).alias("cumplimiento_pct"))
    t = tasks.agg(F.round(F.avg("duration_seconds"), 6).alias("duracion_media"))
    return a.crossJoin(s).crossJoin(t)  # one row each


def market(by_market: DataFrame, by: list[str]) -> DataFrame:
    """Demand of the markets in GWh and TWh, mean of the days' totals, and the highest hour."""
    day = by_market.groupBy(*by, "fecha_key").agg(F.sum(F.col("demanda_gwh").cast("decimal(24,6)")).alias("x"), F.max("demanda_pico_mw").alias("p"))
    return day.groupBy(*by).agg(F.sum("x").cast("double").alias("demanda_gwh"), F.round(F.sum("x").cast("double") / 1000, 9).alias("demanda_twh"), F.round(F.avg(F.col("x").cast("double")), 6).alias("media_diaria_gwh"), F.max("p").alias("pico_mw"))


def energy_change(daily: DataFrame) -> DataFrame:
    """Sum of the daily changes and mean coverage of the stored energy."""
    return daily.agg(F.round(F.sum("variacion_gwh"), 6).alias("variacion_gwh"), F.round(F.avg("cobertura_pct"), 6).alias("cobertura_media_pct"))


def spanning_calendar(days: list[DataFrame], col: str) -> DataFrame:
    """Every day from the first to the last of several sets of days, with its parts."""
    ends = distinct_union(days, col).agg(F.min(col).alias("a"), F.max(col).alias("b")).where("a is not null")
    d = ends.select(F.explode(F.sequence("a", "b")).alias(col))
    c = F.col(col)
    return d.select(c, F.year(c).alias("anio"), F.month(c).alias("mes_numero"), F.date_format(c, "yyyy-MM").alias("anio_mes"), F.concat(F.lit("T"), F.quarter(c).cast("string")).alias("trimestre"), (F.weekday(c) + 1).alias("dia_semana"))


def relationships(specs: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Checks of many-to-one relations (name, many side, its key, one side, its key): rows, rows without partner, and keys of the one
    side that are not unique."""
    out = None
    for n, many, a, one, b in specs:
        keys = one.where(F.col(b).isNotNull()).groupBy(F.col(b).alias("_k")).agg(F.count("*").alias("_n"))
        per = many.groupBy(F.col(a).alias("_a")).agg(F.count("*").alias("_rows"))
        j = per.join(keys, F.col("_a") == F.col("_k"), "full")
        r = j.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("filas"), F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("_rows"))), F.lit(0)).alias("sin_pareja"), F.count_if(F.col("_n") > 1).alias("claves_repetidas")).withColumn("relacion", F.lit(n))
        out = r if out is None else out.unionByName(r)
    return out


def over_capacity(plant_day: DataFrame, plant: str, energy_gwh: str, capacity_mw: str, tolerance: float = 1.05) -> DataFrame:
    """Per plant: days with generation, days above the capacity times the tolerance, and the highest capacity factor."""
    x = plant_day.where(F.col(energy_gwh).isNotNull())
    most = F.col(capacity_mw) * 24
    return x.groupBy(plant).agg(F.count("*").alias("dias"), F.count_if(F.col(energy_gwh) * 1000 > most * tolerance).alias("dias_sobre_capacidad"), F.round(F.max(F.when(F.col(capacity_mw) > 0, F.col(energy_gwh) * 1000 / most)), 8).alias("mayor_factor"))
