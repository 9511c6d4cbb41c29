"""Analytic and serving views as functions of fact and dimension frames.

Measures are summed as decimals and rounded at the end, so results do not depend on the order of rows. Global windows run
over one row per day.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilovela.functions.normalize import blank_to, safe_ratio
from kilovela.operators.joins import validity

CAL = ["anio", "trimestre", "mes_numero", "mes_nombre", "anio_mes", "anio_mes_nombre"]


def _scaled(c: str | Column, by: int, digits: int = 3) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.round(x.cast("double") / by, digits)


def hourly_system(gen: DataFrame, avail: DataFrame, demand: DataFrame, price: DataFrame) -> DataFrame:
    """One row per hour known to any of four facts, with the system's totals and ratios."""
    spine = reduce(DataFrame.union, [x.select("fecha_hora") for x in (gen, avail, demand, price)]).where("fecha_hora is not null").distinct()
    g = gen.groupBy("fecha_hora").agg(F.sum("generacion_real_kwh").alias("generacion_real_kwh"))
    a = avail.groupBy("fecha_hora").agg(F.sum("disponibilidad_real_kwh").alias("disponibilidad_real_kwh"))
    market = F.upper(F.trim("tipo_mercado"))
    part = lambda *m: F.sum(F.when(market.isin(*m), F.col("demanda_real_kwh")).otherwise(0))
    d = demand.groupBy("fecha_hora").agg(F.sum("demanda_real_kwh").alias("demanda_total_kwh"), part("REGULADO").alias("demanda_regulada_kwh"), part("NO REGULADO", "NO_REGULADO").alias("demanda_no_regulada_kwh"))
    p = price.groupBy("fecha_hora").agg(F.max("precio_nacional").alias("precio_nacional"), F.max("precio_internacional").alias("precio_internacional"), F.max("precio_tie").alias("precio_tie"))
    x = spine.join(g, "fecha_hora", "left").join(d, "fecha_hora", "left").join(a, "fecha_hora", "left").join(p, "fecha_hora", "left")
    return x.select(
        F.date_format("fecha_hora", "yyyyMMdd").cast("int").alias("fecha_key"), (F.hour("fecha_hora") + 1).alias("periodo"), "fecha_hora", F.to_date("fecha_hora").alias("fecha"),
        "generacion_real_kwh", "demanda_total_kwh", "demanda_regulada_kwh", "demanda_no_regulada_kwh", "disponibilidad_real_kwh", "precio_nacional", "precio_internacional", "precio_tie",
        (F.col("generacion_real_kwh") - F.col("demanda_total_kwh")).alias("balance_kwh"), (F.col("disponibilidad_real_kwh") - F.col("generacion_real_kwh")).alias("margen_kwh"),
    )


def daily_system(hourly: DataFrame) -> DataFrame:
    """Daily totals in GWh, utilisation, mean / least / highest price, hours with any data."""
    sums = {"generacion_gwh": "generacion_real_kwh", "demanda_gwh": "demanda_total_kwh", "demanda_regulada_gwh": "demanda_regulada_kwh", "disponibilidad_gwh": "disponibilidad_real_kwh", "balance_gwh": "balance_kwh", "margen_gwh": "margen_kwh"}
    util = F.round(100 * safe_ratio(F.sum("generacion_real_kwh").cast("double"), F.sum("disponibilidad_real_kwh").cast("double")), 2)
    pr = "precio_nacional"
    return hourly.groupBy("fecha_key", "fecha").agg(*[_scaled(F.sum(c), 10**6).alias(n) for n, c in sums.items()], util.alias("utilizacion_pct"), F.round(F.avg(pr), 2).alias("precio_promedio"), F.round(F.min(pr), 2).alias("precio_minimo"), F.round(F.max(pr), 2).alias("precio_maximo"), F.countDistinct("fecha_hora").alias("horas_con_datos"))


def kpi_daily(daily: DataFrame) -> DataFrame:
    """Moving means over 7 rows, completeness, and measures masked beyond the last day on which all sources are complete."""
    w = Window.orderBy("fecha").rowsBetween(-6, 0)  # one row per day
    whole = F.col("generacion_gwh").isNotNull() & F.col("demanda_gwh").isNotNull() & F.col("disponibilidad_gwh").isNotNull() & F.col("precio_promedio").isNotNull() & (F.col("horas_con_datos") == 24)
    m = daily.withColumns({
        "generacion_media_7": F.round(F.avg("generacion_gwh").over(w), 3), "demanda_media_7": F.round(F.avg("demanda_gwh").over(w), 3), "precio_media_7": F.round(F.avg("precio_promedio").over(w), 2),
        "completitud_pct": F.round(100.0 * F.col("horas_con_datos") / 24.0, 2), "fecha_corte": F.max(F.when(whole, F.col("fecha"))).over(Window.partitionBy()),
    })
    ok = F.col("fecha") <= F.col("fecha_corte")
    return m.withColumn("es_comparable", ok).withColumns({f"{c}_comparable": F.when(ok, F.col(c)) for c in ("generacion_gwh", "demanda_gwh", "disponibilidad_gwh", "precio_promedio")})


def source_freshness(sources: dict[str, tuple[DataFrame, str]], today: Column, max_lag: int = 45) -> DataFrame:
    """Coverage per source, lag to ``today`` and its class."""
    one = lambda n, df, c: df.agg(F.min(F.to_date(c)).alias("fecha_minima"), F.max(F.to_date(c)).alias("fecha_maxima"), F.countDistinct(F.to_date(c)).alias("dias"), F.count("*").alias("registros")).withColumn("fuente", F.lit(n))
    u = reduce(DataFrame.unionByName, [one(n, df, c) for n, (df, c) in sources.items()])
    lag = F.datediff(today, "fecha_maxima")
    return u.withColumn("dias_rezago", lag).withColumn("cumple", lag <= max_lag).withColumn("estado", F.when(lag <= 7, "SALUDABLE").when(lag <= max_lag, "EN OBSERVACION").otherwise("INCUMPLIDO"))


def _demand_aggs() -> list[Column]:
    v = F.col("demanda_real_kwh")
    return [_scaled(F.sum(v), 10**6).alias("demanda_gwh"), _scaled(F.avg(v), 1000).alias("demanda_promedio_mw"), _scaled(F.max(v), 1000).alias("demanda_pico_mw"), F.countDistinct("fecha_hora").alias("horas_con_datos")]


def demand_by_market(demand: DataFrame, calendar: DataFrame) -> DataFrame:
    b = demand.groupBy("fecha_key", F.upper(F.trim("tipo_mercado")).alias("tipo_mercado")).agg(*_demand_aggs(), F.countDistinct("agente_key").alias("agentes"))
    return b.join(F.broadcast(calendar.select("fecha_key", *CAL, "es_fin_semana")), "fecha_key", "left")  # a calendar: days of some years


def demand_by_agent(demand: DataFrame, calendar: DataFrame, agents: DataFrame) -> DataFrame:
    b = demand.groupBy("fecha_key", "agente_key", F.upper(F.trim("tipo_mercado")).alias("tipo_mercado")).agg(*_demand_aggs())
    return b.join(F.broadcast(calendar.select("fecha_key", *CAL)), "fecha_key", "left").join(agents.select("agente_key", "codigo_agente", "nombre_agente", "actividad_agente"), "agente_key", "left")


def plant_daily(gen: DataFrame, avail: DataFrame, plants: DataFrame) -> DataFrame:
    """Generation and availability per plant and day over the union of both key sets (a full outer join of two aggregates)."""
    def side(df: DataFrame, c: str, p: str) -> DataFrame:
        return df.groupBy("fecha_key", "planta_key").agg(F.sum(c).alias(f"{p}_kwh"), F.avg(c).alias(f"{p}_media"), F.max(c).alias(f"{p}_pico"), F.countDistinct("fecha_hora").alias(f"{p}_horas"))

    j = side(gen, "generacion_real_kwh", "gen").join(side(avail, "disponibilidad_real_kwh", "disp"), ["fecha_key", "planta_key"], "full").join(plants, "planta_key", "left")
    g, d = F.col("gen_kwh"), F.col("disp_kwh")
    return j.select(
        "fecha_key", "planta_key", *[c for c in plants.columns if c != "planta_key"], _scaled(g, 10**6).alias("generacion_gwh"), _scaled(d, 10**6).alias("disponibilidad_gwh"), _scaled("gen_media", 1000).alias("generacion_mw"),
        _scaled("gen_pico", 1000).alias("generacion_pico_mw"), F.col("gen_horas").alias("horas_generacion"), F.col("disp_horas").alias("horas_disponibilidad"), F.round(100 * safe_ratio(g.cast("double"), d.cast("double")), 2).alias("utilizacion_pct"),
        F.when(g.isNull(), "SOLO DISPONIBILIDAD").when(d.isNull(), "SOLO GENERACION").when(g > d, "GENERACION MAYOR A DISPONIBILIDAD").otherwise("CONSISTENTE").alias("estado"),
    )


def by_technology(plant_day: DataFrame) -> DataFrame:
    s = lambda c: F.sum(F.col(c).cast("decimal(24,3)")).cast("double")
    return plant_day.groupBy("fecha_key", blank_to("tipo_generacion", "SIN CLASIFICAR").alias("tipo_generacion")).agg(F.round(s("generacion_gwh"), 3).alias("generacion_gwh"), F.round(s("disponibilidad_gwh"), 3).alias("disponibilidad_gwh"), F.countDistinct("planta_key").alias("plantas"), F.round(100 * safe_ratio(s("generacion_gwh"), s("disponibilidad_gwh")), 2).alias("utilizacion_pct"))


def stored_energy(fact: DataFrame, relations: DataFrame, approved: tuple[str, ...] = ("validated",), reviewed: bool = True) -> DataFrame:
    """Stored energy per plant and day with the reservoirs related on that day by relations of a status in ``approved`` and, with
    ``reviewed``, none that waits for a review: how many, which, and whether one."""
    days = fact.select("planta", "fecha").distinct()
    ok = relations.where(F.col("activo") & F.col("permite_atribucion") & F.lower(F.trim("estado_validacion")).isin(*approved) & (~F.col("requiere_revision_manual") if reviewed else F.lit(True))).select("planta", "codigo_embalse", "valido_desde", "valido_hasta")
    r = validity(days, ok, "planta", "fecha", "valido_desde", "valido_hasta").groupBy("planta", "fecha").agg(F.countDistinct("codigo_embalse").alias("embalses"), F.concat_ws(", ", F.array_sort(F.collect_set("codigo_embalse"))).alias("codigos"))
    n = F.col("embalses")
    return fact.join(r, ["planta", "fecha"], "left").withColumn("estado_relacion", F.when(n == 1, "RELACION UNICA").when(n > 1, "RELACION MULTIPLE").otherwise("SIN RELACION"))


def stored_energy_daily(energy: DataFrame) -> DataFrame:
    """Daily totals by relation state, change to the day before, and the last day on record."""
    v = F.col("energia_gwh").cast("decimal(24,6)")
    by = lambda s: F.sum(F.when(F.col("estado_relacion") == s, v).otherwise(0)).cast("double")
    d = energy.groupBy("fecha").agg(F.sum(v).cast("double").alias("energia_gwh"), by("RELACION UNICA").alias("directa_gwh"), by("RELACION MULTIPLE").alias("multiple_gwh"), by("SIN RELACION").alias("sin_relacion_gwh"), F.countDistinct("planta").alias("plantas"))
    w = Window.orderBy("fecha")  # one row per day
    prev = F.lag("energia_gwh").over(w)
    d = d.withColumns({"dia_anterior_gwh": prev, "fecha_maxima": F.max("fecha").over(Window.partitionBy())})
    p, e = F.col("dia_anterior_gwh"), F.col("energia_gwh")
    return d.withColumns({"variacion_gwh": F.round(e - p, 6), "variacion_pct": F.round(F.when(p > 0, 100 * (e - p) / p), 6), "cobertura_pct": F.round(F.when(e > 0, 100 * F.col("directa_gwh") / e), 6)})


def pipeline_health(runs: DataFrame, since: Column | None = None) -> DataFrame:
    """Success flag and moving success rate over the last ten runs, of the runs started at ``since`` or later (the view keeps 90 days,
    which bounds the window)."""
    ok = F.when(F.col("status") == "SUCCESS", 1).otherwise(0)
    w = Window.orderBy("started_at", "run_id").rowsBetween(-9, 0)
    if since is not None:
        runs = runs.where(F.col("started_at") >= since)
    return runs.withColumn("run_exitoso", ok).withColumn("tasa_exito_10_pct", F.round(F.avg(ok).over(w) * 100, 6))


def task_performance(tasks: DataFrame, by: list[str]) -> DataFrame:
    ok = F.when(F.col("status") == "SUCCESS", 1.0).otherwise(0.0)
    return tasks.groupBy(*by).agg(F.count("*").alias("ejecuciones"), F.round(F.avg("duration_seconds"), 2).alias("duracion_promedio"), F.percentile_approx("duration_seconds", 0.95).alias("duracion_p95"), F.max("duration_seconds").alias("duracion_maxima"), F.round(100 * F.avg(ok), 2).alias("tasa_exito_pct"), F.max("finished_at").alias("ultima_ejecucion"))


def latest_row(df: DataFrame, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(1)


def readable(views: dict[str, DataFrame], need_rows: bool) -> dict[str, bool]:
    """Smoke check: each view can be read and, if asked, has rows."""
    return {n: bool(df.limit(1).collect()) or not need_rows for n, df in views.items()}


def current_agents(agents: DataFrame) -> DataFrame:
    return agents.where("es_actual").select("agente_key", "codigo_agente", "nombre_agente", "nombre_agente_normalizado", "actividad_agente")


def plants(dim: DataFrame) -> DataFrame:
    keep = ("planta_key", "codigo_planta", "nombre_planta", "codigo_sic_agente", "tipo_generacion", "cap_efectiva_neta", "es_registro_inferido", "esta_en_maestro_actual")
    return dim.select(*[c for c in keep if c in dim.columns])


def publish(views: dict[str, DataFrame], prefix: str = "", everywhere: bool = False) -> dict[str, str]:
    """Registers each frame as a view of the session, or with ``everywhere`` of the application; returns the names to query."""
    out = {}
    for n, df in views.items():
        (df.createOrReplaceGlobalTempView if everywhere else df.createOrReplaceTempView)(f"{prefix}{n}")
        out[n] = f"global_temp.{prefix}{n}" if everywhere else f"{prefix}{n}"
    return out
