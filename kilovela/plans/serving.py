"""Queries of the serving views, the semantic model's measures and the dimensions behind them, each with its SQL oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilovela.functions import normalize as N
from kilovela.operators import audit
from kilovela.plans import measures as M
from kilovela.plans import views as V
from kilovela.plans.lakehouse import DAILY_SQL, ENERGY_SQL, HOURLY_SQL, PLANT_SQL, RUNS_SQL, SOURCES, TODAY, _calendar, _energy, _FRESH, _gold, _plant_daily, _runs, union_all_freshness, view_demand_market
from kilovela.session import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def reg(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return reg


@query("SELECT agente_key, codigo_agente, nombre_agente, nombre_agente_normalizado, actividad_agente FROM dim_agente WHERE es_actual")
def view_current_agents(spark: SparkSession, d: str) -> DataFrame:
    return V.current_agents(table(spark, d, "dim_agente"))


# Plant dimension: the master and, as inferred members, the codes of generation that the master lacks but for hydro plants.
_DIM_PLANT = """(WITH g AS (SELECT upper(trim(codigo_planta)) AS k, min(CAST(fecha_hora AS DATE)) AS a, max(CAST(fecha_hora AS DATE)) AS b FROM generacion_real GROUP BY 1), m AS (SELECT * FROM plantas WHERE tipo_generacion = 'HIDRAULICA')
  SELECT codigo_planta, nombre_planta, tipo_generacion, cap_efectiva_neta, false AS es_registro_inferido, true AS esta_en_maestro_actual, a AS fecha_primera_observacion, b AS fecha_ultima_observacion FROM m LEFT JOIN g ON k = codigo_planta
  UNION ALL SELECT k, 'RECURSO SIN MAESTRO - ' || k, NULL, NULL, true, false, a, b FROM g WHERE k NOT IN (SELECT codigo_planta FROM m))"""


def dim_plant(spark: SparkSession, d: str) -> DataFrame:
    from kilovela.operators.dimensions import plant_dimension

    m = table(spark, d, "plantas").where("tipo_generacion = 'HIDRAULICA'").select("codigo_planta", "nombre_planta", "tipo_generacion", "cap_efectiva_neta")
    return plant_dimension(m, table(spark, d, "generacion_real"), "codigo_planta", "nombre_planta", "fecha_hora")


@query(f"SELECT * FROM {_DIM_PLANT}")
def plant_dimension(spark: SparkSession, d: str) -> DataFrame:
    """Every master plant with its first and last observation, and inferred members for the rest."""
    return dim_plant(spark, d)


@query(f"SELECT codigo_planta, nombre_planta, tipo_generacion, cap_efectiva_neta, es_registro_inferido, esta_en_maestro_actual FROM {_DIM_PLANT}")
def view_plants(spark: SparkSession, d: str) -> DataFrame:
    return V.plants(dim_plant(spark, d))


_PASS = {
    "operacion_planta_diaria": f"SELECT count(*) FROM {PLANT_SQL}", "demanda_mercado_diaria": "SELECT count(*) FROM (SELECT DISTINCT fecha_key, upper(trim(tipo_mercado)) FROM fact_demanda_real)", "energia_embalsada_diaria": f"SELECT count(DISTINCT fecha) FROM {ENERGY_SQL}",
    "generacion_tecnologia_diaria": f"SELECT count(*) FROM (SELECT DISTINCT fecha_key, coalesce(nullif(trim(tipo_generacion), ''), 'SIN CLASIFICAR') FROM {PLANT_SQL})",
}


@query(" UNION ALL ".join(f"SELECT '{v}' AS vista, ({q}) AS filas" for v, q in _PASS.items()))
def serving_views(spark: SparkSession, d: str) -> DataFrame:
    """The four pass-through views, published as views and read back by SQL."""
    p = _plant_daily(spark, d)
    names = V.publish({"operacion_planta_diaria": p, "demanda_mercado_diaria": view_demand_market(spark, d), "energia_embalsada_diaria": V.stored_energy_daily(_energy(spark, d)), "generacion_tecnologia_diaria": V.by_technology(p)}, prefix="kv_serving_")
    return spark.sql(" union all ".join(f"select '{v}' as vista, count(*) as filas from {n}" for v, n in names.items()))


@query(f"SELECT run_id, status, round(avg(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END) OVER (ORDER BY started_at, run_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) * 100, 6) AS tasa_exito_10_pct FROM {RUNS_SQL} WHERE started_at >= TIMESTAMP '{TODAY}' - INTERVAL 17 DAY")
def pipeline_health_recent(spark: SparkSession, d: str) -> DataFrame:
    """Of the runs since a day only (the tables span a week, so 17 days before the fixed today and not 90)."""
    return V.pipeline_health(_runs(spark, d), F.expr(f"timestamp'{TODAY}' - interval 17 days")).select("run_id", "status", "tasa_exito_10_pct")


_ALERTS = "(SELECT sha256(run_id || '|' || rule_id) AS alert_id, run_id, rule_id, component, severity, CASE WHEN error_count % 3 = 0 THEN 'RESOLVED' ELSE 'OPEN' END AS status, executed_at AS created_at, CASE WHEN error_count % 3 = 0 THEN executed_at + INTERVAL 100 MINUTE END AS resolved_at FROM data_quality_results WHERE NOT passed AND is_blocking)"


def alerts(spark: SparkSession, d: str) -> DataFrame:
    """Alerts of the failed blocking rules; every third error count stands for one that was resolved."""
    q, done = table(spark, d, "data_quality_results").where("not passed and is_blocking"), F.col("error_count") % 3 == 0
    return q.select(F.sha2(F.concat_ws("|", "run_id", "rule_id"), 256).alias("alert_id"), "run_id", "rule_id", "component", "severity", F.when(done, "RESOLVED").otherwise("OPEN").alias("status"), F.col("executed_at").alias("created_at"), F.when(done, F.col("executed_at") + F.expr("interval 100 minutes")).alias("resolved_at"))


@query(f"SELECT alert_id, rule_id, severity, status, created_at, resolved_at, CAST(floor(date_diff('second', created_at, coalesce(resolved_at, TIMESTAMP '{TODAY}')) / 3600) AS BIGINT) AS edad_horas FROM {_ALERTS}")
def quality_alerts(spark: SparkSession, d: str) -> DataFrame:
    a = audit.alert_ages(alerts(spark, d), F.lit(TODAY).cast("timestamp"))
    return a.select("alert_id", "rule_id", "severity", "status", "created_at", "resolved_at", "edad_horas")


@query(f"SELECT alert_id, rule_id, component FROM {_ALERTS} WHERE status = 'OPEN'")
def view_open_alerts(spark: SparkSession, d: str) -> DataFrame:
    return alerts(spark, d).where("status = 'OPEN'").select("alert_id", "rule_id", "component")


# --- measures ---

_KPI = f"(SELECT fecha, CASE WHEN fecha <= corte THEN generacion_gwh END AS g, CASE WHEN fecha <= corte THEN demanda_gwh END AS dm, CASE WHEN fecha <= corte THEN disponibilidad_gwh END AS a, corte FROM (SELECT *, max(CASE WHEN generacion_gwh IS NOT NULL OR demanda_gwh IS NOT NULL THEN fecha END) OVER () AS corte FROM {DAILY_SQL}))"
_D6 = "CAST(sum(CAST({} AS DECIMAL(24,6))) AS DOUBLE)"


def _comparable(spark: SparkSession, d: str) -> DataFrame:
    """Days with a cut at the last day on which generation or demand is known: no day of these tables has all sources complete."""
    day = V.daily_system(V.hourly_system(*_gold(spark, d)))
    cut = F.max(F.when(F.col("generacion_gwh").isNotNull() | F.col("demanda_gwh").isNotNull(), F.col("fecha"))).over(Window.partitionBy())  # one row per day
    x = day.withColumn("fecha_corte", cut)
    return x.withColumns({c: F.when(F.col("fecha") <= F.col("fecha_corte"), F.col(c)) for c in ("generacion_gwh", "demanda_gwh", "disponibilidad_gwh")}).withColumn("anio_mes", F.date_format("fecha", "yyyyMM").cast("int"))


@query(f"""SELECT anio_mes, round(g - dm, 6) AS margen_gwh, round(CASE WHEN dm <> 0 THEN (g - dm) / dm END, 8) AS margen_parte, round(CASE WHEN a <> 0 THEN g / a END * 100, 6) AS utilizacion_pct, round(g / 1000, 9) AS generacion_twh, round(dm / 1000, 9) AS demanda_twh, round(a / 1000, 9) AS disponibilidad_twh, fecha_corte
  FROM (SELECT CAST(strftime(fecha, '%Y%m') AS INT) AS anio_mes, {_D6.format('g')} AS g, {_D6.format('dm')} AS dm, {_D6.format('a')} AS a, max(corte) AS fecha_corte FROM {_KPI} GROUP BY 1)""")
def measure_system(spark: SparkSession, d: str) -> DataFrame:
    return M.system(_comparable(spark, d), ["anio_mes"], "generacion_gwh", "demanda_gwh", "disponibilidad_gwh", "fecha_corte")


@query(f"""SELECT planta_key, round(coalesce(g, 0), 6) AS generacion_gwh, round(coalesce(g, 0) / 1000, 9) AS generacion_twh, round(CASE WHEN a <> 0 THEN g / a END, 8) AS utilizacion, n AS plantas_activas
  FROM (SELECT planta_key, {_D6.format('generacion_gwh')} AS g, {_D6.format('disponibilidad_gwh')} AS a, count(DISTINCT CASE WHEN horas_generacion > 0 THEN planta_key END) AS n FROM {PLANT_SQL} GROUP BY 1)""")
def measure_plants(spark: SparkSession, d: str) -> DataFrame:
    return M.plants(_plant_daily(spark, d), ["planta_key"])


@query(f"SELECT tipo_generacion, round(CASE WHEN a <> 0 THEN g / a END, 8) AS utilizacion, n AS plantas_activas FROM (SELECT tipo_generacion, {_D6.format('generacion_gwh')} AS g, {_D6.format('disponibilidad_gwh')} AS a, count(DISTINCT CASE WHEN horas_generacion > 0 THEN planta_key END) AS n FROM {PLANT_SQL} GROUP BY 1)")
def measure_active_plants(spark: SparkSession, d: str) -> DataFrame:
    return M.plants(_plant_daily(spark, d), ["tipo_generacion"]).select("tipo_generacion", "utilizacion", "plantas_activas")


@query(f"SELECT fecha_key, tipo_generacion, CASE WHEN h > 0 THEN round(g, 6) END AS generacion_gwh FROM (SELECT fecha_key, tipo_generacion, {_D6.format('generacion_gwh')} AS g, sum(horas_generacion) AS h FROM {PLANT_SQL} GROUP BY 1, 2)")
def measure_daily_generation(spark: SparkSession, d: str) -> DataFrame:
    return M.daily_or_blank(_plant_daily(spark, d), ["fecha_key", "tipo_generacion"])


_SRC = f"(SELECT *, date_diff('day', fecha_maxima, DATE '{TODAY}') AS r FROM ({' UNION ALL '.join(_FRESH.format(n=n, c=c) for n, c in SOURCES.items())}))"


@query(f"SELECT (SELECT count(*) FROM {_ALERTS} WHERE status = 'OPEN') AS alertas_abiertas, (SELECT max(r) FROM {_SRC}) AS mayor_rezago, (SELECT round(100.0 * count(*) FILTER (WHERE r <= 45) / count(*), 6) FROM {_SRC}) AS cumplimiento_pct, (SELECT round(avg(date_diff('second', started_at, finished_at)), 6) FROM {RUNS_SQL}) AS duracion_media")
def measure_health(spark: SparkSession, d: str) -> DataFrame:
    t = _runs(spark, d).withColumn("duration_seconds", F.unix_timestamp("finished_at") - F.unix_timestamp("started_at"))
    return M.health(alerts(spark, d), union_all_freshness(spark, d), t)


@query(f"""SELECT tipo_mercado, CAST(sum(x) AS DOUBLE) AS demanda_gwh, round(CAST(sum(x) AS DOUBLE) / 1000, 9) AS demanda_twh, round(avg(CAST(x AS DOUBLE)), 6) AS media_diaria_gwh, max(p) AS pico_mw FROM
  (SELECT fecha_key, upper(trim(tipo_mercado)) AS tipo_mercado, CAST(round(CAST(sum(demanda_real_kwh) AS DOUBLE) / 1000000, 3) AS DECIMAL(24,6)) AS x, round(CAST(max(demanda_real_kwh) AS DOUBLE) / 1000, 3) AS p FROM fact_demanda_real GROUP BY 1, 2) GROUP BY 1""")
def measure_market(spark: SparkSession, d: str) -> DataFrame:
    return M.market(view_demand_market(spark, d), ["tipo_mercado"])


@query(f"""SELECT round(sum(v), 6) AS variacion_gwh, round(avg(c), 6) AS cobertura_media_pct FROM (SELECT round(e - lag(e) OVER (ORDER BY fecha), 6) AS v, round(CASE WHEN e > 0 THEN 100 * u / e END, 6) AS c FROM
  (SELECT fecha, CAST(sum(CAST(energia_gwh AS DECIMAL(24,6))) AS DOUBLE) AS e, CAST(sum(CASE WHEN estado_relacion = 'RELACION UNICA' THEN CAST(energia_gwh AS DECIMAL(24,6)) ELSE 0 END) AS DOUBLE) AS u FROM {ENERGY_SQL} GROUP BY 1))""")
def measure_energy_change(spark: SparkSession, d: str) -> DataFrame:
    return M.energy_change(V.stored_energy_daily(_energy(spark, d)))


_DAYS = [("fact_generacion_real", "fecha_hora"), ("fact_demanda_real", "fecha_hora"), ("precio_bolsa", "fecha_hora"), ("niveles_embalses", "fecha_inicio"), ("generacion_real", "fecha_hora")]


@query(f"""SELECT CAST(f AS DATE) AS fecha, year(f) AS anio, month(f) AS mes_numero, strftime(f, '%Y-%m') AS anio_mes, 'T' || quarter(f) AS trimestre, isodow(f) AS dia_semana FROM
  (SELECT unnest(generate_series(min(x)::TIMESTAMP, max(x)::TIMESTAMP, INTERVAL 1 DAY)) AS f FROM ({' UNION '.join(f'SELECT CAST({c} AS DATE) AS x FROM {t}' for t, c in _DAYS)}))""")
def model_calendar(spark: SparkSession, d: str) -> DataFrame:
    return M.spanning_calendar([table(spark, d, t).select(F.to_date(c).alias("fecha")) for t, c in _DAYS], "fecha")


_RELS = [("generacion_agente", "fact_generacion_real", "agente_key", "dim_agente", "agente_key"), ("demanda_agente", "fact_demanda_real", "agente_key", "dim_agente", "agente_key"), ("respuesta_pregunta", "documents", "parent_id", "documents", "doc_id"), ("relacion_embalse", "plantas_reservorios", "codigo_embalse", "embalses", "codigo_embalse"), ("agente_codigo", "agentes", "codigo_agente", "dim_agente", "codigo_agente")]


@query(" UNION ALL ".join(f"SELECT '{n}' AS relacion, count(*) AS filas, count(*) FILTER (WHERE {a} IS NULL OR {a} NOT IN (SELECT {b} FROM {o} WHERE {b} IS NOT NULL)) AS sin_pareja, (SELECT count(*) FROM (SELECT {b} FROM {o} WHERE {b} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS claves_repetidas FROM {m}" for n, m, a, o, b in _RELS))
def model_relationships(spark: SparkSession, d: str) -> DataFrame:
    """The model's many-to-one relations: rows without a partner, and keys that are not unique on the one side."""
    return M.relationships([(n, table(spark, d, m), a, table(spark, d, o), b) for n, m, a, o, b in _RELS])


@query(f"SELECT fecha, generacion_kwh, dias FROM (SELECT fecha, CAST(sum(generacion_real_kwh) AS DOUBLE) AS generacion_kwh, count(DISTINCT periodo) AS dias FROM {HOURLY_SQL} WHERE generacion_real_kwh IS NOT NULL GROUP BY 1) ORDER BY generacion_kwh DESC, fecha LIMIT 10")
def rank_days(spark: SparkSession, d: str) -> DataFrame:
    """Ten days of highest generation."""
    h = V.hourly_system(*_gold(spark, d)).where("generacion_real_kwh is not null")
    return h.groupBy("fecha").agg(F.sum("generacion_real_kwh").cast("double").alias("generacion_kwh"), F.countDistinct("periodo").alias("dias")).orderBy(F.desc("generacion_kwh"), "fecha").limit(10)


@query("""SELECT CAST(fecha_hora AS DATE) AS fecha, codigo_variable, count(valor) AS n, round(avg(valor), 6) AS media, min(valor) AS minimo, max(valor) AS maximo FROM (SELECT fecha_hora, upper(trim(codigo_variable)) AS codigo_variable, CASE WHEN NOT isnan(valor) THEN valor END AS valor FROM precio_bolsa) GROUP BY 1, 2""")
def daily_price_stats(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "precio_bolsa").select(F.to_date("fecha_hora").alias("fecha"), N.code("codigo_variable").alias("codigo_variable"), N.number("valor").alias("valor"))
    return p.groupBy("fecha", "codigo_variable").agg(F.count("valor").alias("n"), F.round(F.avg("valor"), 6).alias("media"), F.min("valor").alias("minimo"), F.max("valor").alias("maximo"))


@query(f"""SELECT planta_key, count(*) AS dias, count(*) FILTER (WHERE generacion_gwh * 1000 > cap_efectiva_neta * 24 * 1.05) AS dias_sobre_capacidad, round(max(CASE WHEN cap_efectiva_neta > 0 THEN generacion_gwh * 1000 / (cap_efectiva_neta * 24) END), 8) AS mayor_factor FROM {PLANT_SQL} WHERE generacion_gwh IS NOT NULL GROUP BY 1""")
def generation_over_capacity(spark: SparkSession, d: str) -> DataFrame:
    """Days on which a plant gave more than its capacity allows, with a tolerance of 1.05."""
    return M.over_capacity(_plant_daily(spark, d), "planta_key", "generacion_gwh", "cap_efectiva_neta")


@query("SELECT CAST(strftime(f, '%Y%m%d') AS INT) AS fecha_key, month(f) AS mes_numero FROM (SELECT unnest(generate_series(make_date(year(min(fecha_inicio)), 1, 1)::TIMESTAMP, make_date(year(max(fecha_inicio)) + 2, 12, 31)::TIMESTAMP, INTERVAL 1 DAY)) AS f FROM niveles_embalses)")
def calendar_merge(spark: SparkSession, d: str) -> DataFrame:
    """The calendar merged twice into an empty table: the second merge changes nothing."""
    from kilovela.operators import merge

    c = _calendar(table(spark, d, "niveles_embalses"), "fecha_inicio").select("fecha_key", "mes_numero")
    once = merge.apply(merge.plan(c.limit(0), c, ["fecha_key"], ["mes_numero"]), c.limit(0), ["mes_numero"], F.current_timestamp())
    return merge.apply(merge.plan(once, c, ["fecha_key"], ["mes_numero"]), once, ["mes_numero"], F.current_timestamp())
