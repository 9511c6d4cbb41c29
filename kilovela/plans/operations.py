"""Queries of loaders, facts, audit, governance, inventories and the edge sources, each with its SQL oracle."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilovela.functions import normalize as N
from kilovela.operators import audit, facts, governance, loaders, merge, quality, versioning
from kilovela.operators import dimensions as D
from kilovela.operators import exploration as X
from kilovela.plans import serving
from kilovela.plans.lakehouse import APPROVED, GEN, GEN_SQL, PRICE, PRICE_SQL, TODAY, P, _canonical, _dec, _runs
from kilovela.session import shared_dir, table
from kilovela.sources import landing as L

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def reg(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return reg


NOW = f"timestamp'{TODAY} 00:00:00'"

# --- facts ---

# Validity of agent versions by their trusted columns: from fecha_inicio to the day before the next one's.
_AGENTS = "(SELECT agente_key, upper(trim(codigo_agente)) AS codigo_agente, fecha_inicio AS a, coalesce(CAST(lead(fecha_inicio) OVER (PARTITION BY upper(trim(codigo_agente)) ORDER BY fecha_inicio, agente_key) - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS b FROM dim_agente)"


def _agents(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    a = table(spark, d, "dim_agente").select("agente_key", N.code("codigo_agente").alias("codigo_agente"), "fecha_inicio")
    nxt = F.lead("fecha_inicio").over(Window.partitionBy("codigo_agente").orderBy("fecha_inicio", "agente_key"))
    return a.withColumn("fecha_fin", F.coalesce(F.date_sub(nxt, 1), F.to_date(F.lit("9999-12-31"))))


def _plant_keys(spark: SparkSession, d: str) -> DataFrame:
    none = table(spark, d, "plantas").select("codigo_planta", F.lit(0).cast("long").alias("planta_key")).limit(0)
    return merge.surrogate_keys(table(spark, d, "plantas"), none, ["codigo_planta"], "planta_key")


_PLANTS = "(SELECT codigo_planta, row_number() OVER (ORDER BY codigo_planta) AS planta_key FROM plantas)"


@query(f"""SELECT codigo_planta, codigo_agente, fecha_hora, planta_key, agente_key, valor, version_seleccionada FROM (SELECT g.*, p.planta_key, x.agente_key, sha256('GREAL||PT1H||KWH||' || g.codigo_agente || '||' || g.codigo_planta || '||' || strftime(fecha_hora, '%Y-%m-%d %H:%M:%S')) AS k
  FROM (SELECT codigo_planta, codigo_agente, fecha_hora, CAST(CAST(valor AS DECIMAL(24,6)) AS DOUBLE) AS valor, version_seleccionada FROM ({GEN_SQL})) g LEFT JOIN {_PLANTS} p USING (codigo_planta) LEFT JOIN {_AGENTS} x ON g.codigo_agente = x.codigo_agente AND CAST(g.fecha_hora AS DATE) BETWEEN x.a AND x.b)""")
def fact_generation_scd2(spark: SparkSession, d: str) -> DataFrame:
    """Generation with the plant's key and the key of the agent's version valid on the day."""
    g = facts.build(table(spark, d, "generacion_real"), GEN, _plant_keys(spark, d), _agents(spark, d), keep=("codigo_planta", "codigo_agente"))
    return g.select("codigo_planta", "codigo_agente", "fecha_hora", "planta_key", "agente_key", F.col("valor").cast("double").alias("valor"), "version_seleccionada")


AVAIL = facts.FactSpec("disponibilidad", ("codigo_variable", "codigo_duracion", "unidad_medida", "codigo_planta"), "fecha_hora", "valor", {"codigo_variable": "DISPREAL", "codigo_duracion": "PT1H", "unidad_medida": "KWH"}, tie=("registro_id",))
_AV = f"""SELECT codigo_planta, fecha_hora, valor, ver, p FROM (SELECT *, row_number() OVER (PARTITION BY codigo_planta, fecha_hora ORDER BY p DESC, silver_updated_at DESC NULLS LAST, ingestion_timestamp DESC NULLS LAST, load_date DESC NULLS LAST, ver DESC NULLS LAST, registro_id DESC) AS rn
  FROM (SELECT * REPLACE (upper(trim(codigo_planta)) AS codigo_planta), upper(trim(version)) AS ver, {P} AS p FROM generacion_real WHERE upper(trim(codigo_variable)) = 'GREAL' AND upper(trim(codigo_duracion)) = 'PT1H' AND upper(trim(unidad_medida)) = 'KWH')) WHERE rn = 1"""


@query(f"SELECT codigo_planta, fecha_hora, CAST(strftime(fecha_hora, '%Y%m%d') AS INT) AS fecha_key, CAST(hour(fecha_hora) + 1 AS INT) AS periodo_key, planta_key, CAST(CAST(valor AS DECIMAL(24,6)) AS DOUBLE) AS valor, ver AS version_seleccionada, p AS prioridad_version FROM ({_AV}) LEFT JOIN {_PLANTS} USING (codigo_planta)")
def fact_availability(spark: SparkSession, d: str) -> DataFrame:
    """Availability: one row per plant and hour. The tables have no availability; generation readings under its variable stand for it."""
    raw = table(spark, d, "generacion_real").withColumn("codigo_variable", F.when(N.code("codigo_variable") == "GREAL", "DispReal").otherwise(F.col("codigo_variable")))
    return facts.build(raw, AVAIL, _plant_keys(spark, d), keep=("codigo_planta",)).select("codigo_planta", "fecha_hora", "fecha_key", "periodo_key", "planta_key", F.col("valor").cast("double").alias("valor"), "version_seleccionada", "prioridad_version")


DEMAND = facts.FactSpec("demanda", ("codigo_duracion", "unidad_medida", "codigo_agente", "tipo_mercado"), "fecha_hora", "valor", {"codigo_duracion": "PT1H", "unidad_medida": "KWH"}, recency=("ingestion_timestamp",), tie=("demanda_key", "_v"))


@query(f"""SELECT d.codigo_agente, tipo_mercado, fecha_hora, x.agente_key, v AS valor, ver AS version_seleccionada FROM (SELECT *, row_number() OVER (PARTITION BY codigo_agente, tipo_mercado, fecha_hora ORDER BY p DESC, fecha_actualizacion DESC NULLS LAST, ver DESC NULLS LAST, demanda_key DESC, v DESC NULLS LAST) AS rn
  FROM (SELECT upper(trim(a.codigo_agente)) AS codigo_agente, upper(trim(tipo_mercado)) AS tipo_mercado, date_trunc('hour', fecha_hora) AS fecha_hora, CAST(demanda_real_kwh AS DOUBLE) AS v, demanda_key, d.fecha_actualizacion, upper(trim(version_seleccionada)) AS ver, {P.replace('version', 'version_seleccionada')} AS p FROM fact_demanda_real d JOIN dim_agente a USING (agente_key))) d
  LEFT JOIN {_AGENTS} x ON d.codigo_agente = x.codigo_agente AND CAST(d.fecha_hora AS DATE) BETWEEN x.a AND x.b WHERE rn = 1""")
def fact_demand(spark: SparkSession, d: str) -> DataFrame:
    """Demand by agent, market and hour: the stored readings decoded to their natural codes and loaded again."""
    a = table(spark, d, "dim_agente").select("agente_key", "codigo_agente")
    raw = table(spark, d, "fact_demanda_real").join(a, "agente_key").select("codigo_agente", "tipo_mercado", F.date_trunc("hour", "fecha_hora").alias("fecha_hora"), F.col("demanda_real_kwh").alias("valor"), F.col("demanda_real_kwh").cast("double").alias("_v"), F.col("version_seleccionada").alias("version"), "demanda_key", F.col("fecha_actualizacion").alias("ingestion_timestamp"), F.lit("PT1H").alias("codigo_duracion"), F.lit("kWh").alias("unidad_medida"))
    f = facts.build(raw, DEMAND, agents=_agents(spark, d), keep=("codigo_agente", "tipo_mercado"))
    return f.select("codigo_agente", "tipo_mercado", "fecha_hora", "agente_key", F.col("valor").cast("double").alias("valor"), "version_seleccionada")


@query(f"""SELECT CAST(strftime(fecha_hora, '%Y%m%d') AS INT) AS fecha_key, CAST(hour(fecha_hora) + 1 AS INT) AS periodo_key, fecha_hora, max(CASE WHEN codigo_variable = 'PB_NAL' THEN valor END) AS nacional, max(CASE WHEN codigo_variable = 'PB_INT' THEN valor END) AS internacional, max(CASE WHEN codigo_variable = 'PB_TIE' THEN valor END) AS tie,
  max(CASE WHEN codigo_variable = 'PB_TIE' THEN version_seleccionada END) AS tie_version FROM ({PRICE_SQL}) GROUP BY ALL HAVING count(DISTINCT CASE WHEN codigo_variable IN ('PB_NAL', 'PB_INT', 'PB_TIE') THEN codigo_variable END) = 3""")
def fact_price(spark: SparkSession, d: str) -> DataFrame:
    """Wide price fact of the hours for which all three variables are there."""
    r = _canonical(spark, d, "precio_bolsa", PRICE).withColumnRenamed("version_seleccionada", "version")
    w = facts.pivot_variables(r, ["fecha_hora"], "codigo_variable", "valor", {"PB_Nal": "nacional", "PB_Int": "internacional", "PB_Tie": "tie"}).where("completo")
    return w.select(F.date_format("fecha_hora", "yyyyMMdd").cast("int").alias("fecha_key"), (F.hour("fecha_hora") + 1).cast("int").alias("periodo_key"), "fecha_hora", "nacional", "internacional", "tie", "tie_version")


@query("SELECT codigo_agente, tipo_mercado, CAST(sum(CAST(demanda_real_kwh AS DECIMAL(24,6))) AS DOUBLE) AS kwh, count(*) AS filas FROM fact_demanda_real JOIN dim_agente USING (agente_key) GROUP BY 1, 2")
def decode_join(spark: SparkSession, d: str) -> DataFrame:
    """Fact keys back to natural codes (inner join), then totals."""
    j = table(spark, d, "fact_demanda_real").join(table(spark, d, "dim_agente").select("agente_key", "codigo_agente"), "agente_key")
    return j.groupBy("codigo_agente", "tipo_mercado").agg(F.sum(_dec("demanda_real_kwh")).cast("double").alias("kwh"), F.count("*").alias("filas"))


# --- loaders ---

SILVER_GEN = loaders.Load(["codigo_variable", "fecha_hora", "codigo_duracion", "unidad_medida", "codigo_agente", "codigo_planta", "version"], ["codigo_variable", "codigo_duracion", "unidad_medida", "codigo_agente", "codigo_planta", "version"], typed=("fecha_hora",), payload=["valor"])
SPLIT = "2026-06-12"


def _empty(df: DataFrame) -> DataFrame:
    return df.limit(0)


_GK = "codigo_variable, fecha_hora, codigo_duracion, unidad_medida, codigo_agente, codigo_planta, version"
_GCLEAN = "(SELECT upper(trim(codigo_variable)) AS codigo_variable, fecha_hora, upper(trim(codigo_duracion)) AS codigo_duracion, upper(trim(unidad_medida)) AS unidad_medida, upper(trim(codigo_agente)) AS codigo_agente, upper(trim(codigo_planta)) AS codigo_planta, upper(trim(version)) AS version, valor, ingestion_timestamp, load_date, registro_id FROM generacion_real)"
_GOK = "fecha_hora IS NOT NULL AND codigo_variable <> '' AND codigo_duracion <> '' AND unidad_medida <> '' AND codigo_agente <> '' AND codigo_planta <> '' AND version <> ''"
_GPICK = lambda where: f"(SELECT * FROM {_GCLEAN} WHERE {_GOK} AND {where} QUALIFY row_number() OVER (PARTITION BY {_GK} ORDER BY ingestion_timestamp DESC NULLS LAST, load_date DESC NULLS LAST, registro_id DESC) = 1)"


@query(f"""WITH old AS {_GPICK(f"load_date < DATE '{SPLIT}'")}, hw AS (SELECT max(ingestion_timestamp) AS m FROM old), new AS {_GPICK("((SELECT m FROM hw) IS NULL OR ingestion_timestamp >= (SELECT m FROM hw))")}
  SELECT coalesce(n.codigo_planta, o.codigo_planta) AS codigo_planta, coalesce(n.codigo_agente, o.codigo_agente) AS codigo_agente, coalesce(n.fecha_hora, o.fecha_hora) AS fecha_hora, coalesce(n.version, o.version) AS version, coalesce(n.codigo_variable, o.codigo_variable) AS codigo_variable, coalesce(n.unidad_medida, o.unidad_medida) AS unidad_medida, coalesce(n.codigo_duracion, o.codigo_duracion) AS codigo_duracion,
    CASE WHEN n.fecha_hora IS NOT NULL THEN n.valor ELSE o.valor END AS valor, coalesce(n.codigo_planta, o.codigo_planta) IN (SELECT codigo_planta FROM plantas) AS planta_encontrada, CASE WHEN o.fecha_hora IS NULL THEN TIMESTAMP '{TODAY}' ELSE TIMESTAMP '2026-06-12' END AS silver_created_at
  FROM old o FULL JOIN new n USING ({_GK})""")
def silver_generation_load(spark: SparkSession, d: str) -> DataFrame:
    """Two runs of the fact loader: a first load into an empty table, then everything from its high-water mark on."""
    g, p = table(spark, d, "generacion_real"), table(spark, d, "plantas")
    refs = {"planta_encontrada": (p, "codigo_planta", "codigo_planta")}
    shape = g.select(*SILVER_GEN.key, "valor", "planta_encontrada", *loaders.LINEAGE, "silver_created_at", "silver_updated_at").limit(0)
    first, _ = loaders.load(g.where(f"load_date < date'{SPLIT}'"), shape, SILVER_GEN, F.expr(f"timestamp'{SPLIT} 00:00:00'"), refs, strict=False)
    second, _ = loaders.load(g, _staged(first), SILVER_GEN, F.expr(NOW), refs, strict=False)
    return second.select(*SILVER_GEN.key, "valor", "planta_encontrada", "silver_created_at")


def _staged(df: DataFrame) -> DataFrame:
    from kilovela.session import stage

    return stage(df, "silver")


AGENTS = loaders.Load(["fecha", "codigo_duracion", "codigo_agente"], ["codigo_duracion", "codigo_agente"], ["nombre_agente", "actividad_agente"], typed=("fecha",), payload=["nombre_agente", "actividad_agente"])
RESERVOIRS = loaders.Load(["codigo_embalse"], ["codigo_embalse"], ["nombre_embalse"], payload=["nombre_embalse", "latitud", "longitud"], tie="source_file_name")
PLANTS = loaders.Load(["codigo_planta"], ["codigo_planta", "codigo_sic_agente"], ["nombre_planta"], payload=["nombre_planta", "codigo_sic_agente", "cap_efectiva_neta", "fpo", "tipo_generacion"], recency=("fecha",), tie="codigo_planta")
_NAME = "nullif(upper(trim(regexp_replace({}, '\\s+', ' ', 'g'))), '')"


@query(f"""SELECT fecha, codigo_duracion, codigo_agente, nombre_agente, actividad_agente FROM (SELECT fecha, upper(trim(codigo_duracion)) AS codigo_duracion, upper(trim(codigo_agente)) AS codigo_agente, {_NAME.format('nombre_agente')} AS nombre_agente, {_NAME.format('actividad_agente')} AS actividad_agente, ingestion_timestamp, load_date, registro_id FROM agentes)
  WHERE fecha IS NOT NULL AND codigo_duracion <> '' AND codigo_agente <> '' QUALIFY row_number() OVER (PARTITION BY fecha, codigo_duracion, codigo_agente ORDER BY ingestion_timestamp DESC NULLS LAST, load_date DESC NULLS LAST, registro_id DESC) = 1""")
def silver_agents(spark: SparkSession, d: str) -> DataFrame:
    return loaders.incoming(table(spark, d, "agentes"), None, AGENTS, strict=False).select(*AGENTS.key, *AGENTS.payload)


@query(f"""SELECT upper(trim(codigo_embalse)) AS codigo_embalse, {_NAME.format('nombre_embalse')} AS nombre_embalse, latitud, longitud FROM embalses WHERE trim(codigo_embalse) <> ''
  QUALIFY row_number() OVER (PARTITION BY upper(trim(codigo_embalse)) ORDER BY ingestion_timestamp DESC NULLS LAST, load_date DESC NULLS LAST, source_file_name DESC) = 1""")
def silver_reservoirs(spark: SparkSession, d: str) -> DataFrame:
    return loaders.incoming(table(spark, d, "embalses"), None, RESERVOIRS).select(*RESERVOIRS.key, *RESERVOIRS.payload)


@query(f"SELECT upper(trim(codigo_planta)) AS codigo_planta, {_NAME.format('nombre_planta')} AS nombre_planta, nullif(upper(trim(codigo_sic_agente)), '') AS codigo_sic_agente, cap_efectiva_neta, fpo, tipo_generacion FROM plantas WHERE trim(codigo_planta) <> '' QUALIFY row_number() OVER (PARTITION BY upper(trim(codigo_planta)) ORDER BY fecha DESC NULLS LAST) = 1")
def silver_plants(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "plantas").withColumn("ingestion_timestamp", F.col("fecha").cast("timestamp"))
    return loaders.incoming(p, None, PLANTS).select(*PLANTS.key, *PLANTS.payload)


_KEY = lambda c: f"regexp_replace(translate({c}, 'ÁÉÍÓÚÜÑ', 'AEIOUUN'), '[^A-Z0-9]+', '', 'g')"
_ALIAS = f"(SELECT {_KEY('upper(nombre_embalse)')} || 'X' AS e, codigo_embalse AS code FROM embalses WHERE latitud > 0)"


def _aliases(spark: SparkSession, d: str) -> DataFrame:
    """Aliases of the reservoirs north of the equator: their name with an X behind it, approved and open; those of the others are not."""
    e = table(spark, d, "embalses")
    ok = F.coalesce(F.col("latitud") > 0, F.lit(False))
    return e.select(F.lit("EMBALSE").alias("entity_type"), F.concat(N.match_key("nombre_embalse"), F.lit("X")).alias("alias_normalized"), F.col("codigo_embalse").alias("canonical_code"), F.when(ok, "APPROVED").otherwise("PROPOSED").alias("status"), F.lit("2020-01-01").cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))


@query(f"""WITH r AS (SELECT {_NAME.format('nombre_planta')} AS nombre_planta, upper(trim(regexp_replace(nombre_reservorio || CASE WHEN relacion_id % 2 = 0 THEN 'X' ELSE '' END, '\\s+', ' ', 'g'))) AS nombre_reservorio, lower(trim(estado_validacion)) AS ev, ingestion_timestamp, load_date, relacion_id FROM plantas_reservorios),
  u AS (SELECT * FROM r WHERE nombre_planta <> '' AND nombre_reservorio <> '' QUALIFY row_number() OVER (PARTITION BY nombre_planta, nombre_reservorio ORDER BY ingestion_timestamp DESC NULLS LAST, load_date DESC NULLS LAST, relacion_id DESC) = 1),
  p AS (SELECT {_KEY('upper(nombre_planta)')} AS k, min(codigo_planta) AS c, count(*) > 1 AS m FROM plantas GROUP BY 1), e AS (SELECT {_KEY('upper(nombre_embalse)')} AS k, min(codigo_embalse) AS c, count(*) > 1 AS m FROM embalses GROUP BY 1), a AS (SELECT e AS k, min(code) AS c, count(*) > 1 AS m FROM {_ALIAS} GROUP BY 1)
  SELECT nombre_planta, nombre_reservorio, p.c AS codigo_planta, coalesce(e.c, a.c) AS codigo_embalse, p.c IS NOT NULL AND coalesce(e.c, a.c) IS NOT NULL AS relacion_completa, coalesce(p.m, false) OR coalesce(e.m, false) OR coalesce(a.m, false) OR coalesce(e.c <> a.c, false) AS ambigua
  FROM u LEFT JOIN p ON p.k = {_KEY('nombre_planta')} LEFT JOIN e ON e.k = {_KEY('nombre_reservorio')} LEFT JOIN a ON a.k = {_KEY('nombre_reservorio')}""")
def resolve_relations(spark: SparkSession, d: str) -> DataFrame:
    """Relations by plant name and by reservoir name or alias; every second typed name gets an X to meet the aliases."""
    r = table(spark, d, "plantas_reservorios").withColumn("nombre_reservorio", F.concat("nombre_reservorio", F.when(F.col("relacion_id") % 2 == 0, "X").otherwise("")))
    x = governance.resolve_relations(r, table(spark, d, "plantas"), table(spark, d, "embalses"), _aliases(spark, d), F.to_date(F.lit(TODAY)), APPROVED, "relacion_id")
    return x.select("nombre_planta", "nombre_reservorio", "codigo_planta", "codigo_embalse", "relacion_completa", "ambigua")


# --- governance, audit ---


@query(f"SELECT count(*) AS plantas, count(*) FILTER (WHERE es_registro_inferido AND esta_en_maestro_actual) AS inferida_y_oficial, count(*) FILTER (WHERE es_registro_inferido AND (a IS NULL OR b IS NULL)) AS inferida_sin_fechas, count(*) FILTER (WHERE b < a) AS rango_invalido FROM (SELECT es_registro_inferido, esta_en_maestro_actual OR cap_efectiva_neta IS NULL AS esta_en_maestro_actual, CASE WHEN length(nombre_planta) % 2 = 0 THEN fecha_primera_observacion END AS a, CAST(fecha_ultima_observacion - INTERVAL (length(nombre_planta)) DAY AS DATE) AS b FROM {serving._DIM_PLANT})")
def plant_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Of a plant dimension that was damaged on purpose in all four ways."""
    n = F.length("nombre_planta")
    p = serving.dim_plant(spark, d).withColumns({"esta_en_maestro_actual": F.col("esta_en_maestro_actual") | F.col("cap_efectiva_neta").isNull(), "fecha_primera_observacion": F.when(n % 2 == 0, F.col("fecha_primera_observacion")), "fecha_ultima_observacion": F.date_sub("fecha_ultima_observacion", n)})
    return governance.plant_invariants(p)


_BR = "(SELECT codigo_planta AS planta_key, codigo_embalse AS embalse_key, activo, requiere_revision_manual, valido_desde, valido_hasta FROM plantas_reservorios)"
_OV = "SELECT count(*) FROM (SELECT fecha_inicio, max(coalesce(fecha_fin, DATE '9999-12-31')) OVER (PARTITION BY codigo_agente ORDER BY fecha_inicio, coalesce(fecha_fin, DATE '9999-12-31') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM dim_agente) WHERE fecha_inicio <= b"


@query(f"""SELECT 'alias_duplicados' AS control, (SELECT count(*) FROM (SELECT e FROM (SELECT * FROM {_ALIAS} UNION ALL SELECT * FROM {_ALIAS} WHERE code LIKE '%7') GROUP BY 1 HAVING count(*) > 1)) AS errores UNION ALL SELECT 'solapamientos_scd2', ({_OV}) UNION ALL SELECT 'sin_version_actual_unica', (SELECT count(*) FROM (SELECT codigo_agente FROM dim_agente GROUP BY 1 HAVING count(*) FILTER (WHERE es_actual) <> 1))
  UNION ALL SELECT 'inferidos_oficiales', (SELECT count(*) FROM {serving._DIM_PLANT} WHERE es_registro_inferido AND esta_en_maestro_actual) UNION ALL SELECT 'relaciones_invalidas', (SELECT count(*) FROM {_BR} WHERE activo AND (planta_key IS NULL OR embalse_key IS NULL OR requiere_revision_manual OR valido_hasta < valido_desde))""")
def governance_gate(spark: SparkSession, d: str) -> DataFrame:
    a = _aliases(spark, d)
    bridge = table(spark, d, "plantas_reservorios").select(F.col("codigo_planta").alias("planta_key"), F.col("codigo_embalse").alias("embalse_key"), "activo", "requiere_revision_manual", "valido_desde", "valido_hasta")
    return governance.gate(a.unionByName(a.where("canonical_code like '%7'")), table(spark, d, "dim_agente"), serving.dim_plant(spark, d), bridge)


_TASKS = "(SELECT run_id, component || '.' || rule_id AS task_key, CASE WHEN passed THEN 'SUCCESS' ELSE 'FAILED' END AS status, executed_at AS finished_at FROM data_quality_results)"


def _tasks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "data_quality_results").select("run_id", F.concat_ws(".", "component", "rule_id").alias("task_key"), F.when(F.col("passed"), "SUCCESS").otherwise("FAILED").alias("status"), F.col("executed_at").alias("finished_at"))


@query(f"""SELECT r.run_id, CASE WHEN bad > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status, finished_at, round((epoch_us(finished_at) - epoch_us(started_at)) / 1e6, 3) AS duration_seconds, n AS tasks_total, ok AS tasks_succeeded, bad AS tasks_failed FROM
  (SELECT run_id, min(executed_at) AS started_at FROM data_quality_results GROUP BY 1) r JOIN (SELECT run_id, count(*) AS n, count(*) FILTER (WHERE status = 'SUCCESS') AS ok, count(*) FILTER (WHERE status = 'FAILED') AS bad, max(finished_at) AS finished_at FROM {_TASKS} GROUP BY 1) t USING (run_id)""")
def run_audit(spark: SparkSession, d: str) -> DataFrame:
    """Runs entered as started (twice, which changes nothing) and closed from their tasks."""
    s = _runs(spark, d).select("run_id", F.lit("calidad").alias("job_name"), "started_at")
    shape = s.select("run_id", "job_name", "started_at", F.lit("").alias("status"), F.lit(None).cast("timestamp").alias("finished_at"), F.lit(None).cast("double").alias("duration_seconds"), F.lit(None).cast("timestamp").alias("created_at")).limit(0)
    started = audit.runs_started(audit.runs_started(shape, s, F.expr(NOW)), s, F.expr(NOW))
    return audit.runs_finished(started, _tasks(spark, d), F.expr(NOW)).select("run_id", "status", "finished_at", F.round("duration_seconds", 3).alias("duration_seconds"), "tasks_total", "tasks_succeeded", "tasks_failed")


@query(f"SELECT run_id, task_key, status, finished_at FROM {_TASKS}")
def task_audit(spark: SparkSession, d: str) -> DataFrame:
    """Tasks upserted as running, then with their outcome."""
    t = _tasks(spark, d)
    running = audit.task_upsert(t.limit(0), t.withColumns({"status": F.lit("RUNNING"), "finished_at": F.lit(None).cast("timestamp")}), F.expr(NOW))
    return audit.task_upsert(running, t, F.expr(NOW))


_LAYERS = [("agentes", "silver", "fecha"), ("generacion_real", "silver", "fecha_hora"), ("fact_generacion_real", "gold", "fecha_hora"), ("fact_demanda_real", "gold", "fecha_hora")]
_LM = f"""(SELECT *, coalesce(x.n, 0) AS rows_rejected, epoch(TIMESTAMP '{TODAY}')::BIGINT - epoch(max_event_time)::BIGINT AS lag_seconds FROM ({' UNION ALL '.join(f"SELECT '{t}' AS source_name, '{y}' AS layer, count(*) AS rows_read, min({c})::TIMESTAMP AS min_event_time, max({c})::TIMESTAMP AS max_event_time FROM {t}" for t, y, c in _LAYERS)}) LEFT JOIN (SELECT component AS source_name, CAST(sum(error_count) AS BIGINT) AS n FROM data_quality_results WHERE NOT passed GROUP BY 1) x USING (source_name))"""


def _layers(spark: SparkSession, d: str) -> DataFrame:
    bad = table(spark, d, "data_quality_results").where("not passed").select(F.col("component").alias("source_name"), F.col("error_count").alias("rows"))
    return audit.layer_metrics({t: (table(spark, d, t), y, c) for t, y, c in _LAYERS}, bad, F.expr(NOW))


@query(f"SELECT source_name, layer, rows_read, min_event_time, max_event_time, rows_rejected, lag_seconds FROM {_LM}")
def layer_audit(spark: SparkSession, d: str) -> DataFrame:
    return _layers(spark, d).select("source_name", "layer", "rows_read", "min_event_time", "max_event_time", "rows_rejected", "lag_seconds")


@query(f"SELECT source_name, layer, max_event_time, lag_seconds AS latest_lag_seconds FROM {_LM}")
def audit_freshness(spark: SparkSession, d: str) -> DataFrame:
    return audit.source_freshness(_layers(spark, d)).select("source_name", "layer", "max_event_time", "latest_lag_seconds")


def _ledger(spark: SparkSession, d: str) -> merge.Table:
    """A table with a first load, a merge that changes and adds rows, an appended column and a replaced slice."""
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    t = merge.Table(spark, f"{shared_dir(spark)}/kv_ledger_{uuid.uuid4().hex}")
    t.append(c.where("c_custkey % 3 <> 0"))
    t.merge(c.where("c_custkey % 2 = 0").withColumn("c_acctbal", F.when(F.col("c_custkey") % 4 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))), ["c_custkey"], ["c_acctbal"], F.current_timestamp())
    t.append(c.where("c_custkey = 3").withColumn("nota", F.lit("nueva")))
    t.replace_slice(c.where("c_custkey between 1 and 10").withColumn("nota", F.lit("corte")), F.col("c_custkey").between(1, 10))
    return t


_C1 = "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0"


@query(f"SELECT * FROM (SELECT c_custkey, c_acctbal, NULL::VARCHAR AS nota FROM ({_C1}) UNION ALL SELECT c_custkey, c_acctbal, 'nueva' FROM customer WHERE c_custkey = 3) WHERE c_custkey NOT BETWEEN 1 AND 10 UNION ALL SELECT c_custkey, c_acctbal, 'corte' FROM customer WHERE c_custkey BETWEEN 1 AND 10")
def append_and_replace(spark: SparkSession, d: str) -> DataFrame:
    """Append with a new column, then one slice replaced."""
    return _ledger(spark, d).read()


@query(f"""SELECT * FROM (VALUES (0, 'APPEND', (SELECT count(*) FROM customer WHERE c_custkey % 3 <> 0)), (1, 'MERGE', (SELECT count(*) FROM ({_C1}))), (2, 'APPEND', (SELECT count(*) + 1 FROM ({_C1}))),
  (3, 'REPLACE SLICE', (SELECT count(*) + 10 FROM ({_C1}) WHERE c_custkey NOT BETWEEN 1 AND 10))) t(version, operacion, filas)""")
def table_history(spark: SparkSession, d: str) -> DataFrame:
    h = _ledger(spark, d).history()
    return L.literal(spark, [(x["version"], x["operation"], x["rows"]) for x in h], "version int, operacion string, filas long")


@query("SELECT metrica, CAST(total AS BIGINT) AS total FROM (SELECT 'insert' AS metrica, count(*) FILTER (WHERE c_custkey % 3 = 0 AND c_custkey % 2 = 0) AS total FROM customer UNION ALL SELECT 'update', count(*) FILTER (WHERE c_custkey % 3 <> 0 AND c_custkey % 4 = 0) FROM customer UNION ALL SELECT 'keep', count(*) FILTER (WHERE c_custkey % 3 <> 0 AND c_custkey % 4 <> 0) FROM customer)")
def metric_totals(spark: SparkSession, d: str) -> DataFrame:
    """Operation metrics of all commits, summed by name; those that are no number count nothing."""
    rows = [(x["timestamp"], {**{k: str(v) for k, v in x["metrics"].items()}, "nota": "sin numero"}) for x in _ledger(spark, d).history()]
    h = L.literal(spark, rows, "t double, metrics map<string, string>").select(F.timestamp_seconds("t").alias("timestamp"), "metrics")
    return audit.metric_totals(h, F.expr("timestamp'2000-01-01 00:00:00'"))


@query("SELECT run_id, rule_id, CASE WHEN status = 'A' THEN 'CERRADO' ELSE 'ABIERTO' END AS estado FROM (SELECT run_id, rule_id, CASE WHEN passed THEN 'A' ELSE 'B' END AS status FROM data_quality_results)")
def update_where(spark: SparkSession, d: str) -> DataFrame:
    """UPDATE ... SET ... WHERE as a new snapshot; rows for which the condition is NULL stay as they are."""
    q = table(spark, d, "data_quality_results").select("run_id", "rule_id", "passed", F.lit("ABIERTO").alias("estado"))
    return merge.update_where(q, F.col("passed"), {"estado": F.lit("CERRADO")}).select("run_id", "rule_id", "estado")


@query("SELECT registro_id, CASE WHEN valor < 0 AND codigo_agente = 'AGC001' THEN 'negativo,agente' WHEN valor < 0 THEN 'negativo' ELSE 'agente' END AS reglas FROM generacion_real WHERE valor < 0 OR codigo_agente = 'AGC001'")
def quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Rows that break a blocking rule, with the rules they break; the third rule does not block."""
    r = [quality.Rule("gen", "negativo", F.col("valor") < 0, blocking=True), quality.Rule("gen", "agente", F.col("codigo_agente") == "AGC001", blocking=True), quality.Rule("gen", "nulo", F.col("valor").isNull())]
    return audit.quarantine(table(spark, d, "generacion_real"), r, "r1", ["registro_id"])[1].select("registro_id", "reglas")


@query("SELECT rule_name, count(*) AS corridas, CAST(sum(error_count) AS BIGINT) AS errores FROM data_quality_results WHERE is_blocking AND NOT passed GROUP BY 1")
def blocking_gate(spark: SparkSession, d: str) -> DataFrame:
    """What the gate stops: failed blocking rules."""
    return quality.blocked(table(spark, d, "data_quality_results")).groupBy("rule_name").agg(F.count("*").alias("corridas"), F.sum("error_count").alias("errores"))


_DAY = "SELECT CAST(fecha_hora AS DATE) AS f FROM generacion_real"


@query(f"SELECT count(*) AS dias, min(f) AS desde, max(f) AS hasta, min(f) <= DATE '2026-06-07' AND max(f) >= DATE '2026-06-30' - INTERVAL 3 DAY AS cubierto_3, min(f) <= DATE '2026-06-07' AND max(f) >= DATE '2026-06-30' - INTERVAL 45 DAY AS cubierto_45 FROM (SELECT DISTINCT f FROM ({_DAY}))")
def backfill_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Whether the loaded days cover June 7 to 30 with a lag of 3 and of 45 days."""
    r = table(spark, d, "generacion_real").agg(F.countDistinct(F.to_date("fecha_hora")).alias("dias"), F.min(F.to_date("fecha_hora")).alias("desde"), F.max(F.to_date("fecha_hora")).alias("hasta")).first()  # one row
    ok = lambda lag: L.covered((date(2026, 6, 7), date(2026, 6, 30)), (r["desde"], r["hasta"]), lag)
    return L.literal(spark, [(r["dias"], r["desde"], r["hasta"], ok(3), ok(45))], "dias long, desde date, hasta date, cubierto_3 boolean, cubierto_45 boolean")


@query("SELECT * FROM (VALUES ('valor', 'double', 'decimal(24,6)'), ('extra', NULL, 'string')) t(columna, tiene, espera)")
def schema_contract(spark: SparkSession, d: str) -> DataFrame:
    """Columns that differ from a contract: one of another type, one that is missing."""
    diff = L.schema_differences(table(spark, d, "generacion_real"), {"valor": "decimal(24,6)", "version": "string", "fecha_hora": "timestamp_ntz", "extra": "string"})
    return L.literal(spark, [(c, a, b) for c, (a, b) in diff.items()], "columna string, tiene string, espera string")


@query("SELECT count(*) AS filas, count(*) FILTER (WHERE a IS DISTINCT FROM b) AS distintas FROM (SELECT generacion_key, sum(generacion_real_kwh) AS a FROM fact_generacion_real GROUP BY 1) FULL JOIN (SELECT generacion_key, sum(CASE WHEN planta_key = 1 THEN generacion_real_kwh + 1 ELSE generacion_real_kwh END) AS b FROM fact_generacion_real WHERE planta_key <> 2 GROUP BY 1) USING (generacion_key)")
def idempotency_compare(spark: SparkSession, d: str) -> DataFrame:
    """A fact against a reload that changed one plant and lost another: rows and differing rows."""
    f = table(spark, d, "fact_generacion_real").select("generacion_key", "planta_key", "generacion_real_kwh")
    again = f.where("planta_key <> 2").withColumn("generacion_real_kwh", F.when(F.col("planta_key") == 1, F.col("generacion_real_kwh") + 1).otherwise(F.col("generacion_real_kwh")))
    return quality.same_rows(f, again, "generacion_key", "generacion_real_kwh")


# --- inventories ---

_INV = [("agentes", "fecha"), ("generacion_real", "fecha_hora"), ("precio_bolsa", "fecha_hora"), ("plantas", "fecha")]
_W = {"agentes": 12, "generacion_real": 17, "precio_bolsa": 15, "plantas": 12}


@query(" UNION ALL ".join(f"SELECT '{t}' AS tabla, count(*) AS registros, {_W[t]} AS columnas, {('min(load_date)::TIMESTAMP' if t != 'plantas' else 'NULL::TIMESTAMP')} AS primera_carga, {('max(ingestion_timestamp)' if t != 'plantas' else 'NULL::TIMESTAMP')} AS ultima_ingesta, min({c})::TIMESTAMP AS primera_fecha_evento, max({c})::TIMESTAMP AS ultima_fecha_evento, true AS con_archivos FROM {t}" for t, c in _INV))
def inventory(spark: SparkSession, d: str) -> DataFrame:
    i = X.inventory({t: (table(spark, d, t), c) for t, c in _INV})
    return i.select("tabla", "registros", "columnas", "primera_carga", "ultima_ingesta", "primera_fecha_evento", "ultima_fecha_evento", ((F.col("archivos") >= 1) & (F.col("bytes") > 0)).alias("con_archivos"))


@query("SELECT table_name AS tabla, CAST(ordinal_position AS INT) AS posicion, column_name AS columna FROM information_schema.columns WHERE table_name IN ('agentes', 'generacion_real', 'precio_bolsa', 'plantas')")
def data_dictionary(spark: SparkSession, d: str) -> DataFrame:
    rows = X.dictionary({t: table(spark, d, t) for t, _ in _INV})
    return L.literal(spark, rows, "tabla string, posicion int, columna string, tipo string").select("tabla", "posicion", "columna")


@query(" UNION ALL ".join(f"SELECT '{t}' AS tabla, load_date, source_file_name, source_file_path, count(*) AS registros, min(ingestion_timestamp) AS primera_ingesta, max(ingestion_timestamp) AS ultima_ingesta FROM {t} GROUP BY ALL" for t in ("agentes", "generacion_real", "embalses")))
def load_lineage(spark: SparkSession, d: str) -> DataFrame:
    return X.load_lineage({t: table(spark, d, t) for t in ("agentes", "generacion_real", "embalses")})


_DK = "codigo_variable, fecha_hora, codigo_duracion, unidad_medida, codigo_agente, codigo_planta"
_DUP = lambda kind, keys, n: f"SELECT '{kind}' AS perfil, count(*) AS grupos, CAST(coalesce(sum(n), 0) AS BIGINT) AS filas, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS excedentes, coalesce(max(n), 1) AS mayor FROM (SELECT {n} AS n FROM generacion_real GROUP BY {keys} HAVING {n} > 1)"


@query(" UNION ALL ".join([_DUP("payload", f"{_DK}, version, valor", "count(*)"), _DUP("llave_con_version", f"{_DK}, version", "count(*)"), _DUP("id", "registro_id", "count(*)"), _DUP("varias_versiones", _DK, "count(DISTINCT version)"), _DUP("conflicto_de_valor", f"{_DK}, version", "count(DISTINCT valor)")]))
def duplicate_profiles(spark: SparkSession, d: str) -> DataFrame:
    k = _DK.split(", ")
    return X.duplicate_profiles(table(spark, d, "generacion_real"), "registro_id", [*k, "version", "valor"], [*k, "version"], k, "version", "valor")


_IDS = ("codigo_variable", "codigo_agente", "codigo_planta", "version")


@query(" UNION ALL ".join(f"SELECT '{c}' AS columna, count(*) AS registros, count(*) FILTER (WHERE {c} IS NULL) AS nulos, count(*) FILTER (WHERE trim({c}) = '') AS vacios, count(*) FILTER (WHERE {c} <> trim({c})) AS con_espacios, count(*) FILTER (WHERE {c} <> upper({c})) AS no_mayuscula, min(length(trim({c}))) AS longitud_min, max(length(trim({c}))) AS longitud_max, count(DISTINCT {c}) AS distintos FROM generacion_real" for c in _IDS))
def identifier_hygiene(spark: SparkSession, d: str) -> DataFrame:
    return X.hygiene(table(spark, d, "generacion_real"), list(_IDS))


@query(f"SELECT count(*) AS valores, count(*) FILTER (WHERE n IS NULL OR n NOT IN (SELECT k FROM (SELECT {_KEY('upper(nombre_embalse)')} AS k FROM embalses) WHERE k <> '')) AS sin_correspondencia FROM (SELECT DISTINCT {_KEY('upper(nombre_reservorio)')} AS n FROM plantas_reservorios)")
def name_match(spark: SparkSession, d: str) -> DataFrame:
    return X.unmatched_names(table(spark, d, "plantas_reservorios"), "nombre_reservorio", table(spark, d, "embalses"), "nombre_embalse", N.match_key)


@query("SELECT count(*) AS filas, count(*) FILTER (WHERE latitud IS NULL) AS latitud_no_valida, count(*) FILTER (WHERE longitud IS NULL) AS longitud_no_valida, count(*) FILTER (WHERE NOT (latitud BETWEEN -90 AND 90) OR NOT (longitud BETWEEN -180 AND 180)) AS fuera_de_rango, count(*) FILTER (WHERE NOT (latitud BETWEEN -5 AND 14) OR NOT (longitud BETWEEN -82 AND -66)) AS fuera_de_caja FROM embalses")
def coordinate_box(spark: SparkSession, d: str) -> DataFrame:
    return X.coordinates(table(spark, d, "embalses"), "latitud", "longitud", (-5.0, 14.0, -82.0, -66.0))


@query("SELECT CAST(fecha_hora AS DATE) AS fecha, count(*) AS registros, count(DISTINCT upper(trim(codigo_planta))) AS plantas, count(DISTINCT hour(fecha_hora)) AS horas FROM generacion_real WHERE fecha_hora IS NOT NULL GROUP BY 1")
def daily_volume(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "generacion_real").where("fecha_hora is not null")
    return g.groupBy(F.to_date("fecha_hora").alias("fecha")).agg(F.count("*").alias("registros"), F.countDistinct(N.code("codigo_planta")).alias("plantas"), F.countDistinct(F.hour("fecha_hora")).alias("horas"))


@query("SELECT codigo_agente, fecha, count(DISTINCT (coalesce(nombre_agente, '~'), coalesce(actividad_agente, '~'))) AS estados FROM (SELECT upper(trim(codigo_agente)) AS codigo_agente, fecha, nombre_agente, actividad_agente FROM agentes) GROUP BY 1, 2 HAVING count(DISTINCT (coalesce(nombre_agente, '~'), coalesce(actividad_agente, '~'))) > 1")
def states_per_day(spark: SparkSession, d: str) -> DataFrame:
    """Agents with several states on one snapshot day."""
    return D.several_states(table(spark, d, "agentes").withColumn("codigo_agente", N.code("codigo_agente")), ["codigo_agente", "fecha"], ["nombre_agente", "actividad_agente"])


@query("SELECT planta_key, count(*) AS pares, count(*) FILTER (WHERE g > a * 1.05) AS excesos FROM (SELECT planta_key, fecha_hora, sum(generacion_real_kwh) AS g FROM fact_generacion_real GROUP BY 1, 2) JOIN (SELECT planta_key, fecha_hora, avg(generacion_real_kwh) OVER (PARTITION BY planta_key) AS a FROM (SELECT planta_key, fecha_hora, CAST(sum(generacion_real_kwh) AS DOUBLE) AS generacion_real_kwh FROM fact_generacion_real GROUP BY 1, 2)) USING (planta_key, fecha_hora) GROUP BY 1")
def coherence_by_plant(spark: SparkSession, d: str) -> DataFrame:
    """Hours in which a plant gave over 1.05 times what it gives on average, which stands for its availability here."""
    h = table(spark, d, "fact_generacion_real").groupBy("planta_key", "fecha_hora").agg(F.sum("generacion_real_kwh").alias("g"))
    a = h.groupBy("planta_key").agg(F.avg(F.col("g").cast("double")).alias("a"))
    return h.join(a, "planta_key").groupBy("planta_key").agg(F.count("*").alias("pares"), F.count_if(F.col("g") > F.col("a") * 1.05).alias("excesos"))


@query("SELECT severidad, rule_name, n FROM (SELECT severity AS severidad, rule_name, count(*) AS n FROM data_quality_results GROUP BY 1, 2) ORDER BY CASE severidad WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END, n DESC, rule_name LIMIT 5")
def severity_sort(spark: SparkSession, d: str) -> DataFrame:
    """The five worst, by severity through a map, then number descending, then name."""
    rank = versioning.lookup(F.col("severidad"), {"CRITICAL": 1, "HIGH": 2, "MEDIUM": 3}, 4)
    g = table(spark, d, "data_quality_results").groupBy(F.col("severity").alias("severidad"), "rule_name").agg(F.count("*").alias("n"))
    return g.orderBy(rank, F.desc("n"), "rule_name").limit(5)


@query("SELECT count(*) AS filas, count(*) AS con_fallo FROM (SELECT 1 FROM generacion_real WHERE valor < 0 LIMIT 100)")
def sample_of_invalid(spark: SparkSession, d: str) -> DataFrame:
    """A hundred invalid rows to look at, in no order: the limit is the feature; that all are invalid is checked."""
    s = table(spark, d, "generacion_real").where("valor < 0").limit(100)
    return s.agg(F.count("*").alias("filas"), F.count_if(F.col("valor") < 0).alias("con_fallo"))


@query("SELECT count(*) AS nuevas FROM (SELECT DISTINCT doc_id, source, parent_id FROM documents) a WHERE NOT EXISTS (SELECT 1 FROM documents b WHERE a.doc_id = b.doc_id AND a.source = b.source AND a.parent_id = b.parent_id AND b.doc_id % 2 = 0)")
def anti_using_new_rows(spark: SparkSession, d: str) -> DataFrame:
    """The plain USING anti join: rows with a NULL key part never match and come again."""
    x = table(spark, d, "documents").select("doc_id", "source", "parent_id")
    return versioning.new_rows_plain(x, x.where("doc_id % 2 = 0"), ["doc_id", "source", "parent_id"]).agg(F.count("*").alias("nuevas"))


@query("WITH n AS (SELECT codigo_variable, fecha_inicio, codigo_duracion, unidad_medida, codigo_planta, version, valor, load_date FROM niveles_embalses) SELECT count(*) AS recibidas, (SELECT count(*) FROM (SELECT DISTINCT codigo_variable, fecha_inicio, codigo_duracion, unidad_medida, codigo_planta, version, valor FROM n)) AS unicas, (SELECT count(*) FROM (SELECT codigo_variable, fecha_inicio, codigo_duracion, unidad_medida, codigo_planta, version, valor FROM n EXCEPT SELECT codigo_variable, fecha_inicio, codigo_duracion, unidad_medida, codigo_planta, version, valor FROM n WHERE load_date < DATE '2026-06-15')) AS nuevas FROM n")
def append_new_rows(spark: SparkSession, d: str) -> DataFrame:
    """Append of new rows only, with the counts a loader reports: received, unique, new."""
    n, cols = table(spark, d, "niveles_embalses"), ["codigo_variable", "fecha_inicio", "codigo_duracion", "unidad_medida", "codigo_planta", "version", "valor"]
    return versioning.append_counts(n.select(*cols), n.where("load_date < date'2026-06-15'"), cols)


_RC = "(SELECT component AS source_name, run_id, CAST(sum(error_count) AS BIGINT) AS n FROM data_quality_results GROUP BY 1, 2)"


@query(f"SELECT run_id, source_name, n AS diferencias FROM {_RC}")
def governance_merge(spark: SparkSession, d: str) -> DataFrame:
    """Reconciliation results merged by (run, source): a first state with other numbers, then the right ones."""
    r = table(spark, d, "data_quality_results").groupBy("run_id", F.col("component").alias("source_name")).agg(F.sum("error_count").alias("diferencias"))
    old = r.withColumn("diferencias", F.col("diferencias") - 1)
    return merge.apply(merge.plan(old, r, ["run_id", "source_name"], ["diferencias"]), old, ["diferencias"], F.expr(NOW))


@query("SELECT relacion_id, region, NULL::VARCHAR AS nota, NULL::DATE AS revisado FROM plantas_reservorios")
def evolve_schema(spark: SparkSession, d: str) -> DataFrame:
    """Columns of a contract that a table lacks are added as typed NULLs; nothing is dropped or retyped."""
    return L.evolve(table(spark, d, "plantas_reservorios").select("relacion_id", "region"), {"region": "int", "nota": "string", "revisado": "date"})


@query("SELECT 'TXF' AS regla, 10000 AS peso UNION ALL SELECT 'TXR', 9000 UNION ALL SELECT 'TX_NUMERIC', 100")
def version_policy(spark: SparkSession, d: str) -> DataFrame:
    """The policy as a table, read back through its checks."""
    p = L.literal(spark, [("TXF", 10000, None, True), ("TXR", 9000, None, True), ("TX_NUMERIC", None, 100, True), ("TXF", 1, None, False)], "version_pattern string, priority int, multiplier int, activo boolean")
    return L.literal(spark, sorted(versioning.load_policy(p).items()), "regla string, peso long")


# --- edge sources ---


def _fake_api(first: date, last: date):
    """Rows of a range: one per day, its number twice on Mondays; module level, for the workers unpickle it."""
    for k in range((last - first).days + 1):
        day = first + timedelta(k)
        yield from [(day, day.toordinal() % 7)] * (2 if day.weekday() == 0 else 1)


_API = "(SELECT CAST(f AS DATE) AS fecha, isodow(f) = 1 AS l FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-04-30', INTERVAL 1 DAY)) AS f))"


@query(f"SELECT month(fecha) AS mes, CAST(sum(CASE WHEN l THEN 2 ELSE 1 END) AS BIGINT) AS filas, count(*) AS dias FROM {_API} GROUP BY 1")
def range_reader(spark: SparkSession, d: str) -> DataFrame:
    """A date-range source, one partition per chunk of 25 days, rows streamed."""
    spark.dataSource.register(L.range_source("kv_range", "fecha date, n int", _fake_api))
    r = spark.read.format("kv_range").option("start", "2024-01-01").option("end", "2024-04-30").option("days", "25").load()
    return r.groupBy(F.month("fecha").alias("mes")).agg(F.count("*").alias("filas"), F.countDistinct("fecha").alias("dias"))


@query(f"SELECT fecha FROM {_API}")
def collected_reader(spark: SparkSession, d: str) -> DataFrame:
    """The same windows read one by one, united, and their repeated rows dropped."""
    return L.collected(spark, L.chunks(date(2024, 1, 1), date(2024, 4, 30), 25), _fake_api, "fecha date, n int").select("fecha")


@query("SELECT event_id, event_type FROM events")
def chunked_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Windows appended one after the other under bounded memory, with running guards, and read back."""
    e = table(spark, d, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    lo, hi = e.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()  # one row
    path = f"{shared_dir(spark)}/kv_ingest_{uuid.uuid4().hex}"
    done = L.ingest([e.where(F.to_date("ts").between(a, b)) for a, b in L.chunks(lo, hi, 366)], path, "ts")
    if done["max"] != hi:
        raise ValueError("the newest day was lost")
    return L.read_json(spark, path, "event_id long, event_type string, ts timestamp").select("event_id", "event_type")


@query("SELECT 'sin filas' AS caso, 'no rows to publish' AS error UNION ALL SELECT 'atrasada', 'behind' UNION ALL SELECT 'vieja', 'older'")
def publish_guards(spark: SparkSession, d: str) -> DataFrame:
    """Each guard against what it must stop."""
    g, far = table(spark, d, "generacion_real"), date(2030, 1, 1)
    out = []
    for case, word, call in (("sin filas", "no rows to publish", lambda: L.guard(g.limit(0), "fecha_hora")), ("atrasada", "behind", lambda: L.guard(g, "fecha_hora", not_before=far)), ("vieja", "older", lambda: L.guard(g, "fecha_hora", today=far, max_lag=30))):
        try:
            call()
        except ValueError as e:
            out.append((case, word if word in str(e) else str(e)))
    return L.literal(spark, out, "caso string, error string")


@query("SELECT event_id, true AS con_archivo, true AS con_carga FROM events")
def lineage_columns(spark: SparkSession, d: str) -> DataFrame:
    """File and load columns of a file read."""
    x = L.lineage(table(spark, d, "events").select("event_id", "_metadata"))
    return x.select("event_id", (F.col("source_file_name").endswith(".parquet") & F.col("source_file_path").contains("/")).alias("con_archivo"), (F.col("ingestion_timestamp").isNotNull() & F.col("load_date").isNotNull()).alias("con_carga"))


@query("SELECT registro_id, codigo_agente AS agente, NULL::DOUBLE AS potencia FROM generacion_real")
def column_choice(spark: SparkSession, d: str) -> DataFrame:
    """The first of several possible columns, and a typed NULL for an optional one that is missing."""
    g = table(spark, d, "generacion_real")
    c = L.first_column(g, ["codigo_sic_agente", "codigo_agente", "agente"], "agent")
    return L.evolve(g, {"potencia": "double"}).select("registro_id", F.col(c).alias("agente"), "potencia")


@query("SELECT k, CAST(sum(n) AS BIGINT) AS n, count(extra) AS con_extra FROM (SELECT event_type AS k, 1 AS n, NULL AS extra FROM events UNION ALL SELECT post_type, 2, lang FROM documents UNION ALL SELECT o_orderstatus, 3, NULL FROM orders) GROUP BY 1")
def union_missing_columns(spark: SparkSession, d: str) -> DataFrame:
    """Three tables united by name, absent columns NULL."""
    from functools import reduce

    parts = [table(spark, d, "events").select(F.col("event_type").alias("k"), F.lit(1).alias("n")), table(spark, d, "documents").select(F.col("post_type").alias("k"), F.lit(2).alias("n"), F.col("lang").alias("extra")), table(spark, d, "orders").select(F.col("o_orderstatus").alias("k"), F.lit(3).alias("n"))]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return u.groupBy("k").agg(F.sum("n").alias("n"), F.count("extra").alias("con_extra"))


@query("SELECT * FROM (VALUES ('AUTO', DATE '2026-06-01', DATE '2026-06-30', 'INCREMENTAL'), ('BACKFILL', DATE '2024-02-01', DATE '2024-03-05', 'BACKFILL'), ('por defecto', DATE '2026-06-01', DATE '2026-06-30', 'BACKFILL')) t(caso, desde, hasta, modo)")
def execution_window(spark: SparkSession, d: str) -> DataFrame:
    """Windows by mode: the default, an asked backfill, and a backfill by default without dates."""
    default, today = (date(2026, 6, 1), date(2026, 6, 30)), date(2026, 7, 15)
    rows = [("AUTO", *L.resolve_window("", "2024-02-01", "2024-03-05", default, today=today)), ("BACKFILL", *L.resolve_window(" backfill ", "2024-02-01", "2024-03-05", default, today=today)), ("por defecto", *L.resolve_window("AUTO", "", None, default, "BACKFILL", today))]
    return L.literal(spark, rows, "caso string, desde date, hasta date, modo string")


@query("SELECT * FROM (VALUES (1, 5.0::DOUBLE), (2, 10.0::DOUBLE), (3, 20.0::DOUBLE), (4, 40.0::DOUBLE), (5, 60.0::DOUBLE)) t(intento, espera)")
def retry_waits(spark: SparkSession, d: str) -> DataFrame:
    """Waits between the attempts of a call that fails five times and then gives its result."""
    waits: list[float] = []

    def call() -> int:
        if len(waits) < 5:
            raise ConnectionError
        return 1

    L.retry(call, sleep=waits.append, jitter=lambda: 0.0)
    return L.literal(spark, [(i, float(w)) for i, w in enumerate(waits, 1)], "intento int, espera double")


@query("SELECT * FROM (VALUES ('EL PEÑOL', 'GUATAPE', true), ('BETANIA', 'BETANIA', true), ('SIN NOMBRE', NULL, false)) t(embalse, planta, principal)")
def inline_literal(spark: SparkSession, d: str) -> DataFrame:
    return L.literal(spark, [("EL PEÑOL", "GUATAPE", True), ("BETANIA", "BETANIA", True), ("SIN NOMBRE", None, False)], "embalse string, planta string, principal boolean")


@query("SELECT * FROM (VALUES ('kv_catalogo', true, 2), ('kv_ausente', false, 0)) t(tabla, existe, columnas)")
def catalog_inspection(spark: SparkSession, d: str) -> DataFrame:
    """Whether the catalog has a table, and its columns."""
    table(spark, d, "nation").select("n_nationkey", "n_name").createOrReplaceTempView("kv_catalogo")
    rows = [(n, bool(ok := spark.catalog.tableExists(n)), len(spark.catalog.listColumns(n)) if ok else 0) for n in ("kv_catalogo", "kv_ausente")]
    return L.literal(spark, rows, "tabla string, existe boolean, columnas int")


@query("SELECT codigo_embalse, CASE WHEN codigo_embalse LIKE '%1' THEN 'OVERRIDE' WHEN codigo_embalse LIKE '%2' OR codigo_embalse LIKE '%3' THEN 'GEOCODER' WHEN codigo_embalse LIKE '%4' THEN 'MANUAL' ELSE 'FALTANTE' END AS fuente FROM embalses")
def coordinate_precedence(spark: SparkSession, d: str) -> DataFrame:
    """Coordinates by precedence of the lookup tables that stand for the geocoder, the manual list and the overrides."""
    e = table(spark, d, "embalses").select("codigo_embalse", "latitud", "longitud")
    pick = lambda *ends: e.where(F.right("codigo_embalse", F.lit(1)).isin(*ends))
    return L.resolve_coordinates(e.select("codigo_embalse"), ["codigo_embalse"], pick("1", "2", "3"), pick("3", "4"), pick("1")).select("codigo_embalse", F.col("fuente_coordenada").alias("fuente"))
