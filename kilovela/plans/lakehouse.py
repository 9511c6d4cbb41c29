"""Queries over the driver's tables that exercise the library's operators, each with its SQL oracle."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilovela.functions import normalize as N
from kilovela.operators import dimensions as D
from kilovela.operators import exploration as X
from kilovela.operators import facts, joins, merge, quality, versioning
from kilovela.plans import measures as M
from kilovela.plans import views as V
from kilovela.session import shared_dir, table
from kilovela.sources import landing as L

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def reg(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLES[name or f.__name__] = sql
        return f

    return reg


GEN = facts.FactSpec("generacion", ("codigo_variable", "codigo_duracion", "unidad_medida", "codigo_agente", "codigo_planta"), "fecha_hora", "valor", {"codigo_variable": "GREAL", "codigo_duracion": "PT1H", "unidad_medida": "KWH"}, tie=("registro_id",))
LEVEL = facts.FactSpec("energia", ("codigo_variable", "codigo_duracion", "unidad_medida", "codigo_planta"), "fecha_inicio", "valor", {"codigo_duracion": "P1D"}, tie=("registro_id",))
PRICE = facts.FactSpec("precio", ("codigo_variable", "codigo_duracion", "unidad_medida"), "fecha_hora", "valor", {"codigo_duracion": "PT1H"}, tie=("registro_id",))
TODAY = "2026-07-15"
APPROVED = "aprobado"

P = "CASE WHEN upper(trim(version)) = 'TXF' THEN 10000 WHEN upper(trim(version)) = 'TXR' THEN 9000 WHEN regexp_full_match(upper(trim(version)), 'TX[0-9]+') THEN least(substr(upper(trim(version)), 3)::HUGEINT, 1000000000000000)::BIGINT * 100 ELSE 0 END"


def _canon(t: str, cols: str, keys: str, where: str) -> str:
    return f"""SELECT {cols}, ver AS version_seleccionada, p AS prioridad_version FROM (
      SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY p DESC, silver_updated_at DESC NULLS LAST, ingestion_timestamp DESC NULLS LAST, load_date DESC NULLS LAST, ver DESC NULLS LAST, registro_id DESC) AS rn
      FROM (SELECT * REPLACE (upper(trim(codigo_variable)) AS codigo_variable, upper(trim(codigo_duracion)) AS codigo_duracion, upper(trim(unidad_medida)) AS unidad_medida), upper(trim(version)) AS ver, {P} AS p FROM {t} WHERE {where})) WHERE rn = 1"""


GEN_SQL = _canon("(SELECT * REPLACE (upper(trim(codigo_planta)) AS codigo_planta, upper(trim(codigo_agente)) AS codigo_agente) FROM generacion_real)", "codigo_planta, codigo_agente, fecha_hora, round(valor, 6) AS valor", "codigo_variable, codigo_duracion, unidad_medida, codigo_agente, codigo_planta, fecha_hora", "upper(trim(codigo_variable)) = 'GREAL' AND upper(trim(codigo_duracion)) = 'PT1H' AND upper(trim(unidad_medida)) = 'KWH'")
LEVEL_SQL = _canon("(SELECT * REPLACE (upper(trim(codigo_planta)) AS codigo_planta) FROM niveles_embalses)", "codigo_planta, fecha_inicio, valor", "codigo_variable, codigo_duracion, unidad_medida, codigo_planta, fecha_inicio", "upper(trim(codigo_duracion)) = 'P1D'")
PRICE_SQL = _canon("precio_bolsa", "codigo_variable, fecha_hora, valor", "codigo_variable, codigo_duracion, unidad_medida, fecha_hora", "upper(trim(codigo_duracion)) = 'PT1H'")


def _canonical(spark: SparkSession, d: str, t: str, spec: facts.FactSpec) -> DataFrame:
    return facts.canonical_rows(table(spark, d, t), spec).withColumnRenamed(spec.version, "version_seleccionada")


def _dbl(c: str | Column, n: int = 6) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), n)


def _dec(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(24,6)")


# --- scans, projections ---


@query("""SELECT p.p_type AS tipo, CAST(l.l_shipdate AS DATE) AS dia, CAST(sum(CAST(l.l_quantity AS DECIMAL(24,6))) AS DOUBLE) AS cantidad, count(*) AS filas
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY p DESC, l_shipdate DESC, l_suppkey DESC, l_partkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn
    FROM (SELECT *, CASE WHEN l_returnflag = 'A' THEN 10000 WHEN l_returnflag = 'R' THEN 9000 ELSE (1 + l_suppkey % 5) * 100 END AS p FROM lineitem)) l
  JOIN part p ON l.l_partkey = p.p_partkey WHERE rn = 1 GROUP BY 1, 2""", name="entry_flagship")
def entry_flagship(spark: SparkSession, d: str) -> DataFrame:
    """Scan, version label, canonical version per line, join, daily sum."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    label = F.when(F.col("l_returnflag") == "A", "TXF").when(F.col("l_returnflag") == "R", "TXR").otherwise(F.concat(F.lit("TX"), (1 + F.col("l_suppkey") % 5).cast("string")))
    x = li.withColumn("prioridad", versioning.priority(label))
    x = versioning.latest(x, ["l_orderkey", "l_linenumber"], [F.desc(c) for c in ("prioridad", "l_shipdate", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice")])
    j = x.join(table(spark, d, "part").select("p_partkey", "p_type"), x.l_partkey == F.col("p_partkey"))
    return j.groupBy(F.col("p_type").alias("tipo"), F.to_date("l_shipdate").alias("dia")).agg(F.sum(_dec("l_quantity")).cast("double").alias("cantidad"), F.count("*").alias("filas"))


@query("SELECT event_id, user_id, upper(trim(event_type)) AS tipo, CAST(ts AS DATE) AS dia, hour(ts) + 1 AS periodo FROM events WHERE value > 10 AND event_type <> 'click'")
def scan_filter_project(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").where((F.col("value") > 10) & (F.col("event_type") != "click"))
    return e.select("event_id", "user_id", N.code("event_type").alias("tipo"), F.to_date("ts").alias("dia"), (F.hour("ts") + 1).alias("periodo"))


@query("SELECT registro_id, upper(trim(codigo_planta)) AS planta, upper(trim(codigo_agente)) AS agente, upper(trim(version)) AS version, upper(trim(unidad_medida)) AS unidad FROM generacion_real")
def normalize_codes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "generacion_real").select("registro_id", N.code("codigo_planta").alias("planta"), N.code("codigo_agente").alias("agente"), N.code("version").alias("version"), N.code("unidad_medida").alias("unidad"))


@query("""SELECT registro_id, upper(trim(regexp_replace(nombre_agente, '\\s+', ' ', 'g'))) AS nombre, upper(trim(regexp_replace(translate(nombre_agente, 'ÁÉÍÓÚÜÑ', 'AEIOUUN'), '\\s+', ' ', 'g'))) AS plegado,
  trim(regexp_replace(translate(upper(nombre_agente), 'ÁÉÍÓÚÜÑ', 'AEIOUUN'), '\\s+', ' ', 'g')) AS plegado_todo, coalesce(nullif(trim(actividad_agente), ''), 'SIN CLASIFICAR') AS actividad FROM agentes""")
def normalize_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "agentes").select("registro_id", N.name("nombre_agente").alias("nombre"), N.fold_then_upper("nombre_agente").alias("plegado"), N.upper_then_fold("nombre_agente").alias("plegado_todo"), N.blank_to("actividad_agente", "SIN CLASIFICAR").alias("actividad"))


@query("SELECT codigo_planta, regexp_replace(translate(upper(nombre_planta), 'ÁÉÍÓÚÜÑ', 'AEIOUUN'), '[^A-Z0-9]+', '', 'g') AS llave FROM plantas")
def match_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "plantas").select("codigo_planta", N.match_key("nombre_planta").alias("llave"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, TRY_CAST(regexp_replace(trim(t), ',', '.') AS DOUBLE) AS valor FROM
  (SELECT *, CASE WHEN l_suppkey % 7 = 0 THEN 'x' ELSE ' ' || CAST(l_quantity AS BIGINT) || ',' || l_linenumber || ' ' END AS t FROM lineitem)""")
def decimal_comma_cast(spark: SparkSession, d: str) -> DataFrame:
    t = F.when(F.col("l_suppkey") % 7 == 0, "x").otherwise(F.concat(F.lit(" "), F.col("l_quantity").cast("bigint").cast("string"), F.lit(","), F.col("l_linenumber").cast("string"), F.lit(" ")))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", N.decimal_comma(t).alias("valor"))


@query("SELECT run_id, rule_id, CASE WHEN error_rate <> 0 THEN round(error_count / error_rate, 4) END AS razon FROM data_quality_results")
def safe_ratio(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "data_quality_results").select("run_id", "rule_id", F.round(N.safe_ratio("error_count", "error_rate"), 4).alias("razon"))


@query("SELECT relacion_id, region, nombre_planta FROM plantas_reservorios WHERE (valido_desde IS NULL OR valido_desde <= DATE '2026-07-15') AND (valido_hasta IS NULL OR valido_hasta >= DATE '2026-07-15') AND lower(trim(estado_validacion)) = 'aprobado'")
def valid_today(spark: SparkSession, d: str) -> DataFrame:
    """Approved relations valid on a day; these tables say APROBADO."""
    day = F.to_date(F.lit(TODAY))
    r = table(spark, d, "plantas_reservorios")
    ok = (F.col("valido_desde").isNull() | (F.col("valido_desde") <= day)) & (F.col("valido_hasta").isNull() | (F.col("valido_hasta") >= day)) & (F.lower(F.trim("estado_validacion")) == APPROVED)
    return r.where(ok).select("relacion_id", "region", "nombre_planta")


@query("SELECT registro_id, codigo_agente FROM agentes WHERE fecha = (SELECT max(fecha) FROM agentes)")
def latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "agentes")
    return joins.with_scalars(a, a.agg(F.max("fecha").alias("_m"))).where("fecha = _m").select("registro_id", "codigo_agente")


@query("SELECT count(*) AS filas, min(registro_id) AS primero FROM generacion_real, (SELECT max(ingestion_timestamp) AS m FROM generacion_real WHERE load_date < DATE '2026-06-10') WHERE m IS NULL OR ingestion_timestamp >= m")
def high_water_filter(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "generacion_real").select("registro_id", "ingestion_timestamp", "load_date")
    return L.since_high_water(g, g.where("load_date < date'2026-06-10'"), "ingestion_timestamp").agg(F.count("*").alias("filas"), F.min("registro_id").alias("primero"))


# --- versions ---


@query(f"SELECT DISTINCT version, {P} AS prioridad FROM generacion_real")
def tx_priority(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "generacion_real").select("version", versioning.priority("version").alias("prioridad")).distinct()


@query("SELECT version, CASE upper(trim(version)) WHEN 'TXF' THEN 50 WHEN 'TXR' THEN 40 WHEN 'TX3' THEN 30 WHEN 'TX2' THEN 20 WHEN 'TX1' THEN 10 ELSE 0 END AS orden, count(*) AS filas FROM precio_bolsa GROUP BY ALL")
def map_lookup(spark: SparkSession, d: str) -> DataFrame:
    o = versioning.lookup(N.code("version"), {"TXF": 50, "TXR": 40, "TX3": 30, "TX2": 20, "TX1": 10})
    return table(spark, d, "precio_bolsa").groupBy("version", o.alias("orden")).agg(F.count("*").alias("filas"))


@query(GEN_SQL)
def tx_version_select(spark: SparkSession, d: str) -> DataFrame:
    return _canonical(spark, d, "generacion_real", GEN).select("codigo_planta", "codigo_agente", "fecha_hora", _dbl("valor").alias("valor"), "version_seleccionada", "prioridad_version")


@query("SELECT registro_id, upper(trim(codigo_agente)) AS codigo_agente, fecha FROM agentes QUALIFY row_number() OVER (PARTITION BY upper(trim(codigo_agente)), fecha ORDER BY ingestion_timestamp DESC NULLS LAST, load_date DESC NULLS LAST, registro_id DESC) = 1")
def dedup_latest(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "agentes").withColumn("codigo_agente", N.code("codigo_agente"))
    return versioning.latest(a, ["codigo_agente", "fecha"], [*versioning.newest_first("ingestion_timestamp", "load_date"), F.desc("registro_id")]).select("registro_id", "codigo_agente", "fecha")


@query("""SELECT planta, fecha_inicio, count(DISTINCT v) AS versiones, min(valor) AS minimo, max(valor) AS maximo, list_aggregate(list_sort(list(DISTINCT v)), 'string_agg', ',') AS lista, max(valor) - min(valor) AS rango
  FROM (SELECT upper(trim(codigo_planta)) AS planta, fecha_inicio, upper(trim(version)) AS v, valor FROM niveles_embalses) GROUP BY 1, 2 HAVING count(DISTINCT v) > 1""")
def revision_range(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "niveles_embalses").select(N.code("codigo_planta").alias("planta"), "fecha_inicio", N.code("version").alias("v"), "valor")
    return versioning.revision_range(n, ["planta", "fecha_inicio"], "valor", "v")


@query(f"SELECT version_seleccionada, count(*) AS filas FROM ({GEN_SQL}) GROUP BY 1")
def canonical_version_dist(spark: SparkSession, d: str) -> DataFrame:
    return _canonical(spark, d, "generacion_real", GEN).groupBy("version_seleccionada").agg(F.count("*").alias("filas"))


# --- joins ---

PAYLOAD = ["codigo_variable", "fecha_inicio", "codigo_duracion", "unidad_medida", "codigo_planta", "version", "valor"]


@query("SELECT count(*) AS nuevas FROM (SELECT DISTINCT codigo_variable, fecha_inicio, codigo_duracion, unidad_medida, codigo_planta, version, valor FROM niveles_embalses EXCEPT SELECT codigo_variable, fecha_inicio, codigo_duracion, unidad_medida, codigo_planta, version, valor FROM niveles_embalses WHERE load_date < DATE '2026-06-01')")
def anti_nullsafe_new_rows(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "niveles_embalses")
    return versioning.new_rows(n.select(*PAYLOAD), n.where("load_date < date'2026-06-01'"), PAYLOAD).agg(F.count("*").alias("nuevas"))


@query("SELECT l_partkey, count(*) AS filas FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25) GROUP BY 1")
def orphan_keys(spark: SparkSession, d: str) -> DataFrame:
    return joins.orphans(table(spark, d, "lineitem"), "l_partkey", table(spark, d, "part").where("p_size <= 25"), "p_partkey")


@query("SELECT relacion_id, codigo_planta IS NOT NULL AND codigo_planta IN (SELECT codigo_planta FROM plantas WHERE tipo_generacion = 'HIDRAULICA') AS es_hidraulica FROM plantas_reservorios")
def existence_flag(spark: SparkSession, d: str) -> DataFrame:
    h = table(spark, d, "plantas").where("tipo_generacion = 'HIDRAULICA'")
    return joins.existence_flag(table(spark, d, "plantas_reservorios"), h, "codigo_planta", "codigo_planta", "es_hidraulica").select("relacion_id", "es_hidraulica")


def _calendar(df: DataFrame, when: str) -> DataFrame:
    return D.calendar(df.agg(F.min(F.to_date(when)).alias("a"), F.max(F.to_date(when)).alias("b")))


@query("SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INT) AS fecha_key, hour(ts) + 1 AS periodo_key, quarter(ts) AS trimestre FROM events")
def dim_key_lookup(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    x = e.select("event_id", F.to_date("ts").alias("fecha"), F.hour("ts").alias("hora_inicio"))
    return x.join(F.broadcast(_calendar(e, "ts").select("fecha", "fecha_key", "trimestre")), "fecha", "left").join(F.broadcast(D.periods(spark).select("hora_inicio", "periodo_key")), "hora_inicio", "left").select("event_id", "fecha_key", "periodo_key", "trimestre")


def _scd(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("dia"), "o_orderpriority", "o_orderkey")
    s = D.daily_state(o, "o_custkey", "dia", [F.desc("o_orderkey")])
    return D.scd2(s, "o_custkey", "dia", ["o_orderpriority"])


SCD_SQL = """(WITH s AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS dia, o_orderpriority, upper(trim(o_orderpriority)) AS n FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1),
  c AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR n IS DISTINCT FROM lag(n) OVER w THEN 1 ELSE 0 END AS f FROM s WINDOW w AS (PARTITION BY o_custkey ORDER BY dia)),
  v AS (SELECT *, CAST(sum(f) OVER (PARTITION BY o_custkey ORDER BY dia ROWS UNBOUNDED PRECEDING) AS INT) AS numero_version FROM c)
  SELECT o_custkey, o_orderpriority, numero_version, dia AS fecha_inicio, coalesce(CAST(lead(dia) OVER (PARTITION BY o_custkey ORDER BY dia) - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS fecha_fin,
    lead(dia) OVER (PARTITION BY o_custkey ORDER BY dia) IS NULL AS es_actual FROM v WHERE f = 1)"""


@query(f"SELECT * FROM {SCD_SQL}")
def scd2_versions(spark: SparkSession, d: str) -> DataFrame:
    return _scd(spark, d)


@query("""SELECT count(*) FILTER (WHERE fecha_inicio > fecha_fin) AS rango_invalido, count(*) FILTER (WHERE fecha_inicio <= b) AS traslape, count(*) FILTER (WHERE es_actual <> (fecha_fin = DATE '9999-12-31')) AS fin_abierto,
  (SELECT count(*) FROM (SELECT codigo_agente FROM dim_agente GROUP BY 1 HAVING count(*) FILTER (WHERE es_actual) <> 1)) AS actuales
  FROM (SELECT *, max(fecha_fin) OVER (PARTITION BY codigo_agente ORDER BY fecha_inicio, fecha_fin, agente_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM dim_agente)""")
def scd2_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Of the published history, whose ends and flags are faulty."""
    return D.scd2_invariants(table(spark, d, "dim_agente"), "codigo_agente", "agente_key")


@query(f"SELECT o.o_orderkey, v.numero_version, v.o_orderpriority AS prioridad_vigente FROM orders o LEFT JOIN {SCD_SQL} v ON o.o_custkey = v.o_custkey AND CAST(o.o_orderdate AS DATE) BETWEEN v.fecha_inicio AND v.fecha_fin")
def temporal_scd2_join(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("dia"))
    v = _scd(spark, d).withColumnRenamed("o_orderpriority", "prioridad_vigente")
    return joins.temporal(o, v, ("o_custkey", "o_custkey"), "dia", "fecha_inicio", "fecha_fin", ["numero_version", "prioridad_vigente"]).select("o_orderkey", "numero_version", "prioridad_vigente")


@query("""SELECT n.registro_id, count(r.relacion_id) AS relaciones FROM niveles_embalses n LEFT JOIN plantas_reservorios r ON upper(trim(n.codigo_planta)) = r.codigo_embalse
  AND CAST(n.fecha_inicio AS DATE) >= coalesce(r.valido_desde, DATE '1900-01-01') AND CAST(n.fecha_inicio AS DATE) <= coalesce(r.valido_hasta, DATE '9999-12-31') GROUP BY 1""")
def validity_join(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "niveles_embalses").select("registro_id", N.code("codigo_planta").alias("codigo_embalse"), F.to_date("fecha_inicio").alias("dia"))
    r = table(spark, d, "plantas_reservorios").where("codigo_embalse is not null").select("codigo_embalse", "relacion_id", "valido_desde", "valido_hasta")
    return joins.validity(n, r, "codigo_embalse", "dia", "valido_desde", "valido_hasta").groupBy("registro_id").agg(F.count("relacion_id").alias("relaciones"))


@query("""SELECT relacion_id FROM (SELECT *, max(e) OVER (PARTITION BY codigo_embalse ORDER BY valido_desde, e, relacion_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b
  FROM (SELECT *, coalesce(valido_hasta, DATE '9999-12-31') AS e FROM plantas_reservorios WHERE codigo_embalse IS NOT NULL AND valido_desde IS NOT NULL)) GROUP BY codigo_embalse, valido_desde, e, b, relacion_id HAVING valido_desde <= b""", name="overlap_running_max")
def overlap_running_max(spark: SparkSession, d: str) -> DataFrame:
    """Overlaps by a running maximum; equal to the pairwise definition in the tests."""
    r = table(spark, d, "plantas_reservorios").where("codigo_embalse is not null and valido_desde is not null")
    e = F.coalesce("valido_hasta", F.to_date(F.lit("9999-12-31")))
    w = Window.partitionBy("codigo_embalse").orderBy("valido_desde", e, "relacion_id").rowsBetween(Window.unboundedPreceding, -1)
    return r.withColumn("_b", F.max(e).over(w)).where("valido_desde <= _b").select("relacion_id")


@query("SELECT count(DISTINCT codigo_embalse) AS embalses FROM plantas_reservorios a WHERE codigo_embalse IS NOT NULL AND EXISTS (SELECT 1 FROM plantas_reservorios b WHERE a.codigo_embalse = b.codigo_embalse AND a.relacion_id < b.relacion_id AND a.valido_desde <= coalesce(b.valido_hasta, DATE '9999-12-31') AND b.valido_desde <= coalesce(a.valido_hasta, DATE '9999-12-31'))")
def overlap_entities(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "plantas_reservorios").where("codigo_embalse is not null and valido_desde is not null")
    return joins.overlapping(r, "codigo_embalse", "valido_desde", "valido_hasta").agg(F.countDistinct("codigo_embalse").alias("embalses"))


@query("""SELECT r.relacion_id, min(e.codigo_embalse) AS codigo FROM plantas_reservorios r LEFT JOIN embalses e ON r.nombre_reservorio = e.nombre_embalse OR r.codigo_embalse = e.codigo_embalse GROUP BY 1""")
def or_join_rewrite(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embalses").select(F.col("codigo_embalse").alias("codigo"), "codigo_embalse", "nombre_embalse")
    r = table(spark, d, "plantas_reservorios").select("relacion_id", "nombre_reservorio", "codigo_embalse")
    return joins.either(r, e, ("nombre_reservorio", "nombre_embalse"), ("codigo_embalse", "codigo_embalse"), "codigo").select("relacion_id", "codigo")


_RIGHT = "SELECT CAST(ts AS DATE) AS dia, count(*) AS r_n, sum(CAST(value AS DECIMAL(24,6)) + CASE WHEN day(ts) % 3 = 0 THEN CAST(0.4 AS DECIMAL(24,6)) WHEN day(ts) % 3 = 1 THEN CAST(0.000001 AS DECIMAL(24,6)) ELSE 0 END) AS r_v FROM events WHERE event_type <> 'click' OR day(ts) <> 7 GROUP BY 1"


@query(f"""SELECT dia, l_n, r_n, CAST(l_v AS DOUBLE) AS l_v, CAST(r_v AS DOUBLE) AS r_v FROM (SELECT CAST(ts AS DATE) AS dia, count(*) AS l_n, sum(CAST(value AS DECIMAL(24,6))) AS l_v FROM events GROUP BY 1) FULL JOIN ({_RIGHT}) USING (dia)
  WHERE l_n IS DISTINCT FROM r_n OR abs(coalesce(l_v, 0) - coalesce(r_v, 0)) > 0.001""")
def full_outer_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """All events by day against a copy that lost the clicks of the 7th and whose measures are off by a lot or by next to nothing."""
    e = table(spark, d, "events").select(F.to_date("ts").alias("dia"), "event_type", _dec("value").alias("v"))
    third = F.dayofmonth("dia") % 3
    off = F.when(third == 0, _dec(F.lit("0.4"))).when(third == 1, _dec(F.lit("0.000001"))).otherwise(_dec(F.lit("0")))
    side = lambda x: x.groupBy("dia").agg(F.count("*").alias("registros"), F.sum("v").alias("v"))
    other = e.where("event_type <> 'click' or day(dia) <> 7").withColumn("v", F.col("v") + off)
    r = quality.daily_reconcile(side(e), side(other), "dia", ["v"])
    return r.select("dia", F.col("l_registros").alias("l_n"), F.col("r_registros").alias("r_n"), F.col("l_v").cast("double").alias("l_v"), F.col("r_v").cast("double").alias("r_v"))


@query("""SELECT o_orderkey, CASE WHEN a.p IS NULL THEN 'SOLO_DERECHA' WHEN b.p IS NULL THEN 'SOLO_IZQUIERDA' WHEN a.p <> b.p THEN 'VALOR_DIFERENTE' WHEN a.s <> b.s THEN 'VERSION_DIFERENTE' ELSE 'OK' END AS estado
  FROM (SELECT o_orderkey, o_totalprice AS p, o_orderstatus AS s FROM orders WHERE o_orderkey % 10 <> 1) a FULL JOIN
  (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN o_totalprice + 1 ELSE o_totalprice END AS p, CASE WHEN o_orderkey % 10 = 4 THEN 'Z' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 10 <> 2) b USING (o_orderkey)""")
def row_reconcile_states(spark: SparkSession, d: str) -> DataFrame:
    o, k = table(spark, d, "orders"), F.col("o_orderkey") % 10
    a = o.where(k != 1).select("o_orderkey", F.col("o_totalprice").alias("p"), F.col("o_orderstatus").alias("s"))
    b = o.where(k != 2).select("o_orderkey", F.when(k == 3, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("p2"), F.when(k == 4, "Z").otherwise(F.col("o_orderstatus")).alias("s2"))
    return joins.reconcile(a, b, ["o_orderkey"], [("p", "p2", "VALOR_DIFERENTE"), ("s", "s2", "VERSION_DIFERENTE")], ("p", "p2"))


@query("SELECT dia, n, (SELECT max(n) FROM (SELECT CAST(ts AS DATE) AS dia, count(*) AS n FROM events GROUP BY 1)) AS mayor FROM (SELECT CAST(ts AS DATE) AS dia, count(*) AS n FROM events GROUP BY 1)")
def cross_scalar(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "events").groupBy(F.to_date("ts").alias("dia")).agg(F.count("*").alias("n"))
    return joins.with_scalars(c, c.agg(F.max("n").alias("mayor")))


@query("SELECT (SELECT count(*) FROM agentes) AS plata, (SELECT count(*) FROM dim_agente) AS oro, (SELECT count(*) FROM fact_generacion_real) AS hechos")
def layer_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.layer_counts({"plata": table(spark, d, "agentes"), "oro": table(spark, d, "dim_agente"), "hechos": table(spark, d, "fact_generacion_real")})


@query("""SELECT f.generacion_key, arg_max(m.o_totalprice, m.t) AS precio FROM (SELECT generacion_key, agente_key, fecha_hora FROM fact_generacion_real) f
  LEFT JOIN (SELECT o_custkey, o_orderdate AS t, max(o_totalprice) AS o_totalprice FROM orders GROUP BY 1, 2) m ON f.agente_key = m.o_custkey AND m.t <= f.fecha_hora GROUP BY 1""")
def as_of_join(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "fact_generacion_real").select("generacion_key", "agente_key", F.col("fecha_hora").alias("t"))
    m = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("agente_key"), F.col("o_orderdate").alias("t")).agg(F.max("o_totalprice").alias("precio"))
    return joins.as_of(f, m, "agente_key", "t", "precio").select("generacion_key", "precio")


# --- aggregates ---


_GKEY = "codigo_variable, codigo_duracion, unidad_medida, codigo_agente, codigo_planta, version, fecha_hora"


@query(f"""SELECT count(*) AS filas, count(*) FILTER (WHERE fecha_hora IS NULL OR {" OR ".join(f"coalesce(trim({c}), '') = ''" for c in _GKEY.split(", ")[:-1])}) AS claves_invalidas, (SELECT count(*) FROM (SELECT DISTINCT {_GKEY} FROM generacion_real)) AS claves,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT {_GKEY} FROM generacion_real)) AS duplicados, count(*) FILTER (WHERE valor < 0) AS negativos FROM generacion_real""")
def invalid_key_profile(spark: SparkSession, d: str) -> DataFrame:
    """Over all rows, NULL and blank key parts among them."""
    return quality.key_profile(table(spark, d, "generacion_real"), [*GEN.key, "version", "fecha_hora"], ("fecha_hora",), "valor")


@query("SELECT count(*) AS filas, count(*) FILTER (WHERE valor = 0) AS ceros, count(*) FILTER (WHERE valor < 0) AS negativos, count(*) FILTER (WHERE valor IS NULL) AS nulos, min(fecha_hora) AS primera, max(fecha_hora) AS ultima FROM precio_bolsa")
def global_profile(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("valor")
    return table(spark, d, "precio_bolsa").agg(F.count("*").alias("filas"), F.count_if(v == 0).alias("ceros"), F.count_if(v < 0).alias("negativos"), F.count_if(v.isNull()).alias("nulos"), F.min("fecha_hora").alias("primera"), F.max("fecha_hora").alias("ultima"))


@query("SELECT count(DISTINCT CASE WHEN parent_id IS NOT NULL AND source IS NOT NULL THEN (parent_id, source) END) AS sin_nulos, (SELECT count(*) FROM (SELECT DISTINCT parent_id, source FROM documents)) AS con_nulos FROM documents")
def distinct_tuple_nulls(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "documents").groupBy("parent_id", "source").agg(F.lit(1).alias("_"))
    return p.agg(F.count_if(F.col("parent_id").isNotNull() & F.col("source").isNotNull()).alias("sin_nulos"), F.count("*").alias("con_nulos"))


@query("SELECT event_type, count(DISTINCT CASE WHEN value > 50 THEN user_id END) AS usuarios_altos, count(DISTINCT user_id) AS usuarios FROM events GROUP BY 1")
def conditional_distinct(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").groupBy("event_type", "user_id").agg(F.max("value").alias("m"))
    return e.groupBy("event_type").agg(F.count_if(F.col("m") > 50).alias("usuarios_altos"), F.count("*").alias("usuarios"))


@query(f"""SELECT fecha_hora, max(CASE WHEN codigo_variable = 'PB_NAL' THEN valor END) AS nacional, max(CASE WHEN codigo_variable = 'PB_INT' THEN valor END) AS internacional, max(CASE WHEN codigo_variable = 'PB_TIE' THEN valor END) AS tie,
  count(DISTINCT CASE WHEN codigo_variable IN ('PB_NAL', 'PB_INT', 'PB_TIE') THEN codigo_variable END) = 3 AS completo FROM ({PRICE_SQL}) GROUP BY 1""")
def pivot_conditional(spark: SparkSession, d: str) -> DataFrame:
    r = _canonical(spark, d, "precio_bolsa", PRICE).withColumnRenamed("version_seleccionada", "version")
    return facts.pivot_variables(r, ["fecha_hora"], "codigo_variable", "valor", {"PB_Nal": "nacional", "PB_Int": "internacional", "PB_Tie": "tie"}).select("fecha_hora", "nacional", "internacional", "tie", "completo")


@query("SELECT demanda_key, count(*) AS filas FROM fact_demanda_real GROUP BY 1 HAVING count(*) > 1")
def dup_groups_having(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "fact_demanda_real").groupBy("demanda_key").agg(F.count("*").alias("filas")).where("filas > 1")


@query("SELECT count(*) AS grupos, CAST(sum(n - 1) AS BIGINT) AS sobrantes, max(n) AS mayor, count(*) FILTER (WHERE c) AS en_conflicto FROM (SELECT count(*) AS n, min(l_quantity) <> max(l_quantity) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def nested_agg_dups(spark: SparkSession, d: str) -> DataFrame:
    return X.duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "l_quantity")


@query("SELECT user_id, list_aggregate(list_sort(list(DISTINCT event_type)), 'string_agg', ',') AS tipos FROM events GROUP BY 1")
def sorted_set_string(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("user_id").agg(F.concat_ws(",", F.array_sort(F.collect_set("event_type"))).alias("tipos"))


@query()
def approx_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Rows only: the estimate is engine-specific."""
    return X.completeness(table(spark, d, "generacion_real"), approximate=True)


@query("SELECT event_type, count(value) AS n, round(avg(value), 6) AS media, round(stddev_samp(value), 6) AS desviacion, min(value) AS minimo, max(value) AS maximo, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.5) AS mediana, quantile_disc(value, 0.75) AS q3 FROM events GROUP BY 1")
def numeric_profile(spark: SparkSession, d: str) -> DataFrame:
    return X.numeric(table(spark, d, "events"), ["event_type"], "value").withColumns({c: F.round(c, 6) for c in ("media", "desviacion")})


@query("""WITH q AS (SELECT event_type, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM events GROUP BY 1)
  SELECT event_type, max(q1) AS q1, max(q3) AS q3, count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS atipicos FROM events JOIN q USING (event_type) GROUP BY 1""")
def iqr_outliers(spark: SparkSession, d: str) -> DataFrame:
    return X.iqr_outliers(table(spark, d, "events"), ["event_type"], "value")


@query("SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS estado, max(o_orderdate) AS fecha FROM orders GROUP BY 1")
def max_by_latest(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("estado"), F.max("o_orderdate").alias("fecha"))


@query("SELECT round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 6) AS tasa, count(*) AS n FROM (SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10)")
def last_n_success(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(10)
    return o.agg(F.round(F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)), 6).alias("tasa"), F.count("*").alias("n"))


@query("SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1")
def json_sum(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.sum(F.get_json_object("props", "$.k").try_cast("bigint")).alias("total"))


@query("SELECT dia, tipo, filas, CAST(total AS DOUBLE) AS total FROM (SELECT CAST(ts AS DATE) AS dia, upper(trim(event_type)) AS tipo, count(*) AS filas, sum(CAST(value AS DECIMAL(24,6))) AS total FROM events GROUP BY 1, 2)")
def derived_group(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.to_date("ts").alias("dia"), N.code("event_type").alias("tipo")).agg(F.count("*").alias("filas"), F.sum(_dec("value")).cast("double").alias("total"))


# --- windows, order, sets ---


@query("""SELECT dia, n, round(avg(n) OVER (ORDER BY dia ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS media_7, lag(n) OVER (ORDER BY dia) AS anterior, n - lag(n) OVER (ORDER BY dia) AS cambio, max(dia) OVER () AS ultimo,
  max(CASE WHEN n > 300 THEN dia END) OVER () AS corte FROM (SELECT CAST(ts AS DATE) AS dia, count(*) AS n FROM events GROUP BY 1)""")
def moving_and_lag(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "events").groupBy(F.to_date("ts").alias("dia")).agg(F.count("*").alias("n"))
    w, a = Window.orderBy("dia"), Window.partitionBy()  # one row per day
    return c.select("dia", "n", F.round(F.avg("n").over(w.rowsBetween(-6, 0)), 6).alias("media_7"), F.lag("n").over(w).alias("anterior"), (F.col("n") - F.lag("n").over(w)).alias("cambio"), F.max("dia").over(a).alias("ultimo"), F.max(F.when(F.col("n") > 300, F.col("dia"))).over(a).alias("corte"))


RUNS_SQL = "(SELECT run_id, min(executed_at) AS started_at, max(executed_at) AS finished_at, CASE WHEN bool_and(passed OR NOT is_blocking) THEN 'SUCCESS' ELSE 'FAILED' END AS status, CAST(sum(error_count) AS BIGINT) AS errores FROM data_quality_results GROUP BY 1)"


def _runs(spark: SparkSession, d: str) -> DataFrame:
    ok = F.bool_and(F.col("passed") | ~F.col("is_blocking"))
    return table(spark, d, "data_quality_results").groupBy("run_id").agg(F.min("executed_at").alias("started_at"), F.max("executed_at").alias("finished_at"), F.when(ok, "SUCCESS").otherwise("FAILED").alias("status"), F.sum("error_count").alias("errores"))


@query(f"SELECT run_id, status, CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END AS run_exitoso, round(avg(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END) OVER (ORDER BY started_at, run_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) * 100, 6) AS tasa_exito_10_pct FROM {RUNS_SQL}")
def pipeline_health(spark: SparkSession, d: str) -> DataFrame:
    return V.pipeline_health(_runs(spark, d)).select("run_id", "status", "run_exitoso", "tasa_exito_10_pct")


@query(f"SELECT run_id, status FROM {RUNS_SQL} ORDER BY started_at DESC, run_id DESC LIMIT 1")
def latest_run(spark: SparkSession, d: str) -> DataFrame:
    return V.latest_row(_runs(spark, d), F.desc("started_at"), F.desc("run_id")).select("run_id", "status")


@query(f"SELECT arg_max(status, (started_at, run_id)) AS status, arg_max(errores, (started_at, run_id)) AS errores FROM {RUNS_SQL}")
def last_run_measures(spark: SparkSession, d: str) -> DataFrame:
    return M.last_run(_runs(spark, d), "started_at", ["status", "errores"])


@query("SELECT component, rule_name, count(*) AS ejecuciones, round(avg(error_count), 2) AS duracion_promedio, max(error_count) AS duracion_maxima, round(100 * avg(CASE WHEN passed THEN 1.0 ELSE 0.0 END), 2) AS tasa_exito_pct, max(executed_at) AS ultima_ejecucion, quantile_disc(error_count, 0.95) AS duracion_p95 FROM data_quality_results GROUP BY 1, 2")
def task_performance(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "data_quality_results").select("component", "rule_name", F.when(F.col("passed"), "SUCCESS").otherwise("FAILED").alias("status"), F.col("error_count").alias("duration_seconds"), F.col("executed_at").alias("finished_at"))
    return V.task_performance(t, ["component", "rule_name"])


@query("SELECT component, rule_id, run_id, error_count FROM data_quality_results QUALIFY row_number() OVER (PARTITION BY component, rule_id ORDER BY executed_at DESC, run_id DESC) = 1")
def latest_per_group(spark: SparkSession, d: str) -> DataFrame:
    return versioning.latest(table(spark, d, "data_quality_results"), ["component", "rule_id"], [F.desc("executed_at"), F.desc("run_id")]).select("component", "rule_id", "run_id", "error_count")


@query("""SELECT planta, dia, valor, lag(valor) OVER w AS anterior, round(valor - lag(valor) OVER w, 6) AS cambio, round(CASE WHEN lag(valor) OVER w <> 0 THEN 100 * (valor - lag(valor) OVER w) / lag(valor) OVER w END, 6) AS cambio_pct, date_diff('day', lag(dia) OVER w, dia) AS dias_desde_anterior
  FROM (SELECT upper(trim(codigo_planta)) AS planta, CAST(fecha_inicio AS DATE) AS dia, max(valor) AS valor FROM niveles_embalses GROUP BY 1, 2) WINDOW w AS (PARTITION BY planta ORDER BY dia)""")
def lag_with_gap_days(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "niveles_embalses").groupBy(N.code("codigo_planta").alias("planta"), F.to_date("fecha_inicio").alias("dia")).agg(F.max("valor").alias("valor"))
    return X.changes(n, ["planta"], "dia", "valor").withColumns({"cambio": F.round("cambio", 6), "cambio_pct": F.round("cambio_pct", 6)})


@query("SELECT l_partkey, CAST(sum(CAST(l_quantity AS DECIMAL(24,6))) AS DOUBLE) AS total FROM lineitem GROUP BY 1 ORDER BY total DESC, l_partkey LIMIT 10")
def top_k(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(F.sum(_dec("l_quantity")).cast("double").alias("total")).orderBy(F.desc("total"), "l_partkey").limit(10)


@query("SELECT run_id, rule_id, error_rate FROM data_quality_results ORDER BY error_rate DESC NULLS LAST, run_id, rule_id LIMIT 20")
def nulls_last_sort_limit(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "data_quality_results").orderBy(F.desc_nulls_last("error_rate"), "run_id", "rule_id").limit(20).select("run_id", "rule_id", "error_rate")


@query("SELECT planta, dia, cambio FROM (SELECT upper(trim(codigo_planta)) AS planta, CAST(fecha_inicio AS DATE) AS dia, round(max(valor) - min(valor), 6) AS cambio FROM niveles_embalses GROUP BY 1, 2) ORDER BY abs(cambio) DESC NULLS LAST, planta, dia LIMIT 15")
def sort_by_abs(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "niveles_embalses").groupBy(N.code("codigo_planta").alias("planta"), F.to_date("fecha_inicio").alias("dia")).agg(F.round(F.max("valor") - F.min("valor"), 6).alias("cambio"))
    return n.orderBy(F.desc_nulls_last(F.abs("cambio")), "planta", "dia").limit(15)


@query("SELECT h FROM (SELECT date_trunc('hour', fecha_hora) AS h FROM generacion_real UNION SELECT date_trunc('hour', fecha_hora) FROM precio_bolsa UNION SELECT date_trunc('hour', fecha_hora) FROM fact_demanda_real)")
def union_distinct_spine(spark: SparkSession, d: str) -> DataFrame:
    return M.distinct_union([table(spark, d, t).select(F.date_trunc("hour", "fecha_hora").alias("h")) for t in ("generacion_real", "precio_bolsa", "fact_demanda_real")], "h")


_FRESH = "SELECT '{n}' AS fuente, min(CAST({c} AS DATE)) AS fecha_minima, max(CAST({c} AS DATE)) AS fecha_maxima, count(DISTINCT CAST({c} AS DATE)) AS dias, count(*) AS registros FROM {n}"
SOURCES = {"fact_generacion_real": "fecha_hora", "fact_demanda_real": "fecha_hora", "precio_bolsa": "fecha_hora", "niveles_embalses": "fecha_inicio", "generacion_real": "fecha_hora"}


@query(f"SELECT *, date_diff('day', fecha_maxima, DATE '{TODAY}') AS dias_rezago, date_diff('day', fecha_maxima, DATE '{TODAY}') <= 45 AS cumple, CASE WHEN date_diff('day', fecha_maxima, DATE '{TODAY}') <= 7 THEN 'SALUDABLE' WHEN date_diff('day', fecha_maxima, DATE '{TODAY}') <= 45 THEN 'EN OBSERVACION' ELSE 'INCUMPLIDO' END AS estado FROM ({' UNION ALL '.join(_FRESH.format(n=n, c=c) for n, c in SOURCES.items())})")
def union_all_freshness(spark: SparkSession, d: str) -> DataFrame:
    return V.source_freshness({n: (table(spark, d, n), c) for n, c in SOURCES.items()}, F.to_date(F.lit(TODAY)))


# --- dimensions, facts ---


@query("""SELECT CAST(strftime(f, '%Y%m%d') AS INT) AS fecha_key, CAST(f AS DATE) AS fecha, year(f) AS anio, quarter(f) AS trimestre, month(f) AS mes_numero, CAST(strftime(f, '%Y%m') AS INT) AS anio_mes, week(f) AS semana_anio, dayofyear(f) AS dia_anio, isodow(f) AS dia_semana_numero, isodow(f) >= 6 AS es_fin_semana, last_day(f) AS ultimo_dia_mes
  FROM (SELECT unnest(generate_series(make_date(year(min(fecha_hora)), 1, 1)::TIMESTAMP, make_date(year(max(fecha_hora)) + 2, 12, 31)::TIMESTAMP, INTERVAL 1 DAY)) AS f FROM fact_generacion_real)""")
def calendar_dim(spark: SparkSession, d: str) -> DataFrame:
    return _calendar(table(spark, d, "fact_generacion_real"), "fecha_hora").select("fecha_key", "fecha", "anio", "trimestre", "mes_numero", "anio_mes", "semana_anio", "dia_anio", "dia_semana_numero", "es_fin_semana", "ultimo_dia_mes")


@query("SELECT CAST(i AS INT) AS periodo_key, CAST(i - 1 AS INT) AS hora_inicio, CAST(i % 24 AS INT) AS hora_fin, printf('%02d:00 - %02d:00', i - 1, i % 24) AS etiqueta FROM range(1, 25) t(i)")
def period_dim(spark: SparkSession, d: str) -> DataFrame:
    return D.periods(spark)


@query("""SELECT codigo_planta, nombre_planta, false AS es_registro_inferido FROM plantas WHERE tipo_generacion <> 'SOLAR' UNION ALL
  SELECT k, 'RECURSO SIN MAESTRO - ' || k, true FROM (SELECT DISTINCT upper(trim(codigo_planta)) AS k FROM generacion_real) WHERE k NOT IN (SELECT codigo_planta FROM plantas WHERE tipo_generacion <> 'SOLAR')""")
def inferred_members(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "plantas").where("tipo_generacion <> 'SOLAR'").select("codigo_planta", "nombre_planta")
    return D.with_inferred(m, table(spark, d, "generacion_real"), "codigo_planta", "nombre_planta")


@query("""SELECT upper(trim(codigo_embalse)) AS codigo_embalse, round(CAST(CAST(CASE WHEN abs(latitud) < 1000 THEN latitud END AS DECIMAL(10,7)) AS DOUBLE), 7) AS latitud, coalesce(latitud BETWEEN -90 AND 90 AND longitud BETWEEN -180 AND 180, false) AS coordenadas_validas FROM embalses""")
def reservoir_dim(spark: SparkSession, d: str) -> DataFrame:
    return D.reservoirs(table(spark, d, "embalses")).select("codigo_embalse", _dbl("latitud", 7).alias("latitud"), "coordenadas_validas")


@query("SELECT l_partkey, l_suppkey, n AS relacionados, n = 1 AS es_unica FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN (SELECT l_partkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1) USING (l_partkey)")
def bridge_counts(spark: SparkSession, d: str) -> DataFrame:
    rel = table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
    left = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_partkey").alias("pk"))
    right = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_suppkey").alias("sk"))
    return D.bridge(rel, left, right, ("l_partkey", "pk"), ("l_suppkey", "sk")).select("l_partkey", "l_suppkey", "relacionados", "es_unica")


@query("SELECT o_orderkey, sha256(concat_ws('||', o_orderkey::VARCHAR, coalesce(o_orderstatus, ''), coalesce(o_orderpriority, ''))) AS h FROM orders")
def hash_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", N.record_hash(["o_orderkey", "o_orderstatus", "o_orderpriority"]).alias("h"))


@query(f"""SELECT sha256('GREAL||PT1H||KWH||' || codigo_agente || '||' || codigo_planta || '||' || strftime(fecha_hora, '%Y-%m-%d %H:%M:%S')) AS generacion_key, p.planta_key, fecha_hora, CAST(strftime(fecha_hora, '%Y%m%d') AS INT) AS fecha_key, hour(fecha_hora) + 1 AS periodo_key,
  CAST(CAST(valor AS DECIMAL(24,6)) AS DOUBLE) AS valor, version_seleccionada, prioridad_version FROM ({GEN_SQL}) LEFT JOIN (SELECT codigo_planta, row_number() OVER (ORDER BY codigo_planta) AS planta_key FROM plantas) p USING (codigo_planta)""")
def fact_generation(spark: SparkSession, d: str) -> DataFrame:
    k = Window.orderBy("codigo_planta")  # the plant master is a fixed list
    plants = table(spark, d, "plantas").select("codigo_planta", F.row_number().over(k).alias("planta_key"))
    return facts.build(table(spark, d, "generacion_real"), GEN, plants).withColumn("valor", F.col("valor").cast("double"))


@query(f"SELECT codigo_planta, CAST(fecha_inicio AS DATE) AS dia, round(valor, 6) AS valor, version_seleccionada FROM ({LEVEL_SQL})")
def fact_stored_energy(spark: SparkSession, d: str) -> DataFrame:
    return _canonical(spark, d, "niveles_embalses", LEVEL).select("codigo_planta", F.to_date("fecha_inicio").alias("dia"), _dbl("valor").alias("valor"), "version_seleccionada")


@query(f"SELECT count(*) AS filas, count(*) FILTER (WHERE fecha_hora IS NULL OR coalesce(trim(codigo_variable), '') = '' OR coalesce(trim(codigo_duracion), '') = '' OR coalesce(trim(unidad_medida), '') = '' OR coalesce(trim(codigo_agente), '') = '' OR coalesce(trim(codigo_planta), '') = '') AS claves_invalidas, count(*) FILTER (WHERE valor IS NULL) AS medidas_nulas, count(*) FILTER (WHERE valor < 0) AS medidas_negativas, count(*) FILTER (WHERE ({P}) = 0) AS versiones_desconocidas FROM generacion_real WHERE upper(trim(codigo_variable)) = 'GREAL' AND upper(trim(codigo_duracion)) = 'PT1H' AND upper(trim(unidad_medida)) = 'KWH'")
def fact_gate(spark: SparkSession, d: str) -> DataFrame:
    return facts.gate(table(spark, d, "generacion_real"), GEN)


# --- merge ---


def _snapshots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Customers as target (keys not 1 mod 5) and source (keys not 2 mod 5, balance of 3 mod 5 changed)."""
    c, k = table(spark, d, "customer"), F.col("c_custkey") % 5
    t = c.where(k != 1).select("c_custkey", "c_name", "c_acctbal", F.lit(True).alias("activo"), F.lit(None).cast("date").alias("fecha_retiro"), F.lit("2026-01-01").cast("date").alias("creado"), F.lit("2026-01-01").cast("date").alias("actualizado"))
    s = c.where(k != 2).select("c_custkey", "c_name", F.when(k == 3, F.lit(None)).otherwise(F.col("c_acctbal")).cast("double").alias("c_acctbal"))
    return t, s


NOW = "date'2026-02-02'"
_T = "(SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 5 <> 1)"
_S = "(SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 = 3 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 5 <> 2)"


@query(f"""SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey, CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal, CASE WHEN t.c_custkey IS NULL THEN DATE '2026-02-02' ELSE DATE '2026-01-01' END AS creado,
  CASE WHEN t.c_custkey IS NULL OR (s.c_custkey IS NOT NULL AND s.c_acctbal IS DISTINCT FROM t.c_acctbal) THEN DATE '2026-02-02' ELSE DATE '2026-01-01' END AS actualizado FROM {_T} t FULL JOIN {_S} s ON t.c_custkey = s.c_custkey""")
def merge_upsert(spark: SparkSession, d: str) -> DataFrame:
    t, s = _snapshots(spark, d)
    p = merge.plan(t, s, ["c_custkey"], ["c_name", "c_acctbal"])
    return merge.apply(p, t, ["c_name", "c_acctbal"], F.expr(NOW), created="creado", updated="actualizado").select("c_custkey", "c_acctbal", "creado", "actualizado")


@query(f"SELECT c_custkey, c_acctbal FROM {_S}")
def merge_delete_missing(spark: SparkSession, d: str) -> DataFrame:
    t, s = _snapshots(spark, d)
    p = merge.plan(t, s, ["c_custkey"], ["c_name", "c_acctbal"], missing="delete")
    return merge.apply(p, t, ["c_name", "c_acctbal"], F.expr(NOW), created="creado", updated="actualizado").select("c_custkey", "c_acctbal")


@query(f"SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey, s.c_custkey IS NOT NULL AS activo, CASE WHEN s.c_custkey IS NULL THEN DATE '2026-02-02' END AS fecha_retiro FROM {_T} t FULL JOIN {_S} s ON t.c_custkey = s.c_custkey")
def merge_soft_retire(spark: SparkSession, d: str) -> DataFrame:
    t, s = _snapshots(spark, d)
    p = merge.plan(t, s, ["c_custkey"], ["c_name", "c_acctbal"], missing="retire", active="activo")
    return merge.apply(p, t, ["c_name", "c_acctbal"], F.expr(NOW), created="creado", updated="actualizado", active="activo", retired="fecha_retiro").select("c_custkey", "activo", "fecha_retiro")


@query(f"SELECT CASE WHEN t.c_custkey IS NULL THEN 'insert' WHEN s.c_custkey IS NULL THEN 'retire' WHEN s.c_acctbal IS DISTINCT FROM t.c_acctbal THEN 'update' ELSE 'keep' END AS _action, count(*) AS filas FROM {_T} t FULL JOIN {_S} s ON t.c_custkey = s.c_custkey GROUP BY 1")
def merge_metrics(spark: SparkSession, d: str) -> DataFrame:
    t, s = _snapshots(spark, d)
    return merge.metrics(merge.plan(t, s, ["c_custkey"], ["c_name", "c_acctbal"], missing="retire", active="activo"))


@query(f"SELECT count(*) FILTER (WHERE s.c_custkey IS NULL OR t.c_custkey IS NULL OR s.c_acctbal IS DISTINCT FROM t.c_acctbal OR s.c_name IS DISTINCT FROM t.c_name) AS cambios, (SELECT count(*) FROM {_S}) AS filas FROM (SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 = 3 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 5 <> 2) t FULL JOIN {_S} s ON t.c_custkey = s.c_custkey")
def merge_idempotent(spark: SparkSession, d: str) -> DataFrame:
    t, s = _snapshots(spark, d)
    cols = ["c_name", "c_acctbal"]
    once = merge.apply(merge.plan(t, s, ["c_custkey"], cols, "delete"), t, cols, F.expr(NOW), created="creado", updated="actualizado")
    return merge.plan(once, s, ["c_custkey"], cols, "delete").agg(F.count_if(F.col("_action") != "keep").alias("cambios"), F.count("*").alias("filas"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'INFERIDO:RECURSO ' || p_partkey || '->' || p_name ELSE 'MAESTRO' END AS origen FROM part")
def merge_provenance(spark: SparkSession, d: str) -> DataFrame:
    p, inf = table(spark, d, "part"), F.col("p_partkey") % 3 == 0
    t = p.select("p_partkey", F.when(inf, F.concat(F.lit("RECURSO "), F.col("p_partkey").cast("string"))).otherwise(F.col("p_name")).alias("nombre"), inf.alias("es_registro_inferido"), F.when(~inf, "MAESTRO").alias("origen"))
    s = p.select("p_partkey", F.col("p_name").alias("nombre"), F.lit(False).alias("es_registro_inferido"), F.lit("MAESTRO").alias("origen"))
    cols = ["nombre", "es_registro_inferido"]
    return merge.apply(merge.plan(t, s, ["p_partkey"], cols), t, cols, F.expr(NOW), rules={"origen": D.provenance()}).select("p_partkey", "origen")


@query("SELECT codigo_planta, CASE WHEN old THEN k ELSE (SELECT count(*) FROM plantas WHERE tipo_generacion = 'HIDRAULICA') + row_number() OVER (PARTITION BY old ORDER BY codigo_planta) END AS planta_key FROM (SELECT codigo_planta, coalesce(tipo_generacion = 'HIDRAULICA', false) AS old, row_number() OVER (PARTITION BY coalesce(tipo_generacion = 'HIDRAULICA', false) ORDER BY codigo_planta) AS k FROM plantas)")
def surrogate_keys(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "plantas").select("codigo_planta", "tipo_generacion")
    none = p.select("codigo_planta", F.lit(0).cast("long").alias("planta_key")).limit(0)
    old = merge.surrogate_keys(p.where("tipo_generacion = 'HIDRAULICA'"), none, ["codigo_planta"], "planta_key")
    return merge.surrogate_keys(p, old, ["codigo_planta"], "planta_key")


@query("SELECT coalesce(t.k, s.k) AS k, coalesce(t.v, s.v) AS v FROM (SELECT n_nationkey AS k, n_name AS v FROM nation WHERE n_nationkey < 10) t FULL JOIN (SELECT n_nationkey AS k, 'SEMILLA' AS v FROM nation) s USING (k)")
def seed_if_absent(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    return merge.insert_absent(n.where("n_nationkey < 10").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("v")), n.select(F.col("n_nationkey").alias("k"), F.lit("SEMILLA").alias("v")), ["k"])


_LASTQ = "(SELECT * FROM data_quality_results QUALIFY row_number() OVER (PARTITION BY rule_id ORDER BY executed_at DESC, run_id DESC) = 1)"


@query(f"""SELECT rule_id, status, count(*) AS n FROM (SELECT rule_id, CASE WHEN passed THEN 'RESOLVED' ELSE 'OPEN' END AS status FROM {_LASTQ} UNION ALL SELECT rule_id, 'OPEN' FROM {_LASTQ} WHERE NOT passed AND is_blocking) GROUP BY 1, 2""")
def alert_lifecycle(spark: SparkSession, d: str) -> DataFrame:
    res = versioning.latest(table(spark, d, "data_quality_results"), ["rule_id"], [F.desc("executed_at"), F.desc("run_id")])
    now = F.lit("2026-07-15").cast("timestamp")
    old = res.select(F.concat(F.lit("a"), "rule_id").alias("alert_id"), "rule_id", F.lit("r0").alias("run_id"), F.lit("OPEN").alias("status"), now.alias("created_at"), F.lit(None).cast("timestamp").alias("resolved_at"))
    return quality.open_alerts(old, res, "r1", now).groupBy("rule_id", "status").agg(F.count("*").alias("n"))


# --- quality ---


@query("""SELECT 'negativo' AS rule_name, count(*) FILTER (WHERE valor < 0) AS error_count, count(*) FILTER (WHERE valor < 0) = 0 AS passed FROM generacion_real UNION ALL SELECT 'nulo', count(*) FILTER (WHERE valor IS NULL), count(*) FILTER (WHERE valor IS NULL) = 0 FROM generacion_real
  UNION ALL SELECT 'sin agente', count(*) FILTER (WHERE codigo_agente IS NULL), count(*) FILTER (WHERE codigo_agente IS NULL) = 0 FROM generacion_real""")
def fused_rules(spark: SparkSession, d: str) -> DataFrame:
    r = [quality.Rule("gen", "negativo", F.col("valor") < 0), quality.Rule("gen", "nulo", F.col("valor").isNull()), quality.Rule("gen", "sin agente", F.col("codigo_agente").isNull(), blocking=True)]
    return quality.evaluate(table(spark, d, "generacion_real"), r).select("rule_name", "error_count", "passed")


@query("SELECT count(*) AS filas, count(*) FILTER (WHERE l_partkey IS NULL) AS nulos, count(*) FILTER (WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)) AS huerfanos FROM lineitem")
def foreign_key_coverage(spark: SparkSession, d: str) -> DataFrame:
    return quality.foreign_key(table(spark, d, "lineitem"), "l_partkey", table(spark, d, "part").where("p_size <= 25"), "p_partkey")


@query(f"SELECT count(*) AS filas, count(*) FILTER (WHERE ({P.replace('version', 'version_seleccionada')}) IS DISTINCT FROM prioridad_version) AS prioridad_distinta, count(*) FILTER (WHERE ({P.replace('version', 'version_seleccionada')}) = 0) AS version_desconocida FROM fact_demanda_real")
def version_consistency(spark: SparkSession, d: str) -> DataFrame:
    return quality.version_consistency(table(spark, d, "fact_demanda_real"), "version_seleccionada", "prioridad_version")


@query("""WITH c AS (SELECT CAST(fecha_hora AS DATE) AS f, count(*) AS n, count(DISTINCT hour(fecha_hora)) AS h FROM fact_demanda_real WHERE fecha_hora IS NOT NULL GROUP BY 1), s AS (SELECT CAST(unnest(generate_series(min(f)::TIMESTAMP, max(f)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS f FROM c), m AS (SELECT quantile_disc(n, 0.5) AS mediana FROM c)
  SELECT count(*) AS dias, count(*) FILTER (WHERE coalesce(h, 0) <> 24) AS dias_incompletos, count(*) FILTER (WHERE coalesce(n, 0) < mediana * 0.5 OR coalesce(n, 0) > mediana * 2.0) AS dias_atipicos, max(mediana) AS mediana FROM s LEFT JOIN c USING (f), m""")
def coverage_and_drift(spark: SparkSession, d: str) -> DataFrame:
    """Over all readings."""
    return quality.coverage_and_drift(table(spark, d, "fact_demanda_real"), "fecha_hora")


@query("SELECT count(*) AS filas, count(DISTINCT generacion_key) AS claves, CAST(sum(generacion_real_kwh) AS DOUBLE) AS total, CAST(sum(('0x' || substr(md5(concat_ws('|', generacion_key, CAST(CAST(generacion_real_kwh AS DECIMAL(24,6)) AS VARCHAR))), 1, 8))::BIGINT) AS DOUBLE) AS huella FROM fact_generacion_real")
def fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return quality.fingerprint(table(spark, d, "fact_generacion_real"), "generacion_key", "generacion_real_kwh").select("filas", "claves", F.col("total").cast("double").alias("total"), F.col("huella").cast("double").alias("huella"))


@query("SELECT rule_id, round(avg(error_rate), 6) AS valor, coalesce(round(avg(error_rate), 6) <= 0.05, false) AS cumple FROM data_quality_results GROUP BY 1")
def slo_eval(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "data_quality_results").groupBy("rule_id").agg(F.round(F.avg("error_rate"), 6).alias("valor")).withColumns({"operador": F.lit("<="), "umbral": F.lit(0.05)})
    return quality.slo(s).select("rule_id", "valor", "cumple")


# --- views, measures ---


def _gold(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Facts of the views. Availability, which the tables lack, is generation of plants with odd keys times 1.25 plus 10."""
    g = table(spark, d, "fact_generacion_real")
    a = g.where("planta_key % 2 = 1").select("fecha_key", "periodo_key", "planta_key", "fecha_hora", (F.col("generacion_real_kwh") * F.lit("1.25").cast("decimal(5,2)") + 10).cast("decimal(24,6)").alias("disponibilidad_real_kwh"))
    dem = table(spark, d, "fact_demanda_real").withColumn("fecha_hora", F.date_trunc("hour", "fecha_hora"))
    r = _canonical(spark, d, "precio_bolsa", PRICE).withColumnRenamed("version_seleccionada", "version")
    p = facts.pivot_variables(r.withColumn("valor", _dec("valor")), ["fecha_hora"], "codigo_variable", "valor", {"PB_Nal": "precio_nacional", "PB_Int": "precio_internacional", "PB_Tie": "precio_tie"})
    return g, a, dem, p


_G = "(SELECT fecha_key, planta_key, fecha_hora, generacion_real_kwh FROM fact_generacion_real)"
_A = "(SELECT fecha_key, planta_key, fecha_hora, CAST(generacion_real_kwh * 1.25 + 10 AS DECIMAL(24,6)) AS disponibilidad_real_kwh FROM fact_generacion_real WHERE planta_key % 2 = 1)"
_DEM = "(SELECT * REPLACE (date_trunc('hour', fecha_hora) AS fecha_hora) FROM fact_demanda_real)"
_PR = f"(SELECT fecha_hora, max(CASE WHEN codigo_variable = 'PB_NAL' THEN CAST(valor AS DECIMAL(24,6)) END) AS precio_nacional FROM ({PRICE_SQL}) GROUP BY 1)"
HOURLY_SQL = f"""(SELECT CAST(strftime(h.fecha_hora, '%Y%m%d') AS INT) AS fecha_key, hour(h.fecha_hora) + 1 AS periodo, h.fecha_hora, CAST(h.fecha_hora AS DATE) AS fecha, g.v AS generacion_real_kwh, m.v AS demanda_total_kwh, m.r AS demanda_regulada_kwh, a.v AS disponibilidad_real_kwh, p.precio_nacional,
    g.v - m.v AS balance_kwh, a.v - g.v AS margen_kwh
  FROM (SELECT fecha_hora FROM fact_generacion_real UNION SELECT fecha_hora FROM {_DEM} UNION SELECT fecha_hora FROM precio_bolsa WHERE upper(trim(codigo_duracion)) = 'PT1H') h
  LEFT JOIN (SELECT fecha_hora, sum(generacion_real_kwh) AS v FROM {_G} GROUP BY 1) g USING (fecha_hora) LEFT JOIN (SELECT fecha_hora, sum(disponibilidad_real_kwh) AS v FROM {_A} GROUP BY 1) a USING (fecha_hora)
  LEFT JOIN (SELECT fecha_hora, sum(demanda_real_kwh) AS v, sum(CASE WHEN upper(trim(tipo_mercado)) = 'REGULADO' THEN demanda_real_kwh ELSE 0 END) AS r FROM {_DEM} GROUP BY 1) m USING (fecha_hora) LEFT JOIN {_PR} p USING (fecha_hora) WHERE h.fecha_hora IS NOT NULL)"""


@query(f"SELECT fecha_hora, periodo, CAST(generacion_real_kwh AS DOUBLE) AS generacion, CAST(demanda_total_kwh AS DOUBLE) AS demanda, CAST(demanda_regulada_kwh AS DOUBLE) AS regulada, CAST(disponibilidad_real_kwh AS DOUBLE) AS disponibilidad, CAST(precio_nacional AS DOUBLE) AS precio, CAST(margen_kwh AS DOUBLE) AS margen FROM {HOURLY_SQL}")
def view_hourly_system(spark: SparkSession, d: str) -> DataFrame:
    h = V.hourly_system(*_gold(spark, d))
    c = {"generacion": "generacion_real_kwh", "demanda": "demanda_total_kwh", "regulada": "demanda_regulada_kwh", "disponibilidad": "disponibilidad_real_kwh", "precio": "precio_nacional", "margen": "margen_kwh"}
    return h.select("fecha_hora", "periodo", *[F.col(v).cast("double").alias(k) for k, v in c.items()])


DAILY_SQL = f"""(SELECT fecha_key, fecha, round(CAST(sum(generacion_real_kwh) AS DOUBLE) / 1000000, 3) AS generacion_gwh, round(CAST(sum(demanda_total_kwh) AS DOUBLE) / 1000000, 3) AS demanda_gwh, round(CAST(sum(disponibilidad_real_kwh) AS DOUBLE) / 1000000, 3) AS disponibilidad_gwh,
   round(100 * CAST(sum(generacion_real_kwh) AS DOUBLE) / nullif(CAST(sum(disponibilidad_real_kwh) AS DOUBLE), 0), 2) AS utilizacion_pct, round(avg(precio_nacional), 2) AS precio_promedio, count(DISTINCT fecha_hora) AS horas_con_datos FROM {HOURLY_SQL} GROUP BY 1, 2)"""


@query(f"SELECT * FROM {DAILY_SQL}")
def view_daily_system(spark: SparkSession, d: str) -> DataFrame:
    return V.daily_system(V.hourly_system(*_gold(spark, d))).select("fecha_key", "fecha", "generacion_gwh", "demanda_gwh", "disponibilidad_gwh", "utilizacion_pct", _dbl("precio_promedio", 2).alias("precio_promedio"), "horas_con_datos")


@query(f"""SELECT fecha, round(avg(generacion_gwh) OVER (ORDER BY fecha ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 3) AS generacion_media_7, round(100.0 * horas_con_datos / 24.0, 2) AS completitud_pct,
  max(CASE WHEN generacion_gwh IS NOT NULL AND disponibilidad_gwh IS NOT NULL AND demanda_gwh IS NOT NULL AND precio_promedio IS NOT NULL AND horas_con_datos = 24 THEN fecha END) OVER () AS fecha_corte FROM {DAILY_SQL}""")
def view_kpi_daily(spark: SparkSession, d: str) -> DataFrame:
    k = V.kpi_daily(V.daily_system(V.hourly_system(*_gold(spark, d))))
    return k.select("fecha", "generacion_media_7", F.col("completitud_pct").cast("double").alias("completitud_pct"), "fecha_corte")


@query("""SELECT fecha_key, upper(trim(tipo_mercado)) AS tipo_mercado, round(CAST(sum(demanda_real_kwh) AS DOUBLE) / 1000000, 3) AS demanda_gwh, round(CAST(max(demanda_real_kwh) AS DOUBLE) / 1000, 3) AS demanda_pico_mw, count(DISTINCT agente_key) AS agentes, count(DISTINCT fecha_hora) AS horas_con_datos,
  CAST(fecha_key // 10000 AS INT) AS anio FROM fact_demanda_real GROUP BY 1, 2""")
def view_demand_market(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "fact_demanda_real")
    return V.demand_by_market(f, _calendar(f, "fecha_hora")).select("fecha_key", "tipo_mercado", "demanda_gwh", "demanda_pico_mw", "agentes", "horas_con_datos", "anio")


@query("""SELECT fecha_key, d.agente_key, upper(trim(tipo_mercado)) AS tipo_mercado, any_value(a.codigo_agente) AS codigo_agente, round(CAST(sum(demanda_real_kwh) AS DOUBLE) / 1000000, 3) AS demanda_gwh, count(DISTINCT fecha_hora) AS horas_con_datos FROM fact_demanda_real d LEFT JOIN dim_agente a USING (agente_key) GROUP BY 1, 2, 3""")
def view_demand_agent(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "fact_demanda_real")
    return V.demand_by_agent(f, _calendar(f, "fecha_hora"), table(spark, d, "dim_agente")).select("fecha_key", "agente_key", "tipo_mercado", "codigo_agente", "demanda_gwh", "horas_con_datos")


PLANT_SQL = f"""(SELECT fecha_key, planta_key, p.tipo_generacion, p.cap_efectiva_neta, round(CAST(g AS DOUBLE) / 1000000, 3) AS generacion_gwh, round(CAST(a AS DOUBLE) / 1000000, 3) AS disponibilidad_gwh, gh AS horas_generacion, round(100 * CAST(g AS DOUBLE) / nullif(CAST(a AS DOUBLE), 0), 2) AS utilizacion_pct,
   CASE WHEN g IS NULL THEN 'SOLO DISPONIBILIDAD' WHEN a IS NULL THEN 'SOLO GENERACION' WHEN g > a THEN 'GENERACION MAYOR A DISPONIBILIDAD' ELSE 'CONSISTENTE' END AS estado
  FROM (SELECT fecha_key, planta_key, sum(generacion_real_kwh) AS g, count(DISTINCT fecha_hora) AS gh FROM {_G} GROUP BY 1, 2) FULL JOIN (SELECT fecha_key, planta_key, sum(disponibilidad_real_kwh) AS a FROM {_A} GROUP BY 1, 2) USING (fecha_key, planta_key)
  LEFT JOIN (SELECT row_number() OVER (ORDER BY codigo_planta) AS planta_key, tipo_generacion, cap_efectiva_neta FROM plantas) p USING (planta_key))"""


def _plants(spark: SparkSession, d: str) -> DataFrame:
    k = Window.orderBy("codigo_planta")  # the plant master is a fixed list
    return table(spark, d, "plantas").select(F.row_number().over(k).cast("long").alias("planta_key"), "tipo_generacion", "cap_efectiva_neta")


def _plant_daily(spark: SparkSession, d: str) -> DataFrame:
    g, a, _, _ = _gold(spark, d)
    return V.plant_daily(g, a, _plants(spark, d))


@query(f"SELECT fecha_key, planta_key, tipo_generacion, generacion_gwh, disponibilidad_gwh, horas_generacion, utilizacion_pct, estado FROM {PLANT_SQL}")
def view_plant_daily(spark: SparkSession, d: str) -> DataFrame:
    return _plant_daily(spark, d).select("fecha_key", "planta_key", "tipo_generacion", "generacion_gwh", "disponibilidad_gwh", "horas_generacion", "utilizacion_pct", "estado")


@query(f"SELECT fecha_key, coalesce(nullif(trim(tipo_generacion), ''), 'SIN CLASIFICAR') AS tipo_generacion, round(CAST(sum(CAST(generacion_gwh AS DECIMAL(24,3))) AS DOUBLE), 3) AS generacion_gwh, count(DISTINCT planta_key) AS plantas FROM {PLANT_SQL} GROUP BY 1, 2")
def view_by_technology(spark: SparkSession, d: str) -> DataFrame:
    return V.by_technology(_plant_daily(spark, d)).select("fecha_key", "tipo_generacion", "generacion_gwh", "plantas")


_EN = "(SELECT upper(trim(codigo_planta)) AS planta, CAST(fecha_inicio AS DATE) AS fecha, max(round(valor / 1000000, 6)) AS energia_gwh FROM niveles_embalses GROUP BY 1, 2)"


def _energy(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "niveles_embalses").groupBy(N.code("codigo_planta").alias("planta"), F.to_date("fecha_inicio").alias("fecha")).agg(F.max(F.round(F.col("valor") / 1000000, 6)).alias("energia_gwh"))
    r = table(spark, d, "plantas_reservorios").where("codigo_embalse is not null").withColumn("planta", F.col("codigo_embalse")).withColumn("codigo_embalse", F.coalesce("codigo_planta", "nombre_planta"))
    return V.stored_energy(e, r, (APPROVED, "pendiente"), reviewed=False)  # nearly all relations here wait for a review


ENERGY_SQL = f"""(SELECT e.planta, e.fecha, e.energia_gwh, count(DISTINCT coalesce(r.codigo_planta, r.nombre_planta)) AS embalses, CASE WHEN count(DISTINCT coalesce(r.codigo_planta, r.nombre_planta)) = 1 THEN 'RELACION UNICA' WHEN count(DISTINCT coalesce(r.codigo_planta, r.nombre_planta)) > 1 THEN 'RELACION MULTIPLE' ELSE 'SIN RELACION' END AS estado_relacion
  FROM {_EN} e LEFT JOIN plantas_reservorios r ON e.planta = r.codigo_embalse AND r.activo AND r.permite_atribucion AND lower(trim(r.estado_validacion)) IN ('aprobado', 'pendiente')
  AND e.fecha >= coalesce(r.valido_desde, DATE '1900-01-01') AND e.fecha <= coalesce(r.valido_hasta, DATE '9999-12-31') GROUP BY 1, 2, 3)"""


@query(f"SELECT * FROM {ENERGY_SQL}")
def view_stored_energy(spark: SparkSession, d: str) -> DataFrame:
    return _energy(spark, d).select("planta", "fecha", "energia_gwh", "embalses", "estado_relacion")


@query(f"""SELECT fecha, energia_gwh, directa_gwh, plantas, lag(energia_gwh) OVER (ORDER BY fecha) AS dia_anterior_gwh, round(energia_gwh - lag(energia_gwh) OVER (ORDER BY fecha), 6) AS variacion_gwh, max(fecha) OVER () AS fecha_maxima FROM
  (SELECT fecha, CAST(sum(CAST(energia_gwh AS DECIMAL(24,6))) AS DOUBLE) AS energia_gwh, CAST(sum(CASE WHEN estado_relacion = 'RELACION UNICA' THEN CAST(energia_gwh AS DECIMAL(24,6)) ELSE 0 END) AS DOUBLE) AS directa_gwh, count(DISTINCT planta) AS plantas FROM {ENERGY_SQL} GROUP BY 1)""")
def view_stored_energy_daily(spark: SparkSession, d: str) -> DataFrame:
    return V.stored_energy_daily(_energy(spark, d)).select("fecha", "energia_gwh", "directa_gwh", "plantas", "dia_anterior_gwh", "variacion_gwh", "fecha_maxima")


@query(f"SELECT tipo_generacion, CAST(sum(CAST(generacion_gwh AS DECIMAL(24,6))) AS DOUBLE) AS generacion_gwh, CAST(sum(CAST(disponibilidad_gwh AS DECIMAL(24,6))) AS DOUBLE) AS disponibilidad_gwh FROM {PLANT_SQL} GROUP BY 1")
def measure_sums(spark: SparkSession, d: str) -> DataFrame:
    return M.sums(_plant_daily(spark, d), ["tipo_generacion"], ["generacion_gwh", "disponibilidad_gwh"])


@query(f"SELECT tipo_generacion, round(sum(c), 6) AS capacidad_mw FROM (SELECT tipo_generacion, planta_key, max(cap_efectiva_neta) AS c FROM {PLANT_SQL} GROUP BY 1, 2) GROUP BY 1")
def measure_capacity(spark: SparkSession, d: str) -> DataFrame:
    return M.max_then_sum(_plant_daily(spark, d), ["tipo_generacion"], "planta_key", "cap_efectiva_neta", "capacidad_mw").withColumn("capacidad_mw", F.round("capacidad_mw", 6))


@query(f"SELECT tipo_generacion, round(avg(CAST(s AS DOUBLE)), 6) AS promedio FROM (SELECT tipo_generacion, fecha_key, sum(CAST(disponibilidad_gwh AS DECIMAL(24,6))) AS s FROM {PLANT_SQL} GROUP BY 1, 2) GROUP BY 1")
def measure_avg_of_sums(spark: SparkSession, d: str) -> DataFrame:
    return M.sum_then_avg(_plant_daily(spark, d), ["tipo_generacion"], "fecha_key", "disponibilidad_gwh", "promedio").withColumn("promedio", F.round("promedio", 6))


@query(f"SELECT tipo_generacion, round(CAST(sum(CAST(generacion_gwh AS DECIMAL(24,6))) AS DOUBLE) * 1000 / (CAST(sum(CAST(cap_efectiva_neta AS DECIMAL(24,6))) AS DOUBLE) * 24), 8) AS factor_capacidad FROM {PLANT_SQL} WHERE cap_efectiva_neta > 0 GROUP BY 1")
def measure_capacity_factor(spark: SparkSession, d: str) -> DataFrame:
    return M.capacity_factor(_plant_daily(spark, d), ["tipo_generacion"], "generacion_gwh", "cap_efectiva_neta")


@query(f"SELECT estado_relacion, max(fecha) AS fecha, CAST(sum(CASE WHEN fecha = m THEN CAST(energia_gwh AS DECIMAL(24,6)) END) AS DOUBLE) AS energia_gwh FROM (SELECT *, max(fecha) OVER (PARTITION BY estado_relacion) AS m FROM {ENERGY_SQL}) GROUP BY 1")
def measure_semi_additive(spark: SparkSession, d: str) -> DataFrame:
    return M.at_latest(_energy(spark, d), ["estado_relacion"], "fecha", ["energia_gwh"])


@query("SELECT count(*) AS dias_completos FROM (SELECT fecha_key, min(h) AS m FROM (SELECT fecha_key, tipo_mercado, count(DISTINCT hour(fecha_hora)) AS h FROM fact_demanda_real GROUP BY 1, 2) GROUP BY 1) WHERE m = 24")
def measure_complete_days(spark: SparkSession, d: str) -> DataFrame:
    h = table(spark, d, "fact_demanda_real").groupBy("fecha_key", "tipo_mercado").agg(F.countDistinct(F.hour("fecha_hora")).alias("h"))
    return M.complete_days(h, "fecha_key", "h")


# --- exploration ---


_DOC = ("doc_id", "text", "lang", "source", "n_chars", "post_type", "parent_id", "answer_rank", "votes", "is_accepted", "author_id", "tags", "created_at")


@query("SELECT columna, (SELECT count(*) FROM documents) AS filas, nulos, vacios, distintos FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS columna, count(*) FILTER (WHERE {c} IS NULL) AS nulos, count(*) FILTER (WHERE trim({c}::VARCHAR) = '') AS vacios, count(DISTINCT {c}) AS distintos FROM documents" for c in _DOC) + ")")
def completeness_profile(spark: SparkSession, d: str) -> DataFrame:
    """Every column of the table."""
    return X.completeness(table(spark, d, "documents"))


@query("SELECT lang, count(*) AS filas FROM documents WHERE lang IS NOT NULL AND upper(trim(lang)) NOT IN ('ES', 'EN', 'PT') GROUP BY 1")
def domain_violations(spark: SparkSession, d: str) -> DataFrame:
    return X.outside_domain(table(spark, d, "documents"), "lang", ["ES", "EN", "PT"])


@query("SELECT source, count(*) AS filas, round(100.0 * count(*) / (SELECT count(*) FROM documents), 4) AS pct FROM documents GROUP BY 1")
def categories(spark: SparkSession, d: str) -> DataFrame:
    return X.categories(table(spark, d, "documents"), "source")


@query("SELECT f AS fecha FROM (SELECT CAST(unnest(generate_series(min(o_orderdate)::DATE::TIMESTAMP, max(o_orderdate)::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS f FROM orders) WHERE f NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderdate IS NOT NULL)")
def missing_days(spark: SparkSession, d: str) -> DataFrame:
    """Over all orders."""
    return X.missing_days(table(spark, d, "orders"), "o_orderdate")


@query("SELECT count(*) AS dias, count(*) FILTER (WHERE n < 24) AS incompletos, min(n) AS minimo FROM (SELECT upper(trim(codigo_planta)) AS p, CAST(fecha_hora AS DATE) AS f, count(DISTINCT hour(fecha_hora)) AS n FROM generacion_real GROUP BY 1, 2)")
def hour_continuity(spark: SparkSession, d: str) -> DataFrame:
    return X.continuity(table(spark, d, "generacion_real").select(N.code("codigo_planta").alias("p"), "fecha_hora"), ["p"], "fecha_hora")


@query("SELECT min(x) AS minimo, quantile_disc(x, 0.5) AS mediana, quantile_disc(x, 0.95) AS p95, max(x) AS maximo, count(*) FILTER (WHERE x < 0) AS futuros FROM (SELECT date_diff('day', CAST(fecha_hora AS DATE), CAST(ingestion_timestamp AS DATE)) AS x FROM generacion_real)")
def load_lag(spark: SparkSession, d: str) -> DataFrame:
    return X.lag_profile(table(spark, d, "generacion_real"), "fecha_hora", "ingestion_timestamp")


@query("SELECT codigo_agente, count(DISTINCT nombre_agente) AS nombres, list_aggregate(list_sort(list(DISTINCT nombre_agente)), 'string_agg', ' | ') AS lista FROM dim_agente GROUP BY 1 HAVING count(DISTINCT nombre_agente) > 1")
def name_stability(spark: SparkSession, d: str) -> DataFrame:
    return X.name_stability(table(spark, d, "dim_agente"), "codigo_agente", "nombre_agente")


@query("SELECT count(*) FILTER (WHERE trim(tags) <> '' AND TRY_CAST(trim(tags) AS DOUBLE) IS NULL) AS tags, count(*) FILTER (WHERE trim(post_type) <> '' AND TRY_CAST(trim(post_type) AS DOUBLE) IS NULL) AS post_type FROM documents")
def invalid_numbers(spark: SparkSession, d: str) -> DataFrame:
    return X.invalid_numbers(table(spark, d, "documents"), ["tags", "post_type"])


@query(f"SELECT count(*) AS pares, count(*) FILTER (WHERE g > a * 1.05) AS excesos, round(CAST(sum(g) AS DOUBLE) / CAST(sum(a) AS DOUBLE), 6) AS razon FROM (SELECT fecha_hora, planta_key, sum(generacion_real_kwh) AS g FROM {_G} GROUP BY 1, 2) JOIN (SELECT fecha_hora, planta_key, sum(disponibilidad_real_kwh) AS a FROM {_A} GROUP BY 1, 2) USING (fecha_hora, planta_key)")
def coherence_ratio(spark: SparkSession, d: str) -> DataFrame:
    g, a, _, _ = _gold(spark, d)
    k = ["fecha_hora", "planta_key"]
    return X.coherence(g.groupBy(*k).agg(F.sum("generacion_real_kwh").alias("g")), a.groupBy(*k).agg(F.sum("disponibilidad_real_kwh").alias("a")), k, "g", "a")


@query("SELECT metrica, valor, CASE WHEN metrica = 'nulos' THEN CASE WHEN valor >= 0.1 THEN 'ALTA' WHEN valor >= 0.01 THEN 'MEDIA' ELSE 'BAJA' END WHEN metrica = 'negativos' THEN CASE WHEN valor >= 0.01 THEN 'ALTA' WHEN valor >= 0.0001 THEN 'MEDIA' ELSE 'BAJA' END ELSE 'SIN REGLA' END AS severidad FROM (SELECT 'nulos' AS metrica, round(avg(CASE WHEN valor IS NULL THEN 1.0 ELSE 0.0 END), 8) AS valor FROM generacion_real UNION ALL SELECT 'negativos', round(avg(CASE WHEN valor < 0 THEN 1.0 ELSE 0.0 END), 8) FROM generacion_real)")
def scorecard(spark: SparkSession, d: str) -> DataFrame:
    r = lambda c: F.round(F.avg(F.when(c, 1.0).otherwise(0.0)), 8)
    m = table(spark, d, "generacion_real").agg(r(F.col("valor").isNull()).alias("nulos"), r(F.col("valor") < 0).alias("negativos"))
    long = m.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metrica"), F.col(c).alias("valor")) for c in ("nulos", "negativos")])).alias("p")).select("p.*")
    return X.scorecard(long, [("nulos", 0.01, 0.1), ("negativos", 0.0001, 0.01)]).select("metrica", "valor", "severidad")


@query("SELECT CAST(ts AS DATE) AS dia, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'purchase') AS purchase FROM events GROUP BY 1")
def pivot_types(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.to_date("ts").alias("dia"), "event_type", F.lit(1).alias("uno"))
    p = X.pivot(e, ["dia"], "event_type", ["click", "purchase"], "uno")
    return p.select("dia", F.coalesce("click", F.lit(0)).alias("click"), F.coalesce("purchase", F.lit(0)).alias("purchase"))


# --- sources, streaming ---


@query("SELECT event_id, event_type, value FROM events")
def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """All events."""
    path = f"{shared_dir(spark)}/kv_json_{uuid.uuid4().hex}"
    L.publish_json(table(spark, d, "events").select("event_id", "event_type", "value"), path)
    return L.read_json(spark, L.published(spark, path), "event_id long, event_type string, value double")


@query("SELECT CAST(a AS DATE) AS desde, least(CAST(a + INTERVAL 30 DAY AS DATE), DATE '2024-12-31') AS hasta FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-12-31', INTERVAL 31 DAY)) AS a)")
def chunk_windows(spark: SparkSession, d: str) -> DataFrame:
    from datetime import date

    return L.chunk_frame(spark, date(2024, 1, 1), date(2024, 12, 31), 31)


@query("SELECT c_custkey, c_acctbal FROM customer")
def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Extension: customers merged as a stream of files into an empty table, then read back."""
    from kilovela.streaming.upsert import merge_stream

    base = f"{shared_dir(spark)}/kv_stream_{uuid.uuid4().hex}"
    src = f"{base}/in"
    table(spark, d, "customer").select("c_custkey", "c_acctbal").write.parquet(src)
    t = merge.Table(spark, f"{base}/table", ["c_custkey"], buckets=8)
    s = spark.readStream.schema("c_custkey long, c_acctbal double").parquet(src)
    merge_stream(s, t, ["c_custkey"], ["c_acctbal"], [F.desc_nulls_last("c_acctbal")], f"{base}/checkpoint").awaitTermination()
    return t.read()
