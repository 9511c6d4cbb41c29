"""Queries of the general data problems (1, 2, 3, 4, 6) and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilovela.operators import anomalies, bitemporal, gridfill, history
from kilovela.operators.profile import ColumnSpec, findings, profile, specs_for
from kilovela.session import table

Query = Callable[[SparkSession, str], DataFrame]

CODE = r"^\s*[A-Za-z0-9_]+\s*$"
WATCHED = {
    "generacion_real": ("source_file_name", [ColumnSpec("valor", "number", low=0.0)]),
    "embalses": ("source_file_name", [ColumnSpec("latitud", "number", low=-90.0, high=90.0)]),
    "data_quality_results": ("run_id", [ColumnSpec("error_rate", "number", low=0.0, high=1.0)]),
}
PATTERNS = {
    "codigo_variable": CODE, "codigo_agente": CODE, "codigo_planta": CODE, "codigo_embalse": CODE, "codigo_duracion": r"^\s*P(T1H|1D)\s*$",
    "unidad_medida": r"(?i)^\s*(kwh|cop/kwh)\s*$", "version": r"(?i)^\s*TX(F|R|[0-9]+)\s*$", "rule_id": r"^[0-9a-f]{20}$", "run_id": r"^run_[0-9_]+$",
    "source_file_name": r"^\w+\.json(\.gz)?$", "severity": r"^(LOW|MEDIUM|HIGH|CRITICAL)$",
}


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return findings([(table(spark, d, t), t, load, specs) for t, (load, specs) in WATCHED.items()])


def p1_profile(spark: SparkSession, d: str) -> DataFrame:
    out = []
    for t, (load, specs) in WATCHED.items():
        df = table(spark, d, t)
        known = {s.name: s for s in specs} | {c: ColumnSpec(c, pattern=p) for c, p in PATTERNS.items()} | {"longitud": ColumnSpec("longitud", "number", -180.0, 180.0)}
        out.append(profile(df, t, load, specs_for(df, known)))
    return _union(out).drop("suma", "suma2")


def p1_columns(spark: SparkSession, d: str) -> DataFrame:
    """Of the profile what SQL can check: counts, exact distincts, mean, deviation and both standardised differences."""
    r = lambda c: F.round(c, 5).alias(c)
    return p1_profile(spark, d).select("tabla", "columna", "carga", "filas", "nulos", "fuera", "distintos", "n", r("media"), r("desviacion"), r("dif_anterior"), r("dif_resto"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    a = bitemporal.agent_at_event(table(spark, d, "fact_generacion_real"), table(spark, d, "dim_agente"))
    return a.where(~F.col("guardado").eqNullSafe(F.col("correcto"))).select("generacion_key", F.col("correcto").alias("agente_key"))


def p2_asof(spark: SparkSession, d: str) -> DataFrame:
    a = bitemporal.agent_at_event(table(spark, d, "fact_generacion_real"), table(spark, d, "dim_agente"))
    return a.select("generacion_key", "guardado", F.col("correcto").alias("agente_key"))


MEASURES = [("generacion_real", "codigo_planta", "fecha_hora", False), ("niveles_embalses", "codigo_planta", "fecha_inicio", True), ("precio_bolsa", "codigo_variable", "fecha_hora", True)]


def _measures(spark: SparkSession, d: str) -> list[tuple[DataFrame, anomalies.Measure]]:
    return [(table(spark, d, t), anomalies.Measure(t, "registro_id", src, when, "valor", low)) for t, src, when, low in MEASURES]


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return anomalies.implausible(_measures(spark, d)).select("tabla", "registro_id")


def p3_context(spark: SparkSession, d: str) -> DataFrame:
    return anomalies.contextual(_measures(spark, d))


def _grid(spark: SparkSession, d: str) -> DataFrame:
    g = gridfill.fill(table(spark, d, "fact_demanda_real"), ["agente_key", "tipo_mercado"], "fecha_hora", "demanda_real_kwh", "demanda_key")
    return g.select("agente_key", "tipo_mercado", gridfill.hour_number(F.col("h")).alias("hora"), "valor", "estado")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _grid(spark, d).where(F.col("estado") != gridfill.OBSERVED).select("agente_key", "tipo_mercado", "hora")


def p4_grid(spark: SparkSession, d: str) -> DataFrame:
    return _grid(spark, d)


def p4_states(spark: SparkSession, d: str) -> DataFrame:
    """Of the grid what SQL can check: every cell's state and the values of the observed ones."""
    seen = F.col("estado") == gridfill.OBSERVED
    return _grid(spark, d).select("agente_key", "tipo_mercado", "hora", "estado", F.when(seen, F.round("valor", 4)).alias("observado"), (~seen & F.col("valor").isNotNull()).alias("estimada"))


def p4_accuracy(spark: SparkSession, d: str) -> DataFrame:
    return gridfill.holdout(table(spark, d, "fact_demanda_real"), ["agente_key", "tipo_mercado"], "fecha_hora", "demanda_real_kwh", "demanda_key")


def p6_history(spark: SparkSession, d: str) -> DataFrame:
    return history.versions(table(spark, d, "agentes"), "codigo_agente", "fecha", ["nombre_agente", "actividad_agente"], "ingestion_timestamp", "registro_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    day = lambda c: F.date_format(c, "yyyyMMdd").cast("long").alias(c)
    return p6_history(spark, d).select("codigo_agente", day("fecha_inicio"), day("fecha_fin"))


QUERIES: dict[str, Query] = {
    "p1_found": p1_found, "p1_profile": p1_profile, "p1_columns": p1_columns, "p2_found": p2_found, "p2_asof": p2_asof, "p3_found": p3_found, "p3_context": p3_context,
    "p4_found": p4_found, "p4_grid": p4_grid, "p4_states": p4_states, "p4_accuracy": p4_accuracy, "p6_found": p6_found, "p6_history": p6_history,
}


def _sql_findings(t: str, col: str, load: str, bad: str) -> str:
    return f"""
    SELECT '{t}' AS tabla, '{col}' AS columna, l AS carga, h AS hallazgo FROM (
      SELECT l, unnest(list_filter([CASE WHEN nn > 0.2 * n THEN 'nulos' END, CASE WHEN bad > 0.05 * (n - nn) THEN 'rango' END,
             CASE WHEN m > 3 * mm OR m < mm / 3 THEN 'distribucion' END], lambda x: x IS NOT NULL)) AS h
      FROM (SELECT *, median(m) OVER () AS mm FROM (
        SELECT {load} AS l, count(*) AS n, count(*) - count({col}) AS nn, count(*) FILTER (WHERE {bad}) AS bad, median({col}) AS m
        FROM {t} WHERE {load} IS NOT NULL GROUP BY 1 HAVING count(*) >= 20)))"""


_TAIL = ["source_file_name", "source_file_path", "ingestion_timestamp", "load_date", "silver_created_at", "silver_updated_at"]
_COLUMNS = {
    "generacion_real": ["registro_id", "codigo_variable", "fecha_hora", "codigo_duracion", "unidad_medida", "codigo_agente", "codigo_planta", "version", "valor", "planta_encontrada", "agente_encontrado", *_TAIL],
    "embalses": ["codigo_embalse", "nombre_embalse", "latitud", "longitud", "tipo_coordenada", "fuente_coordenada", "estado_geocodificacion", "consulta_geocodificacion", "coordenadas_validas", "requiere_revision_manual", *_TAIL],
    "data_quality_results": ["run_id", "rule_id", "component", "rule_name", "quality_dimension", "severity", "is_blocking", "error_count", "error_rate", "passed", "detail", "window_start_date", "window_end_date", "executed_at"],
}
_NUMBERS = {"registro_id": "false", "error_count": "false", "valor": "c < 0", "latitud": "c < -90 OR c > 90", "longitud": "c < -180 OR c > 180", "error_rate": "c < 0 OR c > 1"}


def _sql_columns() -> str:
    parts = []
    for t, columns in _COLUMNS.items():
        load = WATCHED[t][0]
        for c in columns:
            bad = _NUMBERS.get(c) or (f"NOT regexp_matches(CAST(c AS VARCHAR), '{PATTERNS[c]}')" if c in PATTERNS else "false")
            x = "TRY_CAST(c AS DECIMAL(18,6))" if c in _NUMBERS else "CAST(NULL AS DECIMAL(18,6))"
            n = f"count({x})" if c in _NUMBERS else "NULL::BIGINT"
            parts.append(f"SELECT '{t}' AS tabla, '{c}' AS columna, l AS carga, count(*) AS filas, count(*) - count(c) AS nulos, count(*) FILTER (WHERE c IS NOT NULL AND ({bad})) AS fuera, count(DISTINCT c) AS distintos, {n} AS n, sum({x})::DOUBLE AS s, sum(CAST({x} AS DECIMAL(19,6)) * CAST({x} AS DECIMAL(19,6)))::DOUBLE AS q FROM (SELECT CAST({load} AS VARCHAR) AS l, {c} AS c FROM {t}) GROUP BY 1, 2, 3")
    diff = lambda m, v: f"round(CASE WHEN va + {v} > 0 THEN (media - {m}) / sqrt((va + {v}) / 2) END, 5)"
    return f"""WITH u AS ({' UNION ALL '.join(parts)}),
    w AS (SELECT *, CASE WHEN n > 0 THEN s / n END AS media, CASE WHEN n > 0 THEN greatest(q / n - (s / n) * (s / n), 0) END AS va, sum(n) OVER b - coalesce(n, 0) AS rn, sum(s) OVER b - coalesce(s, 0) AS rs, sum(q) OVER b - coalesce(q, 0) AS rq FROM u WINDOW b AS (PARTITION BY tabla, columna)),
    z AS (SELECT *, CASE WHEN rn > 0 THEN rs / rn END AS rm, CASE WHEN rn > 0 THEN greatest(rq / rn - (rs / rn) * (rs / rn), 0) END AS rv, lag(media) OVER o AS pm, lag(va) OVER o AS pv FROM w WINDOW o AS (PARTITION BY tabla, columna ORDER BY carga NULLS FIRST))
    SELECT tabla, columna, carga, filas, nulos, fuera, distintos, n, round(media, 5) AS media, round(sqrt(va), 5) AS desviacion, {diff('pm', 'pv')} AS dif_anterior, {diff('rm', 'rv')} AS dif_resto FROM z"""


def _sql_implausible(t: str, src: str, when: str, low: bool) -> str:
    return f"""
    SELECT '{t}' AS tabla, registro_id FROM (
      WITH b AS (SELECT registro_id, upper(trim({src})) AS s, {when} AS t, valor AS v FROM {t} WHERE valor IS NOT NULL),
      m AS (SELECT s, median(v) AS m FROM b WHERE v > 0 GROUP BY 1),
      p AS (SELECT s, t, CASE WHEN min(v) = max(v) AND min(v) <> 0 THEN min(v) END AS c FROM b GROUP BY 1, 2),
      l AS (SELECT *, CASE WHEN c = lag(c) OVER (PARTITION BY s ORDER BY t) THEN 0 ELSE 1 END AS n FROM p),
      i AS (SELECT *, sum(n) OVER (PARTITION BY s ORDER BY t) AS g FROM l),
      k AS (SELECT *, count(*) OVER (PARTITION BY s, g) AS z FROM i),
      st AS (SELECT s, t FROM k WHERE z >= 6 AND c IS NOT NULL)
      SELECT b.registro_id FROM b LEFT JOIN m USING (s) LEFT JOIN st USING (s, t)
      WHERE v < 0 OR v > 3 * m {"OR v < m / 5" if low else ""} OR st.t IS NOT NULL)"""


def _sql_context(t: str, src: str, when: str, low: bool) -> str:
    """Fences of the source's hour of day from buckets of 1/16 octave, and jumps against the last reading of the period before."""
    b = "CAST(floor(log2(v) * 16) AS INT)"
    q = lambda p: f"min(CASE WHEN upto >= ceil(total * {p}) THEN (lo + hi) / 2 END)"
    return f"""
    SELECT '{t}' AS tabla, registro_id, coalesce(v > q3 + 3 * (q3 - q1) OR v < q1 - 3 * (q3 - q1), false) AS fuera_de_valla, coalesce(abs(v - antes) > (q3 + 3 * (q3 - q1)) - (q1 - 3 * (q3 - q1)), false) AS salto FROM (
      WITH r AS (SELECT registro_id, upper(trim({src})) AS s, {when} AS t, valor AS v, hour({when}) AS h FROM {t} WHERE valor IS NOT NULL AND NOT isnan(valor) AND {src} IS NOT NULL AND {when} IS NOT NULL),
      k AS (SELECT s, h, {b} AS k, count(*) AS n, min(v) AS lo, max(v) AS hi FROM r WHERE v > 0 GROUP BY 1, 2, 3),
      c AS (SELECT *, sum(n) OVER (PARTITION BY s, h ORDER BY k) AS upto, sum(n) OVER (PARTITION BY s, h) AS total FROM k),
      f AS (SELECT s, h, {q(0.25)} AS q1, {q(0.75)} AS q3 FROM c GROUP BY 1, 2),
      p AS (SELECT s, t, arg_max(v, registro_id) AS v FROM r GROUP BY 1, 2),
      l AS (SELECT s, t, lag(v) OVER (PARTITION BY s ORDER BY t) AS antes FROM p)
      SELECT r.*, f.q1, f.q3, l.antes FROM r JOIN l USING (s, t) LEFT JOIN f USING (s, h)) WHERE fuera_de_valla OR salto"""


_ASOF = """
    SELECT f.generacion_key, any_value(f.agente_key) AS guardado, coalesce(arg_max(d.agente_key, d.fecha_inicio), 0) AS agente_key
    FROM fact_generacion_real f LEFT JOIN dim_agente d0 ON d0.agente_key = f.agente_key
    LEFT JOIN dim_agente d ON upper(trim(d.codigo_agente)) = upper(trim(d0.codigo_agente)) AND d.fecha_inicio <= f.fecha_hora::DATE AND d.fecha_creacion <= f.fecha_hora
    GROUP BY 1"""


def _plain(x: str) -> str:
    return f"nullif(trim(regexp_replace(strip_accents(upper({x})), '\\s+', ' ', 'g')), '')"


_HISTORY = f"""
    WITH r AS (SELECT upper(trim(codigo_agente)) AS e, fecha AS f, nombre_agente AS ra, actividad_agente AS rb, {_plain("nombre_agente")} AS a, {_plain("actividad_agente")} AS b
      FROM agentes QUALIFY row_number() OVER (PARTITION BY upper(trim(codigo_agente)), fecha ORDER BY ingestion_timestamp DESC NULLS LAST, registro_id DESC) = 1),
    k AS (SELECT e, f, last_value(a IGNORE NULLS) OVER w AS a, last_value(b IGNORE NULLS) OVER w AS b,
      last_value(CASE WHEN a IS NOT NULL THEN ra END IGNORE NULLS) OVER w AS ra, last_value(CASE WHEN b IS NOT NULL THEN rb END IGNORE NULLS) OVER w AS rb
      FROM r WINDOW w AS (PARTITION BY e ORDER BY f ROWS UNBOUNDED PRECEDING)),
    d AS (SELECT *, row_number() OVER w = 1 OR a IS DISTINCT FROM lag(a) OVER w OR b IS DISTINCT FROM lag(b) OVER w AS st FROM k WINDOW w AS (PARTITION BY e ORDER BY f)),
    v AS (SELECT e AS codigo_agente, CAST(row_number() OVER w AS INTEGER) AS numero_version, ra AS nombre_agente, rb AS actividad_agente, f AS fecha_inicio,
      coalesce(CAST(lead(f) OVER w - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS fecha_fin, lead(f) OVER w IS NULL AS es_actual
      FROM d WHERE st WINDOW w AS (PARTITION BY e ORDER BY f))"""

ORACLES: dict[str, str] = {
    "p1_found": " UNION ALL ".join(
        [_sql_findings("generacion_real", "valor", "source_file_name", "valor < 0"), _sql_findings("embalses", "latitud", "source_file_name", "abs(latitud) > 90"), _sql_findings("data_quality_results", "error_rate", "run_id", "error_rate < 0 OR error_rate > 1")]
    ),
    "p1_columns": _sql_columns(),
    "p2_found": f"SELECT generacion_key, agente_key FROM ({_ASOF}) WHERE guardado IS DISTINCT FROM agente_key",
    "p2_asof": _ASOF,
    "p3_found": " UNION ALL ".join(_sql_implausible(*m) for m in MEASURES),
    "p3_context": " UNION ALL ".join(_sql_context(*m) for m in MEASURES),
    "p4_found": """
    WITH o AS (SELECT DISTINCT agente_key, tipo_mercado, date_trunc('hour', fecha_hora) AS h FROM fact_demanda_real WHERE demanda_real_kwh IS NOT NULL),
    b AS (SELECT agente_key, tipo_mercado, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h FROM o GROUP BY 1, 2)
    SELECT agente_key, tipo_mercado, strftime(h, '%Y%m%d%H')::BIGINT AS hora FROM b ANTI JOIN o USING (agente_key, tipo_mercado, h)""",
    "p4_states": """
    WITH r AS (SELECT DISTINCT agente_key AS a, tipo_mercado AS m, fecha_hora AS t, demanda_key, CAST(demanda_real_kwh AS DOUBLE) AS v FROM fact_demanda_real WHERE demanda_real_kwh IS NOT NULL AND fecha_hora IS NOT NULL),
    o AS (SELECT a, m, date_trunc('hour', t) AS h, avg(v) AS y FROM r GROUP BY ALL), k AS (SELECT a, m FROM o GROUP BY ALL HAVING count(*) >= 8), hh AS (SELECT DISTINCT h FROM o JOIN k ON o.a IS NOT DISTINCT FROM k.a AND o.m IS NOT DISTINCT FROM k.m),
    b AS (SELECT a, m, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h FROM o GROUP BY a, m)
    SELECT b.a AS agente_key, b.m AS tipo_mercado, strftime(b.h, '%Y%m%d%H')::BIGINT AS hora, CASE WHEN o.y IS NOT NULL THEN 'observado' WHEN k.a IS NOT NULL AND hh.h IS NOT NULL THEN 'estimado' ELSE 'sin_soporte' END AS estado,
      round(o.y, 4) AS observado, o.y IS NULL AND k.a IS NOT NULL AND hh.h IS NOT NULL AS estimada
    FROM b LEFT JOIN o ON o.a IS NOT DISTINCT FROM b.a AND o.m IS NOT DISTINCT FROM b.m AND o.h = b.h LEFT JOIN k ON k.a IS NOT DISTINCT FROM b.a AND k.m IS NOT DISTINCT FROM b.m LEFT JOIN hh ON hh.h = b.h""",
    "p6_found": f"{_HISTORY} SELECT codigo_agente, strftime(fecha_inicio, '%Y%m%d')::BIGINT AS fecha_inicio, strftime(fecha_fin, '%Y%m%d')::BIGINT AS fecha_fin FROM v",
    "p6_history": f"{_HISTORY} SELECT * FROM v",
}
