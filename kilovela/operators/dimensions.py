"""Builders of calendar, period, type-1, type-2 and bridge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilovela.functions.normalize import code, fold_then_upper, name, record_hash
from kilovela.operators.versioning import latest

# Spanish month and weekday names.
MONTHS = ("Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre")
DAYS = ("Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo")
OPEN_END = "9999-12-31"


def _named(names: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), number.cast("int"))


def calendar(bounds: DataFrame, more_years: int = 2) -> DataFrame:
    """One row per day from January 1st of the first year to December 31st of the last year plus ``more_years``.

    ``bounds`` has one row with the dates ``a`` and ``b``; NULL bounds give no rows.
    """
    days = bounds.where("a is not null and b is not null").select(F.explode(F.sequence(F.make_date(F.year("a"), F.lit(1), F.lit(1)), F.make_date(F.year("b") + more_years, F.lit(12), F.lit(31)))).alias("fecha"))
    d = F.col("fecha")
    iso = ((F.dayofweek(d) + 5) % 7 + 1).cast("int")
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("fecha_key"), d, F.year(d).alias("anio"), F.when(F.month(d) <= 6, 1).otherwise(2).alias("semestre"), F.quarter(d).alias("trimestre"),
        F.month(d).alias("mes_numero"), _named(MONTHS, F.month(d)).alias("mes_nombre"), F.date_format(d, "yyyyMM").cast("int").alias("anio_mes"), F.concat_ws(" ", _named(MONTHS, F.month(d)), F.year(d).cast("string")).alias("anio_mes_nombre"),
        F.weekofyear(d).alias("semana_anio"), F.dayofyear(d).alias("dia_anio"), F.dayofmonth(d).alias("dia_mes"), iso.alias("dia_semana_numero"), _named(DAYS, iso).alias("dia_semana_nombre"),
        (iso >= 6).alias("es_fin_semana"), (F.dayofmonth(d) == 1).alias("es_inicio_mes"), (d == F.last_day(d)).alias("es_fin_mes"), F.last_day(d).alias("ultimo_dia_mes"),
    )


def periods(spark: SparkSession) -> DataFrame:
    """The 24 hourly periods."""
    p = F.col("id").cast("int")
    label = lambda h: F.format_string("%02d:00", h)
    return spark.range(1, 25).select(p.alias("periodo_key"), (p - 1).alias("hora_inicio"), (p % 24).alias("hora_fin"), F.concat(label(p - 1), F.lit(" - "), label(p % 24)).alias("etiqueta"))


def daily_state(df: DataFrame, entity: str, day: str, order: list[Column]) -> DataFrame:
    """One state per entity and day."""
    return latest(df, [entity, day], order)


def scd2(df: DataFrame, entity: str, day: str, attrs: list[str]) -> DataFrame:
    """Versions of a daily state: a version starts where any attribute differs (NULL-safe) from the day before on record and
    ends the day before the next; gaps end nothing. Attributes are compared folded."""
    w = Window.partitionBy(entity).orderBy(day)
    changed = F.lag(day).over(w).isNull()
    for a in attrs:
        changed = changed | ~fold_then_upper(a).eqNullSafe(F.lag(fold_then_upper(a)).over(w))
    marked = df.withColumn("_c", changed.cast("int")).withColumn("numero_version", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    starts = marked.where("_c = 1")
    nxt = F.lead(day).over(w)
    return starts.select(F.col(entity), *attrs, "numero_version", F.col(day).alias("fecha_inicio"), F.coalesce(F.date_sub(nxt, 1), F.to_date(F.lit(OPEN_END))).alias("fecha_fin"), nxt.isNull().alias("es_actual"))


def scd2_invariants(dim: DataFrame, entity: str, tie: str | None = None) -> DataFrame:
    """Violations per rule: more or less than one current version, start after end, overlap, open end not current."""
    far = F.to_date(F.lit(OPEN_END))
    w = Window.partitionBy(entity).orderBy("fecha_inicio", "fecha_fin", *([tie] if tie else []))
    x = dim.withColumn("_prev", F.max("fecha_fin").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    rows = x.agg(F.count_if(F.col("fecha_inicio") > F.col("fecha_fin")).alias("rango_invalido"), F.count_if(F.col("fecha_inicio") <= F.col("_prev")).alias("traslape"), F.count_if(F.col("es_actual") != (F.col("fecha_fin") == far)).alias("fin_abierto"))
    cur = dim.groupBy(entity).agg(F.count_if("es_actual").alias("n")).agg(F.count_if(F.col("n") != 1).alias("actuales"))
    return rows.crossJoin(cur)  # one row each


def with_inferred(master: DataFrame, used: DataFrame, key: str, label: str, prefix: str = "RECURSO SIN MAESTRO - ") -> DataFrame:
    """Master members plus one inferred member for each used key without a master (found by anti-join on distinct keys)."""
    known = master.select(code(key).alias(key)).distinct()
    missing = used.where(F.col(key).isNotNull()).select(code(key).alias(key)).distinct().join(known, key, "left_anti")
    inferred = missing.select(F.col(key), F.concat(F.lit(prefix), F.col(key)).alias(label), F.lit(True).alias("es_registro_inferido"))
    return master.withColumn("es_registro_inferido", F.lit(False)).unionByName(inferred, allowMissingColumns=True)


def provenance() -> Column:
    """Merge rule: the trace an inferred member leaves when its official row arrives."""
    return F.when(F.col("t_es_registro_inferido") & ~F.col("s_es_registro_inferido"), F.concat(F.lit("INFERIDO:"), F.col("t_nombre"), F.lit("->"), F.col("s_nombre"))).otherwise(F.col("t_origen"))


def reservoirs(df: DataFrame) -> DataFrame:
    """Type-1 reservoir dimension: typed coordinates, both normal names, validity."""
    lat, lon = F.col("latitud").try_cast("decimal(10,7)"), F.col("longitud").try_cast("decimal(11,7)")
    ok = F.coalesce(lat.between(-90, 90) & lon.between(-180, 180), F.lit(False))
    return df.select(code("codigo_embalse").alias("codigo_embalse"), name("nombre_embalse").alias("nombre_embalse"), fold_then_upper("nombre_embalse").alias("nombre_normalizado"), lat.alias("latitud"), lon.alias("longitud"), ok.alias("coordenadas_validas"))


def bridge(rel: DataFrame, left: DataFrame, right: DataFrame, left_key: tuple[str, str], right_key: tuple[str, str]) -> DataFrame:
    """Many-to-many relation with both surrogate keys, how many right members each left member has, whether that is one, and a
    hash key. Unresolved sides keep NULL keys."""
    j = rel.join(left.select(left_key[0], left_key[1]), left_key[0], "left").join(right.select(right_key[0], right_key[1]), right_key[0], "left")
    n = j.where(F.col(right_key[1]).isNotNull()).groupBy(left_key[0]).agg(F.countDistinct(right_key[1]).alias("relacionados"))
    return j.join(n, left_key[0], "left").withColumn("relacionados", F.coalesce("relacionados", F.lit(0))).withColumn("es_unica", F.col("relacionados") == 1).withColumn("bridge_key", record_hash([left_key[0], right_key[0]]))


def plant_dimension(master: DataFrame, observed: DataFrame, key: str, label: str, when: str) -> DataFrame:
    """Every master plant with its first and last observation (NULL if never observed), and an inferred member for each observed code
    without a master. Observations are reduced to one row per code before the join, so a hot code costs one row."""
    seen = observed.where(F.col(key).isNotNull()).groupBy(code(key).alias(key)).agg(F.min(F.to_date(when)).alias("fecha_primera_observacion"), F.max(F.to_date(when)).alias("fecha_ultima_observacion"))
    all_ = with_inferred(master, seen, key, label)
    return all_.join(seen, key, "left").withColumn("esta_en_maestro_actual", ~F.col("es_registro_inferido"))


def several_states(df: DataFrame, by: list[str], attrs: list[str]) -> DataFrame:
    """Keys with more than one state (NULL is a state of its own): states are grouped first, then counted."""
    return df.groupBy(*by, *attrs).agg(F.lit(1).alias("_")).groupBy(*by).agg(F.count("*").alias("estados")).where("estados > 1")
