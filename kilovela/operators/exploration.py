"""Exploratory profiles, each a single pass or two nested aggregates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilovela.operators.joins import fill_calendar


def completeness(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Per column: rows, nulls, blanks, distinct values (exact, or approximate in the same pass)."""
    blank = {c for c, t in df.dtypes if t == "string"}
    aggs: list[Column] = [F.count("*").alias("_n")]
    for i, c in enumerate(df.columns):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"u{i}"), (F.count_if(F.trim(c) == "") if c in blank else F.lit(0).cast("long")).alias(f"b{i}")]
        if approximate:
            aggs.append(F.approx_count_distinct(c).alias(f"d{i}"))
    wide = df.agg(*aggs)
    part = lambda i, c: F.struct(F.lit(c).alias("columna"), F.col(f"u{i}").alias("nulos"), F.col(f"b{i}").alias("vacios"), *([F.col(f"d{i}").alias("distintos")] if approximate else []))
    long = wide.select("_n", F.explode(F.array(*[part(i, c) for i, c in enumerate(df.columns)])).alias("p")).select("p.columna", F.col("_n").alias("filas"), "p.nulos", "p.vacios", *(["p.distintos"] if approximate else []))
    if approximate:
        return long
    # exact: one grouped distinct over (column, 128-bit fingerprint of the value), so that no long text is shuffled
    item = lambda i, c: F.struct(F.lit(i).alias("i"), F.xxhash64(c).alias("a"), F.xxhash64(F.lit(7), c).alias("b"), F.col(c).isNotNull().alias("ok"))
    names = F.array(*[F.lit(c) for c in df.columns])
    d = df.select(F.explode(F.array(*[item(i, c) for i, c in enumerate(df.columns)])).alias("p")).select("p.*").where("ok").groupBy("i", "a", "b").agg(F.lit(1).alias("_"))
    d = d.select(F.get(names, F.col("i")).alias("columna"))
    return long.join(d.groupBy("columna").agg(F.count("*").alias("distintos")), "columna", "left").withColumn("distintos", F.coalesce("distintos", F.lit(0)))


def invalid_numbers(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per text column: values that are not blank and no number."""
    bad = lambda c: F.count_if((F.trim(c) != "") & F.trim(c).try_cast("double").isNull()).alias(c)
    return df.agg(*[bad(c) for c in cols])


def duplicates(df: DataFrame, keys: list[str], value: str | None = None) -> DataFrame:
    """Groups of more than one row, the surplus rows, the largest group and, with ``value``, groups whose values conflict."""
    g = df.groupBy(*keys).agg(F.count("*").alias("n"), *([(F.min(value) != F.max(value)).alias("c")] if value else []))
    return g.where("n > 1").agg(F.count("*").alias("grupos"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("sobrantes"), F.max("n").alias("mayor"), *([F.count_if("c").alias("en_conflicto")] if value else []))


def categories(df: DataFrame, col: str) -> DataFrame:
    """Value counts with their percentage of all rows."""
    g = df.groupBy(col).agg(F.count("*").alias("filas"))
    return g.withColumn("pct", F.round(100 * F.col("filas") / F.sum("filas").over(Window.partitionBy()), 4))  # one row per value


def outside_domain(df: DataFrame, col: str, allowed: list[str]) -> DataFrame:
    return df.where(F.col(col).isNotNull() & ~F.upper(F.trim(col)).isin(allowed)).groupBy(col).agg(F.count("*").alias("filas"))


def numeric(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Count, mean, deviation, quartiles (approximate at accuracy 10000) and the count outside the interquartile fences."""
    q = df.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("media"), F.stddev(value).alias("desviacion"), F.min(value).alias("minimo"), F.max(value).alias("maximo"), F.percentile_approx(value, [0.25, 0.5, 0.75], 10000).alias("_q"))
    q = q.select(*by, "n", "media", "desviacion", "minimo", "maximo", *[F.col("_q")[i].alias(c) for i, c in enumerate(("q1", "mediana", "q3"))])
    return q


def iqr_outliers(df: DataFrame, by: list[str], value: str, k: float = 1.5) -> DataFrame:
    q = numeric(df, by, value).select(*by, "q1", "q3")
    j = df.join(F.broadcast(q), by) if not by else df.join(q, by)
    w = F.col("q3") - F.col("q1")
    return j.groupBy(*by).agg(F.max("q1").alias("q1"), F.max("q3").alias("q3"), F.count_if((F.col(value) < F.col("q1") - k * w) | (F.col(value) > F.col("q3") + k * w)).alias("atipicos"))


def missing_days(df: DataFrame, when: str) -> DataFrame:
    per = df.where(F.col(when).isNotNull()).groupBy(F.to_date(when).alias("fecha")).agg(F.count("*").alias("n"))
    return fill_calendar(per, "fecha").where("n is null").select("fecha")


def continuity(df: DataFrame, entity: list[str], when: str) -> DataFrame:
    """Entity-days with and without all 24 hours: distinct hours first, then days, then the total."""
    hours = df.groupBy(*entity, F.to_date(when).alias("d"), F.hour(when).alias("h")).agg(F.lit(1).alias("_"))
    days = hours.groupBy(*entity, "d").agg(F.count("*").alias("n"))
    return days.agg(F.count("*").alias("dias"), F.count_if(F.col("n") < 24).alias("incompletos"), F.min("n").alias("minimo"))


def lag_profile(df: DataFrame, event: str, loaded: str) -> DataFrame:
    """Days from event to load."""
    d = F.datediff(F.to_date(loaded), F.to_date(event))
    return df.agg(F.min(d).alias("minimo"), F.percentile_approx(d, 0.5, 10000).alias("mediana"), F.percentile_approx(d, 0.95, 10000).alias("p95"), F.max(d).alias("maximo"), F.count_if(d < 0).alias("futuros"))


def name_stability(df: DataFrame, key: str, label: str) -> DataFrame:
    return df.groupBy(key).agg(F.countDistinct(label).alias("nombres"), F.concat_ws(" | ", F.array_sort(F.collect_set(label))).alias("lista")).where("nombres > 1")


def coherence(a: DataFrame, b: DataFrame, keys: list[str], left: str, right: str, tolerance: float = 1.05) -> DataFrame:
    """Matched keys, how many exceed the other side times the tolerance, and the ratio of the totals."""
    j = a.join(b, keys)
    return j.agg(F.count("*").alias("pares"), F.count_if(F.col(left) > F.col(right) * tolerance).alias("excesos"), F.round(F.sum(left).cast("double") / F.nullif(F.sum(right).cast("double"), F.lit(0.0)), 6).alias("razon"))


def changes(df: DataFrame, by: list[str], day: str, value: str) -> DataFrame:
    """Change to the previous reading of the entity, in units and percent, and the days between."""
    w = Window.partitionBy(*by).orderBy(day)
    p, d = F.lag(value).over(w), F.lag(day).over(w)
    return df.select(*by, day, value, p.alias("anterior"), (F.col(value) - p).alias("cambio"), F.when(p != 0, 100 * (F.col(value) - p) / p).alias("cambio_pct"), F.datediff(F.col(day), d).alias("dias_desde_anterior"))


def scorecard(measures: DataFrame, thresholds: list[tuple[str, float, float]]) -> DataFrame:
    """(metrica, valor) rows with a severity by thresholds (metric, warn from, fail from), worst first."""
    sev = F.lit("SIN REGLA")
    for m, warn, fail in thresholds:
        sev = F.when(F.col("metrica") == m, F.when(F.col("valor") >= fail, "ALTA").when(F.col("valor") >= warn, "MEDIA").otherwise("BAJA")).otherwise(sev)
    rank = F.create_map(*[F.lit(x) for kv in (("ALTA", 1), ("MEDIA", 2), ("BAJA", 3), ("SIN REGLA", 4)) for x in kv])
    return measures.withColumn("severidad", sev).withColumn("orden", F.element_at(rank, F.col("severidad")))


def pivot(df: DataFrame, rows: list[str], col: str, values: list[str], value: str) -> DataFrame:
    return df.groupBy(*rows).pivot(col, values).agg(F.sum(value))


def dictionary(tables: dict[str, DataFrame]) -> list[tuple[str, int, str, str]]:
    """(table, position, column, type) of every column, from the schemas alone."""
    return [(t, i, c, kind) for t, df in tables.items() for i, (c, kind) in enumerate(df.dtypes, 1)]


def inventory(tables: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """One row per table (frame, event column): rows, columns, files and their bytes, first and last load and event. Loads are
    ``load_date`` and ``ingestion_timestamp`` where the table has them. One aggregate per table; files come from the scan's own metadata."""
    out = None
    for n, (df, event) in tables.items():
        ends = lambda c, label: [F.min(c).cast("timestamp").alias(f"primera_{label}"), F.max(c).cast("timestamp").alias(f"ultima_{label}")] if c in df.columns else [F.lit(None).cast("timestamp").alias(f"primera_{label}"), F.lit(None).cast("timestamp").alias(f"ultima_{label}")]  # noqa: B023, E731
        rows = df.agg(F.count("*").alias("registros"), *ends("load_date", "carga"), *ends("ingestion_timestamp", "ingesta"), *ends(event, "fecha_evento"))
        files = df.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("b")).distinct().agg(F.count("*").alias("archivos"), F.sum("b").alias("bytes"))
        one = rows.crossJoin(files).withColumns({"tabla": F.lit(n), "columnas": F.lit(len(df.columns))})  # one row each
        out = one if out is None else out.unionByName(one)
    return out


def load_lineage(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and span of load times per table, load day and file; tables without one of these columns have it NULL."""
    out = None
    for n, df in tables.items():
        by = [c for c in ("load_date", "source_file_name", "source_file_path") if c in df.columns]
        one = df.groupBy(*by).agg(F.count("*").alias("registros"), F.min("ingestion_timestamp").alias("primera_ingesta"), F.max("ingestion_timestamp").alias("ultima_ingesta")).withColumn("tabla", F.lit(n))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def duplicate_profiles(df: DataFrame, ident: str, payload: list[str], versioned: list[str], canonical: list[str], version: str, value: str) -> DataFrame:
    """Five kinds of duplicates with groups, rows in them, surplus and largest group: equal payload, equal versioned key, equal id,
    keys in several versions, versioned keys with several values."""
    def groups(keys: list[str], of: Column, kind: str) -> DataFrame:
        n = F.coalesce(F.sum("n"), F.lit(0))
        return df.groupBy(*keys).agg(of.alias("n")).where("n > 1").agg(F.count("*").alias("grupos"), n.alias("filas"), (n - F.count("*")).alias("excedentes"), F.coalesce(F.max("n"), F.lit(1)).alias("mayor")).withColumn("perfil", F.lit(kind))

    kinds = [groups(payload, F.count("*"), "payload"), groups(versioned, F.count("*"), "llave_con_version"), groups([ident], F.count("*"), "id"), groups(canonical, F.countDistinct(version), "varias_versiones"), groups(versioned, F.countDistinct(value), "conflicto_de_valor")]
    out = kinds[0]
    for k in kinds[1:]:
        out = out.unionByName(k)
    return out


def hygiene(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per identifier column: rows, nulls, blanks, outer blanks, not upper case, shortest and longest, distinct values; one pass for
    the counts of all columns, and distincts of the few different values by a grouped count."""
    aggs: list[Column] = [F.count("*").alias("_n")]
    for i, c in enumerate(columns):
        x, size = F.col(c), F.length(F.trim(c))
        aggs += [F.count_if(x.isNull()).alias(f"a{i}"), F.count_if(F.trim(x) == "").alias(f"b{i}"), F.count_if(x != F.trim(x)).alias(f"c{i}"), F.count_if(x != F.upper(x)).alias(f"d{i}"), F.min(size).alias(f"e{i}"), F.max(size).alias(f"f{i}")]
    labels = {"a": "nulos", "b": "vacios", "c": "con_espacios", "d": "no_mayuscula", "e": "longitud_min", "f": "longitud_max"}
    row = lambda i, c: F.struct(F.lit(c).alias("columna"), *[F.col(f"{k}{i}").alias(v) for k, v in labels.items()])
    counts = df.agg(*aggs).select(F.col("_n").alias("registros"), F.explode(F.array(*[row(i, c) for i, c in enumerate(columns)])).alias("x")).select("registros", "x.*")
    item = lambda c: F.struct(F.lit(c).alias("columna"), F.col(c).alias("v"))
    one = df.select(F.explode(F.array(*[item(c) for c in columns])).alias("x")).select("x.*").where("v is not null").groupBy("columna", "v").agg(F.lit(1).alias("_"))
    return counts.join(one.groupBy("columna").agg(F.count("*").alias("distintos")), "columna", "left").withColumn("distintos", F.coalesce("distintos", F.lit(0)))


def unmatched_names(typed: DataFrame, column: str, reference: DataFrame, ref_column: str, normal: Callable[[Column], Column]) -> DataFrame:
    """How many distinct typed names there are in normal form, and how many of them no reference name equals."""
    t = typed.select(normal(F.col(column)).alias("n")).distinct()
    r = reference.select(normal(F.col(ref_column)).alias("n")).where("n <> ''").distinct().withColumn("_ok", F.lit(True))
    return t.join(r, "n", "left").agg(F.count("*").alias("valores"), F.count_if(F.col("_ok").isNull()).alias("sin_correspondencia"))


def coordinates(df: DataFrame, lat: str, lon: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows without a usable coordinate, outside the globe, and outside a country's box (south, north, west, east)."""
    y, x = F.col(lat).cast("string").try_cast("double"), F.col(lon).cast("string").try_cast("double")
    south, north, west, east = box
    return df.agg(
        F.count("*").alias("filas"), F.count_if(y.isNull()).alias("latitud_no_valida"), F.count_if(x.isNull()).alias("longitud_no_valida"),
        F.count_if(~y.between(-90, 90) | ~x.between(-180, 180)).alias("fuera_de_rango"), F.count_if(~y.between(south, north) | ~x.between(west, east)).alias("fuera_de_caja"),
    )
