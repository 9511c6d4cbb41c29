"""One builder for all hourly and daily facts: domain filter, canonical version, dimension keys, hash key."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilovela.functions.normalize import code, invalid_key
from kilovela.operators.joins import temporal
from kilovela.operators.versioning import POLICY, canonical, priority


@dataclass(frozen=True)
class FactSpec:
    """What makes a fact: its codes, its time column, its measure, and the values its domain columns must have (compared
    upper-case and trimmed; a column that is not named is not filtered)."""

    name: str
    key: tuple[str, ...]
    when: str
    measure: str
    domain: dict[str, str] = field(default_factory=dict)
    version: str = "version"
    recency: tuple[str, ...] = ("silver_updated_at", "ingestion_timestamp", "load_date")
    tie: tuple[str, ...] = ()


def in_domain(df: DataFrame, spec: FactSpec) -> DataFrame:
    for c, v in spec.domain.items():
        df = df.where(code(c) == v.upper())
    return df


def canonical_rows(df: DataFrame, spec: FactSpec, policy: dict[str, int] = POLICY) -> DataFrame:
    """Domain rows, codes normalised, one row per business key."""
    d = in_domain(df, spec)
    text = [c for c, t in d.select(*spec.key).dtypes if t == "string"]
    d = d.withColumns({c: code(c) for c in [*text, spec.version]})
    return canonical(d, [*spec.key, spec.when] if spec.when not in spec.key else list(spec.key), spec.version, list(spec.recency), policy, spec.tie)


def build(df: DataFrame, spec: FactSpec, plants: DataFrame | None = None, agents: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The fact: calendar and period keys from the time, plant key by code, agent key by code and validity, SHA-256 key over the
    business key, measure as decimal(24,6), selected version and its priority. Plant and agent dimensions are optional; natural codes
    named in ``keep`` stay."""
    f = canonical_rows(df, spec)
    day = F.to_date(spec.when)
    f = f.withColumn("_day", day)
    if plants is not None:
        f = f.join(plants.select("codigo_planta", "planta_key"), "codigo_planta", "left")
    if agents is not None:
        f = temporal(f, agents, ("codigo_agente", "codigo_agente"), "_day", "fecha_inicio", "fecha_fin", ["agente_key"], salts=8)
    keys = [c for c, x in (("planta_key", plants), ("agente_key", agents)) if x is not None]
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (*spec.key, spec.when)]
    return f.select(
        F.sha2(F.concat_ws("||", *parts), 256).alias(f"{spec.name}_key"), F.date_format("_day", "yyyyMMdd").cast("int").alias("fecha_key"), (F.hour(spec.when) + 1).cast("int").alias("periodo_key"), *keys, *keep, spec.when,
        F.col(spec.measure).try_cast("decimal(24,6)").alias(spec.measure), F.col(spec.version).alias("version_seleccionada"), "prioridad_version",
    )


def gate(df: DataFrame, spec: FactSpec, typed: tuple[str, ...] = ()) -> DataFrame:
    """Counts of what must not be in a fact's input, in one pass: invalid keys, null and negative measures, unknown versions."""
    bad = invalid_key(list(spec.key), (*typed, spec.when))
    v = priority(spec.version)
    return in_domain(df, spec).agg(F.count("*").alias("filas"), F.count_if(bad).alias("claves_invalidas"), F.count_if(F.col(spec.measure).isNull()).alias("medidas_nulas"), F.count_if(F.col(spec.measure) < 0).alias("medidas_negativas"), F.count_if(v == 0).alias("versiones_desconocidas"))


def pivot_variables(rows: DataFrame, keys: list[str], variable: str, value: str, names: dict[str, str]) -> DataFrame:
    """Wide row per key out of one canonical row per (key, variable), by conditional aggregates: value, version and priority of
    each variable, and whether all variables are there."""
    aggs = []
    for var, label in names.items():
        hit = code(variable) == var.upper()
        aggs += [F.max(F.when(hit, F.col(value))).alias(label), F.max(F.when(hit, F.col("version"))).alias(f"{label}_version"), F.max(F.when(hit, F.col("prioridad_version"))).alias(f"{label}_prioridad")]
    n = F.countDistinct(F.when(code(variable).isin([v.upper() for v in names]), code(variable)))
    return rows.groupBy(*keys).agg(*aggs, (n == len(names)).alias("completo"))
