"""Loaders of cleaned tables, composed of the library's operators: watermark, normalisation, gate, one row per key, flags, merge."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilovela.functions.normalize import code, invalid_key, name
from kilovela.operators import merge
from kilovela.operators.joins import existence_flag
from kilovela.operators.versioning import latest, newest_first
from kilovela.sources.landing import since_high_water

LINEAGE = ["source_file_name", "source_file_path", "ingestion_timestamp", "load_date"]


@dataclass(frozen=True)
class Load:
    """What a loader needs to know: the key, which columns are codes and which names, the payload, and the order in which rows of
    one key are preferred."""

    key: list[str]
    codes: list[str]
    names: list[str] = field(default_factory=list)
    typed: tuple[str, ...] = ()
    payload: list[str] = field(default_factory=list)
    recency: tuple[str, ...] = ("ingestion_timestamp", "load_date")
    tie: str = "registro_id"


def cleaned(df: DataFrame, spec: Load) -> DataFrame:
    """Codes and names normalised, blank texts NULL in the payload."""
    d = df.withColumns({c: code(c) for c in spec.codes} | {c: name(c) for c in spec.names})
    return d.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in (*spec.codes, *spec.names) if c in spec.payload})


def profile(df: DataFrame, spec: Load) -> DataFrame:
    """Rows, rows with an invalid key and newest load, in one pass: what the gate decides on."""
    return df.agg(F.count("*").alias("filas"), F.count_if(invalid_key(spec.key, spec.typed)).alias("claves_invalidas"), F.max("ingestion_timestamp").alias("ultima_carga"))


def incoming(df: DataFrame, target: DataFrame | None, spec: Load, strict: bool = True) -> DataFrame:
    """One cleaned row per key of what is not older than the target. Invalid keys raise, or are left out if not ``strict``."""
    d = cleaned(since_high_water(df, target, "ingestion_timestamp"), spec)
    if strict and (bad := profile(d, spec).first()["claves_invalidas"]):
        raise ValueError(f"{bad} rows without a full key")
    return latest(d.where(~invalid_key(spec.key, spec.typed)), spec.key, newest_first(*spec.recency, spec.tie))


def load(df: DataFrame, target: DataFrame, spec: Load, now: Column, references: dict[str, tuple[DataFrame, str, str]] | None = None, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(new target, counts per action). ``references``: flag column -> (reference table, its key, the row's column). Every flag says
    whether the row's code is in the reference."""
    d = incoming(df, target, spec, strict)
    for flag, (ref, ref_key, column) in (references or {}).items():
        d = existence_flag(d.drop(flag), ref.select(code(ref_key).alias(ref_key)), column, ref_key, flag)
    columns = [*spec.payload, *(references or {}), *LINEAGE]
    d = d.select(*spec.key, *columns, F.lit(None).cast("timestamp").alias("silver_created_at"), F.lit(None).cast("timestamp").alias("silver_updated_at"))
    p = merge.plan(target.select(*d.columns), d, spec.key, [*spec.payload, *(references or {})])
    return merge.apply(p, target.select(*d.columns), columns, now, created="silver_created_at", updated="silver_updated_at"), merge.metrics(p)
