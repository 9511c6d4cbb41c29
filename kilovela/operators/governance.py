"""Relations resolved to codes, and invariants of the governed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilovela.functions.normalize import match_key, name
from kilovela.operators.joins import either, overlapping
from kilovela.operators.versioning import latest, newest_first


def newest_load(df: DataFrame, loaded: str) -> DataFrame:
    """Rows of the latest load time, by one scalar joined back."""
    return df.join(F.broadcast(df.agg(F.max(loaded).alias(loaded))), loaded).select(*df.columns)  # one row


def resolve_relations(rel: DataFrame, plants: DataFrame, reservoirs: DataFrame, aliases: DataFrame, today: Column, approved: str, tie: str) -> DataFrame:
    """Relations with their codes: one row per (nombre_planta, nombre_reservorio), the latest; the plant by its name, the reservoir by its
    name or by an approved alias valid today. ``ambigua`` marks relations for which names are not unique or the two ways disagree;
    incomplete, ambiguous or unapproved ones need a review."""
    r = rel.withColumns({"nombre_planta": name("nombre_planta"), "nombre_reservorio": name("nombre_reservorio")})
    r = r.where((F.col("nombre_planta") != "") & (F.col("nombre_reservorio") != ""))
    r = latest(r, ["nombre_planta", "nombre_reservorio"], newest_first("ingestion_timestamp", "load_date", tie)).drop("codigo_planta", "codigo_embalse")
    r = r.withColumns({"_p": match_key("nombre_planta"), "_e": match_key("nombre_reservorio")})
    p = plants.groupBy(match_key("nombre_planta").alias("_p")).agg(F.min("codigo_planta").alias("codigo_planta"), (F.min("codigo_planta") != F.max("codigo_planta")).alias("_pm"))
    valid = aliases.where((F.col("status") == "APPROVED") & (F.col("valid_from") <= today) & (F.col("valid_to").isNull() | (F.col("valid_to") >= today)))
    a = valid.groupBy(F.col("alias_normalized").alias("_e")).agg(F.min("canonical_code").alias("_alias"), (F.min("canonical_code") != F.max("canonical_code")).alias("_am"))
    e = reservoirs.select(F.col("codigo_embalse").alias("_code"), match_key("nombre_embalse").alias("_name"), "codigo_embalse")
    j = r.join(p, "_p", "left").join(a, "_e", "left").withColumn("_by", F.col("_e"))
    j = either(j, e, ("_by", "_name"), ("_alias", "_code"), "codigo_embalse")
    many = F.coalesce("_pm", F.lit(False)) | F.coalesce("_am", F.lit(False)) | F.col("ambiguo")
    whole = F.col("codigo_planta").isNotNull() & F.col("codigo_embalse").isNotNull()
    return j.select(
        "nombre_planta", "nombre_reservorio", "codigo_planta", "codigo_embalse", F.lower(F.trim("estado_validacion")).alias("estado_validacion"), F.col("codigo_planta").isNotNull().alias("planta_encontrada"),
        F.col("codigo_embalse").isNotNull().alias("embalse_encontrado"), whole.alias("relacion_completa"), many.alias("ambigua"),
        (~whole | many | ~F.coalesce(F.lower(F.trim("estado_validacion")) == approved, F.lit(False))).alias("requiere_revision_manual"),
    )


def plant_invariants(plants: DataFrame) -> DataFrame:
    """Counts of contradictory states of the plant dimension, in one pass."""
    inferred, official = F.col("es_registro_inferido"), F.col("esta_en_maestro_actual")
    first, last = F.col("fecha_primera_observacion"), F.col("fecha_ultima_observacion")
    return plants.agg(F.count("*").alias("plantas"), F.count_if(inferred & official).alias("inferida_y_oficial"), F.count_if(inferred & (first.isNull() | last.isNull())).alias("inferida_sin_fechas"), F.count_if(last < first).alias("rango_invalido"))


def gate(aliases: DataFrame, agents: DataFrame, plants: DataFrame, bridge: DataFrame) -> DataFrame:
    """(control, errores): approved aliases given twice, versions that begin before an earlier one has ended, agents without exactly one
    current version, inferred plants marked official, active relations that are incomplete, under review or of reversed validity."""
    twice = aliases.where(F.col("status") == "APPROVED").groupBy("entity_type", "alias_normalized").count().where("count > 1")
    current = agents.groupBy("codigo_agente").agg(F.count_if("es_actual").alias("n")).where("n <> 1")
    loose = F.col("planta_key").isNull() | F.col("embalse_key").isNull() | F.col("requiere_revision_manual") | F.coalesce(F.col("valido_hasta") < F.col("valido_desde"), F.lit(False))
    parts = {
        "alias_duplicados": twice, "solapamientos_scd2": overlapping(agents, "codigo_agente", "fecha_inicio", "fecha_fin"), "sin_version_actual_unica": current,
        "inferidos_oficiales": plants.where("es_registro_inferido and esta_en_maestro_actual"), "relaciones_invalidas": bridge.where(F.col("activo") & loose),
    }
    out = None
    for control, rows in parts.items():
        one = rows.agg(F.count("*").alias("errores")).select(F.lit(control).alias("control"), "errores")
        out = one if out is None else out.unionByName(one)
    return out
