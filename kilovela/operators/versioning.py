"""Canonical row per business key out of several published versions and loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilovela.functions.normalize import code

# The version policy. A number multiplies n of TXn, the others are priorities.
POLICY = {"TXF": 10000, "TXR": 9000, "TX_NUMERIC": 100}


def load_policy(df: DataFrame) -> dict[str, int]:
    """Active rows of a policy table (version_pattern, priority, multiplier, activo) as a dict. Each known pattern must be there
    exactly once and have a number."""
    weight = F.coalesce("priority", "multiplier").cast("long")
    per = df.where("activo").groupBy("version_pattern").agg(F.count("*").alias("n"), F.max(weight).alias("w")).limit(len(POLICY) + 1).collect()
    wrong = [r["version_pattern"] for r in per if r["n"] != 1 or r["w"] is None or r["version_pattern"] not in POLICY]
    if wrong or len(per) != len(POLICY):
        raise ValueError(f"version policy needs one active number for each of {sorted(POLICY)}; found {sorted(str(r['version_pattern']) for r in per)}, of these not usable {wrong}")
    return {r["version_pattern"]: r["w"] for r in per}


def priority(version: str | Column, policy: dict[str, int] = POLICY) -> Column:
    """Priority of a version: unknown versions 0."""
    v = code(version)
    n = F.regexp_extract(v, "^TX([0-9]+)$", 1)
    numbered = F.least(n.try_cast("decimal(38,0)"), F.lit(10**15).cast("decimal(38,0)")).cast("long")  # beyond it all are alike
    return F.when(v == "TXF", policy["TXF"]).when(v == "TXR", policy["TXR"]).when(n != "", F.coalesce(numbered, F.lit(10**15)) * policy["TX_NUMERIC"]).otherwise(F.lit(0)).cast("long")


def lookup(value: Column, table: dict[str, int], default: int = 0) -> Column:
    """Constant map lookup with a default for absent keys."""
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(m, value), F.lit(default))


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in the given order. Planned with a group limit before the shuffle, so each task sends at most one
    row per key and a hot key does not gather."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def newest_first(*cols: str) -> list[Column]:
    return [F.desc_nulls_last(c) for c in cols]


def canonical(df: DataFrame, keys: list[str], version: str, recency: list[str], policy: dict[str, int] = POLICY, tie: tuple[str, ...] = ()) -> DataFrame:
    """Row of highest version priority per key, then most recent by ``recency``, then highest version text,
    then largest ``tie``.

    Rows are kept whole; ``prioridad_version`` is added. NULL recency sorts last; keys with NULL form groups of their own.
    """
    d = df.withColumn("prioridad_version", priority(version, policy))
    return latest(d, keys, [F.desc("prioridad_version"), *newest_first(*recency), F.desc_nulls_last(version), *newest_first(*tie)])


def new_rows(incoming: DataFrame, existing: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct incoming rows absent from ``existing``, NULLs equal to NULLs."""
    a = incoming.dropDuplicates(cols)
    b = existing.select(*[F.col(c).alias(f"_e_{c}") for c in cols])
    cond = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_e_{c}")) for c in cols])
    return a.join(b, cond, "left_anti")


def revision_range(df: DataFrame, keys: list[str], value: str, version: str) -> DataFrame:
    """Per key with several versions: how many, the value range and the sorted version labels."""
    g = df.groupBy(*keys).agg(F.countDistinct(version).alias("versiones"), F.min(value).alias("minimo"), F.max(value).alias("maximo"), F.concat_ws(",", F.array_sort(F.collect_set(version))).alias("lista"))
    return g.where("versiones > 1").withColumn("rango", F.col("maximo") - F.col("minimo"))


def new_rows_plain(incoming: DataFrame, existing: DataFrame, cols: list[str]) -> DataFrame:
    """As ``new_rows`` by plain equality: a row with a NULL among ``cols`` equals no row and is new each time."""
    return incoming.dropDuplicates(cols).join(existing.select(*cols), cols, "left_anti")


def append_counts(incoming: DataFrame, existing: DataFrame, cols: list[str]) -> DataFrame:
    """One row: rows received, distinct ones, and those absent from ``existing``, NULLs equal to NULLs; one aggregate over both sides."""
    flag = lambda df, x: df.select(*cols, F.lit(x).alias("_in"))
    g = flag(incoming, 1).unionByName(flag(existing, 0)).groupBy(*cols).agg(F.sum("_in").alias("n"), F.count("*").alias("all"))
    s = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return g.agg(s("n").alias("recibidas"), F.count_if(F.col("n") > 0).alias("unicas"), F.count_if((F.col("n") > 0) & (F.col("n") == F.col("all"))).alias("nuevas"))
