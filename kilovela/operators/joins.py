"""Joins beyond plain equality, each kept hash-joinable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilovela.session import join_small

OPEN_FROM, OPEN_TO = "1900-01-01", "9999-12-31"


def existence_flag(df: DataFrame, ref: DataFrame, key: str, ref_key: str, flag: str) -> DataFrame:
    """Adds whether the key exists in ``ref``; rows are neither lost nor doubled."""
    known = ref.where(F.col(ref_key).isNotNull()).select(F.col(ref_key).alias(key)).distinct().withColumn(flag, F.lit(True))
    return join_small(df, known, [key]).withColumn(flag, F.coalesce(flag, F.lit(False)))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct non-null child keys without a parent, with their row counts: counted before the join."""
    keys = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("filas"))
    return keys.join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def temporal(fact: DataFrame, dim: DataFrame, on: tuple[str, str], at: str, start: str, end: str, take: list[str], salts: int = 1) -> DataFrame:
    """Left join to the version valid at ``at``, both ends inclusive; equal key in the hash, the range as residual. With ``salts`` the
    versions are repeated so often and the facts of a hot key spread by their times."""
    d = dim.select(F.col(on[1]).alias("_k"), F.col(start).alias("_a"), F.col(end).alias("_b"), *take)
    cond = (F.col(on[0]) == F.col("_k")) & (F.col(at) >= F.col("_a")) & (F.col(at) <= F.col("_b"))
    if salts > 1:
        d = d.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        cond &= F.pmod(F.xxhash64(at), F.lit(salts)) == F.col("_s")
    return fact.join(d, cond, "left").drop("_k", "_a", "_b", "_s")


def validity(left: DataFrame, right: DataFrame, key: str, at: str, start: str, end: str, salts: int = 1) -> DataFrame:
    """As ``temporal`` with open bounds where NULL; all right columns are kept, so several rows may match."""
    r = right.withColumn(start, F.coalesce(start, F.to_date(F.lit(OPEN_FROM)))).withColumn(end, F.coalesce(end, F.to_date(F.lit(OPEN_TO)))).withColumnRenamed(key, "_k")
    cond = (F.col(key) == F.col("_k")) & (F.col(at) >= F.col(start)) & (F.col(at) <= F.col(end))
    if salts > 1:
        r = r.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        cond &= F.pmod(F.xxhash64(at), F.lit(salts)) == F.col("_s")
    return left.join(r, cond, "left").drop("_k", "_s")


def overlapping(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Rows that begin before an earlier row of the key has ended, by a running maximum of the ends instead of a self-join:
    O(n log n) and no pairs. NULL ends are open."""
    e = F.coalesce(F.col(end), F.to_date(F.lit(OPEN_TO)))
    w = Window.partitionBy(key).orderBy(start, e)
    before = F.max(e).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("_before", before).where(F.col(start) <= F.col("_before")).drop("_before")


def either(left: DataFrame, right: DataFrame, first: tuple[str, str], second: tuple[str, str], take: str) -> DataFrame:
    """``left JOIN right ON first OR second`` as two equality joins, the first taking precedence. The keys of ``right`` are
    reduced to one row each (smallest ``take``), so no row is doubled; ``ambiguo`` says where they were not unique or the two
    ways disagree."""
    out = left
    for i, (a, b) in enumerate((first, second)):
        r = right.where(F.col(b).isNotNull()).groupBy(F.col(b).alias(a)).agg(F.min(take).alias(f"_t{i}"), (F.min(take) != F.max(take)).alias(f"_m{i}"))
        out = join_small(out, r, [a])
    many = F.coalesce("_m0", F.lit(False)) | F.coalesce("_m1", F.lit(False)) | F.coalesce(F.col("_t0") != F.col("_t1"), F.lit(False))
    return out.withColumn(take, F.coalesce("_t0", "_t1")).withColumn("ambiguo", many).drop("_t0", "_t1", "_m0", "_m1")


def with_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Adds the columns of a one-row aggregate to every row."""
    return df.crossJoin(F.broadcast(scalars))  # one row by construction


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], checks: list[tuple[str, str, str]], present: tuple[str, str], extra: list[str] | None = None) -> DataFrame:
    """Full outer join on the keys with a state: SOLO_DERECHA, SOLO_IZQUIERDA, the label of the first differing pair, OK."""
    j = left.join(right, keys, "full")
    state: Column = F.when(F.col(present[0]).isNull(), "SOLO_DERECHA").when(F.col(present[1]).isNull(), "SOLO_IZQUIERDA")
    for a, b, label in checks:
        state = state.when(~F.col(a).eqNullSafe(F.col(b)), label)
    return j.select(*keys, *(extra or []), state.otherwise("OK").alias("estado"))


def fill_calendar(df: DataFrame, day: str) -> DataFrame:
    """Every day from the first to the last of ``df``, with its columns or NULLs."""
    spine = df.agg(F.min(day).alias("_a"), F.max(day).alias("_b")).where("_a is not null").select(F.explode(F.sequence("_a", "_b")).alias(day))
    return spine.join(df, day, "left")


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, value: str, days: int = 32) -> DataFrame:
    """Extension: last known right value at or before each left row, by one union and a running last; no range join.

    Runs are kept within blocks of ``days`` days, so that a hot key is many tasks; what a block inherits is the last value of the
    blocks before, found over one row per key and block. A NULL value is no value; of equal times any non-NULL one counts (the
    largest); rows of ``left`` with a NULL key or time keep NULL. A numeric time counts seconds for the blocks."""
    numeric = dict(right.dtypes)[at] in ("int", "bigint", "double", "float")
    block = lambda c: F.floor(F.col(c) / (days * 86400)) if numeric else F.floor(F.unix_date(F.col(c).cast("date")) / days)
    known = right.where(F.col(key).isNotNull() & F.col(at).isNotNull() & F.col(value).isNotNull()).groupBy(key, at).agg(F.max(value).alias(value)).withColumn("_b", block(at))
    a = left.withColumns({"_b": block(at), "_o": F.lit(1), value: F.lit(None).cast(dict(right.dtypes)[value])})
    w = Window.partitionBy(key, "_b").orderBy(at, "_o").rowsBetween(Window.unboundedPreceding, 0)
    u = a.unionByName(known.withColumn("_o", F.lit(0)), allowMissingColumns=True)
    near = u.withColumn(value, F.last(value, True).over(w)).where("_o = 1").drop("_o")
    ends = known.groupBy(key, "_b").agg(F.max_by(value, at).alias("_v"))
    spans = ends.withColumn("_to", F.lead("_b").over(Window.partitionBy(key).orderBy("_b")))  # one row per key and block
    r = spans.select(F.col(key).alias("_k"), F.col("_b").alias("_from"), F.coalesce("_to", F.lit(2**31 - 1)).alias("_to"), "_v")
    before = (F.col(key) == F.col("_k")) & (F.col("_b") > F.col("_from")) & (F.col("_b") <= F.col("_to"))
    j = near.join(r, before, "left")
    live = F.col(key).isNotNull() & F.col(at).isNotNull()
    return j.withColumn(value, F.when(live, F.coalesce(F.col(value), F.col("_v")))).drop("_b", "_k", "_from", "_to", "_v")
