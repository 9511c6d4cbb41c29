"""Exact order statistics per group from a mergeable log-bucket sketch and one narrow second pass.

The sketch counts values per (group, bucket); a bucket is one of ``2**BITS`` equal steps of an octave, with the sign
kept, so sketches of partitions merge by adding counts. A rank is first located among the buckets of its group, a
table whose size follows the value range and not the rows; then only rows of the located buckets are read again.
No step sorts or gathers the rows of a group, so a group with a third of all rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 4


def bucket(v: Column) -> Column:
    """Order-preserving bucket number of a double: sign, octave and 1/16 of an octave; 0 for zero."""
    mag = F.floor(F.log2(F.abs(v)) * (1 << BITS)).cast("int") + F.lit(1100 << BITS)
    return F.when(v > 0, mag).when(v < 0, -mag).otherwise(F.lit(0)).cast("int")


def sketch(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, bucket, n, lo, hi) of the non-null values; NaN counts as null."""
    v = F.col(value)
    ok = df.where(v.isNotNull() & ~F.isnan(v))
    return ok.groupBy(*keys, bucket(v).alias("bucket")).agg(F.count("*").alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"))


def merge(sk: DataFrame, keys: list[str]) -> DataFrame:
    """Coarser sketch: the same buckets under fewer keys."""
    return sk.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _cumulated(sk: DataFrame, keys: list[str], order: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order)
    upto = F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(Window.partitionBy(*keys))
    return sk.withColumn("_upto", upto).withColumn("_total", total)


def approx_quantiles(sk: DataFrame, keys: list[str], qs: dict[str, float]) -> DataFrame:
    """Per group the middle of the bucket that holds each quantile: off by half a bucket (2.2 %) at most."""
    c = _cumulated(sk, keys, "bucket")
    aggs = [F.min(F.when(F.col("_upto") >= F.ceil(F.col("_total") * q), (F.col("lo") + F.col("hi")) / 2)).alias(n) for n, q in qs.items()]
    return c.groupBy(*keys).agg(*aggs, F.max("_total").alias("n"))


def with_median_bounds(sk: DataFrame, keys: list[str]) -> DataFrame:
    """The sketch's rows with the least and greatest value their group's median can have (med_lo, med_hi)."""
    c = _cumulated(sk, keys, "bucket")
    w = Window.partitionBy(*keys)
    at = lambda shift: F.floor((F.col("_total") + shift) / 2)
    has = lambda shift: (at(shift) > F.col("_upto") - F.col("n")) & (at(shift) <= F.col("_upto"))
    pick = lambda shift, x: F.max(F.when(has(shift), F.col(x))).over(w)
    return c.withColumns({f"med_{x}": (pick(1, x) + pick(2, x)) / 2 for x in ("lo", "hi")}).drop("_upto", "_total")


def median_bounds(sk: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, med_lo, med_hi): the same, one row per group."""
    return with_median_bounds(sk, keys).groupBy(*keys).agg(F.max("med_lo").alias("med_lo"), F.max("med_hi").alias("med_hi"))


def exact_medians(df: DataFrame, sk: DataFrame, keys: list[str], value: str, out: str = "mediana", broadcast: bool = False) -> DataFrame:
    """Per group the exact median (mean of the two middle values at an even count) of the values behind ``sk``.

    ``broadcast`` says that the caller has bounded the number of groups.
    """
    c = _cumulated(sk, keys, "bucket")
    a, b = F.floor((F.col("_total") + 1) / 2), F.floor((F.col("_total") + 2) / 2)
    before = F.col("_upto") - F.col("n")
    hit = c.where(((a > before) & (a <= F.col("_upto"))) | ((b > before) & (b <= F.col("_upto"))))
    hit = hit.select(*keys, "bucket", before.alias("_before"), a.alias("_a"), b.alias("_b"))
    side = F.broadcast(hit) if broadcast else hit
    v = F.col(value)
    near = df.where(v.isNotNull() & ~F.isnan(v)).select(*keys, value, bucket(v).alias("bucket")).join(side, [*keys, "bucket"])
    per_value = near.groupBy(*keys, "bucket", value).agg(F.count("*").alias("n"), F.max("_before").alias("_before"), F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    w = Window.partitionBy(*keys, "bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    r = per_value.withColumn("_upto", F.col("_before") + F.sum("n").over(w))
    has = lambda k: (F.col(k) > F.col("_upto") - F.col("n")) & (F.col(k) <= F.col("_upto"))
    return r.groupBy(*keys).agg(((F.max(F.when(has("_a"), v)) + F.max(F.when(has("_b"), v))) / 2).alias(out))
