"""Column-level data quality profile, per load and across loads.

Numeric columns are described by mergeable exact power sums (count, sum and sum of squares in decimal arithmetic, so
neither partitioning nor order changes them) and by the standardised difference of each load's mean to the load
before and to all other loads. Grouped distincts, nulls, ranges and counts of pattern violations complete the profile.
A shift is reported where a load's standardised difference to the limits set by the other loads (a median lies within one
standard deviation of the mean) cannot rule it out and the exact median then confirms it.

Defined results: NULL and NaN both count as null except in ``fuera``, where NaN of a bounded column is outside; values
beyond ``decimal(18,s)`` stay out of the power sums and are counted in ``n_sin_suma``; a NULL load is a load of its own
in the profile and never a finding; an empty table has an empty profile; columns other than the named ones are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilovela.operators import quantiles
from kilovela.session import fits_broadcast, stage


@dataclass(frozen=True)
class ColumnSpec:
    """What to check of one column: a domain (``low``, ``high``) for numbers, a ``pattern`` for text; ``scale`` decimals
    are kept by the exact sums."""

    name: str
    kind: str = "text"
    low: float | None = None
    high: float | None = None
    pattern: str | None = None
    scale: int = 6


def specs_for(df: DataFrame, known: dict[str, ColumnSpec], skip: tuple[str, ...] = ()) -> list[ColumnSpec]:
    """A spec for each column of ``df``: the known one, else by type."""
    numeric = ("double", "float", "int", "bigint", "smallint", "tinyint")
    return [known.get(n) or ColumnSpec(n, "number" if t in numeric or t.startswith("decimal") else "text") for n, t in df.dtypes if n not in skip]


def _null(s: ColumnSpec, c: Column) -> Column:
    return c.isNull() | F.isnan(c.cast("double")) if s.kind == "number" else c.isNull()


def _broken(s: ColumnSpec, c: Column) -> Column:
    tests = []
    if s.low is not None:
        tests.append(c < s.low)
    if s.high is not None:
        tests.append((c > s.high) | F.isnan(c.cast("double")))
    elif s.low is not None:
        tests.append(F.isnan(c.cast("double")))
    if s.pattern is not None:
        tests.append(~c.cast("string").rlike(s.pattern))
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def _exact(s: ColumnSpec, c: Column) -> Column:
    x = F.when(~F.isnan(c.cast("double")), c.cast("double"))
    return x.try_cast(f"decimal(18,{s.scale})")


def moments(df: DataFrame, load: str, specs: list[ColumnSpec], table: str) -> DataFrame:
    """One row per (table, column, load): counts, nulls, range, violations and power sums, all from one aggregate."""
    aggs: list[Column] = [F.count("*").alias("filas")]
    for i, s in enumerate(specs):
        c, ok = F.col(s.name), ~_null(s, F.col(s.name))
        aggs += [F.count_if(ok).alias(f"v{i}"), F.count_if(c.isNotNull() & _broken(s, c)).alias(f"b{i}"), F.count_if(c.isNull()).alias(f"z{i}")]
        aggs += [F.min(F.when(ok, c)).cast("string").alias(f"lo{i}"), F.max(F.when(ok, c)).cast("string").alias(f"hi{i}")]
        if s.kind == "number":
            x = _exact(s, c)
            aggs += [F.count(x).alias(f"n{i}"), F.sum(x).alias(f"s{i}"), F.sum(x * x).alias(f"q{i}")]
    wide = df.groupBy(F.col(load).cast("string").alias("carga")).agg(*aggs)

    def part(i: int, s: ColumnSpec) -> Column:
        num = s.kind == "number"
        none = F.lit(None)
        return F.struct(
            F.lit(s.name).alias("columna"), F.col(f"v{i}").alias("validos"), (F.col("filas") - F.col(f"v{i}")).alias("nulos"), F.col(f"z{i}").alias("nulos_exactos"),
            F.col(f"b{i}").alias("fuera"), F.col(f"lo{i}").alias("minimo"), F.col(f"hi{i}").alias("maximo"),
            (F.col(f"n{i}") if num else none).cast("long").alias("n"), (F.col(f"s{i}") if num else none).cast("decimal(38,6)").alias("suma"), (F.col(f"q{i}") if num else none).cast("decimal(38,12)").alias("suma2"),
            ((F.col(f"v{i}") - F.col(f"n{i}")) if num else none).cast("long").alias("n_sin_suma"),
        )

    long = wide.select("carga", "filas", F.explode(F.array(*[part(i, s) for i, s in enumerate(specs)])).alias("p"))
    return long.select(F.lit(table).alias("tabla"), "p.columna", "carga", "filas", *[f"p.{x}" for x in ("validos", "nulos", "nulos_exactos", "fuera", "minimo", "maximo", "n", "suma", "suma2", "n_sin_suma")])


def shifts(mom: DataFrame) -> DataFrame:
    """Adds mean, standard deviation and the standardised differences to the load before (by name) and to all others.

    The others' sums are the total minus the load's own, which exact sums allow. Loads per column are few next to rows:
    the windows run over one row per load.
    """
    by = Window.partitionBy("tabla", "columna")
    d = lambda c: F.col(c).cast("double")
    mean = lambda s, n: F.when(n > 0, s / n)
    var = lambda q, s, n: F.when(n > 0, F.greatest(q / n - (s / n) * (s / n), F.lit(0.0)))
    m = mom.withColumn("media", mean(d("suma"), F.col("n"))).withColumn("varianza", var(d("suma2"), d("suma"), F.col("n")))
    rest = {k: (F.sum(k).over(by) - F.coalesce(F.col(k), F.lit(0))).cast("double") for k in ("n", "suma", "suma2")}
    m = m.withColumns({f"_r{k}": v for k, v in rest.items()}).withColumn("_rm", mean(F.col("_rsuma"), F.col("_rn"))).withColumn("_rv", var(F.col("_rsuma2"), F.col("_rsuma"), F.col("_rn")))
    seq = by.orderBy(F.col("carga").asc_nulls_first())
    m = m.withColumn("_pm", F.lag("media").over(seq)).withColumn("_pv", F.lag("varianza").over(seq))
    diff = lambda m2, v2: F.when(F.col("varianza") + v2 > 0, (F.col("media") - m2) / F.sqrt((F.col("varianza") + v2) / 2))
    return m.withColumn("dif_anterior", diff(F.col("_pm"), F.col("_pv"))).withColumn("dif_resto", diff(F.col("_rm"), F.col("_rv"))).withColumn("desviacion", F.sqrt("varianza")).drop("_rn", "_rsuma", "_rsuma2", "_rm", "_rv", "_pm", "_pv", "varianza")


def distincts(df: DataFrame, load: str, specs: list[ColumnSpec], table: str) -> DataFrame:
    """Exact distinct non-null values per (table, column, load) by grouped distincts: one partial aggregate of 128-bit
    value fingerprints, then counts. No Expand over columns and no per-group set."""
    item = lambda s: F.struct(F.lit(s.name).alias("columna"), F.xxhash64(F.col(s.name).cast("string")).alias("h1"), F.xxhash64(F.lit(7), F.col(s.name).cast("string")).alias("h2"), _null(s, F.col(s.name)).alias("nulo"))
    long = df.select(F.col(load).cast("string").alias("carga"), F.explode(F.array(*[item(s) for s in specs])).alias("p")).select("carga", "p.*").where(~F.col("nulo"))
    one = long.groupBy("carga", "columna", "h1", "h2").agg(F.lit(1).alias("_"))
    return one.groupBy("carga", "columna").agg(F.count("*").alias("distintos")).select(F.lit(table).alias("tabla"), "columna", "carga", "distintos")


def profile(df: DataFrame, table: str, load: str, specs: list[ColumnSpec]) -> DataFrame:
    """The whole profile of the named columns, one row per (table, column, load)."""
    m = shifts(moments(df, load, specs, table))
    d = distincts(df, load, specs, table)
    on = (F.col("m.columna") == F.col("d.columna")) & F.col("m.carga").eqNullSafe(F.col("d.carga"))
    p = m.alias("m").join(d.alias("d"), on, "left").select("m.*", F.coalesce("d.distintos", F.lit(0)).alias("distintos"))
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return p.withColumn("parte_nulos", share("nulos", "filas")).withColumn("parte_fuera", share("fuera", "validos"))


Watched = tuple[DataFrame, str, str, list[ColumnSpec]]
PAIR = ["tabla", "columna", "carga"]


def _long(df: DataFrame, table: str, load: str, specs: list[ColumnSpec]) -> DataFrame:
    """(tabla, columna, carga, v, x, fuera): the named numeric columns below one another; x is what the exact sums take."""
    item = lambda s: F.struct(F.lit(s.name).alias("columna"), F.col(s.name).cast("double").alias("v"), _exact(s, F.col(s.name)).try_cast("decimal(18,6)").alias("x"), F.coalesce(_broken(s, F.col(s.name)), F.lit(False)).alias("fuera"))
    return df.where(F.col(load).isNotNull()).select(F.lit(table).alias("tabla"), F.col(load).cast("string").alias("carga"), F.explode(F.array(*[item(s) for s in specs])).alias("p")).select("tabla", "p.columna", "carga", "p.v", "p.x", "p.fuera")


def findings(watched: list[Watched], min_rows: int = 20, null_share: float = 0.2, broken_share: float = 0.05, ratio: float = 3.0) -> DataFrame:
    """(tabla, columna, carga, hallazgo) of the loads of ``min_rows`` rows or more of all watched (frame, table, load column,
    numeric specs), which share both passes.

    ``nulos``: more than ``null_share`` of the rows null. ``rango``: more than ``broken_share`` of the non-null values
    outside the domain. ``distribucion``: the load's median is over ``ratio`` times, or under 1/``ratio`` of, the median
    of all such loads' medians.

    The first pass counts and adds up powers per (load, value bucket); rolled up they are the loads' power sums, and the buckets bound
    each load's median and the median of the medians. A load's distance from a limit in its own standard deviations then tells
    whether its median can lie beyond it (a median lies within one deviation of the mean), and only such loads, with those that can
    hold the median of the medians, are read again for their exact medians.
    """
    long = reduce(DataFrame.unionByName, [_long(*w) for w in watched])
    v = F.col("v")
    slot = F.when(v.isNotNull() & ~F.isnan("v"), quantiles.bucket(v))
    sums = [F.count("*").alias("filas"), F.count("v").alias("llenas"), F.count_if("fuera").alias("fuera"), F.count("x").alias("n_x"), F.sum("x").cast("decimal(38,6)").alias("suma"), F.sum(F.col("x") * F.col("x")).cast("decimal(38,12)").alias("suma2")]
    sk = stage(long.groupBy(*PAIR, slot.alias("bucket")).agg(*sums, F.min("v").alias("lo"), F.max("v").alias("hi")), "sk")
    total = [F.sum(c).alias(c) for c in ("filas", "llenas", "fuera", "n_x", "suma", "suma2")]
    mom = sk.groupBy(*PAIR).agg(*total, F.sum(F.when(F.col("bucket").isNotNull(), F.col("filas"))).alias("validos")).where(F.col("filas") >= min_rows)
    named = lambda df, h: df.select(*PAIR, F.lit(h).alias("hallazgo"))
    nulls = named(mom.where(F.col("filas") - F.col("llenas") > F.col("filas") * null_share), "nulos")
    broken = named(mom.where(F.col("fuera") > F.col("llenas") * broken_share), "rango")

    sk = sk.where("bucket is not null").withColumnRenamed("filas", "n")
    bounds = quantiles.median_bounds(sk, PAIR).join(mom.where("validos > 0").select(*PAIR, "n_x", "validos", "suma", "suma2"), PAIR)
    by = Window.partitionBy("tabla", "columna")  # one row per load
    for c in ("lo", "hi"):
        w = by.orderBy(f"med_{c}")
        bounds = bounds.withColumns({f"_r{c}": F.row_number().over(w), "_k": F.count("*").over(by)})
        middle = lambda shift, c=c: F.max(F.when(F.col(f"_r{c}") == F.floor((F.col("_k") + shift) / 2), F.col(f"med_{c}"))).over(by)
        bounds = bounds.withColumns({f"_a{c}": middle(1), f"_b{c}": middle(2)})
    low, high = (F.col("_alo") + F.col("_blo")) / 2, (F.col("_ahi") + F.col("_bhi")) / 2
    mean = F.col("suma").cast("double") / F.col("n_x")
    spread = F.sqrt(F.greatest(F.col("suma2").cast("double") / F.col("n_x") - mean * mean, F.lit(0.0))) * (1 + 1e-9) + F.abs(mean) * 1e-6 + 1e-6
    z_up, z_down = (low * ratio - mean) / spread, (mean - high / ratio) / spread
    shifted = (F.col("n_x") < F.col("validos")) | (z_up < 1) | (z_down < 1)
    inside = lambda x: (F.col("med_lo") <= F.col(f"_{x}hi")) & (F.col("med_hi") >= F.col(f"_{x}lo"))
    judged = stage(bounds.select(*PAIR, "med_lo", shifted.alias("movida"), (inside("a") | inside("b")).alias("central")), "judged")
    again = judged.where("movida or central").select(*PAIR)
    few = fits_broadcast(again, 100_000)
    part = long.join(F.broadcast(again) if few else again, PAIR)
    exact = quantiles.exact_medians(part, sk.join(F.broadcast(again) if few else again, PAIR), PAIR, "v", broadcast=few)
    # a load that cannot hold the median of the medians counts by its bound, which lies on the same side of it
    med = judged.join(exact, PAIR, "left").withColumn("valor", F.coalesce("mediana", "med_lo"))
    f = med.withColumn("_m", F.percentile("valor", F.lit(0.5)).over(by)).where("movida")  # one row per load
    moved = named(f.where((F.col("mediana") > F.col("_m") * ratio) | (F.col("mediana") < F.col("_m") / ratio)), "distribucion")
    return nulls.unionByName(broken).unionByName(moved)
