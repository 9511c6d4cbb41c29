"""Implausible readings: negative values, values far from what the source usually reads, jumps and stuck values.

Per-source quantile sketches are counts per (source, hour of day, log bucket), merged across partitions; the hour sketches
give expanded interquartile fences in context, and merged over the hours they bound the source's median, which settles all
readings but those of sources that have some in the narrow bands left open. Stuck values are runs of successive periods,
found in time blocks of a source and stitched across block borders, so that no task ever holds all periods of a source.

Defined results: rows with NULL or NaN value, source or time are never flagged (a NULL source's negative value is); rows
are judged one by one, so repeated rows are all flagged; a source without positive values has no median and no fence.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilovela.functions.normalize import code
from kilovela.operators import quantiles
from kilovela.session import fits_broadcast, join_small, stage

BLOCK_S = 32 * 86400


@dataclass(frozen=True)
class Measure:
    """A table of readings: where its id, source, time and value are, and whether low values are implausible too."""

    table: str
    id_col: str
    source: str
    when: str
    value: str
    low_too: bool = False


KEY = ["tabla", "src"]


def readings(df: DataFrame, m: Measure) -> DataFrame:
    """(tabla, id, src, t, v, low): usable readings; t in epoch micros."""
    v = F.col(m.value).cast("double")
    t = F.unix_micros(F.col(m.when).cast("timestamp"))
    r = df.select(F.lit(m.table).alias("tabla"), F.col(m.id_col).cast("long").alias("id"), code(m.source).alias("src"), t.alias("t"), v.alias("v"), F.lit(m.low_too).alias("low"))
    return r.where(F.col("v").isNotNull() & ~F.isnan("v"))


def _block(t):
    return F.floor(t / F.lit(BLOCK_S * 1_000_000)).cast("int")


def stuck_runs(r: DataFrame, least: int = 6) -> DataFrame:
    """(tabla, src, block, a, b): per time block the first and last period of every stretch that belongs to a run of ``least``
    or more successive periods in which all values of the source are one same non-zero number."""
    per = r.where(F.col("src").isNotNull() & F.col("t").isNotNull()).groupBy(*KEY, _block(F.col("t")).alias("block"), "t").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    per = per.withColumn("c", F.when((F.col("lo") == F.col("hi")) & (F.col("lo") != 0), F.col("lo")))
    w = Window.partitionBy(*KEY, "block").orderBy("t")
    same = F.col("c").isNotNull() & (F.col("c") == F.lag("c").over(w))
    marked = per.withColumn("_new", F.when(same, 0).otherwise(1)).withColumn("isle", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    isles = marked.groupBy(*KEY, "block", "isle").agg(F.min("t").alias("a"), F.max("t").alias("b"), F.count("*").alias("n"), F.max("c").alias("c"))
    # islands that can matter: long ones, and the first and last of a block, which may go on in the next
    ends = isles.withColumn("_last", F.max("isle").over(Window.partitionBy(*KEY, "block")))
    ends = ends.where((F.col("n") >= least) | (F.col("isle") == 1) | (F.col("isle") == F.col("_last")))
    s = Window.partitionBy(*KEY).orderBy("a")
    touches = (F.col("isle") == 1) & (F.lag("isle").over(s) == F.lag("_last").over(s)) & (F.lag("block").over(s) < F.col("block"))
    goes_on = touches & F.col("c").isNotNull() & (F.col("c") == F.lag("c").over(s))
    chain = ends.withColumn("_new", F.when(goes_on, 0).otherwise(1)).withColumn("run", F.sum("_new").over(s.rowsBetween(Window.unboundedPreceding, 0)))
    total = chain.withColumn("_n", F.sum("n").over(Window.partitionBy(*KEY, "run")))
    return total.where((F.col("_n") >= least) & F.col("c").isNotNull()).select(*KEY, "block", "a", "b")


def _sketch(r: DataFrame) -> DataFrame:
    """Counts per (source, hour of day, bucket) of the positive values, staged."""
    pos = r.where((F.col("v") > 0) & F.col("src").isNotNull()).withColumn("hora", F.hour(F.timestamp_micros(F.col("t"))))
    return stage(quantiles.sketch(pos, [*KEY, "hora"], "v"), "sketch")


def levels(r: DataFrame, high: float, low: float) -> DataFrame:
    """(tabla, src, mediana): per source a level that judges every reading as the exact median of its positive values would.

    The sketch bounds the median. Where no bucket of the source reaches into the bands that the limits leave open (``high`` times the
    bounds, a ``low``-th of them) any value within the bounds judges alike; only sources with readings there are read again
    for their exact medians."""
    sk = _sketch(r)
    lo, hi, m0, m1 = F.col("lo"), F.col("hi"), F.col("med_lo"), F.col("med_hi")
    near = ((hi > m0 * high) & (lo <= m1 * high)) | ((hi >= m0 / low) & (lo < m1 / low))
    x = quantiles.with_median_bounds(quantiles.merge(sk, KEY), KEY)
    known = stage(x.groupBy(*KEY).agg(F.max("med_hi").alias("mediana"), F.bool_or(near & (m0 < m1)).alias("unsure")), "levels")
    unsure = known.where("unsure").select(*KEY)
    n = unsure.limit(100_001).count()
    if not n:
        return known.select(*KEY, "mediana")
    mark = F.broadcast(unsure) if n <= 100_000 else unsure
    pos = r.where((F.col("v") > 0) & F.col("src").isNotNull()).join(mark, KEY, "left_semi")
    exact = quantiles.exact_medians(pos, quantiles.merge(sk.join(mark, KEY, "left_semi"), KEY), KEY, "v", "_exact", broadcast=n <= 100_000)
    return stage(known.join(exact, KEY, "left").select(*KEY, F.coalesce("_exact", "mediana").alias("mediana")), "med")


def fences(r: DataFrame, stretch: float = 3.0) -> DataFrame:
    """Expanded interquartile fences per source and hour of day."""
    q = quantiles.approx_quantiles(_sketch(r), [*KEY, "hora"], {"q1": 0.25, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    return q.select(*KEY, "hora", (F.col("q1") - stretch * iqr).alias("valla_baja"), (F.col("q3") + stretch * iqr).alias("valla_alta"))


def implausible(tables: list[tuple[DataFrame, Measure]], high: float = 3.0, low: float = 5.0, least: int = 6) -> DataFrame:
    """(tabla, registro_id, negativo, lejano, atascado) of the flagged rows of all tables, which share every pass.

    ``negativo``: below zero. ``lejano``: over ``high`` times the median of the source's positive values or, where the
    measure says ``low_too``, under a ``low``-th of it. ``atascado``: in a run of ``least`` or more periods of one same value.
    """
    r = reduce(DataFrame.unionByName, [readings(df, m) for df, m in tables])
    runs = stage(stuck_runs(r, least), "runs")
    x = join_small(r.withColumn("block", _block(F.col("t"))), levels(r, high, low), KEY, "left", salt_of="id")
    inside = (x.tabla == runs.tabla) & (x.src == runs.src) & (x.block == runs.block) & (x.t >= runs.a) & (x.t <= runs.b)
    side = F.broadcast(runs) if fits_broadcast(runs, 200_000) else runs
    x = x.join(side, inside, "left").select(x.tabla, x.id, x.v, x.low, x.mediana, F.col("a").isNotNull().alias("atascado"))
    far = (F.col("v") > F.col("mediana") * high) | (F.col("low") & (F.col("v") < F.col("mediana") / low))
    flags = x.select("tabla", F.col("id").alias("registro_id"), (F.col("v") < 0).alias("negativo"), F.coalesce(far, F.lit(False)).alias("lejano"), "atascado")
    return flags.where("negativo or lejano or atascado")


def contextual(tables: list[tuple[DataFrame, Measure]], jump: float = 1.0) -> DataFrame:
    """Softer marks by context: outside the fences of the source's hour of day (``fuera_de_valla``), or a change from the
    period before by more than ``jump`` times the fence width (``salto``). A period's state is its reading of the highest id;
    every reading of the next period is compared with it, also across block borders. One row per marked reading."""
    r = reduce(DataFrame.unionByName, [readings(df, m) for df, m in tables]).where(F.col("src").isNotNull() & F.col("t").isNotNull())
    x = r.withColumn("block", _block(F.col("t"))).withColumn("hora", F.hour(F.timestamp_micros(F.col("t"))))
    state = F.max(F.struct("t", "id", "v"))
    ends = x.groupBy(*KEY, "block").agg(state.alias("_fin"))
    carried = ends.select(*KEY, "block", F.lag("_fin.v").over(Window.partitionBy(*KEY).orderBy("block")).alias("_previo"))
    earlier = Window.partitionBy(*KEY, "block").orderBy("t").rangeBetween(Window.unboundedPreceding, -1)
    x = join_small(x.withColumn("_antes", state.over(earlier)["v"]), stage(carried, "carried"), [*KEY, "block"], "left", salt_of="id")
    x = x.withColumn("_antes", F.coalesce("_antes", "_previo"))
    x = join_small(x, stage(fences(r), "fences"), [*KEY, "hora"], "left", salt_of="id")
    x = x.withColumn("fuera_de_valla", (F.col("v") > F.col("valla_alta")) | (F.col("v") < F.col("valla_baja")))
    x = x.withColumn("salto", F.abs(F.col("v") - F.col("_antes")) > jump * (F.col("valla_alta") - F.col("valla_baja")))
    return x.where("fuera_de_valla or salto").select("tabla", F.col("id").alias("registro_id"), F.coalesce("fuera_de_valla", F.lit(False)).alias("fuera_de_valla"), F.coalesce("salto", F.lit(False)).alias("salto"))
