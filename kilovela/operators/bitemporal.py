"""Attributes as known at event time: a join on two time axes.

A version that is valid from ``s`` and was recorded at ``c`` is the current one of its entity exactly on the part of the
(valid time, recorded time) quadrant ``[s, oo) x [c, oo)`` that no version of later ``s`` covers. That staircase is cut
into disjoint rectangles; an event is the point (its date, its instant) and falls into one rectangle at most. Rectangles
are entered in every cell of a fixed grid that they touch, so the join is an equality on (entity, cell) with a short
residual test, and the rows of a hot entity are spread over the cells of the grid.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilovela.session import fits_broadcast, join_small, stage

FAR = 2**62
RECT = ["entity", "pick", "v0", "v1", "r0", "r1"]


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rectangles of versions that arrive sorted by (entity, s, c, pick).

    At any valid day the current version is a rising step function of recorded time, kept as a stack. A newcomer closes
    the steps recorded at or after it and shortens the one below; each of these ends a rectangle, so there are at most
    two rectangles per version and memory holds one entity's open steps.
    """
    entity, stack = None, []  # [pick, r0, r1, v0] from early to late recorded time
    for pdf in batches:
        out: list[tuple] = []
        for e, s, c, pick in zip(pdf["entity"], pdf["s"].tolist(), pdf["c"].tolist(), pdf["pick"].tolist(), strict=True):
            if e != entity:
                out += [(entity, p, v0, FAR, r0, r1) for p, r0, r1, v0 in stack]
                entity, stack = e, []
            while stack and stack[-1][1] >= c:
                p, r0, r1, v0 = stack.pop()
                out.append((e, p, v0, s, r0, r1))
            if stack:
                p, r0, r1, v0 = stack[-1]
                out.append((e, p, v0, s, r0, r1))
                stack[-1] = [p, r0, c, s]
            stack.append([pick, c, FAR, s])
        if out:
            yield pd.DataFrame(out, columns=RECT)
    if stack:
        yield pd.DataFrame([(entity, p, v0, FAR, r0, r1) for p, r0, r1, v0 in stack], columns=RECT)


def rectangles(versions: DataFrame) -> DataFrame:
    """Disjoint regions of the versions ``(entity, s, c, pick)``: ``s`` valid-from day number, ``c`` recorded micros.

    Versions of equal ``s`` count as one series in which the later recorded, then the larger ``pick``, wins; versions with
    a NULL entity or time have no region. Result: entity, pick, v0 <= valid day < v1, r0 <= recorded < r1.
    """
    a = versions.where(F.col("entity").isNotNull() & F.col("s").isNotNull() & F.col("c").isNotNull() & F.col("pick").isNotNull())
    a = a.select("entity", "s", "c", "pick").repartition("entity").sortWithinPartitions("entity", "s", "c", "pick")
    return a.mapInPandas(_sweep, "entity string, pick long, v0 long, v1 long, r0 long, r1 long").where((F.col("v0") < F.col("v1")) & (F.col("r0") < F.col("r1")))


def as_known(events: DataFrame, versions: DataFrame, cells: int = 12, max_rows: int = 200_000, salts: int = 8) -> DataFrame:
    """Adds to every event the ``pick`` of the version of its entity that was valid and already recorded, else NULL.

    ``events``: entity, vday (day number), vrec (micros), any other columns. ``versions``: entity, s, c, pick (long).
    Events without entity or time, or before the first recorded version, get NULL. Rows are neither lost nor doubled.
    The grid has ``cells`` steps on each axis between the first and last event. An index of more than ``max_rows`` rows, or of more
    bytes than may be broadcast, is shuffled, with events salted.
    """
    span = events.agg(F.min("vday").alias("a"), F.max("vday").alias("b"), F.min("vrec").alias("c"), F.max("vrec").alias("d")).first()
    a, b, c, d = (x if x is not None else 0 for x in span)
    vw, rw = max(1, (b - a) // cells + 1), max(1, (d - c) // cells + 1)
    rects = rectangles(versions).where((F.col("v0") <= b) & (F.col("v1") > a) & (F.col("r0") <= d) & (F.col("r1") > c))
    cell = lambda x, lo, w: F.floor((x - F.lit(lo)) / F.lit(w)).cast("int")
    clip = lambda x, lo, hi: F.least(F.greatest(x, F.lit(lo)), F.lit(hi))
    rects = rects.withColumn("gv", F.explode(F.sequence(cell(clip(F.col("v0"), a, b), a, vw), cell(clip(F.col("v1") - 1, a, b), a, vw))))
    lo_r = F.greatest(cell(clip(F.col("r0"), c, d), c, rw), F.lit(0))
    hi_r = cell(clip(F.col("r1") - 1, c, d), c, rw)
    rects = rects.withColumn("gr", F.explode(F.sequence(lo_r, hi_r)))
    # cells no event falls into are left out: the events' own cells, at most cells * cells pairs
    ev = events.withColumn("gv", cell(F.col("vday"), a, vw)).withColumn("gr", cell(F.col("vrec"), c, rw))
    used = ev.select("gv", "gr").distinct()
    index = stage(rects.join(F.broadcast(used), ["gv", "gr"], "left_semi"), "rects").withColumnRenamed("pick", "_pick")
    keyed = index.select(F.col("entity").alias("_e"), F.col("gv").alias("_gv"), F.col("gr").alias("_gr"), "v0", "v1", "r0", "r1", "_pick")
    cond = (F.col("entity") == F.col("_e")) & (F.col("gv") == F.col("_gv")) & (F.col("gr") == F.col("_gr"))
    cond &= (F.col("vday") >= F.col("v0")) & (F.col("vday") < F.col("v1")) & (F.col("vrec") >= F.col("r0")) & (F.col("vrec") < F.col("r1"))
    if fits_broadcast(index, max_rows):
        keyed = F.broadcast(keyed)
    else:  # both sides are shuffled by (entity, cell); a hot cell's events are spread by their own hash
        ev = ev.withColumn("_salt", F.pmod(F.xxhash64(*events.columns), F.lit(salts)).cast("int"))
        keyed = keyed.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        cond &= F.col("_salt") == F.col("_s")
    return ev.join(keyed, cond, "left").drop("_e", "_gv", "_gr", "v0", "v1", "r0", "r1", "gv", "gr", "_salt", "_s")


def agent_at_event(fact: DataFrame, dim: DataFrame, key: str = "agente_key", code: str = "codigo_agente", when: str = "fecha_hora", valid_from: str = "fecha_inicio", recorded: str = "fecha_creacion", id_col: str = "generacion_key", max_rows: int = 200_000) -> DataFrame:
    """(id, stored key, right key): each fact row with the dimension key that was valid and known at its time, 0 if none.

    A NULL or unknown stored key has no entity, hence 0; NULL times likewise. Codes are compared upper-case and trimmed.
    """
    norm = F.upper(F.trim(F.col(code)))
    d = stage(dim.select(F.col(key).cast("long").alias("pick"), norm.alias("entity"), F.unix_date(F.col(valid_from).cast("date")).cast("long").alias("s"), F.unix_micros(F.col(recorded).cast("timestamp")).alias("c")), "dim")
    f = fact.select(F.col(id_col), F.col(key).cast("long").alias("stored"), F.unix_date(F.col(when).cast("date")).cast("long").alias("vday"), F.unix_micros(F.col(when).cast("timestamp")).alias("vrec"))
    ids = d.where(F.col("pick").isNotNull()).groupBy(F.col("pick").alias("stored")).agg(F.min("entity").alias("entity"))
    ev = join_small(f, ids, ["stored"], "left", salt_of=id_col, max_rows=max_rows)
    out = as_known(ev, d, max_rows=max_rows)
    return out.select(id_col, F.col("stored").alias("guardado"), F.coalesce("_pick", F.lit(0)).cast("long").alias("correcto"))
