"""Best representative of each duplicate group by iterative truth discovery.

A source is a published version; in a group it claims, per field, the last value it gave that is not NULL. Votes of a value are
the summed weights of the sources that claim it, and the value of most votes survives. A source's weight follows from how often
its claims lose, and what wins follows from the weights: the two are estimated in turn until the weights stand still.

A field may have a declared order of trust, as where the problem names the version that always counts first. Its weights are
estimated in the same rounds, under that order as a constraint: before each vote they are raised until a source is as reliable as
any below it and outweighs all of them together (``ranked``). Its survivors are those of these votes, too.

Scale: one aggregate with a map-side combine turns rows into one row per (group, source) that carries the claims of all fields;
no list of a group's rows is ever built. These rows are staged in buckets of the group, so that all further grouping by group
and value is without a shuffle; a group has as many rows as sources, so no bucket is hot. What a vote decides depends only on which sources agree; groups with the same sources
in the same agreement are one *pattern*, and the iterations run over patterns with their counts, read from one representative
group each. That is exact and makes the iterations independent of the number of rows. Sources are any number.

Defined results: NULL and NaN values claim nothing but keep their row in the group; groups are compared by two 64-bit hashes of
the normalised key with NULL as a value of its own; a group without any claim survives with a NULL value (nothing is voted on; under
an order its record is still the most trusted row); equal votes go to the value of the most trusted supporter; repeated rows vote once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilovela.functions.normalize import code, version_rank
from kilovela.session import join_small, stage, stage_by

GROUP = ["k1", "k2"]
DIGITS = 9  # votes are compared to so many decimals, so that the order of their sum decides nothing
BAND = 500  # sources of an ordered field whose votes one double holds


def _rows(df: DataFrame, keys: list[str], fields: list[str], version: str, loaded: str, id_col: str) -> DataFrame:
    """(k1, k2, source, t, id, values v0, v1, ...) with NaN as NULL."""
    parts = [F.coalesce(code(F.col(k).cast("string")), F.lit("\0")) for k in keys]
    kinds = dict(df.dtypes)
    value = lambda f: F.when(~F.isnan(f), F.col(f)) if kinds[f] in ("double", "float") else F.col(f)
    source = F.coalesce(version_rank(version), F.lit(-1).cast("long"))
    t = F.coalesce(F.unix_micros(F.col(loaded).cast("timestamp")), F.lit(-(2**62)))
    return df.select(F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit(11), *parts).alias("k2"), source.alias("source"), t.alias("t"), F.col(id_col).alias("id"), *[value(f).alias(f"v{i}") for i, f in enumerate(fields)])


def by_order(df: DataFrame, keys: list[str], field: str, version: str, loaded: str, id_col: str) -> DataFrame:
    """(grupo_id, filas, registro_id, field): the survivor of the votes under the declared order of trust, and the group's smallest id and
    size."""
    g = survivors(df, keys, {field: True}, version, loaded, id_col)
    return g.select("grupo_id", "filas", F.col(f"registro_{field}").alias("registro_id"), field)


def claims(df: DataFrame, keys: list[str], fields: list[str], version: str, loaded: str, id_col: str) -> DataFrame:
    """One row per (group, source): n rows, first_id, and per field c0, c1, ... the source's claim (id, v)."""
    r = _rows(df, keys, fields, version, loaded, id_col)
    claim = lambda i: F.max(F.struct(F.col(f"v{i}").isNotNull().alias("ok"), "t", "id", F.col(f"v{i}").alias("v"))).alias(f"c{i}")
    g = r.groupBy(*GROUP, "source").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), *[claim(i) for i in range(len(fields))])
    return g.select(*GROUP, "source", F.col("n").cast("int").alias("n"), "first_id", *[F.struct(f"c{i}.id", f"c{i}.v").alias(f"c{i}") for i in range(len(fields))])


def said(cl: DataFrame, fields: list[int]) -> DataFrame:
    """(k1, k2, f, source, v as text, id) of the claims of the numbered fields."""
    one = lambda i: F.struct(F.lit(i).alias("f"), F.col(f"c{i}.v").cast("string").alias("v"), F.col(f"c{i}.id").alias("id"))
    return cl.select(*GROUP, "source", F.explode(F.array(*[one(i) for i in fields])).alias("x")).select(*GROUP, "x.f", "source", "x.v", "x.id").where("v is not null")


def patterns(s: DataFrame) -> DataFrame:
    """(f, pattern, value, source, groups): which sources agree in one representative group of each pattern, and how many groups have
    that pattern."""
    big = F.lit(1 << 40)
    part = lambda seed, *c: F.sum(F.pmod(F.xxhash64(F.lit(seed), *c), big))
    sets = s.groupBy(*GROUP, "f", "v").agg(part(1, "source").alias("a"), part(2, "source").alias("b"), F.count("*").alias("m"))
    per = sets.groupBy(*GROUP, "f").agg(F.count("*").alias("d"), part(3, "a", "b", "m").alias("p"), part(4, "a", "b", "m").alias("q"))
    reps = per.groupBy("f", "d", "p", "q").agg(F.count("*").alias("groups"), F.min(F.struct(*GROUP)).alias("rep"))
    reps = stage(reps.select("f", F.concat_ws(".", "d", "p", "q").alias("pattern"), "groups", "rep.k1", "rep.k2"), "reps")
    return join_small(s, reps, [*GROUP, "f"], "inner").select("f", "pattern", F.col("v").alias("value"), "source", "groups")


def ranked(w: DataFrame, ordered: Sequence[int] = ()) -> DataFrame:
    """(f, source, w, band): the weights to vote with. In the fields of ``ordered`` the k-th source from below weighs 3 ** (k - 1) times the
    highest estimate of it and those below, which is more than twice theirs together; it is 3 ** ((k - 1) % BAND) times that
    in a band of its own, higher bands counting first, so any number of sources has room."""
    if not ordered:
        return w.withColumn("band", F.lit(0))
    from_below = Window.partitionBy("f").orderBy("source")  # one row per source
    held, k = F.col("f").isin(list(ordered)), F.row_number().over(from_below) - 1
    raised = F.max("w").over(from_below) * F.pow(F.lit(3.0), k % BAND)
    return w.select("f", "source", F.when(held, raised).otherwise(F.col("w")).alias("w"), F.when(held, F.floor(k / BAND)).otherwise(0).cast("int").alias("band"))


def discover(s: DataFrame, rounds: int = 20, ordered: Sequence[int] = ()) -> DataFrame:
    """(f, source, w): the weight of each source in each field, -ln of its smoothed share of lost claims over all groups in which it
    claims, unanimous ones too; who wins in the fields of ``ordered`` is voted with ``ranked`` weights. Each round is three small
    aggregates over the patterns; one number comes to the driver."""
    pat = stage(patterns(s), "patterns")
    w = pat.select("f", "source").distinct().withColumn("w", F.lit(1.0))
    for _ in range(rounds):
        won = votes(pat, ranked(w, ordered), ["f", "pattern"], "value").select("f", "pattern", F.col("value").alias("won"))
        lost = F.sum(F.when(F.col("value") != F.col("won"), F.col("groups")).otherwise(0))
        new = pat.join(won, ["f", "pattern"]).groupBy("f", "source").agg((-F.log((lost + 1) / (F.sum("groups") + 2))).alias("new"))
        both = stage(new.join(w, ["f", "source"]), "weights")
        moved = both.agg(F.max(F.abs(F.col("new") - F.col("w")))).first()[0]
        w = both.select("f", "source", F.col("new").alias("w"))
        if not moved or moved < 1e-12:
            break
    return w


def votes(s: DataFrame, weights: DataFrame, by: list[str], value: str, *keep: Column) -> DataFrame:
    """Per ``by`` the value of most votes, its votes ``s`` and the sum of all votes ``total`` (both of the lowest band, the only one of a
    field without an order)."""
    bands = range((weights.agg(F.max("band")).first()[0] or 0) + 1)
    weighed = join_small(s, weights, ["f", "source"], "inner")
    sums = [F.round(F.sum(F.when(F.col("band") == b, F.col("w")).otherwise(0.0)), DIGITS).alias(f"s{b}") for b in bands]
    each = weighed.groupBy(*by, value).agg(*sums, F.max(F.struct("source", *keep)).alias("top"))
    best = each.groupBy(*by).agg(F.max(F.struct(*[f"s{b}" for b in reversed(bands)], "top", value)).alias("b"), F.sum("s0").alias("total"))
    return best.select(*by, F.col("b.s0").alias("s"), "total", "b.top", f"b.{value}")


def survivors(df: DataFrame, keys: list[str], fields: dict[str, bool], version: str, loaded: str, id_col: str) -> DataFrame:
    """Fused record per group: grupo_id (smallest id), filas, and for each field of ``fields`` (name -> has a declared order) the
    surviving value and the row ``registro_<field>`` that supplies it; where votes decide, also its share of them, ``apoyo_<field>``."""
    names, kinds = list(fields), dict(df.dtypes)
    ordered = [i for i, f in enumerate(names) if fields[f]]
    cl = stage_by(claims(df, keys, names, version, loaded, id_col), GROUP, "claims")
    s = said(cl, list(range(len(names))))
    w = stage(ranked(discover(s, ordered=ordered), ordered), "w")
    won = votes(s, w, [*GROUP, "f"], "v", F.col("id"))
    field = lambda i, c: F.max(F.when(F.col("f") == i, F.col(c)))
    voted = won.groupBy(*GROUP).agg(*[field(i, c).alias(f"{n}{i}") for i in range(len(names)) for n, c in (("v", "v"), ("id", "top.id"), ("s", "s"), ("total", "total"))])
    row = lambda i: F.max(F.struct("source", f"c{i}.id")).alias(f"o{i}")
    groups = cl.groupBy(*GROUP).agg(F.min("first_id").alias("grupo_id"), F.sum("n").alias("filas"), *[row(i) for i in ordered])
    out, j = [], groups.join(voted, GROUP, "left")
    for i, f in enumerate(names):
        out.append(F.col(f"v{i}").cast(kinds[f]).alias(f))
        if i in ordered:
            out.append(F.coalesce(f"id{i}", f"o{i}.id").alias(f"registro_{f}"))
        else:
            share = F.when(F.col(f"total{i}") > 0, F.round(F.col(f"s{i}") / F.col(f"total{i}"), 6))
            out += [F.col(f"id{i}").alias(f"registro_{f}"), share.alias(f"apoyo_{f}")]
    return j.select("grupo_id", "filas", *out)


def lost_shares(df: DataFrame, keys: list[str], fields: list[str], version: str, loaded: str, id_col: str) -> DataFrame:
    """(campo, fuente as version rank, peso): the estimated weights themselves."""
    w = discover(said(stage_by(claims(df, keys, fields, version, loaded, id_col), GROUP, "claims"), list(range(len(fields)))))
    name = reduce(lambda acc, x: F.when(F.col("f") == x[0], x[1]).otherwise(acc), enumerate(fields), F.lit(None).cast("string"))
    return w.select(name.alias("campo"), F.col("source").alias("fuente"), F.round("w", 6).alias("peso"))
