"""History of changing attributes out of periodic snapshots, by Merkle comparison.

Every entity hashes to a leaf bucket, of which there are some times as many as entities (a power of 256). For each period a leaf's hash is
the xor of its entities' states and each higher node's the xor of its children's; consecutive periods are compared from the root
downwards and only differing branches are followed. A leaf equal to the one of the period before, in which no entity changed within
either, holds the same states again: its rows cannot start a version, so only the rows of differing leaves are diffed, entity by
entity, against the last state known.

Defined results: rows with NULL or blank entity or NULL date are no snapshot of anything and are left out; a NULL or blank
attribute keeps its earlier value (before the first value it is NULL, and the first value then starts a version);
an entity missing from a snapshot simply keeps its state; repeated rows count once, ties of the load time go to
the larger tie column; text is compared without case, accents and amount of white space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilovela.functions.normalize import code, plain_text
from kilovela.session import stage

FAN = 256


def latest(df: DataFrame, entity: str, when: str, attrs: list[str], loaded: str, tie: str) -> DataFrame:
    """(e, f, raw attributes, state attributes): per entity and date the row of latest load; hot entities combine on the
    map side by a max over (load time, tie)."""
    d = df.where(F.col(entity).isNotNull() & (F.trim(entity) != "") & F.col(when).isNotNull())
    order = F.struct(F.col(loaded).isNotNull(), F.col(loaded), F.col(tie))
    top = d.groupBy(code(entity).alias("e"), F.col(when).cast("date").alias("f")).agg(F.max(F.struct(order.alias("o"), F.struct(*attrs).alias("a"))).alias("x"))
    return top.select("e", "f", *[F.col(f"x.a.{a}").alias(a) for a in attrs], *[plain_text(F.col(f"x.a.{a}")).alias(f"_{a}") for a in attrs])


def leaves_for(rows: DataFrame) -> int:
    """Power of 256 that reaches four times the number of entities, so that most leaves hold one: a neighbour's change costs no row."""
    n = rows.agg(F.approx_count_distinct("e").alias("n")).first()["n"]  # one number
    leaves = FAN
    while leaves < 4 * n:
        leaves *= FAN
    return leaves


def _leaf(leaves: int) -> Column:
    return F.pmod(F.xxhash64("e"), F.lit(leaves)).cast("int")


def changed_leaves(rows: DataFrame, attrs: list[str], leaves: int, period: str = "month") -> DataFrame:
    """(p, leaf) pairs of the periods whose leaf differs from the one of the period before (or that have none before), or in which an
    entity has several states in either."""
    state = F.xxhash64("e", *[F.coalesce(F.col(f"_{a}"), F.lit("\0")) for a in attrs])
    per = rows.select(F.trunc("f", period).alias("p"), "e", state.alias("h")).groupBy("p", "e").agg(F.min("h").alias("h"), (F.min("h") == F.max("h")).alias("one"))
    # a leaf with an entity of several states equals no other: its hash takes in the period
    mixed = F.when(F.bool_and("one"), F.bit_xor("h")).otherwise(F.xxhash64(F.bit_xor("h"), F.col("p")))
    nodes = stage(per.withColumn("leaf", _leaf(leaves)).groupBy("p", "leaf").agg(mixed.alias("h"), F.count("*").alias("n"), F.bool_and("one").alias("one")), "leaves")
    before = nodes.select("p").distinct().withColumn("antes", F.lag("p").over(Window.orderBy("p")))  # one row per period
    open_, width = None, 1
    while width <= leaves:
        at = nodes.withColumn("node", F.floor(F.col("leaf") / (leaves // width)).cast("int"))
        up = [] if open_ is None else ["parent"]
        at = at.withColumn("parent", F.floor(F.col("node") / FAN).cast("int"))
        tree = at.groupBy("p", *up, "node").agg(F.bit_xor(F.xxhash64("leaf", "h", "n")).alias("h"), F.bool_and("one").alias("one"))
        now = tree.join(F.broadcast(before), "p")  # one row per period
        if open_ is not None:
            now = now.join(open_, ["p", "parent"], "left_semi")
        old = tree.select(F.col("p").alias("antes"), "node", F.col("h").alias("h0"), F.col("one").alias("one0"))
        diff = now.join(old, ["antes", "node"], "left").where(F.col("h0").isNull() | (F.col("h") != F.col("h0")) | ~F.col("one") | ~F.col("one0"))
        open_ = diff.select("p", F.col("node").alias("parent"))
        if width < leaves:
            open_ = stage(open_, "open")
        width *= FAN
    return open_.withColumnRenamed("parent", "leaf")


def versions(df: DataFrame, entity: str, when: str, attrs: list[str], loaded: str, tie: str, period: str = "month") -> DataFrame:
    """(entity, numero_version, attributes as first seen, fecha_inicio, fecha_fin, es_actual)."""
    rows = stage(latest(df, entity, when, attrs, loaded, tie), "snap")
    leaves = leaves_for(rows)
    near = rows.withColumns({"p": F.trunc("f", period), "leaf": _leaf(leaves)}).join(changed_leaves(rows, attrs, leaves, period), ["p", "leaf"], "left_semi")
    w = Window.partitionBy("e").orderBy("f")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    for a in attrs:
        known = F.last(F.when(F.col(f"_{a}").isNotNull(), F.struct(F.col(a).alias("r"), F.col(f"_{a}").alias("s"))), True).over(upto)
        near = near.withColumn(f"k_{a}", known)
    first = F.row_number().over(w) == 1
    moved = F.lit(False)
    for a in attrs:
        moved = moved | ~F.col(f"k_{a}.s").eqNullSafe(F.lag(F.col(f"k_{a}.s")).over(w))
    starts = near.withColumn("_start", first | moved).where("_start")
    nxt = F.lead("f").over(w)
    return starts.select(
        F.col("e").alias(entity), F.row_number().over(w).alias("numero_version"), *[F.col(f"k_{a}.r").alias(a) for a in attrs],
        F.col("f").alias("fecha_inicio"), F.coalesce(F.date_sub(nxt, 1), F.to_date(F.lit("9999-12-31"))).alias("fecha_fin"), nxt.isNull().alias("es_actual"),
    )
