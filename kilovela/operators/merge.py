"""Keyed mutation of snapshots: upsert, delete or retire what is missing, with metrics, on plain Parquet.

Target and source meet in one full outer join on the key; an ``_action`` column says what happens to each row, and the new
snapshot and the metrics both come from it. Keys compare NULL-safe. A source must be unique by key (``canonical`` makes it
so). ``Table`` stages each snapshot in a directory of its own, appends a line to a commit log and only then
switches to it, so a reader never sees half a write.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACTIONS = ("insert", "update", "delete", "retire", "keep")


def plan(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], missing: str = "keep", active: str | None = None, only_update: bool = False) -> DataFrame:
    """Joined rows with t_*/s_* columns and ``_action``. ``missing``: what happens to target rows absent from the source
    (keep, delete, or retire where ``active`` is still true)."""
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(True).alias("_t"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns], F.lit(True).alias("_s"))
    cond = reduce(lambda a, b: a & b, [F.col(f"t_{k}").eqNullSafe(F.col(f"s_{k}")) for k in keys])
    changed = reduce(lambda a, b: a | b, [~F.col(f"t_{c}").eqNullSafe(F.col(f"s_{c}")) for c in columns], F.lit(False))
    both, absent = F.col("_t") & F.col("_s"), F.col("_s").isNull()
    act = F.when(both & changed, "update").when(both, "keep")
    if missing == "delete":
        act = act.when(absent, "delete")
    elif missing == "retire":
        act = act.when(absent & F.coalesce(F.col(f"t_{active}"), F.lit(False)), "retire")
    act = act.when(absent, "keep").otherwise("skip" if only_update else "insert")
    return t.join(s, cond, "full").withColumn("_action", act).where("_action <> 'skip'")


def apply(p: DataFrame, target: DataFrame, columns: list[str], now: Column, created: str | None = None, updated: str | None = None, active: str | None = None, retired: str | None = None, rules: dict[str, Column] | None = None) -> DataFrame:
    """New snapshot of a plan. ``created`` survives updates; ``rules`` override a column by an expression over t_* and s_*."""
    names = set(p.columns)
    src = lambda c: F.col(f"s_{c}") if f"s_{c}" in names else F.col(f"t_{c}")
    a = F.col("_action")
    out = []
    for c, kind in target.dtypes:
        t = F.col(f"t_{c}")
        if c == created:
            e = F.when(a == "insert", now).otherwise(t)
        elif c == updated:
            e = F.when(a.isin("insert", "update", "retire"), now).otherwise(t)
        elif c == active:
            e = F.when(a == "retire", F.lit(False)).when(a.isin("insert", "update"), F.coalesce(src(c), F.lit(True))).otherwise(t)
        elif c == retired:
            e = F.when(a == "retire", now).when(a.isin("insert", "update"), F.lit(None)).otherwise(t)
        elif rules and c in rules:
            e = F.when(a == "update", rules[c]).when(a == "insert", src(c)).otherwise(t)
        elif c in columns:
            e = F.when(a.isin("insert", "update"), src(c)).otherwise(t)
        else:
            e = F.when(a == "insert", src(c)).otherwise(t)
        out.append(e.cast(kind).alias(c))
    return p.where(a != "delete").select(*out)


def metrics(p: DataFrame) -> DataFrame:
    """Rows per action."""
    return p.groupBy("_action").agg(F.count("*").alias("filas"))


def surrogate_keys(new: DataFrame, existing: DataFrame, natural: list[str], key: str) -> DataFrame:
    """Existing keys are kept; new natural keys get the next numbers in their own order.

    Numbers are dense without a single-task sort: rows are range-partitioned, counted per partition, and numbered within it
    from the partition's offset (one small row per partition).
    """
    cond = reduce(lambda a, b: a & b, [F.col(f"n.{c}").eqNullSafe(F.col(f"e.{c}")) for c in natural])
    fresh = new.select(*natural).distinct().alias("n").join(existing.select(*natural).alias("e"), cond, "left_anti")
    parted = fresh.repartitionByRange(*natural).withColumn("_p", F.spark_partition_id())
    from kilovela.session import stage

    parted = stage(parted, "newkeys")
    sizes = parted.groupBy("_p").agg(F.count("*").alias("_n"))
    offs = sizes.select("_p", (F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("_o"))  # one row per partition
    top = existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("_m"))
    num = parted.join(F.broadcast(offs), "_p").crossJoin(F.broadcast(top))
    w = Window.partitionBy("_p").orderBy(*natural)
    fresh_keys = num.select(*natural, (F.col("_m") + F.col("_o") + F.row_number().over(w)).cast("long").alias(key))
    return existing.select(*natural, F.col(key).cast("long").alias(key)).unionByName(fresh_keys)


def insert_absent(target: DataFrame, seed: DataFrame, keys: list[str]) -> DataFrame:
    """Seed rows are added where their key is absent; nothing else changes."""
    cond = reduce(lambda a, b: a & b, [F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys])
    return target.unionByName(seed.alias("s").join(target.alias("t"), cond, "left_anti"), allowMissingColumns=True)


class Table:
    """A keyed snapshot table on Parquet with an atomic switch and a history (version, time, operation, metrics).

    With ``keys`` the rows lie in ``buckets`` parts by a hash of the keys; a merge by these keys then reads and writes the touched parts
    only, and the commit names for each part the folder that holds it. Without, a version is one folder.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str] | None = None, buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets
        jvm = spark.sparkContext._jvm
        self._p = lambda x: jvm.org.apache.hadoop.fs.Path(x)
        self.fs = self._p(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def history(self) -> list[dict]:
        log = self._p(f"{self.path}/_commits")
        if not self.fs.exists(log):
            return []
        rows = self.spark.read.text(f"{self.path}/_commits/*.json").collect()  # one line per commit
        return sorted((json.loads(r[0]) for r in rows), key=lambda x: x["version"])

    def read(self, version: int | None = None, parts: set[int] | None = None) -> DataFrame:
        """The table, or of a table with keys the rows of some parts."""
        h = self.history()
        if not h:
            raise FileNotFoundError(self.path)
        at = h[-1] if version is None else next(x for x in h if x["version"] == version)
        folders = [f for k, f in at["parts"].items() if parts is None or int(k) in parts]
        schema = T.StructType.fromJson(at["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def write(self, df: DataFrame, operation: str, counts: dict[str, int] | None = None, touched: set[int] | None = None) -> int:
        """A new version of ``df``, or of a table with keys one in which ``df`` replaces the ``touched`` parts."""
        h = self.history()
        v = h[-1]["version"] + 1 if h else 0
        folder = f"v{v:08d}_{uuid.uuid4().hex}"  # two writers never share one; the commit line names the winner's
        if self.keys is None:
            df.write.parquet(f"{self.path}/{folder}")
            parts = {"0": folder}
            rows = self.spark.read.schema(df.schema).parquet(f"{self.path}/{folder}").count()
        else:
            df.withColumn("_part", self._bucket()).repartition("_part").write.partitionBy("_part").parquet(f"{self.path}/{folder}")
            new = {x.getPath().getName().split("=")[1] for x in self.fs.listStatus(self._p(f"{self.path}/{folder}")) if x.getPath().getName().startswith("_part=")}
            kept = {k: f for k, f in (h[-1]["parts"].items() if h and touched is not None else ()) if int(k) not in touched}
            parts = kept | {k: f"{folder}/_part={k}" for k in new}
            rows = sum(self.spark.read.schema(df.schema).parquet(*[f"{self.path}/{f}" for f in fs]).count() for fs in [list(parts.values())] if fs)
        line = json.dumps({"version": v, "timestamp": time.time(), "operation": operation, "rows": rows, "parts": parts, "schema": json.loads(df.schema.json()), "metrics": counts or {}})
        tmp, log = self._p(f"{self.path}/_commits/.{folder}.tmp"), self._p(f"{self.path}/_commits/{v:08d}.json")
        out = self.fs.create(tmp, True)
        out.write(bytearray(line, "utf-8"))
        out.close()
        if not self.fs.rename(tmp, log):
            raise RuntimeError(f"version {v} was committed by another writer")
        return v

    def append(self, df: DataFrame) -> int:
        """Append with additive schema evolution."""
        old = self.read() if self.history() else None
        return self.write(df if old is None else old.unionByName(df, allowMissingColumns=True), "APPEND")

    def replace_slice(self, df: DataFrame, where: Column) -> int:
        """Rows matching ``where`` are replaced by ``df``."""
        return self.write(self.read().where(~F.coalesce(where, F.lit(False))).unionByName(df, allowMissingColumns=True), "REPLACE SLICE")

    def merge(self, source: DataFrame, keys: list[str], columns: list[str], now: Column, missing: str = "keep", **stamps) -> dict[str, int]:
        """Merge by ``keys``. Where these are the table's own and rows absent from the source stay as they are, only the parts with source
        rows are read and written; ``keep`` then counts the rows of these parts."""
        from kilovela.session import stage

        touched = None
        if self.keys == keys and missing == "keep" and self.history():
            touched = {r["b"] for r in source.select(self._bucket().alias("b")).distinct().collect()}  # at most `buckets` numbers
        target = self.read(parts=touched) if self.history() else source.limit(0)
        p = stage(plan(target, source, keys, columns, missing, stamps.get("active")), "merge")
        counts = {r["_action"]: r["filas"] for r in metrics(p).collect()}  # five rows at most
        if set(counts) - {"keep"} or not self.history():
            self.write(apply(p, target, columns, now, **stamps), "MERGE", counts, touched)
        return counts


def deduplicated_upsert(order: list[Column], keys: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Source preparation for streams: newest row per key."""
    from kilovela.operators.versioning import latest

    return lambda df: latest(df, keys, order)


def update_where(df: DataFrame, where: Column, values: dict[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE: the columns of ``values`` change where the condition is true; where it is NULL nothing does."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.when(where, v).otherwise(F.col(c)).cast(kinds[c]) for c, v in values.items()})
