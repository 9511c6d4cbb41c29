"""Run, task and layer audit, and quarantine of rows that fail a rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilovela.operators import merge
from kilovela.operators.quality import Rule

DONE = "SUCCESS"


def runs_started(runs: DataFrame, started: DataFrame, now: Column) -> DataFrame:
    """Run table after the start of the runs in ``started`` (run_id, job_name, started_at): new ones RUNNING, a repeated start of a
    known run puts it back to RUNNING and keeps its creation time."""
    s = started.select("run_id", "job_name", "started_at", F.lit("RUNNING").alias("status"), F.lit(None).cast("timestamp").alias("finished_at"), F.lit(None).cast("double").alias("duration_seconds"))
    columns = ["job_name", "started_at", "status", "finished_at", "duration_seconds"]
    return merge.apply(merge.plan(runs, s, ["run_id"], columns), runs, columns, now, created="created_at")


def runs_finished(runs: DataFrame, tasks: DataFrame, now: Column) -> DataFrame:
    """Run table after its running runs with finished tasks are closed: counts of tasks by outcome, FAILED if a task failed, the end
    of the last task and the seconds since the start. Runs without tasks stay as they are."""
    per = tasks.groupBy("run_id").agg(F.count("*").alias("_all"), F.count_if(F.col("status") == DONE).alias("_ok"), F.count_if(F.col("status") == "FAILED").alias("_bad"), F.max("finished_at").alias("_end"))
    j = runs.join(per, "run_id", "left")
    close = (F.col("status") == "RUNNING") & F.col("_all").isNotNull() & F.col("_end").isNotNull()
    end = F.when(close, F.col("_end")).otherwise(F.col("finished_at"))
    return j.select(
        *[c for c in runs.columns if c not in ("status", "finished_at", "duration_seconds", "tasks_total", "tasks_succeeded", "tasks_failed")],
        F.when(close, F.when(F.col("_bad") > 0, "FAILED").otherwise(DONE)).otherwise(F.col("status")).alias("status"), end.alias("finished_at"),
        F.when(close, (F.unix_micros(F.col("_end").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))) / 1e6).otherwise(F.col("duration_seconds")).alias("duration_seconds"),
        F.coalesce("_all", F.lit(0)).alias("tasks_total"), F.coalesce("_ok", F.lit(0)).alias("tasks_succeeded"), F.coalesce("_bad", F.lit(0)).alias("tasks_failed"),
    )


def task_upsert(tasks: DataFrame, seen: DataFrame, now: Column) -> DataFrame:
    """Task table after an upsert of ``seen`` by (run_id, task_key)."""
    columns = [c for c in seen.columns if c not in ("run_id", "task_key")]
    return merge.apply(merge.plan(tasks, seen, ["run_id", "task_key"], columns), tasks, columns, now)


def layer_metrics(tables: dict[str, tuple[DataFrame, str, str]], rejected: DataFrame, now: Column) -> DataFrame:
    """One row per (layer, source): rows, first and last event, seconds from the last event to ``now``, and the rows rejected.
    ``tables``: source -> (frame, layer, time column); ``rejected``: source_name, rows."""
    one = lambda n, df, layer, when: df.agg(F.count("*").alias("rows_read"), F.min(when).cast("timestamp").alias("min_event_time"), F.max(when).cast("timestamp").alias("max_event_time")).withColumns({"source_name": F.lit(n), "layer": F.lit(layer)})
    u = reduce(DataFrame.unionByName, [one(n, *t) for n, t in tables.items()])
    bad = rejected.groupBy("source_name").agg(F.sum("rows").alias("rows_rejected"))
    j = u.join(F.broadcast(bad), "source_name", "left")  # one row per source
    return j.withColumns({"rows_rejected": F.coalesce("rows_rejected", F.lit(0)), "lag_seconds": F.unix_timestamp(now) - F.unix_timestamp("max_event_time"), "collected_at": now, "status": F.lit(DONE)})


def source_freshness(metrics: DataFrame) -> DataFrame:
    """Per (source, layer) the newest event and the lag of the latest successful collection."""
    return metrics.where(F.col("status") == DONE).groupBy("source_name", "layer").agg(F.max("max_event_time").alias("max_event_time"), F.max_by("lag_seconds", "collected_at").alias("latest_lag_seconds"), F.max("collected_at").alias("collected_at"))


def metric_totals(history: DataFrame, since: Column) -> DataFrame:
    """Sum of each operation metric over the commits from ``since``; values that are no whole number count nothing. ``history``:
    timestamp, metrics map<string, string>."""
    long = history.where(F.col("timestamp") >= since).select(F.explode("metrics").alias("metrica", "v"))
    return long.withColumn("n", F.col("v").try_cast("bigint")).where("n is not null").groupBy("metrica").agg(F.sum("n").alias("total"))


def quarantine(df: DataFrame, rules: list[Rule], run_id: str, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that break no blocking rule, rows that do with the names of the blocking rules they break). One expression per rule, one pass
    over the table per side; NULL conditions break nothing."""
    hits = F.filter(F.array(*[F.when(F.coalesce(r.failed, F.lit(False)), F.lit(r.name)) for r in rules if r.blocking]), lambda x: x.isNotNull())
    marked = df.withColumn("_hits", hits)
    return marked.where(F.size("_hits") == 0).drop("_hits"), marked.where(F.size("_hits") > 0).select(*keep, F.array_join("_hits", ",").alias("reglas"), F.lit(run_id).alias("run_id"))


def alert_ages(alerts: DataFrame, now: Column) -> DataFrame:
    """Alerts with their age in whole hours, up to their resolution or to ``now``."""
    return alerts.withColumn("edad_horas", F.floor((F.unix_timestamp(F.coalesce("resolved_at", now)) - F.unix_timestamp("created_at")) / 3600))
