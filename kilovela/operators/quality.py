"""Rule checks as fused aggregates: one scan per table gives all its counters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilovela.functions.normalize import invalid_key
from kilovela.operators.joins import fill_calendar, with_scalars
from kilovela.operators.versioning import priority


@dataclass(frozen=True)
class Rule:
    component: str
    name: str
    failed: Column
    dimension: str = "VALIDITY"
    severity: str = "MEDIUM"
    blocking: bool = False


def evaluate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule with errors, rate and verdict; all rules of the table in one aggregate. The rule id is the first 20
    digits of SHA-256 over component and name."""
    wide = df.agg(F.count("*").alias("_n"), *[F.count_if(r.failed).alias(f"_r{i}") for i, r in enumerate(rules)])
    part = lambda i, r: F.struct(
        F.left(F.sha2(F.lit(f"{r.component}|{r.name}"), 256), F.lit(20)).alias("rule_id"), F.lit(r.component).alias("component"), F.lit(r.name).alias("rule_name"), F.lit(r.dimension).alias("quality_dimension"),
        F.lit(r.severity).alias("severity"), F.lit(r.blocking).alias("is_blocking"), F.col(f"_r{i}").alias("error_count"),
    )
    long = wide.select("_n", F.explode(F.array(*[part(i, r) for i, r in enumerate(rules)])).alias("p")).select("_n", "p.*")
    return long.select("rule_id", "component", "rule_name", "quality_dimension", "severity", "is_blocking", "error_count", F.when(F.col("_n") > 0, F.col("error_count") / F.col("_n")).alias("error_rate"), (F.col("error_count") == 0).alias("passed"))


def blocked(results: DataFrame) -> DataFrame:
    """The gate: failed blocking rules."""
    return results.where(F.col("is_blocking") & ~F.col("passed"))


def key_profile(df: DataFrame, keys: list[str], typed: tuple[str, ...] = (), value: str | None = None) -> DataFrame:
    """Rows, rows with a NULL or blank key part, distinct and duplicated keys, negative values. Keys are grouped first, so
    duplicates cost one partial aggregate and no distinct over a struct."""
    neg = F.count_if(F.col(value) < 0) if value else F.lit(0).cast("long")
    g = df.withColumn("_bad", invalid_key(keys, typed)).groupBy(*keys).agg(F.count("*").alias("n"), F.count_if("_bad").alias("bad"), neg.alias("neg"))
    s = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return g.agg(s("n").alias("filas"), s("bad").alias("claves_invalidas"), F.count("*").alias("claves"), s(F.col("n") - 1).alias("duplicados"), s("neg").alias("negativos"))


def foreign_key(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows, null keys, orphan rows and coverage of a relation: child keys are counted before the join."""
    per = child.groupBy(key).agg(F.count("*").alias("n"))
    p = parent.select(F.col(parent_key).alias(key)).where(F.col(key).isNotNull()).distinct().withColumn("_ok", F.lit(True))
    j = per.join(p, key, "left")
    s = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    return j.agg(s(F.lit(True)).alias("filas"), s(F.col(key).isNull()).alias("nulos"), s(F.col(key).isNotNull() & F.col("_ok").isNull()).alias("huerfanos"))


def version_consistency(df: DataFrame, version: str, stored: str) -> DataFrame:
    """Rows whose stored priority is not that of their version, and rows of unknown version."""
    p = priority(version)
    return df.agg(F.count("*").alias("filas"), F.count_if(~p.eqNullSafe(F.col(stored))).alias("prioridad_distinta"), F.count_if(p == 0).alias("version_desconocida"))


def freshness(df: DataFrame, when: str, today: Column) -> DataFrame:
    return df.agg(F.max(F.to_date(when)).alias("fecha_maxima")).withColumn("dias_rezago", F.datediff(today, "fecha_maxima"))


def daily_reconcile(left: DataFrame, right: DataFrame, day: str, measures: list[str], tolerance: float = 0.001) -> DataFrame:
    """Days whose counts (NULL-safe) or measures (beyond the tolerance, NULL as 0) differ. Both sides: day, registros, measures."""
    lhs = left.select(day, *[F.col(c).alias(f"l_{c}") for c in ["registros", *measures]])
    rhs = right.select(day, *[F.col(c).alias(f"r_{c}") for c in ["registros", *measures]])
    bad = ~F.col("l_registros").eqNullSafe(F.col("r_registros"))
    for m in measures:
        bad = bad | (F.abs(F.coalesce(f"l_{m}", F.lit(0)) - F.coalesce(f"r_{m}", F.lit(0))) > tolerance)
    return lhs.join(rhs, day, "full").where(bad)


def hour_mask(df: DataFrame, when: str) -> DataFrame:
    """(fecha, n, mascara): rows of each day and the set of its hours as 24 bits, in one hash aggregate."""
    bit = F.call_function("shiftleft", F.lit(1), F.hour(when))
    return df.where(F.col(when).isNotNull()).groupBy(F.to_date(when).alias("fecha")).agg(F.count("*").alias("n"), F.bit_or(bit).alias("mascara"))


def coverage_and_drift(df: DataFrame, when: str, low: float = 0.5, high: float = 2.0) -> DataFrame:
    """Over every day between the first and the last with rows: how many days, how many lack an hour (a missing day lacks all), how
    many have a volume outside low..high times the median of the days with rows, and that median."""
    full = fill_calendar(hour_mask(df, when), "fecha").select(F.coalesce("n", F.lit(0)).alias("n"), (F.coalesce("mascara", F.lit(0)) != (1 << 24) - 1).alias("parcial"))
    middle = full.where("n > 0").agg(F.percentile_approx("n", 0.5, 10000).alias("mediana"))
    ratio = F.col("n") / F.col("mediana")
    x = with_scalars(full, middle).withColumn("raro", (ratio < low) | (ratio > high))
    return x.agg(F.count("*").alias("dias"), F.count_if("parcial").alias("dias_incompletos"), F.count_if("raro").alias("dias_atipicos"), F.max("mediana").alias("mediana"))


def fingerprint(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Order-free digest of a table: rows, exact total, and the sum of the first 32 bits of each row's hash."""
    h = F.conv(F.left(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col(measure).cast("string"))), F.lit(8)), 16, 10)
    return df.agg(F.count("*").alias("filas"), F.countDistinct(key).alias("claves"), F.sum(F.col(measure).cast("decimal(24,6)")).cast("decimal(38,6)").alias("total"), F.sum(h.cast("decimal(20,0)")).alias("huella"))


def slo(df: DataFrame) -> DataFrame:
    """(slo_id, valor, operador, umbral) -> cumple; NULL fails, an unknown operator raises."""
    v, t, o = F.col("valor"), F.col("umbral"), F.col("operador")
    ok = F.when(o == "<=", v <= t).when(o == ">=", v >= t).when(o == "==", v == t).otherwise(F.raise_error(F.concat(F.lit("unknown operator "), o)).cast("boolean"))
    return df.withColumn("cumple", F.coalesce(ok, F.lit(False)))


def open_alerts(alerts: DataFrame, results: DataFrame, run_id: str, now: Column) -> DataFrame:
    """Alert life cycle of a run: open alerts of rules that now pass are resolved, then each failed blocking rule opens one alert
    whose id hashes run and rule, so a rerun adds nothing."""
    passed = results.where("passed").select("rule_id").distinct().withColumn("_ok", F.lit(True))
    a = alerts.join(passed, "rule_id", "left")
    done = (F.col("status") == "OPEN") & F.coalesce("_ok", F.lit(False))
    a = a.withColumn("resolved_at", F.when(done, now).otherwise(F.col("resolved_at"))).withColumn("status", F.when(done, "RESOLVED").otherwise(F.col("status"))).drop("_ok")
    new = blocked(results).select(F.sha2(F.concat(F.lit(f"{run_id}|"), "rule_id"), 256).alias("alert_id"), "rule_id", F.lit(run_id).alias("run_id"), F.lit("OPEN").alias("status"), now.alias("created_at"), F.lit(None).cast("timestamp").alias("resolved_at"))
    return a.unionByName(new.join(alerts.select("alert_id"), "alert_id", "left_anti"))


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row with the row count of every layer."""
    out = None
    for n, df in tables.items():
        c = df.agg(F.count("*").alias(n))
        out = c if out is None else out.crossJoin(c)  # one row each
    return out


def same_rows(left: DataFrame, right: DataFrame, key: str, measure: str) -> DataFrame:
    """Rows by key on either side, and how many differ in their measure's total or are on one side only."""
    side = lambda df, n: df.groupBy(key).agg(F.sum(measure).alias(n), F.lit(True).alias(f"_{n}"))
    j = side(left, "a").join(side(right, "b"), key, "full")
    return j.agg(F.count("*").alias("filas"), F.count_if(~F.col("a").eqNullSafe(F.col("b")) | F.col("_a").isNull() | F.col("_b").isNull()).alias("distintas"))
