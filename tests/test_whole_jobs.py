"""Registered queries on small fixtures: the whole table is their input."""

import datetime as dt
import random

import __spark_entry__ as entry
from kilovela.operators import anomalies


def run(spark, name, d):
    return entry.queries()[name](spark, str(d)).collect()


def test_missing_days_of_all_orders(frame, spark, tmp_path):
    # customers 1 and 10 (1 modulo 9) have the 1st and 6th only; the others fill all but the 4th
    days = [(1, 1), (2, 2), (3, 3), (5, 5), (10, 6)]
    frame("o_custkey long, o_orderdate timestamp", [(c, dt.datetime(2024, 1, d)) for c, d in days] + [(4, None)]).write.parquet(f"{tmp_path}/orders.parquet")
    assert [r["fecha"] for r in run(spark, "missing_days", tmp_path)] == [dt.date(2024, 1, 4)]


def test_json_round_trip_of_all_event_types(frame, spark, tmp_path):
    rows = [(1, "click", 1.5), (2, "view", 2.0), (3, None, None)]
    frame("event_id long, event_type string, value double", rows).write.parquet(f"{tmp_path}/events.parquet")
    assert sorted(map(tuple, run(spark, "json_round_trip", tmp_path))) == rows


def test_coverage_and_drift_of_all_readings(frame, spark, tmp_path):
    # agents 7 and 1; the 11th is there, the 13th is missing, the 14th has one hour too few and the 15th three times the rows
    hours = {10: range(24), 11: range(24), 12: range(24), 14: range(23), 15: [*range(24)] * 3}
    rows = [(a, dt.datetime(2024, 3, d, h)) for d, hs in hours.items() for h in hs for a in (7, 1)] + [(1, None)]
    frame("agente_key long, fecha_hora timestamp", rows).write.parquet(f"{tmp_path}/fact_demanda_real.parquet")
    (r,) = run(spark, "coverage_and_drift", tmp_path)
    assert (r["dias"], r["dias_incompletos"], r["dias_atipicos"], r["mediana"]) == (6, 2, 2, 48)


def test_key_profile_counts_blank_and_null_key_parts(frame, spark, tmp_path):
    t, key = dt.datetime(2024, 1, 1), ("GReal", "PT1H", "kWh", "A", "P")
    versions = [("TXF", 1.0), ("TXF", 1.0), (" ", -1.0), (" ", 2.0), (None, -3.0)]
    rows = [(*key, v, t, x) for v, x in versions] + [("GReal", "PT1H", "kWh", None, "P", "TXF", t, 1.0), (*key, "TXF", None, 1.0)]
    ddl = "codigo_variable string, codigo_duracion string, unidad_medida string, codigo_agente string, codigo_planta string, version string, fecha_hora timestamp, valor double"
    frame(ddl, rows).write.parquet(f"{tmp_path}/generacion_real.parquet")
    (r,) = run(spark, "invalid_key_profile", tmp_path)
    assert (r["filas"], r["claves_invalidas"], r["claves"], r["duplicados"], r["negativos"]) == (7, 5, 5, 2, 2)


READ = "registro_id long, codigo_planta string, fecha_hora timestamp, valor double"
MEASURE = anomalies.Measure("t", "registro_id", "codigo_planta", "fecha_hora", "valor")


def jumps(frame, rows, jump):
    return sorted(r["registro_id"] for r in anomalies.contextual([(frame(READ, rows), MEASURE)], jump).collect() if r["salto"])


def test_jump_at_a_block_border_and_in_every_version(frame):
    day = lambda k: dt.datetime(2026, 1, 1) + dt.timedelta(days=k)
    border = next(k for k in range(40, 80) if (day(k) - dt.datetime(1970, 1, 1)).days * 86400 % anomalies.BLOCK_S == 0)
    rows = [(k, "a", day(k), 500.0 if k == border else 10.0 + k % 3) for k in range(100)]
    assert jumps(frame, rows, 1.0) == [border, border + 1]
    rows = [(k, "a", day(k), 10.0 + k % 3) for k in range(100) if k != 70] + [(200, "a", day(70), 500.0), (201, "a", day(70), 500.0)]
    assert jumps(frame, rows, 1.0) == [71, 200, 201]


def test_jumps_equal_brute_force_over_blocks(frame):
    rnd, rows = random.Random(3), []
    for s in "abc":
        h = 0
        for _ in range(150):
            h += rnd.choice([1, 1, 24, 400, 2000])
            rows += [(rnd.randrange(10**9), s, dt.datetime(2025, 1, 1) + dt.timedelta(hours=h), rnd.choice([1.0, 2.0])) for _ in range(rnd.choice([1, 2, 3]))]
    rnd.shuffle(rows)
    want = []
    for i, s, t, v in rows:
        if before := [(u, j, x) for j, r, u, x in rows if r == s and u < t]:
            want += [i] if max(before)[2] != v else []
    assert jumps(frame, rows, 0.0) == sorted(want)


def test_completeness_covers_every_column(frame, spark, tmp_path):
    for name, t in (("completeness_profile", "documents"), ("approx_distinct", "generacion_real")):
        cols = spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").columns
        assert sorted(r["columna"] for r in run(spark, name, "/root/testdata/sf0.001")) == sorted(cols)
    frame("doc_id long, text string", [(1, " "), (2, None), (3, "a"), (3, "a")]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["columna"]: (r["filas"], r["nulos"], r["vacios"], r["distintos"]) for r in run(spark, "completeness_profile", tmp_path)}
    assert got == {"doc_id": (4, 0, 0, 3), "text": (4, 1, 1, 2)}
