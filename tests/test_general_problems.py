"""Edge cases of the general data operators: NULLs, ties, repeated rows, empty tables, clashing extra columns, brute force."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kilovela.operators import anomalies, bitemporal, gridfill, history, quantiles
from kilovela.operators.profile import ColumnSpec, findings, profile

# --- quantiles ---


def test_exact_medians_match_python(frame):
    rnd = random.Random(1)
    rows = [(k, rnd.choice([rnd.gauss(0, 100), 0.0, -3.5, 7.25, 1e12, 1e-9])) for k in ("a", "b", "c", "d") for _ in range(rnd.randint(1, 300))]
    rows += [("e", None), ("f", float("nan")), ("g", 5.0)]
    df = frame("k string, v double", rows)
    got = dict(frame.rows(quantiles.exact_medians(df, quantiles.sketch(df, ["k"], "v"), ["k"], "v")))
    import statistics

    want = {k: statistics.median([v for kk, v in rows if kk == k]) for k in "abcdg"}
    assert got == pytest.approx(want)


# --- p1 ---

SPEC = [ColumnSpec("valor", "number", low=0.0)]
LOADS = "source_file_name string, valor double, carga string, tabla string"


def loads(values, name):
    return [(name, v, "x", "y") for v in values]


def test_findings(frame):
    rows = loads([10.0] * 20, "a") + loads([11.0] * 15 + [None] * 6, "b") + loads([9.0] * 18 + [-1.0] * 2, "c") + loads([100.0] * 20, "d") + loads([1000.0] * 19, "short") + loads([10.0] * 30, None)
    got = frame.rows(findings([(frame(LOADS, rows), "t", "source_file_name", SPEC)]))
    assert got == [("t", "valor", "b", "nulos"), ("t", "valor", "c", "rango"), ("t", "valor", "d", "distribucion")]


def test_findings_nan_is_out_of_range_and_limits_are_strict(frame):
    at_limit = loads([10.0] * 16 + [None] * 4, "a") + loads([10.0] * 19 + [-1.0], "b")
    rows = at_limit + loads([10.0] * 17 + [float("nan")] * 3, "c") + loads([30.0] * 20, "d") + loads([1e15] * 9 + [10.0] * 11, "e")
    assert frame.rows(findings([(frame(LOADS, rows), "t", "source_file_name", SPEC)])) == [("t", "valor", "c", "rango")]


def test_findings_and_profile_of_empty_and_all_null(frame):
    assert frame.rows(findings([(frame(LOADS), "t", "source_file_name", SPEC)])) == []
    assert profile(frame(LOADS), "t", "source_file_name", SPEC).count() == 0
    assert frame.rows(findings([(frame(LOADS, loads([None] * 20, "a")), "t", "source_file_name", SPEC)])) == [("t", "valor", "a", "nulos")]


def test_profile_counts(frame):
    rows = loads([1.0, 1.0, 3.0, None, -2.0], "a") + loads([5.0] * 3, "b") + loads([4.0], None)
    specs = [*SPEC, ColumnSpec("carga", pattern="^y$")]
    p = {(r["columna"], r["carga"]): r for r in profile(frame(LOADS, rows), "t", "source_file_name", specs).collect()}
    a = p["valor", "a"]
    assert (a["filas"], a["nulos"], a["fuera"], a["distintos"], a["minimo"], a["maximo"], a["media"]) == (5, 1, 1, 3, "-2.0", "3.0", 0.75)
    assert p["valor", "b"]["dif_anterior"] > 0 and p["valor", None]["distintos"] == 1
    assert p["carga", "a"]["fuera"] == 5 and p["carga", "a"]["dif_resto"] is None


def test_power_sums_do_not_depend_on_partitions(frame):
    rows = loads([random.Random(i).uniform(0, 1e6) for i in range(500)], "a")
    one = profile(frame(LOADS, rows).coalesce(1), "t", "source_file_name", SPEC).first()
    many = profile(frame(LOADS, rows[::-1]).repartition(7), "t", "source_file_name", SPEC).first()
    assert (one["suma"], one["suma2"]) == (many["suma"], many["suma2"])


# --- p2 ---


def brute_asof(events, versions):
    out = {}
    for eid, e, d, t in events:
        ok = [(s, c, p) for en, s, c, p in versions if en == e and e is not None and None not in (d, t, s, c) and s <= d and c <= t]
        out[eid] = max(ok)[2] if ok else None
    return out


def test_as_known_matches_brute_force(frame):
    rnd = random.Random(4)
    versions = [(rnd.choice(["a", "b", "hot"]), rnd.randint(0, 60), rnd.randint(0, 60) * 10, i) for i in range(150)]
    versions += [("a", None, 5, 900), ("a", 5, None, 901), (None, 1, 1, 902), versions[0]]
    events = [(i, rnd.choice(["a", "b", "hot", "none", None]), rnd.randint(-5, 70), rnd.randint(-5, 70) * 10) for i in range(800)] + [(9001, "a", None, 3), (9002, "a", 3, None)]
    ev = frame("id long, entity string, vday long, vrec long", events)
    got = {r["id"]: r["_pick"] for r in bitemporal.as_known(ev, frame("entity string, s long, c long, pick long", versions)).collect()}
    assert got == brute_asof(events, versions)


def test_rectangles_are_disjoint_and_few(frame):
    rnd = random.Random(5)
    versions = [("e", rnd.randint(0, 40), rnd.randint(0, 40), i) for i in range(120)]
    r = bitemporal.rectangles(frame("entity string, s long, c long, pick long", versions)).collect()
    assert len(r) <= 2 * len(versions)
    cells = [(x, y) for q in r for x in range(q["v0"], min(q["v1"], 45)) for y in range(q["r0"], min(q["r1"], 45))]
    assert len(cells) == len(set(cells))


DIM = "agente_key long, codigo_agente string, fecha_inicio date, fecha_fin date, fecha_creacion timestamp, entity string"
FACT = "generacion_key string, agente_key long, fecha_hora timestamp, pick long"


def test_agent_at_event(frame):
    dim = [(1, " ag1 ", date(2024, 1, 1), None, datetime(2024, 1, 5), "x"), (2, "AG1", date(2024, 2, 1), None, datetime(2024, 3, 1), "x")]
    fact = [("a", 1, datetime(2024, 1, 3), 7), ("b", 2, datetime(2024, 2, 10), 7), ("c", 2, datetime(2024, 3, 1), 7), ("d", None, datetime(2024, 3, 1), 7), ("e", 99, datetime(2024, 3, 1), 7), ("f", 1, None, 7), ("c", 2, datetime(2024, 3, 1), 7)]
    got = frame.rows(bitemporal.agent_at_event(frame(FACT, fact), frame(DIM, dim)))
    assert got == [("a", 1, 0), ("b", 2, 1), ("c", 2, 2), ("c", 2, 2), ("d", None, 0), ("e", 99, 0), ("f", 1, 0)]
    assert bitemporal.agent_at_event(frame(FACT), frame(DIM, dim)).count() == 0
    assert frame.rows(bitemporal.agent_at_event(frame(FACT, fact[:1]), frame(DIM))) == [("a", 1, 0)]


# --- p3 ---

READ = "registro_id long, codigo_planta string, fecha_hora timestamp, valor double, src string, t long"


def measure(low_too):
    return anomalies.Measure("t", "registro_id", "codigo_planta", "fecha_hora", "valor", low_too)


def at(h):
    return datetime(2026, 1, 1) + timedelta(hours=h)


def brute_implausible(rows, low_too):
    import statistics

    by = defaultdict(list)
    for i, s, t, v in rows:
        if s is not None and v is not None:
            by[s.strip().upper()].append((i, t, v))
    bad = {i for i, s, t, v in rows if v is not None and v < 0}
    for rs in by.values():
        pos = [v for _, _, v in rs if v > 0]
        m = statistics.median(pos) if pos else None
        bad |= {i for i, _, v in rs if m is not None and (v > 3 * m or (low_too and v < m / 5))}
        per = defaultdict(set)
        for _, t, v in rs:
            if t is not None:
                per[t].add(v)
        ts = sorted(per)
        run = []
        for t in [*ts, None]:
            c = next(iter(per[t])) if t is not None and len(per[t]) == 1 else None
            if run and (t is None or c is None or c == 0 or per[run[0]] != {c}):
                if len(run) >= 6:
                    bad |= {i for i, t2, _ in rs if t2 in run}
                run = []
            if c:
                run.append(t)
    return sorted(bad)


@pytest.mark.parametrize("low_too", [False, True])
def test_implausible_matches_brute_force(frame, low_too):
    rnd = random.Random(7)
    rows, i = [], 0
    for s in ("a", "b", "hot"):
        h = 0
        for _ in range(260):
            h += rnd.choice([1, 1, 1, 30, 400])
            stuck = rnd.random() < 0.75
            v = rows[-1][3] if stuck and rows else rnd.choice([0.0, 5.0, 9.0, 10.0, 40.0, -1.0, None])
            for _ in range(rnd.choice([1, 1, 2])):
                i += 1
                rows.append((i, rnd.choice([s, f" {s.upper()} "]), at(h), v if rnd.random() > 0.03 else rnd.choice([None, 11.0])))
    rows += [(9001, None, at(1), -4.0), (9002, "a", None, 500.0), (9003, "a", at(2), None)]
    df = frame(READ, [(*r, "x", 1) for r in rows])
    got = sorted(r["registro_id"] for r in anomalies.implausible([(df, measure(low_too))]).collect())
    assert got == brute_implausible(rows, low_too)


def test_stuck_run_crosses_blocks(frame):
    rows = [(k, "a", at(24 * 30 * k), 3.0, "x", 1) for k in range(6)] + [(10 + k, "b", at(24 * 30 * k), 3.0, "x", 1) for k in range(5)]
    got = anomalies.implausible([(frame(READ, rows), measure(False))])
    assert sorted(r["registro_id"] for r in got.collect()) == list(range(6))
    assert anomalies.implausible([(frame(READ), measure(True))]).count() == 0


def test_contextual_marks_a_jump(frame):
    rows = [(k, "a", at(24 * k), 10.0 + k % 3, "x", 1) for k in range(40)] + [(99, "a", at(24 * 40), 500.0, "x", 1)]
    got = {r["registro_id"]: r for r in anomalies.contextual([(frame(READ, rows), measure(False))]).collect()}
    assert got[99]["fuera_de_valla"] and 5 not in got


# --- p4 ---

DEM = "demanda_key string, agente_key long, tipo_mercado string, fecha_hora timestamp, demanda_real_kwh double, h long, s long"


def fill(df):
    return gridfill.fill(df, ["agente_key", "tipo_mercado"], "fecha_hora", "demanda_real_kwh", "demanda_key")


def test_fill_keeps_observed_and_marks_the_rest(frame):
    import math

    rows, hidden = [], {(s, h) for s in range(6) for h in range(10, 90) if (s * 7 + h) % 9 == 0}
    for s in range(6):
        for h in range(96):
            if (s, h) not in hidden:
                rows.append((f"k{s}-{h}", s, "REG", at(h) + timedelta(minutes=s), (s + 1) * (50 + 20 * math.sin(h * math.pi / 12)), 1, 1))
    rows += [rows[0], ("x", 0, "REG", at(0), 70.0, 1, 1), ("n", 0, "REG", at(500), None, 1, 1), ("nt", 0, "REG", None, 4.0, 1, 1), ("p", 77, None, at(0), 4.0, 1, 1), ("q", 77, None, at(3), 6.0, 1, 1)]
    got = {(r["agente_key"], r["h"] - 490896): (r["valor"], r["estado"]) for r in fill(frame(DEM, rows)).collect()}
    assert got[0, 0] == (pytest.approx((50 + 70) / 2), "observado")
    assert {k for k, v in got.items() if v[1] == "estimado"} == hidden
    assert {k for k, v in got.items() if v[1] == "sin_soporte"} == {(77, 1), (77, 2)} and got[77, 1][0] is None
    for s, h in hidden:
        assert got[s, h][0] == pytest.approx((s + 1) * (50 + 20 * math.sin(h * math.pi / 12)), rel=0.08)


def test_fill_empty(frame):
    assert fill(frame(DEM)).count() == 0


def test_holdout_beats_the_mean(spark):
    from kilovela.plans.data_problems import p4_accuracy

    r = p4_accuracy(spark, "/root/testdata/sf0.01").first()
    assert r["n"] > 200 and r["rmse"] < 0.6 * r["rmse_media"]


# --- p6 ---

SNAP = "registro_id long, fecha date, codigo_agente string, nombre_agente string, actividad_agente string, ingestion_timestamp timestamp, leaf int, e string"


def snap(rows):
    return [(i, date.fromisoformat(f), c, n, a, datetime(2026, 1, 1) + timedelta(hours=t), 1, "x") for i, (f, c, n, a, t) in enumerate(rows)]


def hist(df):
    return history.versions(df, "codigo_agente", "fecha", ["nombre_agente", "actividad_agente"], "ingestion_timestamp", "registro_id")


def test_history(frame):
    rows = [
        ("2024-01-01", "a1 ", "Río  Uno", "GEN", 0), ("2024-02-01", "A1", "RIO UNO", "gen", 0), ("2024-03-01", "A1", None, "GEN", 0), ("2024-04-01", "A1", "Dos", " ", 0), ("2024-05-01", "A1", "Dos", "TRA", 5), ("2024-05-01", "A1", "Tres", "TRA", 1),
        ("2024-07-01", "A1", "Dos", "TRA", 0), ("2024-01-01", "B", "x", "y", 0), ("2024-01-01", "B", "x", "y", 0), ("2024-07-01", "B", "x", "y", 0), ("2024-03-01", "C", None, None, 0), ("2024-04-01", "C", "z", None, 0), ("2024-04-01", " ", "z", None, 0), ("2024-04-01", None, "z", None, 0),
    ]
    got = [(r["codigo_agente"], r["numero_version"], r["nombre_agente"], r["actividad_agente"], str(r["fecha_inicio"]), str(r["fecha_fin"]), r["es_actual"]) for r in hist(frame(SNAP, snap(rows))).orderBy("codigo_agente", "numero_version").collect()]
    assert got == [
        ("A1", 1, "Río  Uno", "GEN", "2024-01-01", "2024-03-31", False), ("A1", 2, "Dos", "GEN", "2024-04-01", "2024-04-30", False), ("A1", 3, "Dos", "TRA", "2024-05-01", "9999-12-31", True),
        ("B", 1, "x", "y", "2024-01-01", "9999-12-31", True), ("C", 1, None, None, "2024-03-01", "2024-03-31", False), ("C", 2, "z", None, "2024-04-01", "9999-12-31", True),
    ]
    assert hist(frame(SNAP)).count() == 0


def test_merkle_descends_only_where_something_changed(frame):
    rows = [(f"2024-0{m}-{10 + k % 3}", f"A{k}", "n" if (m, k) != (3, 17) else "changed", "GEN", 0) for m in range(1, 6) for k in range(300)]
    rows += [("2024-04-28", "A5", "two states", "GEN", 0)]
    latest = history.latest(frame(SNAP, snap(rows)), "codigo_agente", "fecha", ["nombre_agente", "actividad_agente"], "ingestion_timestamp", "registro_id")
    leaves = history.leaves_for(latest)
    per = dict(history.changed_leaves(latest, ["nombre_agente", "actividad_agente"], leaves).groupBy(F.month("p")).count().collect())
    assert leaves == 65536 and per[3] == 1 and per[4] == 2 and per[5] == 1 and 2 not in per and per[1] > 200


def test_merkle_prunes_most_rows_of_the_given_snapshots(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/agentes.parquet")
    attrs = ["nombre_agente", "actividad_agente"]
    rows = history.latest(d, "codigo_agente", "fecha", attrs, "ingestion_timestamp", "registro_id").cache()
    leaves = history.leaves_for(rows)
    left = rows.withColumns({"p": F.trunc("f", "month"), "leaf": history._leaf(leaves)}).join(history.changed_leaves(rows, attrs, leaves), ["p", "leaf"], "left_semi").count()
    assert left < 0.5 * rows.count()


def test_history_matches_brute_force(frame):
    rnd = random.Random(9)
    rows = [(f"2024-{m:02d}-{rnd.choice([1, 1, 9, 20]):02d}", f"A{k}", rnd.choice(["x", "x", "x", "x", "y", None, ""]), rnd.choice(["g", "g", "h", None]), rnd.randint(0, 3)) for m in range(1, 13) for k in range(25) for _ in range(rnd.choice([0, 1, 1, 2]))]
    want = []
    for k in {r[1] for r in rows}:
        prev = None
        last = {}
        for i, r in enumerate(rows):
            if r[1] == k and (r[0] not in last or (r[4], i) > last[r[0]][0]):
                last[r[0]] = (r[4], i), r
        for f, (_, (_, _, n, a, _)) in sorted(last.items()):
            cur = ((n or "").upper() or (prev and prev[0]) or None, (a or "").upper() or (prev and prev[1]) or None)
            if prev is None or cur != prev:
                want.append((k, f))
            prev = cur
    got = [(r["codigo_agente"], str(r["fecha_inicio"])) for r in hist(frame(SNAP, snap(rows))).collect()]
    assert sorted(got) == sorted(want)


def test_as_known_with_a_shuffled_index(frame):
    rnd = random.Random(14)
    versions = [(rnd.choice(["a", "hot"]), rnd.randint(0, 60), rnd.randint(0, 60) * 10, i) for i in range(120)]
    events = [(i, rnd.choice(["hot", "hot", "a", None]), rnd.randint(-5, 70), rnd.randint(-5, 70) * 10) for i in range(500)]
    ev = frame("id long, entity string, vday long, vrec long", events)
    got = {r["id"]: r["_pick"] for r in bitemporal.as_known(ev, frame("entity string, s long, c long, pick long", versions), max_rows=0).collect()}
    assert got == brute_asof(events, versions)


def test_a_side_of_few_but_wide_rows_is_not_broadcast(frame):
    from kilovela.session import fits_broadcast

    df = frame("k int, t string, l array<int>", [(1, "x" * 1000, [1]), (2, None, None)])
    assert fits_broadcast(df) and not fits_broadcast(df, max_bytes=900) and not fits_broadcast(df, max_rows=1)


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_findings_equal_brute_force(frame, seed):
    import statistics

    rnd = random.Random(seed)
    rows = []
    for k in range(rnd.choice([6, 7, 12])):
        level = rnd.choice([1.0, 10.0, 10.0, 12.0, 31.0, -5.0, 0.0])
        rows += loads([None if rnd.random() < rnd.choice([0, 0.3]) else level * rnd.choice([0.5, 1, 1, 1, 2.9, 50]) + rnd.random() for _ in range(rnd.choice([19, 20, 33]))], f"c{k}")
    by = defaultdict(list)
    for load, v, *_ in rows:
        by[load].append(v)
    full = {k: [v for v in vs if v is not None] for k, vs in by.items() if len(vs) >= 20}
    med = {k: statistics.median(vs) for k, vs in full.items() if vs}
    m = statistics.median(med.values())
    want = {("t", "valor", k, "nulos") for k, vs in full.items() if len(by[k]) - len(vs) > 0.2 * len(by[k])}
    want |= {("t", "valor", k, "rango") for k, vs in full.items() if sum(v < 0 for v in vs) > 0.05 * len(vs)}
    want |= {("t", "valor", k, "distribucion") for k, x in med.items() if x > 3 * m or x < m / 3}
    assert set(frame.rows(findings([(frame(LOADS, rows), "t", "source_file_name", SPEC)]))) == want
