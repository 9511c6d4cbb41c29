"""Reference-level operators: versions, joins, merge, dimensions, quality, sources, streaming, plans."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kilovela.functions import normalize as N
from kilovela.operators import dimensions as D
from kilovela.operators import exploration as X
from kilovela.operators import audit, governance, joins, loaders, merge, quality, versioning
from kilovela.plans import measures as M
from kilovela.plans import views as V
from kilovela.session import join_small
from kilovela.sources import landing as L


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_normal_forms(frame):
    r = frame("a string", [("  Peñol   Punchiná ",), ("áé",), (None,)]).select(N.fold_then_upper("a"), N.upper_then_fold("a"), N.match_key("a"), N.plain_text("a"), N.blank_to("a", "-")).collect()
    assert tuple(r[0]) == ("PEñOL PUNCHINá".upper(), "PENOL PUNCHINA", "PENOLPUNCHINA", "PENOL PUNCHINA", "Peñol   Punchiná")
    assert r[1][0] == "ÁÉ" and r[1][1] == "AE" and tuple(r[2])[:4] == (None, None, None, None) and r[2][4] == "-"
    n = [x[0] for x in frame("a string", [("1,5",), (" 2.0 ",), ("x",), ("",), (None,)]).select(N.decimal_comma("a")).collect()]
    assert n == [1.5, 2.0, None, None, None]


def test_version_ladder(frame):
    rows = [("k1", v, i, None) for i, v in enumerate(["TX1", "TX2", "TXR", " txf "])] + [("k2", "TX2", 9, None), ("k2", "TX10", 1, None), ("k3", "ABC", 1, None), ("k3", None, 2, None), ("k4", "TX1", 1, datetime(2026, 1, 2)), ("k4", "TX1", 2, None), (None, "TX1", 1, None)]
    got = {r["k"]: (r["id"], r["prioridad_version"]) for r in versioning.canonical(frame("k string, version string, id long, ts timestamp", rows), ["k"], "version", ["ts"], tie=("id",)).collect()}
    assert got == {"k1": (3, 10000), "k2": (1, 1000), "k3": (1, 0), "k4": (1, 100), None: (1, 100)}
    assert "WindowGroupLimit" in plan_of(versioning.canonical(frame("k string, version string, id long, ts timestamp", rows), ["k"], "version", ["ts"]))
    with pytest.raises(ValueError):
        versioning.load_policy(frame("version_pattern string, priority int, multiplier int, activo boolean", [("TXF", 1, None, True)]))


def test_new_rows_null_safe(frame):
    d = frame("a string, b double", [("x", None), (None, 1.0), ("y", 2.0), ("y", 2.0)])
    assert versioning.new_rows(d, d.limit(0), ["a", "b"]).count() == 3 and versioning.new_rows(d, d, ["a", "b"]).count() == 0
    assert "NestedLoop" not in plan_of(versioning.new_rows(d, d, ["a", "b"]))


def test_join_small_ways_agree(frame):
    big = frame("id long, k string", [(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(900, None)])
    small = frame("k string, v int", [("hot", 1), ("k3", 2)])
    ways = [join_small(big, small, ["k"], salt_of=s, max_rows=m) for s, m in (("id", 10), ("id", 1), (None, 1))]
    assert len({str(frame.rows(w.select("id", "k", "v"))) for w in ways}) == 1 and ways[0].count() == 301


def test_or_join(frame):
    left = frame("id int, n string, c string", [(1, "A", None), (2, None, "c2"), (3, "A", "c2"), (4, "zz", None), (5, "A", "c1"), (6, "D", None)])
    right = frame("n2 string, c2 string, code string", [("A", "c1", "1"), ("B", "c2", "2"), ("D", "c3", "3"), ("D", "c4", "4")])
    got = {r["id"]: (r["code"], r["ambiguo"]) for r in joins.either(left, right, ("n", "n2"), ("c", "c2"), "code").collect()}
    assert got == {1: ("1", False), 2: ("2", False), 3: ("1", True), 4: (None, False), 5: ("1", False), 6: ("3", True)}


def test_overlaps_match_pairs(frame):
    rnd = random.Random(3)
    rows = []
    for i in range(120):
        a = date(2024, 1, 1) + timedelta(rnd.randint(0, 300))
        rows.append((i, f"k{i % 15}", a, None if rnd.random() < 0.05 else a + timedelta(rnd.randint(0, 15))))
    far = date(9999, 12, 31)
    pairs = {y[1] for x in rows for y in rows if x[0] != y[0] and x[1] == y[1] and x[2] <= (y[3] or far) and y[2] <= (x[3] or far)}
    assert {r["k"] for r in joins.overlapping(frame("id int, k string, a date, b date", rows), "k", "a", "b").collect()} == pairs


def test_temporal_edges_and_as_of(frame):
    dim = frame("c string, a date, b date, key int", [("x", date(2024, 1, 1), date(2024, 1, 31), 1), ("x", date(2024, 2, 1), date(9999, 12, 31), 2)])
    fact = frame("id int, code string, d date", [(1, "x", date(2023, 12, 31)), (2, "x", date(2024, 1, 1)), (3, "x", date(2024, 1, 31)), (4, "x", date(2024, 2, 1)), (5, None, date(2024, 2, 1))])
    assert {r["id"]: r["key"] for r in joins.temporal(fact, dim, ("code", "c"), "d", "a", "b", ["key"]).collect()} == {1: None, 2: 1, 3: 1, 4: 2, 5: None}
    left = frame("k int, at int", [(1, 0), (1, 5), (1, 9), (2, 5)])
    assert sorted((r["k"], r["at"], r["v"]) for r in joins.as_of(left, frame("k int, at int, v int", [(1, 5, 50), (1, 7, 70)]), "k", "at", "v").collect() if r["v"]) == [(1, 5, 50), (1, 9, 70)]


def test_merge_semantics_and_idempotence(spark, frame, tmp_path):
    t = merge.Table(spark, str(tmp_path / "t"))
    ddl = "k int, v string, activo boolean, retiro timestamp, creado timestamp, cambiado timestamp"
    now = lambda d: F.lit(f"2026-01-0{d}").cast("timestamp")
    stamps = {"active": "activo", "retired": "retiro", "created": "creado", "updated": "cambiado"}
    src = lambda rows: frame("k int, v string", rows).withColumns({"activo": F.lit(True), "retiro": F.lit(None).cast("timestamp"), "creado": F.lit(None).cast("timestamp"), "cambiado": F.lit(None).cast("timestamp")})
    assert t.merge(src([(1, "a"), (2, None), (3, "c")]), ["k"], ["v"], now(1), "retire", **stamps) == {"insert": 3}
    second = [(1, "a"), (2, "b"), (4, None), (None, "n")]
    assert t.merge(src(second), ["k"], ["v"], now(2), "retire", **stamps) == {"keep": 1, "update": 1, "insert": 2, "retire": 1}
    rows = {r["k"]: r for r in t.read().collect()}
    assert rows[2]["creado"].day == 1 and rows[2]["cambiado"].day == 2 and rows[3]["activo"] is False and rows[3]["retiro"].day == 2 and rows[1]["cambiado"].day == 1
    assert t.merge(src(second), ["k"], ["v"], now(3), "retire", **stamps) == {"keep": 5}
    assert [h["version"] for h in t.history()] == [0, 1] and t.history()[1]["metrics"]["update"] == 1 and t.read(0).count() == 3
    assert t.merge(src([(3, "c")]), ["k"], ["v"], now(4), "delete", **stamps)["delete"] == 4
    assert [(r["k"], r["activo"]) for r in t.read().collect()] == [(3, False)]
    assert t.read().schema.simpleString() == frame(ddl).schema.simpleString()


def test_table_append_evolves_and_slices(spark, frame, tmp_path):
    t = merge.Table(spark, str(tmp_path / "s"))
    with pytest.raises(FileNotFoundError):
        t.read()
    t.append(frame("k int", [(1,)]))
    t.append(frame("k int, extra string", [(2, "x")]))
    t.replace_slice(frame("k int, extra string", [(3, "y")]), F.col("k") == 1)
    assert frame.rows(t.read()) == [(2, "x"), (3, "y")]


def test_surrogate_keys_are_dense_and_stable(frame):
    a = merge.surrogate_keys(frame("n string, x int", [(f"n{i}", 1) for i in range(50)]), frame("n string, key long"), ["n"], "key")
    b = dict(frame.rows(merge.surrogate_keys(frame("n string", [("zz",), (None,), ("n3",)]), a, ["n"], "key")))
    assert sorted(b.values()) == list(range(1, 53)) and all(b[n] == k for n, k in frame.rows(a))


def test_scd2_build(frame):
    rows = [("x", date(2024, 1, d), s) for d, s in ((1, "A"), (2, "a "), (3, "B"), (6, "A"), (7, None), (8, None))]
    got = [(r["numero_version"], r["s"], r["fecha_inicio"].day, str(r["fecha_fin"]), r["es_actual"]) for r in D.scd2(frame("e string, d date, s string", rows), "e", "d", ["s"]).orderBy("numero_version").collect()]
    assert got == [(1, "A", 1, "2024-01-02", False), (2, "B", 3, "2024-01-05", False), (3, "A", 6, "2024-01-06", False), (4, None, 7, "9999-12-31", True)]
    bad = D.scd2(frame("e string, d date, s string", rows), "e", "d", ["s"]).withColumn("fecha_fin", F.to_date(F.lit("2024-01-04")))
    inv = D.scd2_invariants(bad, "e").first()
    assert inv["traslape"] >= 1 and inv["rango_invalido"] == 2 and inv["fin_abierto"] == 1 and inv["actuales"] == 0


def test_calendar_and_periods(spark, frame):
    c = D.calendar(frame("a date, b date", [(date(2023, 5, 5), date(2024, 2, 2))]))
    assert c.count() == 365 + 366 + 365 + 365 and c.where("fecha = '2024-02-29'").first()["es_fin_mes"] and c.where("fecha = '2024-06-09'").first()["dia_semana_nombre"] == "Domingo"
    assert D.calendar(frame("a date, b date", [(None, None)])).count() == 0
    assert [r["etiqueta"] for r in D.periods(spark).where("periodo_key = 24").collect()] == ["23:00 - 00:00"]


def test_quality(frame):
    d = frame("k string, v double, ts timestamp", [("a", 1.0, datetime(2026, 1, 1)), ("a", -1.0, datetime(2026, 1, 1)), (" ", None, datetime(2026, 1, 4)), (None, 2.0, None)])
    p = quality.key_profile(d, ["k"], value="v").first()
    assert tuple(p) == (4, 2, 3, 1, 1)
    r = quality.evaluate(d, [quality.Rule("c", "neg", F.col("v") < 0, blocking=True), quality.Rule("c", "ok", F.lit(False))])
    assert [(x["rule_name"], x["error_count"], x["error_rate"], x["passed"]) for x in r.collect()] == [("neg", 1, 0.25, False), ("ok", 0, 0.0, True)]
    assert [x["rule_name"] for x in quality.blocked(r).collect()] == ["neg"]
    assert quality.evaluate(d.limit(0), [quality.Rule("c", "neg", F.col("v") < 0)]).first()["error_rate"] is None
    assert quality.hour_mask(d, "ts").count() <= 4 and quality.coverage_and_drift(d, "ts").first()["dias_incompletos"] == 4
    assert quality.freshness(d, "ts", F.to_date(F.lit("2026-01-10"))).first()["dias_rezago"] == 6
    s = {x["slo_id"]: x["cumple"] for x in quality.slo(frame("slo_id string, valor double, operador string, umbral double", [("a", 1.0, "<=", 1.0), ("b", None, "<=", 1.0), ("c", 2.0, "==", 2.0), ("d", 1.0, ">=", 2.0)])).collect()}
    assert s == {"a": True, "b": False, "c": True, "d": False}
    with pytest.raises(Exception, match="unknown operator"):
        quality.slo(frame("slo_id string, valor double, operador string, umbral double", [("a", 1.0, "!", 1.0)])).collect()


def test_alerts_rerun_adds_nothing(frame):
    al = frame("alert_id string, rule_id string, run_id string, status string, created_at timestamp, resolved_at timestamp", [("x", "r1", "old", "OPEN", datetime(2026, 1, 1), None), ("y", "r2", "old", "OPEN", datetime(2026, 1, 1), None)])
    res = frame("rule_id string, passed boolean, is_blocking boolean", [("r1", True, True), ("r2", False, True), ("r3", False, False)])
    once = quality.open_alerts(al, res, "run", F.lit("2026-01-02").cast("timestamp"))
    assert once.groupBy("status").count().orderBy("status").collect()[0]["count"] == 2 and once.where("rule_id = 'r3'").count() == 0
    assert frame.rows(quality.open_alerts(once, res, "run", F.lit("2026-01-02").cast("timestamp"))) == frame.rows(once)


def test_fingerprint_ignores_order_and_sees_changes(frame):
    d = frame("k int, m double", [(i, i / 7) for i in range(100)])
    f = lambda x: tuple(quality.fingerprint(x, "k", "m").first())
    assert f(d) == f(d.orderBy(F.desc("k")).repartition(3)) != f(d.withColumn("m", F.when(F.col("k") == 5, 0.0).otherwise(F.col("m"))))


def test_exploration(frame):
    d = frame("a string, b int", [("x", 1), (" ", 1), (None, None), ("7", 2)])
    assert {r["columna"]: (r["filas"], r["nulos"], r["vacios"], r["distintos"]) for r in X.completeness(d).collect()} == {"a": (4, 1, 1, 3), "b": (4, 1, 0, 2)}
    assert X.invalid_numbers(d, ["a"]).first()["a"] == 1
    assert X.duplicates(d, ["b"], "a").first()["en_conflicto"] == 1
    s = X.scorecard(frame("metrica string, valor double", [("m", 0.5), ("z", 1.0)]), [("m", 0.1, 0.4)])
    assert {r["metrica"]: r["severidad"] for r in s.collect()} == {"m": "ALTA", "z": "SIN REGLA"}


def test_measures(frame):
    d = frame("g string, e int, d date, v double, c double", [("a", 1, date(2024, 1, 1), 1.0, 5.0), ("a", 1, date(2024, 1, 2), 3.0, 5.0), ("a", 2, date(2024, 1, 2), 5.0, 7.0), ("b", 3, date(2024, 1, 1), 2.0, 0.0)])
    assert dict(frame.rows(M.max_then_sum(d, ["g"], "e", "c", "x"))) == {"a": 12.0, "b": 0.0}
    assert dict(frame.rows(M.sum_then_avg(d, ["g"], "d", "v", "x"))) == {"a": 4.5, "b": 2.0}
    assert {r["g"]: r["v"] for r in M.at_latest(d, ["g"], "d", ["v"]).collect()} == {"a": 8.0, "b": 2.0}
    assert [r["g"] for r in M.capacity_factor(d, ["g"], "v", "c").collect()] == ["a"]


def test_views_readable(frame):
    d = frame("a int", [(1,)])
    assert V.readable({"x": d, "y": d.limit(0)}, True) == {"x": True, "y": False} and V.readable({"y": d.limit(0)}, False) == {"y": True}


# --- sources ---


def test_chunks_and_windows(spark):
    c = L.chunks(date(2025, 11, 20), date(2026, 1, 15), 24)
    assert c == [(date(2025, 11, 20), date(2025, 12, 13)), (date(2025, 12, 14), date(2026, 1, 6)), (date(2026, 1, 7), date(2026, 1, 15))]
    assert [tuple(r) for r in L.chunk_frame(spark, date(2025, 11, 20), date(2026, 1, 15), 24).collect()] == c and L.chunks(date(2024, 1, 2), date(2024, 1, 1), 5) == []
    for days in (0, 367):
        with pytest.raises(ValueError):
            L.chunks(date(2024, 1, 1), date(2024, 1, 2), days)
    dflt, today = (date(2024, 1, 1), date(2024, 1, 9)), date(2024, 5, 1)
    window = lambda *a, **kw: L.resolve_window(*a, dflt, today=today, **kw)
    assert window("", "", "") == (*dflt, "INCREMENTAL") == window("auto", "2024-02-01", "2024-02-03") == window(None, None, None)
    assert window(" backfill", "2024-02-01", "2024-02-03") == (date(2024, 2, 1), date(2024, 2, 3), "BACKFILL") == window("AUTO", "2024-02-01", "2024-02-03", default_mode="BACKFILL")
    assert window("AUTO", "", "", default_mode="BACKFILL") == (*dflt, "BACKFILL")
    for bad in (("BACKFILL", "", ""), ("BACKFILL", "2024-02-01", ""), ("BACKFILL", "2024-02-03", "2024-02-01"), ("BACKFILL", "2024-02-03", "2024-06-01"), ("x", "", "")):
        with pytest.raises(ValueError):
            window(*bad)
    assert L.covered(dflt, (date(2024, 1, 1), date(2024, 1, 7)), 2) and not L.covered(dflt, (date(2024, 1, 2), date(2024, 1, 9)), 2) and not L.covered(dflt, (None, None), 2)


class HttpError(Exception):
    def __init__(self, status):
        self.response = type("R", (), {"status_code": status})()


def test_retry():
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise HttpError(502)
        return "ok"

    assert L.retry(flaky, base=2, sleep=waits.append, jitter=lambda: 0) == "ok" and waits == [2, 4]
    with pytest.raises(HttpError):
        L.retry(lambda: (_ for _ in ()).throw(HttpError(404)), sleep=waits.append)
    assert len(waits) == 2


def test_range_source(spark):
    def fetch(a, b):
        yield from ((a + timedelta(i), float(i)) for i in range((b - a).days + 1))

    spark.dataSource.register(L.range_source("kv_range", "dia date, valor double", fetch))
    df = spark.read.format("kv_range").option("start", "2024-01-01").option("end", "2024-03-05").option("days", "31").load()
    assert df.count() == 65 and df.rdd.getNumPartitions() == 3


def test_landing(spark, frame, tmp_path):
    d = frame("FechaHora timestamp, Valor string", [(datetime(2026, 1, 1), "1,5"), (datetime(2026, 1, 2), None)])
    path = str(tmp_path / "x")
    assert L.publish_json(d, path) == 2 and L.publish_json(d.limit(1), path) == 1
    back = L.lineage(L.read_json(spark, L.published(spark, path), "FechaHora timestamp, Valor string"))
    assert back.count() == 1 and back.first()["source_file_name"].endswith(".json.gz")
    assert L.renamed(back, {"Valor": "valor", "Nada": "nada"}).first().asDict() == {"valor": "1,5", "nada": None}
    assert L.guard(d, "FechaHora")["rows"] == 2
    for kw in ({"not_before": date(2027, 1, 1)}, {"today": date(2027, 1, 1), "max_lag": 5}):
        with pytest.raises(ValueError):
            L.guard(d, "FechaHora", **kw)
    with pytest.raises(ValueError):
        L.guard(d.limit(0), "FechaHora")
    with pytest.raises(ValueError):
        L.require(d, ["nope"])
    assert L.evolve(d, {"extra": "int"}).columns[-1] == "extra" and L.schema_differences(d, {"Valor": "double", "z": "int"}) == {"Valor": ("string", "double"), "z": (None, "int")}
    assert L.first_column(d, ["a", "Valor"], "v") == "Valor" and L.since_high_water(d, d, "FechaHora").count() == 1 and L.since_high_water(d, None, "FechaHora").count() == 2


def test_coordinates_precedence(frame):
    c = "k string, latitud double, longitud double"
    r = L.resolve_coordinates(frame("k string", [("a",), ("b",), ("c",), ("d",)]), ["k"], frame(c, [("a", 1.0, 1.0), ("b", 2.0, 2.0)]), frame(c, [("b", 9.0, 9.0), ("c", 3.0, 3.0)]), frame(c, [("a", 5.0, 5.0)]))
    assert {x["k"]: (x["latitud"], x["fuente_coordenada"]) for x in r.collect()} == {"a": (5.0, "OVERRIDE"), "b": (2.0, "GEOCODER"), "c": (3.0, "MANUAL"), "d": (None, "FALTANTE")}


# --- registry and plans ---


def test_every_oracle_has_a_query_and_plans_have_no_nested_loops(spark):
    import __spark_entry__ as e

    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) > 90
    for n in ("tx_version_select", "temporal_scd2_join", "or_join_rewrite", "anti_nullsafe_new_rows", "validity_join", "p2_found", "p3_found"):
        p = plan_of(q[n](spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, n


def test_scan_is_pruned_and_filtered(spark):
    import __spark_entry__ as e

    p = plan_of(e.queries()["scan_filter_project"](spark, "/root/testdata/sf0.001"))
    assert "PushedFilters: [IsNotNull(value), IsNotNull(event_type), GreaterThan(value,10.0)" in p and "props" not in p


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0


def test_policy_numbers_have_no_digit_limit(frame):
    d = frame("v string", [("TX9999999",), ("tx12 ",), ("TXF",), ("TX" + "9" * 60,), ("TX",), ("ABC",), (None,)])
    got = {r["v"]: r["p"] for r in d.select("v", versioning.priority("v").alias("p")).collect()}
    assert got == {"TX9999999": 999999900, "tx12 ": 1200, "TXF": 10000, "TX" + "9" * 60: 10**17, "TX": 0, "ABC": 0, None: 0}
    ddl = "version_pattern string, priority int, multiplier int, activo boolean"
    rows = [("TXF", 10, None, True), ("TXR", 9, None, True), ("TX_NUMERIC", None, 1, True)]
    assert versioning.load_policy(frame(ddl, rows)) == {"TXF": 10, "TXR": 9, "TX_NUMERIC": 1}
    for bad in (rows[:2], [*rows, rows[0]], [*rows, ("OTRA", 1, None, True)], [*rows[:2], ("TX_NUMERIC", None, None, True)]):
        with pytest.raises(ValueError):
            versioning.load_policy(frame(ddl, bad))


def test_two_writers_of_one_version(spark, frame, tmp_path):
    t, u = (merge.Table(spark, str(tmp_path / "t")) for _ in range(2))
    t.append(frame("k int", [(1,)]))
    stale = u.history()
    u.history = lambda: stale  # the second writer has read the log before the first one commits
    t.append(frame("k int", [(2,)]))
    with pytest.raises(RuntimeError):
        u.write(frame("k int", [(9,)]), "APPEND")
    assert frame.rows(t.read()) == [(1,), (2,)] and frame.rows(t.read(0)) == [(1,)]


def test_a_reader_streams_and_goes_on_after_an_error(monkeypatch):
    monkeypatch.setattr(L.time, "sleep", lambda s: None)
    tries = []

    def fetch(a, b):
        tries.append(a)
        for k in range(5):
            if k == 3 and len(tries) == 1:
                raise ConnectionError
            yield (k,)

    r = L.RangeReader({"start": "2024-01-01", "end": "2024-01-02", "days": "2"}, None, fetch)
    assert [x for (x,) in r.read(r.partitions()[0])] == [0, 1, 2, 3, 4] and len(tries) == 2


def test_gate_invariants_and_quarantine_on_nothing(frame):
    agents = frame("codigo_agente string, fecha_inicio date, fecha_fin date, es_actual boolean")
    plants = frame("es_registro_inferido boolean, esta_en_maestro_actual boolean, fecha_primera_observacion date, fecha_ultima_observacion date", [(True, True, None, None), (True, False, date(2024, 1, 2), date(2024, 1, 1)), (None, None, None, None)])
    bridge = frame("planta_key long, embalse_key long, activo boolean, requiere_revision_manual boolean, valido_desde date, valido_hasta date", [(1, 1, True, False, None, None), (1, None, True, False, None, None), (1, 1, True, False, date(2024, 2, 1), date(2024, 1, 1)), (None, None, False, True, None, None)])
    aliases = frame("entity_type string, alias_normalized string, status string", [("E", "a", "APPROVED"), ("E", "a", "APPROVED"), ("E", "b", "APPROVED"), ("E", "b", "PROPOSED")])
    got = dict(frame.rows(governance.gate(aliases, agents, plants, bridge)))
    assert got == {"alias_duplicados": 1, "solapamientos_scd2": 0, "sin_version_actual_unica": 0, "inferidos_oficiales": 1, "relaciones_invalidas": 2}
    assert tuple(governance.plant_invariants(plants).first()) == (3, 1, 1, 1)
    rules = [quality.Rule("t", "neg", F.col("v") < 0, blocking=True)]
    ok, bad = audit.quarantine(frame("v int, reglas string", [(1, "x"), (-1, "x"), (None, "x")]), rules, "r", ["v"])
    assert frame.rows(ok) == [(1, "x"), (None, "x")] and frame.rows(bad) == [(-1, "neg", "r")]


def test_loader_gate_and_flags(frame):
    spec = loaders.Load(["k"], ["k"], payload=["v"], tie="registro_id")
    ddl = "registro_id long, k string, v string, source_file_name string, source_file_path string, ingestion_timestamp timestamp, load_date date, silver_created_at timestamp, silver_updated_at timestamp"
    row = lambda i, k, v, h: (i, k, v, "f", None, datetime(2026, 1, 1, h), date(2026, 1, 1), None, None)
    d = frame(ddl, [row(1, " a", "x", 1), row(2, "A ", "y", 2), row(3, "b", "z", 0)])
    ref = frame("c string", [("a",), (None,)])
    shape = d.select("k", "v", "source_file_name", "source_file_path", "ingestion_timestamp", "load_date", "silver_created_at", "silver_updated_at").withColumn("hay", F.lit(True)).limit(0)
    new, counts = loaders.load(d, shape, spec, F.lit("2026-02-01").cast("timestamp"), {"hay": (ref, "c", "k")})
    assert sorted((r["k"], r["v"], r["hay"]) for r in new.collect()) == [("A", "y", True), ("B", "z", False)] and frame.rows(counts) == [("insert", 2)]
    with pytest.raises(ValueError):
        loaders.incoming(frame(ddl, [row(1, " ", "x", 1)]), None, spec)
    assert loaders.incoming(frame(ddl), None, spec).count() == 0


def test_a_merge_by_the_tables_keys_touches_only_their_parts(spark, frame, tmp_path):
    t = merge.Table(spark, str(tmp_path / "t"), ["k"], buckets=16)
    now = F.lit("2026-01-01").cast("timestamp")
    t.merge(frame("k int, v int", [(i, i) for i in range(200)] + [(None, -1)]), ["k"], ["v"], now)
    first = t.history()[-1]["parts"]
    counts = t.merge(frame("k int, v int", [(3, 30), (500, 5), (None, -2)]), ["k"], ["v"], now)
    parts = t.history()[-1]["parts"]
    assert counts["update"] == 2 and counts["insert"] == 1 and sum(first[k] != parts[k] for k in first) <= 3
    want = sorted([*((i, 30 if i == 3 else i) for i in range(200)), (500, 5), (None, -2)], key=str)
    assert frame.rows(t.read()) == want and t.history()[-1]["rows"] == 202 and t.read(0).where("k = 3").first()["v"] == 3
    assert set(t.merge(frame("k int, v int", [(3, 30)]), ["k"], ["v"], now)) == {"keep"} and len(t.history()) == 2
    assert t.merge(frame("k int, v int", [(3, 31)]), ["k"], ["v"], now, missing="delete")["delete"] == 201 and frame.rows(t.read()) == [(3, 31)]
    assert t.merge(frame("k int, v int"), ["k"], ["v"], now) == {} and t.read().count() == 1
