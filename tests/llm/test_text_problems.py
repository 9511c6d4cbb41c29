"""Edge cases of the training-text operators: NULLs, ties, repeated rows, empty tables, clashing columns, brute force, held-out
accuracy."""

import math
import random
import re
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kilovela.llm import canonical, leakage, mixing, stuffing, survivors

# --- 5 survivors ---

GEN = "registro_id long, k string, version string, valor double, ingestion_timestamp timestamp, flag boolean, v long, mask long"


def order(r):
    v = (r[2] or "").strip().upper()
    n = int(v[2:]) if re.fullmatch(r"TX[0-9]{1,15}", v) else -1
    rank = 4e15 if v == "TXF" else 3e15 if v == "TXR" else n
    return (r[3] is not None and r[3] == r[3], rank, r[4] or datetime.min, r[0])


def gen_rows(seed, n=400):
    rnd = random.Random(seed)
    return [(i, rnd.choice(["a", " A", "b", "hot", "hot", "hot", None]) if rnd.random() < 0.5 else f"k{rnd.randint(0, 60)}", rnd.choice(["TX1", " tx2", "TX10", "TXR", "txf ", "ABC", None, "TX", "TX70", "TX65"]), rnd.choice([None, 1.0, 2.0, 2.0, float("nan")]),
             None if rnd.random() < 0.1 else datetime(2026, 1, 1) + timedelta(hours=rnd.randint(0, 3)), rnd.choice([True, True, False, None]), 1, 2) for i in range(n)]


def test_survivor_follows_the_precedence(frame):
    rows = gen_rows(3)
    got = {(r["grupo_id"], r["registro_id"], r["filas"]) for r in survivors.by_order(frame(GEN, rows), ["k"], "valor", "version", "ingestion_timestamp", "registro_id").collect()}
    by = defaultdict(list)
    for r in rows:
        by[None if r[1] is None else r[1].strip().upper()].append(r)
    assert got == {(min(r[0] for r in g), max(g, key=order)[0], len(g)) for g in by.values()}


def test_votes_find_the_reliable_source(frame):
    rows, i = [], 0
    for k in range(60):
        truth = float(k)
        for v, ok in (("TXF", True), ("TXR", True), ("TX1", k % 10 == 0), ("TX2", k % 9 == 0)):
            i += 1
            rows.append((i, f"k{k}", v, truth if ok else -truth - 1 - (1 if v == "TX2" and k % 2 else 0), None, True, 1, 2))
    w = weights(frame(GEN, rows))
    assert min(w[TXF], w[TXR]) > max(w[1], w[2])
    got = survivors.survivors(frame(GEN, rows), ["k"], {"valor": False}, "version", "ingestion_timestamp", "registro_id").collect()
    assert sum(r["valor"] == float((r["grupo_id"] - 1) // 4) for r in got) == 60


def truth(rows, rounds=20):
    """Brute force: weights per source, and the surviving value per group."""
    last, n = {}, defaultdict(lambda: 0)
    for r in rows:
        g = None if r[1] is None else r[1].strip().upper()
        n[g] += 1
        if r[3] is not None and r[3] == r[3]:
            src, key = order(r)[1], (r[4] or datetime.min, r[0])
            if (g, src) not in last or key > last[g, src][0]:
                last[g, src] = key, r[3]
    w = {s: 1.0 for _, s in last}
    for _ in range(rounds):
        won, tally = {}, defaultdict(lambda: [0, 0])
        for g in {g for g, _ in last}:
            votes = defaultdict(lambda: [0.0, -2])
            for (gg, s), (_, v) in last.items():
                if gg == g:
                    votes[v] = [votes[v][0] + w[s], max(votes[v][1], s)]
            won[g] = max(votes, key=lambda v: (round(votes[v][0], 9), votes[v][1]))  # noqa: B023
        for (g, s), (_, v) in last.items():
            tally[s][0] += v != won[g]
            tally[s][1] += 1
        w = {s: -math.log((a + 1) / (b + 2)) for s, (a, b) in tally.items()}
    return w, {g: won.get(g) for g in n}


def weights(df, fields=("valor",)):
    s = survivors.said(survivors.claims(df, ["k"], list(fields), "version", "ingestion_timestamp", "registro_id"), list(range(len(fields))))
    return {r["source"]: r["w"] for r in survivors.discover(s).where("f = 0").collect()}


TXF, TXR = 4 * 10**15, 3 * 10**15


@pytest.mark.parametrize("seed", [3, 11])
def test_votes_and_weights_equal_brute_force(frame, seed):
    rows = gen_rows(seed, 300)
    w, won = truth(rows)
    got = weights(frame(GEN, rows))
    assert got == pytest.approx(w)
    keys = {min(r[0] for r in rows if (None if r[1] is None else r[1].strip().upper()) == g): v for g, v in won.items()}
    assert {r["grupo_id"]: r["valor"] for r in survivors.survivors(frame(GEN, rows), ["k"], {"valor": False}, "version", "ingestion_timestamp", "registro_id").collect()} == keys


def test_survivors_of_several_fields_and_of_nothing(frame):
    one = survivors.survivors(frame(GEN, gen_rows(5)), ["k"], {"valor": True, "flag": False}, "version", "ingestion_timestamp", "registro_id")
    assert one.count() == len({None if r[1] is None else r[1].strip().upper() for r in gen_rows(5)})
    assert survivors.by_order(frame(GEN), ["k"], "valor", "version", "ingestion_timestamp", "registro_id").count() == 0
    assert survivors.survivors(frame(GEN), ["k"], {"valor": False}, "version", "ingestion_timestamp", "registro_id").count() == 0
    rows = [(1, "a", "TX1", None, None, None, 1, 1), (2, "a", "TX2", float("nan"), None, None, 1, 1)]
    r = survivors.by_order(frame(GEN, rows), ["k"], "valor", "version", "ingestion_timestamp", "registro_id").first()
    assert (r["grupo_id"], r["registro_id"], r["filas"], r["valor"]) == (1, 2, 2, None)


def test_source_weights_count_unanimous_groups(frame):
    ddl = "registro_id long, k string, version string, valor double, ingestion_timestamp timestamp"
    rows = [(2 * k + i, f"k{k}", v, 1.0, None) for k in range(98) for i, v in enumerate(("TX1", "TX2"))]
    rows += [(900, "x", "TXF", 5.0, None), (901, "x", "TXR", 5.0, None), (902, "x", "TX1", 6.0, None)]
    rows += [(1000 + 2 * k + i, f"y{k}", v, 1.0, None) for k in range(50) for i, v in enumerate(("TXF", "TXR"))]
    w = weights(frame(ddl, rows))
    # TX1 loses 1 of 99 groups, TX2 none of 98, TXF and TXR none of 51
    want = {1: 2 / 101, 2: 1 / 100, TXF: 1 / 53, TXR: 1 / 53}
    assert w == pytest.approx({s: -math.log(e) for s, e in want.items()})


def test_votes_decide_under_an_order_too(frame, monkeypatch):
    """The survivors under a declared order are those of votes with estimated weights: without the order's constraint on the weights
    two sources outvote a more trusted one."""
    rows = [(1, "a", "TX1", 1.0, None, True, 1, 2), (2, "a", "TX2", 1.0, None, True, 1, 2), (3, "a", "TXF", 2.0, None, True, 1, 2)]
    by_order = lambda: survivors.by_order(frame(GEN, rows), ["k"], "valor", "version", "ingestion_timestamp", "registro_id").first()["registro_id"]
    assert by_order() == 3
    monkeypatch.setattr(survivors, "ranked", lambda w, ordered=(): w.selectExpr("f", "source", "w", "0 AS band"), raising=False)
    assert by_order() == 2


def test_weights_under_an_order(frame):
    """TX1 loses 1 of 2 groups, TX2 1 of 1, TXF none of 1; with two fields the one without an order keeps its own weights."""
    rows = [(1, "a", "TX1", 1.0, None, True, 1, 2), (2, "a", "TX2", 1.0, None, True, 1, 2), (3, "a", "TXF", 2.0, None, False, 1, 2), (4, "b", "TX1", 1.0, None, None, 1, 2)]
    s = survivors.said(survivors.claims(frame(GEN, rows), ["k"], ["valor", "flag"], "version", "ingestion_timestamp", "registro_id"), [0, 1])
    w = survivors.discover(s, ordered=[0])
    got = {(r["f"], r["source"]): r["w"] for r in w.collect()}
    ln = lambda lost, n: -math.log((lost + 1) / (n + 2))
    assert got == pytest.approx({(0, 1): ln(1, 2), (0, 2): ln(1, 1), (0, TXF): ln(0, 1), (1, 1): ln(0, 1), (1, 2): ln(0, 1), (1, TXF): ln(1, 1)})
    top = max(ln(1, 2), ln(1, 1))
    ranked = {(r["f"], r["source"]): (r["w"], r["band"]) for r in survivors.ranked(w, [0]).collect()}
    assert [ranked[0, k][0] for k in (1, 2, TXF)] == pytest.approx([ln(1, 2), 3 * top, 9 * ln(0, 1)]) and ranked[1, TXF][0] == pytest.approx(ln(1, 1))


def test_an_order_of_very_many_sources(frame):
    """Each source outweighs all below it together, be they a thousand."""
    rnd, rows = random.Random(8), []
    for g in range(12):
        some = rnd.sample(range(1, 1200), 1100 if g < 4 else rnd.randint(1, 40))
        top = max(some)
        rows += [(len(rows) + i, f"k{g}", f"TX{v}", 1.0 if v == top else 2.0, None, True, 1, 2) for i, v in enumerate(some)]
    got = {r["grupo_id"]: (r["registro_id"], r["valor"]) for r in survivors.by_order(frame(GEN, rows), ["k"], "valor", "version", "ingestion_timestamp", "registro_id").collect()}
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    assert got == {min(r[0] for r in g): (max(g, key=order)[0], 1.0) for g in by.values()}


# --- 7 canonical ---

REF = "codigo string, nombre string, valor string"
NAMES = [("R1", "EL ZUNQUEXTIQUE I", "x"), ("R2", "EL ZUNQUEXTIQUE II", "x"), ("R3", "EL ZUNQUEXTIQUE III", "x"), ("R4", "PEÑOMZIQUE", "x"), ("R5", "RÍO CLONGERZÓN", "x"), ("R6", "GUEMZACÁ", "x"), ("R7", "SAN CIEVAL I", "x"), ("R8", "LA TIDROLMA", "x")]
TYPED = [("Represa el zunquextique iii", "R3"), ("ZUNQUEXTIQUE II, EL", "R2"), ("EL ZUNQUEXTIQUE No. 1", "R1"), ("EL  ZUNQUEXTIQUE2", "R2"), ("PEÃ\x91OMZIQUE", "R4"), ("penomzique (rev.)", "R4"), ("Río Clongerzo", "R5"), ("GUEMZA...", "R6"), ("GUEMAZCA", "R6"), ("CIEVAL I, SAN - antiguo", "R7"), ("EMBALSE DE 1A TIDR0LMA *", "R8"), ("no aplica", canonical.UNKNOWN), ("???", canonical.UNKNOWN), ("MORTRUNCLAL", canonical.UNKNOWN), ("EL ZUNQUEXTIQUE IV", canonical.UNKNOWN), ("LA TIDROLMA", None), ("  ", None), (None, None)]


def test_mapping(frame):
    rows = [(i, v, "c", 1) for i, (v, _) in enumerate(TYPED)] * 2
    got = sorted((r["id"], r["codigo"]) for r in canonical.map_values(frame("id long, t string, codigo string, parecido int", rows), "id", "t", frame(REF, NAMES), "codigo", "nombre").collect())
    assert got == sorted(2 * [(i, c) for i, (_, c) in enumerate(TYPED) if c])


def test_mapping_of_empty_tables(frame):
    typed = frame("id long, t string", [(1, "GUEMZACÁ")])
    assert [tuple(r) for r in canonical.map_values(typed, "id", "t", frame(REF), "codigo", "nombre").select("id", "codigo").collect()] == [(1, canonical.UNKNOWN)]
    assert canonical.map_values(frame("id long, t string"), "id", "t", frame(REF, NAMES), "codigo", "nombre").count() == 0


def index(names):
    return canonical.Index([(c, n) for c, n in names], canonical.weights_of([n for _, n in names]))


def test_cosines_of_the_inverted_index_match_brute_force():
    ix = index([(c, n) for c, n, _ in NAMES])
    q = canonical.normal("GUEMXACA")
    a = ix.weights.vector(q.words)
    for v, n in zip(ix.cosines(q), ix.names, strict=True):
        b = ix.weights.vector(n.words)
        assert v == pytest.approx(sum(x * b.get(g, 0.0) for g, x in a.items()) if n.numeral == 0 else 0.0)


def made_up(n, seed):
    rnd = random.Random(seed)
    parts = [a + b + c for a in "B BR C CH D F G GR L LL M N P PL QU R S T TR V Z".split() for b in "AEIOU" for c in ("", "N", "L", "R", "S", "X", "M")]
    names = sorted({rnd.choice(["", "LA ", "EL ", "SAN ", "RÍO "]) + "".join(rnd.choice(parts) for _ in range(rnd.choice([3, 3, 4]))) for _ in range(n)})
    return [(f"c{i:05d}", x) for i, x in enumerate(names)]


def typed_wrong(name, rnd):
    """The name with one or two typing errors, or in another usual dress."""
    def typo(x):
        k = rnd.randrange(1, len(x) - 1)
        c = rnd.choice("AEIORSTLN")
        return rnd.choice([x[:k] + x[k + 1 :], x[:k] + c + x[k:], x[:k] + c + x[k + 1 :], x[:k] + x[k + 1] + x[k] + x[k + 2 :]])

    first, *rest = name.split(" ")
    x = rnd.choice([
        lambda: typo(name), lambda: typo(typo(name)) if len(name) > 9 else typo(name), lambda: f"Embalse de {name.title()}", lambda: f"emb {typo(name)}", lambda: name.lower().encode().decode("latin-1"), lambda: f"  {name.replace(' ', '   ')} *",
        lambda: f"{name} (rev.)", lambda: f"{name} - antiguo", lambda: f"{' '.join(rest)}, {first}" if rest else name.lower(), lambda: name.replace("O", "0").replace("S", "5"),
    ])()
    return x if x != name else name.lower()


def test_labelled_values(frame):
    """Recall and precision of names typed wrong and of unknown names, in one block and in several."""
    rnd, names = random.Random(2), made_up(600, 1)
    known, unknown = names[::2] + names[1::4], names[3::4]
    rows, truth = [], {}
    for i in range(1500):
        code, name = rnd.choice(known if rnd.random() < 0.9 else unknown)
        truth[i] = code if code in {c for c, _ in known} else canonical.UNKNOWN
        rows.append((i, typed_wrong(name, rnd)))
    typed, ref = frame("id long, t string", rows), frame("codigo string, nombre string", known)
    one = {r["id"]: r["codigo"] for r in canonical.map_values(typed, "id", "t", ref, "codigo", "nombre").collect()}
    found = [i for i, c in one.items() if c != canonical.UNKNOWN]
    there = [i for i in one if truth[i] != canonical.UNKNOWN]
    assert len(one) == 1500 and sum(one[i] == truth[i] for i in there) >= 0.98 * len(there) and sum(one[i] == truth[i] for i in found) >= 0.99 * len(found)
    several = canonical.map_values(typed, "id", "t", ref, "codigo", "nombre", block=100)
    assert sum(one[r["id"]] == r["codigo"] for r in several.collect()) >= 0.99 * len(one)
    by = dict(canonical.map_values(typed, "id", "t", ref, "codigo", "nombre").groupBy("via").count().collect())
    assert by["coseno"] > 3 * by["edicion"]


def test_words_that_go_with_many_entries_are_learnt(frame):
    rnd, names = random.Random(3), made_up(200, 5)
    rows = [(i, f"ZXWKJ {n}") for i, (_, n) in enumerate(names)] + [(1000 + i, f"ZXWJK {n}") for i, (_, n) in enumerate(rnd.sample(names, 40))]
    got = canonical.map_values(frame("id long, t string", rows), "id", "t", frame("codigo string, nombre string", names), "codigo", "nombre").collect()
    assert {r["codigo"] for r in got if r["id"] < 1000} == {c for c, _ in names} and min(r["parecido"] for r in got) > 0.9


def match(ix, value):
    accept = canonical.threshold(ix)
    return canonical.decide(ix.candidates(value, accept), accept, ix.margin)[0]


def test_the_exact_check_equals_brute_force_over_all_candidates():
    rnd, names = random.Random(4), made_up(400, 6)
    ix = index(names)
    for _ in range(150):
        q = canonical.normal(typed_wrong(typed_wrong(rnd.choice(names)[1], rnd), rnd))
        score, core = ix.cosines(q), ix.weights.core(q.words)
        want = {}
        for i in ((ix._bound(q, score) if q.cut else score) >= ix.low).nonzero()[0].tolist():
            bonus = 0.08 * bool(ix.weights.light(q.words) & ix.lights[i]) + 0.05 * (q.numeral > 0)
            s = 1 - canonical.edits(core, ix.cores[i]) / max(len(core), len(ix.cores[i])) + bonus
            if q.cut and (begun := 1 - canonical.prefix_edits(core, ix.cores[i]) / len(core)) >= ix.begun:
                s = max(s, begun)
            want[i] = s
        best = max(want.values(), default=0.0)
        got = ix.alike(q, score)
        assert (got[0][0] if got else 0.0) == pytest.approx(best if best >= ix.similar and len(core) >= 3 else 0.0)
        if got:
            ties = {ix.keys[i] for i, s in want.items() if s > best - 1e-9}
            assert (len(got) > 1 and got[1][0] > best - 1e-9) == (len(ties) > 1)


def near_names(n, twins):
    """``n`` made-up names in order of their codes; of each two places of ``twins`` the second has the first's name but for one letter."""
    rnd = random.Random(9)
    out = [(f"c{i:05d}", "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(12))) for i in range(n)]
    for a, b in zip(twins[::2], twins[1::2], strict=True):
        out[b] = out[b][0], out[a][1][:-1] + ("A" if out[a][1][-1] != "A" else "B")
    return out


def test_the_threshold_is_learnt_from_all_names():
    """Twenty names that have a near twin, among 2,100, wherever they stand in the list."""
    for first in (0, 1):
        assert canonical.threshold(index(near_names(2100, list(range(first, 1000, 50))))) > 0.7


def test_the_threshold_of_several_blocks_is_that_of_one(frame):
    """Near twins in different blocks show in the threshold as in one."""
    names = near_names(260, [10, 110, 20, 220, 130, 230, 40, 240])
    one = index(names)
    blocks = [canonical.Index(names[i : i + 100], one.weights) for i in range(0, 260, 100)]
    ref = frame("codigo string, nombre string", names)
    send = ref.sparkSession.sparkContext.broadcast
    want = canonical.threshold(one)
    assert want > 0.7 > max(canonical.threshold(b) for b in blocks)
    assert canonical.threshold_of(ref, [send(b) for b in blocks]) == pytest.approx(want, abs=1e-12)
    assert canonical.threshold_of(ref, [send(one)]) == pytest.approx(want, abs=1e-12)
    assert canonical.threshold_of(ref.limit(0), [send(index([]))]) == 0.4


def test_ties_and_beginnings():
    decoys = [(f"d{a}{b}", f"FGHJKABCDE{a}{b}") for a in "LMNPQR" for b in "LMNPQR"] + [("near", "ABCLMNPQRSTWZ")]
    assert match(index([*decoys, ("right", "QBCDRFGHJS")]), "ABCDEFGHJK") == "right"
    # an equally similar entry makes it ambiguous
    assert match(index([*decoys, ("right", "QBCDRFGHJS"), ("other", "ZBCDTFGHJS")]), "ABCDEFGHJK") == canonical.UNKNOWN
    # the beginning of a cut name
    assert match(index([*decoys, ("right", "QBCDRFGHJKLMNPRSTWZLMNPRSTWZ")]), "ABCDEFGHJK.") == "right"


@given(st.text(alphabet="abcd", max_size=7), st.text(alphabet="abcd", max_size=7))
@settings(max_examples=60, deadline=None)
def test_edits_properties(a, b):
    assert canonical.edits(a, b) == canonical.edits(b, a) and (canonical.edits(a, b) == 0) == (a == b)
    assert canonical.prefix_edits(a, a + b) == 0


# --- 8 leakage ---


def brute_leaks(docs, items, least):
    grams = lambda t: {tuple(w[i : i + least]) for w in [leakage.words(t)] for i in range(len(w) - least + 1)}
    return sorted((d, i) for d, t in docs for i, x in items if grams(t) & grams(x))


def test_leaks_match_brute_force(frame):
    rnd = random.Random(6)
    word = lambda: rnd.choice(["uno", "dos", "tres", "ñu", "q5", "Él"])
    items = [(i, " ".join(word() for _ in range(rnd.randint(3, 40)))) for i in range(30)] + [(100, None), (101, ""), (102, "uno dos")]
    items.append((103, items[3][1]))
    docs = []
    for d in range(150):
        t = [word() for _ in range(rnd.randint(0, 60))]
        if d % 2:
            w = items[rnd.randint(0, 29)][1].split()
            a = rnd.randint(0, len(w))
            t[5:5] = w[a : a + rnd.randint(1, 20)]
        docs.append((d, rnd.choice([" ", "**, ", "\n"]).join(x.upper() if rnd.random() < 0.3 else x for x in t)))
    docs += [(900, None), (901, ""), (0, docs[1][1])]
    ddl = "doc_id long, text string, item_id long, texto string"
    got = leakage.leaks(frame(ddl, [(*d, 1, "x") for d in docs]), frame("item_id long, text string, doc_id long", [(*i, 1) for i in items]), least=6)
    assert sorted(map(tuple, got.collect())) == brute_leaks(docs, items, 6)


@given(st.lists(st.lists(st.sampled_from("abc"), max_size=14), max_size=5), st.lists(st.sampled_from("abcd"), max_size=40), st.integers(1, 5))
@settings(max_examples=200, deadline=None)
def test_automaton_against_brute_force(items, doc, least):
    a = leakage.Automaton(list(enumerate(items)), least)
    found, spans = a.scan(doc)
    g = lambda w: {tuple(w[i : i + least]) for i in range(len(w) - least + 1)}
    assert found == {i for i, w in enumerate(items) if g(w) & g(doc)}
    cover = {k for i in range(len(doc) - least + 1) if any(tuple(doc[i : i + least]) in g(w) for w in items) for k in range(i, i + least)}
    assert {k for x, y in spans for k in range(x, y)} == cover


def test_blocks_accents_and_long_text(frame):
    item = " ".join(f"palabra{i} número" for i in range(10))
    long = "relleno " * 200_000 + item.replace("número", "NÚMERO") + " fin" * 1000
    docs = frame("doc_id long, text string", [(1, long), (2, "nada"), (1, long)])
    items = frame("item_id long, text string", [(1, "otra cosa"), (2, item)])
    assert [tuple(r) for r in leakage.leaks(docs, items).collect()] == [(1, 2), (1, 2)]
    assert len(list(leakage.automata(items, "item_id", "text", 12, block=1))) > 5
    assert [tuple(r) for r in leakage.leaks(docs, items, block=13).collect()] == [(1, 2), (1, 2)]
    assert leakage.leaks(docs, frame("item_id long, text string")).count() == 0 and leakage.leaks(frame("doc_id long, text string"), items).count() == 0


@given(st.text(alphabet="aÁñ\u0301\u0300 ßİ.,Z_\n한é😀", max_size=40))
@settings(max_examples=300, deadline=None)
def test_placed_words_are_the_words(t):
    ws, at = leakage.placed(t)
    assert ws == leakage.words(t) and all(leakage.words(t[a:b]) == [w] for w, (a, b) in zip(ws, at, strict=True))


def test_scrub_is_the_same_in_any_blocks_and_equals_brute_force(frame):
    rnd = random.Random(12)
    word = lambda: rnd.choice(["uno", "dos", "ñandú", "n\u0303u", "Él", "cinco"])
    items = [(i, " ".join(word() for _ in range(rnd.randint(6, 25)))) for i in range(25)]
    docs = [(0, "\u0301 " + items[0][1] + " fin")]
    for d in range(1, 80):
        t = [word() for _ in range(rnd.randint(10, 60))]
        for _ in range(2):
            w = items[rnd.randrange(25)][1].split()
            t[5:5] = w[rnd.randint(0, 5) :]
        docs.append((d, rnd.choice([" ", ", ", " \u0301 "]).join(t)))
    df, it, want = frame("doc_id long, text string", docs), frame("item_id long, text string", items), {}
    grams = {tuple(w[i : i + 6]) for w in (leakage.words(t) for _, t in items) for i in range(len(w) - 5)}
    for d, t in docs:
        ws = leakage.words(t)
        gone = {k for i in range(len(ws) - 5) if tuple(ws[i : i + 6]) in grams for k in range(i, i + 6)}
        if gone:
            want[d] = (len(ws), len(gone), None if len(gone) > 0.8 * len(ws) else [w for k, w in enumerate(ws) if k not in gone])
    for block in (60, 20_000):
        got = leakage.scrub(df, it, least=6, max_share=0.8, block=block).collect()
        assert {r["doc_id"]: (r["palabras"], r["filtradas"], None if r["texto"] is None else leakage.words(r["texto"])) for r in got} == want
    assert len({tuple(sorted((r["doc_id"], r["texto"] or "") for r in leakage.scrub(df, it, least=6, block=b).collect())) for b in (60, 20_000)}) == 1


def test_scrub(frame):
    item = " ".join(f"w{i}" for i in range(30))
    r = leakage.scrub(frame("doc_id long, text string", [(1, "Antes. " + " ".join(f"w{i}" for i in range(13)) + ", después " + "x " * 30), (2, item), (3, "nada")]), frame("item_id long, text string", [(5, item)])).orderBy("doc_id").collect()
    assert [(x["doc_id"], x["filtradas"], x["descartado"]) for x in r] == [(1, 13, False), (2, 30, True)]
    assert r[0]["texto"].startswith("Antes. , después x") and r[1]["texto"] is None


# --- 9 mixing ---

DOC = "doc_id long, text string, source string, tokens long, p string"


def corpus(n=600):
    rnd = random.Random(8)
    vocab = {"a": ["sol", "luz", "panel"], "b": ["mar", "ola", "barco"], "c": ["tren", "via", "freno"]}
    out = []
    for i in range(n):
        s = rnd.choices("abc", [80, 15, 5])[0]
        t = " ".join(rnd.choice(vocab[s] + ["el", "de", "que"]) for _ in range(rnd.randint(5, 40)))
        out.append((i, t, None if i % 17 == 0 else s, 1, s))
    return out


def test_mixture_meets_targets_and_caps(frame):
    goals = frame("source string, target_share double, max_repeats int, doc_id long", [("a", 0.4, 1, 1), ("b", 0.4, 3, 1), ("c", 0.2, 4, 1)])
    rows = corpus() + [(9000, None, "a", 1, "a"), (9001, "", "b", 1, "b"), (9002, "sol", "otra", 1, "a")]
    m, g = mixing.mixture(frame(DOC, rows), goals)
    got = {r["source"]: r for r in mixing.shares(m, g).collect()}
    for s, share, cap in (("a", 0.4, 1), ("b", 0.4, 3), ("c", 0.2, 4)):
        assert got[s]["parte"] == pytest.approx(share, abs=0.02) and got[s]["parte_esperada"] == pytest.approx(share, abs=0.005) and got[s]["mas_copias"] <= cap
    assert m.where("copias > cap or tasa > cap or tasa < 0").count() == 0 and m.where("doc_id >= 9000 and doc_id < 9002").count() == 0
    assert m.where("doc_id = 9002").first()["copias"] == 0


def test_classifier_on_held_out_documents():
    rows = corpus(900)
    c = mixing.Classifier(["a", "b", "c"], [r[1] for r in rows[:600]], [r[4] for r in rows[:600]])
    hit = sum("abc"[int(c.posterior(r[1]).argmax())] == r[4] for r in rows[600:])
    assert hit > 0.9 * 300 and c.heat > 0


def test_the_classifier_does_not_depend_on_partitions(frame):
    df = frame(DOC, corpus(900))
    one, two = (mixing.fit_classifier(x, ["a", "b", "c"], "doc_id", "text", "source", 200) for x in (df.repartition(7), df.coalesce(1).orderBy("text")))
    assert (one.like == two.like).all() and one.heat == two.heat


def test_a_threads_labels_are_evidence(frame):
    rnd, rows, truth = random.Random(3), [], {}
    for k in range(300):  # texts say nothing; threads of four share their source, but for one document in twenty
        s = rnd.choices("abc", [70, 20, 10])[0]
        for i in range(4):
            own = s if rnd.random() > 0.05 else rnd.choice("abc")
            hide = i == 3 and k % 3 == 0
            truth[4 * k + i] = own
            rows.append((4 * k + i, "el de que", None if hide else own, 4 * k if i else None))
    rows.append((9999, "el de que", None, None))
    goals = frame("source string, target_share double, max_repeats int", [("a", 0.5, 2), ("b", 0.3, 3), ("c", 0.2, 4)])
    m, _ = mixing.mixture(frame("doc_id long, text string, source string, parent_id long", rows), goals, parent="parent_id")
    got = {r["doc_id"]: r["asignada"] for r in m.where("source is null").collect()}
    assert sum(got[i] == truth[i] for i in got if i != 9999) >= 0.9 * (len(got) - 1) and got[9999] == "a"


def test_mixture_with_an_absent_source_and_of_nothing(frame):
    goals = frame("source string, target_share double, max_repeats int", [("a", 0.5, 1), ("b", 0.3, 3), ("zz", 0.2, 4)])
    m, g = mixing.mixture(frame(DOC, corpus(300)), goals)
    got = {r["source"]: r["parte"] for r in mixing.shares(m, g).collect()}
    assert got["zz"] == 0 and got["a"] == pytest.approx(0.625, abs=0.03)
    m, g = mixing.mixture(frame(DOC), goals)
    assert m.count() == 0 and {r["parte"] for r in mixing.shares(m, g).collect()} == {0.0}


def test_tokens_round_trip():
    enc = mixing.tokenizer(f"{mixing.TOKENIZERS}/{mixing.VOCABULARY}")
    t = "¿Por qué 12.5 kWh?  Ñandú\n\tfin <|endoftext|>"
    assert enc.decode(enc.encode_ordinary(t)) == t and mixing.n_tokens([t, None, ""], f"{mixing.TOKENIZERS}/{mixing.VOCABULARY}") == [len(enc.encode_ordinary(t)), 0, 0]


# --- 10 stuffing ---

PROSE = "El lote de la mañana llegó con retraso y nadie quiso revisar el registro antes de comparar con el día anterior. Después medimos otra vez la curva y todo volvió a la normalidad sin previo aviso."
SPAM = [
    ", ".join(["panel solar barato", "crédito fácil", "luz gratis"] * 12), " | ".join(["batería litio oferta"] * 30), "batería litio oferta " * 30, " ".join(f"#{w}" for w in "sol luz panel oferta gratis barato litio hogar".split() * 4),
    "\n".join(f"https://a{i}.test/p?id={i}" for i in range(20)), " ".join(f'<a href="http://b.test/{i}">oferta {i}</a>' for i in range(20)), "\n".join(f"crédito para paneles Ciudad{chr(97 + i)}" for i in range(20)), "\n".join(f"- [tarifa barata](http://c.test/doc/{i}.html)" for i in range(15)),
]
FINE = [
    PROSE, PROSE + "\n\nVer https://a.test/q/1 y https://a.test/q/2 (error 404)", "```python\nfor i, x in enumerate(datos):\n    if x is None:\n        continue\n    y[i] = round(x * 2, 2)\n```", "\n".join(f"{h:02d}:00 | {h * 37} | {h * 1.5}" for h in range(24)),
    "\n".join(f"{k}. {PROSE.split('.')[0]} en el paso {k}." for k in range(1, 7)), "Ver https://a.test/doc/1.html (error 404)", "Gracias", "", None, "???",
]


def planted(n, seed):
    """(id, text, is spam): pages of prose with code, tables, steps and links, and stuffed pages of eight kinds, a line of prose
    before some."""
    rnd = random.Random(seed)
    word = lambda k=0: "".join(rnd.choice(["ba", "ce", "di", "fo", "gu", "la", "me", "ni", "ro", "tu"]) for _ in range(rnd.randint(2, 4)))
    vocab = [word() for _ in range(600)]
    sentence = lambda: " ".join(rnd.choice(vocab) for _ in range(rnd.randint(6, 18))).capitalize() + rnd.choice(".?!")
    prose = lambda: " ".join(sentence() for _ in range(rnd.randint(2, 6)))
    phrases = [" ".join(rnd.sample(vocab, rnd.randint(2, 4))) for _ in range(12)]
    url = lambda: f"https://{rnd.choice(vocab)}.test/{rnd.choice('pqr')}/{rnd.randint(1, 99999)}"
    code = lambda: f"{rnd.choice(phrases).title()} {rnd.choice('ABKX')}{rnd.randint(100, 999)} {rnd.randint(1, 80)}%"

    def spam():
        some, k = rnd.sample(phrases, 3), rnd.randint(15, 45)
        pool = " ".join(some).split()
        return rnd.choice([
            lambda: rnd.choice([", ", " | ", "; "]).join(rnd.choice(some) for _ in range(k)), lambda: "\n".join(rnd.choice(some) for _ in range(k)), lambda: " ".join(rnd.choice(pool) for _ in range(4 * k)),
            lambda: rnd.choice([", ", " / ", " · "]).join(code() for _ in range(k)), lambda: " ".join("#" + rnd.choice(pool) for _ in range(k)), lambda: "\n".join(url() for _ in range(k)),
            lambda: " ".join(f'<a href="{url()}">{rnd.choice(phrases)}</a>' for _ in range(k)), lambda: "\n".join(f"- [{rnd.choice(phrases)}]({url()})" for _ in range(k)),
        ])()

    def fine():
        parts = [prose() for _ in range(rnd.randint(1, 3))]
        parts += rnd.sample([
            "```\nfor x in datos:\n    y[x] = round(x * 2, 1)\nprint(y)\n```", "\n".join(f"{h:02d}:00 | {rnd.randint(1, 999)} | {rnd.random():.2f}" for h in range(8)), "\n".join(f"{i}. {sentence()}" for i in range(1, 6)), f"{sentence()[:-1]}: {url()}", f"[manual]({url()})",
        ], rnd.randint(0, 2))
        return "\n\n".join(parts)

    out = []
    for i in range(n):
        bad = rnd.random() < 0.08
        out.append((i, (f"{sentence()}\n" if rnd.random() < 0.3 else "") + spam() if bad else fine(), bad))
    return out


def test_training_finds_what_its_start_does_not(frame):
    seen, held = planted(4000, 1), planted(3000, 2)
    model = stuffing.train(stuffing.featured(frame("doc_id long, text string, s string, parte long", [(*r[:2], "x", 1) for r in seen])).cache())
    feats = stuffing.featured(frame("doc_id long, text string", [r[:2] for r in held])).cache()
    bad = {r[0] for r in held if r[2]}

    def judged(m):
        got = {r["doc_id"] for r in stuffing.labelled(feats, m).where("2 * listadas > palabras and elementos >= 6").collect()}
        return len(got & bad) / len(bad), len(got & bad) / len(got)

    before, after = judged(stuffing.Model()), judged(model)
    assert after[0] >= 0.99 and after[1] >= 0.99 and before[0] < after[0] - 0.03


def test_training_is_the_same_at_every_size(frame):
    pages = planted(500, 5)
    one = stuffing.train(stuffing.featured(frame("doc_id long, text string", [r[:2] for r in pages])))
    ten = stuffing.train(stuffing.featured(frame("doc_id long, text string", [r[:2] for r in pages] * 10)))
    assert all((abs(a - b) < 1e-9).all() for a, b in zip([*one.emit, one.move, one.start], [*ten.emit, ten.move, ten.start], strict=True))


def test_pages(frame):
    rows = [(i, t, "x", 1) for i, t in enumerate(SPAM)] + [(100 + i, t, "x", 1) for i, t in enumerate(FINE)] + [(1000 + i, t, "x", 1) for i, t, _ in planted(1500, 3)]
    rows += [(300, (PROSE + " ") * 3 + "\n" + " | ".join(["batería litio oferta"] * 8), "x", 1), (0, SPAM[0], "x", 1)]
    got = sorted(r["doc_id"] for r in stuffing.pages(frame("doc_id long, text string, s string, parte long", rows)).where("relleno and doc_id < 1000").collect())
    assert got == [0, *range(len(SPAM))]
    assert stuffing.pages(frame("doc_id long, text string")).count() == 0


def test_features_do_not_depend_on_the_grouping_of_pages(frame):
    import numpy as np

    texts = [t for _, t, _ in planted(120, 4)] + ["", "???", "ÑANDÚ \U0001f600 #x", "a" * 5000]
    page, *whole = stuffing.features(texts)
    for i, t in enumerate(texts):
        one = stuffing.features([t])
        for a, b in zip(one[1:], whole, strict=True):
            assert np.array_equal(a, b[page == i])
    got = {r["doc_id"]: r["s"] for r in stuffing.featured(frame("doc_id long, text string", list(enumerate(texts))), chars=900).collect()}
    assert all(np.array_equal(got[i], whole[0][page == i]) for i in range(len(texts)))


def test_viterbi_against_brute_force():
    import itertools

    import numpy as np

    m, rnd = stuffing.Model(), np.random.default_rng(1)
    for _ in range(20):
        s = rnd.integers(0, int(np.prod(stuffing.SIZES)), 4)
        n = rnd.integers(1, 80, 4)
        b = m.scores(s, n)
        score = lambda z: m.start[z[0]] + b[0, z[0]] + sum(m.move[z[t - 1], z[t]] + b[t, z[t]] for t in range(1, 4))  # noqa: B023, E731
        best = max(map(score, itertools.product(range(len(stuffing.STATES)), repeat=4)))
        for z in (m.decode(s, n), m.decode_all([(s, n), (s[:2], n[:2])])[0]):  # the flat start has ties
            assert score(z) == pytest.approx(best)


def test_a_very_long_page_is_read_whole(frame):
    t = PROSE + "\n" + " | ".join(["batería litio oferta"] * 60_000)
    assert stuffing.pages(frame("doc_id long, text string", [(1, t)])).first()["palabras"] > 180_000


ODD = ["<a " * 60_000, "[" * 200_000, "a." * 100_000, "```" * 60_000, "(" * 200_000, "-" * 200_000, " - " * 60_000, "<a href=x>y" * 20_000, "](" * 100_000, "é\u0301" * 100_000, "# " * 100_000, "GUEMZACA" + " " * 200_000 + "2"]


@pytest.mark.parametrize("k", range(len(ODD)))
def test_odd_long_texts_take_no_time(k):
    import time

    began = time.time()
    stuffing.features([ODD[k]])
    ix = index([(c, n) for c, n, _ in NAMES])
    match(ix, ODD[k])
    leakage.placed(ODD[k])
    assert time.time() - began < 8
