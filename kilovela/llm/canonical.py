"""Free-entered values mapped to the entries of a reference list, unmatched values reported.

Values are deduplicated first, so a name entered a million times is scored once, and normalised: broken encodings repaired,
accents and case folded, digits typed for letters undone, bracketed notes dropped, a numeral at the end set apart. Candidates
come from an inverted index of character n-grams (2, 3, and pairs with a gap, within words, so word order does not matter) and
are scored by weighted cosine. A gram weighs by its rarity in the reference list times the weight of its word, and a word's
weight is learnt: a first pass over the distinct values notes with which entries each word goes, and a word that goes with many
different entries (the generic words before a name, articles, remarks) says little. No word list is kept.

The candidate of highest cosine is accepted above a threshold and with a margin over the next entry of another name. The
threshold is learnt too: all reference names, each looked up in the whole list with its own entry left out, show how high the
cosine of a wrong entry gets. Only below it (some values of a hundred, with several typing errors in a short name) an exact
check follows: of all candidates of cosine ``low`` or more the one of highest edit similarity, if that is high enough and
strictly the highest. A numeral must agree, for entries that differ in it only are different entries; a value cut short
is compared with the beginnings of the candidates, and so is one that the cosine does not settle.

The reference list is read in blocks of ``block`` entries, so the index sent to the executors is bounded however long the list
is: with several blocks every value's best candidates of each block are compared in the end, which gives the same result as one
block. Gram statistics are those of the whole list. The distinct values are scored in Arrow batches spread over all tasks.

Defined results: NULL and blank values give no row; placeholders and unknown names ``SIN_REFERENCIA``; a value equal to an
entry's name gives no row; equal scores (ties) leave the value unmatched unless the names are the same and then take the
smallest code; repeated rows share their value's result; an empty reference list leaves every value unmatched.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilovela.session import join_small, stage

UNKNOWN = "SIN_REFERENCIA"

# Numerals at the end of a name; letters that digits stand for.
ROMAN = {"I": 1, "II": 2, "III": 3, "IV": 4, "V": 5}
LETTERS = str.maketrans("015", "OLS")

BROKEN = re.compile("[ÃãAa]([\x80-\xbf])")
NOTE = re.compile(r"\([^()]*\)|\s-\s.*$")
NUMERAL = re.compile(r"(?:[\s-]+(?:N[O0]\.?\s*)?(IV|V|I{1,3}|[1-9])|(?:\s*N[O0]\.\s*|(?<=[A-Z]))([1-9]))$")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
PLACE = {c: i for i, c in enumerate(ALPHABET)}


@dataclass(frozen=True)
class Name:
    """Words, the numeral (0: none), and whether the name was cut short."""

    words: tuple[str, ...]
    numeral: int
    cut: bool


def normal(value: str, glued: bool = True) -> Name:
    """Comparison form of a value; with ``glued`` a digit right behind a letter at the end is a numeral, else a letter."""
    t = BROKEN.sub(lambda m: bytes([0xC3, ord(m.group(1))]).decode("utf-8", "ignore"), value)
    t = unicodedata.normalize("NFD", t)
    t = " ".join("".join(c for c in t if not unicodedata.combining(c)).upper().split())
    t = " ".join(NOTE.sub(" ", t).split()).strip(" ,;*")
    cut = t.endswith((".", "…"))
    t = t.rstrip(" .,;…*")
    numeral, parts = 0, [p.strip() for p in t.split(",")]  # an article may stand behind a comma, the numeral before it
    for i in range(len(parts) - 1, -1, -1):
        tail = parts[i][-40:]  # a numeral is at the very end
        if not numeral and (m := NUMERAL.search(tail)) and (glued or m.group(1)):
            g = m.group(1) or m.group(2)
            numeral, parts[i] = ROMAN.get(g) or int(g), parts[i][: len(parts[i]) - len(tail) + m.start()]
    return Name(tuple(w.translate(LETTERS) for w in re.findall(r"[A-Z0-9]+", " ".join(parts))), numeral, cut)


def readings(value: str) -> list[Name]:
    """The ways to read a value: a last digit may be a numeral or stand for a letter."""
    first = normal(value)
    second = normal(value, glued=False) if first.numeral else first
    return [first] if second == first else [first, second]


def grams(word: str, cut: bool = False) -> Counter:
    """Character pairs, triples and pairs around a gap, with the word's ends marked (its end not if it was cut short)."""
    s = f"^{word}" if cut else f"^{word}$"
    return Counter([s[i : i + n] for n in (2, 3) for i in range(len(s) - n + 1)] + [f"{s[i]}_{s[i + 2]}" for i in range(len(s) - 2)])


def edits(a: str, b: str) -> int:
    """Optimal string alignment distance (insert, delete, replace, swap neighbours)."""
    return _last_row(a, b)[-1]


def prefix_edits(a: str, b: str) -> int:
    """Distance of a to the nearest beginning of b."""
    return min(_last_row(a, b))


def _last_row(a: str, b: str) -> list[int]:
    p2: list[int] = []
    p1 = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            d = min(p1[j] + 1, cur[-1] + 1, p1[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, p2[j - 2] + 1)
            cur.append(d)
        p2, p1 = p1, cur
    return p1


@dataclass
class Weights:
    """What is known of the whole list and of the values typed: entries, grams and how many entries hold them, words and how many
    entries they go with."""

    entries: int
    grams: dict[str, int]
    words: dict[str, int] = field(default_factory=dict)
    cache: dict[str, float] = field(default_factory=dict, repr=False)
    long: list[str] | None = field(default=None, repr=False)
    known: dict[tuple[str, bool], list[tuple[str, float]]] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}, "cache": {}}

    def gram(self, g: str) -> float:
        return math.log(1 + self.entries / self.grams.get(g, 1))

    def word(self, w: str) -> float:
        """1 for a word that goes with one entry, falling to nearly nothing for one that goes with many, or for a word typed much
        like such a one."""
        if (got := self.cache.get(w)) is None:
            n = self.words.get(w, 1)
            if n * n < self.entries and len(w) >= 5:
                n = max((self.words[g] for g in self._generic() if abs(len(g) - len(w)) <= 2 and 4 * edits(w, g) <= len(w)), default=n)
            got = max(0.02, (1 - math.log(n) / math.log(1 + self.entries)) ** 2) if n > 1 else 1.0
            self.cache = self.cache if len(self.cache) < 100_000 else {}
            self.cache[w] = got
        return got

    def _generic(self) -> list[str]:
        """Long words that go with more entries than the root of their number."""
        if self.long is None:
            self.long = [w for w, n in self.words.items() if len(w) >= 5 and n * n >= self.entries]
        return self.long

    def vector(self, words: tuple[str, ...], cut: bool = False) -> dict[str, float]:
        v: dict[str, float] = {}
        for i, w in enumerate(words):
            weight = self.word(w)
            for g, x in self._weighed(w, cut and i == len(words) - 1):
                v[g] = v.get(g, 0.0) + weight * x
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {g: x / norm for g, x in v.items()}

    def _weighed(self, w: str, cut: bool) -> list[tuple[str, float]]:
        """Grams of a word with their weights; kept, for words come again."""
        if (got := self.known.get((w, cut))) is None:
            got = [(g, k * self.gram(g)) for g, k in grams(w, cut).items()]
            self.known = self.known if len(self.known) < 20_000 else {}
            self.known[w, cut] = got
        return got

    def core(self, words: tuple[str, ...]) -> str:
        """The letters of the words that matter: those of at least half the highest weight."""
        least = max((self.word(w) for w in words), default=0.0) / 2
        return "".join(w for w in words if self.word(w) >= least)

    def light(self, words: tuple[str, ...]) -> set[str]:
        least = max((self.word(w) for w in words), default=0.0) / 2
        return {w for w in words if self.word(w) < least}


Found = tuple[float, str, str]  # score, code, name


@dataclass
class Index:
    """Inverted n-gram index of a block [(code, name)] of the reference list."""

    entries: list[tuple[str, str]]
    weights: Weights
    low: float = 0.1
    margin: float = 0.04
    similar: float = 0.69
    begun: float = 0.8
    whole: float = 0.95

    def __post_init__(self) -> None:
        self.names = [normal(n) for _, n in self.entries]
        self.numerals = np.array([n.numeral for n in self.names], dtype=np.int64)
        self.keys = [f"{' '.join(n.words)}|{n.numeral}" for n in self.names]
        self.key_numbers = np.unique(np.array(self.keys, dtype=str), return_inverse=True)[1] if self.keys else np.zeros(0, dtype=np.int64)
        self.cores = [self.weights.core(n.words) for n in self.names]
        self.lights = [self.weights.light(n.words) for n in self.names]
        self.lengths = np.array([len(c) for c in self.cores], dtype=np.int64)
        self.bags = np.array([self._bag(c) for c in self.cores], dtype=np.int32).reshape(len(self.cores), len(ALPHABET))
        self.starts = np.array([self._starts(n, 32) for n in self.names]).reshape(len(self.names), 32)
        post: dict[str, tuple[list[int], list[float]]] = {}
        for i, n in enumerate(self.names):
            for g, x in self.weights.vector(n.words).items():
                at = post.setdefault(g, ([], []))
                at[0].append(i)
                at[1].append(x)
        self.post = {g: (np.array(i, dtype=np.int32), np.array(x)) for g, (i, x) in post.items()}

    @staticmethod
    def _bag(core: str) -> list[int]:
        out = [0] * len(ALPHABET)
        for c in core:
            out[PLACE[c]] += 1
        return out

    def cosines(self, q: Name) -> np.ndarray:
        """Cosine of every entry of the block; 0 where the numeral differs."""
        hits = [(self.post[g], x) for g, x in self.weights.vector(q.words, q.cut).items() if g in self.post]
        if not hits:
            return np.zeros(len(self.entries))
        score = np.bincount(np.concatenate([p[0] for p, _ in hits]), np.concatenate([p[1] * x for p, x in hits]), len(self.entries))
        if q.cut:
            score = self._begun(q, score)
        return np.where(self.numerals == q.numeral, score, 0.0)

    def _begun(self, q: Name, score: np.ndarray) -> np.ndarray:
        """For a value cut short the candidates' cosines with their beginnings of the value's length. What lies beyond the beginning only
        lengthens an entry's vector, so cosine over the beginning's length bounds the result, and candidates are taken in the order
        of that bound until two are known to be best."""
        v, bound = self.weights.vector(q.words, True), self._bound(q, score)
        bound = np.where((bound >= self.low) & (self.numerals == q.numeral), bound, 0.0)
        score, known = score.copy(), []
        for i in np.argsort(-bound, kind="stable").tolist():
            if bound[i] <= 0 or (len(known) > 1 and bound[i] < known[1][0] - 1e-9):
                break
            n = self.names[i]
            if n.words and len(n.words[-1]) > len(q.words[-1]):
                w = self.weights.vector((*n.words[:-1], n.words[-1][: len(q.words[-1])]), True)
                score[i] = max(score[i], sum(x * w.get(g, 0.0) for g, x in v.items()))
            known = merged([*known, (float(score[i]), self.entries[i][0], self.keys[i])])
        return score

    def _bound(self, q: Name, score: np.ndarray) -> np.ndarray:
        return np.minimum(1.0, score / self.starts[:, min(len(q.words[-1]), self.starts.shape[1] - 1)])

    def _starts(self, n: Name, longest: int) -> list[float]:
        """Length, as a share of the whole vector's, of the name's vector up to each letter of its last word, at the least."""
        whole = self.weights.vector(n.words)
        per, ends = np.zeros(longest), []
        for i, w in enumerate(n.words):
            s, last = f"^{w}$", i == len(n.words) - 1
            found = [(s[k : k + g], k + g - 1) for g in (2, 3) for k in range(len(s) - g + 1)] + [(f"{s[k]}_{s[k + 2]}", k + 2) for k in range(len(s) - 2)]
            ends += [(g, min(end, longest - 1) if last else 0) for g, end in found]
        often = Counter(g for g, _ in ends)
        for g, end in ends:
            per[end] += (whole[g] / often[g]) ** 2
        return np.maximum(np.sqrt(np.cumsum(per)), 1e-6).tolist()

    def best(self, q: Name, score: np.ndarray) -> list[Found]:
        """The entry of highest cosine (of equal names the one of smallest code) and the best entry of another name."""
        out: list[Found] = []
        for _ in range(2):
            if not len(score) or (top := float(score.max())) <= 0:
                break
            i = int((score >= top - 1e-12).argmax())  # entries are in order of their codes
            out.append((top, self.entries[i][0], self.keys[i]))
            score = np.where(self.key_numbers == self.key_numbers[i], 0.0, score)
        return out

    def alike(self, q: Name, score: np.ndarray) -> list[Found]:
        """The highest edit similarity among the candidates, and the next where it ties. A candidate is passed over only if its letters
        or its length rule out that it reaches the threshold or the best so far, so the best and its ties are exact."""
        core, light = self.weights.core(q.words), self.weights.light(q.words)
        at = np.flatnonzero((self._bound(q, score) if q.cut else score) >= self.low)
        if len(core) < 3 or not len(at):
            return []
        bag, bags, lengths = np.array(self._bag(core), dtype=np.int32), self.bags[at], self.lengths[at]
        shared = np.minimum(bag, bags).sum(1)
        limit = shared / np.maximum(len(core), lengths) + 0.13
        if q.cut:
            limit = np.maximum(limit, np.where(shared >= self.begun * len(core), shared / len(core), 0.0))
        at, limit = at[limit >= self.similar], limit[limit >= self.similar]
        bonus = np.array([0.08 * bool(light & self.lights[i]) + 0.05 * (q.numeral > 0) for i in at.tolist()])
        out: list[Found] = []
        for k in np.argsort(-score[at], kind="stable").tolist():
            if out and limit[k] < out[0][0] - 1e-9:
                continue
            i = int(at[k])
            s = 1 - edits(core, self.cores[i]) / max(len(core), len(self.cores[i])) + bonus[k]
            if q.cut and (begun := 1 - prefix_edits(core, self.cores[i]) / len(core)) >= self.begun:
                s = max(s, begun)
            if s >= self.similar and self.keys[i] not in {f[2] for f in out}:
                out = sorted([*out, (float(s), self.entries[i][0], self.keys[i])], key=lambda f: (-f[0], f[1]))[:2]
        return out

    def candidates(self, value: str, accept: float) -> list[tuple[list[Found], list[Found]]]:
        """Per reading of the value the best by cosine and, where the cosine does not settle it, by edit similarity; then per reading
        the entries that begin with it. Four pairs of lists."""
        out: list[tuple[list[Found], list[Found]]] = [([], [])] * 4
        for k, q in enumerate(readings(value)):
            if not q.words:
                continue
            score = self.cosines(q)
            top = self.best(q, score)
            if settled(top, accept, self.margin):
                out[k] = top, []
                continue
            out[k] = top, self.alike(q, score)
            if not q.cut and len(q.words[-1]) >= 5:
                short = Name(q.words, q.numeral, True)
                out[2 + k] = [f for f in self.best(short, self.cosines(short)) if f[0] >= self.whole], []
        return out


def settled(top: list[Found], accept: float, margin: float) -> bool:
    return bool(top) and top[0][0] >= accept and (len(top) == 1 or top[0][0] - top[1][0] >= margin)


def merged(found: list[Found]) -> list[Found]:
    """The two best of different names out of several blocks."""
    out: list[Found] = []
    for f in sorted(found, key=lambda x: (-x[0], x[1])):
        if len(out) < 2 and f[2] not in {o[2] for o in out}:
            out.append(f)
    return out


def decide(by_reading: list[tuple[list[Found], list[Found]]], accept: float, margin: float) -> tuple[str, float, str]:
    """(code or SIN_REFERENCIA, best cosine, how it was found: coseno, edicion or nada)."""
    cosine = max((top[0][0] for top, _ in by_reading[:2] if top), default=0.0)
    for top, _ in by_reading[:2]:
        if settled(top, accept, margin):
            return top[0][1], cosine, "coseno"
    for top, _ in by_reading[2:]:
        if settled(top, accept, margin):
            return top[0][1], top[0][0], "coseno"
    for _, near in by_reading[:2]:
        if near and (len(near) == 1 or near[0][0] > near[1][0] + 1e-9):
            return near[0][1], cosine, "edicion"
    return UNKNOWN, cosine, "nada"


def wrong(index: Index, n: Name) -> float:
    """The highest cosine of a reference name with an entry of another name."""
    key = f"{' '.join(n.words)}|{n.numeral}"
    return max((f[0] for f in index.best(n, index.cosines(n)) if f[2] != key), default=0.0)


def threshold(index: Index, share: float = 0.999) -> float:
    """The cosine that only 1 - ``share`` of the reference names reach with an entry of another name."""
    return max(0.4, float(np.quantile([wrong(index, n) for n in index.names], share))) if index.names else 0.4


def threshold_of(ref: DataFrame, blocks: list[Broadcast[Index]], share: float = 0.999) -> float:
    """The same over all names of ``ref`` (codigo, nombre), each looked up in all blocks by the executors; the driver gets the names from
    the ``share`` quantile on."""
    names, per = ref.repartition(2 * ref.sparkSession.sparkContext.defaultParallelism), None
    for shared in blocks:

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield b.assign(s=[wrong(shared.value, normal(n)) for n in b["nombre"]])

        one = names.mapInPandas(run, "codigo string, nombre string, s double")
        per = one if per is None else per.unionByName(one)
    if len(blocks) > 1:
        per = per.groupBy("codigo", "nombre").agg(F.max("s").alias("s"))
    per = stage(per.select("s"), "wrong")
    n = per.count()
    if not n:
        return 0.4
    at = (n - 1) * share
    top = [r["s"] for r in per.orderBy(F.desc("s")).limit(n - int(at)).collect()]
    return max(0.4, float(np.quantile(top[-2:], at - int(at))))


def weights_of(names: list[str], generic: int = 3) -> Weights:
    """Counts over the names of a list: grams, and the words of ``generic`` names or more; names that differ in their numeral only count
    once."""
    per_gram, per_word, seen = Counter(), Counter(), {normal(n).words for n in names}
    for words in seen:
        per_word.update(set(words))
        per_gram.update({g for w in words for g in grams(w)})
    return Weights(len(seen), dict(per_gram), {w: k for w, k in per_word.items() if k >= generic})


def statistics(names: DataFrame, generic: int) -> Weights:
    """The same over a column ``nombre``, by partial counts; the driver gets the grams, which an alphabet of 36 bounds, and the words
    that many names share."""

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"w": sorted({" ".join(normal(n).words) for n in b["nombre"]})})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            c: Counter = Counter({("n", ""): len(b)})
            for name in b["w"]:
                own = set(name.split())
                c.update(("w", w) for w in own)
                c.update(("g", g) for g in {g for w in own for g in grams(w)})
            yield pd.DataFrame([(*k, n) for k, n in c.items()], columns=["kind", "x", "n"])

    per = names.mapInPandas(words, "w string").distinct().mapInPandas(count, "kind string, x string, n long").groupBy("kind", "x").agg(F.sum("n").alias("n"))
    rows = per.where((F.col("kind") != "w") | (F.col("n") >= generic)).collect()
    part = lambda kind: {r["x"]: r["n"] for r in rows if r["kind"] == kind}
    return Weights(part("n").get("", 0), part("g"), part("w"))


def map_values(df: DataFrame, id_col: str, column: str, reference: DataFrame, code: str, name: str, block: int = 50_000, generic: int = 3, sure: float = 0.3, **limits: float) -> DataFrame:
    """(id, valor, codigo, parecido, via) for every row whose ``column`` is neither NULL nor blank nor, byte for byte, a name of the
    reference list. ``generic``: words that go with fewer entries keep their full weight."""
    spark = df.sparkSession
    ref = stage(reference.where(F.col(code).isNotNull() & F.col(name).isNotNull()).select(F.col(code).cast("string").alias("codigo"), F.col(name).alias("nombre")).distinct(), "ref")
    head = [(r[0], r[1]) for r in ref.orderBy("codigo", "nombre").limit(block + 1).collect()]  # a block at most
    several = len(head) > block

    def blocks() -> Iterator[list[tuple[str, str]]]:
        if not several:
            yield head
            return
        part: list[tuple[str, str]] = []
        for r in ref.orderBy("codigo", "nombre").toLocalIterator():
            part.append((r[0], r[1]))
            if len(part) == block:
                yield part
                part = []
        yield part

    weights = statistics(ref.select("nombre"), generic) if several else weights_of([n for _, n in head], generic)
    blank = F.regexp_replace("valor", r"[\s ]+", "") == ""
    typed = df.select(F.col(id_col), F.col(column).alias("valor")).where(F.col("valor").isNotNull() & ~blank)
    distinct = typed.groupBy("valor").agg(F.lit(1).alias("_")).select("valor").join(ref.select(F.col("nombre").alias("valor")).distinct(), "valor", "left_anti")
    # few bytes but much work per value: an explicit number of tasks, which AQE does not merge
    distinct = stage(distinct.repartition(2 * spark.sparkContext.defaultParallelism), "typed").repartition(2 * spark.sparkContext.defaultParallelism)

    # which words go with many different entries
    pairs = None
    for part in blocks():
        shared = spark.sparkContext.broadcast(Index(part, weights, **limits))  # at most `block` entries

        def go(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            ix = shared.value
            for b in batches:
                out = set()
                for v in b["valor"]:
                    q = normal(v)
                    top = ix.best(q, ix.cosines(q)) if q.words else []
                    if top and top[0][0] >= sure:
                        out |= {(w, top[0][2].split("|")[0]) for w in q.words}
                yield pd.DataFrame(sorted(out), columns=["w", "e"])

        one = distinct.mapInPandas(go, "w string, e string")
        pairs = one if pairs is None else pairs.unionByName(one)
    often = pairs.groupBy("w", "e").agg(F.lit(1).alias("_")).groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= generic).collect()  # words that go with several entries
    for r in often:
        weights.words[r["w"]] = max(r["n"], weights.words.get(r["w"], 0))
    weights = Weights(weights.entries, weights.grams, weights.words)

    indexes = [spark.sparkContext.broadcast(Index(part, weights, **limits)) for part in blocks()]
    mapped, accept, margin = None, threshold_of(ref, indexes), limits.get("margin", Index.margin)
    limit = 2.0 if several else accept  # 2: edit similarities in any case
    for shared in indexes:

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            ix = shared.value
            for b in batches:
                if several:
                    got = [(v, k, kind, *f) for v in b["valor"] for k, both in enumerate(ix.candidates(v, limit)) for kind, found in enumerate(both) for f in found]
                    yield pd.DataFrame(got, columns=["valor", "k", "kind", "s", "c", "e"])
                else:
                    got = [decide(ix.candidates(v, limit), limit, margin) for v in b["valor"]]
                    yield pd.DataFrame({"valor": b["valor"], "codigo": [g[0] for g in got], "parecido": [g[1] for g in got], "via": [g[2] for g in got]})

        one = distinct.mapInPandas(run, "valor string, k int, kind int, s double, c string, e string" if several else "valor string, codigo string, parecido double, via string")
        mapped = one if mapped is None else mapped.unionByName(one)
    if several:
        mapped = _over_blocks(distinct, mapped, accept, margin)
    return join_small(typed, stage(mapped, "mapped"), ["valor"], "inner", salt_of=id_col).select(id_col, "valor", "codigo", "parecido", "via")


def _over_blocks(distinct: DataFrame, found: DataFrame, accept: float, margin: float) -> DataFrame:
    """One decision per value out of the blocks' best candidates: a few per reading and block."""
    per = found.groupBy("valor").agg(F.collect_list(F.struct("k", "kind", "s", "c", "e")).alias("f"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = []
            for fs in b["f"]:
                fs = [] if fs is None else fs
                by = [[merged([(f["s"], f["c"], f["e"]) for f in fs if (f["k"], f["kind"]) == (k, kind)]) for kind in (0, 1)] for k in range(4)]
                got.append(decide([(x, y) for x, y in by], accept, margin))
            yield pd.DataFrame({"valor": b["valor"], "codigo": [g[0] for g in got], "parecido": [g[1] for g in got], "via": [g[2] for g in got]})

    return distinct.join(per, "valor", "left").mapInPandas(run, "valor string, codigo string, parecido double, via string")
