"""Keyword-stuffed and link-list pages, by a hidden Markov model over lines.

Each line with words becomes a vector of coarse features (share of its words in links, in tags, in short segments, in word
pairs the page repeats; poverty of words; numbers; code; length; how it ends). A hidden Markov
model with the states prose, data (code, tables, numbered values), link list, tag list, menu (separated search phrases,
offers) and phrases (keywords without separators) labels the lines of a page; a page is flagged if over half of its words
stand in lines of the last four states and these hold at least ``least`` items.

The model is trained here. Its start knows a state by one feature only, its signature (links by the share of links, menus by
repeated word pairs, ...), and is flat in all others; Viterbi training over all pages fills in the rest: which lengths,
segments, endings and numbers go with each state, and which state follows which. Pages whose lines have no signature, such as
shuffled keywords or lists of offers, are found through what training has learnt.

Features are computed in Arrow batches, whole batches of pages at once on arrays of code points, and staged; training then
reads only the small feature rows. A training round is one pass that counts (state, feature value) and transitions with a
map-side sum; the driver gets these counts only, some hundreds of numbers.

Everything is per page: no shuffle of texts, so no hot source or author. Defined results: NULL, empty and wordless texts
have share 0 and are not flagged; repeated rows are each judged; whole texts are read, whatever their length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilovela.session import stage

STATES = ("prosa", "datos", "enlaces", "etiquetas", "menu", "frases")
LISTED = np.array([False, False, True, True, True, True])

# Feature names with their numbers of values.
FEATURES = {"enlace": 3, "etiqueta": 3, "repetido": 4, "corto": 3, "numero": 3, "codigo": 2, "largo": 3, "frase": 3, "pobre": 3, "enumera": 3}
SIZES = list(FEATURES.values())

# Each alternative stops where another could begin, so that no text, however odd, is scanned more than a few times.
LINK = re.compile(r"<a\b[^<>\n]*>[^<\n]*(?:<(?!/?a\b)[^<\n]*)*</a>|!?\[[^\[\]\n]*\]\([^()\s]*\)|(?:\b[a-z][a-z0-9+.-]{0,20}://|\bwww\.)[^\s<>\"')\]]+", re.I)
CODED = re.compile(r"^[ \t]*(```|~~~).*?(?:^[ \t]*\1|\Z)|<(pre|code)\b.*?(?:</\2>|\Z)", re.S | re.M | re.I)
SEPARATORS = ",;|·•\t/»–—#\n"
SYMBOLS = "=<>{}[]()_\\`"


WORD, DIGIT, SPACE, BREAK, DASH, STOP, SYMBOL = (np.uint8(1 << k) for k in range(7))


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: its kinds as bits, and its lower case where that is one code point."""
    chars = [chr(c) for c in range(0x110000)]
    kinds, low = np.zeros(len(chars), dtype=np.uint8), np.arange(len(chars), dtype=np.uint64)
    for bit, test in ((WORD, str.isalnum), (DIGIT, str.isdigit), (SPACE, str.isspace)):
        kinds |= np.fromiter((test(c) for c in chars), dtype=bool, count=len(chars)) * bit
    for bit, those in ((BREAK, SEPARATORS), (DASH, "-*~+>"), (STOP, ".:!?"), (SYMBOL, SYMBOLS)):
        kinds[[ord(c) for c in those]] |= bit
    for i, c in enumerate(chars):
        if c.isupper() and len(x := c.lower()) == 1:
            low[i] = ord(x)
    return kinds, low


MIX = np.random.default_rng(10).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
GOLD = np.uint64(0x9E3779B97F4A7C15)


def _spread(flag: np.ndarray) -> np.ndarray:
    """Position of the last true flag at or before each place (0 before the first)."""
    return np.maximum.accumulate(np.where(flag, np.arange(len(flag)), 0))


def _spans(texts: list[str], at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks of the places inside links and inside code blocks, and the places where links begin. The patterns run over pages only
    that hold a link's or a code block's mark."""
    link, coded, begins = np.zeros(size + 1, dtype=np.int32), np.zeros(size + 1, dtype=np.int32), []
    for t, a in zip(texts, at.tolist(), strict=True):
        low = t.lower()
        if "://" in t or "www." in low or "](" in t or "<a" in low:
            for m in LINK.finditer(t):
                link[a + m.start()] += 1
                link[a + m.end()] -= 1
                begins.append(a + m.start())
        if "```" in t or "~~~" in t or "<pre" in low or "<code" in low:
            for m in CODED.finditer(t):
                coded[a + m.start()] += 1
                coded[a + m.end()] -= 1
    return np.cumsum(link)[:-1] > 0, np.cumsum(coded)[:-1] > 0, np.array(begins, dtype=np.int64)


def _counts(key: np.ndarray) -> np.ndarray:
    """How often each element's value occurs."""
    _, back, n = np.unique(key, return_inverse=True, return_counts=True)
    return n[back]


def _distinct(group: np.ndarray, word: np.ndarray, groups: int) -> np.ndarray:
    """Distinct words per group number, by 40 bits of their hashes."""
    key = np.sort((group.astype(np.uint64) << np.uint64(40)) | (word & np.uint64((1 << 40) - 1)))
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    return np.bincount((key[new] >> np.uint64(40)).astype(np.int64), minlength=groups)


def _bin(x: np.ndarray, *cuts: float) -> np.ndarray:
    return np.searchsorted(np.array(cuts), x, side="right")


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the lines with words of all pages, in order: page number, symbol, words, items. The symbol packs the features in mixed
    radix."""
    none = np.zeros(0, dtype=np.int64)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    joined = "".join(f"{t}\n" for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    total = len(codes)
    if not total:
        return none, none, none, none
    kinds, lower = _letters()
    page_at, kind = np.cumsum(sizes) - sizes, kinds[codes]
    of = lambda bit, x=kind: (x & bit) != 0
    alnum, blank, newline = of(WORD), of(SPACE), codes == 10
    blank_next = np.concatenate((blank[1:], [True]))
    begin = alnum & ~np.concatenate(([False], alnum[:-1]))
    w = np.flatnonzero(begin)
    if not len(w):
        return none, none, none, none
    end = np.flatnonzero(alnum & ~np.concatenate((alnum[1:], [False])))
    line_of, line_at = np.cumsum(newline) - newline, np.concatenate(([0], np.flatnonzero(newline)[:-1] + 1))
    lines = len(line_at)
    page_of_line = np.searchsorted(page_at, line_at, side="right") - 1
    in_link, in_code, link_at = _spans(texts, page_at, total)

    # words: hash, line, page
    letter = np.where(alnum, lower[codes] * MIX[(np.arange(total) - _spread(begin)) & 63], np.uint64(0))
    word = np.add.reduceat(letter, w) * GOLD
    word ^= word >> np.uint64(29)
    line = line_of[w]
    page = page_of_line[line]
    n = np.bincount(line, minlength=lines)
    page_n = np.bincount(page, minlength=len(texts))

    # pairs of neighbouring words that a page repeats: three times or more, and once in 40 words or more
    same = page[1:] == page[:-1]
    pair = (word[:-1] * MIX[1] + word[1:]) * GOLD + page[:-1].astype(np.uint64) * MIX[2]
    often = np.zeros(len(w), dtype=bool)
    many = np.zeros(len(same), dtype=bool)
    many[same] = _counts(pair[same]) >= np.maximum(3, page_n[page[:-1]][same] / 40)
    often[:-1] |= many
    often[1:] |= many

    linked, tagged = in_link[w], (codes[np.maximum(w - 1, 0)] == 35) & ~in_link[w]
    stop = of(BREAK) | in_link | (of(STOP) & blank_next) | (of(DASH) & np.concatenate(([True], blank[:-1])) & blank_next)
    segment = np.cumsum(stop)[w][~linked]
    _, seg_first, seg_of, seg_n = np.unique(segment, return_index=True, return_inverse=True, return_counts=True)
    short_word = seg_n[seg_of] <= 6
    # a repeated phrase is a short segment, or part of a long one that says its words over and over; repeated sentences are neither
    often[~linked] &= short_word | (2 * _distinct(seg_of, word[~linked], len(seg_n)) <= seg_n)[seg_of]
    seg_line = line[~linked][seg_first]
    per = lambda which: np.bincount(which, minlength=lines)
    free, short = per(line[~linked]), per(line[~linked][short_word])
    short_segments = per(seg_line[seg_n <= 6])
    n1 = np.maximum(n, 1)
    part = lambda which: per(line[which]) / n1
    numbers = of(DIGIT, kind[w])
    symbols = np.bincount(line_of[of(SYMBOL) & ~in_link], minlength=lines)
    links = np.bincount(line_of[link_at], minlength=lines) if len(link_at) else np.zeros(lines, dtype=np.int64)
    in_block = np.bincount(line, weights=in_code[w], minlength=lines) > 0
    last = np.maximum.reduceat(np.where(blank, -1, np.arange(total)), line_at)
    closes = of(STOP, kind[np.maximum(last, 0)]) & ~in_link[np.maximum(last, 0)]
    first_word = np.full(lines, -1)
    first_word[line[::-1]] = np.arange(len(w))[::-1]
    fw = np.maximum(first_word, 0)
    bullet = numbers[fw] & np.isin(codes[np.minimum(end[fw] + 1, total - 1)], (46, 41))
    poor = np.where(n >= 16, _distinct(line, word, lines) / np.sqrt(n1), 9.0)
    repeated = part(often)
    f = (
        _bin(part(linked), 0.3, 0.6), _bin(part(tagged), 0.2, 0.6), _bin(repeated, 0.25, 0.5, 0.75), _bin(np.where(free > 0, short / np.maximum(free, 1), 1.0), 0.4, 0.8), _bin(part(numbers), 0.25, 0.5),
        (in_block | ((symbols * 4 > n) & (links == 0))).astype(np.int64), _bin(n, 5, 15), np.where(bullet, 0, np.where(closes, 1, 2)), 2 - _bin(poor, 2.0, 3.0), _bin(short_segments, 3, 8),
    )
    packed = np.zeros(lines, dtype=np.int64)
    for x, size in zip(f, SIZES, strict=True):
        packed = packed * size + x
    items = np.maximum.reduce([links, per(line[tagged]), short_segments, np.where((repeated >= 0.5) | (poor < 2.5), n // 4, 0)])
    has = n > 0
    return page_of_line[has], packed[has], n[has], items[has]


def unpack(symbols: np.ndarray) -> np.ndarray:
    out = np.empty((len(symbols), len(SIZES)), dtype=np.int64)
    s = symbols.copy()
    for j in range(len(SIZES) - 1, -1, -1):
        s, out[:, j] = np.divmod(s, SIZES[j])
    return out


# What the start knows: a state's signature is the highest value of one feature, and lines of other states rarely have it.
SIGNATURE = {"prosa": ("frase", 1), "datos": ("codigo", 1), "enlaces": ("enlace", 2), "etiquetas": ("etiqueta", 2), "menu": ("repetido", 3), "frases": ("pobre", 2)}
SURE, STRAY, STAY = 0.9, 0.05, 0.8


class Model:
    """Log-probabilities: start[k], move[k, k], emit[feature][k, value]."""

    def __init__(self) -> None:
        k = len(STATES)
        self.start = np.log(np.full(k, 1 / k))
        self.move = np.log(np.full((k, k), (1 - STAY) / (k - 1)) + np.eye(k) * (STAY - (1 - STAY) / (k - 1)))
        self.emit = []
        for name, size in FEATURES.items():
            e = np.full((k, size), 1 / size)
            for owner, (feature, value) in SIGNATURE.items():
                if feature == name:
                    for i, state in enumerate(STATES):
                        p = SURE if state == owner else STRAY
                        e[i] = (1 - p) / (size - 1)
                        e[i, value] = p
            self.emit.append(np.log(e))

    def scores(self, symbols: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Log-chance of each line in each state. A line counts as one observation per 25 words, one to three."""
        f = unpack(symbols.astype(np.int64))
        return sum(e[:, f[:, j]].T for j, e in enumerate(self.emit)) * np.clip(n / 25, 1, 3)[:, None]

    def decode(self, symbols: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Most likely states (Viterbi)."""
        b = self.scores(symbols, n)
        back = np.zeros(b.shape, dtype=np.int64)
        v = self.start + b[0]
        for t in range(1, len(b)):
            paths = v[:, None] + self.move
            back[t] = paths.argmax(0)
            v = paths.max(0) + b[t]
        out = np.empty(len(b), dtype=np.int64)
        out[-1] = v.argmax()
        for t in range(len(b) - 1, 0, -1):
            out[t - 1] = back[t, out[t]]
        return out

    def decode_all(self, pages: list[tuple[np.ndarray, np.ndarray]], cells: int = 50_000) -> list[np.ndarray]:
        """States of many pages (symbols, words), each with a line at least: pages of like length go through the recursion
        together, in groups of about ``cells`` lines."""
        out: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(pages)
        order = sorted(range(len(pages)), key=lambda i: len(pages[i][0]))
        at = 0
        while at < len(order):
            stop = at + 1
            while stop < len(order) and len(pages[order[stop]][0]) * (stop + 1 - at) <= cells:
                stop += 1
            self._group([pages[i] for i in order[at:stop]], order[at:stop], out)
            at = stop
        return out

    def _group(self, pages: list[tuple[np.ndarray, np.ndarray]], index: list[int], out: list[np.ndarray]) -> None:
        sizes = np.array([len(p[0]) for p in pages])
        longest, k = int(sizes.max()), len(STATES)
        flat = self.scores(np.concatenate([p[0] for p in pages]), np.concatenate([p[1] for p in pages]))
        inside = np.arange(longest) < sizes[:, None]
        b = np.zeros((len(pages), longest, k))
        b[inside] = flat
        back = np.tile(np.arange(k), (longest, len(pages), 1))
        v = self.start + b[:, 0]
        for t in range(1, longest):
            paths = v[:, :, None] + self.move
            on = inside[:, t, None]
            back[t] = np.where(on, paths.argmax(1), back[t])
            v = np.where(on, paths.max(1) + b[:, t], v)
        z = np.empty((len(pages), longest), dtype=np.int64)
        z[:, -1] = v.argmax(1)
        rows = np.arange(len(pages))
        for t in range(longest - 1, 0, -1):
            z[:, t - 1] = back[t, rows, z[:, t]]
        for i, j, n in zip(index, range(len(pages)), sizes, strict=True):
            out[i] = z[j, :n]

    def updated(self, counts: dict[tuple[int, int, int], int], keep: float) -> Model:
        """Estimates from (feature or -1 for moves, -2 for starts; state; value) counts, of which the start model makes up the share
        ``keep``: chances stay off zero, and a corpus of any size is trained alike. A state without lines stays at its start."""
        base, m = Model(), Model()
        k = range(len(STATES))

        def mix(prior: np.ndarray, j: int, states: Iterable[int]) -> np.ndarray:
            got = np.array([[counts.get((j, a, v), 0) for v in range(prior.shape[1])] for a in states], dtype=float)
            total = got.sum(1, keepdims=True)
            return np.log(np.where(total > 0, (1 - keep) * got / np.maximum(total, 1) + keep * np.exp(prior), np.exp(prior)))

        m.emit = [mix(e, j, k) for j, e in enumerate(base.emit)]
        m.move = mix(base.move, -1, k)
        m.start = mix(base.start[None], -2, (0,))[0]
        return m


def featured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chars: int = 500_000) -> DataFrame:
    """(doc_id, s, n, k): line symbols, word counts and item counts of every page. Pages go through ``features`` in groups of about
    ``chars`` characters; a longer page is a group of its own."""
    ints = pa.list_(pa.int32())

    def lists(page: np.ndarray, values: np.ndarray, pages: int) -> pa.Array:
        ends = np.searchsorted(page, np.arange(pages + 1))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column("doc_id"), [t or "" for t in b.column("t").to_pylist()]
            room, at = np.cumsum([len(t) + 1 for t in texts]) // chars, 0
            while at < len(texts):
                stop = max(at + 1, int(np.searchsorted(room, room[at], side="right")))
                page, *columns = features(texts[at:stop])
                arrays = [ids.slice(at, stop - at), *(lists(page, c, stop - at) for c in columns)]
                yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema([("doc_id", pa.int64()), ("s", ints), ("n", ints), ("k", ints)]))
                at = stop

    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t"))
    return base.mapInArrow(run, "doc_id long, s array<int>, n array<int>, k array<int>")


def train(feats: DataFrame, rounds: int = 8, keep: float = 0.1, still: float = 1e-3) -> Model:
    """Viterbi training over all pages until the states' shares of the lines stand still; the driver receives a few hundred counts
    per task and round."""
    model, last = Model(), None
    for _ in range(rounds):

        def count(batches: Iterator[pd.DataFrame], model: Model = model) -> Iterator[pd.DataFrame]:
            k, c = len(STATES), Counter()
            for b in batches:
                pages = [(np.asarray(s, dtype=np.int64), np.asarray(n)) for s, n in zip(b["s"], b["n"], strict=True) if s is not None and len(s)]
                if not pages:
                    continue
                states = model.decode_all(pages)
                z, f = np.concatenate(states), unpack(np.concatenate([p[0] for p in pages]))
                first = np.zeros(len(z), dtype=bool)
                first[np.cumsum([0, *[len(x) for x in states[:-1]]])] = True
                for v, n in enumerate(np.bincount(z[first], minlength=k)):
                    c[-2, 0, v] += int(n)
                moves = np.bincount(z[:-1][~first[1:]] * k + z[1:][~first[1:]], minlength=k * k)
                c.update({(-1, i // k, i % k): int(n) for i, n in enumerate(moves)})
                for j, size in enumerate(SIZES):
                    c.update({(j, i // size, i % size): int(n) for i, n in enumerate(np.bincount(z * size + f[:, j], minlength=k * size))})
            yield pd.DataFrame([(*key, v) for key, v in c.items()], columns=["j", "a", "v", "c"])

        rows = feats.select("s", "n").mapInPandas(count, "j int, a int, v int, c long").groupBy("j", "a", "v").agg(F.sum("c").alias("c")).collect()
        counts = {(r["j"], r["a"], r["v"]): r["c"] for r in rows}
        model = model.updated(counts, keep)
        share = np.array([sum(counts.get((0, a, v), 0) for v in range(SIZES[0])) for a in range(len(STATES))], dtype=float)
        share /= max(share.sum(), 1.0)
        if last is not None and np.abs(share - last).max() <= still:
            break
        last = share
    return model


def labelled(feats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, palabras, listadas, elementos, lineas per state): what the model makes of each page."""
    names = [f"l_{s}" for s in STATES]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            full = [i for i, s in enumerate(b["s"]) if s is not None and len(s)]
            states = dict(zip(full, model.decode_all([(np.asarray(b["s"].iloc[i], dtype=np.int64), np.asarray(b["n"].iloc[i])) for i in full]), strict=True))
            rows = []
            for i, (d, n, k) in enumerate(zip(b["doc_id"].tolist(), b["n"], b["k"], strict=True)):
                if i not in states:
                    rows.append((d, 0, 0, 0, *[0] * len(STATES)))
                    continue
                z, n = states[i], np.asarray(n)
                on = LISTED[z]
                rows.append((d, int(n.sum()), int(n[on].sum()), int(np.asarray(k)[on].sum()), *np.bincount(z, minlength=len(STATES)).tolist()))
            yield pd.DataFrame(rows, columns=["doc_id", "palabras", "listadas", "elementos", *names])

    return feats.mapInPandas(run, "doc_id long, palabras long, listadas long, elementos long, " + ", ".join(f"{x} long" for x in names))


def pages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = 0.5, least: int = 6) -> DataFrame:
    """Every page with its non-prose word share and the verdict ``relleno``."""
    feats = stage(featured(docs, doc_id, text), "lines")
    p = labelled(feats, train(feats))
    part = F.when(F.col("palabras") > 0, F.col("listadas") / F.col("palabras")).otherwise(F.lit(0.0))
    return p.withColumn("parte", part).withColumn("relleno", (F.col("parte") > share) & (F.col("elementos") >= least))
