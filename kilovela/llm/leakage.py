"""Passages of held-out items inside a training corpus, by a generalised suffix automaton over words.

The automaton holds every word sequence of every item. A document is streamed through it once, word by word: the state and
the length of the longest match ending here follow from those of the word before, so work is linear in the text and no
shingles are stored or shuffled. Where the match reaches ``least`` words, the state's ancestor of exactly that length names
the items that contain those words.

Items are a stated query set read in blocks of about ``block`` words, one automaton and one pass per block, so the size of an
automaton sent to the executors is bounded however many and however long the items are; an item of more words is read in
pieces that overlap by ``least`` - 1 words, so that no passage is lost at a border. No row of the corpus is ever shuffled for the
search; a hot author or source changes nothing. To scrub, the spans of all blocks are found in the original text, merged, and
cut once by their places in it, so the result does not depend on the blocks.

Words are runs of letters and digits after canonical decomposition, with combining marks dropped and case folded; anything
else only separates. Defined results: NULL or empty texts and items match nothing; items of fewer than ``least`` words can
never leak; repeated rows are each judged; equal items are all named; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilovela.session import join_small, stage

WORD = re.compile(r"[^\W_]+")
MARKS = re.compile(r"[̀-ͯ᪰-᫿᷀-᷿⃐-⃿︠-︯]")


def fold(text: str) -> str:
    if not text.isascii():
        text = MARKS.sub("", unicodedata.normalize("NFD", text))
    return text.casefold() if not text.isascii() else text.lower()


def words(text: str | None) -> list[str]:
    return WORD.findall(fold(text)) if text else []


def placed(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The same words and where each stands in the original text: characters are folded one by one, and combining marks belong to the
    word they follow."""
    if text.isascii():
        found = list(WORD.finditer(text.lower()))
        return [m.group() for m in found], [m.span() for m in found]
    folded, at = [], []
    for i, c in enumerate(text):
        f = c.lower() if c.isascii() else MARKS.sub("", unicodedata.normalize("NFD", c)).casefold()
        folded.append(f)
        at += [i] * len(f)
    ws, spans = [], []
    for m in WORD.finditer("".join(folded)):
        a, b = at[m.start()], at[m.end() - 1] + 1
        while b < len(text) and not folded[b]:  # marks behind the last letter
            b += 1
        ws.append(m.group())
        spans.append((a, b))
    return ws, spans


class Automaton:
    """Generalised suffix automaton of word lists; ``anchor[s]`` is the ancestor-or-self of state ``s`` that covers length
    ``least`` (or -1), ``items[a]`` the ids of the items that contain an anchor's words."""

    def __init__(self, texts: list[tuple[int, list[str]]], least: int):
        self.least, self.vocab = least, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        own: list[set[int]] = [set()]
        for item, ws in texts:
            last = 0
            for w in ws:
                last = self._extend(last, self.vocab.setdefault(w, len(self.vocab)), own)
                own[last].add(item)
        self._finish(own)

    def _state(self, length: int, own: list[set[int]]) -> int:
        self.next.append({})
        self.link.append(0)
        self.len.append(length)
        own.append(set())
        return len(self.len) - 1

    def _split(self, p: int, c: int, own: list[set[int]]) -> int:
        """The state reached from p by c whose longest word is one longer than p's: the one there, or a copy of it."""
        q = self.next[p][c]
        if self.len[q] == self.len[p] + 1:
            return q
        twin = self._state(self.len[p] + 1, own)
        self.next[twin] = dict(self.next[q])
        self.link[twin], self.link[q] = self.link[q], twin
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin

    def _extend(self, last: int, c: int, own: list[set[int]]) -> int:
        if c in self.next[last]:  # an earlier item has this prefix
            return self._split(last, c, own)
        cur, p = self._state(self.len[last] + 1, own), last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        self.link[cur] = 0 if p == -1 else self._split(p, c, own)
        return cur

    def _finish(self, own: list[set[int]]) -> None:
        order = sorted(range(1, len(self.len)), key=self.len.__getitem__)
        self.anchor = [-1] * len(self.len)
        for s in order:
            if self.len[s] >= self.least:
                up = self.link[s]
                self.anchor[s] = s if self.len[up] < self.least else self.anchor[up]
        self.items: dict[int, set[int]] = {}
        for s in order:
            if self.anchor[s] >= 0:
                self.items.setdefault(self.anchor[s], set()).update(own[s])

    def scan(self, ws: list[str]) -> tuple[set[int], list[tuple[int, int]]]:
        """Items found, and the maximal matched spans (from, to) of word positions, to exclusive."""
        state, length, found, spans = 0, 0, set(), []
        nxt, link, ln, vocab, least, anchor = self.next, self.link, self.len, self.vocab, self.least, self.anchor
        for i, w in enumerate(ws):
            c = vocab.get(w)
            if c is None:
                state = length = 0
                continue
            to = nxt[state].get(c)
            if to is None:
                while state > 0 and to is None:
                    state = link[state]
                    to = nxt[state].get(c)
                length = ln[state]
                if to is None:
                    state = length = 0
                    continue
            state, length = to, length + 1
            if length >= least:
                found |= self.items[anchor[state]]
                if spans and spans[-1][1] > i - length:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((i + 1 - length, i + 1))
        return found, spans


def automata(items: DataFrame, item_id: str, text: str, least: int, block: int = 2_000_000) -> Iterator[Automaton]:
    """One automaton per block of about ``block`` words of the items, in the order of their ids."""
    rows = items.where(F.col(text).isNotNull() & F.col(item_id).isNotNull()).select(F.col(item_id).cast("long"), text).orderBy(item_id).toLocalIterator()
    part: list[tuple[int, list[str]]] = []
    size, most = 0, max(block, least)
    for r in rows:
        ws = words(r[1])
        for a in range(0, max(1, len(ws) - least + 1), most - least + 1):
            piece = ws[a : a + most]
            if part and size + len(piece) > most:
                yield Automaton(part, least)
                part, size = [], 0
            part.append((r[0], piece))
            size += len(piece)
    if part:
        yield Automaton(part, least)


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", least: int = 12, block: int = 2_000_000) -> DataFrame:
    """(doc_id, item_id): the document's text contains at least ``least`` successive words of the item's text."""
    base = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t"))
    out, blocks = None, 0
    for a in automata(items, item_id, item_text, least, block):
        blocks += 1
        shared = docs.sparkSession.sparkContext.broadcast(a)  # of `block` words

        def find(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            auto = shared.value
            for b in batches:
                hits = [(d, i) for d, t in zip(b["doc_id"].tolist(), b["t"].tolist(), strict=True) for i in sorted(auto.scan(words(t))[0])]
                if hits:
                    yield pd.DataFrame(hits, columns=["doc_id", "item_id"])

        part = base.mapInPandas(find, "doc_id long, item_id long").withColumn("_block", F.lit(blocks))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long")
    return _once(out) if blocks > 1 else out.drop("_block")


def _once(pairs: DataFrame) -> DataFrame:
    """An item read in pieces may be found in two blocks; a document listed twice is judged twice, so pairs are kept as often as the
    block that finds them most often does."""
    per = pairs.groupBy("doc_id", "item_id", "_block").agg(F.count("*").alias("n"))
    most = per.groupBy("doc_id", "item_id").agg(F.max("n").cast("int").alias("n"))
    return most.select("doc_id", "item_id", F.explode(F.array_repeat(F.lit(1), F.col("n")))).select("doc_id", "item_id")


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans of the same words, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _cut(text: str, at: list[tuple[int, int]], spans: list[tuple[int, int]]) -> str:
    """Text without the words of the spans; ``at`` tells where in the text each word stands."""
    keep, last = [], 0
    for a, b in spans:
        keep.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return "".join([*keep, text[last:]])


def scrub(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", least: int = 12, max_share: float = 0.5, block: int = 2_000_000) -> DataFrame:
    """(doc_id, palabras, filtradas, descartado, texto): texts with every matched span of ``least`` words or more removed; a
    document whose matched words exceed ``max_share`` of its words is discarded whole (``texto`` NULL). Documents without a
    match are not listed. With several item blocks each finds its spans, and the last step cuts them together."""
    base = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("texto"))
    parts = []
    for a in automata(items, item_id, item_text, least, block):
        shared = docs.sparkSession.sparkContext.broadcast(a)  # of `block` words

        def mark(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            auto = shared.value
            for b in batches:
                found = [[x for span in auto.scan(placed(t)[0])[1] for x in span] for t in b["texto"]]
                hit = b[[bool(f) for f in found]]
                yield hit.assign(tramos=pd.Series([f for f in found if f], index=hit.index, dtype=object))

        parts.append(base.mapInPandas(mark, "doc_id long, texto string, tramos array<int>"))
    if not parts:
        parts = [base.limit(0).withColumn("tramos", F.array().cast("array<int>"))]
    if len(parts) == 1:
        cur = parts[0]
    else:
        # equal documents have equal spans, so spans are gathered per document and text, and repeated rows find them again
        key = lambda df: df.withColumns({"_h": F.xxhash64("texto"), "_n": F.length("texto")})
        spans = reduce(DataFrame.unionByName, [key(p).select("doc_id", "_h", "_n", "tramos") for p in parts]).distinct()
        spans = spans.groupBy("doc_id", "_h", "_n").agg(F.flatten(F.collect_list("tramos")).alias("tramos"))  # at most a list per block
        cur = join_small(key(base), stage(spans, "spans"), ["doc_id", "_h", "_n"], "inner").select("doc_id", "texto", "tramos")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for d, t, s in zip(b["doc_id"].tolist(), b["texto"].tolist(), b["tramos"], strict=True):
                s = list(s)
                spans = _joined(list(zip(s[::2], s[1::2], strict=True)))
                at = placed(t)[1]
                rows.append((d, len(at), sum(y - x for x, y in spans), _cut(t, at, spans)))
            yield pd.DataFrame(rows, columns=["doc_id", "palabras", "filtradas", "texto"])

    done = cur.mapInPandas(cut, "doc_id long, palabras long, filtradas long, texto string")
    gone = F.col("filtradas") > F.col("palabras") * max_share
    return done.select("doc_id", "palabras", "filtradas", gone.alias("descartado"), F.when(~gone, F.col("texto")).alias("texto"))
