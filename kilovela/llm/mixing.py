"""Mixing sources to target token weights with soft membership.

A classifier fitted on labelled rows gives every document without a (known) source posteriors over the sources; labelled
documents belong to their source; in a thread the labels of the other documents count as evidence, by how often two of a thread
agree. Each document gets a rate between 0 and the repeats its source allows; projected gradient
least squares brings the expected tokens per source, sum of rate * tokens * membership, to the targets. Rates become whole
copies by hash rounding, so a document is never used more often than allowed.

Scale: one pass counts tokens and memberships and stages a narrow table; every gradient step is one aggregate of six
sums over it, in which a document's rate is recomputed from the few past step vectors instead of being stored. Only the sums
reach the driver. No step groups by source in a shuffle key, so a source with most of the rows costs nothing extra.

Bound: the classifier is fitted on at most ``sample`` labelled documents (hash sample, default 20,000) of which a fifth
is held out for its temperature; everything else covers all documents.

Defined results: NULL and empty texts have no tokens and are never used; sources without a target are not used; a target
whose source has no tokens at all is reported with share 0 and the other targets are scaled up; repeated rows are
documents of their own; documents of equal posteriors go to the first source in name order for their cap.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

from typing import TYPE_CHECKING

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilovela.session import join_small, stage

if TYPE_CHECKING:
    import tiktoken

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
BUCKETS = 1 << 14
WORD = re.compile(r"[^\W_]+")
# Fixed value: the splitting pattern that belongs to the public byte-level vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def tokenizer(path: str) -> tiktoken.Encoding:
    import tiktoken  # here, so that the other problems do not need it

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def n_tokens(texts: Iterator[str | None], path: str) -> list[int]:
    enc = tokenizer(path)
    return [len(enc.encode_ordinary(t)) if t else 0 for t in texts]


def _features(text: str) -> np.ndarray:
    """Hashed word buckets, each once."""
    import xxhash

    return np.unique(np.fromiter((xxhash.xxh32_intdigest(w) % BUCKETS for w in set(WORD.findall(text.lower()))), dtype=np.int64))


class Classifier:
    """Naive Bayes over hashed words; the evidence is tempered so that posteriors are calibrated, not extreme."""

    def __init__(self, sources: list[str], texts: list[str], labels: list[str], smooth: float = 10.0):
        self.sources = sources
        at = {s: i for i, s in enumerate(sources)}
        n = np.zeros((len(sources), BUCKETS))
        docs = np.zeros(len(sources))
        held: list[tuple[np.ndarray, int]] = []
        for k, (t, s) in enumerate(zip(texts, labels, strict=True)):
            f = _features(t)
            if k % 5 == 4:
                held.append((f, at[s]))
            else:
                n[at[s], f] += 1
                docs[at[s]] += 1
        # shares are smoothed towards those of all documents, so rare words do not favour small sources; a source without
        # documents has no posterior
        back = (n.sum(0) + 0.5) / (docs.sum() + 1)
        self.like = np.log((n + smooth * back) / (docs[:, None] + smooth))
        with np.errstate(divide="ignore"):
            self.prior = np.log(docs / docs.sum()) if docs.sum() else np.full(len(sources), -np.log(len(sources)))
        self.heat = 0.0
        best = np.inf
        for heat in (0.0, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7, 1.0):
            loss = -sum(self._log(f, heat)[y] for f, y in held)
            if loss < best:
                best, self.heat = loss, heat

    def _log(self, f: np.ndarray, heat: float) -> np.ndarray:
        x = self.prior + heat * self.like[:, f].sum(1)
        x = x - x.max()
        return x - np.log(np.exp(x).sum())

    def posterior(self, text: str | None) -> np.ndarray:
        return np.exp(self._log(_features(text or ""), self.heat))


def fit_classifier(docs: DataFrame, sources: list[str], doc_id: str, text: str, source: str, sample: int) -> Classifier:
    """Classifier from the ``sample`` labelled documents of smallest hash, whatever their partitions."""
    mixed = F.xxhash64(F.lit("muestra"), doc_id)
    labelled = docs.where(F.col(source).isin(sources) & F.col(text).isNotNull()).select(doc_id, text, source, mixed.alias("_h"))
    share = sample / max(labelled.count(), 1)
    if share < 0.5:  # twice as many as needed are sorted, not all
        labelled = labelled.where(F.col("_h").cast("double") / 2.0**63 < 4 * share - 1)
    rows = labelled.orderBy("_h", doc_id).limit(sample).toPandas().sort_values(doc_id)
    return Classifier(sources, rows[text].tolist(), rows[source].tolist())


def with_neighbours(p: np.ndarray, near: np.ndarray | None, agree: float) -> np.ndarray:
    """Posterior after the labels of the thread's other documents: each agrees with the document's own source by the chance ``agree``."""
    if near is None or len(p) < 2:
        return p
    n = np.asarray(near, dtype=float)
    x = np.log(np.maximum(p, 1e-300)) + n * np.log(agree) + (n.sum() - n) * np.log((1 - agree) / (len(p) - 1))
    x = np.where(p > 0, np.exp(x - x[p > 0].max()), 0.0) if (p > 0).any() else p
    return x / x.sum() if x.sum() else p


def _with_thread(base: DataFrame, names: list[str]) -> tuple[DataFrame, float]:
    """Adds ``near``, how many labelled documents of each source a document's thread has (NULL for labelled documents and where there
    are none), and gives the chance that two labelled documents of a thread agree. Labels are counted per thread and source with a
    map-side combine; only threads with a document that lacks its source are joined."""
    count = [F.count_if(F.col("source") == n).alias(f"n{i}") for i, n in enumerate(names)]
    per = stage(base.groupBy("_thread").agg(*count, F.count_if(F.col("source").isNull()).alias("open")), "threads")
    n = sum((F.col(f"n{i}") for i in range(len(names))), F.lit(0))
    same = sum((F.col(f"n{i}") * (F.col(f"n{i}") - 1) for i in range(len(names))), F.lit(0))
    r = per.agg(F.sum(same).alias("same"), F.sum(n * (n - 1)).alias("pairs")).first()  # two numbers
    agree = ((r["same"] or 0) + 1) / ((r["pairs"] or 0) + 2)
    votes = per.where((F.col("open") > 0) & (n > 0)).select("_thread", F.array(*[F.col(f"n{i}") for i in range(len(names))]).alias("near"))
    j = join_small(base, votes, ["_thread"], "left", salt_of="doc_id")
    return j.withColumn("near", F.when(F.col("source").isNull(), F.col("near"))), agree


def weighed(docs: DataFrame, targets: DataFrame, tokenizer_dir: str = TOKENIZERS, vocabulary: str = VOCABULARY, sample: int = 20_000, doc_id: str = "doc_id", text: str = "text", source: str = "source", parent: str | None = None) -> tuple[DataFrame, list[tuple[str, float, int]]]:
    """(doc_id, source, tokens, p, cap) per document with tokens, staged, and the targets [(source, share, max_repeats)]. With ``parent``
    (the column that names a reply's first document) the labels of a document's thread are evidence too."""
    goals = sorted((r["source"], float(r["target_share"] or 0), int(r["max_repeats"] or 0)) for r in targets.where("source is not null").collect())  # one row per source
    names = [g[0] for g in goals]
    model = docs.sparkSession.sparkContext.broadcast(fit_classifier(docs, names, doc_id, text, source, sample))
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"), F.coalesce(F.col(parent or doc_id), F.col(doc_id)).cast("long").alias("_thread"))
    base, agree = _with_thread(base, names) if parent else (base.withColumn("near", F.lit(None).cast("array<long>")), 0.5)
    path, caps = f"{tokenizer_dir}/{vocabulary}", np.array([g[2] for g in goals])
    at = {s: i for i, s in enumerate(names)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = np.eye(len(names)).tolist()
        for b in batches:
            p, cap = [], []
            for s, t, near in zip(b["source"], b["text"], b["near"], strict=True):
                if s in at:
                    p.append(one[at[s]])
                    cap.append(int(caps[at[s]]))
                elif s is None:
                    q = with_neighbours(model.value.posterior(t), near, agree)
                    p.append(q.tolist())
                    cap.append(int(caps[int(q.argmax())]))
                else:
                    p.append([0.0] * len(names))
                    cap.append(0)
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "tokens": n_tokens(b["text"], path), "p": p, "cap": cap})

    out = base.drop("_thread").mapInPandas(run, "doc_id long, source string, tokens long, p array<double>, cap int")
    return stage(out.where("tokens > 0"), "weighed"), goals


def _dot(p: Column, g: list[float]) -> Column:
    return sum((p[i] * F.lit(float(x)) for i, x in enumerate(g)), F.lit(0.0))


def rate(steps: list[list[float]]) -> Column:
    """A document's rate after the steps: each moves it along its membership and projects it back into [0, cap]."""
    r = F.lit(0.0)
    for g in steps:
        r = F.least(F.greatest(r - _dot(F.col("p"), g), F.lit(0.0)), F.col("cap").cast("double"))
    return r


def copies(steps: list[list[float]]) -> Column:
    """Whole copies: the rate plus a hash in [0, 1), rounded down, so totals are right on average and caps hold."""
    u = F.pmod(F.xxhash64(F.lit("mezcla"), "doc_id"), F.lit(1 << 30)).cast("double") / (1 << 30)
    return F.least(F.floor(rate(steps) + u).cast("int"), F.col("cap"))


def fit_rates(w: DataFrame, goals: list[tuple[str, float, int]], total: float | None = None, rounds: int = 25, tol: float = 1e-4, polish: int = 4) -> tuple[list[list[float]], float]:
    """Step vectors of the projected gradient, and the size of the mixture in tokens.

    Without ``total`` the mixture is as large as all targets allow together. Steps are scaled by each source's tokens (a
    diagonal preconditioner), so a source that binds nothing converges in a few steps. The last ``polish`` steps take the
    totals of the whole copies instead of those of the rates, which removes what rounding has left.
    """
    k = len(goals)
    mass = [F.sum(F.col("tokens") * F.col("p")[i]).alias(f"m{i}") for i in range(k)]
    room = [F.sum(F.col("tokens") * F.col("p")[i] * F.col("cap")).alias(f"c{i}") for i in range(k)]
    row = w.agg(*mass, *room).first()
    m = np.array([row[f"m{i}"] or 0.0 for i in range(k)])
    c = np.array([row[f"c{i}"] or 0.0 for i in range(k)])
    q = np.array([g[1] if c[i] > 0 else 0.0 for i, g in enumerate(goals)])
    if not q.sum():
        return [], 0.0
    q = q / q.sum()
    size = total or float(min(c[i] / q[i] for i in range(k) if q[i] > 0))
    steps: list[list[float]] = [(-(q * size) / np.maximum(m, 1.0)).tolist()]
    for k_round in range(rounds + polish):
        exact = k_round < rounds
        got = w.withColumn("_use", rate(steps) if exact else copies(steps)).agg(*[F.sum(F.col("_use") * F.col("tokens") * F.col("p")[i]).alias(f"g{i}") for i in range(k)]).first()
        g = np.array([got[f"g{i}"] or 0.0 for i in range(k)])
        miss = g - q * (size if exact else g.sum())
        if exact and np.abs(miss).max() <= tol * size:
            rounds = k_round + 1  # settled: the rest is polish
            continue
        if not exact and (k_round >= rounds + polish or np.abs(miss).max() <= 10 * tol * size):
            break
        steps.append((miss / np.maximum(m, 1.0)).tolist())
    return steps, size


def mixture(docs: DataFrame, targets: DataFrame, total: float | None = None, **kw) -> tuple[DataFrame, list[tuple[str, float, int]]]:
    """(doc_id, source, asignada, tokens, tasa, copias) of every document with tokens, and the targets."""
    w, goals = weighed(docs, targets, **kw)
    steps, _ = fit_rates(w, goals, total)
    names = F.array(*[F.lit(g[0]) for g in goals])
    first = F.when(F.array_max("p") > 0, F.element_at(names, F.array_position("p", F.array_max("p")).cast("int")))
    return w.select("doc_id", "source", first.alias("asignada"), "tokens", rate(steps).alias("tasa"), copies(steps).alias("copias"), "cap", "p"), goals


def shares(mix: DataFrame, goals: list[tuple[str, float, int]]) -> DataFrame:
    """Report per source: target, documents used and their tokens by first source, the share of tokens by first source (``parte``) and
    by membership (``parte_esperada``, what the rates are fitted to), and the most copies of one document."""
    spark = mix.sparkSession
    want = spark.createDataFrame([(g[0], g[1], g[2], i) for i, g in enumerate(goals)], "source string, objetivo double, max_repeats int, i int")
    weight = F.col("tokens") * F.col("copias")
    used = mix.groupBy(F.col("asignada").alias("source")).agg(F.count_if(F.col("copias") > 0).alias("documentos"), F.sum(weight).alias("tokens_usados"), F.max("copias").alias("mas_copias"))
    total = mix.agg(F.sum(weight).alias("_t"), F.max(F.when(F.col("copias") > 0, F.col("tokens"))).alias("_g"), F.array(*[F.sum(weight * F.col("p")[i]) for i in range(len(goals))]).alias("_m"))
    j = want.join(used, "source", "left").crossJoin(F.broadcast(total))  # one row
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    share = lambda x: F.when(F.col("_t") > 0, x / F.col("_t")).otherwise(F.lit(0.0))
    return j.select("source", "objetivo", zero("documentos").alias("documentos"), zero("tokens_usados").alias("tokens_usados"), share(zero("tokens_usados")).alias("parte"), share(F.get("_m", F.col("i"))).alias("parte_esperada"), share(zero("_g")).alias("mayor_documento"), zero("mas_copias").alias("mas_copias"), "max_repeats")
