"""Toxicity by a factorization machine over hashed terms.

Terms are the words of a text and their beginnings of 4 to 6 letters, hashed.  The score is the logistic of a bias, a weight
per term present, and for each pair of terms present the product of their factor vectors: what two terms mean together (an
insult with a group mention, say) that neither means alone.  The sum over pairs is divided by the root of the number of distinct
words, since a long text has so many more pairs than words.

Fitting uses a bounded sample of the labelled documents, ``max_positive`` and ``max_negative`` of them by the order of a hash of
their ids, one text of each id; a class that is sampled counts as much as all of it.  Every term of ``min_docs`` sampled documents or
more takes part, whatever it tells alone: the rows are sparse, fitted in small batches.  So the driver holds the terms of at most
16,000 documents and a model of at most ``BUCKETS`` terms.  Scoring reads every whole text of every document.

Held-out rows (crc32 of the id as text, modulo 5, is 0) are never learned from.  Labels that are null are left out; of several
labels of one document the largest holds; of several texts of one id the first in order is learned from, all are scored.  Missing and
empty texts score like a text without terms.  Without labels of both classes all scores are the share of positives (0 without
labels).  Very long texts are scored whole, by their distinct words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from graticule.llm.common import fold, ids_and_texts
from graticule.session import cut_lineage

BUCKETS = 1 << 22
_WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
REMEMBER = 200_000


def term_ids(word: str) -> list[int]:
    """Hashed terms of one lower-case word: itself and its beginnings."""
    terms = [word, *(f"^{word[:n]}" for n in PREFIXES if len(word) >= n)]
    return [xxhash.xxh64_intdigest(t, 1) % BUCKETS for t in terms]


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every run, one run after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


class FactorizationMachine:
    """Presence of sparse terms, log loss, AdaGrad in batches of a fixed order: the same result at every run.

    Weights are drawn to zero by their size (``sparse``), factor vectors to where they started by their distance (``pairs``), so that
    rare terms do not learn single documents by heart.  Vectors start to move after ``alone`` of the ``epochs``.  Terms that did not
    move at all say nothing and leave the model when it is fitted.
    """

    def __init__(self, terms: np.ndarray, bias: float, factors: int = 4, spread: float = 0.03, seed: int = 1):
        self.terms = np.asarray(terms, np.int64)  # ascending
        self._number: dict[int, int] | None = None
        self.b = float(bias)
        self.w = np.zeros(len(terms), np.float32)
        self.v = np.random.default_rng(seed).normal(0, spread, (len(terms), factors)).astype(np.float32)

    def places(self, terms: list[int]) -> list[int]:
        """Where terms are in the model; those it does not know are left out."""
        if self._number is None:
            self._number = {t: i for i, t in enumerate(self.terms.tolist())}
        return [i for t in terms if (i := self._number.get(t, -1)) >= 0]

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_number": None}  # made anew where it is used

    def logits(self, starts: np.ndarray, features: np.ndarray, words: np.ndarray) -> np.ndarray:
        """One number per row; row i has the features from ``starts[i]`` to ``starts[i + 1]`` and so many distinct ``words``."""
        lengths = np.diff(starts)
        rows = np.repeat(np.arange(len(lengths)), lengths)
        total = lambda x: np.bincount(rows, x, len(lengths))
        v = self.v[features]
        together = sum(total(v[:, f]) ** 2 - total(v[:, f] ** 2) for f in range(v.shape[1]))
        return self.b + total(self.w[features]) + 0.5 * together / np.sqrt(np.maximum(words, 1))

    def fit(
        self, starts: np.ndarray, features: np.ndarray, words: np.ndarray, y: np.ndarray, weight: np.ndarray,
        epochs: int = 10, alone: int = 5, batch: int = 128, rate: float = 0.3, sparse: float = 1e-3, pairs: float = 1e-3, damp: float = 1e-2, seed: int = 2,
    ) -> FactorizationMachine:
        n, m = len(y), len(self.w)
        rng = np.random.default_rng(seed)
        seen = [damp, np.full(m, damp), np.full(m, damp)]
        start = self.v.copy()
        scale, last, now = weight / weight.mean(), np.zeros(m, np.int64), 0
        for epoch in range(epochs):
            order = rng.permutation(n)
            for at in range(0, n, batch):
                chosen = order[at:at + batch]
                lengths = starts[chosen + 1] - starts[chosen]
                flat = features[_spread(starts[chosen], lengths)]
                rows = np.repeat(np.arange(len(chosen)), lengths)
                z = self.logits(np.concatenate([[0], np.cumsum(lengths)]), flat, words[chosen])
                g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[chosen]) * scale[chosen] / len(chosen)).astype(np.float32)
                # Only the terms of the batch move.
                own, inside = np.unique(flat, return_inverse=True)
                each, v = g[rows], self.v[flat]
                paired = each / np.sqrt(np.maximum(words[chosen], 1))[rows]
                dw = np.bincount(inside, each, len(own)).astype(np.float32)
                dv = np.zeros((len(own), v.shape[1]), np.float32)
                for f in range(v.shape[1]):
                    mine = np.bincount(rows, v[:, f], len(chosen))[rows] - v[:, f]
                    dv[:, f] += np.bincount(inside, paired * mine, len(own))
                db = float(g.sum())
                seen[0] += db * db
                seen[1][own] += dw * dw
                self.b -= rate * db / np.sqrt(seen[0])
                # The penalties are due for every batch; they are paid when a term comes up.
                now += 1
                waited, last[own] = now - last[own], now
                step = rate / np.sqrt(seen[1][own])
                w = self.w[own] - step * dw
                self.w[own] = np.sign(w) * np.maximum(np.abs(w) - step * sparse * waited, 0)
                # Pairs explain what single terms leave unexplained: they wait until those are fitted.
                if epoch >= alone:
                    seen[2][own] += (dv * dv).mean(axis=1)
                    step = rate / np.sqrt(seen[2][own])
                    away = self.v[own] - start[own] - step[:, None] * dv
                    size = np.maximum(np.sqrt((away * away).sum(axis=1)), 1e-12)
                    self.v[own] = start[own] + away * np.maximum(1 - step * pairs * waited / size, 0)[:, None]
        learned = (self.w != 0) | (self.v != start).any(axis=1)
        self.terms, self.w, self.v, self._number = self.terms[learned], self.w[learned], self.v[learned], None
        return self

    def score(self, features: list[int], words: int) -> float:
        """One text, by the places of its terms in the model and the number of its distinct words."""
        v = self.v[features].astype(np.float64)
        z = self.b + float(self.w[features].sum(dtype=np.float64)) + 0.5 * float((v.sum(0) ** 2).sum() - (v ** 2).sum()) / max(words, 1) ** 0.5
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def training_rows(docs: DataFrame, labels: DataFrame, max_positive: int, max_negative: int) -> tuple[DataFrame, dict[int, int]]:
    """(toxic, words, terms) of a bounded sample of labelled documents that aren't held out, and how many of each class there are."""
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    known = known.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(fold(F.col("doc_id"), 5) != 0)
    known = cut_lineage(known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64("doc_id", F.lit(11))
    sample = known.where("toxic = 1").orderBy(order).limit(max_positive).union(known.where("toxic = 0").orderBy(order).limit(max_negative))

    def terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [words_of(t) for t in batch["text"]]
            yield pd.DataFrame({
                "toxic": batch["toxic"], "words": [len(w) for w in words], "terms": [sorted({i for w in ws for i in term_ids(w)}) for ws in words]})

    # The sample has a set number of (id, label) rows, so it is broadcast whatever the size of the corpus; an id's texts are
    # combined before they move.
    picked = ids_and_texts(docs).join(F.broadcast(cut_lineage(sample)), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return cut_lineage(picked.select("toxic", "text").mapInPandas(terms, "toxic int, words int, terms array<int>")), sizes


def fit(
    docs: DataFrame, labels: DataFrame, max_positive: int = 4000, max_negative: int = 12_000, min_docs: int = 4,
) -> FactorizationMachine:
    rows, sizes = training_rows(docs, labels, max_positive, max_negative)
    data = rows.toArrow()  # bounded: the terms of max_positive + max_negative documents
    y = data.column("toxic").to_numpy().astype(np.float32)
    words = data.column("words").to_numpy().astype(np.float32)
    sampled = {k: int((y == k).sum()) for k in (0, 1)}
    if not sampled[0] or not sampled[1]:
        return FactorizationMachine(np.zeros(0), 30.0 if sampled[1] else -30.0)
    chunks = [c for c in data.column("terms").chunks if len(c)]
    del data
    counts = np.zeros(BUCKETS, np.int32)
    for c in chunks:
        counts += np.bincount(c.flatten().to_numpy(), minlength=BUCKETS).astype(np.int32)
    terms = np.flatnonzero(counts >= min_docs)
    number = np.full(BUCKETS, -1, np.int32)
    number[terms] = np.arange(len(terms))
    features, lengths, marks = [], [], []
    for c in chunks:
        flat, ends = number[c.flatten().to_numpy()], np.concatenate([[0], np.cumsum(c.value_lengths().to_numpy())])
        for a, b in zip(ends, ends[1:]):
            own = flat[a:b]
            features.append(own[own >= 0])
            lengths.append(len(features[-1]))
            marks.append(xxhash.xxh64_intdigest(features[-1].tobytes()))
    # A sampled class stands for all of its documents, so that scores mean the same at every size of the table.
    weight = np.where(y == 1, sizes[1] / sampled[1], sizes[0] / sampled[0])
    share = float(weight @ y / weight.sum())
    # By a hash of their terms: whatever order the rows came in, the fit is the same.
    order = np.array(sorted(range(len(y)), key=lambda i: (marks[i], y[i])))
    starts = np.concatenate([[0], np.cumsum(np.array(lengths)[order])])
    model = FactorizationMachine(terms, np.log(share / (1 - share)))
    return model.fit(starts, np.concatenate([features[i] for i in order]), words[order], y[order], weight[order])


def scores(docs: DataFrame, model: FactorizationMachine) -> DataFrame:
    """(doc_id, score) of every whole text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            out = []
            for text in batch["text"]:
                features: set[int] = set()
                words = words_of(text)
                for word in words:
                    at = known.get(word)
                    if at is None:
                        if len(known) >= REMEMBER:
                            known.clear()
                        at = known[word] = tuple(model.places(term_ids(word)))
                    if at:
                        features.update(at)
                out.append(model.score(sorted(features), len(words)))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": out})

    return ids_and_texts(docs).mapInPandas(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = scores(docs, fit(docs, labels))
    return out.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
