"""Language ID by nearest centroid: TF-IDF vectors of letter n-grams, several centroids per language, cosine, rejection.

A text becomes counts of its letters, letter pairs and letter triples (within and at the edges of words, lower-cased), hashed to
a fixed number of places; damped, weighted by inverse document frequency and normalised.  Each language has up to ``CLUSTERS``
centroids, found by spherical k-means.  A text gets the language of the nearest centroid by cosine; ``rejected`` says that it is
farther from it than all but a few of the texts the centroid was made of, by a margin.

Fitting uses at most ``max_per_language`` documents (by the order of a hash of their ids) of every language, however many there
are, one text of each id.  Centroids are found per language in tasks; the driver gets centroids, not rows: at most 64 KB a language.
Prediction reads every whole text.  Rows whose id has crc32 modulo 4 = 2, and rows without an id, are never learned from.  A missing text, or one without a letter, is ``und`` with score 0; so is every text if there was nothing to learn.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from graticule.llm.common import fold, ids_and_texts, whole_text
from graticule.session import cut_lineage, small_enough_to_broadcast

PLACES = 4096
CLUSTERS = 4
PIECE = 1 << 20
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts over the hashed places, or None for a text without a letter; long texts go through in pieces that overlap."""
    if not text:
        return None
    counts, any_letter = np.zeros(PLACES, np.float32), False
    for at in range(0, len(text), PIECE):
        codes = np.frombuffer((" " + text[at:at + PIECE + 2].lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
        known = _letters()[codes]
        any_letter |= bool(known.any())
        a = np.where(known, codes, 32).astype(np.uint32)
        two = a[:-1] * np.uint32(40503) + a[1:] * np.uint32(2654435761)
        three = two[:-1] * np.uint32(69069) + a[2:] * np.uint32(2246822519)
        inner = known[1:-1]  # no grams around white space alone
        for h, keep in ((a * np.uint32(3266489917), known), (two, known[:-1] | known[1:]), (three, inner)):
            counts += np.bincount((h[keep] * np.uint32(374761393)) >> np.uint32(20), minlength=PLACES)
    return counts if any_letter else None


class Centroids:
    def __init__(self, languages: list[str], idf: np.ndarray, vectors: np.ndarray, owners: np.ndarray, floors: np.ndarray):
        self.languages, self.idf, self.vectors, self.owners, self.floors = languages, idf, vectors, owners, floors

    def predict(self, counts: list[np.ndarray | None]) -> list[tuple[str, float, bool]]:
        """(language, cosine, rejected) per text."""
        out = [(UNKNOWN, 0.0, True)] * len(counts)
        rows = [i for i, c in enumerate(counts) if c is not None]
        if rows and len(self.languages):
            near = weigh(damped(np.stack([counts[i] for i in rows])), self.idf) @ self.vectors.T
            best = near.argmax(1)
            for i, b, s in zip(rows, best, near[np.arange(len(rows)), best]):
                out[i] = (self.languages[self.owners[b]], float(min(1.0, max(0.0, s))), bool(s < self.floors[b]))
        return out


def damped(counts: np.ndarray) -> np.ndarray:
    """Counts as they are learned from and compared: logarithms in 16 bits."""
    return np.log1p(counts).astype(np.float16)


def weigh(logs: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = logs.astype(np.float32) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 15) -> tuple[np.ndarray, np.ndarray]:
    """Centroids and the nearest one of each row; starts from the mean direction, then from rows far from all before."""
    start = [x.mean(0)]
    while len(start) < k:
        start.append(x[(x @ np.stack(start).T).max(1).argmin()])
    c = np.stack(start)
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        c = np.stack([x[own == j].mean(0) if (own == j).any() else c[j] for j in range(k)])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c, (x @ c.T).argmax(1)


def sample(docs: DataFrame, max_per_language: int) -> DataFrame:
    """(lang, text) of the rows to learn from."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["lang"].cast("string").alias("lang"), whole_text(docs).alias("text"))
    rows = rows.where(F.col("lang").isNotNull()).where(fold(F.col("doc_id"), 4) != 2)
    # The least hashes of a language are picked.  Only hashes below a bound of some times as many rows are shuffled, so a
    # common language is no hot key; the bound is known from the counts.
    # An id counts once, with one text, however often it is repeated.
    sizes = small_enough_to_broadcast(cut_lineage(rows.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n"))))
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    ids = rows.where(F.col("doc_id").isNotNull()).select("doc_id", "lang", F.xxhash64("doc_id", F.lit(5)).alias("h")).join(sizes, "lang")
    ids = ids.where(F.col("h") / F.lit(2.0**64) + 0.5 <= (3 * max_per_language + 100) / F.col("n")).distinct()
    chosen = ids.withColumn("r", F.row_number().over(order)).where(F.col("r") <= max_per_language).select("doc_id", "lang")
    return rows.join(small_enough_to_broadcast(cut_lineage(chosen)), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(
        F.min("text").alias("text")).select("lang", "text")


def fit(docs: DataFrame, max_per_language: int = 800, clusters: int = CLUSTERS, margin: float = 0.6) -> Centroids:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(lang, c) for lang, c in zip(batch["lang"], map(ngram_counts, batch["text"])) if c is not None]
            yield pd.DataFrame([(lang, damped(c).tobytes()) for lang, c in found], columns=["lang", "counts"])

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, seen = 0, np.zeros(PLACES, np.int64)
        for batch in batches:
            for c in batch["counts"]:
                seen += np.frombuffer(c, np.float16) > 0
                n += 1
        yield pd.DataFrame({"place": np.arange(-1, PLACES), "n": [n, *seen]})

    learned = cut_lineage(sample(docs, max_per_language).mapInPandas(count, "lang string, counts binary"))
    seen = np.zeros(PLACES + 1, np.int64)
    for r in learned.select("counts").mapInPandas(present, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        seen[r["place"] + 1] = r["n"]
    if not seen[0]:
        return Centroids([], np.ones(PLACES), np.zeros((0, PLACES)), np.zeros(0, int), np.zeros(0))
    idf = (np.log((1 + seen[0]) / (1 + seen[1:])) + 1).astype(np.float32)

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        x = weigh(np.stack([np.frombuffer(c, np.float16) for c in sorted(group["counts"])]), idf)
        c, own = spherical_kmeans(x, min(clusters, len(x)))
        near = (x * c[own]).sum(1)
        floors = [margin * float(np.quantile(near[own == j], 0.01)) if (own == j).any() else 0.0 for j in range(len(c))]
        return pd.DataFrame({
            "lang": group["lang"].iloc[0], "j": np.arange(len(c)), "vector": [v.astype(np.float32).tobytes() for v in c], "floor": floors})

    found = cut_lineage(learned.groupBy("lang").applyInPandas(centroids, "lang string, j int, vector binary, floor double"))
    parts = sorted(found.toLocalIterator(), key=lambda r: (r["lang"], r["j"]))  # up to CLUSTERS vectors a language
    languages = sorted({r["lang"] for r in parts})
    place = {lang: i for i, lang in enumerate(languages)}
    vectors = np.stack([np.frombuffer(r["vector"], np.float32) for r in parts])
    return Centroids(languages, idf, vectors, np.array([place[r["lang"]] for r in parts]), np.array([r["floor"] for r in parts]))


def predictions(docs: DataFrame, model: Centroids) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every whole text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame(model.predict([ngram_counts(t) for t in batch["text"]]), columns=["lang_pred", "score", "rejected"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return ids_and_texts(docs).mapInPandas(run, "doc_id long, lang_pred string, score double, rejected boolean")


def languages(docs: DataFrame) -> DataFrame:
    out = predictions(docs, fit(docs))
    return out.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")
