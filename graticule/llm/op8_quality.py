"""Quality rules: counts of words, symbols and repeats, and compression bands.

A text is rejected for few words or many repeated three-word windows (base rules), or if zstandard shrinks it too well
(repetitive) or hardly at all (noise): the ratio of the whole text must lie in a band that depends on its length, and so must
that of most fixed-size chunks, which shows a repetitive or random part in an otherwise ordinary text.  Chunks are smaller, with
a band of their own, in short texts; the last one ends at the last byte and may overlap the one before.

Whole texts are read.  Lines part at \\n; equal means equal to the byte.  A missing or empty text has no words and is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.functions import pandas_udf

from graticule.llm.common import ids_and_texts

# Fixed values: (UTF-8 bytes up to, lowest ratio, highest ratio).  Short texts compress less, by the nature of the format.
BANDS = ((512, 0.34, 1.10), (2048, 0.27, 0.90), (16_384, 0.22, 0.80), (float("inf"), 0.18, 0.74))
CHUNK, CHUNK_BAND, BAD_CHUNKS = 4096, (0.22, 0.82), 0.3
# Fixed values for texts below CHUNK: (UTF-8 bytes up to, chunk, band).
SHORT_CHUNKS = ((2048, 512, (0.34, 0.88)), (CHUNK - 1, 1024, (0.27, 0.85)))
LEVEL = 3
SYMBOLS = "#*$%&|<>"
_SPACE = re.compile(r"[\x20\x09-\x0D]")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) >= 1 << 20:  # keep the product of three within 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(number) + ids[2:]
    _, where, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[where] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:shift + n - 2] |= again
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    seen, n = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\r\x0b\x0c"):
            n += line in seen
            seen.add(line)
    return n


def band(size: int) -> tuple[float, float]:
    return next((low, high) for upto, low, high in BANDS if size <= upto)


class Rules:
    def __init__(self):
        self.zstd = zstandard.ZstdCompressor(level=LEVEL)

    def ratio(self, data) -> float:
        return len(self.zstd.compress(data)) / len(data)

    def compression(self, data: bytes) -> tuple[float, float]:
        """Ratio of the whole and the share of chunks outside their band (0 if the text is shorter than a chunk)."""
        view = memoryview(data)
        size, (low, high) = next(((c, limits) for upto, c, limits in SHORT_CHUNKS if len(data) <= upto), (CHUNK, CHUNK_BAND))
        starts = [*range(0, len(data) - size + 1, size)]
        if starts and len(data) % size:
            starts.append(len(data) - size)
        bad = sum(not low <= self.ratio(view[at:at + size]) <= high for at in starts)
        return self.ratio(data), bad / len(starts) if starts else 0.0

    def measure(self, text: str | None) -> tuple:
        """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio, bad_chunks, kept)."""
        text = text or ""
        data = text.encode()
        words = data.split()
        n, repeats = len(words), repeated_words(words)
        failed = n < 50 or 100 * repeats > 50 * n
        ratio, bad = self.compression(data) if data else (None, None)
        kept = not failed and band(len(data))[0] <= ratio <= band(len(data))[1] and bad <= BAD_CHUNKS
        word_chars = len(text) - sum(map(text.count, " \t\n\r\x0b\x0c"))
        return n, word_chars, sum(map(text.count, SYMBOLS)), duplicate_lines(text), repeats, failed, ratio, bad, kept


COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, ratio double, bad_chunks double, kept boolean"


def quality(docs: DataFrame) -> DataFrame:
    """Per document all counts, both compression figures and the verdict."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rules = Rules()
        for batch in batches:
            out = pd.DataFrame([rules.measure(t) for t in batch["text"]], columns=[c.split()[0] for c in COLUMNS.split(", ")])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return ids_and_texts(docs).mapInPandas(run, "doc_id long, " + COLUMNS)


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, that pass every rule."""

    @pandas_udf("boolean")
    def passes(text: pd.Series) -> pd.Series:
        rules = Rules()
        return text.map(lambda t: rules.measure(t)[-1]).astype(bool)

    return docs.where(passes(docs["text"].cast("string")))
