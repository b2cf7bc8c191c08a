"""Byte-pair encoding and decoding, with a segment tree over the ranks of adjacent pairs.

A piece starts as one symbol per byte.  Leaf i of the tree holds the rank of the pair (symbol i, its right neighbour), an inner node the
least of its leaves with its place, so the root names the leftmost of the pairs of lowest rank.  That pair is merged, which
changes three leaves: the pair itself, the one before and the one that is gone; each is a path to the root.  It ends when the root
holds no pair.  A piece of n bytes takes O(n log n) steps, also where a text is one run of letters without white space.

The vocabulary file gives symbols, merges and word ends.  How a text becomes pieces (normal form, lower case, pattern) is the file's
too: plain texts are cut by the same pattern written out (``encoding.plain_pieces``), others by the library's own normalizer and
cutter.  Strings of special tokens in a text become their ids, as in the library's call with its standard settings; with
``special=False`` they are ordinary text.

Rows stay where they are: one pass over the texts, no exchange.  A worker remembers the ids of the pieces it met, a bounded number.

Defined results: a missing or empty text, or one of white space only, has no ids, and decodes to the empty text.  Ids beyond the
vocabulary raise.  Repeated rows and rows of missing or equal ``doc_id`` are encoded each; other columns are ignored.  A very long text is
one row, whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from graticule.llm.common import ids_and_texts
from graticule.llm.encoding import Memory, byte_letters, is_plain, plain_pieces

NONE = 1 << 62  # the rank where there is no pair to merge
_PLACE = 32     # a node is rank << 32 | place: the least one is the leftmost of the lowest rank


class PairTree:
    """Ranks of the adjacent pairs of a piece; ``root`` is the least (rank, place)."""

    def __init__(self, ranks: Sequence[int]):
        """``ranks[i]`` belongs to the pair at place i; ``NONE`` where there is none."""
        self.leaves = 1 << max(0, len(ranks) - 1).bit_length()
        nodes = [NONE] * self.leaves
        nodes += [r << _PLACE | i if r != NONE else NONE for i, r in enumerate(ranks)]
        nodes += [NONE] * (2 * self.leaves - len(nodes))
        for i in range(self.leaves - 1, 0, -1):
            a, b = nodes[2 * i], nodes[2 * i + 1]
            nodes[i] = a if a < b else b
        self.nodes = nodes

    def set(self, place: int, rank: int) -> None:
        nodes, i = self.nodes, self.leaves + place
        value = NONE if rank == NONE else rank << _PLACE | place
        nodes[i] = value
        while i > 1:
            other = nodes[i ^ 1]
            if other < value:
                value = other
            i >>= 1
            if nodes[i] == value:
                break
            nodes[i] = value

    def lowest(self) -> int:
        """The place of the leftmost pair of lowest rank, -1 if no pair is left."""
        root = self.nodes[1]
        return -1 if root >= NONE else root & (1 << _PLACE) - 1


class Vocabulary:
    def __init__(self, path: str, special: bool = True):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        self.symbols: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.pairs[self.symbols[left], self.symbols[right]] = rank, self.symbols[left + right]
        self.tokens = {i: s for s, i in self.symbols.items()} | {t["id"]: t["content"] for t in file["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]} if special else {}
        self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        library = Tokenizer.from_file(path)
        self._normalizer, self._cutter = library.normalizer, library.pre_tokenizer
        self._plain = Memory(lambda piece: array("I", self.merge(byte_letters(piece))).tobytes(), 400_000)
        self._chunks = Memory(self._chunk, 100_000)

    def merge(self, piece: str) -> list[int]:
        """The ids of one piece, given in the letters that stand for its bytes."""
        symbols = [self.symbols[c] for c in piece[:-1]]
        symbols.append(self.symbols[piece[-1] + self.end])
        n, find = len(symbols), self.pairs.get
        if n == 1:
            return symbols
        none = (NONE, -1)
        tree = PairTree([find(p, none)[0] for p in zip(symbols, symbols[1:])])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        while (i := tree.lowest()) >= 0:
            j = after[i]
            symbols[i] = find((symbols[i], symbols[j]))[1]
            alive[j], k = False, after[j]
            after[i] = k
            if j < n - 1:
                tree.set(j, NONE)
            if k < n:
                before[k] = i
                tree.set(i, find((symbols[i], symbols[k]), none)[0])
            else:
                tree.set(i, NONE)
            if (h := before[i]) >= 0:
                tree.set(h, find((symbols[h], symbols[i]), none)[0])
        return [s for s, a in zip(symbols, alive) if a]

    def _chunk(self, chunk: str) -> bytes:
        """A run without white space, not plain as a whole or not in a plain text."""
        if is_plain(chunk):
            return self._plain_text(chunk)
        pieces = self._cutter.pre_tokenize_str(self._normalizer.normalize_str(chunk))
        return b"".join([array("I", self.merge(piece)).tobytes() for piece, _ in pieces])

    def _plain_text(self, text: str) -> bytes:
        return b"".join(map(self._plain.__getitem__, plain_pieces(text, False)))

    def _ordinary(self, text: str) -> bytes:
        if is_plain(text):
            return self._plain_text(text)
        return b"".join([self._chunks[word.decode()] for word in text.encode().split()])

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a whole text as unsigned 32-bit integers."""
        if not text:
            return np.zeros(0, "<u4")
        out, at = [], 0
        if self._special is not None:
            for found in self._special.finditer(text):
                out += [self._ordinary(text[at:found.start()]), array("I", [self.special[found.group()]]).tobytes()]
                at = found.end()
        out.append(self._ordinary(text[at:]))
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: Sequence[int]) -> str:
        """The tokens of all ids, special ones too, with a space between them: the file has no decoder of its own."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))


_VOCABULARIES: dict[tuple[str, bool], Vocabulary] = {}


def vocabulary_of(path: str, special: bool = True) -> Vocabulary:
    """One per Python worker and file."""
    if (path, special) not in _VOCABULARIES:
        _VOCABULARIES[path, special] = Vocabulary(path, special)
    return _VOCABULARIES[path, special]


def encoded(docs: DataFrame, path: str, special: bool = True) -> DataFrame:
    """(doc_id, ids) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary_of(path, special)
        for batch in batches:
            lists = [words.encode(t) for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, "<u4"), *lists]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "ids"])

    return ids_and_texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary_of(path)
        for batch in batches:
            texts = [words.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select(rows["doc_id"].cast("long").alias("doc_id"), rows["ids"].alias("ids")).mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, special: bool = True) -> DataFrame:
    """Per document, its number of ids, the sha256 of its ids as little-endian 32-bit integers and that of their decoded text.

    Encodes and decodes in one pass, so ids and decoded texts are never stored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary_of(path, special)
        for batch in batches:
            counts, ids_sha, decoded_sha = [], [], []
            for text in batch.column("text").to_pylist():
                ids = words.encode(text)
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                decoded_sha.append(hashlib.sha256(words.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return ids_and_texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
