"""Best-two-fit packing of encoded documents into sequences of a set length.

Packing needs only how many pieces there are of each length, at most ``capacity`` numbers.  A plan is made on those: bins are
filled greedily with the longest piece that fits; if a gap is left, the smallest piece of the bin makes way for the two unpacked
pieces that fill the widened gap best.  A bin's pattern is repeated as long as its pieces last, so the plan has at most a few
thousand patterns however many documents there are.  Pieces are numbered within their length, and number and length tell the
sequence and the place: a lookup in the plan, without bringing documents together.

Documents are encoded whole and end with id 0; only longer ones are cut, into full pieces and a rest.  A missing or empty text is
one piece of length 1.  Repeated rows are packed each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from graticule.llm.common import groups_of, ids_and_texts
from graticule.llm.encoding import END, encoder
from graticule.session import cut_lineage

CAPACITY = 2048


def pieces(docs: DataFrame, tokenizer: str, spaces: bool = False, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every whole text, and the ids themselves if ``with_ids``."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer, spaces)
        for batch in batches:
            rows, lists = [], []
            for doc_id, text in zip(batch["doc_id"].array, batch["text"]):
                packed = enc.encode(text) + END
                for n, at in enumerate(range(0, len(packed), 4 * capacity)):
                    part = packed[at:at + 4 * capacity]
                    rows.append((doc_id, n, at // 4, len(part) // 4, zlib.crc32(part)))
                    if with_ids:
                        lists.append(np.frombuffer(part, "<i4"))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            if with_ids:
                out["ids"] = lists
            yield out

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return ids_and_texts(docs).mapInPandas(cut, schema)


def best_two_fit(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Patterns (lengths, times) that use every piece once; ``counts[l]`` is how many pieces have length ``l``."""
    left = counts.astype(np.int64).copy()
    lengths = np.arange(capacity + 1)
    plan = []
    while left.any():
        free = left.copy()
        bin_, gap = [], capacity
        while gap > 0:
            fits = np.flatnonzero(free[: gap + 1])
            if not len(fits):
                break
            bin_.append(int(fits[-1]))
            free[fits[-1]] -= 1
            gap -= bin_[-1]
        if gap > 0 and len(bin_) > 1:
            room = gap + bin_[-1]
            # For each length, the longest available one up to it, and with it the best partner of every first piece.
            upto = np.maximum.accumulate(np.where(free > 0, lengths, 0))
            first = np.flatnonzero(free[:room])
            second = upto[np.minimum(first, room - first)]
            alone = (second == first) & (free[first] < 2)
            second = np.where(alone, upto[np.maximum(first - 1, 0)], second)
            total = np.where(second > 0, first + second, 0)
            if len(total) and total.max() > bin_[-1]:
                best = int(total.argmax())
                bin_[-1:] = [int(first[best]), int(second[best])]
        used, need = np.unique(bin_, return_counts=True)
        times = int((left[used] // need).min())
        left[used] -= times * need
        plan.append((bin_, times))
    return plan


class Slots:
    """The plan turned round: from (length, number within the length) to (sequence, offset)."""

    def __init__(self, plan: list[tuple[list[int], int]], capacity: int = CAPACITY):
        self.span = np.int64(1 << 44)  # more pieces of one length than that do not occur
        taken = np.zeros(capacity + 1, np.int64)
        rows, base = [], 0
        for bin_, times in plan:
            offset = 0
            for length in bin_:
                rows.append((length * int(self.span) + int(taken[length]), base, offset))
                taken[length] += times
                offset += length
            base += times
        self.keys, self.bases, self.offsets = np.array(sorted(rows) or np.zeros((0, 3)), np.int64).reshape(-1, 3).T.copy()
        self.sequences = base

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = length * self.span + number
        at = np.searchsorted(self.keys, key, "right") - 1
        return self.bases[at] + key - self.keys[at], self.offsets[at]


def pack(parts: DataFrame, capacity: int = CAPACITY, rows_per_group: int = 2048) -> DataFrame:
    """``parts`` (doc_id, piece, length and more; of lengths 1 to ``capacity``) with sequence_id and offset.

    Pieces are numbered in two levels, over hashed groups of a length and inside each, so a very common length is no hot key.
    ``parts`` is read more than once: pass a stored table.
    """
    groups = groups_of(parts.count(), rows_per_group)
    rows = parts.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    per_group = rows.groupBy("length", "g").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in per_group.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["n"]
    slots = Slots(best_two_fit(counts, capacity), capacity)
    earlier = Window.partitionBy("length").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_group.select("length", "g", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "g").orderBy("doc_id", "piece", *[c for c in ("ids_crc32",) if c in parts.columns])
    numbered = rows.join(starts, ["length", "g"]).withColumn("number", F.col("first") + F.row_number().over(inside) - 1)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset = slots.place(batch["length"].to_numpy(np.int64), batch["number"].to_numpy(np.int64))
            yield batch.drop(columns=["number"]).assign(sequence_id=sequence, offset=offset)

    kept = numbered.select(*parts.columns, "number")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema) + ", sequence_id long, offset long"
    return kept.mapInPandas(place, schema)


def packed_documents(docs: DataFrame, tokenizer: str, spaces: bool = False, capacity: int = CAPACITY) -> DataFrame:
    return pack(cut_lineage(pieces(docs, tokenizer, spaces, capacity)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """From packed pieces that carry ``ids``: one row per sequence with its ids and where documents begin; bounded by the capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("offsets"), F.col("parts.doc_id").alias("doc_ids"))
