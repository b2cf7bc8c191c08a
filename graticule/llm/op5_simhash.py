"""Near-duplicates by SimHash and multi-index hashing.

A fingerprint has 64 bits, cut into two segments of 32.  Of two fingerprints that differ in at most three bits, one segment
differs in at most one.  So every fingerprint is entered in a table under each of its segments, looks up its own segment and
the small Hamming ball around it (the 0 bits set in turn; the partner finds the 1 bits), and what is found is verified on all
64 bits.  With 32-bit keys a bucket holds n / 2^32 of n unrelated fingerprints.

Only distinct fingerprints are linked, so thousands of exact copies are one node, and the verification is part of the join:
rows come out for true links only.  Groups are found by star contraction on tables in the shared folder.  Nothing is collected.

Texts without a word have fingerprint 0 and are linked like others.  A missing ``doc_id`` is never the smallest of its group;
a group that has no id at all gets a null class.  Rows of equal id are separate documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from graticule.llm.common import ids_and_texts, whole_text
from graticule.session import cut_lineage

SEGMENT = 32


def shingle_hashes(text: str | None, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """Unsigned 64-bit hashes of all word shingles, repeats included; ASCII letters lower-cased, a shorter text is one shingle."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        h = xxhash.xxh64_intdigest
        hashes = [h(joined[a:b], seed) for a, b in zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    return np.array(hashes, np.uint64)


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Signed 64-bit fingerprint over all word shingles, repeats included; ASCII letters lower-cased."""
    array = shingle_hashes(text, shingle, seed)
    if not len(array):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(array), 1 << 16):  # a very long text unpacks to 64 bytes per shingle
        counts += np.unpackbits(array[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * counts > len(array), bitorder="little").view(np.int64)[0])


@pandas_udf(T.LongType())
def fingerprint(text: pd.Series) -> pd.Series:
    return text.map(simhash).astype("int64")


def links(fingerprints: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints, column ``fp``, that differ in at most ``radius`` bits (3 at most)."""
    if not 0 <= radius <= 3:
        raise ValueError("two segments and balls of one bit find all pairs within 3 bits, no more")
    segment = lambda s: f"(shiftrightunsigned(fp, {s * SEGMENT}) & 4294967295L)"
    key = lambda s, value: f"({value} | {s << SEGMENT}L)"
    table = fingerprints.selectExpr("fp AS b", f"explode(array({key(0, segment(0))}, {key(1, segment(1))})) AS k")
    ball = [
        f"transform(filter(sequence(0, {SEGMENT - 1}), i -> {segment(s)} & shiftleft(1L, i) = 0), i -> {key(s, f'{segment(s)} | shiftleft(1L, i)')})"
        for s in (0, 1)
    ]
    own = f"array({key(0, segment(0))}, {key(1, segment(1))})"
    probes = fingerprints.selectExpr("fp AS a", f"explode({own}) AS k", "true AS same").unionByName(
        fingerprints.selectExpr("fp AS a", f"explode(concat({ball[0]}, {ball[1]})) AS k", "false AS same"))
    found = probes.join(table, "k").where(f"bit_count(a ^ b) <= {radius} AND (NOT same OR a < b)")
    return found.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct()


def components(pairs: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``pairs`` (a, b): the smallest node reachable.

    Alternates two steps until nothing changes: every node links its larger neighbours to its smallest neighbour, then its
    smaller ones.  The minima are combined on the map side, and a hub's rows can be split in the join.
    """
    edges = cut_lineage(pairs.selectExpr("greatest(a, b) AS u", "least(a, b) AS v").where("u <> v").distinct())

    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(edges)
    for _ in range(max_rounds):
        both = edges.union(edges.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").selectExpr("v AS u", "m AS v").where("u <> v").distinct()
        large = cut_lineage(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").selectExpr("v AS u", "m AS v").union(least.selectExpr("u", "m AS v"))
        edges = cut_lineage(small.where("u <> v").selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct())
        after = state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("groups did not settle")
    return edges.selectExpr("u AS node", "v AS root").union(edges.selectExpr("v AS node", "v AS root").distinct())


def classes(fingerprinted: DataFrame, radius: int = 3) -> DataFrame:
    """From rows (doc_id, fp): per distinct ``fp`` its class, named by ``rep_id`` and ``rep_fp``, its least document.

    The least document has the smallest id, missing ids last, and among equal ids the smallest fingerprint.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "fp")).alias("first")
    nodes = cut_lineage(fingerprinted.groupBy("fp").agg(first))
    roots = cut_lineage(components(links(nodes.select("fp"), radius)))
    rep = roots.join(nodes, F.col("node") == F.col("fp")).groupBy("root").agg(F.min("first").alias("rep"))
    grouped = roots.join(rep, "root").select(F.col("node").alias("fp"), "rep")
    return nodes.join(grouped, "fp", "left").select(
        "fp", F.coalesce("rep.doc_id", F.when(F.col("rep").isNull(), F.col("first.doc_id"))).alias("rep_id"),
        F.coalesce("rep.fp", "fp").alias("rep_fp"))


def near_duplicates(docs: DataFrame, radius: int = 3) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (the smallest id that links reach)."""
    rows = cut_lineage(ids_and_texts(docs).select("doc_id", fingerprint("text").alias("fp")))
    # The classes are stored first: between two plain tables the rows of a fingerprint with thousands of copies can be split.
    return rows.join(cut_lineage(classes(rows, radius)), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("rep_id").alias("component_id"))


def one_of_each_group(docs: DataFrame, radius: int = 3) -> DataFrame:
    """The rows of ``docs``, all their columns, that are the least document of their group; of repeated rows one stays.

    Groups are decided on ids, fingerprints and row keys alone.  The rows themselves move once, to their key; repeats of a row are
    combined before they move.
    """
    key = F.xxhash64(docs["doc_id"].cast("long").isNull(), docs["doc_id"].cast("long"), whole_text(docs))
    rows = cut_lineage(docs.select(docs["doc_id"].cast("long").alias("doc_id"), key.alias("row_key"), fingerprint(whole_text(docs)).alias("fp")))
    reps = cut_lineage(classes(rows.select("doc_id", "fp"), radius).select("rep_id", "rep_fp").distinct())
    same = rows["doc_id"].eqNullSafe(reps["rep_id"]) & (rows["fp"] == reps["rep_fp"])
    # Different texts of one id and fingerprint count as one document: the least key stands for it.
    keep = cut_lineage(rows.join(reps, same, "left_semi").groupBy("doc_id", "fp").agg(F.min("row_key").alias("row_key")).select("row_key"))
    kept = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), key.alias("row_key")).dropDuplicates(["row_key"])
    return kept.join(keep, "row_key", "left_semi").select("row.*")
