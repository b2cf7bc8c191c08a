"""Document fingerprints: a Merkle tree over sections, paragraphs and short pieces, built from SQL functions alone.

Sections are parted by an empty line, paragraphs by a line break, pieces end at a full stop, exclamation or question mark or
after ``PIECE`` characters.  Nothing is dropped: the pieces joined again give the text.  A leaf is the hash of a piece, each
inner node the hash of its children's hashes, the root the hash of all sections.

A fingerprint is written ``root|section;section``, a section ``hash:paragraph,paragraph``, a paragraph ``hash~leaf~leaf``.
Equal texts have equal fingerprints; equal roots mean equal texts but for a hash collision (64 bits at each inner node, 256 at
the root); leaves are written with 32 bits, which serve to locate edits only.  A missing text counts as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from graticule.llm.common import groups_of, ids_and_texts

PIECE = 32
_LEAF = rf"[^.!?]{{1,{PIECE}}}+[.!?]*+|[.!?]++"


def _node(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 16)


def _paragraph(leaves: Column) -> Column:
    marks = F.concat_ws("", F.transform(leaves, lambda leaf: F.concat(F.lit("~"), F.substring(leaf, 1, 8))))
    own = _node(F.concat_ws("", leaves))
    return F.struct(own.alias("h"), F.concat(own, marks).alias("s"))


def _section(paragraphs: Column) -> Column:
    own = _node(F.concat_ws(",", paragraphs["h"]))
    return F.struct(own.alias("h"), F.concat(own, F.lit(":"), F.concat_ws(",", paragraphs["s"])).alias("s"))


def fingerprint(text: Column) -> Column:
    # Each array of children is bound by the next transform, so no level is computed twice.
    leaves = lambda paragraph: F.transform(F.regexp_extract_all(paragraph, F.lit(_LEAF), F.lit(0)), _node)
    paragraphs = lambda section: F.transform(F.transform(F.split(section, "\n", -1), leaves), _paragraph)
    sections = F.transform(F.transform(F.split(text, "\n\n", -1), paragraphs), _section)
    whole = F.transform(
        F.array(sections), lambda s: F.concat(F.sha2(F.concat_ws(";", s["h"]), 256), F.lit("|"), F.concat_ws(";", s["s"])))
    return whole[0]


def root(fp: Column) -> Column:
    return F.substring(fp, 1, 64)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: twice the distinct leaves in common over the distinct leaves of both; 1 for equal fingerprints."""
    leaves = lambda fp: F.array_distinct(F.regexp_extract_all(fp, F.lit("~[0-9a-f]{8}"), F.lit(0)))
    share = F.transform(
        F.array(F.struct(leaves(a).alias("a"), leaves(b).alias("b"))),
        lambda x: 2.0 * F.size(F.array_intersect(x["a"], x["b"])) / F.greatest(F.size(x["a"]) + F.size(x["b"]), F.lit(1)),
    )
    return F.when(a == b, F.lit(1.0)).otherwise(share[0])


def changed_branches(a: Column, b: Column) -> Column:
    """Paths ``section.paragraph`` (from 0, by position) at which two trees differ; equal sections aren't entered."""
    numbered = lambda parts: F.transform(parts, lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    pairs = lambda x, y: F.filter(
        numbered(F.arrays_zip(x.alias("a"), y.alias("b"))), lambda p: ~p["x"]["a"].eqNullSafe(p["x"]["b"]))
    body = lambda fp: F.split(F.substring_index(fp, "|", -1), ";")
    parts = lambda section: F.split(F.substring_index(section, ":", -1), ",")
    none = F.array().cast("array<string>")
    paths = F.transform(
        pairs(body(a), body(b)),
        lambda s: F.transform(
            pairs(F.coalesce(parts(s["x"]["a"]), none), F.coalesce(parts(s["x"]["b"]), none)),
            lambda p: F.concat_ws(".", s["i"], p["i"])),
    )
    return F.when(root(a) == root(b), none).otherwise(F.flatten(paths))


def _cuts(docs: DataFrame, rows_per_block: int, max_blocks: int) -> list[int]:
    """Ascending ids that end the blocks, the largest id last; at most ``max_blocks`` numbers come to the driver."""
    n = min(max_blocks, groups_of(docs.count(), rows_per_block))
    shares = [i / n for i in range(1, n + 1)]
    row = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * n)).alias("q"), F.max("doc_id").alias("m")).first()
    return sorted({*(row["q"] or []), row["m"]}) if row["m"] is not None else []


def with_next(docs: DataFrame, columns: list[str], rows_per_block: int = 500, max_blocks: int = 65_536) -> DataFrame:
    """Each row with ``next_<column>`` of the row after it by descending ``doc_id``; after the last comes the first.

    Ids are cut into blocks at quantiles.  The first row of each block is copied to the end of the block before it, so blocks
    are independent windows and no task sees all rows.  Missing ids come last; rows of equal id are ordered by text.
    """
    cuts = _cuts(docs, rows_per_block, max_blocks)
    n = len(cuts)
    bounds = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
    steps = [2**k for k in range(max(n, 1).bit_length() - 1, -1, -1)]
    found = F.aggregate(  # how many bounds lie below the id, by halving
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda at, step: F.when((at + step < n) & (F.element_at(bounds, F.least(at + step, F.lit(max(n, 1)))) < F.col("doc_id")), at + step)
        .otherwise(at),
    )
    own = docs.withColumn("block", found if n > 1 else F.lit(0)).withColumn("copy", F.lit(0))
    if n > 1:
        heads = F.element_at(bounds, F.col("block") + 1) == F.col("doc_id")
        place = lambda block, copy: F.struct(block.alias("block"), F.lit(copy).alias("copy"))
        here, before = place(F.col("block"), 0), place(F.pmod(F.col("block") + 1, F.lit(n)), 1)
        own = own.select(*docs.columns, F.explode(F.when(heads, F.array(here, before)).otherwise(F.array(here))).alias("p"))
        own = own.select(*docs.columns, "p.block", "p.copy")
    order = Window.partitionBy("block").orderBy("copy", F.col("doc_id").desc_nulls_last(), "text")
    following = [F.lead(c).over(order).alias(f"next_{c}") for c in columns]
    if n <= 1:
        following = [F.coalesce(F.lead(c).over(order), F.first(c).over(order)).alias(f"next_{c}") for c in columns]
    return own.select(*docs.columns, "copy", *following).where("copy = 0").drop("copy")


def fingerprints_and_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text (the last third replaced by the start of the next document), likenesses.

    The texts move once, with their fingerprints, to meet the next document; null and empty texts have the same fingerprint.
    """
    rows = ids_and_texts(docs).withColumn("fingerprint", fingerprint(F.col("text")))
    pairs = with_next(rows.select("doc_id", "text", "fingerprint"), ["text", "fingerprint"])
    n = F.char_length("text")
    edited = pairs.select(
        "doc_id", n.cast("long").alias("n_chars"), "fingerprint", "next_fingerprint",
        F.concat(F.expr("substring(text, 1, char_length(text) - char_length(text) div 3)"),
                 F.expr("substring(next_text, 1, char_length(text) div 3)")).alias("edited"),
    )
    done = edited.select(
        "doc_id", "n_chars", "fingerprint", "next_fingerprint", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
    )
    return done.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        F.size(changed_branches(F.col("fingerprint"), F.col("edited_fingerprint"))).cast("long").alias("n_changed_paragraphs"),
    )
