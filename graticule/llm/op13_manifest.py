"""Merkle manifest of a dataset: a tree over its rows per language, roots over languages, and a proof for every row.

The leaves of a tree are cut into aligned blocks of ``fanout ** height`` consecutive ones; a block hashes its own subtree in a task.
Above the blocks there is no tree of tasks and no pass back down, but a butterfly exchange: in round r the blocks whose numbers differ
in digit r alone (base ``fanout``) form a group, swap the roots of their subtrees, and each of them hashes the parent.  So every
block holds its own ancestors, and what it was sent are the siblings its proofs need.  After as many rounds as block numbers have
digits each block holds the root and the upper part of its proofs.  Round by round the groups have ``fanout`` rows of one hash each.

A tree that is no full power has block numbers without leaves up to the next power.  They take part with an empty root, which adds
nothing to a parent; so a block whose partner is past the end still gets the sibling, from the number that stands for it.

Leaves are ordered by (doc_id, leaf), missing ids first; rows equal in both are the same row and any order of them gives the same tree.
Their places come from a range sort and one count per (partition, language).  No text is moved: a leaf is hashed where the row is read.

H(x, ...) is the sha256 in lower-case hex of its inputs one after the other.  A leaf is H of the fields doc_id, source, lang, n_chars and
text, each ``-`` if missing, else its length in UTF-8 bytes, ``:`` and its value.  While several nodes remain each run of ``fanout`` is
hashed, a last shorter one too, even of one; a lone leaf is the root of its tree.

Defined results: an empty table gives no rows; a missing ``lang`` is a tree of its own, before the others, which are in the order of their
UTF-8 bytes; repeated rows are leaves each, with proofs of their own; other columns are ignored; long texts are hashed whole.
Tampering changes n_chars by one where ``tampered`` says so; a missing n_chars stays missing, so such a row is verified.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from graticule.llm.common import groups_of
from graticule.session import cut_lineage, small_enough_to_broadcast

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def H(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(fields: list[Column]) -> Column:
    """H of the fields; those that aren't strings are written as decimals."""
    texts = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in texts]), 256)


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(tree, doc_id, leaf, shown): the leaf of every row and the one that is presented for it, which ``tampered`` rows change.

    ``tree`` is the language behind a sign, or empty where there is none, so it is never null and sorts as languages do.
    """
    columns = {c: docs[c] for c in FIELDS}
    changed = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    columns["n_chars"] = columns["n_chars"].cast("long")
    forged = {**columns, "n_chars": F.when(changed, columns["n_chars"] + 1).otherwise(columns["n_chars"])}
    leaf = leaf_of(list(columns.values()))
    return docs.select(
        F.coalesce(F.concat(F.lit("="), columns["lang"].cast("string")), F.lit("")).alias("tree"), columns["doc_id"].cast("long").alias("doc_id"), leaf.alias("leaf"),
        F.when(changed, leaf_of(list(forged.values()))).otherwise(leaf).alias("shown"))


def numbered(rows: DataFrame, order: list[str], rows_per_partition: int) -> DataFrame:
    """``rows`` with ``place``, from 0 within their ``tree`` by ``order``, and ``size``, the rows of the tree.

    A range sort, then a count per (partition, tree).  Equal rows can be dealt to several partitions: a number of their own
    splits them, and any order of them is right.
    """
    parts = groups_of(rows.count(), rows_per_partition)
    by = [F.col("tree"), *[F.col(c).asc_nulls_first() for c in order], F.col("_own")]
    ranged = rows.withColumn("_own", F.monotonically_increasing_id()).repartitionByRange(parts, *by).sortWithinPartitions(*by)
    # In a sorted partition this number is its own upper bits and a counter below them.
    ranged = cut_lineage(ranged.withColumns({"_at": F.monotonically_increasing_id(), "_part": F.spark_partition_id()}).drop("_own"))
    counts = ranged.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_low"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("tree").alias("_tree"), F.col("_part").alias("_p"), "_low",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(whole).alias("size"))
    # One row per partition and tree.
    starts = small_enough_to_broadcast(cut_lineage(starts))
    joined = ranged.join(starts, (F.col("_part") == F.col("_p")) & (F.col("tree") == F.col("_tree")))
    return joined.withColumn("place", F.col("_start") + F.col("_at") - F.col("_low")).select(*rows.columns, "place", "size")


def levels(nodes: list[str], fanout: int, height: int | None) -> list[list[str]]:
    """All levels over ``nodes``, themselves first: ``height`` of them above, or until one node is left."""
    out = [nodes]
    while len(out) <= height if height is not None else len(out[-1]) > 1:
        last = out[-1]
        out.append([H(last[i:i + fanout]) for i in range(0, len(last), fanout)])
    return out


def siblings(tree: list[list[str]], place: int, fanout: int) -> list[tuple[list[str], list[str]]]:
    """Per level from the leaf up, what stands left and right of the own node in its run."""
    out = []
    for level in tree[:-1]:
        run = place - place % fanout
        out.append((level[run:place], level[place + 1:run + fanout]))
        place //= fanout
    return out


def fold(node: str, steps) -> str:
    """The root that a leaf and its (left, right) siblings lead to."""
    for left, right in steps:
        node = H([*left, node, *right])
    return node


STEPS = "array<struct<left: array<string>, right: array<string>>>"


def in_blocks(placed: DataFrame, keep: list[str], fanout: int, height: int) -> DataFrame:
    """(tree, block, size, leaf[], and each of ``keep`` as a list) in the order of places: the leaves of a block brought together once."""
    rows = placed.groupBy("tree", F.expr(f"place DIV {fanout ** height}").alias("block"), "size").agg(
        F.sort_array(F.collect_list(F.struct("place", "leaf", *keep))).alias("rows"))
    return cut_lineage(rows.select("tree", "block", "size", *[F.col(f"rows.{c}").alias(c) for c in ("leaf", *keep)]))


def subtree(leaf: list[str], size: int, fanout: int, height: int) -> list[list[str]]:
    """A block's levels: all ``height`` of them where the tree has more blocks, also over a last block of few leaves."""
    return levels(leaf, fanout, height if size > fanout ** height else None)


def butterfly(blocks: DataFrame, fanout: int, max_rounds: int) -> DataFrame:
    """(tree, block, top, steps) from (tree, block, node, rounds): the tree's root, and the siblings on the way to it.

    ``rounds`` is how many levels the tree has above its blocks.  ``blocks`` holds the numbers without leaves too, with a null node.
    """
    rows = blocks.withColumn("steps", F.expr(f"CAST(array() AS {STEPS})"))
    there = lambda x: x["node"].isNotNull()
    for r in range(max_rounds):
        weight = fanout ** r
        digit = F.expr(f"CAST((block DIV {weight}) % {fanout} AS INT)")
        active = F.col("rounds") > r
        # The aligned group: same tree, all digits but digit r the same; fanout rows at most.
        group = Window.partitionBy("tree", F.col("block") - digit * weight, active)
        swapped = rows.withColumn("_digit", digit).withColumn(
            "_all", F.when(active, F.filter(F.sort_array(F.collect_list(F.struct("_digit", "node")).over(group)), there)))
        nodes = lambda x: x["node"]
        step = F.struct(
            F.transform(F.filter("_all", lambda x: x["_digit"] < F.col("_digit")), nodes).alias("left"),
            F.transform(F.filter("_all", lambda x: x["_digit"] > F.col("_digit")), nodes).alias("right"))
        parent = F.when(F.size("_all") > 0, F.sha2(F.concat_ws("", F.transform("_all", nodes)), 256))
        rows = cut_lineage(swapped.select(
            "tree", "block", "rounds", F.when(active, parent).otherwise(F.col("node")).alias("node"),
            F.when(active, F.concat("steps", F.array(step))).otherwise(F.col("steps")).alias("steps")))
    return rows.select("tree", "block", F.col("node").alias("top"), "steps")


def upper_proofs(blocks: DataFrame, fanout: int, height: int) -> DataFrame:
    """(tree, block, top, steps) of every block that has leaves."""

    def root(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            node = [subtree(list(leaf), size, fanout, height)[-1][0] for size, leaf in zip(batch["size"], batch["leaf"])]
            yield batch[["tree", "block", "size"]].assign(node=node)

    roots = cut_lineage(blocks.select("tree", "block", "size", "leaf").mapInPandas(root, "tree string, block long, size long, node string"))
    most = (roots.agg(F.max("block")).first()[0] or 0) + 1
    powers = [1]
    while powers[-1] < most:
        powers.append(powers[-1] * fanout)
    block_size = fanout ** height
    count = F.expr(f"(size + {block_size - 1}) DIV {block_size}")
    rounds = sum((F.when(count > p, 1).otherwise(0) for p in powers), F.lit(0)).cast("int")
    roots = roots.withColumns({"_blocks": count, "rounds": rounds})
    full = F.element_at(F.array(*[F.lit(p).cast("long") for p in powers]), F.col("rounds") + 1)
    empty = roots.where((F.col("block") == F.col("_blocks") - 1) & (F.col("_blocks") < full)).select(
        "tree", F.explode(F.sequence("_blocks", full - 1)).alias("block"), F.lit(None).cast("string").alias("node"), "rounds")
    everything = roots.select("tree", "block", "node", "rounds").unionByName(empty)
    exchanged = butterfly(everything, fanout, len(powers) - 1)
    return exchanged.join(roots.select("tree", "block"), ["tree", "block"], "left_semi")


def with_upper(blocks: DataFrame, upper: DataFrame, blocks_per_task: int = 64) -> DataFrame:
    """``blocks`` with ``top`` and ``steps``.  What follows hashes each leaf's whole proof, so the tasks are set by blocks, not bytes."""
    tasks = groups_of(blocks.count(), blocks_per_task)
    spread = [df.repartition(tasks, "tree", "block") for df in (blocks, upper)]
    return spread[0].join(spread[1], ["tree", "block"])


def _steps(rows) -> list[tuple[list[str], list[str]]]:
    return [(list(s["left"]), list(s["right"])) for s in rows]


def proofs(placed: DataFrame, key: str, fanout: int, height: int) -> DataFrame:
    """(key, top, steps): for every leaf of ``placed``, which carries ``key``, the root of its tree and its whole proof."""
    blocks = in_blocks(placed, [key], fanout, height)

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, leaf, keys, top, above in zip(*(batch[c] for c in ("size", "leaf", key, "top", "steps"))):
                tree, above = subtree(list(leaf), size, fanout, height), _steps(above)
                steps = [[{"left": a, "right": b} for a, b in [*siblings(tree, i, fanout), *above]] for i in range(len(leaf))]
                yield pd.DataFrame({key: list(keys), "top": [top] * len(steps), "steps": steps})

    rows = with_upper(blocks, cut_lineage(upper_proofs(blocks, fanout, height)))
    return rows.mapInPandas(own, f"{key} {dict(placed.dtypes)[key]}, top string, steps {STEPS}")


def manifest(docs: DataFrame, tampered: Column | None = None, fanout: int = 2, height: int = 10, rows_per_partition: int = 1 << 17) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root (of the leaf as presented), verified (it is the root)."""
    placed = numbered(leaves(docs, tampered), ["doc_id", "leaf"], rows_per_partition)
    blocks = in_blocks(placed, ["doc_id", "shown"], fanout, height)
    upper = cut_lineage(upper_proofs(blocks, fanout, height))
    # The roots of the languages are the leaves of one more tree.
    languages = upper.where("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("own"), F.col("top").alias("leaf"))
    last = proofs(numbered(languages, ["own"], rows_per_partition), "own", fanout, height)
    last = small_enough_to_broadcast(cut_lineage(last.select(F.col("own").alias("tree"), F.col("top").alias("root"), F.col("steps").alias("last_steps"))))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, doc_ids, leaf, shown, top, steps, root, last_steps in batch.itertuples(index=False):
                tree, above = subtree(list(leaf), size, fanout, height), [*_steps(steps), *_steps(last_steps)]
                rows = []
                for i, (doc_id, own, given) in enumerate(zip(doc_ids, leaf, shown)):
                    path = [*siblings(tree, i, fanout), *above]
                    folded = fold(given, path)
                    rows.append((doc_id, own, top, root, H([h for left, right in path for h in (*left, *right)]), folded, folded == root))
                out = pd.DataFrame(rows, columns=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
                yield out.assign(doc_id=pd.array([None if pd.isna(d) else int(d) for d in out["doc_id"]], "Int64"))

    found = with_upper(blocks, upper).join(last, "tree")
    return found.select("size", "doc_id", "leaf", "shown", "top", "steps", "root", "last_steps").mapInPandas(
        verify, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
