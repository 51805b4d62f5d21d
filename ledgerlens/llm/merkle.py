"""Merkle manifest of a dataset as a persistent tree with path copying.

Every source's rows, in id order, are the leaves of a tree in which 16
consecutive nodes make one parent; the sources' roots are the leaves of one
more tree of the same kind. Digests are hex SHA-256.

Leaf positions come from a range sort and prefix sums of counts, so that no
source passes through one task. Nodes are built in aligned blocks of
``16 ** BLOCK_LEVELS`` leaves: a block's top depends on its own leaves only,
the tops are the leaves of the next distributed step, and so on until each
tree has one node. Downwards, every block receives the siblings of its top up
to the root (at most 15 digests a level).

A tampered leaf makes a version of the tree that shares all nodes but the
leaf's ancestors: within its block the ancestors are copied, above it the
version goes on along the block's upper path. Versions are never stored
whole; a version is its leaf and the copied ancestors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import Stages

FAN = 16
#: levels of nodes that one block builds: 16**2 leaves
BLOCK_LEVELS = 2


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(*fields: Column) -> Column:
    """Digest of fields, each ``-`` if null, else UTF-8 byte count, ``:``, value."""
    parts = []
    for f in fields:
        s = f.cast("string")
        parts.append(F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def levels_of(nodes: list[str], most: int | None) -> list[list[str]]:
    """The nodes and all levels above them: ``most`` levels, or (None) until
    one node remains. A last run may be shorter, even one node."""
    out = [nodes]
    while (len(out) <= most) if most is not None else len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i:i + FAN])) for i in range(0, len(out[-1]), FAN)])
    return out


def siblings(levels: list[list[str]], at: int) -> list[tuple[list[str], int]]:
    """Of leaf ``at``: on every level below the top, the others of its run and
    its place among them."""
    out = []
    for nodes in levels[:-1]:
        run = at // FAN * FAN
        out.append((nodes[run:at] + nodes[at + 1:run + FAN], at - run))
        at //= FAN
    return out


def fold(leaf: str, path: list[tuple[list[str], int]]) -> str:
    """Top of the version in which the path's leaf is ``leaf``: one copied
    ancestor a level, everything else shared."""
    for others, place in path:
        leaf = digest("".join(others[:place]) + leaf + "".join(others[place:]))
    return leaf


def positions(df: DataFrame, tree: str, order: list[Column], stages: Stages, name: str) -> DataFrame:
    """``df`` with ``pos`` (from 0 in ``order`` within ``tree``) and ``n`` (the
    tree's size). Rows are range-sorted over all trees; a tree's rows span any
    number of partitions, whose counts are summed up."""
    rows = stages.write(df, f"{name}-rows")  # the range sort reads its input twice, once for a sample
    ranged = rows.repartitionByRange(F.col(tree).asc_nulls_first(), *order)
    ranged = stages.write(ranged.sortWithinPartitions(F.col(tree).asc_nulls_first(), *order)
                          .withColumn("at", F.monotonically_increasing_id()), f"{name}-sorted")
    stages.drop(rows)
    part = F.shiftright("at", 33)
    counts = ranged.groupBy(tree, part.alias("part")).agg(F.count("*").alias("c"), F.min("at").alias("first"))
    whole = Window.partitionBy(tree)
    counts = counts.select(
        F.col(tree).alias("c_tree"), F.col("part").alias("c_part"), "first",
        F.coalesce(F.sum("c").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"),
        F.sum("c").over(whole).alias("n"))
    return (ranged.join(counts, F.col(tree).eqNullSafe(F.col("c_tree")) & (part == F.col("c_part")))
            .select(*df.columns, (F.col("at") - F.col("first") + F.col("ahead")).alias("pos"), "n"))


def _most(n: int, levels: int) -> int | None:
    """Levels that a block of a tree of ``n`` nodes builds (None: to the tree's root)."""
    return levels if n > FAN ** levels else None


def _tops(df: DataFrame, block_levels: int) -> DataFrame:
    """(tree, block, n, nodes) -> (tree, block, n, top)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tops = [levels_of(nodes, _most(n, block_levels))[-1][0] for nodes, n in zip(b.column("nodes").to_pylist(), b.column("n").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("tree"), b.column("block"), b.column("n"), pa.array(tops, pa.string())],
                                             ["tree", "block", "n", "top"])

    return df.select("tree", "block", "n", "nodes").mapInArrow(run, "tree string, block long, n long, top string")


def _blocks(nodes: DataFrame, block_levels: int) -> DataFrame:
    """(tree, pos, n, hash) -> one row a block with its nodes in order, at most 16**block_levels."""
    return (nodes.groupBy("tree", F.expr(f"pos div {FAN ** block_levels}").alias("block"))
            .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "hash"))).alias("s"))
            .select("tree", "block", "n", F.col("s.hash").alias("nodes")))


_PATH = "array<struct<others:array<string>,place:int>>"


def _paths(blocks: DataFrame, above: DataFrame | None, block_levels: int) -> DataFrame:
    """Of every node of the blocks (tree, block, n, nodes): the siblings up to
    its tree's root, its block's part first; ``above`` has (tree, block, path)
    of the blocks' tops."""
    above_path = F.array().cast(_PATH)
    if above is not None:
        blocks = blocks.join(above.select(F.col("tree").alias("a_tree"), F.col("block").alias("a_block"), "path"),
                             F.col("tree").eqNullSafe(F.col("a_tree")) & (F.col("block") == F.col("a_block")))
        above_path = F.col("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                levels = levels_of(row["nodes"], _most(row["n"], block_levels))
                size = len(row["nodes"])
                paths = [[{"others": o, "place": p} for o, p in siblings(levels, i)] + row["path"] for i in range(size)]
                first = row["block"] * FAN ** block_levels
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tree"]] * size, pa.string()), pa.array(range(first, first + size), pa.int64()),
                     pa.array(paths, pa.list_(pa.struct([("others", pa.list_(pa.string())), ("place", pa.int32())])))],
                    ["tree", "block", "path"])

    return blocks.select("tree", "block", "n", "nodes", above_path.alias("path")).mapInArrow(
        run, f"tree string, block long, path {_PATH}")


def _upper(tops: DataFrame, stages: Stages, block_levels: int) -> tuple[DataFrame, DataFrame]:
    """(tree, pos, n, hash) of trees' nodes -> ``(roots, paths)``: (tree, root)
    and, per node, (tree, block, path) up to the root. Steps grow with the
    logarithm of the largest tree's size."""
    blocks = stages.write(_blocks(tops, block_levels), "blocks")
    done = stages.write(_tops(blocks, block_levels), "tops")
    size = FAN ** block_levels
    if done.where(F.col("n") > size).isEmpty():
        return done.select("tree", F.col("top").alias("root")), stages.write(_paths(blocks, None, block_levels), "paths")
    open_ = done.select("tree", F.col("block").alias("pos"), F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("top").alias("hash"))
    roots, above = _upper(open_, stages, block_levels)  # a finished tree is one node here: no siblings, its own root
    return roots, stages.write(_paths(blocks, above, block_levels), "paths")


def manifest(docs: DataFrame, stages: Stages, fields: list[str], tampered: Column, tamper: dict[str, Column],
             id_col: str = "doc_id", source_col: str = "source", block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, leaf, subroot, root,
    proof_sha256, folded_root, verified, copied``.

    A leaf is the digest of ``fields``, in this order. Where ``tampered`` is
    true, the fields named in ``tamper`` are replaced by its expressions, and
    ``folded_root`` is the root of the version with that leaf; elsewhere it is
    folded from the original leaf. ``proof_sha256`` is the digest of all
    siblings from leaf to root. ``copied`` is the number of nodes the version
    does not share with the original (0 for an untampered leaf).

    Null ids come first in their source, rows of equal id follow by leaf
    digest (equal rows have equal siblings); null sources are a source of
    their own, the first one, and differ from the empty source. Null fields
    are ``-``, empty ones ``0:``. A null ``tampered`` is false. A single
    source's subroot is the root, a single leaf is both, and an empty table
    gives no rows.
    """
    changed = F.coalesce(tampered, F.lit(False))
    leaves = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("tree"),
        leaf_digest(*[F.col(f) for f in fields]).alias("hash"),
        F.when(changed, leaf_digest(*[tamper.get(f, F.col(f)) for f in fields])).alias("new_hash"))
    mark = stages.n
    placed = positions(leaves, "tree", [F.col("doc_id").asc_nulls_first(), F.col("hash")], stages, "leaves")
    size = FAN ** block_levels
    blocks = (placed.groupBy("tree", F.expr(f"pos div {size}").alias("block"))
              .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "hash", "doc_id", "new_hash"))).alias("s"))
              .select("tree", "block", "n", F.col("s.hash").alias("nodes"), F.col("s.doc_id").alias("ids"),
                      F.col("s.new_hash").alias("new")))
    blocks = stages.write(blocks, "leaf-blocks")
    tops = stages.write(_tops(blocks, block_levels), "leaf-tops")
    subroots, paths = _upper(
        tops.select("tree", F.col("block").alias("pos"),
                    F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("top").alias("hash")), stages, block_levels)
    subroots = stages.write(subroots, "subroots")
    forest = positions(subroots.select(F.lit("sources").alias("all"), "tree", "root"), "all",
                       [F.col("tree").asc_nulls_first()], stages, "sources")
    forest = stages.write(forest, "forest")
    roots, source_paths = _upper(forest.select(F.col("all").alias("tree"), "pos", "n", F.col("root").alias("hash")), stages, block_levels)
    root = roots.first()  # one digest
    sources = (forest.select(F.col("tree").alias("s_tree"), F.col("root").alias("subroot"), F.col("pos").alias("s_pos"))
               .join(source_paths.select(F.col("block").alias("s_pos"), F.col("path").alias("s_path")), "s_pos")
               .select("s_tree", "subroot", F.lit(root and root.root).cast("string").alias("root"), "s_path"))
    stages.drop_since(mark, blocks, paths, forest, source_paths)
    above = paths.select(F.col("tree").alias("a_tree"), F.col("block").alias("a_block"), F.col("path").alias("a_path"))
    whole = (blocks.join(above, F.col("tree").eqNullSafe(F.col("a_tree")) & (F.col("block") == F.col("a_block")))
             .join(sources, F.col("tree").eqNullSafe(F.col("s_tree")))
             .select("tree", "n", "nodes", "ids", "new", "subroot", "root", F.concat("a_path", "s_path").alias("path")))
    return whole.mapInArrow(lambda batches: _versions(batches, block_levels), (
        "doc_id long, source string, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean, copied int"))


def _versions(batches: Iterator[pa.RecordBatch], block_levels: int) -> Iterator[pa.RecordBatch]:
    """Proofs and versions of the leaves of whole blocks."""
    for b in batches:
        for row in b.to_pylist():
            levels = levels_of(row["nodes"], _most(row["n"], block_levels))
            upper = [(p["others"], p["place"]) for p in row["path"]]
            upper_text = "".join("".join(o) for o, _ in upper)
            out = []
            for i, (leaf, doc_id, new) in enumerate(zip(row["nodes"], row["ids"], row["new"])):
                own = siblings(levels, i)
                path = own + upper
                proof = digest("".join("".join(o) for o, _ in own) + upper_text)
                folded = fold(leaf if new is None else new, path)
                out.append((doc_id, row["tree"], leaf, row["subroot"], row["root"], proof, folded, folded == row["root"],
                            len(path) + 1 if new is not None and new != leaf else 0))
            types = [pa.int64()] + [pa.string()] * 6 + [pa.bool_(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [
                "doc_id", "source", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "copied"])
