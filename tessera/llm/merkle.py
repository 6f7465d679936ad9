"""Merkle manifest of a dataset by nested-interval labels (operator 12).

Every row is a leaf: the hash of its fields.  The leaves of a tree (one per
value of a column) are numbered in the order of their ids, and every node
carries the interval ``[lo, hi)`` of leaf numbers that it covers.  Runs of
``arity`` consecutive nodes become their parent until one is left; the roots of
the trees, in the order of the column's values, are the leaves of a last tree.

How it is spread:

* leaf numbers come from a range cut of (tree, id) (``row_numbers``), so one tree
  may hold any share of the rows;
* levels are taken ``LEVELS`` at a time: a block is a row with the nodes of one
  level that have the same ancestor ``LEVELS`` levels up, at most
  ``arity ** LEVELS`` of them.  A block's ancestor is a node of a block above, so the
  next levels have about a thousandth of the rows;
* on the way down a containment join by (tree, level, ``lo``) gives every block what
  its ancestor's members know: the siblings on the path to the root.  Inside a
  block the ancestor of a node is the one whose interval contains it, and
  its siblings are the nodes in the parent's interval less its own.

Defined results: a null field counts as ``-``; a null tree value is a tree of its
own and comes first; null ids come first in their tree; rows with the same id are
ordered by their leaf, and equal rows have equal digests whatever their order.
Texts are hashed whole.  Only the named columns are read.  An empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.positions import row_numbers
from tessera.session import cut_lineage

LEVELS = 10


def digest_of(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(fields: Sequence[Column]) -> Column:
    """Hash of the fields: ``-`` for a null, else the number of UTF-8 bytes, ``:`` and the value."""
    one = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
           for c in fields]
    return F.sha2(F.concat(*one).cast("binary"), 256)


@dataclass
class Level:
    """Nodes of one level in a block: their intervals of leaf numbers and their digests."""

    lo: np.ndarray
    hi: np.ndarray
    digests: list[str]

    def parents(self, arity: int) -> Level:
        first = np.arange(0, len(self.lo), arity)
        last = np.minimum(first + arity, len(self.lo)) - 1
        return Level(self.lo[first], self.hi[last],
                     [digest_of("".join(self.digests[i:i + arity])) for i in first.tolist()])

    def holding(self, lo: np.ndarray) -> np.ndarray:
        """Number of the node whose interval contains ``lo``."""
        return np.searchsorted(self.lo, lo, side="right") - 1


def levels_of(base: Level, height: int, arity: int) -> list[Level]:
    """The base and ``height`` levels above it."""
    out = [base]
    for _ in range(height):
        out.append(out[-1].parents(arity))
    return out


def siblings(levels: list[Level]) -> list[tuple[list[str], list[str]]]:
    """For every node of the lowest level its siblings up to the highest: those before and those after, by level."""
    sides = []
    for level, above in zip(levels, levels[1:]):
        parent = above.holding(level.lo)
        first = np.searchsorted(level.lo, above.lo[parent], side="left")
        last = np.searchsorted(level.lo, above.hi[parent], side="left")
        sides.append([("".join(level.digests[f:k]), "".join(level.digests[k + 1:e]))
                      for k, (f, e) in enumerate(zip(first.tolist(), last.tolist(), strict=True))])
    at = [level.holding(levels[0].lo).tolist() for level in levels[:-1]]
    return [([sides[h][at[h][i]][0] for h in range(len(sides))], [sides[h][at[h][i]][1] for h in range(len(sides))])
            for i in range(len(levels[0].lo))]


def fold(digest: str, left: Sequence[str], right: Sequence[str]) -> str:
    """The root that a leaf and its siblings lead to."""
    for before, after in zip(left, right, strict=True):
        digest = digest_of(before + digest + after)
    return digest


def height_of(n: int, arity: int, most: int) -> int:
    """Levels above ``n`` nodes until one is left, at most ``most``."""
    h = 0
    while n > 1 and h < most:
        n, h = -(-n // arity), h + 1
    return h


def _blocks(nodes: DataFrame, arity: int, level: int, height: int) -> DataFrame:
    """Nodes (``tree``, ``rank``, ``n``, ``lo``, ``hi``, ``digest``, ``id``, ``changed``) of a level by their ancestor, one row each."""
    members = F.sort_array(F.collect_list(F.struct("rank", "lo", "hi", "digest", "id", "changed")))
    return cut_lineage(
        nodes.groupBy("tree", F.floor(F.col("rank") / arity ** height).alias("above"))
        .agg(members.alias("members"), F.max("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .withColumn("level", F.lit(level)))


def _read(batch: pa.RecordBatch) -> Iterator[tuple[int, Level, pa.StructArray]]:
    """Each block of a batch: its row, its lowest level and its members."""
    for i, members in enumerate(batch.column("members")):
        m = members.values
        yield i, Level(m.field("lo").to_numpy(), m.field("hi").to_numpy(), m.field("digest").to_pylist()), m


def _tops(blocks: DataFrame, arity: int, height: int) -> DataFrame:
    """The ancestors of the blocks as nodes of the next level."""

    def run(batches):
        for batch in batches:
            n = batch.column("n").to_pylist()
            digest = [levels_of(base, height_of(n[i], arity, height), arity)[-1].digests[0] for i, base, _ in _read(batch)]
            left = [-(-x // arity ** height) for x in n]
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), batch.column("above"), pa.array(left, pa.int64()), batch.column("lo"), batch.column("hi"),
                 pa.array(digest, pa.string())], names=["tree", "rank", "n", "lo", "hi", "digest"])

    return blocks.mapInArrow(run, "tree string, rank long, n long, lo long, hi long, digest string")


@dataclass
class Forest:
    """Blocks of every band of levels, lowest first, and the roots (``tree``, ``digest``)."""

    bands: list[DataFrame]
    roots: DataFrame
    arity: int
    height: int

    def nodes(self) -> DataFrame:
        """All nodes: ``tree``, ``level``, ``lo``, ``hi``, ``digest``."""
        arity, height = self.arity, self.height

        def run(batches):
            for batch in batches:
                n, tree, bottom = (batch.column(c).to_pylist() for c in ("n", "tree", "level"))
                for i, base, _ in _read(batch):
                    for h, level in enumerate(levels_of(base, height_of(n[i], arity, height), arity)):
                        if h and h == height and n[i] > arity ** height:
                            continue  # it is in the block above
                        size = len(level.digests)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([tree[i]] * size), pa.array([bottom[i] + h] * size, pa.int32()), pa.array(level.lo, pa.int64()),
                             pa.array(level.hi, pa.int64()), pa.array(level.digests)], names=["tree", "level", "lo", "hi", "digest"])

        return reduce(DataFrame.union, [b.mapInArrow(run, "tree string, level int, lo long, hi long, digest string") for b in self.bands])


def build(leaves: DataFrame, arity: int = 2, height: int = LEVELS) -> Forest:
    """Trees over ``leaves``: ``tree`` (string, not null), ``rank`` from 0, ``n`` leaves of the tree, ``digest``, ``id``, ``changed``."""
    nodes, level, bands, roots = leaves.withColumns({"lo": F.col("rank"), "hi": F.col("rank") + 1}), 0, [], []
    carried = leaves.schema["id"].dataType
    while True:
        bands.append(_blocks(nodes, arity, level, height))
        tops = cut_lineage(_tops(bands[-1], arity, height))
        roots.append(tops.where("n = 1").select("tree", "digest"))
        nodes = tops.where("n > 1").withColumns({"id": F.lit(None).cast(carried), "changed": F.lit(None).cast("string")})
        level += height
        if nodes.isEmpty():
            return Forest(bands, reduce(DataFrame.union, roots), arity, height)


_PATH = "left array<string>, right array<string>"


def paths(forest: Forest, above: DataFrame) -> DataFrame:
    """The lowest blocks with the siblings above them.

    ``above``: per tree ``left`` and ``right``, the siblings of its root by level, and any other columns.
    """
    arity, height = forest.arity, forest.height
    others = [f for f in above.schema.fields if f.name not in ("tree", "left", "right")]
    names = [f.name for f in others]

    def run(batches):
        for batch in batches:
            n, level = batch.column("n").to_pylist(), batch.column("level").to_pylist()
            left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            row, out = [], {"lo": [], "level": [], "left": [], "right": []}
            for i, base, _ in _read(batch):
                found = siblings(levels_of(base, height_of(n[i], arity, height), arity))
                row += [i] * len(found)
                out["lo"] += base.lo.tolist()
                out["level"] += [level[i] - height] * len(found)
                out["left"] += [x + left[i] for x, _ in found]
                out["right"] += [x + right[i] for _, x in found]
            kept = [batch.column(c).take(pa.array(row, pa.int64())) for c in ("tree", *names)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(out["lo"], pa.int64()), pa.array(out["level"], pa.int32()),
                 pa.array(out["left"], pa.list_(pa.string())), pa.array(out["right"], pa.list_(pa.string()))],
                names=["tree", *names, "lo", "level", "left", "right"])

    schema = T.StructType([T.StructField("tree", T.StringType()), *others,
                           *T._parse_datatype_string(f"lo long, level int, {_PATH}").fields])
    known = None  # of the blocks below a band: what its members know
    for band in reversed(forest.bands):
        # the tree's last block of all, or a block whose ancestor is a member of a block above
        whole = band.where(F.col("n") <= arity ** height).join(above, "tree")
        band = whole if known is None else whole.unionByName(
            band.where(F.col("n") > arity ** height).join(known, ["tree", "level", "lo"]))
        known = band.mapInArrow(run, schema)
    return band


def manifest(df: DataFrame, fields: Sequence[str], tree_col: str, id_col: str, changed: Mapping[str, Column] | None = None,
             arity: int = 2, height: int = LEVELS) -> tuple[Forest, Forest]:
    """The trees of ``tree_col``'s values and the tree of their roots; see the module's docstring.

    ``changed`` names fields that are to be tampered with and their new values;
    the digest of a row that differs is kept beside its leaf, for ``proofs``.
    """
    changed = dict(changed or {})
    own, other = [F.col(f"`{c}`") for c in fields], [changed.get(c, F.col(f"`{c}`")) for c in fields]
    same = reduce(lambda a, b: a & b, [a.eqNullSafe(b) for c, a, b in zip(fields, own, other) if c in changed], F.lit(True))
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{tree_col}`").cast("string")), F.lit(""))  # null first, then bytewise
    rows = df.select(tree.alias("tree"), F.col(f"`{id_col}`").alias("id"), leaf(own).alias("digest"),
                     F.when(~same, leaf(other)).alias("changed"))
    ranked = row_numbers(rows, ["id", "digest"], "rank", ["tree"], count_out="n").withColumn("rank", F.col("rank") - 1)
    trees = build(ranked, arity, height)
    roots = row_numbers(trees.roots, ["tree"], "rank", count_out="n").select(
        F.lit("").alias("tree"), (F.col("rank") - 1).alias("rank"), "n", "digest", F.col("tree").alias("id"),
        F.lit(None).cast("string").alias("changed"))
    return trees, build(roots, arity, height)


def proofs(df: DataFrame, fields: Sequence[str], tree_col: str, id_col: str, changed: Mapping[str, Column] | None = None,
           arity: int = 2, height: int = LEVELS) -> DataFrame:
    """One row per input row: its proof, and whether its (tampered) leaf still leads to the root.

    Returns ``id_col``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (hash of the siblings from the leaf to the root,
    left to right in every level), ``folded_root`` (from the changed leaf, if it is one, and the siblings) and ``verified``.
    """
    trees, top = manifest(df, fields, tree_col, id_col, changed, arity, height)
    start = top.roots.select("tree", F.col("digest").alias("root"), F.lit([]).cast("array<string>").alias("left"),
                             F.lit([]).cast("array<string>").alias("right"))
    in_top = paths(top, start)
    names = ["id", "digest", "changed"]

    def per_tree(batches):
        for batch in batches:
            n, left, right, root = (batch.column(c).to_pylist() for c in ("n", "left", "right", "root"))
            for i, base, m in _read(batch):
                found = siblings(levels_of(base, height_of(n[i], arity, height), arity))
                yield pa.RecordBatch.from_arrays(
                    [m.field("id"), m.field("digest"), pa.array([root[i]] * len(found)),
                     pa.array([x + left[i] for x, _ in found], pa.list_(pa.string())),
                     pa.array([x + right[i] for _, x in found], pa.list_(pa.string()))], names=["tree", "subroot", "root", "left", "right"])

    above = cut_lineage(in_top.mapInArrow(per_tree, f"tree string, subroot string, root string, {_PATH}"))
    id_type = df.schema[id_col].dataType

    def per_leaf(batches):
        for batch in batches:
            n, left, right, subroot, root = (batch.column(c).to_pylist() for c in ("n", "left", "right", "subroot", "root"))
            for i, base, m in _read(batch):
                proof, folded = [], []
                upper = "".join(x for pair in zip(left[i], right[i], strict=True) for x in pair)
                found = siblings(levels_of(base, height_of(n[i], arity, height), arity))
                for digest, other, (before, after) in zip(base.digests, m.field("changed").to_pylist(), found, strict=True):
                    proof.append(digest_of("".join(x for pair in zip(before, after, strict=True) for x in pair) + upper))
                    folded.append(fold(fold(other or digest, before, after), left[i], right[i]))
                size = len(found)
                yield pa.RecordBatch.from_arrays(
                    [m.field("id"), m.field("digest"), pa.array([subroot[i]] * size), pa.array([root[i]] * size), pa.array(proof),
                     pa.array(folded), pa.array([x == root[i] for x in folded])],
                    names=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    text = [T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    schema = T.StructType([T.StructField("id", id_type), *text, T.StructField("verified", T.BooleanType())])
    return paths(trees, above).mapInArrow(per_leaf, schema).withColumnRenamed("id", id_col)
