"""Near-duplicate vectors by dual traversal of cover trees: exact pairs over a cosine threshold.

Vectors of one label and length, scaled to length 1, are near by cosine if they
are near by distance, |x - y|^2 = 2 - 2 cos. Equal vectors are one class.

1. The top of each large label's tree is fitted on a bounded sample of its
   classes (`sample`, by hash): nested levels with halving radii give as many
   centres as the label needs cells. Every class goes to its nearest centre, and
   an aggregate gives each cell's true covering radius.
2. Pairs of cells whose centres are further apart than the two radii and the
   threshold allow are dropped with all that is in them. A cell beyond `shard`
   classes goes in parts of that size, so a task never holds more than two.
3. Each pair of parts that is left is a task of its own, which builds a cover
   tree over each part (nodes cover their members within radii that halve) and
   walks both trees at once. A pair of nodes too far apart is dropped with all
   below it; a pair so close that every member of one links with every member of
   the other is counted whole. What is left at the leaves is settled by cosine
   in double precision.

A task returns how many vectors each vector links with and a spanning forest of
the links, never all pairs; links are counted exactly. Where a label's vectors
are unrelated, no radius under their mutual distance prunes, and the work is
quadratic in the label's distinct vectors; it is then spread over the pairs of
parts.

Defined cases: a null label, a null, empty or zero vector and one with null or
non-finite components link with nothing; so do vectors of different lengths;
repeated rows are vectors of their own that link with each other if valid; a
null vec_id has a null component; other columns do not matter; an empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import materialize, scratch
from .streams import runs

_MARGIN = 1e-9


def _distance(dots: np.ndarray) -> np.ndarray:
    """Distances of unit vectors with these dot products."""
    return np.sqrt(np.maximum(2 - 2 * dots, 0.0))


class CoverTree:
    """Levels of a cover tree over the rows of x (unit vectors).

    levels[l] is (centres, parents, radii, bounds): the row of each node's
    centre, the place of its parent in the level above, the distance of its
    furthest member and where its members begin in `members`, which lists rows
    so that the nodes of any level are contiguous.
    """

    def __init__(self, x: np.ndarray, least: float, top: float = 2.0):
        n = len(x)
        dots = x @ x.T  # of one part: its size is bounded
        order, bounds = np.arange(n), np.array([0, n])
        self.levels = [(np.zeros(1, dtype=int), np.zeros(1, dtype=int), _distance(dots[0].min(initial=1.0, keepdims=True)), bounds)]
        radius = top
        while radius > least and len(bounds) - 1 < n:
            radius /= 2
            close = 1 - radius * radius / 2  # the dot product of vectors so far apart
            centres, parents, lowest, new_order, sizes = [], [], [], [], []
            single = np.diff(bounds) == 1
            for node, (lo, hi) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
                rows = order[lo:hi]
                if single[node]:
                    centres.append(rows[0])
                    parents.append(node)
                    lowest.append(1.0)
                    new_order.append(rows)
                    sizes.append(1)
                    continue
                while len(rows):  # the first row left becomes a centre and covers what is within the radius
                    c = rows[0]
                    d = dots[c][rows]
                    near = d >= close
                    near[0] = True
                    members = rows[near]
                    centres.append(c)
                    parents.append(node)
                    lowest.append(d[near][1:].min(initial=1.0))
                    new_order.append(members)
                    sizes.append(len(members))
                    rows = rows[~near]
            order, bounds = np.concatenate(new_order), np.concatenate([[0], np.cumsum(sizes)])
            self.levels.append((np.array(centres), np.array(parents), _distance(np.array(lowest)), bounds))
        self.members = order

    def members_at(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Rows below some nodes, node after node."""
        bounds = self.levels[level][3]
        n = bounds[nodes + 1] - bounds[nodes]
        return self.members[np.repeat(bounds[nodes] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def _by_first(i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each first element of the pairs (as an array of one), all second ones."""
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    cuts = np.flatnonzero(np.diff(i, prepend=-1))
    return zip(np.split(i[cuts], range(1, len(cuts))) if len(cuts) else [], np.split(j, cuts[1:]))


def _children(tree: CoverTree, level: int) -> tuple[np.ndarray, np.ndarray]:
    """First child of each node of a level and its number of children in the next one."""
    parents = tree.levels[level + 1][1]
    counts = np.bincount(parents, minlength=len(tree.levels[level][0]))
    return np.concatenate([[0], np.cumsum(counts)[:-1]]), counts


def dual_traversal(x: np.ndarray, y: np.ndarray, cosine: float, same: bool, wx: np.ndarray, wy: np.ndarray):
    """Links between the rows of x and of y (unit vectors with multiplicities wx, wy).

    Returns the links' summed multiplicities per row of x and of y and edges
    (i, j) that connect what the links connect. same: y is x, each pair once.
    """
    reach = float(np.sqrt(2 - 2 * cosine))
    a = CoverTree(x, reach / 8)
    b = a if same else CoverTree(y, reach / 8)
    count_x, count_y = np.zeros(len(x)), np.zeros(len(y))
    edges: list[np.ndarray] = []

    def known(rows: np.ndarray, cols: np.ndarray) -> None:
        """All rows link with all cols."""
        count_x[rows] += wy[cols].sum()
        count_y[cols] += wx[rows].sum()
        edges.append(np.concatenate([np.stack([rows, np.full(len(rows), cols[0])]), np.stack([np.full(len(cols), rows[0]), cols])], axis=1))

    def settle(rows: np.ndarray, cols: np.ndarray, within: bool = False) -> None:
        """All pairs of rows and cols by cosine; within: of one node with itself, each pair once."""
        hit = x[rows] @ y[cols].T >= cosine
        if within:
            hit = np.triu(hit, 1)
        if hit.any():
            count_x[rows] += hit @ wy[cols]
            count_y[cols] += wx[rows] @ hit
            i, j = np.nonzero(hit)
            edges.append(np.stack([rows[i], cols[j]]))

    pairs = (np.zeros(1, dtype=int), np.zeros(1, dtype=int))
    la = lb = 0
    while True:
        ca, _, ra, ba = a.levels[la]
        cb, _, rb, bb = b.levels[lb]
        kept_i, kept_j = [], []
        # many pairs of few nodes: one matrix product gives all their distances
        dense = x[ca] @ y[cb].T if 8 * len(pairs[0]) >= len(ca) * len(cb) else None
        for at in range(0, len(pairs[0]), 200_000):  # bounded memory
            i, j = pairs[0][at : at + 200_000], pairs[1][at : at + 200_000]
            dot = dense[i, j] if dense is not None else np.einsum("ij,ij->i", x[ca[i]], y[cb[j]])
            d = _distance(dot)
            near = d <= ra[i] + rb[j] + reach + _MARGIN
            whole = near & (d + ra[i] + rb[j] <= reach - 1e-6)
            if same:
                whole &= i != j
            for p, q in _by_first(i[whole], j[whole]):
                known(a.members_at(la, p), b.members_at(lb, q))  # no two nodes of a level share a row
            kept_i.append(i[near & ~whole])
            kept_j.append(j[near & ~whole])
        i, j = np.concatenate(kept_i), np.concatenate(kept_j)
        last_a, last_b = la == len(a.levels) - 1, lb == len(b.levels) - 1
        if not len(i) or (last_a and last_b):
            own = same & (i == j)
            for p, q in _by_first(i[~own], j[~own]):
                settle(a.members_at(la, p), b.members_at(lb, q))
            for p in i[own & (np.diff(ba)[i] > 1)]:
                rows = a.members_at(la, np.array([p]))
                settle(rows, rows, True)
            break
        if not last_a:
            first, n = _children(a, la)
            step = n[i]
            i, j = np.repeat(first[i], step) + (np.arange(step.sum()) - np.repeat(np.cumsum(step) - step, step)), np.repeat(j, step)
            la += 1
        if not last_b:
            first, n = _children(b, lb)
            step = n[j]
            j, i = np.repeat(first[j], step) + (np.arange(step.sum()) - np.repeat(np.cumsum(step) - step, step)), np.repeat(i, step)
            lb += 1
        if same:
            i, j = i[i <= j], j[i <= j]
        pairs = (i, j)
    return count_x, count_y, np.concatenate(edges, axis=1) if edges else np.zeros((2, 0), dtype=int)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place in each place's component, for places 0 .. n - 1."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compared(blocks: DataFrame, cosine: float) -> DataFrame:
    """(node, links, root) of the linked rows in each group of rows (grp, side, node, copies, embedding)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in runs(batches, "grp"):
            side, node, copies = (table.column(c).to_numpy() for c in ("side", "node", "copies"))
            vectors = table.column("embedding").combine_chunks()
            for lo, hi in zip(starts, starts[1:]):
                v = _unit(vectors.slice(lo, hi - lo))
                s, w, names = side[lo:hi], copies[lo:hi].astype(float), node[lo:hi]
                if (s == 2).all():
                    cx, cy, (i, j) = dual_traversal(v, v, cosine, True, w, w)
                    counts, total = cx + cy, names
                else:
                    left, right, w_l, w_r = v[s == 0], v[s == 1], w[s == 0], w[s == 1]
                    if not len(left) or not len(right):
                        continue
                    cx, cy, (i, j) = dual_traversal(left, right, cosine, False, w_l, w_r)
                    counts, total, j = np.concatenate([cx, cy]), np.concatenate([names[s == 0], names[s == 1]]), j + len(left)
                linked = np.flatnonzero(counts)
                if len(linked):
                    root = total[_roots(len(total), i, j)]
                    yield pa.RecordBatch.from_arrays([pa.array(total[linked], pa.int64()), pa.array(np.rint(counts[linked]).astype(np.int64)), pa.array(root[linked], pa.int64())], names=["node", "links", "root"])

    return blocks.repartition("grp").sortWithinPartitions("grp").mapInArrow(work, "node long, links long, root long")


def _unit(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column, scaled to length 1."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    v = np.array(column.flatten().to_numpy(zero_copy_only=False), dtype=float).reshape(len(column), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _centres(some: DataFrame) -> DataFrame:
    """(label, dim, cell, centre) of each label's top levels, from its sample (label, dim, cells, embedding)."""

    def work(table: pa.Table) -> pa.Table:
        x, wanted = _unit(table.column("embedding")), table.column("cells")[0].as_py()
        levels = CoverTree(x, 0.05).levels
        deep = next((centres for centres, *_ in levels if len(centres) >= wanted), levels[-1][0])
        above = next((centres for centres, *_ in reversed(levels) if len(centres) < wanted), deep[:0])
        chosen = [*above, *(c for c in deep if c not in set(above.tolist()))][:wanted]  # a level's nodes, then as many of the next one
        k = len(chosen)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(k + 1) * x.shape[1], pa.int32()), pa.array(x[chosen].ravel()))
        return pa.table([pa.array([table.column("label")[0].as_py()] * k, pa.string()), pa.array([table.column("dim")[0].as_py()] * k, pa.int32()), pa.array(range(k), pa.int32()), lists], names=["label", "dim", "cell", "centre"])

    return some.groupBy("label", "dim").applyInArrow(work, "label string, dim int, cell int, centre array<double>")


def _assigned(rows: DataFrame, centres: DataFrame) -> DataFrame:
    """(node, cell, distance) of each row's nearest centre; both sides by (label, dim, salt)."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.float64())], names=["node", "cell", "distance"])
        order = np.argsort(right.column("cell").to_numpy())
        c, best = _unit(right.column("centre"))[order], []
        x = _unit(left.column("embedding"))
        for at in range(0, len(x), 4096):  # bounded memory
            dots = x[at : at + 4096] @ c.T
            cell = dots.argmax(axis=1)
            best.append((cell, dots[np.arange(len(cell)), cell]))
        cell, dots = (np.concatenate(b) for b in zip(*best))
        return pa.table([left.column("node"), pa.array(cell, pa.int32()), pa.array(_distance(dots))], names=["node", "cell", "distance"])

    keys = ["label", "dim", "salt"]
    return rows.groupBy(*keys).cogroup(centres.groupBy(*keys)).applyInArrow(work, "node long, cell int, distance double")


def _blocks(classes: DataFrame, reach: float, shard: int, sample: int) -> DataFrame:
    """The rows (grp, side, node, copies, embedding) of every pair of parts that may hold links; side 2 is a part with itself."""
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("size"))
    sizes = materialize(sizes.withColumn("cells", F.ceil(F.col("size") / shard).cast("int")).withColumn("salts", F.ceil(F.col("size") / 65_536).cast("int")), "vec-sizes")
    large = sizes.where("cells > 1")
    one = classes.join(sizes.where("cells = 1").select("label", "dim"), ["label", "dim"]).select("label", "dim", "node", F.lit(0).alias("cell"))
    spread = classes.join(large, ["label", "dim"])
    some = spread.where(F.pmod(F.xxhash64("node", F.lit("sample")), F.greatest(F.floor(F.col("size") / sample), F.lit(1))) == 0)
    centres = materialize(_centres(some.select("label", "dim", "cells", "embedding")), "vec-centres")
    each = centres.join(large.select("label", "dim", "salts"), ["label", "dim"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    salted = spread.withColumn("salt", F.pmod(F.xxhash64("node", F.lit("salt")), F.col("salts")).cast("int"))
    found = materialize(_assigned(salted.select("label", "dim", "salt", "node", "embedding"), each.select("label", "dim", "salt", "cell", "centre")), "vec-assigned")
    placed = materialize(classes.join(found, "node").select("label", "dim", "node", "cell", "distance"), "vec-placed")
    cells = placed.groupBy("label", "dim", "cell").agg(F.count("*").alias("size"), F.max("distance").alias("radius")).join(centres, ["label", "dim", "cell"])
    cells = cells.withColumn("parts", F.ceil(F.col("size") / shard).cast("int"))
    a, b = (cells.select("label", "dim", *(F.col(c).alias(f"{c}_{k}") for c in ("cell", "radius", "centre", "parts"))) for k in "ab")
    apart = F.sqrt(F.aggregate(F.zip_with("centre_a", "centre_b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    pairs = a.join(b, ["label", "dim"]).where("cell_a <= cell_b").where((F.col("cell_a") == F.col("cell_b")) | (apart <= F.col("radius_a") + F.col("radius_b") + reach + _MARGIN))
    pairs = pairs.select("label", "dim", "cell_a", "cell_b", "parts_a", "parts_b").unionByName(sizes.where("cells = 1").select("label", "dim", *(F.lit(v).alias(c) for c, v in (("cell_a", 0), ("cell_b", 0), ("parts_a", 1), ("parts_b", 1)))))
    number = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    pairs = pairs.withColumn("part_a", number("parts_a")).withColumn("part_b", number("parts_b")).where("cell_a < cell_b OR part_a <= part_b")
    pairs = materialize(pairs.withColumn("grp", F.xxhash64("label", "dim", "cell_a", "part_a", "cell_b", "part_b")), "vec-pairs")
    same = (F.col("cell_a") == F.col("cell_b")) & (F.col("part_a") == F.col("part_b"))
    left = pairs.select("label", "dim", F.col("cell_a").alias("cell"), F.col("part_a").alias("part"), "grp", F.when(same, 2).otherwise(0).alias("side"))
    right = pairs.where(~same).select("label", "dim", F.col("cell_b").alias("cell"), F.col("part_b").alias("part"), "grp", F.lit(1).alias("side"))
    parts = cells.select("label", "dim", "cell", "parts")
    dealt = placed.join(parts, ["label", "dim", "cell"]).select("node", "cell", F.pmod(F.xxhash64("node", F.lit("part")), F.col("parts")).cast("int").alias("part"))
    dealt = dealt.unionByName(one.select("node", "cell", F.lit(0).alias("part")))
    return classes.join(dealt, "node").join(left.unionByName(right), ["label", "dim", "cell", "part"]).select("grp", "side", "node", "copies", "embedding")


def near_vectors(vectors: DataFrame, cosine: float = 0.98, shard: int = 2048, sample: int = 4096) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row; links are cosines of at least `cosine` within a label."""
    e = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), e.alias("embedding"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    valid = F.coalesce(F.col("label").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", finite) & F.exists("embedding", lambda x: finite(x) & (x != 0)), F.lit(False))
    # two hashes name a vector: 128 bits, so that strangers do not share a class
    f1, f2 = (F.when(valid, F.xxhash64(F.lit(k), "label", "embedding")) for k in (1, 2))
    rows = rows.withColumn("f1", f1).withColumn("f2", f2)
    classes = rows.where("f1 IS NOT NULL").groupBy("f1", "f2").agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    with scratch() as keep:
        classes = materialize(classes.withColumn("dim", F.size("embedding")).withColumn("node", F.monotonically_increasing_id()), "vec-classes")  # written: a class keeps its number
        found = materialize(_compared(_blocks(classes, math.sqrt(2 - 2 * cosine), shard, sample), cosine), "vec-links")
        parts = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vec-parts").withColumnRenamed("root", "part")
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        named = classes.select("node", "f1", "f2", "copies", "least").join(links, "node", "left").join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
        named = materialize(named, "vec-parts-of-classes")
        least = materialize(named.groupBy("part").agg(F.min("least").alias("component_id")), "vec-least")
        result = keep(materialize(named.join(least, "part").select("f1", "f2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "vec-result"))
    out = rows.select("vec_id", "f1", "f2").join(result, ["f1", "f2"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
