"""Exact near-duplicate vectors by dual traversal of cover trees.

On unit vectors a cosine of at least t is a distance of at most e = sqrt(2 - 2t). The top level of the cover is a few
centres from a bounded sample. A vector is at home in the cell of its nearest centre and a guest in each earlier cell
whose border it is no further from than e; two vectors within e of each other always meet, once, in the earlier of
their home cells. A cell with many vectors is cut into blocks, each two of which meet in a group of their own.

In a group each side is a cover tree: nested levels of nodes, radii halved from level to level. Pairs of nodes are
descended from the roots and dropped once their centres are further apart than both covering radii and e. What is left
at the leaves is compared exactly. Equal vectors are one row with a count, and a group gives counts of links and local
roots, not pairs, so rows never grow with the square of a group of copies.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm import vectors
from reviewlens.llm.common import slices, stored
from reviewlens.llm.components import components


@dataclass(frozen=True)
class CoverConfig:
    """`sample` vectors at most are read to choose the `centres`; all vectors are compared."""

    threshold: float = 0.98
    centres: int = 16
    sample: int = 2000
    block: int = 1024
    leaf: int = 8

    @property
    def reach(self) -> float:
        return float(np.sqrt(2 - 2 * self.threshold)) + 1e-9


def units(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, by their largest component first so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def far_apart(x: np.ndarray, n: int) -> np.ndarray:
    """Up to `n` rows, each the furthest from those before."""
    if not len(x):
        return x
    chosen, near = [0], np.full(len(x), np.inf)
    while len(chosen) < n:
        near = np.minimum(near, ((x - x[chosen[-1]]) ** 2).sum(1))
        if near.max() <= 0:
            break
        chosen.append(int(near.argmax()))
    return x[chosen]


# ---------------------------------------------------------------- trees


@dataclass
class Node:
    centre: int
    radius: float
    members: np.ndarray
    children: list[Node] = field(default_factory=list)


def cover_tree(x: np.ndarray, rows: np.ndarray, leaf: int) -> Node:
    """Cover tree over some rows. A node's first child keeps its centre; children's centres are further apart than half
    the node's radius, and every member is with the nearest of them."""

    def node(centre: int, members: np.ndarray) -> Node:
        away = np.sqrt(((x[members] - x[centre]) ** 2).sum(1))
        return Node(centre, float(away.max()), members)

    root = node(int(rows[0]), rows)
    waiting = [root]
    while waiting:
        top = waiting.pop()
        if len(top.members) <= leaf or top.radius <= 0:
            continue
        own = x[top.members]
        centre, near, which, centres = top.centre, None, None, []
        while True:
            away = ((own - x[centre]) ** 2).sum(1)
            if near is None:
                near, which = away, np.zeros(len(own), dtype=np.int64)
            else:
                closer = away < near
                near[closer], which[closer] = away[closer], len(centres)
            centres.append(centre)
            furthest = int(near.argmax())
            if near[furthest] <= (top.radius / 2) ** 2:
                break
            centre = int(top.members[furthest])
        order = np.argsort(which, kind="stable")
        cuts = np.searchsorted(which[order], np.arange(len(centres) + 1))
        for k, centre in enumerate(centres):
            members = top.members[order[cuts[k] : cuts[k + 1]]]
            top.children.append(node(centre, members) if len(members) > 1 else Node(centre, 0.0, members))
        waiting += top.children
    return root


def close_pairs(x: np.ndarray, a: Node, b: Node, reach: float, at_most: int = 200_000):
    """Pairs of rows, one under each node, that may be within reach, in portions; a node with itself: each pair once."""

    def parts(node: Node) -> list[Node]:
        return node.children or [node]

    def leaves(p: Node, q: Node) -> tuple[np.ndarray, np.ndarray]:
        i, j = np.repeat(p.members, len(q.members)), np.tile(q.members, len(p.members))
        keep = i < j if p is q else np.ones(len(i), dtype=bool)
        return i[keep], j[keep]

    waiting, out, held = [(a, b)], [], 0
    while waiting:
        p, q = waiting.pop()
        left, right = parts(p), parts(q)
        if len(left) == 1 and left[0] is p and len(right) == 1 and right[0] is q:
            out.append(leaves(p, q))
            held += len(out[-1][0])
        else:
            one = np.array([n.centre for n in left])
            two = one if p is q else np.array([n.centre for n in right])
            bound = np.array([n.radius for n in left])[:, None] + np.array([n.radius for n in right])[None, :] + reach
            # The small addition covers the rounding of 2 - 2 cos, which is largest near distance 0.
            near = 2 - 2 * (x[one] @ x[two].T) <= bound * bound + 1e-9
            if p is q:
                near &= np.arange(len(one))[:, None] <= np.arange(len(one))[None, :]
            k, m = np.nonzero(near)
            single = np.array([len(n.members) == 1 for n in left])[k] & np.array(
                [len(n.members) == 1 for n in right])[m]
            if p is q:
                single &= k != m
            out.append((one[k[single]], two[m[single]]))
            held += int(single.sum())
            waiting += [(left[s], right[t]) for s, t in zip(k[~single].tolist(), m[~single].tolist())]
        if held > at_most:
            yield np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])
            out, held = [], 0
    if out:
        yield np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


class Roots:
    """Sets of rows that hang together, each named by its smallest row."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.of[i], self.of[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.of, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(self.of, self.of[self.of]):
                self.of = self.of[self.of]


def compare(x: np.ndarray, left: np.ndarray, right: np.ndarray | None, copies: np.ndarray, cfg: CoverConfig):
    """Number of vectors linked with each row, and the first row it hangs together with.

    Rows of `left` are compared with those of `right`, or with each other where that is None.
    """
    u = units(x)
    linked, roots = np.zeros(len(x), dtype=np.int64), Roots(len(x))
    if len(left) and (right is None or len(right)):
        a = cover_tree(u, left, cfg.leaf)
        b = a if right is None else cover_tree(u, right, cfg.leaf)
        length = np.sqrt((x * x).sum(1))
        for i, j in close_pairs(u, a, b, cfg.reach):
            for start in range(0, len(i), 50_000):
                s, t = i[start : start + 50_000], j[start : start + 50_000]
                cosine = (x[s] * x[t]).sum(1) / (length[s] * length[t])
                # Lengths whose squares leave the range of doubles are compared as unit vectors.
                odd = ~np.isfinite(cosine) | (length[s] * length[t] < 1e-290)
                cosine[odd] = (u[s[odd]] * u[t[odd]]).sum(1)
                hit = cosine >= cfg.threshold
                s, t = s[hit], t[hit]
                np.add.at(linked, s, copies[t])
                np.add.at(linked, t, copies[s])
                roots.join(s, t)
    return linked, roots.of


# ---------------------------------------------------------------- on Spark


def _cells(classes: DataFrame, centres: np.ndarray, reach: float) -> DataFrame:
    """Every class in its home cell and in those where it is a guest."""
    apart = np.sqrt(np.maximum(((centres[:, None] - centres[None]) ** 2).sum(-1), 1e-30)) if len(centres) else None

    def placed(batch: pa.RecordBatch) -> pa.RecordBatch:
        u = units(vectors.matrix(batch["vector"]))
        if u.shape[1] == centres.shape[1]:
            away = (u * u).sum(1)[:, None] + (centres * centres).sum(1)[None] - 2 * u @ centres.T
            home = away.argmin(1)
            border = (away - away[np.arange(len(u)), home][:, None]) / (2 * apart[home])
            visits = (border <= reach + 1e-9) & (np.arange(len(centres))[None] < home[:, None])
            visits[np.arange(len(u)), home] = True
            row, cell = np.nonzero(visits)
            at_home = cell == home[row]
        else:  # a dimension that the sample did not have
            row, cell = np.arange(len(u)), np.zeros(len(u), dtype=np.int64)
            at_home = np.ones(len(u), dtype=bool)
        taken = batch.take(pa.array(row))
        return pa.record_batch([*taken.columns, pa.array(cell, pa.int32()), pa.array(at_home)],
                               names=[*batch.schema.names, "cell", "home"])

    def run(batches):
        for batch in slices(batches, 1024):
            dims = np.asarray(batch["dim"])
            for dim in np.unique(dims):
                yield placed(batch.filter(pa.array(dims == dim)))

    schema = classes.withColumns({"cell": F.lit(0), "home": F.lit(True)}).schema
    return classes.mapInArrow(run, schema)


def near_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 cfg: CoverConfig = CoverConfig()) -> DataFrame:
    """`key`, `n_links`, `component_id`, `kept` for each row.

    Two rows are linked if their labels are equal and not null, their vectors have the same dimension and a cosine of
    at least the threshold. Vectors that are null, empty, zero or hold null or non-finite components link with nothing.
    `n_links` counts the other rows linked directly, copies among them; `component_id` is the smallest key reachable by
    links, the row's own included; `kept` marks the row (with a repeated key: rows) of that key. Rows with a null key
    take part, and a null counts as larger than any key. Other columns are dropped; an empty table stays empty.
    """
    rows = stored(
        table.select(
            F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(label).alias("label"),
            F.col(vector).cast("array<double>").alias("vector"),
        ).withColumn("takes", vectors.usable(F.col("vector")) & F.col("label").isNotNull())
        .withColumn("print", F.when(F.col("takes"), vectors.fingerprint(F.col("vector")))), "vectors")
    part = rows.filter("takes")
    classes = stored(part.groupBy("label", "print").agg(
        F.min("row").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")), "classes")
    sample = vectors.sample(
        classes.join(_dimension(classes), F.size("vector") == F.col("dim"), "left_semi"), F.xxhash64("print", "rep"),
        cfg.sample, "vector")
    centres = far_apart(units(sample), cfg.centres) if len(sample) else sample
    cells = _cells(classes.select("label", F.size("vector").alias("dim"), "rep", "copies", "vector"), centres, cfg.reach)
    spots = ["label", "dim", "cell"]
    sizes = stored(cells.drop("vector").groupBy(*spots).agg(
        F.ceil(F.count_if("home") / cfg.block).cast("int").alias("homes"),
        F.ceil(F.count_if(~F.col("home")) / cfg.block).cast("int").alias("guests")), "sizes").filter("homes > 0")

    def meet(first, second, inner):
        return F.struct(first.alias("lo"), second.alias("hi"), F.lit(inner).alias("inner"))

    def up_to(n):
        return F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))

    block = F.when(F.col("home"), F.pmod(F.xxhash64("rep"), F.col("homes"))).otherwise(
        F.pmod(F.xxhash64("rep"), F.greatest("guests", F.lit(1)))).cast("int")
    groups = F.when(
        F.col("home"),
        F.concat(
            F.transform(up_to("homes"), lambda o: meet(F.least("block", o), F.greatest("block", o), True)),
            F.transform(up_to("guests"), lambda o: meet(F.col("block"), o, False))),
    ).otherwise(F.transform(up_to("homes"), lambda o: meet(o, F.col("block"), False)))
    placed = cells.join(sizes, spots).withColumn("block", block).select(
        *spots, "rep", "copies", "vector", "home", "block", F.explode(groups).alias("g")).select(
        *spots, "rep", "copies", "vector", "home", "block", "g.*")

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("rep")
        rep, copies = np.asarray(group["rep"]), np.asarray(group["copies"])
        home, place = np.asarray(group["home"]), np.asarray(group["block"])
        inner, lo, hi = group["inner"][0].as_py(), group["lo"][0].as_py(), group["hi"][0].as_py()
        if inner:
            left = np.flatnonzero(place == lo)
            right = None if lo == hi else np.flatnonzero(place == hi)
        else:
            left, right = np.flatnonzero(home), np.flatnonzero(~home)
        linked, root = compare(vectors.matrix(group["vector"]), left, right, copies, cfg)
        hit = linked > 0
        return pa.table({"rep": rep[hit], "linked": linked[hit], "root": rep[root[hit]]})

    found = stored(
        placed.groupBy(*spots, "lo", "hi", "inner").applyInArrow(run, "rep long, linked long, root long"), "found")
    linked = found.groupBy("rep").agg(F.sum("linked").alias("linked"))
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    of_class = (
        classes.select("label", "print", "rep", "copies")
        .join(linked, "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    )
    whole = stored(
        rows.select("row", "key", "label", "print").join(of_class, ["label", "print"], "left").select(
            "row", "key", "copies", "linked", F.coalesce("root", "rep", F.col("row")).alias("top")), "members")
    # Stored, so that a component with very many rows is a skewed join that Spark can split, not part of an aggregate.
    least = stored(whole.groupBy("top").agg(F.min("key").alias("least")), "least")
    return whole.join(least, "top").select(
        F.col("key").alias(key),
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        F.col("least").alias("component_id"),
        F.col("key").eqNullSafe(F.col("least")).alias("kept"),
    )


def _dimension(classes: DataFrame) -> DataFrame:
    """The most frequent dimension, as a table of one row."""
    sizes = classes.groupBy(F.size("vector").alias("dim")).count()
    return sizes.orderBy(F.desc("count"), F.desc("dim")).limit(1).select("dim")
