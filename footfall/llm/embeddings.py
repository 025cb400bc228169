"""Embedding near-dedup: a forest of random-projection trees with spill overlap.

Equal vectors are one class with a representative. Each tree halves the unit vectors again and again along random directions, at the median of
a bounded sample; vectors within a margin of a cut go to both sides. The margin is a share of how far apart the projections
of a pair at the threshold usually are, so such a pair is separated at a level with probability 0.026, and every tree
is a fresh chance. Every vector is compared with all others in its leaves, links are verified by exact cosine in
double precision, and leaves hand on spanning edges, of which components are made.

All links lie within components. So the number of a vector's links is counted there: every two members of a
component are compared, once, which also counts links that no leaf held. Groups (leaves, components) are
compared by blocks of bounded size, pairs of blocks in tasks of their own, so none is held by one task.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing; rows without a vec_id
likewise, and have no component; vectors of other length are never compared; repeated rows are vectors of their own;
an empty table gives an empty result; only vec_id and embedding are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import as_batch, doc_draw
from footfall.llm.components import components
from footfall.llm.vectors import matrix, packed
from footfall.session import materialise


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.9
    trees: int = 6
    #: Vectors that the cuts are taken from, and those a leaf should hold of the table.
    sample: int = 40_000
    leaf: int = 1200
    least_sample: int = 12
    depth: int = 36
    #: Margin of a cut, in standard deviations of the projected difference of a pair at the threshold.
    margin: float = 0.54
    block: int = 2048
    seed: int = 11


@dataclass
class Tree:
    """Inner nodes by path: a direction and its cut. A path is 1, then a bit per turn."""

    directions: dict[int, np.ndarray]
    cuts: dict[int, float]

    def leaves(self, x: np.ndarray, margin: float) -> list[tuple[int, np.ndarray]]:
        """(path, rows) of every leaf that rows of x fall into."""
        out, waiting = [], [(1, np.arange(len(x)))]
        while waiting:
            path, rows = waiting.pop()
            if not len(rows):
                continue
            if path not in self.cuts:
                out.append((path, rows))
                continue
            at = x[rows] @ self.directions[path] - self.cuts[path]
            waiting += [(2 * path, rows[at <= margin]), (2 * path + 1, rows[at > -margin])]
        return out


def plant(sample: np.ndarray, total: int, s: Settings, tree: int) -> Tree:
    """A tree over a sample that stands for ``total`` vectors."""
    rng = np.random.default_rng([s.seed, tree, sample.shape[1]])
    margin = spill(sample.shape[1], s)
    least = max(s.least_sample, s.leaf * len(sample) / max(total, 1))
    grown = Tree({}, {})
    waiting = [(1, np.arange(len(sample)))]
    while waiting:
        path, rows = waiting.pop()
        if len(rows) <= least or path.bit_length() > s.depth:
            continue
        direction = rng.normal(size=sample.shape[1])
        direction /= np.linalg.norm(direction)
        at = sample[rows] @ direction
        cut = float(np.median(at))
        sides = rows[at <= cut + margin], rows[at > cut - margin]
        if max(map(len, sides)) > 0.9 * len(rows):
            continue  # closer together than the margin: no cut along any direction tells them apart
        grown.directions[path], grown.cuts[path] = direction, cut
        waiting += [(2 * path, sides[0]), (2 * path + 1, sides[1])]
    return grown


def spill(dim: int, s: Settings) -> float:
    return s.margin * math.sqrt(2 - 2 * s.threshold) / math.sqrt(dim)


def forests(classes: DataFrame, s: Settings) -> dict[int, list[Tree]]:
    """Trees for each length of vectors, from a bounded repeatable sample."""
    out = {}
    for dim, total in classes.groupBy("dim").count().collect():
        of_dim = classes.where(F.col("dim") == dim)
        share = min(1.0, s.sample / total)
        drawn = of_dim.where(doc_draw("forest", F.col("id")) < share) if share < 1 else of_dim
        table = drawn.select("id", "v").toArrow().sort_by("id")
        if table.num_rows:
            sample = matrix(table.column(1))
            out[dim] = [plant(sample, total, s, t) for t in range(s.trees)]
    return out


def in_leaves(classes: DataFrame, grown: dict[int, list[Tree]], s: Settings, vectors: bool = True) -> DataFrame:
    """A row (kind, path, id, v) for each leaf that each vector falls into; kind tells length and tree.

    Without ``vectors``, v is null: finding the leaves again is cheaper than writing all copies to count them.
    """
    schema = pa.schema([("kind", pa.int64()), ("path", pa.int64()), ("id", pa.int64()), ("v", pa.binary())])
    shared = classes.sparkSession.sparkContext.broadcast(grown)  # bounded by the sample

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                rows = batch.take(pa.array(np.flatnonzero(dims == dim)))
                x = matrix(rows.column(2))
                for t, tree in enumerate(shared.value.get(dim, ())):
                    for path, places in tree.leaves(x, spill(dim, s)):
                        part = rows.take(pa.array(places))
                        n = len(places)
                        v = part.column(2) if vectors else [None] * n
                        yield as_batch(schema, [[dim * 1000 + t] * n, [path] * n, part.column(0), v])

    return classes.select("id", "dim", "v").mapInArrow(run, "kind long, path long, id long, v binary")


def by_blocks(rows: DataFrame, keys: list[str], block: int, counted: DataFrame | None = None) -> DataFrame:
    """``rows`` once for each pair (i, j) of blocks of their group that they are compared in.

    A group of up to ``block`` rows is one block, compared with itself. ``own`` tells the block a row is of. ``counted`` may
    stand in for the rows where they are counted.
    """
    sizes = (rows if counted is None else counted).groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks")).where(F.count(F.lit(1)) > 1)
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).alias("own")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    return rows.join(sizes, keys).select(*rows.columns, "blocks", own).select("*", other).select(
        *rows.columns, "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )


def _within(table: pa.Table, threshold: float) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Ids, and the places of linking pairs with the second place's block the greater where blocks differ."""
    own = table.column("own").to_numpy()
    order = np.argsort(own, kind="stable")
    table, own = table.take(pa.array(order)), own[order]
    x = matrix(table.column("v"))
    first = int(np.searchsorted(own, own[0], "right"))
    single = table.column("i")[0] == table.column("j")[0]
    left, right, shift = (x, x, 0) if single else (x[:first], x[first:], first)
    a, b = np.nonzero(left @ right.T >= threshold)
    keep = a < b if single else np.ones(len(a), bool)
    return table.column("id").to_pylist(), a[keep], b[keep] + shift, x


def spanning_links(blocks: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """Spanning edges (a, b) of the links between the rows of each pair of blocks."""
    def run(table: pa.Table) -> pa.Table:
        ids, a, b, _ = _within(table, threshold)
        parent = list(range(len(ids)))
        edges = []
        for i, j in zip(a.tolist(), b.tolist()):
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            while parent[j] != j:
                parent[j] = j = parent[parent[j]]
            if i != j:
                parent[j] = i
                edges.append((ids[i], ids[j]))
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return blocks.groupBy(*keys, "i", "j").applyInArrow(run, "a long, b long")


def link_counts(blocks: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """id and n: the vectors linked with it within each pair of blocks; ``size`` vectors stand behind each row."""
    def run(table: pa.Table) -> pa.Table:
        ids, a, b, _ = _within(table, threshold)
        order = np.argsort(table.column("own").to_numpy(), kind="stable")
        size = table.column("size").to_numpy()[order]
        n = np.bincount(a, size[b], len(ids)) + np.bincount(b, size[a], len(ids))
        return pa.table({"id": pa.array(ids, pa.int64()), "n": pa.array(n.astype(np.int64))})

    return blocks.groupBy(*keys, "i", "j").applyInArrow(run, "id long, n long")


def near_duplicates(rows: DataFrame, settings: Settings | None = None) -> DataFrame:
    """vec_id, n_links, component_id (least vec_id reachable by links) and kept, per row."""
    s = settings or Settings()
    unit = materialise(packed(rows), "unit")
    same = unit.groupBy("v").agg(F.min("id").alias("class"), F.count(F.lit(1)).alias("size"))
    classes = materialise(same.select(F.col("class").alias("id"), (F.octet_length("v") / 8).cast("int").alias("dim"), "v", "size"), "classes")
    members = materialise(unit.select("id", "v").join(same, "v").select("id", "class", "size"), "members")
    # one id on unequal vectors stands for several classes, which belong together as rows of one id do
    twins = members.groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a <> b").select("a", "b")

    grown = forests(classes, s)
    leaves, bare = (in_leaves(classes, grown, s, vectors) for vectors in (True, False))
    keys = ["kind", "path"]
    edges = spanning_links(by_blocks(leaves, keys, s.block, bare), keys, s.threshold)
    found = materialise(components(edges.unionByName(twins)), "components")
    in_component = classes.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    blocks = by_blocks(in_component.select("component", "dim", "id", "v", "size"), ["component", "dim"], s.block)
    counts = link_counts(blocks, ["component", "dim"], s.threshold).groupBy("id").agg(F.sum("n").alias("n"))
    linked = classes.select("id").distinct().join(found, "id", "left").join(counts, "id", "left").select(
        F.col("id").alias("class"), F.coalesce("component", "id").alias("component_id"), F.coalesce("n", F.lit(0)).alias("n")
    )
    valid = members.join(linked, "class").select(
        F.col("id").alias("vec_id"), (F.col("n") + F.col("size") - 1).alias("n_links"), "component_id"
    )
    # rows that take no part: as many as the table has more of an id than there are valid ones
    every = rows.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.count(F.lit(1)).alias("rows"))
    took = unit.groupBy(F.col("id").alias("vec_id")).agg(F.count(F.lit(1)).alias("valid"))
    idle = every.join(took, "vec_id", "left").withColumn("idle", F.col("rows") - F.coalesce("valid", F.lit(0))).where("idle > 0")
    alone = idle.select("vec_id", F.explode(F.sequence(F.lit(1).cast("long"), F.col("idle")))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return valid.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
