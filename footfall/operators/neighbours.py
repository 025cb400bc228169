"""Exact nearest neighbours without comparing every pair.

Distinct points are cut into cells: a cell with more rows than a block is halved along its widest coordinate, at the
median of points drawn from it, again and again, all cuts in one pass over the points; every cell keeps its box. A point's neighbours inside its own cell bound how far its true ones
can be; the distance to a cell's box, over all coordinates, bounds the distance to its points from below. So a point visits only cells whose
box is within its bound: the nearest few first, then those still within the bound that these leave. Which cells can matter to any point of a cell is found by
descending the tree of boxes, level by level, as joins of cells with nodes; both are tables.

Work is grouped by (home cell, visited cell): neither side of a group exceeds a block, and a group sends on
at most ``k`` rows per point. Copies of a point are one row with a count, so no number of copies fills a cell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.session import materialise

BLOCK_ROWS = 8192
#: Cells that are visited before bounds are tightened.
NEAREST_CELLS = 4
#: Points drawn from an overfull cell to plan its cuts, and the fewest drawn points on one side of a cut.
SAMPLE = 1 << 16
LEAST_DRAWN = 32
_CHUNK = 256
_ROOT = "r"


def distinct_points(df: DataFrame, point: str = "x") -> DataFrame:
    """(vid, x, copies): points told apart by the md5 of their coordinates."""
    return df.groupBy("vid").agg(F.any_value(point).alias("x"), F.count(F.lit(1)).alias("copies"))


def _closest(
    ids: np.ndarray, points: np.ndarray, ref_ids: np.ndarray, refs: np.ndarray, k: int,
    bound: np.ndarray | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For chunks of points: positions of points and of references, and squared distances, of the k
    closest other references by (distance, id), within the bound if one is known. Squares are summed
    coordinate by coordinate."""
    order = np.argsort(ref_ids, kind="stable")
    ref_ids, refs = ref_ids[order], refs[order]
    for start in range(0, len(ids), _CHUNK):
        part = slice(start, start + _CHUNK)
        squares = np.zeros((len(ids[part]), len(ref_ids)))
        for axis in range(points.shape[1]):
            gap = points[part, axis][:, None] - refs[:, axis][None, :]
            squares += gap * gap
        squares[ids[part][:, None] == ref_ids[None, :]] = np.inf
        if bound is not None and np.isfinite(bound[part]).all():
            limit = bound[part]
        else:
            last = min(k, squares.shape[1]) - 1
            limit = np.partition(squares, last, axis=1)[:, last]
        row, col = np.nonzero((squares <= limit[:, None]) & np.isfinite(squares))
        found = squares[row, col]
        by = np.lexsort((col, found, row))
        row, col, found = row[by], col[by], found[by]
        first = np.searchsorted(row, row, side="left")
        keep = np.arange(len(row)) - first < k
        yield row[keep] + start, order[col[keep]], found[keep]


def _matrix(points: pd.Series) -> np.ndarray:
    return np.array(points.tolist(), dtype=float)


def _lists(columns: list[np.ndarray], row: np.ndarray, n: int) -> list[list[np.ndarray]]:
    """Each column cut into one piece per point; ``row`` names the point of each entry, in order."""
    stops = np.searchsorted(row, np.arange(1, n))
    return [np.split(c, stops) for c in columns]


def _inside(k: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Neighbours in the home cell, and the distance of the k-th."""

    def find(frame: pd.DataFrame) -> pd.DataFrame:
        ids, points = frame["vid"].to_numpy(), _matrix(frame["x"])
        row, col, found = (np.concatenate(c) for c in zip(*_closest(ids, points, ids, points, k)))
        distances, others = _lists([found, ids[col]], row, len(ids))
        return pd.DataFrame({
            "vid": ids, "d": distances, "other": others,
            "bound": [d[-1] if len(d) == k else np.inf for d in distances],
        })

    return find


def _visiting(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def find(guests: pd.DataFrame, hosts: pd.DataFrame) -> pd.DataFrame:
        out = {"vid": [], "d": [], "other": []}
        if len(guests) and len(hosts):
            ids, bound = guests["vid"].to_numpy(), guests["bound"].to_numpy()
            ref_ids = hosts["host_vid"].to_numpy()
            refs = _matrix(hosts["host_x"])
            for row, col, found in _closest(ids, _matrix(guests["x"]), ref_ids, refs, k, bound):
                out["vid"].extend(ids[row])
                out["d"].extend(found)
                out["other"].extend(ref_ids[col])
        # Object columns: an empty column of pandas' own string type has no Arrow array to send on.
        return pd.DataFrame({name: pd.Series(column, dtype=object) for name, column in out.items()})

    return find


def _sum(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def _box_distance(low: Column, high: Column, box_low: Column, box_high: Column, dimensions: int) -> Column:
    """Squared distance between two boxes; a point is a box of its own."""
    gaps = [
        F.greatest(box_low[i] - high[i], low[i] - box_high[i], F.lit(0.0)) for i in range(dimensions)
    ]
    return _sum([g * g for g in gaps])


def _plant(block_rows: int, least: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A split tree over the drawn points of one cell, as arrays by node: axis (-1: a leaf), cut, first child, name."""

    def plant(frame: pd.DataFrame) -> pd.DataFrame:
        points, total = _matrix(frame["x"]), int(frame["n"].iloc[0])
        scale = total / len(points)
        # a drawn share is an estimate: leaves of it are planned smaller, and not from too few points
        room, least_drawn = (block_rows, 1) if scale <= 1 else (0.75 * block_rows, least)
        axes, cuts, children, names, waiting = [-1], [0.0], [0], [""], [(0, np.arange(len(points)))]
        while waiting:
            node, held = waiting.pop()
            if len(held) * scale <= room or len(held) < 2 * least_drawn:
                continue
            here = points[held]
            low, high = here.min(axis=0), here.max(axis=0)
            axis = int(np.argmax(high - low))
            if not high[axis] > low[axis]:
                continue
            along = here[:, axis]
            middle = np.partition(along, (len(held) - 1) // 2)[(len(held) - 1) // 2]
            # a cut below the greatest value leaves points on both sides
            cut = middle if middle < high[axis] else low[axis]
            axes[node], cuts[node], children[node] = axis, float(cut), len(axes)
            for digit, side in (("0", held[along <= cut]), ("1", held[along > cut])):
                waiting.append((len(axes), side))
                axes.append(-1)
                cuts.append(0.0)
                children.append(0)
                names.append(names[node] + digit)
        return pd.DataFrame({
            "cell": [frame["cell"].iloc[0]], "n": [total], "axes": [axes], "cuts": [cuts], "children": [children], "names": [names],
        })

    return plant


def _route(points: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
    """The leaf of each point in its cell's tree."""
    if points.empty or trees.empty:
        return pd.DataFrame({name: pd.Series([], dtype=object) for name in ("vid", "x", "cell")})
    tree = trees.iloc[0]
    axes, cuts, children = (np.asarray(tree[c]) for c in ("axes", "cuts", "children"))
    names = np.asarray(tree["names"], dtype=object)
    matrix, at = _matrix(points["x"]), np.zeros(len(points), dtype=np.int64)
    moving = np.flatnonzero(axes[at] >= 0)
    while len(moving):
        node = at[moving]
        at[moving] = children[node] + (matrix[moving, axes[node]] > cuts[node])
        moving = moving[axes[at[moving]] >= 0]
    return pd.DataFrame({"vid": points["vid"], "x": points["x"], "cell": tree["cell"] + names[at]})


def cells(
    points: DataFrame, dimensions: int, block_rows: int, sample: int = SAMPLE, least: int = LEAST_DRAWN
) -> tuple[DataFrame, DataFrame]:
    """(vid, x, cell) of every point, and the boxes (node, low, high, leaf) of all cells and of those they were cut from.

    A round draws about ``sample`` points of each overfull cell (all, if it holds fewer), plants a tree over them that goes on
    until a leaf should fit a block or has too few drawn points, and sends the cell's points down that tree in one pass; a
    part of a cell goes with a copy of its tree, so no task holds a cell. Only cells that are still overfull go on. A round
    divides a cell by up to ``sample / (2 * least)``, so the number of rounds, and of writes, is the logarithm to that
    base, not the depth of the tree: one write for up to ``sample`` points, two for billions. A node's name is its parent's and a digit.
    """
    placed = points.select("vid", "x", F.lit(_ROOT).alias("cell"))
    done, turn = [], 0
    while True:
        counted = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        full = materialise(counted.where(F.col("n") > block_rows), "full")
        if full.isEmpty():
            done.append(placed)
            break
        done.append(placed.join(full, "cell", "left_anti"))
        draw = F.pmod(F.xxhash64("vid", F.lit(turn)), F.lit(1 << 40)) / float(1 << 40) * F.col("n") < sample
        drawn = placed.join(full, "cell").where(draw)
        trees = materialise(drawn.groupBy("cell").applyInPandas(
            _plant(block_rows, least),
            "cell string, n long, axes array<int>, cuts array<double>, children array<int>, names array<string>",
        ), "trees")
        parts = F.ceil(F.col("n") / float(sample)).cast("int")
        copies = trees.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        guests = placed.join(full.withColumn("parts", parts), "cell").select(
            "vid", "x", "cell", F.pmod(F.xxhash64("vid", F.lit(-1)), F.col("parts")).cast("int").alias("part")
        )
        placed = materialise(guests.groupBy("cell", "part").cogroup(copies.groupBy("cell", "part")).applyInPandas(
            _route, "vid string, x array<double>, cell string"
        ), "cells")
        turn += 1
    whole = done[0] if len(done) == 1 else reduce(DataFrame.unionByName, done)
    if len(done) > 2:
        whole = materialise(whole, "placed")
    corner = [F.array(*[f(F.col("x")[i]) for i in range(dimensions)]) for f in (F.min, F.max)]
    leaves = whole.groupBy("cell").agg(corner[0].alias("low"), corner[1].alias("high"))
    # a node's box holds the boxes of the cells whose names begin with its own
    above = leaves.select("cell", "low", "high", F.explode(F.sequence(F.lit(1), F.length("cell"))).alias("upto"))
    bounds = [
        F.array(*[f(F.col(side)[i]) for i in range(dimensions)]).alias(side) for f, side in ((F.min, "low"), (F.max, "high"))
    ]
    nodes = above.groupBy(F.expr("substring(cell, 1, upto)").alias("node")).agg(
        *bounds, F.bool_or(F.length("cell") == F.col("upto")).alias("leaf")
    )
    return whole, materialise(nodes, "nodes")


def _reachable(homes: DataFrame, nodes: DataFrame, dimensions: int) -> DataFrame:
    """(home, host, gap): other cells within the largest bound of any point of a cell."""
    boxes = nodes.select("node", F.col("low").alias("box_low"), F.col("high").alias("box_high"), "leaf")
    gap = _box_distance(F.col("low"), F.col("high"), F.col("box_low"), F.col("box_high"), dimensions)
    front = homes.withColumn("node", F.lit(_ROOT))
    found = []
    while True:
        met = materialise(front.join(boxes, "node").withColumn("gap", gap).where(F.col("gap") <= F.col("reach")), "front")
        found.append(met.where("leaf and node <> home").select("home", F.col("node").alias("host"), "gap"))
        inner = met.where(~F.col("leaf"))
        if inner.isEmpty():
            return reduce(DataFrame.unionByName, found)
        front = inner.select("home", "low", "high", "reach", F.explode(
            F.array(F.concat("node", F.lit("0")), F.concat("node", F.lit("1")))
        ).alias("node"))


def _visit(placed: DataFrame, bounds: DataFrame, meetings: DataFrame, nodes: DataFrame, dimensions: int, k: int) -> DataFrame:
    """(vid, d, other) of what points find in the cells their home meets, where the box is within the point's bound."""
    boxes = nodes.where("leaf").select(F.col("node").alias("host"), F.col("low").alias("box_low"), F.col("high").alias("box_high"))
    away = _box_distance(F.col("x"), F.col("x"), F.col("box_low"), F.col("box_high"), dimensions)
    guests = placed.join(bounds, "vid").select(F.col("cell").alias("home"), "vid", "x", "bound").join(
        meetings.select("home", "host"), "home"
    ).join(boxes, "host").where(away <= F.col("bound")).select("home", "host", "vid", "x", "bound")
    hosts = placed.select(F.col("cell").alias("host_cell"), F.col("vid").alias("host_vid"), F.col("x").alias("host_x")).join(
        meetings.select(F.col("home").alias("guest_cell"), F.col("host").alias("host_cell")), "host_cell"
    ).groupBy("guest_cell", "host_cell")
    return guests.groupBy("home", "host").cogroup(hosts).applyInPandas(_visiting(k), "vid string, d double, other string")


def _best(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(W.partitionBy("vid").orderBy("d", "other"))
    return found.withColumn("place", place).where(F.col("place") <= k)


def nearest(points: DataFrame, dimensions: int, k: int = 5, block_rows: int = BLOCK_ROWS, sample: int = SAMPLE, least: int = LEAST_DRAWN) -> DataFrame:
    """(vid, place, d2, other) for the k nearest other points, squared Euclidean distance, ties by id."""
    placed, nodes = cells(points, dimensions, block_rows, sample, least)
    home = materialise(placed.groupBy("cell").applyInPandas(
        _inside(k), "vid string, d array<double>, other array<string>, bound double"
    ), "home")
    found = home.select("vid", F.inline(F.arrays_zip("d", "other")))
    bounds = home.select("vid", "bound")
    if nodes.where(~F.col("leaf")).isEmpty():
        return _best(found, k).select("vid", "place", F.col("d").alias("d2"), "other")
    leaves = nodes.where("leaf").select(F.col("node").alias("home"), "low", "high")
    reach = placed.join(bounds, "vid").groupBy(F.col("cell").alias("home")).agg(F.max("bound").alias("reach"))
    ranked = materialise(_reachable(leaves.join(reach, "home"), nodes, dimensions).withColumn(
        "turn", F.row_number().over(W.partitionBy("home").orderBy("gap", "host"))
    ), "meetings")
    for near in (True, False):
        turn = F.col("turn") <= NEAREST_CELLS
        more = _visit(placed, bounds, ranked.where(turn if near else ~turn), nodes, dimensions, k)
        found = materialise(_best(found.unionByName(more), k), "found")
        bounds = found.groupBy("vid").agg(
            F.when(F.count(F.lit(1)) == k, F.max("d")).otherwise(float("inf")).alias("bound")
        )
        found = found.select("vid", "d", "other") if near else found
    return found.select("vid", "place", F.col("d").alias("d2"), "other")


def visited_share(points: DataFrame, dimensions: int, k: int, block_rows: int) -> float:
    """The share of all pairs of other cells that any point of a cell can need, after its home cell is searched."""
    placed, nodes = cells(points, dimensions, block_rows)
    home = placed.groupBy("cell").applyInPandas(_inside(k), "vid string, d array<double>, other array<string>, bound double")
    reach = placed.join(home, "vid").groupBy(F.col("cell").alias("home")).agg(F.max("bound").alias("reach"))
    leaves = nodes.where("leaf").select(F.col("node").alias("home"), "low", "high")
    n = leaves.count()
    return _reachable(leaves.join(reach, "home"), nodes, dimensions).count() / max(n * (n - 1), 1)
