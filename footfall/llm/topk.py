"""Exact top-k by inner product: vectors by descending length, SVD-rotated partial sums, Cauchy-Schwarz bounds.

Components are whole numbers, floor(1024 x). Candidates are ordered by length and packed into blocks; blocks are dealt to stripes, so that
every stripe sees lengths fall. Queries are packed into blocks too, and each block of queries meets every stripe. A stripe keeps the k best of each query so far and

* ends when the next block's greatest length cannot lift any query's product to its k-th best;
* else adds up the products over the leading directions of the rotation (those of the most variance, from the second moments of the whole table),
  and bounds the rest by the lengths of what is left; only pairs whose bound reaches the k-th best get their exact product.

Products are exact integers: doubles hold them while they stay below 2**53, and whole-number arithmetic takes over beyond. The first, longest blocks
are in every stripe's reach as they are dealt in turn. The stripes' lists, k per query and stripe, are merged at the end.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part, nor do rows without a vec_id; vectors are scored against
those of their own length only; rows that repeat an id are candidates of their own but never of a query with that id; rows of one id are one query, with the best products of any of its vectors; ties go to the smaller
vec_id; products beyond 64 bits are held at the bounds of a long; an empty table gives an empty result; only vec_id and embedding are read.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from footfall.llm.common import as_batch
from footfall.llm.vectors import matrix, packed
from footfall.session import materialise

SCALE = 1024.0
K = 10
#: Candidates and queries of a block, and blocks of a stripe.
BLOCK = 4096
QUERIES = 2048
STRIPE = 16
#: Share of the rotated directions in the partial sums.
LEADING = 0.5
EXACT = 2.0**53


def second_moments(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Sum of x x^T over all vectors, by their length: one table of dim x dim sums, added up by Spark."""
    schema = pa.schema([("dim", pa.int32()), ("i", pa.int32()), ("row", pa.list_(pa.float64()))])

    def run(batches: Iterable[pa.RecordBatch]):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims).tolist():
                x = matrix(batch.column(1).filter(pa.array(dims == dim)))
                x = x / max(np.abs(x).max(), 1.0)
                sums[dim] = sums.get(dim, 0) + x.T @ x
        for dim, total in sums.items():
            yield as_batch(schema, [[dim] * dim, list(range(dim)), total.tolist()])

    parts = vectors.select("dim", "v").mapInArrow(run, "dim int, i int, row array<double>")
    cells = parts.select("dim", "i", F.posexplode("row").alias("j", "x")).groupBy("dim", "i", "j").agg(F.sum("x").alias("x"))
    out: dict[int, np.ndarray] = {}
    for dim, i, j, x in cells.toArrow().to_pandas().itertuples(index=False):
        out.setdefault(int(dim), np.zeros((int(dim), int(dim))))[int(i), int(j)] = x
    return out


def pack(rows: DataFrame, size: int) -> DataFrame:
    """Consecutive rows of a partition with one dim and group as blocks: part, norm (of the longest), ids and data."""
    schema = pa.schema([("dim", pa.int32()), ("part", pa.int64()), ("norm", pa.float64()), ("ids", pa.binary()), ("data", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]):
        held: dict[tuple[int, int], list[tuple]] = {}

        def block(key):
            rows = held.pop(key)
            ids = np.array([r[0] for r in rows], np.int64).tobytes()
            return as_batch(schema, [[key[0]], [key[1]], [max(r[2] for r in rows)], [ids], [b"".join(r[1] for r in rows)]])

        for batch in batches:
            for dim, part, i, v, norm in zip(*(batch.column(c).to_pylist() for c in range(5))):
                held.setdefault((dim, part), []).append((i, v, norm))
                if len(held[dim, part]) == size:
                    yield block((dim, part))
        for key in list(held):
            yield block(key)

    return rows.select("dim", "part", "id", "v", "norm").mapInArrow(
        run, "dim int, part long, norm double, ids binary, data binary"
    )


class Search:
    """One block of queries, and the k best of each so far."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, rotation: np.ndarray, k: int):
        self.ids, self.x, self.k, self.rotation = ids, x, k, rotation
        self.lead = max(1, int(LEADING * x.shape[1]))
        turned = x @ rotation
        self.head, self.rest = turned[:, : self.lead], np.sqrt((turned[:, self.lead :] ** 2).sum(axis=1))
        self.norm = np.sqrt((x * x).sum(axis=1))
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]  # (-score, id), best first
        self.least = np.full(len(ids), -np.inf)
        self.scored = self.met = 0

    def spent(self, norm: float) -> bool:
        """Whether no candidate of at most this length can enter any list."""
        return bool((self.norm * norm * (1 + 1e-9) < self.least).all())

    def visit(self, ids: np.ndarray, x: np.ndarray) -> None:
        turned = x @ self.rotation
        rest = np.sqrt((turned[:, self.lead :] ** 2).sum(axis=1))
        norm = np.sqrt((x * x).sum(axis=1))
        bound = self.head @ turned[:, : self.lead].T + self.rest[:, None] * rest[None, :]
        # rounding of the rotation stays far below this share of the lengths
        bound += 1e-9 * self.norm[:, None] * norm[None, :] + 1e-6
        able = (bound >= self.least[:, None]) & (ids[None, :] != self.ids[:, None])
        self.met += able.size
        at, to = np.nonzero(able)
        for start in range(0, len(at), 1 << 18):
            self._enter(at[start : start + (1 << 18)], to[start : start + (1 << 18)], ids, x)

    def _enter(self, at: np.ndarray, to: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        self.scored += len(at)
        if np.abs(self.x).max(initial=0) * np.abs(x).max(initial=0) * x.shape[1] < EXACT:
            score = np.einsum("ij,ij->i", self.x[at], x[to])
            keep = score >= self.least[at]
            at, to, score = at[keep], to[keep], score[keep].astype(np.int64).tolist()
        else:
            limit = 2**63 - 1
            score = [
                max(-limit - 1, min(limit, sum(int(a) * int(b) for a, b in zip(self.x[i], x[j]))))
                for i, j in zip(at.tolist(), to.tolist())
            ]
        cuts = np.flatnonzero(np.diff(at, prepend=-1)).tolist()
        names = ids[to].tolist()
        for start, stop in zip(cuts, [*cuts[1:], len(at)]):
            q = int(at[start])
            self.best[q] = sorted(self.best[q] + [(-score[n], names[n]) for n in range(start, stop)])[: self.k]
            if len(self.best[q]) == self.k:
                self.least[q] = -self.best[q][-1][0]


def top_k(rows: DataFrame, is_query, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k greatest inner products."""
    norm = F.col("norm")
    vectors = materialise(_with_norm(packed(rows, SCALE)), "vectors")
    counts = {d: (n, q) for d, n, q in vectors.groupBy("dim").agg(
        F.count(F.lit(1)).alias("n"), F.sum(is_query(F.col("id")).cast("long")).alias("q")
    ).collect()}
    rotations = {d: np.linalg.eigh(m)[1][:, ::-1].copy() for d, m in second_moments(vectors).items()}
    n_queries = max((-(-q // QUERIES) for _, q in counts.values()), default=0)
    stripes = max((-(-n // (BLOCK * STRIPE)) for n, _ in counts.values()), default=1)

    asked = vectors.where(is_query(F.col("id"))).select("dim", "id", "v", "norm").distinct()
    queries = pack(asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(max(n_queries, 1)))).repartition("dim", "part"), 4 * QUERIES)
    candidates = pack(vectors.withColumn("part", F.lit(0).cast("long")).repartitionByRange("dim", norm.desc()).sortWithinPartitions(
        "dim", norm.desc()
    ), BLOCK)
    dealt = candidates.withColumn("stripe", F.pmod(F.xxhash64("ids"), F.lit(stripes)).cast("int"))
    parts = F.sequence(F.lit(0).cast("long"), F.lit(max(n_queries - 1, 0)).cast("long"))
    met = dealt.withColumns({"part": F.explode(parts), "role": F.lit(1)})
    asking = queries.withColumns({"stripe": F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))), "role": F.lit(0)})
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    turn = rows.sparkSession.sparkContext.broadcast(rotations)  # dim x dim numbers

    def run(batches: Iterable[pa.RecordBatch]):
        key, searches = None, []

        def finished():
            for s in searches:
                found = [(int(s.ids[q]), i, -score) for q, best in enumerate(s.best) for score, i in best]
                if found:
                    yield as_batch(schema, [list(c) for c in zip(*found)])

        for batch in batches:
            for dim, part, stripe, role, longest, ids, data in zip(*(batch.column(c).to_pylist() for c in range(7))):
                if (dim, part, stripe) != key:
                    yield from finished()
                    key, searches = (dim, part, stripe), []
                ids = np.frombuffer(ids, np.int64)
                x = np.frombuffer(data, np.float64).reshape(len(ids), -1)
                if role == 0:
                    searches.append(Search(ids, x, turn.value[dim], k))
                else:
                    for s in searches:
                        if not s.spent(longest):
                            s.visit(ids, x)
        yield from finished()

    columns = ["dim", "part", "stripe", "role", "norm", "ids", "data"]
    blocks = asking.select(columns).unionByName(met.select(columns)).repartition("dim", "part", "stripe")
    lists = blocks.sortWithinPartitions("dim", "part", "stripe", "role", norm.desc()).mapInArrow(
        run, "query_id long, vec_id long, score long"
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _with_norm(vectors: DataFrame) -> DataFrame:
    schema = pa.schema([("id", pa.int64()), ("dim", pa.int32()), ("v", pa.binary()), ("norm", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            norms = [float(np.sqrt((np.frombuffer(v, np.float64) ** 2).sum())) for v in batch.column(2).to_pylist()]
            yield as_batch(schema, [batch.column(0), batch.column(1), batch.column(2), norms])

    return vectors.mapInArrow(run, "id long, dim int, v binary, norm double")
