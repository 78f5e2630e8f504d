"""Nearest neighbours by a block matrix join with int8 product tiles.

Candidates are dealt to fragments and queries to blocks, both of bounded
size, and every (fragment, block) cell is one task's work: rows are copied
once per block (or fragment) of the other side and meet by an equi-join on
the cell.  Inside a cell unit vectors are quantised to int8; a product tile
approximates all cosines at once, and each row's quantisation error bounds
how far an approximation can be off:

    |u.v - (su qu).(sv qv)| <= |su qu| ev + eu,   e = |u - s q|.

Only candidates whose upper bound reaches the k-th best lower bound of
their query are recomputed, in double precision on the original vectors.
Cells keep their k best per query in a heap; the heaps of a query's cells
are merged.  The result is exact: the bounds never drop a true neighbour.

Defined results: a vector that is null, empty, zero or holds a null or
non-finite component takes no part; vectors of different lengths are not
compared; ties go to the smaller id; equal rows are separate candidates, but
never one with the query's own id; a null id takes no part; fewer than k
candidates are all returned; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwx.llm.store import cut

FRAGMENT = 8192
BLOCK = 512
TILE = 64


def usable(vector: str) -> Column:
    """Whether the cosine with ``vector`` is defined."""
    c = F.col(vector)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(c) > 0) & finite & F.exists(c, lambda x: x != 0), F.lit(False))


def quantise(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, scale, norm of what they stand for, and error norm, of the
    unit vectors along ``rows`` (double)."""
    # scaled by the largest component first, so that no square over- or underflows
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    unit = rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    stood = q * scale[:, None]
    gap = unit - stood
    return q, scale, np.sqrt((stood * stood).sum(axis=1)), np.sqrt((gap * gap).sum(axis=1))


def tile_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of int8 rows; single-precision products of at most 1024
    components are exact whole numbers below 2**24."""
    out = np.zeros((len(a), len(b)), np.float64)
    for k in range(0, a.shape[1], 1024):
        out += a[:, k:k + 1024].astype(np.float32) @ b[:, k:k + 1024].astype(np.float32).T
    return out


def cosine(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines in double precision; each row is summed alike wherever it stands."""
    dots = (rows * query).sum(axis=1)
    return dots / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum()))


def cell_best(qrow, queries, crow, cid, candidates, k: int):
    """(query row, candidate id, score) of the k best candidates per query
    row; a row is no candidate of its own."""
    cq, cs, cn, ce = quantise(candidates)
    qq, qs, qn, qe = quantise(queries)
    for a in range(0, len(queries), TILE):
        part = slice(a, a + TILE)
        near = tile_products(qq[part], cq) * qs[part, None] * cs[None, :]
        slack = qn[part, None] * ce[None, :] + qe[part, None] + 1e-9
        own = qrow[part, None] == crow[None, :]
        low = np.where(own, -np.inf, near - slack)
        best = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] > k else np.full(len(low), -np.inf)
        open_ = (near + slack >= best[:, None]) & ~own
        for r in range(len(low)):
            some = np.flatnonzero(open_[r])
            if len(some):
                score = cosine(queries[a + r], candidates[some])
                top = heapq.nsmallest(k, zip((-score).tolist(), cid[some].tolist()))
                for s, c in top:
                    yield a + r, c, -s


def _cells(k):
    def solve(rows):
        sides = [[r for r in rows if r[0] == s] for s in (0, 1)]
        if sides[0] and sides[1]:
            (crow, cid, cand), (qrow, qid, quer) = [
                (*(np.array([r[i] for r in s], np.int64) for i in (1, 2)), np.array([r[3] for r in s], np.float64)) for s in sides]
            for q, c, score in cell_best(qrow, quer, crow, cid, cand, k):
                yield qrow[q], qid[q], c, score

    def pack(out):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)],
                                          ["query_row", "query_id", "vec_id", "score"])

    def run(batches):
        last, rows = None, []
        for batch in batches:
            cols = [batch.column(c) for c in ("dim", "f", "b", "side", "row", "id", "v")]
            flat = cols[6].flatten().to_numpy(zero_copy_only=False)
            stop = 0
            for *at, side, row, i in zip(*[c.to_pylist() for c in cols[:6]]):
                if at != last:
                    yield pack(list(solve(rows)))
                    last, rows = at, []
                rows.append((side, row, i, flat[stop:stop + at[0]]))
                stop += at[0]
        yield pack(list(solve(rows)))
    return run


def cells(rows: DataFrame) -> DataFrame:
    """Candidates (side 0) and queries (side 1) by cell.  ``rows``: row, id,
    v, q, dim; rows are dealt by their own number, so that neither ids nor
    vectors that repeat can fill a cell."""
    grid = rows.groupBy("dim").agg(
        F.ceil(F.count("*") / FRAGMENT).cast("long").alias("nf"),
        F.ceil(F.count_if("q") / BLOCK).cast("long").alias("nb")).filter("nb > 0")
    spot = F.xxhash64("row")
    rows = rows.join(grid, "dim")

    def upto(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    given = rows.select("dim", F.pmod(spot, F.col("nf")).alias("f"), upto("nb").alias("b"), F.lit(0).alias("side"), "row", "id", "v")
    asked = rows.filter("q").select("dim", upto("nf").alias("f"), F.pmod(spot, F.col("nb")).alias("b"),
                                    F.lit(1).alias("side"), "row", "id", "v")
    return given.unionByName(asked)


def search(vectors: DataFrame, queries: Column, k: int = 5, vector: str = "embedding", id_: str = "vec_id") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of each row for
    which ``queries`` holds."""
    rows = vectors.select(F.col(id_).cast("long").alias("id"), F.col(vector).alias("v"), queries.alias("q")).filter(
        usable("v") & F.col("id").isNotNull()).withColumn("dim", F.size("v"))
    rows = cut(rows.withColumns({"v": F.col("v").cast("array<double>"), "row": F.monotonically_increasing_id()}), "vectors")
    dealt = cells(rows).repartition("dim", "f", "b").sortWithinPartitions("dim", "f", "b")
    best = dealt.mapInArrow(_cells(k), "query_row bigint, query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
