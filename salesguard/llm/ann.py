"""Nearest neighbours by largest inner product: a block matrix join.

Query blocks meet candidate blocks in cells. In a cell, tiles of int8 codes
are multiplied; each product comes with a bound on what quantisation can have
changed, and only pairs whose upper bound reaches the k-th largest lower bound
are computed again in double precision. Every cell sends at most k pairs for
each query, merged by heaps. The result is exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesguard.llm.columns import need

HITS = "query_id long, vec_id long, score double"
TILE, PAIRS = 512, 32_768


def usable(vec: Column) -> Column:
    """A vector that takes part: not null, no null or non-finite component, not all zero."""
    good = F.forall(vec, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")),
                                              F.lit(False)))
    return F.coalesce(good & F.exists(vec, lambda x: x != 0), F.lit(False))


class Coded:
    """Vectors with int8 codes; ``code * scale`` is off by a vector of norm ``err`` at most."""

    def __init__(self, x: np.ndarray):
        self.x = x
        scale = np.abs(x).max(axis=1) / 127
        scale[scale == 0] = 1e-300
        self.code = np.rint(x / scale[:, None]).astype(np.int8)
        near = self.code * scale[:, None]
        grow = 1 + 1e-9                                   # above what double rounding can lose
        self.scale = scale
        self.near = np.sqrt((near * near).sum(axis=1)) * grow
        self.norm = np.sqrt((x * x).sum(axis=1)) * grow
        self.err = np.sqrt(((x - near) ** 2).sum(axis=1)) * grow + 1e-12 * self.norm

    def take(self, at) -> Coded:
        out = object.__new__(Coded)
        for k, v in self.__dict__.items():
            setattr(out, k, v[at])
        return out


def code_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact product of int8 codes. Float32 sums of up to 1,024 products of
    codes are whole numbers below 2**24, so the fast product is exact."""
    out = np.zeros((len(a), len(b)))
    for d in range(0, a.shape[1], 1024):
        out += a[:, d:d + 1024].astype(np.float32) @ b[:, d:d + 1024].astype(np.float32).T
    return out


def exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of row pairs; the order of summation is always the same."""
    return (q * c).sum(axis=1)


def cell(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """The k best (query, candidate, score) of each query in a cell, exactly; ties to the smaller candidate."""
    # A query wants k candidates and may itself be one, so of equal vectors the k + 1 smallest ids are enough.
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], np.ascontiguousarray(c[order])
    _, same = np.unique(c.view([("", c.dtype)] * c.shape[1]).ravel(), return_inverse=True)
    by = np.argsort(same.ravel(), kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(same.ravel()[by]) != 0])
    nth = np.arange(len(by)) - np.repeat(starts, np.diff(np.r_[starts, len(by)]))
    keep = np.sort(by[nth <= k])
    c_ids, cand, out = c_ids[keep], Coded(c[keep]), []
    whole = Coded(q)
    for at in range(0, len(q_ids), TILE):
        part, ids = whole.take(slice(at, at + TILE)), q_ids[at:at + TILE]
        approx = code_product(part.code, cand.code) * part.scale[:, None] * cand.scale[None, :]
        bound = part.near[:, None] * cand.err[None, :] + part.err[:, None] * cand.norm[None, :]
        own = ids[:, None] == c_ids[None, :]
        low = approx - bound
        low[own] = -np.inf
        floor = (np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k] if low.shape[1] >= k
                 else np.full(len(ids), -np.inf))
        i, j = np.nonzero((approx + bound >= floor[:, None]) & ~own)
        score = np.empty(len(i))
        for p in range(0, len(i), PAIRS):
            score[p:p + PAIRS] = exact(part.x[i[p:p + PAIRS]], cand.x[j[p:p + PAIRS]])
        cuts = np.searchsorted(i, np.arange(len(ids) + 1))
        for n, qid in enumerate(ids):
            a, b = cuts[n], cuts[n + 1]
            best = heapq.nsmallest(k, zip((-score[a:b]).tolist(), c_ids[j[a:b]].tolist(), strict=True))
            out += [(int(qid), v, -s) for s, v in best]
    return out


def block_matrix_join(queries: DataFrame, candidates: DataFrame, k: int = 20, id_col: str = "vec_id",
                      vec_col: str = "embedding", q_block: int = 8192, c_block: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k nearest of all candidates but itself.

    Both sides have ``id_col`` and ``vec_col``; ids name a row
    (rows with a null id take no part; of rows that repeat an id, the one with the
    least vector of each length counts, component by component).
    Vectors null, empty, all zero or with null or non-finite components take no
    part, on either side; vectors of different lengths never meet. Equal scores
    go to the smaller id. A query with no candidate gives no rows. Cells hold
    about ``q_block`` by ``c_block`` vectors, dealt by a hash of the id.
    """

    def side(df: DataFrame) -> DataFrame:
        rows = need(df, id_col, vec_col).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
        return rows.where(usable(F.col("vec")) & F.col("id").isNotNull()).select(
            "id", F.col("vec").cast("array<double>").alias("vec"), F.size("vec").alias("dim"))

    q, c = side(queries), side(candidates)
    n_q, n_c = (max(1, -(-df.count() // size)) for df, size in ((q, q_block), (c, c_block)))
    mine = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = q.withColumn("qb", mine(n_q)).withColumn("cb", all_of(n_c))
    c = c.withColumn("cb", mine(n_c)).withColumn("qb", all_of(n_q))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if left.num_rows and right.num_rows:
            rows = cell(*unpack(left), *unpack(right), k)
        names, kinds = ("query_id", "vec_id", "score"), (pa.int64(), pa.int64(), pa.float64())
        columns = list(zip(*rows, strict=True)) or [[]] * 3
        return pa.table([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names=list(names))

    def unpack(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = t.column("id").to_numpy()
        flat = t.column("vec").combine_chunks()
        flat = flat.flatten().to_numpy(zero_copy_only=False)
        vec = flat.reshape(t.num_rows, -1).astype(np.float64)
        order = np.argsort(ids, kind="stable")
        if (np.diff(ids[order]) == 0).any():               # of a repeated id the least vector
            order = np.lexsort((*vec.T[::-1], ids))
        first = order[np.diff(ids[order], prepend=ids[order[0]] - 1) != 0]
        return ids[first], vec[first]

    hits = (q.groupBy("dim", "qb", "cb").cogroup(c.groupBy("dim", "qb", "cb")).applyInArrow(meet, HITS))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, heap = None, []
        for b in batches:
            rows = []
            for qid, vid, s in zip(*(b.column(n).to_pylist() for n in range(3)), strict=True):
                if qid != query:
                    rows += ranked(query, heap)
                    query, heap = qid, []
                item = (s, -vid)
                if len(heap) < k:
                    heapq.heappush(heap, item)
                else:
                    heapq.heappushpop(heap, item)
            yield batch(rows)
        yield batch(ranked(query, heap))

    def ranked(query, heap):
        return [(query, n, -v, s) for n, (s, v) in enumerate(sorted(heap, reverse=True), 1)]

    def batch(rows):
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.float64()), strict=True)],
            ["query_id", "rank", "vec_id", "score"])

    return (hits.repartition("query_id").sortWithinPartitions("query_id")
            .mapInArrow(merge, "query_id long, rank int, vec_id long, score double"))
