"""Exact top-k inner products by Fagin's threshold algorithm.

Vectors are quantised to integers. Queries are dealt to blocks and candidates to groups;
every (block, group) pair is a unit of work that streams the group's candidates in
shards. A shard holds one sorted list per dimension. For a query the lists are read from
the end its component prefers, all new candidates are scored exactly, and reading stops
when the threshold - the score of a vector made of the last values read - cannot beat the
k-th result. Results carry over from shard to shard of a unit, and candidates near the
same pivot share shards, so that thresholds fall early.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 2048
BLOCK_ROWS = 512
PIVOTS = 16
FIRST_DEPTH = 8


def quantised(vector: Column) -> Column:
    """floor(256 * x) of each component as long; null where a component is null or not finite."""
    wide = vector.cast("array<double>")
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), F.transform(wide, lambda x: F.floor(x * 256).cast("long")))


class Shard:
    """Candidates with a sorted list per dimension."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids = ids
        large = float(np.abs(matrix).max(initial=0))
        # Products and sums below 2^53 are exact in floating point, which is faster.
        self.exact = large
        self.matrix = matrix.astype(float) if large < 2 ** 31 else matrix
        self.order = np.argsort(matrix, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.matrix, self.order, axis=0)

    def search(self, query: np.ndarray, own: int, k: int, best: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], int]:
        """The best ``k`` (-score, id) of ``best`` and this shard, and how many candidates were scored."""
        n, used = len(self.ids), np.flatnonzero(query)
        safe = self.exact * float(np.abs(query).max(initial=0)) * max(len(query), 1) < 2 ** 53
        matrix = self.matrix if safe or self.matrix.dtype == np.int64 else self.matrix.astype(np.int64)
        q = query.astype(matrix.dtype)
        up = query[used] > 0
        seen = np.zeros(n, bool)
        scored, done, depth = 0, 0, min(FIRST_DEPTH, n)
        while done < n:
            if len(used):
                rows = np.arange(done, depth)
                rows = np.where(up[None, :], n - 1 - rows[:, None], rows[:, None])
                fresh = np.zeros(n, bool)
                fresh[self.order[rows, used[None, :]].ravel()] = True
                at = np.flatnonzero(fresh & ~seen)
                seen |= fresh
            else:
                at, depth = np.arange(n), n
            if len(at):
                scores = (matrix[at] @ q).astype(np.int64)
                scored += len(at)
                other = self.ids[at] != own
                at, scores = at[other], scores[other]
                if len(best) == k:
                    good = scores >= -best[-1][0]
                    at, scores = at[good], scores[good]
                if len(at):
                    top = np.lexsort((self.ids[at], -scores))[:k]
                    best = sorted([*best, *zip((-scores[top]).tolist(), self.ids[at[top]].tolist())])[:k]
            done = depth
            if len(used) and len(best) == k:
                last = np.where(up, self.sorted[n - done, used], self.sorted[done - 1, used])
                # A safe bound is an exact integer; one that equals the k-th score may hide a smaller id.
                if safe and int(last.astype(float) @ query[used].astype(float)) < -best[-1][0]:
                    break
            depth = min(n, depth * 4)
        return best, scored


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the highest inner product for each query.

    Queries are the rows where ``is_query`` holds; candidates are all rows but those with
    the query's id. Ties go to the smaller id; fewer candidates give fewer rows. Vectors
    that are null or hold null or non-finite components, and rows without an id, take no
    part; vectors meet those of their own length only. A repeated candidate counts as often
    as it occurs, a repeated query once. An empty table gives no rows; other columns are
    ignored.
    """
    spark = vectors.sparkSession
    ready = vectors.select(F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vector_col)).alias("v"), is_query.alias("q"))
    ready = ready.where("vec_id IS NOT NULL AND v IS NOT NULL").withColumn("dim", F.size("v"))
    asked = ready.where("q").select("vec_id", "v", "dim").distinct()
    n_rows, n_asked = ready.count(), asked.count()
    blocks = max(1, -(-n_asked // BLOCK_ROWS))
    groups = max(1, min(-(-n_rows // SHARD_ROWS), -(-4 * spark.sparkContext.defaultParallelism // blocks)))
    pivots = [r.v for r in ready.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).collect()]

    def near(v: Column) -> Column:
        """Number of the pivot with the largest product, pivots of another length aside."""
        dots = [F.when(F.size(v) == len(p), F.aggregate(F.zip_with(v, F.array(*[F.lit(x) for x in p]), lambda a, b: a.cast("double") * b),
                                                        F.lit(0.0), lambda a, b: a + b)) for p in pivots]
        found = F.array(*dots) if dots else F.array(F.lit(0.0))
        return F.coalesce(F.array_position(found, F.array_max(found)), F.lit(0)).cast("int")

    deal = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select("dim", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), deal(groups).alias("group"),
                        F.lit(0).alias("kind"), "vec_id", "v")
    right = ready.select("dim", "vec_id", "v", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)).cast("int").alias("group"),
                         near(F.col("v")).alias("kind"))
    right = right.select("dim", deal(blocks).alias("block"), "group", (F.col("kind") + 1).alias("kind"), "vec_id", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, queries, best, ids, rows = None, [], [], [], []

        def close_shard() -> None:
            if ids and queries:
                shard = Shard(np.array(ids, np.int64), np.array(rows, np.int64).reshape(len(ids), -1))
                for n, (own, q) in enumerate(queries):
                    best[n], _ = shard.search(q, own, k, best[n])
            ids.clear()
            rows.clear()

        def results() -> pa.RecordBatch:
            flat = [(own, i, -s) for (own, _), found in zip(queries, best) for s, i in found]
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in flat], pa.int64()) for c in range(3)], ["query_id", "vec_id", "score"])

        for batch in batches:
            places = zip(*(batch.column(c).to_pylist() for c in ("dim", "block", "group", "kind", "vec_id")))
            flat = batch.column("v").flatten().to_numpy()
            ends = np.cumsum(batch.column("dim").to_numpy())
            for (dim, block, group, kind, vec_id), end in zip(places, ends):
                if (dim, block, group) != unit:
                    close_shard()
                    if queries:
                        yield results()
                    unit, queries, best = (dim, block, group), [], []
                if kind == 0:
                    queries.append((vec_id, flat[end - dim: end].copy()))
                    best.append([])
                elif queries:
                    ids.append(vec_id)
                    rows.append(flat[end - dim: end].copy())
                    if len(ids) >= SHARD_ROWS:
                        close_shard()
        close_shard()
        if queries:
            yield results()

    dealt = left.unionByName(right).repartition("dim", "block", "group").sortWithinPartitions("dim", "block", "group", "kind", "vec_id")
    found = dealt.mapInArrow(run, "query_id long, vec_id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
