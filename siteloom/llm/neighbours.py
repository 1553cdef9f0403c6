"""Approximate nearest neighbours by a block matrix join; its results are exact.

A set of queries (``op9_block_knn``: the vectors whose vec_id is divisible by 50) is searched in all vectors. A vector x
is kept as int8 codes c and a scale s with x = s * c + r, and the norm of the rest r is known, so for two vectors
    |x . y - s s' (c . c')| <= |s c| |r'| + |r| |y|
bounds the error of a squared distance made from a product tile of int8 codes. The sums of a tile are whole numbers; they
are made by a float32 product of at most ``CHUNK`` dimensions at once, below which each partial sum is under 2 ** 24 and
thus exact, so any number of dimensions is. In each tile a query's least ``k`` upper bounds, and its k-th distance so far,
give a limit; pairs whose lower bound is within it are recomputed in float64. The lists of a query are merged by heaps.

The tiles are laid out as a grid: queries in groups of at most ``QUERY_BYTES``, all vectors in as many groups as make one
task for each shuffle partition. A task holds one group of queries; the vectors are streamed past it in blocks, so its
memory depends on neither table's size. Vectors are moved once for each group of queries, queries once for each group of
vectors. Work is queries times vectors: that is the method.

Defined results: vectors that are null, empty, hold a null, NaN or infinity, or have another length than most are dropped, as
are rows without a vec_id; a vec_id that is repeated counts once (its least vector); ties in distance go by vec_id;
a vector is no neighbour of itself, an equal one of another id is (at distance 0); with fewer than k others there are
fewer neighbours; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.llm.common import materialize, read, shuffles

K, BLOCK, EVERY = 10, 4096, 50
#: Queries of a tile that are multiplied at once, and dimensions of an exact float32 sum of int8 products.
STRIP, CHUNK = 512, 1024
#: Bytes of float32 vectors of one group of queries.
QUERY_BYTES = 32_000_000


def _coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the rest."""
    scale = np.abs(x).max(1) / 127
    scale[scale == 0] = 1
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    return codes, scale, np.sqrt(((x - codes * scale[:, None]) ** 2).sum(1))


def product(a: np.ndarray, b: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """a @ b.T of int8 codes, exact."""
    out = a[:, :chunk].astype(np.float32) @ b[:, :chunk].astype(np.float32).T
    if a.shape[1] > chunk:
        out = out.astype(np.float64)
        for at in range(chunk, a.shape[1], chunk):
            out += a[:, at : at + chunk].astype(np.float32) @ b[:, at : at + chunk].astype(np.float32).T
    return out


class Block:
    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.x = ids[order], x[order].astype(np.float32)
        wide = self.x.astype(np.float64)
        self.codes, self.scale, self.rest = _coded(wide)
        self.square = (wide**2).sum(1)
        self.norm = np.sqrt(self.square)
        self.coded = self.scale * np.sqrt((self.codes.astype(np.float64) ** 2).sum(1))


class Search:
    """The k nearest of each query among the blocks that it has seen; ``far`` is infinite and ``found`` -1 where there are fewer."""

    def __init__(self, queries: Block, k: int):
        self.queries, self.k = queries, k
        self.far = np.full((len(queries.ids), k), np.inf)
        self.found = np.full((len(queries.ids), k), -1, np.int64)

    def see(self, b: Block) -> None:
        q, k = self.queries, self.k
        for at in range(0, len(q.ids), STRIP):
            s = slice(at, at + STRIP)
            dots = product(q.codes[s], b.codes) * q.scale[s, None] * b.scale
            # Error of the product by the codes, and by rounding.
            error = 2 * (q.coded[s, None] * b.rest + q.rest[s, None] * b.norm) + 1e-9 * (q.norm[s, None] + b.norm) ** 2
            middle = q.square[s, None] + b.square - 2 * dots
            upper = middle + error
            place = np.minimum(np.searchsorted(b.ids, q.ids[s]), len(b.ids) - 1)
            own = np.flatnonzero(b.ids[place] == q.ids[s])
            upper[own, place[own]] = np.inf
            middle -= error
            middle[own, place[own]] = np.inf
            limit = self.far[s, -1].copy()
            if upper.shape[1] > k:
                np.minimum(limit, np.partition(upper, k - 1, 1)[:, k - 1], out=limit)
            r, c = np.nonzero((middle <= limit[:, None]) & (middle < np.inf))
            if len(r):
                self._keep(at, r, c, b)

    def _keep(self, at: int, r: np.ndarray, c: np.ndarray, b: Block) -> None:
        k, exact = self.k, np.empty(len(r))
        for i in range(0, len(r), 50_000):
            j = slice(i, i + 50_000)
            exact[j] = ((self.queries.x[at + r[j]].astype(np.float64) - b.x[c[j]]) ** 2).sum(1)
        touched = np.unique(r)
        # Beside what is known of these queries; places that are empty sort last.
        rows = np.concatenate((np.repeat(touched, k), r))
        far = np.concatenate((self.far[at + touched].reshape(-1), exact))
        ids = np.concatenate((self.found[at + touched].reshape(-1), b.ids[c]))
        order = np.lexsort((ids, far, rows))
        rows, far, ids = rows[order], far[order], ids[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        top = rank < k
        self.far[at + rows[top], rank[top]], self.found[at + rows[top], rank[top]] = far[top], ids[top]


def _task(batches, k: int, block: int):
    """Rows of one task, sorted by (side, vec_id): its queries come first, then the vectors that stream past them."""
    held: dict[int, list] = {0: [], 1: []}
    search, waiting = None, 0

    def take(side: int) -> Block:
        parts, held[side] = held[side], []
        return Block(np.concatenate([i for i, _ in parts]), np.concatenate([x for _, x in parts]))

    for batch in batches:
        sides = batch.column("side").to_numpy()
        ids = batch.column("vec_id").to_numpy()
        x = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        cut = int(np.searchsorted(sides, 1))
        if cut:
            held[0].append((ids[:cut], x[:cut]))
        if cut < len(ids):
            if search is None and held[0]:
                search = Search(take(0), k)
            held[1].append((ids[cut:], x[cut:]))
            waiting += len(ids) - cut
            if waiting >= block and search is not None:
                search.see(take(1))
                waiting = 0
    if search is not None:
        if held[1]:
            search.see(take(1))
        full = search.found >= 0
        kept = np.flatnonzero(full.any(1))
        bounds = pa.array(np.append(0, np.cumsum(full[kept].sum(1))).astype(np.int32))
        inside = full[kept]
        yield pa.RecordBatch.from_arrays([
            pa.array(search.queries.ids[kept]), pa.ListArray.from_arrays(bounds, pa.array(search.found[kept][inside])),
            pa.ListArray.from_arrays(bounds, pa.array(search.far[kept][inside])),
        ], ["vec_id", "ids", "far"])


def knn(vectors: DataFrame, asked: Column | None = None, k: int = K, block: int = BLOCK, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """vec_id, neighbour_id, rank (from 1), distance (Euclidean) of the k nearest of every vector for which ``asked`` (of vec_id) holds, or of all."""
    ok = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall(
        "embedding", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False))
    )
    clean = vectors.where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    clean = materialize(clean.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "vectors")
    asked = F.lit(True) if asked is None else F.coalesce(asked, F.lit(False))
    sizes = clean.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"), F.count_if(asked).alias("q")).orderBy(F.desc("n"), "d").take(1)
    width, n, q = (sizes[0].d, sizes[0].n, sizes[0].q) if sizes else (0, 0, 0)
    fits = clean.where(F.size("embedding") == width)
    down = max(1, -(-q * 4 * width // query_bytes))
    # No more tasks a group of queries than blocks of vectors, so the lists that a query's merge gets are bounded by the partitions.
    across = max(1, min(-(-shuffles(vectors.sparkSession) // down), -(-n // block)))

    def group(salt: int, groups: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(groups)).cast("int")

    every = lambda groups: F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    queries = fits.where(asked).select(F.lit(0).alias("side"), "vec_id", "embedding", group(1, down).alias("g"), every(across).alias("a"))
    base = fits.select(F.lit(1).alias("side"), "vec_id", "embedding", every(down).alias("g"), group(2, across).alias("a"))
    laid = queries.union(base).withColumn("task", F.col("g") * across + F.col("a"))
    tasks = laid.repartitionById(down * across, F.col("task")).sortWithinPartitions("side", "vec_id").select("side", "vec_id", "embedding")
    lists = tasks.mapInArrow(lambda batches: _task(batches, k, block), "vec_id long, ids array<long>, far array<double>")

    def merge(batches):
        for batch in batches:
            out = []
            for query, found in zip(batch.column("vec_id").to_pylist(), batch.column("lists").to_pylist()):
                best = heapq.nsmallest(k, heapq.merge(*(zip(p["far"], p["ids"]) for p in found)))
                out += [(query, i, rank + 1, float(np.sqrt(d))) for rank, (d, i) in enumerate(best)]
            if out:
                c = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int32()), pa.array(c[3], pa.float64())], ["vec_id", "neighbour_id", "rank", "distance"])

    return lists.groupBy("vec_id").agg(F.collect_list(F.struct("far", "ids")).alias("lists")).mapInArrow(
        merge, "vec_id long, neighbour_id long, rank int, distance double"
    )


def op9_block_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest neighbours, among all vectors, of those whose vec_id is divisible by ``EVERY``; distances are rounded to 5 digits."""
    return knn(read(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0).withColumn("distance", F.bround("distance", 5))


SQL = f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
d AS (
  SELECT a.vec_id, b.vec_id AS neighbour_id, sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS distance
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % {EVERY} = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour_id)::INTEGER AS rank FROM d)
SELECT vec_id, neighbour_id, rank, round_even(distance, 5) AS distance FROM r WHERE rank <= {K}
"""
