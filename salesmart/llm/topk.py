"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Vectors are quantised to integers.  A block of vectors is indexed by impact level: the postings
(dimension, vector, impact) whose magnitude lies in [2^l, 2^(l+1)) form level l, cut into a segment for each
dimension.  A batch of queries adds segments from the highest impact down, for the vectors still possible.  After
each level the part of a vector not yet added has a known norm, so by Cauchy and Schwarz every score lies
within a known distance of its running sum; a query for which few vectors can still reach the k best of the
block stops, and exactly these are rescored in full.  A block is indexed once for a wave of query batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import stage

SCALE = 256
#: Numbers in a block of vectors and in a batch of queries; rows of each follow from the dimension.
BLOCK_NUMBERS = 1 << 18
BATCH_NUMBERS = 1 << 13
#: Query batches that meet a block in one group, one after another; a vector is shuffled once for each wave.
WAVE_BATCHES = 256
LONG = 1 << 63


def quantise(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, embedding) -> staged (rid, vec_id, dim, parts: int64 bytes) of the vectors that take part.

    Left out: null ids, null or empty vectors, vectors with a null or non-finite component.  A component
    outside the range of a long is held at its end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 36
        for b in batches:
            rows = []
            for vec, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if vec is None or not x.is_valid or not len(x.values) or x.values.null_count:
                    continue
                v = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(v).all():
                    q = np.floor(scale * v)
                    q = np.array([int(c) for c in np.clip(q, -(2.0**63), np.nextafter(2.0**63, 0))], np.int64) if np.abs(q).max() >= 2.0**62 else q.astype(np.int64)
                    rows.append((rid, vec, len(q), q.tobytes()))
                    rid += 1
            if rows:
                r, i, d, p = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()), pa.array(i, pa.int64()), pa.array(d, pa.int32()), pa.array(p, pa.binary())], ["rid", "vec_id", "dim", "parts"])

    chosen = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return stage(chosen.mapInArrow(run, "rid long, vec_id long, dim int, parts binary"), "vectors")


class BlockIndex:
    """Posting segments of one block, highest impact level first: a segment holds (vector, impact) of one dimension and level.

    A level also keeps the norm of what every vector has in lower levels.
    """

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        level = np.frexp(np.abs(x))[1]  # bits of the magnitude; 0 has none
        rest = (x * x).sum(1)
        self.levels: list[tuple[list[tuple[int, np.ndarray, np.ndarray]], np.ndarray]] = []
        for bit in sorted(set(np.unique(level).tolist()) - {0}, reverse=True):
            dims, vecs = np.nonzero((level == bit).T)
            impact = x[vecs, dims]
            cuts = np.nonzero(np.diff(dims))[0] + 1
            parts = zip(np.split(dims, cuts), np.split(vecs, cuts), np.split(impact, cuts), strict=True)
            rest = rest - np.bincount(vecs, impact * impact, len(x))
            self.levels.append(([(int(d[0]), v, i) for d, v, i in parts], np.sqrt(np.maximum(rest, 0))))

    def top(self, q: np.ndarray, own: np.ndarray, k: int, ids: np.ndarray, few: int = 8) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (row of ``q``) the vectors of the block with its k best scores, ties to smaller ids, and the scores.

        own: for each query the place of its own row in the block, -1 if it is elsewhere.  A query stops once few vectors
        can still be among its best; postings of vectors that are out for all queries left are not added any more.
        """
        n, nq = len(self.x), len(q)
        found: list[np.ndarray] = [np.empty(0, int)] * nq
        going = np.arange(nq)
        weights, norm = np.ascontiguousarray(q.T), np.sqrt((q * q).sum(1))
        sums, possible = np.zeros((n, nq)), np.ones((n, nq), bool)
        mine = np.nonzero(own >= 0)[0]
        possible[own[mine], mine] = False
        for segments, rest in self.levels if n > k else []:
            alive = possible.any(1)
            every = alive.all()
            for d, vecs, impact in segments:
                if not every:
                    kept = alive[vecs]
                    vecs, impact = vecs[kept], impact[kept]
                sums[vecs] += impact[:, None] * weights[d]
            slack = rest[:, None] * (norm * (1 + 1e-12)) + 1e-9
            low = np.where(possible, sums - slack, -np.inf)
            bar = np.partition(low, n - k, axis=0)[n - k]
            possible &= sums + slack >= bar
            done = possible.sum(0) <= few * k
            if done.any():
                for j in np.nonzero(done)[0]:
                    found[going[j]] = np.nonzero(possible[:, j])[0]
                left = ~done
                going, sums, possible, weights, norm = going[left], sums[:, left], possible[:, left], np.ascontiguousarray(weights[:, left]), norm[left]
                if not len(going):
                    break
        for j, i in enumerate(going):
            found[i] = np.nonzero(possible[:, j])[0]
        out = []
        for at, query in zip(found, q, strict=True):
            exact = self.x[at] @ query
            best = np.lexsort((ids[at], -exact))[:k]
            out.append((at[best], exact[best]))
        return out


def _plain(x: np.ndarray, q: np.ndarray, own: np.ndarray, k: int, ids: np.ndarray) -> list[tuple[np.ndarray, list[int]]]:
    """The same for components so large that doubles are not exact: whole numbers of any size."""
    out = []
    for i, row in enumerate(q):
        scores = [(-max(-LONG, min(LONG - 1, sum(int(a) * int(b) for a, b in zip(row, v, strict=True)))), int(ids[j]), j) for j, v in enumerate(x) if j != own[i]]
        best = sorted(scores)[:k]
        out.append((np.array([j for *_, j in best], int), [-s for s, *_ in best]))
    return out


def _search(k: int):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        rows: dict[str, list] = {"rid": [], "query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            dim = key[0].as_py()
            x = np.frombuffer(b"".join(left.column("parts").to_pylist()), np.int64).reshape(-1, dim)
            ids, rid = (left.column(c).to_numpy() for c in ("vec_id", "rid"))
            place = {r: i for i, r in enumerate(rid.tolist())}
            largest = max(-int(x.min()), int(x.max()))
            index = None  # of this block, made once for all batches of the wave
            right = right.sort_by("batch")
            ends = [*(np.nonzero(np.diff(right.column("batch").to_numpy()))[0] + 1).tolist(), right.num_rows]
            for at, end in zip([0, *ends], ends, strict=False):
                batch = right.slice(at, end - at)
                q = np.frombuffer(b"".join(batch.column("parts").to_pylist()), np.int64).reshape(-1, dim)
                mine = batch.column("rid").to_pylist()
                own = np.array([place.get(r, -1) for r in mine])
                if max(largest, -int(q.min()), int(q.max())) ** 2 * dim < 1 << 52:
                    index = index or BlockIndex(x.astype(np.float64))
                    found = index.top(q.astype(np.float64), own, k, ids)
                else:
                    found = _plain(x, q, own, k, ids)
                for r, query, (best, scores) in zip(mine, batch.column("query_id").to_pylist(), found, strict=True):
                    rows["rid"] += [r] * len(best)
                    rows["query_id"] += [query] * len(best)
                    rows["vec_id"] += ids[best].tolist()
                    rows["score"] += [int(s) for s in scores]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in rows.items()})

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = SCALE) -> DataFrame:
    """(vec_id, embedding) -> query_id, rank, vec_id, score: the k best other rows of every query row.

    is_query: a condition on vec_id.  Only vectors of a query's dimension are its candidates; a query
    without candidates has no row.  Repeated rows are rows of their own, as queries and as candidates.
    Waves of query batches meet blocks of vectors, each pair one group; neither grows with the data.
    """
    rows = quantise(vectors, scale)
    block_rows = F.greatest(F.lit(64), F.floor(F.lit(BLOCK_NUMBERS) / F.col("dim")))
    batch_rows = F.greatest(F.lit(64), F.floor(F.lit(BATCH_NUMBERS) / F.col("dim")))
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q"))
    sizes = sizes.select("dim", F.ceil(F.col("n") / block_rows).alias("blocks"), F.ceil(F.col("q") / batch_rows).alias("batches")).filter("batches > 0")
    sizes = sizes.withColumn("waves", F.ceil(F.col("batches") / WAVE_BATCHES))
    sized = rows.join(sizes, "dim")
    spread = lambda of, count: F.pmod(F.xxhash64("rid", F.lit(of)), count)
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
    left = sized.select("dim", spread("block", F.col("blocks")).alias("block"), every("waves").alias("wave"), "rid", "vec_id", "parts")
    right = sized.filter(is_query).select("dim", spread("batch", F.col("batches")).alias("batch"), every("blocks").alias("block"), "rid", F.col("vec_id").alias("query_id"), "parts")
    right = right.withColumn("wave", F.floor(F.col("batch") / WAVE_BATCHES))
    right = right.toDF(*right.columns)  # names of its own, as both sides come from one table
    keys = ["dim", "block", "wave"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_search(k), "rid long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("rid").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
