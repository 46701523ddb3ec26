"""Exact top-k search over an impact-ordered index, score at a time.

Vectors are quantised to integers. A block of candidates is indexed by sparse
posting lists, one for a dimension and an impact (the size of a component, to
six significant bits); lists of one impact are a segment, and components of
zero have no posting. Segments are processed from the highest impacts down:
each list adds its products with the weights of a batch of queries to its
candidates' accumulators. When little of the candidates' energy is left, and
again whenever that has halved, queries are tested; one stops only on proof:
by the Cauchy-Schwarz inequality no unprocessed posting can lift any candidate
but a few possible members to the score of the exact k-th best so far.
Possible members, ties included, are rescored exactly. A query for which there
is no proof runs to the last segment, where accumulators are exact. So no
posting is processed twice, and the last segments are left out on proof.

Queries and candidates are dealt into blocks and each pair of blocks is one
task group; a group returns at most k rows a query.

Edge cases: vectors that are null, empty, or hold null or non-finite
components take no part; vectors of different lengths are not compared; ties
go to the smaller id; equal vectors are separate candidates; a query never
meets candidates with its own id; ids that occur twice are separate rows;
rows with a null id take no part; an empty table gives an empty result; other
columns are ignored whatever their names. Products beyond 2^53 are summed in
arbitrary precision and cut to 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, pick, prepare

#: Rows of a block of candidates and of queries.
CANDIDATES = 16384
QUERIES = 2048
#: Stop and rescore where at most this share of a block can still be a member.
FEW = 1 / 32
#: Share of the candidates' energy (sum of squares) that may be left at the first test.
TESTED = 0.05
#: Queries that are scored together.
BATCH = 128


def quantised(rows: DataFrame, scale: float) -> DataFrame:
    """(id, dims, v): floor(scale * x) of valid vectors as little-endian float64."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, dims, out = [], [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if i is None or not v or None in v:
                    continue
                x = np.floor(scale * np.array(v, np.float64))
                if np.isfinite(x).all():
                    ids.append(i)
                    dims.append(len(v))
                    out.append(x.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(out, pa.binary())], names=["id", "dims", "v"])

    return rows.mapInArrow(run, "id long, dims int, v binary")


class ImpactIndex:
    """Posting lists of a block of candidates by falling impact; ``work`` counts products."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors, self.work = ids, vectors, 0
        self.rows, dims = np.nonzero(vectors)
        size = np.abs(vectors[self.rows, dims])
        step = np.exp2(np.maximum(np.frexp(size)[1] - 6, 0))
        level = np.floor(size / step) * step
        order = np.lexsort((self.rows, dims, -level))
        self.rows, dims, level = self.rows[order], dims[order], level[order]
        self.impacts = vectors[self.rows, dims]
        apart = np.ones(len(order), bool)
        apart[1:] = (dims[1:] != dims[:-1]) | (level[1:] != level[:-1])
        starts = np.flatnonzero(apart)
        #: (dimension, first posting, past the last) of every list, and the lists that begin a segment.
        self.lists = list(zip(dims[starts].tolist(), starts.tolist(), np.append(starts[1:], len(order)).tolist(), strict=True))
        begins = np.flatnonzero(np.append(True, level[starts][1:] != level[starts][:-1])) if len(starts) else np.zeros(0, np.int64)
        self.segments = [self.lists[a:z] for a, z in zip(begins, np.append(begins[1:], len(starts)), strict=True)] or [[]]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, candidate ids, scores): each query's k best of the block, ties to smaller ids."""
        bound = float(np.abs(self.vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * self.vectors.shape[1]
        if bound >= 2**53:
            exact = np.array([[int(x) for x in v] for v in self.vectors], object)
            for i, q in zip(query_ids, queries, strict=True):
                scores = np.array([max(-(2**63), min(2**63 - 1, s)) for s in exact @ np.array([int(x) for x in q], object)], object)
                yield i, *self._best(i, np.arange(len(self.ids)), scores, k)
            return
        kind = np.float32 if bound < 2**24 else np.float64  # sums of integers, exact in either
        acc = np.zeros((len(self.ids), len(queries)), kind)
        weights = np.ascontiguousarray(queries.T.astype(kind))
        impacts = self.impacts.astype(kind)[:, None]
        length = np.sqrt((queries * queries).sum(axis=1)) * (1 + 1e-9)
        active = np.arange(len(queries))
        energy = (self.vectors * self.vectors).sum(axis=1)
        rest, tested = energy.copy(), TESTED * energy.sum()
        for at, segment in enumerate(self.segments):
            for dim, start, stop in segment:
                rows = self.rows[start:stop]
                acc[rows] += impacts[start:stop] * weights[dim]
                rest[rows] -= self.impacts[start:stop] ** 2
                self.work += (stop - start) * len(active)
            final = at == len(self.segments) - 1
            if not final and rest.sum() > tested:
                continue
            tested = rest.sum() / 2
            # what a unit query could still gain from the postings below, rounded up
            left = np.sqrt(np.maximum(rest, 0) + 1e-12 * energy) * (1 + 1e-9)
            going = []
            for place, (a, seen) in enumerate(zip(active, np.ascontiguousarray(acc.T), strict=True)):
                few = min(len(seen), k + 1)
                best = np.argpartition(-seen, few - 1)[:few] if few < len(seen) else np.arange(len(seen))
                best = best[self.ids[best] != query_ids[a]]
                sure = np.sort(self.vectors[best] @ queries[a])[::-1]
                least = sure[k - 1] if len(sure) >= k else -np.inf
                possible = np.flatnonzero(seen + length[a] * left >= least)
                self.work += len(best) * self.vectors.shape[1]
                if final or len(possible) <= max(4 * k, FEW * len(seen)):
                    scores = self.vectors[possible] @ queries[a]
                    self.work += len(possible) * self.vectors.shape[1]
                    yield query_ids[a], *self._best(query_ids[a], possible, scores, k)
                else:
                    going.append(place)
            if not going:
                return
            if len(going) < len(active):
                active, acc, weights = active[going], np.ascontiguousarray(acc[:, going]), np.ascontiguousarray(weights[:, going])

    def _best(self, query: int, places: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        other = self.ids[places] != query
        places, scores = places[other], scores[other]
        order = np.lexsort((self.ids[places], -scores))[:k]
        return self.ids[places[order]], scores[order].astype(np.int64)


def top_k(spark: SparkSession, vectors: DataFrame, is_query: F.Column, k: int = 20, scale: float = 64.0, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer products of each query row.

    ``is_query`` is a condition on the column ``id`` (named ``id``).
    """
    import pandas as pd

    prepare(spark)
    rows = materialize(quantised(pick(vectors, id=id, vector=vector), scale), "quantised")
    sizes = {r.dims: (r.n, r.q) for r in rows.groupBy("dims").agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).collect()}
    blocks = [(d, n // CANDIDATES + 1, q // QUERIES + 1) for d, (n, q) in sizes.items() if q]
    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    counts = spark.createDataFrame(blocks, "dims int, cs int, qs int")
    dealt = rows.join(F.broadcast(counts), "dims")  # one row a vector length
    mix = F.xxhash64("id", "v")
    asked = dealt.where(is_query).select("dims", "id", "v", F.pmod(mix, "qs").cast("int").alias("qb"), F.explode(F.sequence(F.lit(0), F.col("cs") - 1)).alias("cb"))
    held = dealt.select("dims", "id", "v", F.pmod(mix, "cs").cast("int").alias("cb"), F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("qb"))

    def unpack(rows: pd.DataFrame, name: str) -> tuple[np.ndarray, np.ndarray]:
        return rows[f"{name}id"].to_numpy(), np.frombuffer(b"".join(rows[f"{name}v"]), "<f8").reshape(len(rows), -1)

    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(candidates):
            ids, vectors = unpack(queries, "")
            index = ImpactIndex(*unpack(candidates, "held_"))
            for at in range(0, len(ids), BATCH):
                for q, found, scores in index.search(ids[at : at + BATCH], vectors[at : at + BATCH], k):
                    out.append(pd.DataFrame({"query_id": q, "vec_id": found, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")})

    held = held.select(*[F.col(c).alias(f"held_{c}") for c in held.columns])
    meet = held.groupBy("held_dims", "held_cb", "held_qb")
    found = asked.groupBy("dims", "cb", "qb").cogroup(meet).applyInPandas(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """The 20 highest products of the rows whose id is divisible by 20 with all other rows."""
    return top_k(spark, vectors, F.col("id") % 20 == 0)


#: DuckDB: brute force.
NEAREST_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
