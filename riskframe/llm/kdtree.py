"""Exact top-k inner products with KD-trees, one per shard of the vectors.

Vectors are spread over shards by a hash of their id. A shard splits its
vectors at medians into leaves with tight bounding boxes; a query visits leaves
in order of the largest inner product their box allows and stops at the first
box below its k-th score. A first pass searches one shard per query, and the
k-th score found there goes along to all others, so that most boxes are skipped.

Contract for unusual input: vectors that are null, empty, or hold a null, NaN
or infinite component take no part, as query or as candidate; vectors of
another length than the query's are no candidates for it; rows with a null id
take no part; rows that repeat an id count as candidates each; ties go to the
smaller id; a score beyond 64 bits is returned as the nearest 64-bit number; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.frames import renewed
from riskframe.session import durable

LEAF = 64
SHARD_ROWS = 1 << 14
QUERY_BLOCK = 1 << 12
_FOUND = "query_id long, vec_id long, score long"


class Tree:
    """Leaves of a KD-tree over integer vectors, each with its tight bounding box."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order, stack, self.leaves = np.arange(len(ids)), [(0, len(ids))], []
        while stack:
            a, b = stack.pop()
            own = vectors[order[a:b]]
            spread = own.max(axis=0) - own.min(axis=0)
            if b - a <= leaf or not spread.any():
                self.leaves.append((a, b))
                continue
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, int(spread.argmax())], middle)]
            stack += [(a, a + middle), (a + middle, b)]
        self.ids, self.vectors = ids[order], vectors[order]
        self.low = np.array([self.vectors[a:b].min(axis=0) for a, b in self.leaves])
        self.high = np.array([self.vectors[a:b].max(axis=0) for a, b in self.leaves])

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray):
        """For each query its k best (score, id) not below its floor, without its own id."""
        bounds = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        visit = np.argsort(-bounds, axis=1, kind="stable")
        for i, q in enumerate(queries):
            scores, ids, least = np.zeros(0, queries.dtype), np.zeros(0, np.int64), floor[i]
            for leaf in visit[i]:
                if bounds[i, leaf] < least:
                    break
                a, b = self.leaves[leaf]
                got = self.vectors[a:b] @ q
                good = (got >= least) & (self.ids[a:b] != own[i])
                if not good.any():
                    continue
                scores, ids = np.append(scores, got[good]), np.append(ids, self.ids[a:b][good])
                if len(scores) > k:
                    order = np.argsort(ids, kind="stable")
                    best = order[np.argsort(-scores[order], kind="stable")][:k]
                    scores, ids = scores[best], ids[best]
                if len(scores) == k:
                    least = max(least, scores.min())
            yield scores, ids


def exact_kind(*matrices: np.ndarray) -> type:
    """Doubles hold every product and sum here exactly, unless components are huge."""
    largest = max(float(np.abs(m).max(initial=0)) for m in matrices)
    bound = largest * largest * matrices[0].shape[1]
    return np.float64 if bound < 2**52 else np.int64 if bound < 2**62 else object


def _pair(k: int):
    def run(shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(shard) and len(queries):
            x, q = np.stack(shard["x"].to_numpy()), np.stack(queries["x"].to_numpy())
            kind = exact_kind(x, q)
            tree = Tree(shard["vec_id"].to_numpy(), x.astype(kind))
            own = queries["vec_id"].to_numpy()
            floor = queries["floor"].to_numpy().astype(kind)
            for query, (scores, ids) in zip(own, tree.search(q.astype(kind), own, k, floor), strict=True):
                rows += [(query, i, min(max(int(s), -(2**63)), 2**63 - 1)) for s, i in zip(scores, ids, strict=True)]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def integer_vectors(df: DataFrame, vec_id: str, vector: str, *more: Column) -> DataFrame:
    """(vec_id, x, more...): floor(256 * component) of every usable vector."""
    sound = (F.size(vector) > 0) & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf")))
    )
    return df.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & sound).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(vector, lambda c: F.floor(F.lit(256.0) * c.cast("double")).cast("long")).alias("x"),
        *more,
    )


def top_k(df: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
          shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of every query row.

    A (shard, block of queries) pair is one task of fixed size, so neither the
    vectors nor the queries meet in one place as they grow.
    """
    vectors = integer_vectors(df, vec_id, vector)
    sizes = vectors.agg(F.count("*").alias("n"), F.sum(is_query.cast("long")).alias("q")).first()
    shards = max(1, -(-sizes["n"] // shard_rows))
    blocks = max(1, -(-(sizes["q"] or 0) // query_block))

    def spread(salt: int, n: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")

    dim = F.size("x").alias("dim")
    # Read by both passes and joined to what is derived from it, hence checkpointed.
    queries = durable(vectors.where(is_query).select("vec_id", "x", dim, spread(1, blocks).alias("block"),
                                                     spread(2, shards).alias("home")))
    keys = ["shard", "block", "dim"]
    held = vectors.select(
        "vec_id", "x", dim, spread(0, shards).alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )

    def search(asked: DataFrame) -> DataFrame:
        return held.groupBy(*keys).cogroup(renewed(asked).groupBy(*keys)).applyInPandas(_pair(k), _FOUND)

    least = F.lit(-(2**62)).cast("long")
    first = durable(search(queries.select("vec_id", "x", "dim", "block", F.col("home").alias("shard"), least.alias("floor"))))
    kth = first.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.min("score")).otherwise(least).alias("floor")
    )
    rest = (
        queries.join(kth, F.col("vec_id") == F.col("query_id"), "left")
        .select("vec_id", "x", "dim", "block", "home", F.coalesce("floor", least).alias("floor"),
                F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
        .where(F.col("shard") != F.col("home"))
    )
    found = first.unionByName(search(rest)) if shards > 1 else first
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k)
    return (
        found.groupBy("query_id").agg(best.alias("best"))
        .select("query_id", F.posexplode("best").alias("rank", "b"))
        .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"),
                (-F.col("b.s")).alias("score"))
    )
