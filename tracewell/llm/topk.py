"""Exact top-k by inner product: columnar branch-and-bound over blocks of vectors in vertical layout."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import map_rows, new_path, nullable, stored

#: Scores below the first are exact in doubles, below the second in longs; beyond it, they are worked out in Python's whole numbers.
EXACT, LONG = 1 << 53, 1 << 63
#: Components of the queries of a round, and of the candidates that are compared together.
QUERY_CELLS, BLOCK_CELLS = 1 << 23, 1 << 22


def quantized(vectors: DataFrame, scale: int = 64, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and v, an array of longs floor(scale * x), x as a double.

    Vectors that are null or have null, infinite or NaN components take no part, nor do rows without an id.
    A component that is no long by then is an error.
    """
    value = f"{scale} * cast(x as double)"
    scaled = f"transform({vector}, x -> if(abs({value}) < 9.2e18D, cast(floor({value}) as bigint), cast(raise_error('a component is too large for a long') as bigint)))"
    whole = f"{key} is not null and {vector} is not null and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    return vectors.filter(whole).selectExpr(f"cast({key} as bigint) vec_id", f"{scaled} v")


def matrix(vectors: list[list[int]], dims: int, kind: type) -> np.ndarray:
    """Vectors as columns; missing components count as zero."""
    out = np.zeros((dims, len(vectors)), kind)
    for k, v in enumerate(vectors):
        out[: len(v), k] = v
    return out


def remaining(m: np.ndarray, steps: list[int]) -> np.ndarray:
    """For each step, the length of what each column has from there on: the mass that is still to come."""
    return np.sqrt(np.stack([(m[s:].astype(float) ** 2).sum(0) for s in steps]))


class Search:
    """The k best of all candidates seen so far for each of a set of queries."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, step: int):
        self.ids, self.q, self.k = ids, queries, k
        self.steps = list(range(0, max(1, len(queries)), step)) + [len(queries)]
        self.mass = remaining(queries, self.steps)
        self.kind = object if queries.dtype == object else np.int64
        self.best = [(np.empty(0, self.kind), np.empty(0, np.int64)) for _ in ids]

    def add(self, ids: np.ndarray, block: np.ndarray) -> None:
        """Compare a block of candidates, in vertical layout, with every query.

        Inner products grow dimension block by dimension block. By Cauchy and Schwarz, what is missing is at
        most the product of the two remaining masses; a candidate that cannot reach the query's k-th best
        score any more goes, and the survivors are moved together before the next dimensions.
        """
        mass = remaining(block, self.steps)
        head = self.steps[1]
        first = self.q[:head].T @ block[:head]
        for n, query in enumerate(self.ids):
            best_scores, best_ids = self.best[n]
            bar = best_scores[-1] if len(best_scores) == self.k else None
            alive, part = np.flatnonzero(ids != query), first[n]
            part = part[alive]
            for s in range(1, len(self.steps)):
                if bar is not None:
                    so_far, missing = part.astype(float), self.mass[s, n] * mass[s, alive]
                    slack = 1e-9 * (np.abs(so_far) + missing) + 1e-3  # rounding must not lose a tie
                    keep = so_far + missing + slack >= float(bar)
                    alive, part = alive[keep], part[keep]
                if s + 1 < len(self.steps) and len(alive):
                    low, high = self.steps[s], self.steps[s + 1]
                    part = part + self.q[low:high, n] @ (block[low:high, alive] if len(alive) < len(ids) // 2 else block[low:high][:, alive])
            if len(alive):
                scores = np.concatenate([best_scores, part.astype(self.kind)])
                found = np.concatenate([best_ids, ids[alive]])
                if self.kind is object:
                    order = sorted(range(len(found)), key=lambda i: (-scores[i], found[i]))[: self.k]
                else:
                    order = np.lexsort((found, -scores))[: self.k]
                self.best[n] = scores[order], found[order]

    def rows(self) -> Iterator[tuple[int, int, int]]:
        for query, (scores, ids) in zip(self.ids.tolist(), self.best, strict=True):
            for i, s in zip(ids.tolist(), map(int, scores.tolist()), strict=True):
                if not -LONG <= s < LONG:
                    raise OverflowError(f"the score of {query} and {i} is no long")
                yield query, i, s


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, dims_a_step: int = 16, block_rows: int = 4096, queries_a_round: int = 8192) -> DataFrame:
    """The k best candidates of each query by integer inner product: query_id, rank (from 1), vec_id, score.

    vectors and queries come from `quantized`. A query is not its own candidate (nor is any row with its
    id); other rows that repeat an id are candidates of their own, and a repeated query counts once, with
    its smallest vector. Ties go to the smaller vec_id. Vectors of different lengths are compared as if
    filled up with zeros. Scores are exact whatever the components and dimensions; one among a query's best
    that is no long is an error.

    Queries are taken in rounds of a bounded number, which is sent to every task; candidates stay where
    they are, and each task hands on at most k rows a query. Queries times candidates is the work that
    exactness asks for in the worst case; the bound cuts it by the share of dimensions that are not read.
    """
    spark = vectors.sparkSession
    vectors = stored(vectors, "vectors")
    dims, most = (x or 0 for x in vectors.agg(F.max(F.size("v")), F.max(F.expr("aggregate(v, 0L, (a, x) -> greatest(a, abs(x)))"))).first())
    size = dims * int(most) ** 2
    kind = float if size < EXACT else np.int64 if size < LONG else object
    queries_a_round = max(1, min(queries_a_round, QUERY_CELLS // max(1, dims)))
    block_rows = max(1, min(block_rows, BLOCK_CELLS // max(1, dims)))
    queries = stored(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    rounds = -(-queries.count() // queries_a_round)
    folder = new_path(spark, "top-k")
    schema = "query_id long, vec_id long, score long"
    numbered = queries.withColumn("round", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, rounds))))
    for n in range(rounds):
        # About queries_a_round of them, so the driver and the tasks hold a bounded number.
        table = numbered.filter(F.col("round") == n).select("vec_id", "v").toArrow()
        part = spark.sparkContext.broadcast((np.array(table["vec_id"].to_pylist(), np.int64), matrix(table["v"].to_pylist(), dims, kind)))

        def search(rows: Iterator[tuple], part=part) -> Iterator[tuple]:  # noqa: ANN001
            state, ids, block = Search(*part.value, k, dims_a_step), [], []
            for vec_id, v in rows:
                ids.append(vec_id)
                block.append(v)
                if len(ids) == block_rows:
                    state.add(np.array(ids, np.int64), matrix(block, dims, kind))
                    ids, block = [], []
            if ids:
                state.add(np.array(ids, np.int64), matrix(block, dims, kind))
            yield from state.rows()

        map_rows(vectors.select("vec_id", "v"), search, schema, 65536).write.mode("append").parquet(folder)
        part.destroy()
    if not rounds:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = spark.read.schema(nullable(spark.createDataFrame([], schema).schema)).parquet(folder)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def every_twentieth(vectors: DataFrame) -> DataFrame:
    """Each row whose id is divisible by 20, as a query against all rows."""
    ready = quantized(vectors)
    return top_k(ready, ready.filter("vec_id % 20 = 0"))


CHECK = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                  CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
     r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
