"""Approximate nearest neighbours by cross-polytope hashing.

Every hash function turns a unit vector by a fast pseudo-rotation (three rounds of random signs and
a Hadamard transform) and names the signed axis nearest to it. A table joins `functions` of them
to a bucket. A vector lies in one bucket of each table; a query asks in each table for the `probes`
buckets whose axes are nearest to it. All vectors met are ranked by the exact distance of the
original vectors.

Vectors and probes meet in cells (table, bucket), dealt out by hash. A cell with many
vectors or queries is cut into a grid of salted cells by its measured size. In a task, queries
come first and vectors stream past them; only the best k of each query and cell leave it. Of equal
vectors only the k + 1 smallest ids are candidates, which is exact: ties go to the smaller id.

A query that has met fewer than k vectors, though there are more of its length, asks for all cells of one
table, which hold every vector; so few candidates come back whole.

Defined results: vectors that are null or zero, or hold a null or a non-finite component, take no
part; vectors of different length never meet; a query is no candidate of its own id; repeated rows of
an id give its neighbours once; null ids take no part; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopledger.llm.common import arrow_rows, written

TABLES = 10
PROBES = 8
FUNCTIONS = 1
CELL_VECTORS, CELL_QUERIES = 20_000, 4_000  # of a salted cell, on average
SEED = 6


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the normalised Hadamard matrix, in n log n steps."""
    rows, n = x.shape
    step = 1
    while step < n:
        x = x.reshape(rows, n // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(rows, n)
        step *= 2
    return x / math.sqrt(n)


class CrossPolytope:
    """The hash functions of all tables for vectors of one length."""

    def __init__(self, length: int, tables: int = TABLES, functions: int = FUNCTIONS, seed: int = SEED):
        self.length, self.size = length, 1 << max(length - 1, 0).bit_length()
        rng = np.random.default_rng([seed, length])
        self.signs = rng.choice([-1.0, 1.0], (tables, functions, 3, self.size))

    def near(self, vectors: np.ndarray, probes: int) -> np.ndarray:
        """Buckets [row, table, probe], nearest first."""
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        wide = np.zeros((len(unit), self.size))
        wide[:, : self.length] = unit
        out = []
        for table in self.signs:
            codes, closeness = np.zeros((len(unit), 1), np.int64), np.zeros((len(unit), 1))
            for rounds in table:
                turned = wide
                for signs in rounds:
                    turned = hadamard(turned * signs)
                axes = np.concatenate([turned, -turned], axis=1)  # signed axes: n positive, n negative
                best = np.argsort(-axes, axis=1, kind="stable")[:, :probes]
                value = np.take_along_axis(axes, best, axis=1)
                both = (closeness[:, :, None] + value[:, None, :]).reshape(len(unit), -1)
                code = (codes[:, :, None] * axes.shape[1] + best[:, None, :]).reshape(len(unit), -1)
                keep = np.argsort(-both, axis=1, kind="stable")[:, :probes]
                codes, closeness = np.take_along_axis(code, keep, axis=1), np.take_along_axis(both, keep, axis=1)
            out.append(codes)
        return np.stack(out, axis=1)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id, vector (doubles): the rows that take part."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        .filter(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    )


def rows_of(column: pa.Array) -> list[np.ndarray]:
    """Views of the lists of a list column without nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, bounds = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    bounds = bounds - bounds[0]
    return [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def hashed(rows: DataFrame, probes: int, tables: int, functions: int, seed: int) -> DataFrame:
    """rows with `cells`: one number for (length, table, bucket) of each table and probe."""

    def cells(batches):
        made: dict[int, CrossPolytope] = {}
        for batch in batches:
            vectors = rows_of(batch.column("vector"))
            found: list = [None] * len(vectors)
            for length in {len(v) for v in vectors}:
                at = [i for i, v in enumerate(vectors) if len(v) == length]
                if length not in made:
                    made[length] = CrossPolytope(length, tables, functions, seed)
                near = made[length].near(np.array([vectors[i] for i in at]), probes)
                buckets = (2 * made[length].size) ** functions
                base = (np.arange(tables, dtype=np.int64) * buckets)[None, :, None]
                codes = (near + base).reshape(len(at), -1) * 65_521 + length
                for i, row in zip(at, codes):
                    found[i] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"), pa.array(found, pa.list_(pa.int64()))], names=["id", "vector", "cells"]
            )

    return rows.select("id", "vector").mapInArrow(cells, "id long, vector array<double>, cells array<long>")


def merged(best: tuple[np.ndarray, np.ndarray], ids: np.ndarray, squares: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k smallest (square, id) of each row of what is kept and what is new."""
    all_ids = np.concatenate([best[0], np.broadcast_to(ids, squares.shape)], axis=1)
    all_squares = np.concatenate([best[1], squares], axis=1)
    order = np.lexsort((all_ids, all_squares), axis=1)[:, :k]
    return np.take_along_axis(all_ids, order, axis=1), np.take_along_axis(all_squares, order, axis=1)


def nearest(
    vectors: DataFrame, query: Column, *, key: str = "vec_id", vector: str = "embedding", k: int = 10, tables: int = TABLES,
    probes: int = PROBES, functions: int = FUNCTIONS, seed: int = SEED, cell_vectors: int = CELL_VECTORS, cell_queries: int = CELL_QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance): the k nearest found of each row that `query` picks."""
    own = usable(vectors, key, vector)
    picked = usable(vectors.filter(query), key, vector).distinct()
    same = Window.partitionBy("vector").orderBy("id")
    base = own.distinct().withColumn("place", F.row_number().over(same)).filter(F.col("place") <= k + 1).drop("place")
    base = written(hashed(base, 1, tables, functions, seed), "neighbours-base")
    asked = written(hashed(picked, probes, tables, functions, seed), "neighbours-queries")
    found = written(best_of(met(base, asked, k, cell_vectors, cell_queries), k), "neighbours-found")
    # queries that met too few vectors, though there are more of their length: all cells of one table hold all of them
    there = base.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"))
    had = found.groupBy("query_id").agg(F.count("*").alias("had"))
    short = (
        asked.join(had, asked["id"] == had["query_id"], "left").withColumn("length", F.size("vector")).join(there, "length")
        .filter(F.coalesce("had", F.lit(0)) < F.least(F.lit(k), F.col("n") - 1)).select("id", "vector", "length")
    )
    axes = F.lit(1)
    for _ in range(functions):
        axes = axes * 2 * F.pow(2.0, F.ceil(F.log2("length"))).cast("long")
    every = F.transform(F.sequence(F.lit(0).cast("long"), axes - 1), lambda c: c * 65_521 + F.col("length"))
    short = written(short.select("id", "vector", every.alias("cells")), "neighbours-short")
    if not short.isEmpty():
        one = base.withColumn("cells", F.slice("cells", 1, 1))
        found = best_of(found.select("query_id", "vec_id", "square").union(met(one, short, k, cell_vectors, cell_queries)), k)
    return found.select("query_id", "rank", "vec_id", F.sqrt("square").alias("score"))


def best_of(pairs: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, square, rank: the k nearest of each query; a pair may come more than once."""
    ranked = Window.partitionBy("query_id").orderBy("square", "vec_id")
    once = pairs.groupBy("query_id", "vec_id").agg(F.min("square").alias("square"))
    return once.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)


def met(base: DataFrame, asked: DataFrame, k: int, cell_vectors: int, cell_queries: int) -> DataFrame:
    """query_id, vec_id, square: the k nearest vectors of each query in every cell that both are in."""

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias(name))

    # a row for each cell that is asked: at most tables x buckets
    grid = (
        counted(base, "v").join(counted(asked, "q"), "cell")
        .select("cell", F.ceil(F.col("v") / cell_vectors).cast("int").alias("vs"), F.ceil(F.col("q") / cell_queries).cast("int").alias("qs"))
    )

    def share(of: str, among: str):
        """Own salt by hash, and a copy for each salt of the other side."""
        own_salt = F.pmod(F.xxhash64("id"), F.col(of)).cast("int")
        return own_salt, F.explode(F.sequence(F.lit(0), F.col(among) - 1))

    v_salt, q_copies = share("vs", "qs")
    q_salt, v_copies = share("qs", "vs")
    left = base.select(F.explode("cells").alias("cell"), "id", "vector").join(grid, "cell").select("cell", v_salt.alias("a"), q_copies.alias("b"), F.lit(1).alias("kind"), "id", "vector")
    right = asked.select(F.explode("cells").alias("cell"), "id", "vector").join(grid, "cell").select("cell", v_copies.alias("a"), q_salt.alias("b"), F.lit(0).alias("kind"), "id", "vector")

    def rerank(batches):
        now, queries, best = None, [], None

        def result():
            if best is None:
                return None
            ids, squares = best
            row, column = np.nonzero(np.isfinite(squares))
            names = np.array([q[0] for q in queries], np.int64)
            return pa.RecordBatch.from_arrays([pa.array(names[row]), pa.array(ids[row, column]), pa.array(squares[row, column])], names=["query_id", "vec_id", "square"])

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("cell", "a", "b"))))
            kinds, ids, rows = batch.column("kind").to_pylist(), batch.column("id").to_numpy(), rows_of(batch.column("vector"))
            i = 0
            while i < len(keys):
                if keys[i] != now:
                    if (out := result()) is not None:
                        yield out
                    now, queries, best = keys[i], [], None
                j = i
                while j < len(keys) and keys[j] == now and kinds[j] == kinds[i]:
                    j += 1
                if kinds[i] == 0:
                    queries += [(int(n), v) for n, v in zip(ids[i:j], rows[i:j])]
                elif queries:
                    if best is None:
                        names, matrix = np.array([q[0] for q in queries], np.int64), np.array([q[1] for q in queries])
                        best = np.zeros((len(names), 0), np.int64), np.zeros((len(names), 0))
                    step = max(1, 2_000_000 // (matrix.size or 1))
                    for s in range(i, j, step):
                        part, names_here = np.array(rows[s : min(s + step, j)]), ids[s : min(s + step, j)]
                        squares = ((matrix[:, None, :] - part[None, :, :]) ** 2).sum(axis=2)
                        squares[names[:, None] == names_here[None, :]] = np.inf
                        best = merged(best, names_here, squares, k)
                i = j
        if (out := result()) is not None:
            yield out

    return (
        left.union(right).repartition("cell", "a", "b").sortWithinPartitions("cell", "a", "b", "kind")
        .mapInArrow(rerank, "query_id long, vec_id long, square double")
    )
