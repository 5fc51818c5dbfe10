"""Approximate nearest neighbours by learned partitions.

A bounded sample of the vectors gives a neighbour graph; the graph is cut into parts of equal size with few edges
between them; a small classifier learns from every sample vector how its neighbours spread over the parts.  The
classifier then places every vector of the table in its most probable part, and routes a query to the most probable
parts, whose vectors are all compared with it by exact cosine.

The fit is bounded by ``SAMPLE`` vectors.  Placing and routing are narrow.  A part, however large, is dealt in blocks
of bounded bytes on either side, so no task holds a whole part, and no vector of a routed part is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import materialise

SAMPLE = 8_192
DEGREE = 10
PART_ROWS = 2_000  # vectors that a part should have; at most SAMPLE / PART_SAMPLE parts
PART_SAMPLE = 32
HIDDEN = 128
STEPS = 300
MASS = 0.98  # parts are added for a query until their probabilities reach this
ENOUGH = 64  # and until they hold so many vectors
BLOCK_BYTES = 32 << 20
SLACK = 1e-9


def neighbour_graph(unit: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Indices of the ``degree`` nearest other rows (unit vectors) of every row."""
    n = len(unit)
    degree = min(degree, n - 1)
    out = np.empty((n, degree), dtype=np.int64)
    for at in range(0, n, 1024):
        near = unit[at: at + 1024] @ unit.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out[at: at + 1024] = np.argpartition(-near, degree - 1, axis=1)[:, :degree]
    return out


def balanced_parts(graph: np.ndarray, parts: int, rounds: int = 8) -> np.ndarray:
    """A part for every node: regions grown along the edges up to an equal size, then nodes move to the part of most of
    their neighbours while it has room (a twentieth over the equal size)."""
    n = len(graph)
    size = -(-n // parts)
    edges: list[list[int]] = [list(row) for row in graph.tolist()]
    for node, row in enumerate(graph.tolist()):
        for other in row:
            edges[other].append(node)
    part = np.full(n, -1, dtype=np.int64)
    seeds = iter(range(n))
    for number in range(parts):
        queue: list[int] = []
        members = head = 0
        while members < size:
            if head == len(queue):
                seed = next((s for s in seeds if part[s] < 0), None)
                if seed is None:
                    break
                part[seed] = number
                members += 1
                queue.append(seed)
                continue
            node = queue[head]
            head += 1
            for other in edges[node]:
                if part[other] < 0 and members < size:
                    part[other] = number
                    members += 1
                    queue.append(other)
    part[part < 0] = parts - 1
    count = np.bincount(part, minlength=parts)
    room = math.ceil(1.05 * size)
    for _ in range(rounds):
        moved = 0
        for node in range(n):
            votes = np.bincount(part[edges[node]], minlength=parts)
            votes[count >= room] = -1
            best = int(votes.argmax())
            own = part[node]
            if best != own and votes[best] > np.count_nonzero(part[edges[node]] == own):
                part[node] = best
                count[own] -= 1
                count[best] += 1
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A classifier with one hidden layer from unit vectors to part probabilities."""

    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: np.ndarray

    def probabilities(self, unit: np.ndarray) -> np.ndarray:
        hidden = np.tanh(unit @ self.first + self.first_bias)
        odds = hidden @ self.second + self.second_bias
        odds -= odds.max(axis=1, keepdims=True)
        out = np.exp(odds)
        return out / out.sum(axis=1, keepdims=True)


def fit_router(unit: np.ndarray, wanted: np.ndarray, steps: int = STEPS) -> Router:
    """Fit by full-batch Adam steps to the wanted distribution of every row; the start is seeded, reruns agree."""
    random = np.random.default_rng(7)
    dim, parts = unit.shape[1], wanted.shape[1]
    weights = [
        random.normal(size=(dim, HIDDEN)) / math.sqrt(dim) * 2, np.zeros(HIDDEN),
        random.normal(size=(HIDDEN, parts)) / math.sqrt(HIDDEN), np.zeros(parts),
    ]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        router = Router(*weights)
        hidden = np.tanh(unit @ weights[0] + weights[1])
        off = (router.probabilities(unit) - wanted) / len(unit)
        back = (off @ weights[2].T) * (1 - hidden**2)
        slopes = [unit.T @ back, back.sum(axis=0), hidden.T @ off, off.sum(axis=0)]
        for i, slope in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.99 * second[i] + 0.01 * slope**2
            scale = np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8
            weights[i] = weights[i] - 0.02 * (first[i] / (1 - 0.9**step)) / scale
    return Router(*weights)


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(-1, dim)


def _unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    scaled = vectors / largest
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _levelled(vectors: np.ndarray) -> np.ndarray:
    """Every vector times the power of two that brings its largest component to between 0.5 and 1.  Cosines keep every
    bit, and squares and products neither overflow nor vanish, however long or short a vector is."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponent)


def usable_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) in double precision: no nulls, no null or non-finite component, not zero; equal rows once.

    The dimension is the most frequent length; vectors of another length take no part.
    """
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0)
    )
    top = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = top["dim"] if top else 0
    return rows.where(F.size("vector") == dim).distinct()


def _routes(probabilities: np.ndarray, held: np.ndarray, mass: float, enough: int) -> list[list[int]]:
    """Parts of each query, most probable first."""
    order = np.argsort(-probabilities, axis=1, kind="stable")
    sorted_ = np.take_along_axis(probabilities, order, axis=1)
    before = np.cumsum(sorted_, axis=1) - sorted_
    rows = np.cumsum(held[order], axis=1) - held[order]
    take = (before < mass) | (rows < enough)
    return [order[i][take[i]].tolist() for i in range(len(order))]


def _best(query_ids, queries, ids, vectors, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, vec_id, score) of the k nearest in these vectors, score computed pair by pair in double precision."""
    queries, vectors = _levelled(queries), _levelled(vectors)
    unit, norms = _unit(vectors), np.sqrt((vectors * vectors).sum(axis=1))
    step = max(1, (4 << 20) // max(1, len(ids)))
    order = np.argsort(ids, kind="stable")
    starts = np.flatnonzero(np.diff(ids[order], prepend=ids[order[0]] - 1))  # of each id, whose rows count once
    for at in range(0, len(query_ids), step):
        own, some = query_ids[at: at + step], queries[at: at + step]
        near = _unit(some) @ unit.T
        near[own[:, None] == ids[None, :]] = -np.inf
        best = near if len(starts) == len(ids) else np.maximum.reduceat(near[:, order], starts, axis=1)
        if k < best.shape[1]:
            least = -np.partition(-best, k - 1, axis=1)[:, k - 1] - SLACK
        else:
            least = np.full(len(own), -2.0)
        row, column = np.nonzero((near >= least[:, None]) & (near > -np.inf))
        length = np.sqrt((some * some).sum(axis=1))
        for cut in range(0, len(row), 1 << 18):
            r, c = row[cut: cut + (1 << 18)], column[cut: cut + (1 << 18)]
            dot = (some[r] * vectors[c]).sum(axis=1)
            yield own[r], ids[c], dot / (length[r] * norms[c])


def nearest(
    table: DataFrame,
    k: int = 5,
    every: int = 50,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    mass: float = MASS,
    part_rows: int = PART_ROWS,
    sample_rows: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every id divisible by ``every`` the k nearest found, nearest first, ties to
    the smaller id.

    Unusable vectors (see ``usable_vectors``) are neither queries nor candidates.  Rows with the query's id are its own
    and no candidates; several rows of one other id count once, with the nearest.  Other columns are ignored; an empty
    table gives an empty result, and with k candidates or fewer all are returned.
    """
    spark = table.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    vectors = materialise(usable_vectors(table, id_col, vector_col), "ann-vectors")
    n = vectors.count()
    if not n:
        return spark.createDataFrame([], schema)
    order = F.xxhash64("vec_id")
    drawn = vectors.orderBy(order, "vec_id", "vector").limit(sample_rows).toArrow()
    dim = len(drawn["vector"][0])
    sample = _unit(_matrix(drawn["vector"], dim))
    parts = max(1, min(math.ceil(n / part_rows), len(sample) // PART_SAMPLE))
    router = None
    if parts > 1:
        graph = neighbour_graph(sample.astype(np.float32))
        part = balanced_parts(graph, parts)
        around = np.zeros((len(sample), parts))
        for column in range(graph.shape[1]):
            np.add.at(around, (np.arange(len(sample)), part[graph[:, column]]), 1.0)
        np.add.at(around, (np.arange(len(sample)), part), 2.0)
        router = fit_router(sample, around / around.sum(axis=1, keepdims=True))

    def chances(vectors_: np.ndarray) -> np.ndarray:
        return router.probabilities(_unit(vectors_)) if router else np.ones((len(vectors_), 1))

    @F.arrow_udf("int")
    def home(column: pa.Array) -> pa.Array:
        return pa.array(chances(_matrix(column, dim)).argmax(axis=1).astype(np.int32))

    placed = materialise(vectors.withColumn("part", home(F.col("vector"))), "ann-placed")
    held = np.zeros(parts, dtype=np.int64)
    for row in placed.groupBy("part").count().collect():  # one row per part
        held[row["part"]] = row["count"]

    @F.arrow_udf("array<int>")
    def route(column: pa.Array) -> pa.Array:
        return pa.array(_routes(chances(_matrix(column, dim)), held, mass, ENOUGH), type=pa.list_(pa.int32()))

    queries = placed.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), "vector", F.explode(route(F.col("vector"))).alias("part")
    )
    queries = materialise(queries, "ann-queries")
    asked = np.zeros(parts, dtype=np.int64)
    for row in queries.groupBy("part").count().collect():
        asked[row["part"]] = row["count"]
    rows = max(1, BLOCK_BYTES // (8 * dim))
    blocks = lambda counts: F.array(*[F.lit(max(1, -(-int(c) // rows))) for c in counts])[F.col("part")]
    mine = lambda id_, counts: F.pmod(F.xxhash64(id_), blocks(counts)).cast("int")
    all_ = lambda counts: F.explode(F.sequence(F.lit(0), blocks(counts) - 1))
    left = queries.withColumn("qblock", mine("query_id", asked)).withColumn("vblock", all_(held))
    right = placed.withColumn("vblock", mine("vec_id", held)).withColumn("qblock", all_(asked))
    keys = ["part", "vblock", "qblock"]

    def compare(_: tuple, ask: pa.Table, have: pa.Table) -> pa.Table:
        out = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)]
        if ask.num_rows and have.num_rows:
            ids = have["vec_id"].to_numpy()
            found = list(_best(ask["query_id"].to_numpy(), _matrix(ask["vector"], dim), ids,
                               _matrix(have["vector"], dim), k))
            if found:
                query, vec, score = (np.concatenate(column) for column in zip(*found))
                first = np.lexsort((vec, -score, query))
                query, vec, score = query[first], vec[first], score[first]
                # Equal ids keep their nearest, then k per query.
                _, fresh = np.unique(np.stack([query, vec]), axis=1, return_index=True)
                fresh.sort()
                query, vec, score = query[fresh], vec[fresh], score[fresh]
                begin = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
                rank = np.arange(len(query)) - np.repeat(begin, np.diff(np.append(begin, len(query))))
                out = [column[rank < k] for column in (query, vec, score)]
        return pa.table(out, names=["query_id", "vec_id", "score"])

    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        compare, "query_id long, vec_id long, score double"
    )
    once = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
