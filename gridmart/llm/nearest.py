"""Nearest neighbours by largest inner product, with multiprobe p-stable hashing.

Largest inner products become smallest distances: vectors are divided by the top of their range of norms
(the largest norm, its half, its quarter and so on, so that one long vector does not press all others
together) and lifted onto the unit sphere by one more component, queries are scaled to length one. A table
hashes a vector to the cell of a grid, ``floor((a.x + b) / width)`` for ``n_hashes`` random directions. A
query visits its own cell and then its neighbours, in the order in which they are expected to hold
near vectors: directions are ranked by the query's distance to the cell wall, and perturbations
are visited by the expected sum of squared wall distances, which depends on the ranks alone.

Cells are dealt to blocks of bounded size, on the side of the vectors and of the queries: a hot
cell is cut over several blocks, each of which sees every query that probes it. A block keeps a
query's best; the candidates of all tables are merged. Matrix products only leave out what cannot be among
the best, whatever their rounding; what is left is ranked by products summed in the order of the components, so
that equal vectors have equal scores.

Every vector is in every table. ``N_TABLES``, ``N_HASHES``, ``WIDTH`` and ``N_PROBES`` are set for a
recall of over 0.9 on vectors without much structure, where this takes more than half of all vectors as candidates.
A query that finds fewer than ``k`` vectors there, or than there are, is compared with every vector.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.common import map_batches, ship_package, stored

K = 20
N_TABLES = 5
N_HASHES = 6
WIDTH = 1.5
N_PROBES = 320
SEED = 2
BLOCK_VECTORS = 16_384
BLOCK_QUERIES = 4_096
SCORES_AT_ONCE = 1 << 22
PAIRS_AT_ONCE = 1 << 15


def probing_order(n_hashes: int, n_probes: int) -> list[tuple[int, ...]]:
    """Sets of ranks to perturb, most promising first; rank r stands for the r-th nearest wall.

    The expected squared distance of the r-th nearest of 2 M walls, in units of the width, is
    r (r + 1) / (4 (M + 1) (M + 2)) up to M; the wall opposite has 1 - 2 z + z**2 of it, in expectation. Ranks r
    and 2 M + 1 - r are the two walls of one direction, and never go together.
    """
    m = n_hashes
    near = [r * (r + 1) / (4 * (m + 1) * (m + 2)) for r in range(1, m + 1)]
    far = [1 - (2 * m + 1 - r) / (m + 1) + near[2 * m - r] for r in range(m + 1, 2 * m + 1)]
    cost = near + far
    order: list[tuple[int, ...]] = [()]
    waiting = [(cost[0], (0,))]
    while waiting and len(order) < n_probes:
        total, ranks = heapq.heappop(waiting)
        if len({min(r, 2 * m - 1 - r) for r in ranks}) == len(ranks):
            order.append(ranks)
        last = ranks[-1]
        if last + 1 < 2 * m:
            heapq.heappush(waiting, (total + cost[last + 1] - cost[last], (*ranks[:-1], last + 1)))
            heapq.heappush(waiting, (total + cost[last + 1], (*ranks, last + 1)))
    return order


class Tables:
    """The hash functions, the same in every task."""

    def __init__(self, dim: int, n_tables: int, n_hashes: int, width: float, n_probes: int, seed: int):
        random = np.random.default_rng(seed)
        self.directions = random.normal(size=(n_tables, dim + 1, n_hashes))
        self.offsets = random.uniform(0, width, size=(n_tables, n_hashes))
        self._odd = random.integers(1, 1 << 62, size=n_hashes, dtype=np.int64) * 2 + 1
        self._width = width
        self._order = probing_order(n_hashes, n_probes)

    def cells(self, points: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Grid coordinates and the place within the cell."""
        at = (points @ self.directions[table] + self.offsets[table]) / self._width
        floor = np.floor(at)
        return floor.astype(np.int64), at - floor

    def bucket(self, cells: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = (cells * self._odd).sum(axis=-1)
            mixed = (mixed ^ (mixed >> 31)) * np.int64(0x1E3779B97F4A7C15)
        return (mixed ^ (mixed >> 29)) & np.int64((1 << 62) - 1)

    def probes(self, points: np.ndarray, table: int) -> np.ndarray:
        """Buckets to visit, a row for each point."""
        cells, place = self.cells(points, table)
        n, m = cells.shape
        ranked = np.argsort(np.concatenate([place, 1 - place], axis=1), axis=1, kind="stable")
        rows = np.arange(n)
        buckets = np.empty((n, len(self._order)), np.int64)
        for i, ranks in enumerate(self._order):
            moved = cells.copy()
            for rank in ranks:
                wall = ranked[:, rank]
                moved[rows, wall % m] += np.where(wall < m, -1, 1)
            buckets[:, i] = self.bucket(moved)
        return buckets


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.ListArray) else column.values
    return np.asarray(flat.to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def _range_top(norms: np.ndarray, longest: float) -> np.ndarray:
    """The largest norm halved as often as it stays at or above the vector's own."""
    return longest * 2.0 ** -np.maximum(0.0, np.floor(np.log2(longest / norms)))


def _hash_vectors(batches: Iterator[pa.RecordBatch], dim: int, longest: float, n_blocks: int, settings: tuple) -> Iterator[pa.RecordBatch]:
    tables = Tables(dim, *settings)
    for batch in batches:
        points = _matrix(batch.column("vector"), dim)
        points = points / _range_top(np.linalg.norm(points, axis=1), longest)[:, None]
        lift = np.sqrt(np.maximum(0.0, 1.0 - (points**2).sum(axis=1)))
        points = np.column_stack([points, lift])
        for table in range(settings[0]):
            bucket = tables.bucket(tables.cells(points, table)[0])
            n = len(bucket)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, table, np.int32)), pa.array((bucket % n_blocks).astype(np.int32)), pa.array(bucket),
                 batch.column("id"), batch.column("vector")],
                ["table", "block", "bucket", "id", "vector"],
            )


def _hash_queries(batches: Iterator[pa.RecordBatch], dim: int, n_blocks: int, settings: tuple) -> Iterator[pa.RecordBatch]:
    tables = Tables(dim, *settings)
    for batch in batches:
        points = _matrix(batch.column("vector"), dim)
        points = points / np.linalg.norm(points, axis=1, keepdims=True)
        points = np.column_stack([points, np.zeros(len(points))])
        for table in range(settings[0]):
            probes = tables.probes(points, table)
            block = probes % n_blocks
            rows, blocks, lists = [], [], []
            for b in range(n_blocks) if n_blocks < probes.shape[1] else np.unique(block):
                inside = block == b
                for row in np.flatnonzero(inside.any(axis=1)):
                    rows.append(row)
                    blocks.append(b)
                    lists.append(probes[row, inside[row]])
            if not rows:
                continue
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), table, np.int32)), pa.array(blocks, pa.int32()), pa.array(lists, pa.list_(pa.int64())),
                 batch.column("id").take(taken), batch.column("vector").take(taken)],
                ["table", "block", "buckets", "id", "vector"],
            )


def _block_best(key: tuple, queries: pa.Table, vectors: pa.Table, dim: int, k: int) -> pa.Table:
    """A query's ``k`` best of the vectors in the buckets that it probes, of one block, some queries at a time."""
    vectors = _least_of_equals(vectors.combine_chunks(), dim, k)
    step = max(1, SCORES_AT_ONCE // max(1, len(vectors)))
    slices = [queries.slice(at, step) for at in range(0, max(1, len(queries)), step)]
    return pa.concat_tables([_best(some, vectors, dim, k) for some in slices])


def _least_of_equals(vectors: pa.Table, dim: int, k: int) -> pa.Table:
    """Without the vectors that have more than ``k`` equals of smaller id in their bucket: they lose every tie."""
    if not len(vectors):
        return vectors
    held = np.ascontiguousarray(_matrix(vectors.column("vector").combine_chunks(), dim) + 0.0)
    _, content = np.unique(held.view(np.dtype((np.void, 8 * dim))).ravel(), return_inverse=True)
    bucket, vec_id = vectors.column("bucket").to_numpy(), vectors.column("id").to_numpy()
    order = np.lexsort((vec_id, bucket, content))
    starts = np.append(True, (np.diff(content[order]) != 0) | (np.diff(bucket[order]) != 0))
    return vectors.take(np.sort(order[_places(np.cumsum(starts)) <= k]))


def _best(queries: pa.Table, vectors: pa.Table, dim: int, k: int) -> pa.Table:
    queries, vectors = queries.combine_chunks(), vectors.combine_chunks()
    one = lambda table, name: table.column(name).combine_chunks()
    empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    if not len(queries) or not len(vectors):
        return empty
    asked, held = _matrix(one(queries, "vector"), dim), _matrix(one(vectors, "vector"), dim)
    query_id, vec_id = one(queries, "id").to_numpy(), one(vectors, "id").to_numpy()
    # Two ways to sum a product differ by less than ``noise`` times both norms.
    noise = 2 * (dim + 4) * np.finfo(np.float64).eps
    asked_noise, held_norm = noise * np.linalg.norm(asked, axis=1), np.linalg.norm(held, axis=1)
    bucket = one(vectors, "bucket").to_numpy()
    order = np.argsort(bucket, kind="stable")
    names, starts = np.unique(bucket[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    lists = one(queries, "buckets")
    probed = lists.flatten().to_numpy()
    asker = np.repeat(np.arange(len(queries)), np.diff(lists.offsets.to_numpy()))
    where = np.searchsorted(names, probed)
    hit = (where < len(names)) & (names[np.minimum(where, len(names) - 1)] == probed)
    where, asker = where[hit], asker[hit]
    by_bucket = np.argsort(where, kind="stable")
    where, asker = where[by_bucket], asker[by_bucket]
    found: list[tuple] = []
    for lo, hi in zip(*_runs(where), strict=True):
        inside = order[starts[where[lo]] : ends[where[lo]]]
        who = asker[lo:hi]
        scores = asked[who] @ held[inside].T
        error = asked_noise[who][:, None] * held_norm[inside][None, :] + np.finfo(np.float64).tiny
        own = query_id[who][:, None] == vec_id[inside][None, :]
        least = scores - error
        least[own] = -np.inf
        possible = ~own
        if len(inside) > k:
            limit = np.partition(least, len(inside) - k, axis=1)[:, len(inside) - k]
            possible &= scores + error >= limit[:, None]
        at = np.nonzero(possible)
        pairs = (who[at[0]], inside[at[1]], least[at], (scores + error)[at])
        if len(pairs[0]) > 4 * k * len(who):  # many that tie, or nearly
            kept, _ = _ranked(pairs[0], pairs[1], asked, held, vec_id, k)
            pairs = tuple(c[kept] for c in pairs)
        found.append(pairs)
    if not found:
        return empty
    who, which, least, most = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((-least, who))
    who, which, least, most = who[order], which[order], least[order], most[order]
    limit = np.full(len(queries), -np.inf)
    last = _places(who) == k - 1
    limit[who[last]] = least[last]
    possible = most >= limit[who]
    who, which = who[possible], which[possible]
    kept, score = _ranked(who, which, asked, held, vec_id, k)
    return pa.table({"query_id": query_id[who[kept]], "vec_id": vec_id[which[kept]], "score": score})


def _ranked(
    who: np.ndarray, which: np.ndarray, asked: np.ndarray, held: np.ndarray, vec_id: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """The places of every asker's ``k`` best pairs and their scores, summed in the order of the components."""
    score = np.zeros(len(who))
    for at in range(0, len(who), PAIRS_AT_ONCE):
        some = slice(at, at + PAIRS_AT_ONCE)
        products = (asked[who[some]] * held[which[some]]).T.copy()
        for product in products:
            score[some] += product
    order = np.lexsort((vec_id[which], -score, who))
    order = order[_places(who[order]) < k]
    return order, score[order]


def _places(values: np.ndarray) -> np.ndarray:
    """Places, from 0, within the runs of equal values."""
    first, last = _runs(values)
    return np.arange(len(values)) - np.repeat(first, last - first)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.empty(0, np.int64)
    return starts, np.append(starts[1:], len(values)) if len(values) else starts


def _searched(asked: DataFrame, hashed: DataFrame, dim: int, k: int) -> DataFrame:
    """The best that every query finds in each block that it probes: query_id, vec_id, score."""
    # A block beyond its size is cut on either side; every cut of one side meets all of the other's.
    cuts = hashed.groupBy("table", "block").agg(F.count("*").alias("held")).join(
        asked.groupBy("table", "block").agg(F.count("*").alias("asking")), ["table", "block"]
    ).select(
        "table", "block",
        F.ceil(F.col("held") / (2 * BLOCK_VECTORS)).cast("int").alias("vector_cuts"),
        F.ceil(F.col("asking") / BLOCK_QUERIES).cast("int").alias("query_cuts"),
    )
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    left = asked.join(cuts, ["table", "block"]).withColumn("query_cut", own("query_cuts")).withColumn("vector_cut", every("vector_cuts"))
    right = hashed.join(cuts, ["table", "block"]).withColumn("vector_cut", own("vector_cuts")).withColumn("query_cut", every("query_cuts"))
    keys = ["table", "block", "vector_cut", "query_cut"]
    ship_package(asked.sparkSession)
    return (
        left.select(*keys, "id", "vector", "buckets").groupBy(*keys)
        .cogroup(right.select(*keys, "id", "vector", "bucket").groupBy(*keys))
        .applyInArrow(partial(_block_best, dim=dim, k=k), "query_id bigint, vec_id bigint, score double")
    )


def _merged(found: DataFrame, k: int) -> DataFrame:
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = merged.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = K,
    n_tables: int = N_TABLES,
    n_hashes: int = N_HASHES,
    width: float = WIDTH,
    n_probes: int = N_PROBES,
    seed: int = SEED,
) -> DataFrame:
    """The ``k`` vectors found of largest inner product with each query: query_id, rank (from 1),
    vec_id, score; ties go to the smaller id, the query's own id is left out. Only where there are fewer
    other vectors does a query get fewer rows.

    Vectors that are null, zero, of another length than most, or hold null or non-finite
    components take no part, nor do null ids. Rows that share an id are one vector, the smallest by
    content. An empty table gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    value = F.col(vector_column)
    usable = F.col(id_column).isNotNull() & value.isNotNull()
    rows = vectors.filter(usable).select(F.col(id_column).cast("bigint").alias("id"), value.alias("vector"), is_query.alias("asks"))
    rows = rows.filter(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    rows = rows.groupBy("id").agg(F.min("vector").alias("vector"), F.max("asks").alias("asks"))
    squared = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    rows = stored(rows.withColumn("norm", F.sqrt(squared)).filter("norm > 0"), "nearest-vectors")
    sizes = rows.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n"), F.max("norm").alias("longest"))
    most = sizes.orderBy(F.desc("n"), "dim").first()
    if most is None:
        return spark.createDataFrame([], schema)
    dim, n_vectors, longest = most
    rows = rows.filter(F.size("vector") == dim)
    settings = (n_tables, n_hashes, width, n_probes, seed)
    n_blocks = max(1, round(n_vectors / BLOCK_VECTORS))
    kind = rows.schema["vector"].dataType.simpleString()
    hashed = map_batches(
        rows.select("id", "vector"), partial(_hash_vectors, dim=dim, longest=longest, n_blocks=n_blocks, settings=settings),
        f"table int, block int, bucket bigint, id bigint, vector {kind}",
    )
    asked = map_batches(
        rows.filter("asks").select("id", "vector"), partial(_hash_queries, dim=dim, n_blocks=n_blocks, settings=settings),
        f"table int, block int, buckets array<bigint>, id bigint, vector {kind}",
    )
    hashed, asked = stored(hashed, "nearest-buckets"), stored(asked, "nearest-probes")
    best = _merged(_searched(asked, hashed, dim, k), k)
    # Queries that met too few vectors are compared with all: one bucket for every block of a table.
    best = stored(best, "nearest-found")
    enough = best.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("n")).filter(F.col("n") >= min(k, n_vectors - 1))
    short = stored(rows.filter("asks").select("id", "vector").join(enough, "id", "left_anti"), "nearest-short")
    if not short.isEmpty():
        one_bucket = F.lit(0).cast("bigint")
        everything = hashed.filter("table = 0").withColumn("bucket", one_bucket)
        every_block = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
        asking = short.select(
            F.lit(0).alias("table"), every_block.alias("block"), F.array(one_bucket).alias("buckets"), "id", "vector"
        )
        filled = _merged(_searched(asking, everything, dim, k), k)
        return best.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(filled)
    return best
