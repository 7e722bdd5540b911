"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table has several functions floor((a v + b) / w) with normally distributed a; their values are a
vector's bucket. A neighbour at distance r differs from the query by a normal step of deviation r
under each function, so the chance that it lies in a bucket is a product of normal probabilities,
known before any bucket is read. A query visits its own and perturbed buckets of every table in
falling order of that chance, down to a threshold: no number of probes is set, and at most one over
the threshold can reach it. Candidates of all tables are merged and ranked by exact distance.

Radius and threshold are fitted, not guessed: for ``CALIBRATION`` rows of least hash (out of
``FIT_ROWS`` that give the spread of the projections) the exact neighbours among all rows are found in
one pass, and the threshold is the one that reaches ``RECALL`` of them. Every row is indexed. The
number of functions follows the number of rows, so that a bucket holds some ``BUCKET_ROWS``.

The index is dealt by bucket to shards of some ``SHARD_ROWS``; a larger bucket is split by row. A shard
meets the queries that visit one of its buckets, in blocks of ``QUERY_BLOCK``, and returns the nearest
few of each query, so candidates are never rows of their own. A query that finds fewer than k rows is
searched again in all shards of one table, exactly.

Defined results: vectors that are null, zero, of another length than most, or hold null, infinite
or undefined components take no part, as row or as query. Repeated ids are rows of their own, and so
are queries that repeat one; a row is not its own neighbour but its repetitions are. Null ids are
indexed and come last among equal distances. Ties go to the smaller id, then to the row stored first.
Fewer than k rows are all returned. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bercario.llm.tables import stored
from bercario.llm.vectors import finite, matrix, of_common_length
from bercario.llm.words import PLACE, mixed
from bercario.operators.lookups import attach

NEIGHBOURS, TABLES = 10, 4
# Rows that the parameters are fitted on, and how many of them are searched exactly.
FIT_ROWS, CALIBRATION = 2_048, 128
RECALL = 0.97
BUCKET_ROWS, SHARD_ROWS, QUERY_BLOCK = 50, 4_096, 8_192
# Cells are this many deviations of the projections wide, which makes some 2.5 of them common.
WIDTH = 2.5
SEED = 20240613


def distances(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances in doubles, each summed the same way whatever rows stand beside it."""
    difference = rows - query
    return np.sqrt((difference * difference).sum(axis=1))


def _within(rows: np.ndarray, squares: np.ndarray, query: np.ndarray, k: int) -> np.ndarray:
    """A few rows that surely hold the k nearest: by a fast product, with room for its rounding."""
    if len(rows) <= k:
        return np.arange(len(rows))
    own = query @ query
    rough = squares + own - 2 * (rows @ query)
    room = 1e-9 * (squares.max() + own)
    return np.flatnonzero(~(rough > np.partition(rough, k - 1)[k - 1] + room))


def nearest_of(
    rows: np.ndarray, squares: np.ndarray, query: np.ndarray, k: int, ids: list, keys: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of the k nearest rows, ties to the smaller id, null last, then key."""
    some = _within(rows, squares, query, k)
    found = distances(rows[some], query)
    if len(some) > k:
        near = found <= np.partition(found, k - 1)[k - 1]
        some, found = some[near], found[near]
    order = sorted(
        range(len(some)),
        key=lambda at: (found[at], ids[some[at]] is None, ids[some[at]] or 0, keys[some[at]]),
    )[:k]
    return some[order], found[order]


def _cell_chance(low: float) -> float:
    return 0.5 * math.erfc(-low / math.sqrt(2))


@dataclass(frozen=True)
class Hashing:
    """The functions of all tables, and the fitted radius and threshold."""

    directions: np.ndarray  # tables x length x functions
    shifts: np.ndarray  # tables x functions
    width: float
    radius: float = 1.0
    threshold: float = 1.0

    @property
    def tables(self) -> int:
        return len(self.directions)

    def places(self, vectors: np.ndarray, table: int) -> np.ndarray:
        """Where vectors fall along each function, in cells."""
        return vectors @ self.directions[table] / self.width + self.shifts[table]

    def tokens(self, cells: np.ndarray, table: int) -> np.ndarray:
        """Buckets as numbers; two that should share one only add candidates."""
        values = np.clip(cells, -(2.0**62), 2.0**62).astype(np.int64).astype(np.uint64)
        total = (values * PLACE[: values.shape[1]]).sum(axis=1, dtype=np.uint64)
        return mixed(total + np.uint64(table + 1) * PLACE[63]).view(np.int64)

    def chances(self, place: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Logarithm of the chance of each cell (by function), for a query at ``place``."""
        step = self.width / self.radius
        low, high = (cells - place) * step, (cells + 1 - place) * step
        chance = [_cell_chance(b) - _cell_chance(a) for a, b in zip(low.ravel(), high.ravel(), strict=True)]
        with np.errstate(divide="ignore"):
            return np.log(np.maximum(np.array(chance), 0.0)).reshape(low.shape)

    def probes(self, place: np.ndarray, table: int) -> np.ndarray:
        """The buckets that a query visits, by falling chance of holding a neighbour."""
        own = np.floor(place)
        reach = math.ceil(6 * self.radius / self.width) + 1
        offsets = np.arange(-reach, reach + 1.0)
        cells = own[:, None] + offsets[None, :]
        chance = self.chances(place[:, None], cells)
        # What the functions still to come can add at best.
        best = np.concatenate([np.cumsum(chance.max(axis=1)[::-1])[::-1][1:], [0.0]])
        least = math.log(self.threshold)
        total, made = np.zeros(1), np.zeros((1, 0))
        for i in range(len(place)):
            sums = total[:, None] + chance[i][None, :]
            rows, columns = np.nonzero(sums + best[i] >= least)
            total = sums[rows, columns]
            made = np.concatenate([made[rows], cells[i][columns][:, None]], axis=1)
        return self.tokens(made[np.argsort(-total, kind="stable")], table)

    def best_chance(self, query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """The greatest chance, over all tables, of the buckets that hold the vectors."""
        found = []
        for table in range(self.tables):
            place = self.places(query[None, :], table)
            cells = np.floor(self.places(vectors, table))
            found.append(self.chances(np.broadcast_to(place, cells.shape), cells).sum(axis=1))
        return np.max(found, axis=0)


def _columns(frame: DataFrame, *names: str) -> str:
    return ", ".join(f"{name} {frame.schema[name].dataType.simpleString()}" for name in names)


FOUND = "query long, query_id {id}, row long, vec_id {id}, score double"
FOUND_NAMES = ["query", "query_id", "row", "vec_id", "score"]


def _answer(found: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = [pa.int64(), id_type, pa.int64(), id_type, pa.float64()]
    columns = list(zip(*found, strict=True)) or [()] * 5
    arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, FOUND_NAMES)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query, each row once however many shards and tables gave it."""
    order = W.partitionBy("query").orderBy("score", F.col("vec_id").asc_nulls_last(), "row")
    ranked = found.withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= k)
    return ranked.dropDuplicates(["query", "rank"])


def _fit(rows: DataFrame, many: int, length: int, tables: int, k: int) -> Hashing:
    """Functions for so many rows, then the radius and the threshold that reach ``RECALL``."""
    functions = round(math.log(max(many / BUCKET_ROWS, 1)) / math.log(WIDTH))
    functions = min(max(functions, 1), len(PLACE) - 1)
    rng = np.random.default_rng(SEED)
    directions = rng.standard_normal((tables, length, functions))
    shifts = rng.random((tables, functions))
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(FIT_ROWS).select("row", "vector").collect()
    vectors = np.array([row["vector"] for row in sample], np.float64).reshape(len(sample), length)
    along = np.concatenate([vectors @ table for table in directions])
    spread = float(np.std(along, axis=0).mean()) if len(along) else 0.0
    hashing = Hashing(directions, shifts, WIDTH * spread if spread > 0 else 1.0)
    queries, keys = vectors[:CALIBRATION], [row["row"] for row in sample[:CALIBRATION]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, own = matrix(batch.column(1)), batch.column(0).to_numpy()
            squares = (values * values).sum(axis=1)
            at, of, score = [], [], []
            for number, query in enumerate(queries):
                near, found = nearest_of(values, squares, query, k + 1, [None] * len(own), own)
                at.append(near)
                of += [keys[number]] * len(near)
                score.append(found)
            rest = batch.take(pa.array(np.concatenate(at) if at else [], pa.int64()))
            scores = pa.array(np.concatenate(score) if score else [], pa.float64())
            columns = [pa.array(of, pa.int64()), rest.column(0), scores, rest.column(1)]
            yield pa.RecordBatch.from_arrays(columns, ["query", "row", "score", "vector"])

    near = rows.select("row", "vector").mapInArrow(
        work, f"query long, row long, score double, {_columns(rows, 'vector')}"
    )
    order = W.partitionBy("query").orderBy("score", "row")
    near = near.filter("query != row").withColumn("rank", F.row_number().over(order))
    # At most k rows for each of CALIBRATION queries.
    exact = near.filter(F.col("rank") <= k).collect()
    if not exact:
        return hashing
    radius = float(np.quantile([row["score"] for row in exact], 0.9))
    hashing = Hashing(directions, shifts, hashing.width, max(radius, 1e-9 * hashing.width))
    vector_of = dict(zip(keys, queries, strict=True))
    chances = [
        hashing.best_chance(vector_of[row["query"]], np.array([row["vector"]], np.float64))[0]
        for row in exact
    ]
    # The chance that this part of the true neighbours reach; one that none has would visit all.
    reached = float(np.sort(chances)[math.floor((1 - RECALL) * len(chances))])
    threshold = max(math.exp(reached), 1e-7) if math.isfinite(reached) else 1e-7
    return Hashing(directions, shifts, hashing.width, hashing.radius, min(threshold * (1 - 1e-9), 1.0))


@dataclass(frozen=True)
class Index:
    """All rows with their buckets, stored, and the number of shards they are dealt to."""

    rows: DataFrame  # row, vec_id, vector, tokens
    buckets: DataFrame  # token, copies
    hashing: Hashing
    shards: int
    many: int

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64("token", "copy"), F.lit(self.shards)).cast("int")

    def _dealt(self, blocks: int, tables: list[int]) -> DataFrame:
        """Each row once per table and block of queries, in the shard of its bucket."""
        token = F.array(*[F.element_at("tokens", table + 1) for table in tables])
        rows = self.rows.select("row", "vec_id", "vector", F.explode(token).alias("token"))
        split = self.buckets.filter("copies > 1")
        rows = attach(rows, split, "token", self.rows.select(F.explode(token).alias("token")), unique=True)
        copy = F.pmod(F.xxhash64("row"), F.coalesce("copies", F.lit(1))).cast("int")
        rows = rows.withColumn("copy", copy).withColumn("shard", self._shard())
        block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        return rows.select("shard", block.alias("block"), "token", "row", "vec_id", "vector")

    def search(self, queries: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
        """query, query_id, rank, vec_id, score for queries with query (a number), vec_id, vector.

        ``query`` is the ``row`` of a query that is itself indexed, otherwise a number below zero.
        """
        hashing = self.hashing
        blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = matrix(batch.column(1))
                of, tokens = [], []
                for table in range(hashing.tables):
                    for number, place in enumerate(hashing.places(values, table)):
                        tokens.append(hashing.probes(place, table))
                        of.append(np.full(len(tokens[-1]), number))
                rows = batch.column(0).take(pa.array(np.concatenate(of) if of else [], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.array(np.concatenate(tokens) if tokens else [], pa.int64())], ["query", "token"]
                )

        visits = queries.select("query", "vector").mapInArrow(visit, "query long, token long")
        visits = visits.join(self.buckets, "token")
        copies = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
        visits = visits.select("query", "token", copies).withColumn("shard", self._shard())
        # At most one over the threshold of buckets for each query and table.
        visits = visits.groupBy("query", "shard").agg(F.collect_set("token").alias("visited"))
        found = stored(self._meet(queries, visits, blocks, k, list(range(hashing.tables))), "neighbours-found")
        enough = min(k, self.many - 1)
        counts = found.groupBy("query").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= enough)
        few = stored(queries.join(counts, "query", "left_anti"), "neighbours-few")
        if not few.isEmpty():
            everywhere = F.explode(F.sequence(F.lit(0), F.lit(self.shards - 1))).alias("shard")
            visits = few.select("query", everywhere, F.lit(None).cast("array<long>").alias("visited"))
            exact = self._meet(few, visits, blocks, k, [0])
            found = found.join(few.select("query"), "query", "left_anti").unionByName(exact)
        return found.select("query", "query_id", "rank", "vec_id", "score")

    def _meet(
        self, queries: DataFrame, visits: DataFrame, blocks: int, k: int, tables: list[int]
    ) -> DataFrame:
        """The k nearest rows in the visited buckets; visited buckets that are null stand for all."""
        named = queries.select("query", F.col("vec_id").alias("query_id"), F.col("vector").alias("asked"))
        visits = visits.join(named, "query")
        visits = visits.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
        id_type = self.rows.schema["vec_id"].dataType.simpleString()

        def search(rows: pa.Table, asked: pa.Table) -> pa.Table:
            found: list[tuple] = []
            kind = rows.schema.field("vec_id").type
            if rows.num_rows and asked.num_rows:
                rows = rows.combine_chunks().sort_by("token")
                values = matrix(rows["vector"].combine_chunks())
                squares = (values * values).sum(axis=1)
                token, key = rows["token"].to_numpy(), rows["row"].to_numpy()
                ids = rows["vec_id"].to_pylist()
                asked_values = matrix(asked["asked"].combine_chunks())
                names = asked["query_id"].to_pylist()
                for number, query in enumerate(asked["query"].to_pylist()):
                    visited = asked["visited"][number].values
                    if visited is None:
                        some = np.arange(len(token))
                    else:
                        wanted = np.sort(visited.to_numpy())
                        first = np.searchsorted(token, wanted, "left")
                        last = np.searchsorted(token, wanted, "right")
                        size = last - first
                        some = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
                    # Several tables may give a row; each is measured once.
                    some = some[np.unique(key[some], return_index=True)[1]]
                    some = some[key[some] != query]
                    if not len(some):
                        continue
                    own = [ids[at] for at in some]
                    near, score = nearest_of(values[some], squares[some], asked_values[number], k, own, key[some])
                    found += [
                        (query, names[number], int(key[some[at]]), own[at], float(distance))
                        for at, distance in zip(near, score, strict=True)
                    ]
            return pa.Table.from_batches([_answer(found, kind)])

        dealt = self._dealt(blocks, tables)
        met = dealt.groupBy("shard", "block").cogroup(visits.groupBy("shard", "block"))
        return _ranked(met.applyInArrow(search, FOUND.format(id=id_type)), k)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vector of the rows that can be measured."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    return rows.filter(finite(F.col("vector")) & F.exists("vector", lambda x: x != 0))


def build(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = TABLES
) -> Index:
    """An index of all usable rows."""
    rows = usable(vectors, id_col, vector_col)
    rows, length = of_common_length(rows, "vector")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "neighbours-rows")
    many = rows.count()
    hashing = _fit(rows, many, length, tables, NEIGHBOURS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch.column(2))
            tokens = [hashing.tokens(np.floor(hashing.places(values, t)), t) for t in range(hashing.tables)]
            flat = pa.array(np.stack(tokens, axis=1).ravel())
            offsets = np.arange(0, hashing.tables * batch.num_rows + 1, hashing.tables, dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["row", "vec_id", "vector", "tokens"])

    kinds = _columns(rows, "row", "vec_id", "vector")
    rows = stored(
        rows.select("row", "vec_id", "vector").mapInArrow(work, f"{kinds}, tokens array<long>"), "neighbours-index"
    )
    counts = rows.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    copies = F.ceil(F.col("n") / SHARD_ROWS).cast("int").alias("copies")
    buckets = stored(counts.select("token", copies), "neighbours-buckets")
    return Index(rows, buckets, hashing, max(1, math.ceil(many * tables / SHARD_ROWS)), many)


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = NEIGHBOURS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tables: int = TABLES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows of every row that ``is_query`` chooses.

    ``is_query`` is a condition on ``vec_id``.
    """
    index = build(vectors, id_col, vector_col, tables)
    queries = stored(
        index.rows.filter(is_query).select(F.col("row").alias("query"), "vec_id", "vector"), "neighbours-queries"
    )
    return index.search(queries, k).select("query_id", "rank", "vec_id", "score")
