"""Approximate nearest neighbours by cosine with a hash-prefix forest.

Each tree gives every vector a long hash string, the signs of its products with
random directions. An index block keeps, per tree, its strings sorted, so all
vectors that share a prefix with a query are one stretch of the array. A query
descends in every tree to its longest matching prefix; then all trees ascend
together, a bit at a time, and the stretches widen until the distinct vectors in
them reach ``share`` of the block. These candidates are compared exactly.

Equal vectors are one entry of the index, with their ``k + 1`` smallest ids, which
is all that k answers can need, so a vector of any number of copies is one row.
Index blocks and query blocks are bounded in size and meet pairwise; a block pair
answers with the block's best for each query, and the best of all blocks are the
query's. Work grows with queries times rows, as it must for a query set that is a
fixed share of the rows and a candidate share that keeps the recall.

The share is large because it has to be: with ``share`` = 0.5 and 32 trees recall on
near-random vectors is about 0.95. Vectors with neighbours much nearer than the rest
allow a far smaller one.

Cases: vectors that are null, empty, zero, of another length than most, or hold null
or non-finite components are neither queries nor candidates; equal scores go to the
smaller id; with fewer candidates all are returned; null ids take no part; rows that
repeat an id and a vector count as one candidate, and a query is not its own candidate
(rows of its id are left out).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from flowlog.llm.common import ship_package

TREES = 32
BITS = 32
SHARE = 0.5
INDEX_BLOCK = 16_384
QUERY_BLOCK = 4_096


def directions(trees: int, bits: int, width: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((trees, width, bits))


def hash_strings(unit: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Strings of each tree as unsigned integers, first bit highest."""
    bits = planes.shape[2]
    weight = (np.uint64(1) << np.arange(bits - 1, -1, -1, dtype=np.uint64))
    return np.stack([((unit @ p) > 0).astype(np.uint64) @ weight for p in planes])


class PrefixForest:
    """Sorted hash strings of one index block."""

    def __init__(self, vectors: np.ndarray, planes: np.ndarray):
        self.planes, self.bits = planes, planes.shape[2]
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.vectors = vectors
        strings = hash_strings(vectors / self.norms[:, None], planes)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def stretches(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(from, to) by tree, prefix length and query."""
        strings = hash_strings(queries / np.sqrt((queries * queries).sum(axis=1))[:, None], self.planes)
        shape = (len(self.planes), self.bits + 1, len(queries))
        low, high = np.empty(shape, np.int64), np.empty(shape, np.int64)
        for t, own in enumerate(self.sorted):
            for n in range(self.bits + 1):
                cut = np.uint64(self.bits - n)
                first = (strings[t] >> cut) << cut
                low[t, n] = np.searchsorted(own, first, "left")
                high[t, n] = np.searchsorted(own, first + ((np.uint64(1) << cut) - np.uint64(1)), "right")
        return low, high

    def candidates(self, low: np.ndarray, high: np.ndarray, want: int) -> np.ndarray:
        """Ascend from the longest matches, all trees at once, until ``want`` distinct entries are in."""
        total = (high - low).sum(axis=0)
        level = int(np.flatnonzero(total >= want).max())      # level 0 always has them all
        found = np.zeros(self.order.shape[1], bool)
        while True:
            for t, own in enumerate(self.order):
                found[own[low[t, level]:high[t, level]]] = True
            if level == 0 or int(found.sum()) >= want:
                return np.flatnonzero(found)
            level -= 1

    def nearest(self, queries: np.ndarray, query_ids: list[int], ids: list[list[int]], k: int, share: float):
        want = min(len(self.vectors), max(k + 1, int(np.ceil(share * len(self.vectors)))))
        low, high = self.stretches(queries)
        q_norms = np.sqrt((queries * queries).sum(axis=1))
        unit = self.vectors / self.norms[:, None]
        for q, own in enumerate(query_ids):
            near = self.candidates(low[:, :, q], high[:, :, q], want)
            rough = unit[near] @ queries[q]
            keep = k + 1
            if len(near) > keep:
                bound = np.partition(rough, -keep)[-keep]
                near = near[rough >= bound - 1e-9 * q_norms[q]]
            exact = (self.vectors[near] * queries[q]).sum(axis=1) / (self.norms[near] * q_norms[q])
            rows = [(own, i, s) for e, s in zip(near.tolist(), exact.tolist()) for i in ids[e] if i != own]
            yield from sorted(rows, key=lambda r: (-r[2], r[1]))[:k]


def usable_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    vector = F.col(vector_col).cast("array<double>")
    good = (F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()
            & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0))
    rows = table.select(F.col(id_col).alias("vec"), vector.alias("v")).where(F.coalesce(good, F.lit(False)))
    width = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").first()
    return rows.where(F.size("v") == F.lit(width["w"] if width else 0))


def nearest_neighbours(table: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
                       trees: int = TREES, bits: int = BITS, share: float = SHARE,
                       index_block: int = INDEX_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Rows (query_id, rank, vec_id, score). ``is_query`` is a condition on the id column."""
    ship_package(table.sparkSession)
    rows = usable_vectors(table, id_col, vector_col)
    # the k + 1 smallest ids of each distinct vector
    ranked = (rows.distinct().withColumn("h", F.xxhash64("v"))
              .withColumn("r", F.row_number().over(Window.partitionBy("h", "v").orderBy("vec"))).where(F.col("r") <= k + 1))
    entries = ranked.groupBy("h", "v").agg(F.sort_array(F.collect_list("vec")).alias("ids"))
    queries = rows.withColumnRenamed("vec", id_col).where(is_query).withColumnRenamed(id_col, "vec").dropDuplicates(["vec"])
    sizes = rows.agg(F.count("*")).first()[0], queries.agg(F.count("*")).first()[0]
    n_index, n_query = max(1, -(-sizes[0] // index_block)), max(1, -(-sizes[1] // query_block))
    index = (entries.withColumn("iblock", F.pmod("h", F.lit(n_index)).cast("int"))
             .withColumn("qblock", F.explode(F.sequence(F.lit(0), F.lit(n_query - 1)))).select("iblock", "qblock", "ids", "v"))
    asked = (queries.withColumn("qblock", F.pmod(F.xxhash64("vec"), F.lit(n_query)).cast("int"))
             .withColumn("iblock", F.explode(F.sequence(F.lit(0), F.lit(n_index - 1)))).select("iblock", "qblock", "vec", "v"))

    def matrix(column) -> np.ndarray:
        flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        return np.asarray(flat.flatten(), dtype=np.float64).reshape(len(flat), -1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            vectors = matrix(left.column("v"))
            forest = PrefixForest(vectors, directions(trees, bits, vectors.shape[1]))
            found = list(forest.nearest(matrix(right.column("v")), right.column("vec").to_pylist(), left.column("ids").to_pylist(), k, share))
        q, i, s = zip(*found) if found else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(i, pa.int64()), "score": pa.array(s, pa.float64())})

    best = index.groupBy("iblock", "qblock").cogroup(asked.groupBy("iblock", "qblock")).applyInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
