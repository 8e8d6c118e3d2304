"""Approximate nearest neighbours by few stable projections, a kd-tree over them, and a chi-square stopping test.

Largest inner product becomes smallest distance by one more coordinate that gives all vectors the same length. A handful
of Gaussian (2-stable) projections keeps distances up to a chi-square factor. The projected space is cut into kd cells;
a cell, in parts of bounded size, is a task with a kd-tree of its own. A query verifies the points of its own part in
order of projected distance, and stops when a point farther out would be one of its nearest with less than the allowed
chance. With the bound it got there it goes on to those parts that the same test does not rule out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.common import key_counts, saved, spread

POINT = "cell int, part int, vec_id long, query boolean, vector array<double>"
FOUND = "query_id long, vec_id long, score double"


def chi_square_point(dims: int, chance: float) -> float:
    """Where the chi-square distribution of an even number of degrees reaches `chance`."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        half = middle / 2
        reached = 1 - math.exp(-half) * sum(half ** i / math.factorial(i) for i in range(dims // 2))
        low, high = (middle, high) if reached < chance else (low, middle)
    return high


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class Projection:
    def __init__(self, size: int, longest: float, dims: int, seed: int):
        self.longest = longest
        self.matrix = np.random.default_rng(seed).standard_normal((size + 1, dims))

    def points(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest ** 2 - (vectors ** 2).sum(axis=1), 0))
        return vectors @ self.matrix[:-1] + rest[:, None] * self.matrix[-1]

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.matrix[:-1]


def kd_split(points: np.ndarray, levels: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Median cuts of the widest axis, level by level: (axis, value) of each node of a level."""
    cuts, groups = [], [points]
    for _ in range(levels):
        axes, values, halves = [], [], []
        for group in groups:
            axis = int(np.ptp(group, axis=0).argmax()) if len(group) else 0
            value = float(np.median(group[:, axis])) if len(group) else 0.0
            right = group[:, axis] >= value
            axes.append(axis)
            values.append(value)
            halves += [group[~right], group[right]]
        cuts.append((np.array(axes), np.array(values)))
        groups = halves
    return cuts


def kd_cell(points: np.ndarray, cuts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    cell = np.zeros(len(points), dtype=np.int64)
    for axes, values in cuts:
        cell = 2 * cell + (points[np.arange(len(points)), axes[cell]] >= values[cell])
    return cell


class Leaves:
    """kd-tree of one part: leaves of about `size` points and their boxes."""

    def __init__(self, points: np.ndarray, size: int):
        order = [np.arange(len(points))]
        while max(len(x) for x in order) > size:
            halves = []
            for rows in order:
                if len(rows) <= size:
                    halves.append(rows)
                    continue
                axis = int(np.ptp(points[rows], axis=0).argmax())
                rows = rows[np.argpartition(points[rows, axis], len(rows) // 2)]
                halves += [rows[:len(rows) // 2], rows[len(rows) // 2:]]
            order = halves
        self.width = max(len(x) for x in order)
        self.rows = np.full((len(order), self.width), -1, dtype=np.int64)
        for n, rows in enumerate(order):
            self.rows[n, :len(rows)] = rows
        self.low = np.stack([points[rows].min(axis=0) for rows in order])
        self.high = np.stack([points[rows].max(axis=0) for rows in order])


def box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes."""
    total = np.zeros((len(points), len(low)))
    for k in range(points.shape[1]):
        total += np.maximum(np.maximum(low[:, k] - points[:, k, None], points[:, k, None] - high[:, k]), 0) ** 2
    return total


def search(projection: Projection, vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray,
           bounds: np.ndarray, k: int, stop: float, leaf: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores), k columns a query (id -1 where fewer): nearest first, ties to the smaller id. `bounds` are scores
    that a result must reach; a query ends when the next leaf's projected distance passes the chi-square point."""
    found_ids = np.full((len(queries), k), -1, dtype=np.int64)
    found = np.full((len(queries), k), -np.inf)
    if not len(vectors):
        return found_ids, found
    tree = Leaves(projection.points(vectors), leaf)
    squared = (queries ** 2).sum(axis=1) + projection.longest ** 2
    for start in range(0, len(queries), 512):
        part = np.arange(start, min(start + 512, len(queries)))
        near = box_distance(projection.queries(queries[part]), tree.low, tree.high)
        order = near.argsort(axis=1, kind="stable")
        near = np.take_along_axis(near, order, axis=1)
        active = np.arange(len(part))
        for step in range(0, order.shape[1], 2):
            own = part[active]
            worst = np.maximum(found[own, -1], bounds[own])
            farthest = np.where(np.isfinite(worst), squared[own] - 2 * worst, np.inf)
            active = active[near[active, step] <= stop * np.maximum(farthest, 0) + 1e-12]
            if not len(active):
                break
            own = part[active]
            rows = tree.rows[order[active, step:step + 2]].reshape(len(active), -1)
            scores = np.einsum("qnd,qd->qn", vectors[rows], queries[own])
            its = ids[rows]
            its[rows < 0] = -1
            scores[(rows < 0) | (its == query_ids[own][:, None])] = -np.inf
            all_scores = np.concatenate([found[own], scores], axis=1)
            all_ids = np.concatenate([found_ids[own], its], axis=1)
            best = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
            found[own] = np.take_along_axis(all_scores, best, axis=1)
            found_ids[own] = np.take_along_axis(all_ids, best, axis=1)
    found_ids[~np.isfinite(found)] = -1
    return found_ids, found


def _rows(query_ids: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pd.DataFrame:
    there = np.isfinite(scores)
    return pd.DataFrame({"query_id": np.repeat(query_ids, scores.shape[1])[there.ravel()], "vec_id": ids[there], "score": scores[there]})


def _stacked(column: pd.Series, size: int) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64) if len(column) else np.zeros((0, size))


def in_blocks(sent: DataFrame, ask_rows: int) -> tuple[DataFrame, DataFrame]:
    """What is sent to each (cell, part), dealt over blocks of about `ask_rows` rows, and (cell, part, block) of all blocks."""
    blocks = key_counts(sent, "cell", "part").select("cell", "part", F.ceil(F.col("n") / ask_rows).cast("int").alias("blocks"))
    asking = sent.join(F.broadcast(blocks), ["cell", "part"])  # at most one row for every part
    asking = asking.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.col("blocks")).cast("int")).drop("blocks")
    return asking, blocks.select("cell", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))


def _one_length(rows: DataFrame, size: int, queries: Column, k: int, dims: int, chance: float, cell_rows: int, part_rows: int,
                ask_rows: int, sample: int, seed: int) -> DataFrame:
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)).alias("longest")).first()
    projection, stop = Projection(size, math.sqrt(facts["longest"]), dims, seed), chi_square_point(dims, chance)
    levels = min(12, max(0, math.ceil(math.log2(max(1, facts["n"] / cell_rows)))))
    seen = rows.orderBy(F.xxhash64("vec_id", F.lit(seed))).limit(sample).select("vector").collect() if levels else []
    cuts = kd_split(projection.points(np.array([r["vector"] for r in seen])), levels) if levels else []

    def to_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(cell=kd_cell(projection.points(_stacked(batch["vector"], size)), cuts).astype(np.int32))

    celled = saved(rows.withColumn("query", F.coalesce(queries, F.lit(False)))
                   .mapInPandas(to_cells, "vec_id long, vector array<double>, query boolean, cell int"), "near-cells")
    parts = key_counts(celled, "cell").withColumn("parts", F.ceil(F.col("n") / part_rows).cast("int")).drop("n")  # at most 2**12 rows
    dealt = saved(celled.join(F.broadcast(parts), "cell").withColumn("part", F.pmod(spread("vec_id"), F.col("parts")).cast("int"))
                  .select("cell", "part", "vec_id", "query", "vector"), "near-points")

    def at_home(group: pd.DataFrame) -> pd.DataFrame:
        vectors, ids = _stacked(group["vector"], size), group["vec_id"].to_numpy(np.int64)
        asks = group["query"].to_numpy(bool)
        own = np.flatnonzero(asks)
        found_ids, scores = search(projection, vectors, ids, vectors[own], ids[own], np.full(len(own), -np.inf), k, stop)
        return _rows(ids[own], found_ids, scores)

    home = saved(dealt.groupBy("cell", "part").applyInPandas(at_home, FOUND), "near-home")
    kth = home.groupBy("query_id").agg(F.count(F.lit(1)).alias("have"), F.min("score").alias("bound"))
    asked = dealt.where("query").join(kth, F.col("vec_id") == F.col("query_id"), "left").select(
        F.col("cell").alias("own_cell"), F.col("part").alias("own_part"), "vec_id", "vector", F.when(F.col("have") >= k, F.col("bound")).otherwise(float("-inf")).alias("bound"))

    def box(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = projection.points(_stacked(batch["vector"], size))
            for key, rows_ in batch.groupby(["cell", "part"]).indices.items():
                yield pd.DataFrame({"cell": [key[0]], "part": [key[1]], "low": [points[rows_].min(axis=0)], "high": [points[rows_].max(axis=0)]})

    ends = [f(F.col(side)[i]).alias(f"{side}{i}") for side, f in (("low", F.min), ("high", F.max)) for i in range(dims)]
    boxes = dealt.select("cell", "part", "vector").mapInPandas(box, "cell int, part int, low array<double>, high array<double>") \
        .groupBy("cell", "part").agg(*ends).collect()  # one for every part of `part_rows` vectors
    places = np.array([(b["cell"], b["part"]) for b in boxes], dtype=np.int32).reshape(-1, 2)
    low = np.array([[b[f"low{i}"] for i in range(dims)] for b in boxes]).reshape(-1, dims)
    high = np.array([[b[f"high{i}"] for i in range(dims)] for b in boxes]).reshape(-1, dims)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            vectors, bound = _stacked(batch["vector"], size), batch["bound"].to_numpy(np.float64)
            farthest = np.where(np.isfinite(bound), (vectors ** 2).sum(axis=1) + projection.longest ** 2 - 2 * bound, np.inf)
            near = box_distance(projection.queries(vectors), low, high)
            goes = near <= (stop * np.maximum(farthest, 0) + 1e-12)[:, None]
            goes &= (batch["own_cell"].to_numpy()[:, None] != places[:, 0]) | (batch["own_part"].to_numpy()[:, None] != places[:, 1])
            q, to = np.nonzero(goes)
            if len(q):
                yield pd.DataFrame({"cell": places[to, 0], "part": places[to, 1], "vec_id": batch["vec_id"].to_numpy(np.int64)[q],
                                    "bound": bound[q], "vector": list(vectors[q])})

    sent = saved(asked.mapInPandas(send, "cell int, part int, vec_id long, bound double, vector array<double>"), "near-sent")

    def elsewhere(group: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        query_ids = asking["vec_id"].to_numpy(np.int64)
        if not len(asking) or not len(group):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        found_ids, scores = search(projection, _stacked(group["vector"], size), group["vec_id"].to_numpy(np.int64),
                                   _stacked(asking["vector"], size), query_ids, asking["bound"].to_numpy(np.float64), k, stop)
        return _rows(query_ids, found_ids, scores)

    asking, blocks = in_blocks(sent, ask_rows)
    asked_parts = dealt.select("cell", "part", "vec_id", "vector").join(F.broadcast(blocks), ["cell", "part"])  # a part for every block of its queries
    keys = ("cell", "part", "block")
    away = asked_parts.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInPandas(elsewhere, FOUND)
    return home.unionByName(away)


def nearest(vectors: DataFrame, queries: Column, k: int = 20, dims: int = 8, chance: float = 0.98, cell_rows: int = 8192,
            part_rows: int = 32768, ask_rows: int = 32768, sample: int = 32768, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` vectors with the largest inner product found for each query, nearest
    first, ties to the smaller id. `queries` is a condition on `vec_id` and picks the queries among the vectors.

    Rows without id, and vectors that are null, zero, or hold null or non-finite components, take no part. Vectors are
    compared with those of their own length. Rows with the query's id are never its neighbours; a repeated id is a
    neighbour once for each distinct vector. A task gets about `part_rows` vectors and `ask_rows` queries. The tree is cut on a sample of `sample` vectors; every vector is indexed.
    """
    vector = F.col(vector_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(vector, lambda x: x.cast("double")).alias("vector")) \
        .where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    rows = saved(rows.dropDuplicates(["vec_id", "vector"]), "near-vectors")
    sizes = [r["size"] for r in rows.select(F.size("vector").alias("size")).distinct().collect()]  # lengths, not vectors
    found = None
    for size in sorted(sizes):
        one = _one_length(rows.where(F.size("vector") == size), size, queries, k, dims, chance, cell_rows, part_rows, ask_rows, sample, seed)
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], FOUND)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
