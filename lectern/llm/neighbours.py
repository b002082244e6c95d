"""Approximate nearest neighbours by low-dimensional stable projections in a kd-tree."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from lectern.llm.shared import join_hot, materialize

#: Gaussian (2-stable) projections, probability of the stopping test, points of a leaf and of a shard at most.
PROJECTIONS, STOP, LEAF, SHARD = 16, 0.88, 32, 4096
#: Vectors that the upper tree is fitted on, levels of it at most, queries that meet a shard at once.
SAMPLE, DEPTH, QUERIES = 8192, 12, 256


def chi_square_quantile(p: float, even: int) -> float:
    """x with P(chi-square with `even` degrees of freedom <= x) = p."""

    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(even // 2))

    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


def kd_split(points: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """(axis, value) of every inner node of a kd-tree of `depth` levels in heap order, split at medians of the widest axis."""
    nodes, level = [], [points]
    for _ in range(depth):
        after = []
        for own in level:
            axis = int(np.argmax(own.max(0) - own.min(0))) if len(own) else 0
            value = float(np.median(own[:, axis])) if len(own) else 0.0
            nodes.append((axis, value))
            after += [own[own[:, axis] <= value], own[own[:, axis] > value]]
        level = after
    return nodes


def kd_cell(points: np.ndarray, nodes: list[tuple[int, float]], depth: int) -> np.ndarray:
    at = np.zeros(len(points), np.int64)
    if nodes:
        axes, values = np.array([a for a, _ in nodes]), np.array([v for _, v in nodes])
        for _ in range(depth):
            at = 2 * at + 1 + (points[np.arange(len(points)), axes[at]] > values[at])
    return at - ((1 << depth) - 1)


@dataclass
class Leaves:
    """A shard's kd-tree: its points in leaf order, and the boxes of the leaves."""

    ids: np.ndarray
    vectors: np.ndarray
    points: np.ndarray
    edges: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray) -> Leaves:
        order, todo, parts = [], [np.arange(len(ids))], []
        while todo:
            own = todo.pop()
            if len(own) <= LEAF:
                parts.append(own)
                continue
            axis = int(np.argmax(points[own].max(0) - points[own].min(0)))
            own = own[np.argsort(points[own, axis], kind="stable")]
            todo += [own[: len(own) // 2], own[len(own) // 2 :]]
        order = np.concatenate(parts)
        edges = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        low, high = (f.reduceat(points[order], edges[:-1]) for f in (np.minimum, np.maximum))
        return cls(ids[order], vectors[order], points[order], edges, low, high)

    def gaps(self, point: np.ndarray) -> np.ndarray:
        """Squared projected distance to every leaf's box."""
        return (np.maximum(np.maximum(self.low - point, point - self.high), 0) ** 2).sum(1)

    def search(self, vector: np.ndarray, point: np.ndarray, k: int, reach: float, test: float) -> tuple[np.ndarray, np.ndarray, int]:
        """The k nearest here, their distances, and how many vectors were compared in full.

        reach: the k-th distance known so far. Leaves are taken by projected distance, their points too, and
        compared in full one after another until the next one's squared projected distance is over `test`
        times the squared reach: a nearer vector than the k-th lies so far off with probability 1 - STOP only.
        """
        gaps = self.gaps(point)
        order = np.argsort(gaps, kind="stable")
        ids, distances, at, step, seen = np.zeros(0, np.int64), np.zeros(0), 0, 2, 0
        while at < len(order) and gaps[order[at]] <= test * reach * reach:
            rows = np.concatenate([np.arange(self.edges[x], self.edges[x + 1]) for x in order[at : at + step]])
            far = ((self.points[rows] - point) ** 2).sum(1)
            by = np.argsort(far, kind="stable")
            rows, far, done = rows[by], far[by], 0
            while done < len(rows) and far[done] <= test * reach * reach:
                some = rows[done : min(done + LEAF, int(np.searchsorted(far, test * reach * reach, "right")))]
                done, seen = done + len(some), seen + len(some)
                ids = np.concatenate([ids, self.ids[some]])
                distances = np.concatenate([distances, np.sqrt(((self.vectors[some] - vector) ** 2).sum(1))])
                best = np.lexsort((ids, distances))[:k]
                ids, distances = ids[best], distances[best]
                if len(ids) == k:
                    reach = min(reach, np.nextafter(distances[-1], np.inf))
            at, step = at + step, 2 * step
        return ids, distances, seen


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _top(answers: DataFrame, key: str, near: str, k: int) -> DataFrame:
    best = W.partitionBy(key).orderBy("score", near)
    return answers.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).drop("rank")


def _searched(axes: np.ndarray, width: int, k: int, test: float):
    """Of rows (queries, a shard's tree): the k nearest there of each query, (point, near, score)."""
    kinds = (np.int64, np.float64, np.int64, np.float64, np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                queries = batch.column(0)[r].values
                own, vectors, edges, low, high = (np.frombuffer(batch.column(c)[r].as_buffer(), t) for c, t in enumerate(kinds, 1))
                vectors = vectors.reshape(-1, width)
                leaves = Leaves(own, vectors, vectors @ axes, edges, low.reshape(-1, PROJECTIONS), high.reshape(-1, PROJECTIONS))
                asked, reach = _matrix(queries.field("embedding")), queries.field("reach").to_numpy()
                out: list[list] = [[], [], []]
                for q, vector, point, far in zip(queries.field("point").to_pylist(), asked, asked @ axes, reach, strict=True):
                    found, distances, _ = leaves.search(vector, point, k, far, test)
                    out[0] += [q] * len(found)
                    out[1] += found.tolist()
                    out[2] += distances.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], ["point", "near", "score"])

    return run


def nearest(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """The k nearest other vectors of each query: (query_id, rank, vec_id, score), score the Euclidean distance.

    Reads vec_id and embedding. Queries are the vectors whose vec_id is divisible by `every`. Equal vectors are
    one point, which keeps the k + 1 smallest ids of them: no other one can be an answer. Sixteen Gaussian
    projections keep squared distances up to a chi-square factor. The projected points are dealt to cells of a
    kd-tree that a sample of 8192 was fitted for, cells to shards of some 4096 points, each with a kd-tree of its
    own. A query first meets one shard of its own cell, which gives a reach, then all shards of
    the cells whose boxes pass the chi-square test at that reach; both are joins by cell, of some 256 queries with a
    shard at a time. In a shard projected neighbours are taken one after another and compared in
    double precision, until the chi-square test at 0.88 says that no nearer one is to be expected. Every vector
    is indexed.

    Null ids and vectors that are null, zero, of another than the commonest length (ties: the shorter), or hold null or
    non-finite components take no part; of rows of one vec_id the smallest vector counts. Ties go to the smaller vec_id.
    Fewer than k others: all. No vector or no query: no rows.
    """
    spark = vectors.sparkSession
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    usable = usable.filter(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    usable = materialize(usable, "near-vectors")
    common = usable.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = common["d"]
    usable = usable.filter(F.size("embedding") == width)
    turn = F.row_number().over(W.partitionBy("embedding").orderBy("vec_id"))
    few = usable.withColumn("turn", turn).filter(F.col("turn") <= k + 1)  # limited before the shuffle as well
    points = few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    points = materialize(points.select(F.get("ids", F.lit(0)).alias("point"), "ids", "embedding"), "near-points")

    axes = np.random.default_rng(61).standard_normal((width, PROJECTIONS))
    depth = min(DEPTH, max(0, math.ceil(math.log2(max(1, points.count() / (SHARD // 2))))))
    sample = _matrix(points.orderBy(F.xxhash64("point")).limit(SAMPLE).select("embedding").toArrow()["embedding"]) @ axes
    nodes, test = kd_split(sample, depth), chi_square_quantile(STOP, PROJECTIONS)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = kd_cell(_matrix(batch.column(1)) @ axes, nodes, depth) if len(batch) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["point", "embedding", "cell"])

    def pack(table: pa.Table) -> pa.Table:
        own = _matrix(table["embedding"])
        leaves = Leaves.build(table["point"].to_numpy(), own, own @ axes)
        parts = [leaves.ids, leaves.vectors, leaves.edges.astype(np.int64), leaves.low, leaves.high]
        boxes = {"box_low": pa.array([leaves.low.min(0)]), "box_high": pa.array([leaves.high.max(0)])}
        return pa.table({"cell": table["cell"][:1], "shard": table["shard"][:1], **boxes, **{f"p{i}": pa.array([p.tobytes()], pa.binary()) for i, p in enumerate(parts)}})

    def parts_of(dealt: DataFrame, size: int, name: str) -> DataFrame:
        """`dealt` with a number below the cell's rows / size; a row a cell is broadcast, 4096 at most."""
        number = dealt.groupBy("cell").agg(F.ceil(F.count("*") / size).alias("_parts"))
        return dealt.join(F.broadcast(number), "cell").withColumn(name, F.pmod(F.xxhash64("point"), F.col("_parts"))).drop("_parts")

    dealt = points.select("point", "embedding").mapInArrow(deal, "point long, embedding array<double>, cell long")
    shards = parts_of(dealt, SHARD, "shard").groupBy("cell", "shard").applyInArrow(
        pack, "cell long, shard long, box_low array<double>, box_high array<double>, p0 binary, p1 binary, p2 binary, p3 binary, p4 binary"
    )
    shards = materialize(shards, "near-shards")
    sides = [f(F.col(c)[i]).alias(f"{c}{i}") for f, c in ((F.min, "box_low"), (F.max, "box_high")) for i in range(PROJECTIONS)]
    boxes = shards.groupBy("cell").agg(*sides).toArrow()  # a row a cell
    cells, box = boxes["cell"].to_numpy(), np.stack([c.to_numpy() for c in boxes.columns[1:]], 1).reshape(-1, 2, PROJECTIONS)

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query with the cells that its reach may go to."""
        for batch in batches:
            reach, own = batch.column(2).to_numpy(), _matrix(batch.column(1)) @ axes if len(batch) else np.zeros((0, PROJECTIONS))
            near = [np.flatnonzero((np.maximum(np.maximum(box[:, 0] - p, p - box[:, 1]), 0) ** 2).sum(1) <= test * r * r) for p, r in zip(own, reach, strict=True)]
            rows = pa.array(np.repeat(np.arange(len(batch)), [len(x) for x in near]))
            yield pa.RecordBatch.from_arrays([*batch.take(rows).columns, pa.array(cells[np.concatenate([np.zeros(0, np.int64), *near])])], ["point", "embedding", "reach", "cell"])

    def answers(queries: DataFrame, where: DataFrame) -> DataFrame:
        """The k + 1 nearest points of each query (point, embedding, reach, cell) in each of its cells' shards."""
        blocks = parts_of(queries, QUERIES, "block").groupBy("cell", "block").agg(F.collect_list(F.struct("point", "embedding", "reach")).alias("queries"))
        met = blocks.join(where, "cell").select("queries", *[f"p{i}" for i in range(5)])
        return met.mapInArrow(_searched(axes, width, k + 1, test), "point long, near long, score double")

    asked = materialize(usable.filter(F.col("vec_id") % every == 0), "near-asked")
    of_query = asked.groupBy("embedding").agg(F.count("*").alias("n")).join(points.select("embedding", "point"), "embedding")
    of_query = materialize(of_query, "near-queries")  # equal queries are one
    at_home = of_query.select("point", "embedding").mapInArrow(deal, "point long, embedding array<double>, cell long")
    found = answers(materialize(at_home, "near-home").withColumn("reach", F.lit(float("inf"))), shards.filter("shard = 0"))
    found = materialize(found, "near-found")
    known = found.groupBy("point").agg(F.count("*").alias("n"), F.max("score").alias("reach")).filter(F.col("n") > k).select("point", "reach")
    further = of_query.select("point", "embedding").join(known, "point", "left").select("point", "embedding", F.coalesce("reach", F.lit(float("inf"))).alias("reach"))
    further = materialize(further.mapInArrow(reached, "point long, embedding array<double>, reach double, cell long"), "near-further")
    best = _top(found.union(answers(further, shards)).dropDuplicates(["point", "near"]), "point", "near", k + 1)
    best = best.join(points.select(F.col("point").alias("near"), "ids"), "near").select("point", F.explode("ids").alias("vec_id"), "score")
    best = _top(best, "point", "vec_id", k + 1).groupBy("point").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("best"))
    best = materialize(of_query.join(best, "point").select("embedding", "best", "n"), "near-best")
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    ranked = join_hot(asked.withColumnRenamed("vec_id", "query_id"), best, ["embedding"], "n").select("query_id", F.posexplode(others).alias("at", "b"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "b.vec_id", "b.score")
