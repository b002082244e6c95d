"""Hard negatives: for each anchor and positive the best rows of other labels in a window below the positive's score."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from lectern.llm.shared import materialize

#: Rows that one task holds at once at most; anchors and rows whose scores are computed in one step.
SHARD, ANCHORS, ROWS = 1 << 16, 128, 4096


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part, one for each vec_id: the smallest label's, then the smallest vector."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine & (F.size("embedding") > 0), F.lit(False)))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("row")).select("vec_id", "row.*")


def _matrix(lists: pa.Array, scale: float) -> np.ndarray:
    values = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
    return np.floor(values * scale)


def _met(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Of a stream in which a shard's rows come before its anchors: (ids, labels, vectors) of the shard, by label and id, with some anchors."""
    parts: list[pa.RecordBatch] = []
    shard, open_, held = None, False, None
    for batch in batches:
        where, asked = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = np.flatnonzero(np.diff(where * 2 + asked)) + 1 if len(batch) else np.zeros(0, np.int64)
        for a, b in zip([0, *edges], [*edges, len(batch)], strict=True):
            if a == b:
                continue
            if where[a] != shard:
                parts, shard, open_ = [], where[a], False
            part = batch.slice(a, b - a)
            if not asked[a]:
                parts.append(part)
            elif parts:
                if not open_:
                    ids, labels = (np.concatenate([p.column(c).to_numpy() for p in parts]) for c in (2, 3))
                    order = np.lexsort((ids, labels))
                    held = ids[order], labels[order], np.concatenate([_matrix(p.column(4), scale) for p in parts])[order]
                    open_ = True
                yield *held, part


def _best(groups: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each group: greatest score, then smallest id."""
    order = np.lexsort((ids, -scores, groups))
    sorted_ = groups[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(order) else np.zeros(0, np.int64)
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.concatenate([first, [len(order)]])))
    return order[rank < k]


class _Kept:
    """The k best candidates of each group so far, from several steps; what can't be among them any more is told by `least`."""

    def __init__(self, groups: int, k: int):
        self.k, self.least = k, np.full(groups, -np.inf)
        self.group, self.score, self.id = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        some = score >= self.least[group]
        group, score, ids = (np.concatenate([old, new[some]]) for old, new in ((self.group, group), (self.score, score), (self.id, ids)))
        keep = _best(group, score, ids, self.k)
        self.group, self.score, self.id = group[keep], score[keep], ids[keep]
        full = np.flatnonzero(np.bincount(self.group, minlength=len(self.least)) == self.k)
        lowest = np.full(len(self.least), np.inf)
        np.minimum.at(lowest, self.group, self.score)
        self.least[full] = lowest[full]


def _steps(labels: np.ndarray) -> Iterator[slice]:
    for at in range(0, len(labels), ROWS):
        yield slice(at, min(at + ROWS, len(labels)))


def _same_label(scale: float, k: int) -> Callable:
    """Each anchor's k best other rows of its label in each shard: (anchor_id, vec_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, vectors, anchors in _met(batches, scale):
            own_ids, own_labels = (anchors.column(c).to_numpy() for c in (2, 3))
            for label in np.unique(own_labels):
                low, high = np.searchsorted(labels, [label, label + 1])
                mine = np.flatnonzero(own_labels == label)
                for at in range(0, len(mine), ANCHORS):
                    some = mine[at : at + ANCHORS]
                    asked, kept = _matrix(anchors.column(4).take(pa.array(some)), scale), _Kept(len(some), k)
                    for rows in _steps(labels[low:high]):
                        rows = slice(low + rows.start, low + rows.stop)
                        scores = asked @ vectors[rows].T
                        fits = (scores >= kept.least[:, None]) & (ids[rows] != own_ids[some][:, None])
                        r, c = np.nonzero(fits)
                        kept.add(r, scores[r, c], ids[rows][c])
                    columns = [own_ids[some][kept.group], kept.id, kept.score.astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor_id", "vec_id", "score"])

    return run


def _other_labels(scale: float, k: int, least: int, most: int) -> Callable:
    """Each anchor's k best rows of other labels in each of its slots and each shard: (anchor_id, slot, vec_id, score).

    limits: an anchor's upper limits, falling. Slot i is what is over limit i + 1 and up to limit i, so slots are disjoint
    and a row falls in one at most; what even the window of its own slot's limit leaves out is no candidate of any.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, vectors, anchors in _met(batches, scale):
            for at in range(0, len(anchors), ANCHORS):
                some = anchors.slice(at, ANCHORS)
                own_ids, own_labels = (some.column(c).to_numpy() for c in (2, 3))
                lists = some.column(5)
                count = lists.value_lengths().to_numpy()
                width = int(count.max())
                limits = np.full((len(some), width), -np.inf)
                limits[np.arange(width) < count[:, None]] = lists.flatten().to_numpy()
                lowest = limits[np.arange(len(some)), count - 1]
                asked, kept = _matrix(some.column(4), scale), _Kept(len(some) * width, k)
                for rows in _steps(labels):
                    scores = asked @ vectors[rows].T
                    fits = (most * scores <= most * limits[:, :1]) & (most * scores >= least * lowest[:, None]) & (labels[rows] != own_labels[:, None])
                    r, c = np.nonzero(fits)
                    score = scores[r, c]
                    slot = (limits[r] >= score[:, None]).sum(1) - 1
                    inside = most * score >= least * limits[r, slot]
                    kept.add((r * width + slot)[inside], score[inside], ids[rows][c][inside])
                columns = [own_ids[kept.group // width], (kept.group % width).astype(np.int32), kept.id, kept.score.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor_id", "slot", "vec_id", "score"])

    return run


def _first(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best of each group by score, then id; limited in every task before the shuffle as well."""
    best = W.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= k).drop("_rank")


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100, scale: float = 256.0) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of each anchor's positives and their negatives.

    Reads vec_id, label and embedding. Every component x counts as floor(scale * x); a score is the inner product with
    the anchor, exact in whole numbers; greater scores come first, ties by smaller vec_id. Anchors are the rows whose
    vec_id is divisible by `every`, their positives the first `positives` other rows of their label. For each
    positive come the first `negatives` rows of other labels with least * positive_score <= most * score <= most * positive_score.

    The anchors are a stated query set: they are sent to shards of at most 65,536 rows that stay in
    one task each, and are scored there in steps of 128 anchors with 4096 rows. First the positives; their distinct scores are
    an anchor's upper limits, which cut the scores into disjoint slots. Then each shard gives the best rows of every slot,
    the best of all shards are taken slot by slot, and a positive's answer is the merge of the slots from its own one
    down, cut at its lower limit: overlapping windows are never scanned twice. No label or hot vector makes a group of its own.

    Rows with null vec_id or label, a null or empty vector, a null or non-finite component, or another length than
    the commonest (ties: the shorter) take no part; zero vectors do. Of rows of one vec_id the one of smallest label, then
    smallest vector counts. Fewer positives or negatives: all. No anchors or no rows: no rows. Other columns aren't read.
    Scores are exact below 2**53; vectors whose scores could go beyond are an error, and ask for a smaller `scale`.
    """
    spark = vectors.sparkSession
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = materialize(usable(vectors), "negatives-rows")
    common = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("embedding", F.abs))).alias("top")).orderBy(F.desc("n"), "d").first()
    if common is None:
        return spark.createDataFrame([], empty)
    width, n = common["d"], common["n"]
    if width * (common["top"] * scale + 1) ** 2 >= 2.0**53:
        raise ValueError("scores of 2**53 or more; choose a smaller scale")
    rows = rows.filter(F.size("embedding") == width)
    shards = max(math.ceil(n / SHARD), min(n, 2 * spark.sparkContext.defaultParallelism))
    here = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard")
    no_limits = F.lit(None).cast("array<long>").alias("limits")
    stay = rows.select(here, F.lit(0).alias("asked"), "vec_id", "label", "embedding", no_limits)
    anchors = rows.filter(F.col("vec_id") % every == 0)

    def met(asked: DataFrame) -> DataFrame:
        """Every shard's rows and behind them the anchors; shards have a task each."""
        everywhere = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("asked"), "vec_id", "label", "embedding", "limits")
        return stay.unionByName(everywhere).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "asked")

    near = met(anchors.select("*", no_limits)).mapInArrow(_same_label(scale, positives), "anchor_id long, vec_id long, score long")
    of_anchor = _first(near, ["anchor_id"], positives).groupBy("anchor_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("positives"))
    of_anchor = materialize(of_anchor, "negatives-positives")
    upper = F.reverse(F.array_sort(F.array_distinct(F.col("positives.score")))).alias("limits")
    limited = anchors.join(of_anchor.select(F.col("anchor_id").alias("vec_id"), upper), "vec_id")
    far = met(limited).mapInArrow(_other_labels(scale, negatives, least, most), "anchor_id long, slot int, vec_id long, score long")
    slots = _first(far, ["anchor_id", "slot"], negatives).groupBy("anchor_id")
    # Slots hold falling scores, so in order of score an anchor's kept rows are its slots, one behind the other.
    ordered = slots.agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id"))).alias("kept"))
    each = of_anchor.select("anchor_id", F.explode("positives").alias("p")).join(ordered, "anchor_id")
    from_own_slot = F.filter("kept", lambda x: (-x["down"] <= F.col("p.score")) & (-most * x["down"] >= least * F.col("p.score")))
    found = each.select("anchor_id", "p", F.posexplode(F.slice(from_own_slot, 1, negatives)).alias("at", "x"))
    return found.select(
        "anchor_id", F.col("p.vec_id").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), (-F.col("x.down")).alias("negative_score"),
    )


#: The tables' labels disagree for each vec_id divisible by 7, and components are 256ths.
ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank,
    s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
