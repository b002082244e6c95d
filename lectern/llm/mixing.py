"""Mixing sources to target weights by capped water-filling, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from lectern.llm.shared import materialize, word_count

#: Sub-buckets of a source, by leading byte of the seeded hash; one of them is taken in part.
BUCKETS = 256


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """Target words for each source from (source, source_size), one row a source.

    Sources in code point order, null last, get `weights` in turn and share the sum of all sizes.
    A source whose share passes `max_epochs` times its size is clamped there and what is over goes to
    the others by weight. With the sources ordered by clamp per weight, a source is clamped exactly if
    its share of what the clamped ones before it leave is above its own clamp, so one ordered pass
    over the per-source table finds the fixed point.
    """
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((turn - 1) % len(weights) + 1).cast("int"))
    by_room = W.orderBy((F.col("clamp") / F.col("weight")), F.col("source").asc_nulls_last())
    before, rest = by_room.rowsBetween(W.unboundedPreceding, -1), by_room.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy()
    clamped = F.col("clamped")
    return (
        sizes.withColumn("weight", weight.cast("long"))
        .withColumn("clamp", F.col("source_size") * max_epochs)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("clamp").over(before), F.lit(0)))
        .withColumn("clamped", F.col("left") * F.col("weight") > F.col("clamp") * F.sum("weight").over(rest))
        .withColumn("free", F.col("total") - F.sum(F.when(clamped, F.col("clamp")).otherwise(0)).over(everything))
        .withColumn("free_weight", F.sum(F.when(clamped, 0).otherwise(F.col("weight"))).over(everything))
        .select(
            "source",
            "source_size",
            F.when(clamped, F.col("clamp").cast("double"))
            .otherwise((F.col("free") * F.col("weight")).cast("double") / F.col("free_weight").cast("double"))
            .alias("target"),
        )
    )


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: str = "mix"
) -> DataFrame:
    """Words that a weighted mix takes from each document: (doc_id, source, size, source_size, target, taken).

    Reads doc_id, source and text; other columns don't matter. Every document is taken the whole number
    of times that its source's target holds the source, and a seeded part of the documents once more:
    by md5 of seed and doc_id a source falls into 256 sub-buckets, those below the remaining budget are
    taken once more, and in the one that the budget ends in each document gives the same fraction.
    The words taken of a source miss its target by less than the documents of one sub-bucket.

    Only the per-(source, sub-bucket) sums are windowed, so a source with most rows is no hot group.
    Null text: size 0. Null source: a source of its own, last in order. Null doc_id: hashed as ''.
    Rows with equal doc_id fall into one sub-bucket. Empty input: no rows.
    """
    digest = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 2)
    sized = materialize(
        docs.select(
            "doc_id",
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"),
            F.conv(digest, 16, 10).cast("int").alias("bucket"),
        ),
        "mix-sizes",
    )
    parts = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    sizes = parts.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    t = source_targets(sizes, weights, max_epochs).withColumnRenamed("source", "t_source")
    running = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = (
        parts.withColumn("below", F.coalesce(F.sum("bucket_size").over(running), F.lit(0)))
        .join(t, F.col("source").eqNullSafe(F.col("t_source")))
        .withColumn("whole", whole)
        .withColumn("extra", F.round(F.col("target")).cast("long") - F.col("whole") * F.col("source_size") - F.col("below"))
        .select(
            F.col("source").alias("p_source"),
            F.col("bucket").alias("p_bucket"),
            "bucket_size",
            "source_size",
            "target",
            "whole",
            F.least(F.greatest(F.col("extra"), F.lit(0)), F.col("bucket_size")).alias("extra"),
        )
    )
    more = F.when(F.col("bucket_size") > 0, F.expr("(size * extra) div bucket_size")).otherwise(0)
    return sized.join(
        plan, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("bucket") == F.col("p_bucket"))
    ).select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("whole") + more).alias("taken"))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 2))::INT AS bucket
  FROM {docs}),
parts AS (SELECT source, bucket, sum(size)::BIGINT AS bucket_size FROM sized GROUP BY source, bucket),
ranked AS (
  SELECT source, sum(bucket_size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight
  FROM parts GROUP BY source),
room AS (
  SELECT *, source_size * 3 AS clamp, sum(source_size) OVER () AS total FROM ranked),
filled AS (
  SELECT *, (total - coalesce(sum(clamp) OVER (ORDER BY clamp / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight
     > clamp * sum(weight) OVER (ORDER BY clamp / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS clamped
  FROM room),
goal AS (
  SELECT source, source_size, CASE WHEN clamped THEN clamp::DOUBLE
    ELSE ((total - sum(CASE WHEN clamped THEN clamp ELSE 0 END) OVER ()) * weight)::DOUBLE
         / (sum(CASE WHEN clamped THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
  FROM filled),
steps AS (
  SELECT p.source, p.bucket, p.bucket_size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 0 END::BIGINT AS whole,
         coalesce(sum(p.bucket_size) OVER (PARTITION BY p.source ORDER BY p.bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS below
  FROM parts p JOIN goal g ON p.source IS NOT DISTINCT FROM g.source),
plan AS (
  SELECT *, least(greatest(round(target)::BIGINT - whole * source_size - below, 0), bucket_size)::BIGINT AS extra FROM steps)
SELECT s.doc_id, s.source, s.size, p.source_size, p.target,
       (s.size * p.whole + CASE WHEN p.bucket_size > 0 THEN (s.size * p.extra) // p.bucket_size ELSE 0 END)::BIGINT AS taken
FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source AND s.bucket = p.bucket
"""
