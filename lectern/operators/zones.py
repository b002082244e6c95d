"""Wall clock times of a zone as instants, the doubled hour told apart by the order of a file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

#: By how many minutes clocks are set back, the usual change first.
CHANGES = (60, 30, 120, 20)


def earlier(wall: Column, zone: str) -> Column:
    """The instant of a wall clock time; of two the earlier, and for a time that the clocks skip the one by the offset before the change."""
    return F.to_utc_timestamp(wall, zone)


def set_back(wall: Column, zone: str) -> Column:
    """By how many minutes the clocks were set back over this time, so that it came twice; null if it came once."""
    first = earlier(wall, zone)
    again = lambda m: F.from_utc_timestamp(first + F.make_dt_interval(mins=F.lit(m)), zone) == wall
    minutes = F.lit(None).cast("int")
    for m in reversed(CHANGES):
        minutes = F.when(again(m), m).otherwise(minutes)
    return minutes


def in_zone(rows: DataFrame, zone: str, time: str, file: Sequence[str], order: str) -> DataFrame:
    """`rows` with the column `time`, a wall clock time of `zone` kept as if it were UTC, made the instant that it means.

    In the hour that comes twice a year a time is of the first pass until, in the file's order, times jump back; the
    rest of the hour is of the second pass. A file whose last time is before its first counts from its end. Without a jump all are of the first pass.
    Times that the clocks skip count by the offset before the change. Only rows of doubled hours are
    ordered, an hour of one file at a time; all others are translated where they are. Ties of `order` are the caller's to break.
    """
    keys = list(file)
    doubled = rows.filter(set_back(F.col(time), zone).isNotNull()).select(*keys, F.col(order).alias("_order"), F.col(time).alias("_wall"), F.date_trunc("day", time).alias("_day"))
    timed = F.when(F.col(time).isNotNull(), F.struct(order, time))
    ends = rows.groupBy(*keys).agg(F.min(timed)[time].alias("_first"), F.max(timed)[time].alias("_last"))
    ends = ends.select(*[F.col(k).alias(f"_{k}") for k in keys], (F.col("_last") < F.col("_first")).alias("_falls"))
    own = doubled.join(ends, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]).withColumn("_turn", F.when(F.col("_falls"), -F.col("_order")).otherwise(F.col("_order")))
    hour = W.partitionBy(*keys, "_day").orderBy("_turn")
    jump = own.withColumn("_jump", (F.col("_wall") < F.lag("_wall").over(hour)).cast("int"))
    second = jump.withColumn("_jumps", F.sum(F.coalesce("_jump", F.lit(0))).over(hour.rowsBetween(W.unboundedPreceding, 0))).filter("_jumps > 0")
    second = second.select(*[F.col(k).alias(f"_{k}") for k in keys], "_order").distinct()
    found = rows.join(second, [*[F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.col(order) == F.col("_order")], "left")
    late = F.when(F.col("_order").isNotNull(), F.make_dt_interval(mins=set_back(F.col(time), zone)))
    instant = earlier(F.col(time), zone)
    return found.withColumn(time, F.coalesce(instant + late, instant)).select(*rows.columns)
