"""Operators on keys: latest and first rows, bounds, inserts of what is new, upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in `order`; ties are the caller's to break."""
    n = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_n", n).filter("_n = 1").drop("_n")


def latest(df: DataFrame, keys: Sequence[str], time: str, tie: Sequence[str] = ()) -> DataFrame:
    """The row of each key with the greatest time; ties by the other columns, ascending."""
    return one_per_key(df, keys, [F.col(time).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tie]])


def bounds(df: DataFrame, keys: Sequence[str], time: str, low: str = "first_at", high: str = "last_at") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(time).alias(low), F.max(time).alias(high))


def only_new(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `new` whose key isn't in `existing`. Rows with a null key are new."""
    return new.join(existing.select(*keys).distinct(), list(keys), "left_anti").select(*new.columns)


def insert_absent(new: DataFrame, existing: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """What an insert adds to `existing`: of each new key its first row in `order`."""
    return only_new(one_per_key(new, keys, order), existing, keys)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], loaded: str, tie: Sequence[str] = ()) -> DataFrame:
    """Both tables by key, the newest load winning."""
    return latest(old.unionByName(new), keys, loaded, tie)


def lookup_last(left: DataFrame, right: DataFrame, key: str, value: str, position: str) -> DataFrame:
    """`left` with the value of the last row of `right` that has its key, the value first; unmatched rows get null."""
    last = right.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.max_by(value, position).alias("_v"))
    return left.join(last, left[key] == F.col("_k"), "left").select(F.col("_v").alias(value), *[left[c] for c in left.columns])


def dedup_rows(df: DataFrame, fields: Sequence[str], source: str | None = None, position: Sequence[str] = ()) -> DataFrame:
    """Rows distinct by their fields trimmed, within one source if named; the first in `position` stays."""
    from lectern.functions.text import row_fingerprint

    keyed = df.withColumn("row_key", row_fingerprint([F.col(f) for f in fields]))
    keys = ["row_key"] + ([source] if source else [])
    return one_per_key(keyed, keys, [F.col(p).asc_nulls_last() for p in position]) if position else keyed.dropDuplicates(keys)


def require_one_period(df: DataFrame, columns: Sequence[str] = ("ay", "term")) -> DataFrame:
    """`df` as it is; raises MixedPeriods if it holds more than one period."""
    found = df.select(*columns).filter(F.col(columns[0]).isNotNull()).distinct().limit(2).collect()
    if len(found) > 1:
        raise MixedPeriods(f"more than one period: {[tuple(r) for r in found]}")
    return df


class MixedPeriods(ValueError):
    """Events of one run belong to one academic period."""
