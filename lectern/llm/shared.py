"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.tables import drop, kept as materialize, new_path, shared_dir

__all__ = ["WORD", "drop", "join_hot", "materialize", "new_path", "read", "salted", "shared_dir", "word_count"]

#: A word is a run of bytes that are neither blank nor one of the five ASCII line and tab controls.
WORD = r"[^\x20\x09-\x0D]+"
#: Keys that are broadcast as hot ones, at most.
HOT_KEYS = 4096


def join_hot(rows: DataFrame, table: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """Inner join of `rows` with `table` (one row a key), in which `number` says how many rows have the key.

    Keys with a share of 1 / HOT_KEYS of these rows or more are HOT_KEYS at most, whatever the input: they
    are broadcast, so that their rows stay where they are. All others meet by a shuffle, in which no key is
    large. Both inputs are read twice and should be written tables.
    """
    total = table.agg(F.coalesce(F.sum(number), F.lit(0))).first()[0]
    least = max(1000, -(-total // HOT_KEYS))
    many = table.filter(F.col(number) >= least)
    if not many.limit(1).count():
        return rows.join(table.drop(number), list(keys))
    names = [F.col(k).alias(f"_hot_{k}") for k in keys]
    same = [F.col(k) == F.col(f"_hot_{k}") for k in keys]
    hot = F.broadcast(many.select(*names))
    rest = rows.join(hot, same, "left_anti").join(table.filter(F.col(number) < least).drop(number), list(keys))
    return rest.unionByName(rows.join(F.broadcast(many.drop(number)), list(keys)))


def salted(rows: DataFrame, table: DataFrame, key: str, by: str) -> tuple[DataFrame, DataFrame]:
    """Both with a column salt, to be joined on key and salt: for rows with a key of `table` that very many of them have.

    Such a key's rows, dealt by the column `by`, get as many salts as they are shares of 1 / HOT_KEYS, and its
    row in `table` is repeated as often: at most 2 * HOT_KEYS rows more in all, however wide they are. `rows` is
    read three times and should be a written table.
    """
    least = max(1000, -(-rows.count() // HOT_KEYS))
    hot = rows.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_n")).filter(F.col("_n") >= least)
    hot = F.broadcast(materialize(hot.select("_hot", F.ceil(F.col("_n") / least).cast("int").alias("_salts")), "hot-keys"))  # HOT_KEYS rows at most
    salt = F.coalesce(F.pmod(F.xxhash64(by), F.col("_salts")), F.lit(0)).cast("int").alias("salt")
    dealt = rows.join(hot, F.col(key) == F.col("_hot"), "left").select(*rows.columns, salt)
    salts = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)).alias("salt")
    return dealt, table.join(hot, F.col(key) == F.col("_hot"), "left").select(*table.columns, salts)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
