"""Token counts as delta-maintained rollups by source, language and tokenizer version."""

from __future__ import annotations

import base64
import json
import uuid
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lectern.llm.shared import materialize as kept

#: The public vocabulary's file and its split pattern.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEYS, COUNTS = ["source", "lang", "tokenizer"], ["n_docs", "n_tokens"]


@lru_cache(2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def count_tokens(df: DataFrame, columns: list[str], path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Replace each of the text `columns` by its number of tokens (null: 0) under the name <column>_tokens."""
    rest = [c for c in df.columns if c not in columns]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(path, pattern).encode_ordinary
        for batch in batches:
            sizes = [pa.array([len(encode(t)) if t else 0 for t in (x.as_py() for x in batch.column(c))], pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + sizes, rest + [f"{c}_tokens" for c in columns])

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name in rest]
    return df.select(*rest, *columns).mapInArrow(count, ", ".join(fields + [f"{c}_tokens long" for c in columns]))


def token_deltas(changes: DataFrame, tokenizer: str = "byte_bpe_50k", path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """What a batch of changes adds to the totals: (source, lang, tokenizer, n_docs, n_tokens), signed.

    Reads kind, source, lang, text and old_text. kind insert counts text, delete takes the count of text
    away, revise adds the count of text less that of old_text; any other or null kind changes nothing.
    Null text counts 0. Null source or lang is a group of its own. Repeated rows count each time; there is no
    order, so no ties. A very long text is encoded whole. Other columns aren't read. Empty input: no rows.
    """
    counted = count_tokens(
        changes.select("kind", "source", "lang", F.col("text").cast("string").alias("text"), F.col("old_text").cast("string").alias("old_text")),
        ["text", "old_text"], path, pattern,
    )
    sign = F.when(F.col("kind").isin("insert", "revise"), 1).when(F.col("kind") == "delete", -1).otherwise(0)
    docs = F.when(F.col("kind") == "revise", 0).otherwise(sign)
    old = F.when(F.col("kind") == "revise", F.col("old_text_tokens")).otherwise(0)
    return counted.groupBy("source", "lang", F.lit(tokenizer).alias("tokenizer")).agg(
        F.sum(docs).cast("long").alias("n_docs"), F.sum(sign * F.col("text_tokens") - old).cast("long").alias("n_tokens")
    )


def _log(spark: SparkSession, store: str) -> DataFrame:
    """The published commits (version, batch_id, deltas, totals), the latest of each batch; folders are named from the store on."""
    schema = "version long, batch_id long, deltas string, totals string"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/log")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).json(f"{store}/log").filter("version is not null")
    return rows.groupBy("batch_id").agg(F.max(F.struct("version", "deltas", "totals")).alias("c")).select("batch_id", "c.*")


def _last(log: DataFrame) -> Row | None:
    """The last commit; however many there are, one row comes to the driver."""
    return log.orderBy(F.desc("version")).limit(1).first()


def _publish(spark: SparkSession, store: str, version: int, batch_id: int, deltas: str, totals: str) -> None:
    """Make a commit visible: its one line is written beside the log and moved there, which happens whole or not at all."""
    fs, name = spark._jvm.org.apache.hadoop.fs, f"{version:012d}.json"
    written, place = fs.Path(f"{store}/pending/{uuid.uuid4().hex}"), fs.Path(f"{store}/log/{name}")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place.getParent())
    out = files.create(written, False)
    out.write(bytearray(json.dumps({"version": version, "batch_id": batch_id, "deltas": deltas, "totals": totals}) + "\n", "utf-8"))
    out.close()
    if files.exists(place) or not files.rename(written, place):
        raise RuntimeError(f"another writer has published version {version} of {store}")


def commit(deltas: DataFrame, store: str, batch_id: int) -> None:
    """Add a batch's deltas to the totals of `store`, once: the same id again replaces what the batch added.

    The batch and the new totals (the last ones plus the batch, less its earlier deltas if it is a replay) are
    written to folders of their own. Then one line in the log names both; until it is there, readers see the
    last version, so a crash at any point loses and doubles nothing. Only the last totals, one row a
    group, are read: batches before aren't summed again. One writer at a time; a second one gets an error.
    """
    spark, batch_id = deltas.sparkSession, int(batch_id)
    log = _log(spark, store)
    last, earlier = _last(log), log.filter(F.col("batch_id") == batch_id).first()
    version = last["version"] + 1 if last else 1
    mine, after = (f"{kind}/{version:012d}-{uuid.uuid4().hex}" for kind in ("deltas", "totals"))
    deltas.select(*KEYS, *COUNTS).write.parquet(f"{store}/{mine}")
    parts = [_counts(spark, f"{store}/{mine}")]
    if last:
        parts.append(_counts(spark, f"{store}/{last['totals']}"))
    if earlier:
        parts.append(_counts(spark, f"{store}/{earlier['deltas']}").select(*KEYS, *[(-F.col(c)).alias(c) for c in COUNTS]))
    total = reduce(DataFrame.union, parts).groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in COUNTS])
    total.write.parquet(f"{store}/{after}")  # a row for each source, language and tokenizer
    _publish(spark, store, version, batch_id, mine, after)


def _counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("source string, lang string, tokenizer string, n_docs long, n_tokens long").parquet(path)


def totals(spark: SparkSession, store: str) -> DataFrame:
    """The last published totals: (source, lang, tokenizer, n_docs, n_tokens); groups that come to nothing go."""
    last = _last(_log(spark, store))
    if not last:
        return spark.createDataFrame([], "source string, lang string, tokenizer string, n_docs long, n_tokens long")
    return _counts(spark, f"{store}/{last['totals']}").filter("n_docs <> 0 or n_tokens <> 0")


def compact(spark: SparkSession, store: str) -> int:
    """Delete the totals of all versions but the last, replaced or unpublished deltas, and the log's single lines; the number of folders deleted.

    The log is written anew as one table beside its lines before these go, and equal lines count once, so readers find every commit
    throughout. Which folders are still named is told by a join; only the names of those that aren't come to the driver.
    """
    log = kept(_log(spark, store), "token-log")
    last, gone = _last(log), 0
    used = log.select(F.col("deltas").alias("folder")).union(log.filter(F.col("version") == (last["version"] if last else 0)).select("totals"))
    fs = spark._jvm.org.apache.hadoop.fs
    for kind in ("deltas", "totals", "pending"):
        path = fs.Path(f"{store}/{kind}")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        there = [(f"{kind}/{f.getPath().getName()}",) for f in files.listStatus(path)] if files.exists(path) else []
        for (folder,) in spark.createDataFrame(there, "folder string").join(used, "folder", "left_anti").collect() if there else []:
            gone += files.delete(fs.Path(f"{store}/{folder}"), True)
    if last:
        path = fs.Path(f"{store}/log")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        lines = [f.getPath() for f in files.listStatus(path)]
        log.select("version", "batch_id", "deltas", "totals").write.mode("append").json(f"{store}/log")
        kept_line = f"{last['version']:012d}.json"  # the last one stays: the next writer's version is told by its name
        for line in lines:
            if line.getName() != kept_line:
                files.delete(line, False)
    return gone
