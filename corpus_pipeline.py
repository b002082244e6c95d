"""Corpus pipeline: from the documents table to a weighted mix of its clean documents.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written and read again before the next.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.decontaminate import decontaminate
from lectern.llm.lines import dedup_lines
from lectern.llm.minhash import near_duplicates
from lectern.llm.mixing import mix_sources
from lectern.llm.quality import keep_quality
from lectern.llm.shared import WORD, materialize, read

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it is fitted on documents and labels of this input."""
    return keep_quality(docs.select(COLUMNS), read(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that repeat earlier ones; n_chars follows the text. One that loses all its words goes."""
    left = dedup_lines(docs, carry=["lang", "source"])
    # Behind the explode of one element the filter stays above, so what is left of a text is put together once.
    left = left.select("doc_id", F.explode(F.array("text")).alias("text"), "lang", "source", "n_removed")
    left = left.filter((F.col("n_removed") == 0) | F.col("text").rlike(WORD))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of every near-duplicate class."""
    kept = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi").select(COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark")).select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the weighted mix takes of every document."""
    return mix_sources(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_lines),
    ("MinHash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mix),
]

#: Classifier and latent space can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
