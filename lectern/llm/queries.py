"""The registered queries of this subpackage, opN_<name>, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.llm import chunks, decontaminate, infilling, lines, minhash, mixing, negatives, neighbours, pieces, quality, suffixes, token_counts, url_templates
from lectern.llm.shared import materialize, new_path, read


def op1_near_duplicates(spark, sf_dir):
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op2_quality(spark, sf_dir):
    return quality.classify_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_nearest_neighbours(spark, sf_dir):
    return neighbours.nearest(read(spark, sf_dir, "embeddings"))


def op4_chunk_dedup(spark, sf_dir):
    return chunks.dedup_chunks(read(spark, sf_dir, "documents"), stretch=True, marks=True)


def op5_suffix_dedup(spark, sf_dir):
    return suffixes.remove_repeats(read(spark, sf_dir, "documents"))


def op6_url_filter(spark, sf_dir):
    return url_templates.judge_urls(read(spark, sf_dir, "pages"))


def op7_source_mix(spark, sf_dir):
    return mixing.mix_sources(read(spark, sf_dir, "documents"))


def op8_decontamination(spark, sf_dir):
    return decontaminate.find_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_token_counts(spark, sf_dir):
    """Token counts of all documents, kept up to date over three batches and a replay.

    Batch 1 inserts every document as a crawl in lower case had it, and the benchmark by mistake; batch 2 revises
    every document to its text as it is; batch 3 takes the benchmark out. Batch 2 then comes once more.
    """
    store, none = new_path(spark, "token-store"), F.lit(None).cast("string")
    docs = read(spark, sf_dir, "documents").select("source", "lang", "text", F.lower("text").alias("before"))
    stray = read(spark, sf_dir, "benchmark").select(F.lit("benchmark").alias("source"), none.alias("lang"), "text")
    row = lambda df, kind, text, old: df.select(F.lit(kind).alias("kind"), "source", "lang", F.col(text).alias("text"), old.alias("old_text"))
    first = row(docs, "insert", "before", none).union(row(stray, "insert", "text", none))
    token_counts.commit(token_counts.token_deltas(first), store, 1)
    revised = materialize(token_counts.token_deltas(row(docs, "revise", "text", F.col("before"))), "token-deltas")
    token_counts.commit(revised, store, 2)
    token_counts.commit(token_counts.token_deltas(row(stray, "delete", "text", none)), store, 3)
    token_counts.commit(revised, store, 2)
    token_counts.compact(spark, store)
    return token_counts.totals(spark, store)


def op10_line_dedup(spark, sf_dir):
    return lines.dedup_lines(read(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark, sf_dir):
    changed = infilling.restored(infilling.fill_in_middle(read(spark, sf_dir, "documents")))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return changed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_sentencepiece(spark, sf_dir):
    coded = pieces.decode_pieces(pieces.encode_pieces(read(spark, sf_dir, "documents")))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2("ids_le", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op13_hard_negatives(spark, sf_dir):
    """Anchors' hard negatives among labels that are off by one where vec_id is divisible by 7."""
    given = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(given.withColumn("label", label))


QUERIES = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_quality": op2_quality,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_chunk_dedup": op4_chunk_dedup,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_source_mix": op7_source_mix,
    "op8_decontamination": op8_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_line_dedup": op10_line_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL = {
    "op1_near_duplicates": minhash.ORACLE,
    "op5_suffix_dedup": suffixes.ORACLE,
    "op6_url_filter": url_templates.oracle(),
    "op7_source_mix": mixing.ORACLE.replace("{docs}", "documents"),
    "op10_line_dedup": lines.ORACLE,
    "op11_fill_in_middle": infilling.ORACLE,
    "op13_hard_negatives": negatives.ORACLE,
}
