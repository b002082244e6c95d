"""Near-duplicate documents by min-max hashing of word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.bytesops import U64, blocks, byte_view, mix, randoms, shingle_sets, signed
from lectern.llm.components import components
from lectern.llm.shared import join_hot, materialize, salted

#: 48 bands of three permutations, each giving its minimum and its maximum: six values a band, 288 in all.
BANDS, PERMUTATIONS_A_BAND = 48, 3
SHINGLE_WORDS, LEAST_PERCENT = 5, 75
_N = BANDS * PERMUTATIONS_A_BAND
_FACTOR, _SHIFT = (randoms(s, _N).astype(np.uint32) for s in (11, 12))
_FACTOR |= np.uint32(1)
_BAND = randoms(13, _N * 2).reshape(BANDS, PERMUTATIONS_A_BAND * 2)
SKETCH_LONGS = -(-_N * 2 // 64)
#: One-bit sketches of similarity 0.75 differ in 36 of 288 bits, with a deviation of 5.6; 78 is seven and a half deviations more.
MOST_BITS = 78


def _extremes(shingles: np.ndarray) -> np.ndarray:
    """Minimum and maximum of the shingles under each permutation, as one row."""
    low, high = np.full(_N, 2**32 - 1, np.uint32), np.zeros(_N, np.uint32)
    short = (shingles >> U64(32)).astype(np.uint32)
    for at in range(0, len(short), 2048):
        seen = short[None, at : at + 2048] * _FACTOR[:, None]
        seen += _SHIFT[:, None]
        np.minimum(low, seen.min(1), out=low)
        np.maximum(high, seen.max(1), out=high)
    return np.stack([low, high], 1).ravel()


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    """Two numbers of a set."""
    both = np.array([shingles.sum(dtype=U64), mix(shingles).sum(dtype=U64)], U64).view(np.int64)
    return int(both[0]), int(both[1])


def _lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(signed(np.ascontiguousarray(values).ravel())))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = byte_view(batch.column(1))
        for a, b in blocks(offsets):
            sets = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SHINGLE_WORDS)
            seen = np.stack([_extremes(s) for s in sets])
            keys = mix((seen.reshape(-1, BANDS, PERMUTATIONS_A_BAND * 2).astype(U64) * _BAND).sum(2, dtype=U64))
            bits = np.zeros((b - a, SKETCH_LONGS * 64), np.uint8)
            bits[:, : _N * 2] = (seen * np.uint32(0x9E3779B1)) >> np.uint32(31)
            sketch = np.packbits(bits, 1).view(np.int64)
            size = np.array([len(s) for s in sets], np.int64)
            digest = np.array([_digest(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(size), pa.array(digest[:, 0]), pa.array(digest[:, 1]), _lists(keys), _lists(sketch)],
                ["doc_id", "n_shingles", "h1", "h2", "bands", "sketch"],
            )


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (u, v, cu, cv, text of u, text of v) those whose full shingle sets are similar enough, without the texts."""
    for batch in batches:
        sides = []
        for k in (4, 5):
            data, offsets = byte_view(batch.column(k))
            sides.append([s for a, b in blocks(offsets) for s in shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SHINGLE_WORDS)])
        near = []
        for x, y in zip(*sides, strict=True):
            both = len(np.intersect1d(x, y, assume_unique=True))
            near.append(both > 0 and 100 * both >= LEAST_PERCENT * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays(batch.columns[:4], ["u", "v", "cu", "cv"]).filter(pa.array(near, pa.bool_()))


def _differing(a: str, b: str) -> Column:
    return sum((F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(SKETCH_LONGS)), F.lit(0))


def _right_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (doc_id, text, id, n_shingles, h1, h2) the id and text where the text has just that set."""
    for batch in batches:
        data, offsets = byte_view(batch.column(1))
        for a, b in blocks(offsets):
            sets = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SHINGLE_WORDS)
            seen = np.array([(len(s), *_digest(s)) for s in sets], np.int64).reshape(-1, 3)
            asked = np.stack([batch.column(k).slice(a, b - a).to_numpy() for k in (3, 4, 5)], 1)
            part = pa.RecordBatch.from_arrays([batch.column(2), batch.column(1)], ["id", "text"]).slice(a, b - a)
            yield part.filter(pa.array((seen == asked).all(1)))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = byte_view(batch.column(1))
        for a, b in blocks(offsets):
            sets = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SHINGLE_WORDS)
            ids = np.repeat(batch.column(0).slice(a, b - a).to_numpy(), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(signed(np.concatenate(sets)))], ["id", "gram"])


def _parities(shingles: np.ndarray) -> np.ndarray:
    """For each of 1024 classes of shingles, whether the set has an odd number of them, as 16 words of bits."""
    odd = np.bincount((shingles & U64(1023)).astype(np.int64), minlength=1024) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text the shingles that a similar text must meet it in: the rarest ones, but none that it has alone."""
    for batch in batches:
        ids, lists, rows = batch.column(0), batch.column(1), []
        edges, entries = lists.offsets.to_numpy(), lists.values
        texts, grams = entries.field("texts").to_numpy(), entries.field("gram").to_numpy()
        for r, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            order = np.lexsort((grams[a:b], texts[a:b]))
            n, odd = b - a, _parities(grams[a:b].view(U64))
            last = n - -(-LEAST_PERCENT * n // 100)  # later positions leave too few
            first = np.searchsorted(texts[a:b][order], 2)
            rows += [(grams[a:b][order[k]], ids[r].as_py(), n, k, odd) for k in range(first, last + 1)]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        odds = _lists(np.stack(columns[4])) if rows else pa.array([], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns[:4]] + [odds], ["gram", "id", "n", "at", "odd"])


def _similar_across(texts: DataFrame, left: DataFrame) -> DataFrame:
    """Pairs (u > v, cu, cv) across components, one of each marked `other` in `left` (id, other, c), that may be similar.

    An exact prefix join: with all shingles in one order, the first that a similar pair shares stands where
    both sets still have the overlap that their sizes ask for. The order goes by the number of texts, the
    rarest shingle first, so what very many texts have stands in a prefix only if nearly all of its text is
    such; shingles of one text only aren't sent at all.
    Classes of shingles that the texts have an even and an odd number of each cost them one shared shingle
    or more; that bound is exact too, and leaves few pairs but those close to the threshold.
    """
    grams = materialize(texts.mapInArrow(_grams, "id long, gram long"), "near-grams")
    number = materialize(grams.groupBy("gram").agg(F.count("*").alias("n")).withColumn("texts", F.col("n")), "near-shingles")
    lists = join_hot(grams, number, ["gram"], "n").groupBy("id").agg(F.collect_list(F.struct("texts", "gram")).alias("grams"))
    prefixes = lists.mapInArrow(_prefixes, "gram long, id long, n long, at long, odd array<long>")
    prefixes = materialize(prefixes.join(left, "id"), "near-prefixes")
    # A partner's size lies between what the own size asks for and what the place leaves room for; a row none of whose shingle's texts has
    # such a size is left out before pairs are formed.
    sizes = prefixes.groupBy("gram").agg(F.min("n").alias("_least"), F.max("n").alias("_most"), F.count("*").alias("_rows")).filter("_rows > 1")
    prefixes = join_hot(prefixes, materialize(sizes, "near-sizes"), ["gram"], "_rows")
    fits = 100 * F.col("_most") >= LEAST_PERCENT * F.col("n")
    roomy = (100 + LEAST_PERCENT) * (F.col("n") - F.col("at")) >= LEAST_PERCENT * (F.col("n") + F.col("_least"))
    prefixes = materialize(prefixes.filter(fits & roomy).drop("_least", "_most"), "near-prefixes")
    a = prefixes.filter("other").select("gram", F.col("id").alias("u"), F.col("n").alias("nu"), F.col("at").alias("at_u"), F.col("c").alias("cu"), F.col("odd").alias("odd_u"))
    b = prefixes.select("gram", F.col("id").alias("v"), F.col("n").alias("nv"), F.col("at").alias("at_v"), F.col("c").alias("cv"), F.col("odd").alias("odd_v"))
    asked = LEAST_PERCENT * (F.col("nu") + F.col("nv"))
    room = lambda n, at: (100 + LEAST_PERCENT) * (F.col(n) - F.col(at)) >= asked
    apart = sum((F.bit_count(F.col("odd_u")[k].bitwiseXOR(F.col("odd_v")[k])) for k in range(16)), F.lit(0))
    enough = (100 + LEAST_PERCENT) * (F.col("nu") + F.col("nv") - apart) >= 2 * asked
    met = a.join(b, (a["gram"] == b["gram"]) & (F.col("cu") != F.col("cv")) & room("nu", "at_u") & room("nv", "at_v") & enough)
    first = F.col("u") > F.col("v")
    return met.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), F.when(first, F.col("cu")).otherwise(F.col("cv")).alias("cu"), F.when(first, F.col("cv")).otherwise(F.col("cu")).alias("cv")
    ).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Classes of near-duplicate texts: (doc_id, n_shingles, component_id, kept), one row for each input row.

    Reads doc_id (whole number) and text. Texts are linked if the sets of their five-word shingles (A-Z
    folded) have 100 * intersection >= 75 * union. Texts of equal sets are first made one class. Classes are
    banded by min-max hashing: 144 permutations give minimum and maximum,
    48 bands hold six of these values each, so a pair of similarity 0.75 shares a band with probability
    0.9999. Links are confirmed on full sets, in three steps: each class with the likeliest of
    the first members of its buckets; with the others of these; then the members of buckets that aren't
    all in one component by then by an exact prefix join across components. So a bucket of n members that
    hang together takes n comparisons, and no link between two components is lost. The second and third step
    merge components only, so their graphs are small.

    One-bit sketches skip pairs that are far from the threshold (beyond seven deviations). A text without
    words has an empty set and links with nothing; null text is such a text. A null doc_id is kept, with
    itself (null) as component. Rows of one doc_id are one node, which holds the classes of all its texts
    together. A very long text is one step of a task. Other columns aren't read. Empty input: no rows.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed_docs = materialize(
        base.mapInArrow(_sign, "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>, sketch array<long>"), "near-signed"
    )
    some, of_set = signed_docs.filter("n_shingles > 0 and doc_id is not null"), ["n_shingles", "h1", "h2"]
    classes = materialize(
        some.groupBy(*of_set).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).withColumn("id", F.monotonically_increasing_id()), "near-classes"
    )
    reps = materialize(
        some.join(classes.select("id", F.col("rep").alias("doc_id"), *of_set), ["doc_id", *of_set]).select("id", "doc_id", "bands", "sketch").dropDuplicates(["id"]), "near-reps"
    )
    keyed = reps.select("id", F.explode("bands").alias("key"))
    centres = keyed.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("last"), F.count("*").alias("n")).filter("centre < last").drop("last")
    buckets = materialize(join_hot(keyed, materialize(centres, "near-centres"), ["key"], "n"), "near-buckets")
    sketches = reps.select("id", "sketch")
    stars = materialize(buckets.filter("id <> centre").select("id", "centre").distinct().join(sketches, "id"), "near-stars")
    of_centre = stars.groupBy("centre").agg(F.count("*").alias("n")).join(sketches.select(F.col("id").alias("centre"), F.col("sketch").alias("c_sketch")), "centre")
    stars = join_hot(stars, materialize(of_centre, "near-stars"), ["centre"], "n")
    stars = materialize(stars.select("id", "centre", _differing("sketch", "c_sketch").alias("bits")).filter(F.col("bits") <= MOST_BITS), "near-stars")
    # Texts of the classes that share a bucket: by the class's first document, of whose texts the one with this set.
    asked = reps.join(buckets.select("id").distinct(), "id", "left_semi").join(classes.select("id", *of_set), "id")
    texts = materialize(base.join(asked.select("id", "doc_id", *of_set), "doc_id").mapInArrow(_right_text, "id long, text string").dropDuplicates(["id"]), "near-texts")

    def linked(pairs: DataFrame) -> DataFrame:
        """Of pairs (u, v, cu, cv) the true links; v may be in very many."""
        pairs, ends = salted(pairs, texts.select(F.col("id").alias("v"), F.col("text").alias("v_text")), "v", "u")
        a = texts.select(F.col("id").alias("u"), F.col("text").alias("u_text"))
        both = pairs.join(ends, ["v", "salt"]).join(a, "u").select("u", "v", "cu", "cv", "u_text", "v_text")
        return both.mapInArrow(_verify, "u long, v long, cu long, cv long")

    def labelled(links: DataFrame, labels: DataFrame) -> DataFrame:
        """(id, c) with the components joined that the links (cu, cv) hold together."""
        merged = components(links.select(F.col("cu").alias("u"), F.col("cv").alias("v"))).withColumnRenamed("id", "c")
        return materialize(labels.join(merged, "c", "left").select("id", F.coalesce("component", "c").alias("c")), "near-labels")

    def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """(u, v, cu, cv): pairs whose ends aren't known to be in one component, with the components."""
        ends = [labels.select(F.col("id").alias(x), F.col("c").alias(f"c{x}")) for x in "uv"]
        return pairs.join(ends[0], "u").join(ends[1], "v").filter("cu <> cv").select("u", "v", "cu", "cv")

    one = F.min(F.struct("bits", "centre"))["centre"]
    first = materialize(stars.groupBy("id").agg(one.alias("v")).select(F.col("id").alias("u"), "v", F.col("id").alias("cu"), F.col("v").alias("cv")), "near-pairs")
    links = linked(first)
    several = materialize(some.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "near-several")
    if several.limit(1).count():  # a doc_id with several rows holds their classes together
        own = some.join(several, "doc_id").select("doc_id", *of_set).distinct().join(classes, of_set).select("doc_id", F.col("id").alias("u"))
        links = links.unionByName(own.join(own.groupBy("doc_id").agg(F.min("u").alias("v")), "doc_id").select("u", "v", F.col("u").alias("cu"), F.col("v").alias("cv")))
    labels = labelled(links, classes.select("id", F.col("id").alias("c")))

    rest = stars.select(F.col("id").alias("u"), F.col("centre").alias("v")).join(first, ["u", "v"], "left_anti")
    second = materialize(apart(rest, labels), "near-pairs")
    labels = labelled(linked(second), labels)

    places = buckets.join(labels, "id").join(labels.select(F.col("id").alias("centre"), F.col("c").alias("cc")), "centre")
    places = materialize(places.select("key", "id", "c", (F.col("c") != F.col("cc")).alias("other")), "near-places")
    mixed = places.join(places.filter("other").select("key").distinct(), "key", "left_semi")
    left = materialize(mixed.groupBy("id").agg(F.max("other").alias("other"), F.min("c").alias("c")), "near-left")
    if left.limit(1).count():
        third = _similar_across(texts.join(left.select("id"), "id", "left_semi"), left)
        seen = first.select("u", "v").union(second.select("u", "v"))
        seen = seen.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        labels = labelled(linked(materialize(third.join(seen, ["u", "v"], "left_anti"), "near-pairs")), labels)

    named = labels.join(classes, "id")
    smallest = named.groupBy("c").agg(F.min("rep").alias("component"))
    named = materialize(named.join(smallest, "c").select(*of_set, "component", "n"), "near-named")
    rows = signed_docs.select("doc_id", *of_set)
    alone = rows.filter("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component"))
    found = join_hot(rows.filter("n_shingles > 0 and doc_id is not null"), named, of_set, "n").select("doc_id", "n_shingles", "component").unionByName(alone)
    # A doc_id with several texts is one node, whichever of them is empty.
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"), F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
g AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS grams
  FROM w),
s AS (SELECT doc_id, unnest(grams) AS gram FROM g),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT p.x, p.y FROM p JOIN g a ON a.doc_id = p.x JOIN g b ON b.doc_id = p.y
  WHERE 100 * p.n >= 75 * (len(a.grams) + len(b.grams) - p.n)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS id, doc_id AS other FROM g
  UNION SELECT r.id, b.y FROM reach r JOIN both_ways b ON b.x = r.other)
SELECT g.doc_id, len(g.grams)::BIGINT AS n_shingles, min(r.other)::BIGINT AS component_id, min(r.other) = g.doc_id AS kept
FROM g JOIN reach r ON r.id = g.doc_id GROUP BY g.doc_id, g.grams
"""
