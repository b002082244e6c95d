"""Line dedup by winnowing over line hashes, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.shared import WORD, join_hot, materialize


#: Words of a repeated run from which on it is sure to be found, and below which it stays.
MIN_WORDS = 8


def _windows(lines: Column, min_words: int) -> Column:
    """Every window of `lines` (array of struct line_no, hash, twin, words): struct at, till, chosen, as places in the array.

    A window starts at any line and ends with the first line that brings it to `min_words` words, so it
    has at most that many lines. chosen is its line of smallest hash, the first of equal ones.
    """

    def window(_, i):
        near = F.slice(lines, i + 1, F.lit(min_words))
        reach = F.aggregate(
            near,
            F.struct(F.lit(0).alias("words"), F.lit(0).alias("n")),
            lambda a, x: F.when(a["words"] >= min_words, a).otherwise(
                F.struct((a["words"] + x["words"]).alias("words"), (a["n"] + 1).alias("n"))
            ),
        )
        return F.struct(i.alias("at"), reach.alias("reach"))

    def chosen(w):
        hashes = F.transform(F.slice(lines, w["at"] + 1, w["reach"]["n"]), lambda x: x["hash"])
        place = w["at"] + F.array_position(hashes, F.array_min(hashes)).cast("int") - 1
        return F.struct(w["at"].alias("at"), (w["at"] + w["reach"]["n"] - 1).alias("till"), place.alias("chosen"))

    return F.transform(F.filter(F.transform(lines, window), lambda w: w["reach"]["words"] >= min_words), chosen)


def _prints(lines: Column, windows: Column, opening: Column) -> Column:
    """Of each chosen line its print, its place, the lines of its windows and these windows' bounds among them.

    Windows move on, and so do their chosen lines, so the windows of a line stand side by side.
    """

    def one(o, t):
        last = F.coalesce(F.get(opening, t + 1)["k"], F.size(windows)) - 1
        own = F.slice(windows, o["k"] + 1, last - o["k"] + 1)
        from_, till = F.get(windows, o["k"])["at"], F.get(windows, last)["till"]
        return F.struct(
            F.get(lines, o["chosen"])["hash"].alias("print"),
            F.transform(F.slice(lines, from_ + 1, till - from_ + 1), lambda x: F.struct(x["line_no"].alias("line_no"), x["hash"].alias("hash"), x["twin"].alias("twin"))).alias("around"),
            F.transform(own, lambda w: F.struct((w["at"] - from_).alias("at"), (w["till"] - from_).alias("till"))).alias("bounds"),
        )

    return F.transform(opening, one)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, carry: Sequence[str] = ()) -> DataFrame:
    r"""Delete later copies of repeated runs of lines: input columns doc_id, text; returns (doc_id, text, n_lines, n_removed, n_runs).

    The columns named in `carry` come back as well; other columns aren't read.

    Lines are split at \n. Lines without a word take no part; they go where they stand within a deleted run,
    else stay. The others of a document, in order, are covered by windows of at least `min_words` words. (1)
    Winnowing: of each window only its line of smallest hash is chosen, and only chosen lines are kept as
    fingerprints, each with the lines of its windows; two equal windows always choose the same. (2) Positions of
    equal fingerprints are joined; those that occur once go. (3) From a fingerprint that is left a match is
    extended both ways over the lines around it: each of its windows, known by 128 bits of its lines, whose
    first place is an earlier one, is a copy, and matches of neighbouring fingerprints run on into each other.
    Every line that a copy covers goes; n_removed counts them, n_runs their maximal runs. Places are ordered by
    doc_id, then line number, so copies inside a document count. A run of fewer than `min_words` words is never
    deleted, one of as many is always found.

    No group is gathered: fingerprints and windows are reduced by count and min and joined back, those that
    very many places share by a broadcast of 4096 of them at most. Null text stays null with zero counts; a null doc_id sorts before all
    others; ties don't arise, as rows with equal doc_id and text are one place, and each comes back; a very
    long text is a row of long arrays; empty input: no rows.
    """
    text = F.col("text")
    lines = F.filter(
        F.transform(
            F.split(text, "\n", -1),
            lambda x, i: F.struct(
                i.alias("line_no"), F.xxhash64(x).alias("hash"), F.xxhash64(F.lit("second"), x).alias("twin"), F.regexp_count(x, F.lit(WORD)).alias("words")
            ),
        ),
        lambda x: x["words"] > 0,
    )
    carried = [F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)]
    base = docs.select("doc_id", F.col("text").cast("string").alias("text"), *carried).withColumn("row_hash", F.xxhash64(text))
    windows, steps = F.col("windows"), F.transform("windows", lambda w, k: F.struct(k.alias("k"), w["chosen"].alias("chosen")))
    opening = F.filter(steps, lambda o: (o["k"] == 0) | (F.get(windows, o["k"] - 1)["chosen"] != o["chosen"]))
    prints = materialize(
        base.select("doc_id", "row_hash", lines.alias("lines"))
        .select("doc_id", "row_hash", "lines", _windows(F.col("lines"), min_words).alias("windows"))
        .select("doc_id", "row_hash", "lines", "windows", opening.alias("opening"))
        .select("doc_id", "row_hash", F.explode(_prints(F.col("lines"), windows, F.col("opening"))).alias("p"))
        .select("doc_id", "row_hash", "p.*"),
        "line-prints",
    )
    shared = materialize(prints.groupBy("print").agg(F.count("*").alias("n")).filter("n > 1"), "line-shared")
    met = join_hot(prints, shared, ["print"], "n").select("doc_id", "row_hash", "around", F.explode("bounds").alias("w"))
    part = F.slice("around", F.col("w.at") + 1, F.col("w.till") - F.col("w.at") + 1)
    near = lambda end: F.get("around", F.col(f"w.{end}"))["line_no"].alias(end)
    matches = materialize(
        met.select(
            "doc_id", "row_hash", near("at"), near("till"),
            F.xxhash64(F.transform(part, lambda x: x["hash"])).alias("h1"), F.xxhash64(F.transform(part, lambda x: x["twin"])).alias("h2"),
        ),
        "line-matches",
    )
    place = F.struct("doc_id", "row_hash", "at")
    first = matches.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("n"))
    first = materialize(first.filter(~F.col("first").eqNullSafe(F.col("last"))).drop("last"), "line-firsts")
    later = join_hot(matches, first, ["h1", "h2"], "n").filter(~F.col("first").eqNullSafe(place))
    gone = (
        later.groupBy("doc_id", "row_hash").agg(F.collect_set(F.struct("at", "till")).alias("spans"))
        .select(F.col("doc_id").alias("g_id"), F.col("row_hash").alias("g_hash"), F.array_sort("spans").alias("spans"))
    )
    # Spans go on and on in both ends, so one opens a new run if the span before it ends before the line before.
    spans = F.col("spans")
    opens = F.filter(
        F.transform(spans, lambda s, k: F.struct(k.alias("k"), s["at"].alias("at"))),
        lambda o: (o["k"] == 0) | (F.get(spans, o["k"] - 1)["till"] < o["at"] - 1),
    )
    ends = F.transform("opens", lambda o, t: F.struct(o["at"].alias("at"), F.get(spans, F.coalesce(F.get("opens", t + 1)["k"], F.size(spans)) - 1)["till"].alias("till")))
    dropped = F.flatten(F.transform("runs", lambda r: F.sequence(r["at"], r["till"])))
    whole = F.split(text, "\n", -1)
    kept_at = F.array_except(F.sequence(F.lit(0), F.size(whole) - 1), F.col("dropped"))
    kept = F.array_join(F.transform(kept_at, lambda i: F.col("parts")[i]), "\n")
    number = lambda c: F.coalesce(F.array_size(c), F.lit(0)).cast("long")
    return (
        base.join(gone, F.col("doc_id").eqNullSafe(F.col("g_id")) & F.col("row_hash").eqNullSafe(F.col("g_hash")), "left")
        .withColumn("opens", opens)
        .withColumn("runs", ends)
        .withColumn("dropped", dropped)
        .withColumn("parts", whole)
        .select(
            "doc_id",
            F.when(F.col("runs").isNull(), text).otherwise(kept).alias("text"),
            number("parts").alias("n_lines"),
            number("dropped").alias("n_removed"),
            number("runs").alias("n_runs"),
            *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)],
        )
    )


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no
  FROM documents),
s AS (
  SELECT *, row_number() OVER d AS k, sum(words) OVER d AS c
  FROM (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM l) WHERE words > 0
  WINDOW d AS (PARTITION BY doc_id ORDER BY no)),
e AS (
  SELECT a.doc_id, a.k, a.no AS from_no, min(b.k) AS till_k
  FROM s a JOIN s b ON a.doc_id = b.doc_id AND b.k BETWEEN a.k AND a.k + 7 AND b.c - a.c + a.words >= 8
  GROUP BY a.doc_id, a.k, a.no),
w AS (
  SELECT e.doc_id, e.from_no, max(b.no) AS to_no, string_agg(b.line, chr(10) ORDER BY b.k) AS body
  FROM e JOIN s b ON e.doc_id = b.doc_id AND b.k BETWEEN e.k AND e.till_k GROUP BY e.doc_id, e.from_no),
later AS (SELECT doc_id, from_no, to_no FROM w QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, from_no) > 1),
gone AS (SELECT DISTINCT l.doc_id, l.no FROM l JOIN later ON l.doc_id = later.doc_id AND l.no BETWEEN later.from_no AND later.to_no),
m AS (
  SELECT l.doc_id, l.no, l.line, g.no IS NOT NULL AS gone,
         lag(g.no) OVER (PARTITION BY l.doc_id ORDER BY l.no) IS NULL AS opens
  FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.no = g.no)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT gone), '') AS text,
       count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_removed,
       count(*) FILTER (WHERE gone AND opens)::BIGINT AS n_runs
FROM m GROUP BY doc_id
"""
