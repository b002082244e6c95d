"""Substring dedup by content-defined chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.bytesops import U64, blocks, byte_codes, byte_view, randoms, signed, span_hashes
from lectern.llm.shared import drop, join_hot, materialize, new_path
from lectern.llm.suffixes import CUT, cut, keyed, own_spans, with_cuts

#: Bits of the rolling hash that are zero at a cut, least bytes from a cut to the next, most bytes of a chunk.
CUT_BITS, NEAREST, MOST = 6, 40, 1024
#: A cut depends on so many bytes before it: those of the rolling hash, and NEAREST of them.
SEEN = 32 + NEAREST
#: A mark is the least hash of so many places in a row; so many bytes around it, 32 of them before it, are its context.
WINDOW, CONTEXT = 192, 64
#: Equal stretches of WINDOW + CONTEXT - 1 bytes or more have the same mark.
REACH = WINDOW + CONTEXT
_GEAR = (randoms(51, 256) >> U64(20)).astype(np.uint32)


def _gear_hashes(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Gear hash at every place, of the last 32 bytes of its row."""
    place = np.arange(len(data)) - np.repeat(bounds[:-1], np.diff(bounds))
    gear, width = _GEAR[data], 1
    while width < 32:
        before = np.zeros_like(gear)
        before[width:] = gear[:-width] << np.uint32(width)
        before[place < width] = 0
        gear, width = gear + before, 2 * width
    return gear


def cut_points(data: np.ndarray, bounds: np.ndarray, gear: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, end) of every chunk of every row; row r is data[bounds[r]:bounds[r + 1]].

    Gear hash: shifted left by one a byte and the byte's number added, so it depends on the last 32 bytes of
    the row; it is computed for all places at once, for 1, 2, 4, ... 32 bytes. A place whose top bits are zero
    is a cut unless another such place stands within the NEAREST bytes before it: a rule on near bytes
    alone, so an insertion moves no cut farther away. Cuts don't fall inside a UTF-8 character. Longer
    stretches are cut every MOST bytes from their start.
    """
    n = len(bounds) - 1
    rows = np.repeat(np.arange(n), np.diff(bounds))
    gear = _gear_hashes(data, bounds) if gear is None else gear
    tail = np.zeros(len(data), bool)
    tail[:-1] = (data[1:] & 0xC0) == 0x80
    low = np.flatnonzero(((gear >> np.uint32(32 - CUT_BITS)) == 0) & ~tail)
    alone = np.ones(len(low), bool)
    alone[1:] = (np.diff(low) > NEAREST) | (rows[low][1:] != rows[low][:-1])
    ends = np.union1d(low[alone] + 1, bounds[1:][np.diff(bounds) > 0])
    starts = np.concatenate([[0], ends[:-1]])
    parts = (ends - starts - 1) // MOST
    extra = np.repeat(starts, parts) + MOST * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts) + 1)
    ends = np.union1d(ends, extra[~tail[extra - 1]])
    return rows[ends - 1], ends


def mark_points(gear: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, end) of the marks of every row, each after a place of `gear`; row r has gear[bounds[r]:bounds[r + 1]].

    Of each WINDOW places in a row whose contexts are within the row, the least gear hash, the last of equal ones, is a mark. So
    equal stretches have equal marks wherever they stand, one at least in each REACH - 1 bytes, and one a period
    where a few bytes repeat. There, equal hashes a period before the first and after the last one are marks, too.
    """
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    after = CONTEXT - 32
    n = len(gear) - WINDOW - after + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    last = U64((1 << 32) - 1)
    least, width = gear.astype(U64) << U64(32) | (last - np.arange(len(gear), dtype=U64)), 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        least, width = np.minimum(least[:-step], least[step:]), width + step
    within = rows[:n] == rows[WINDOW + after - 1 :]
    for start in bounds[:-1]:  # the first hashes are of fewer than 32 bytes
        within[start : start + 31] = False
    ats = (last - (least[:n][within] & last)).astype(np.int64)
    ats = ats[np.diff(ats, prepend=-1) > 0]
    period = np.diff(ats)
    period[(period > CONTEXT) | (gear[ats[1:]] != gear[ats[:-1]]) | (rows[ats[1:]] != rows[ats[:-1]])] = 0
    more = []
    ends = (np.diff(period, prepend=0) != 0) | (np.diff(period, append=0) != 0)
    for i in np.flatnonzero((period > 0) & ends):  # a run of equal marks: to both ends of it
        at, step, row = int(ats[i]), int(period[i]), rows[ats[i]]
        if i == 0 or period[i - 1] != step:
            while at - step >= bounds[row] + 31 and gear[at - step] == gear[at]:
                at -= step
                more.append(at)
        at = int(ats[i + 1])
        if i + 1 == len(period) or period[i + 1] != step:
            while at + step + after < bounds[row + 1] and gear[at + step] == gear[at]:
                at += step
                more.append(at)
    ats = np.union1d(ats, more).astype(np.int64) if more else ats
    return rows[ats], ats + 1


_CHUNKS = "doc_id long, row_key long, h1 long, h2 long, lo int, hi int, again boolean, low int, high int, h_before long, h_after long"


def _chunks(with_marks: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of (doc_id, row_key, text) the chunks, with the start of the chunk before and the end of the one after it, and the digests of these, null where there is none.

    `with_marks`: the marks' contexts, too. Before and after them is what is up to the far ends of their neighbours' contexts.
    Marks that follow each other a period apart, with the same context, come as one, from the first to the last.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_view(batch.column(2))
            for a, b in blocks(offsets):
                part, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                if not len(part):
                    continue
                gear = _gear_hashes(part, bounds)
                rows, ends = cut_points(part, bounds, gear)
                n, starts = len(rows), np.concatenate([[0], ends[:-1]])
                if with_marks:
                    mark_rows, ats = mark_points(gear, bounds)
                    rows, starts, ends = (np.concatenate(x) for x in ((rows, mark_rows), (starts, ats - 32), (ends, ats + CONTEXT - 32)))
                opens = np.concatenate([[True], rows[1:] != rows[:-1]])
                opens[n : n + 1] = True
                closes = np.concatenate([opens[1:], [True]])
                low, high = np.where(opens, starts, np.roll(starts, 1)), np.where(closes, ends, np.roll(ends, -1))
                low[n:][opens[n:]], high[n:][closes[n:]] = bounds[rows[n:][opens[n:]]], bounds[rows[n:][closes[n:]] + 1]
                spans = [np.concatenate(x) for x in ((starts, low[n:], ends[n:]), (ends, starts[n:], high[n:]))]  # all chunks and contexts, then what is beside contexts
                hashes = signed(span_hashes(byte_codes(part), *spans))
                digests = [hashes[: len(rows)], signed(span_hashes(byte_codes(part, True), starts, ends, True))]
                before, after = (np.concatenate([np.roll(digests[0][:n], k), x]) for k, x in ((1, hashes[len(rows) : 2 * len(rows) - n]), (-1, hashes[2 * len(rows) - n :])))
                order = np.lexsort((*(x[:n] for x in digests), rows[:n]))
                again = np.zeros(len(rows), bool)  # the text has the chunk before
                again[order[1:]] = np.logical_and.reduce([x[order[1:]] == x[order[:-1]] for x in (rows, *digests)])
                joined = np.zeros(len(rows) + 1, bool)  # with the mark before
                joined[n + 1 : -1] = np.logical_and.reduce([x[n + 1 :] == x[n:-1] for x in (rows, *digests)]) & (np.diff(starts[n:]) <= CONTEXT)
                first, last = np.flatnonzero(~joined[:-1]), np.flatnonzero(~joined[1:])
                own = lambda places, at: pa.array((places - bounds[rows])[at].astype(np.int32))
                sides = [batch.column(k).slice(a, b - a).take(pa.array(rows[first])) for k in (0, 1)]
                none_before, none_after = (x & (np.arange(len(rows)) < n) for x in (opens, closes))
                yield pa.RecordBatch.from_arrays(
                    [
                        *sides, *(pa.array(x[first]) for x in digests), own(starts, first), own(ends, last), pa.array(again[first]), own(low, first), own(high, last),
                        pa.array(before[first], mask=none_before[first]), pa.array(after[last], mask=none_after[last]),
                    ],
                    [c.split()[0] for c in _CHUNKS.split(", ")],
                )

    return run


_AROUND = "h1 long, h2 long, n long, s_before long, s_after long, s_left binary, s_right binary"


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (text, chunks in it) one row a chunk: the bytes on either side that a copy of the chunk elsewhere may go on with, if some copy doesn't go on as here anyway."""
    kinds = [pa.int64()] * 5 + [pa.binary()] * 2
    for batch in batches:
        data, offsets = byte_view(batch.column(0))
        rows = []
        for r, own in enumerate(batch.column(1).to_pylist()):
            text = data[offsets[r] : offsets[r + 1]].tobytes()
            for c in own:
                left = text[max(0, min(c["low"] - SEEN, c["lo"] - REACH)) : c["lo"]] if c["left"] else None
                right = text[c["hi"] : max(c["high"], c["hi"] + REACH)] if c["right"] else None
                rows.append((c["h1"], c["h2"], c["n"], c["h_before"], c["h_after"], left, right))
        columns = list(zip(*rows, strict=True)) or [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [c.split()[0] for c in _AROUND.split(", ")])


def _same(one: np.ndarray, other: np.ndarray) -> int:
    """How many bytes the two have in common at their start."""
    n = min(len(one), len(other))
    differ = one[:n] != other[:n]
    return int(differ.argmax()) if differ.any() else n


def _cut_stretched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`cut`, with each span stretched to the left and right as far as the bytes agree with those of its source; no UTF-8 character is split."""
    for batch in batches:
        data, offsets = byte_view(batch.column(2))
        inside = (data & 0xC0) == 0x80
        all_lo, all_hi, sizes = [], [], [0]
        for r, spans in enumerate(batch.column(3)):
            text, middle = (x[offsets[r] : offsets[r + 1]] for x in (data, inside))
            fields = [spans.values.field(f).to_pylist() for f in ("lo", "hi", "s_left", "s_right")]
            for lo, hi, left, right in zip(*fields, strict=True):
                start = lo - _same(text[:lo][::-1], np.frombuffer(left, np.uint8)[::-1]) if left else lo
                while start < hi and middle[start]:
                    start += 1
                end = hi + _same(text[hi:], np.frombuffer(right, np.uint8)) if right else hi
                while start < end < len(text) and middle[end]:
                    end -= 1
                all_lo.append(start)
                all_hi.append(end)
            sizes.append(len(all_lo))
        stretched = pa.StructArray.from_arrays([pa.array(all_lo, pa.int32()), pa.array(all_hi, pa.int32())], ["lo", "hi"])
        lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), stretched)
        yield from cut(iter([pa.RecordBatch.from_arrays([*batch.columns[:3], lists], ["doc_id", "row_key", "text", "spans"])]))


def _with_sources(base: DataFrame, met: DataFrame, path: str) -> DataFrame:
    """Chunks that an earlier document has, with the bytes around its first place there where the next chunks differ (s_left, s_right).

    The first place is that of the smallest (doc_id, row_key, lo). Its surroundings are read from its text, once for
    each digest however many copies there are, and meet the copies by the digest. Where what is next to the chunk is
    equal, it goes with the chunk. Surroundings that are equal in all copies aren't read. They are written to `path`.
    """
    place = F.struct("row_key", "lo", "hi", "low", "high", "h_before", "h_after")
    differ = [(F.min(c) != F.max(c)).alias(side) for c, side in (("h_before", "left"), ("h_after", "right"))]
    source = met.groupBy("h1", "h2").agg(F.min("first_id").alias("s_id"), F.min("n").alias("n"), F.min(F.when(F.col("doc_id") == F.col("first_id"), place)).alias("s"), *differ)
    chunk = F.struct("h1", "h2", "n", "left", "right", *[F.col(f"s.{c}").alias(c) for c in ("lo", "hi", "low", "high", "h_before", "h_after")])
    asked = source.groupBy("s_id", F.col("s.row_key").alias("s_key")).agg(F.collect_list(chunk).alias("own"))  # chunks of one text
    texts = base.join(asked, (F.col("doc_id") == F.col("s_id")) & (F.col("row_key") == F.col("s_key"))).dropDuplicates(["doc_id", "row_key"])
    around = materialize(texts.select("text", "own").mapInArrow(_around, _AROUND), "chunk-sources", path)
    copies = met.filter("doc_id > first_id").drop("n")
    # At a text's start or end nothing is left to compare.
    return join_hot(copies, around, ["h1", "h2"], "n").select(
        "doc_id", "row_key", F.when(F.col("h_before") == F.col("s_before"), F.col("low")).otherwise(F.col("lo")).alias("lo"), F.when(F.col("h_after") == F.col("s_after"), F.col("high")).otherwise(F.col("hi")).alias("hi"),
        F.when(F.col("h_before") != F.col("s_before"), F.col("s_left")).alias("s_left"), F.when(F.col("h_after") != F.col("s_after"), F.col("s_right")).alias("s_right"),
    )


def dedup_chunks(docs: DataFrame, stretch: bool = False, marks: bool = False) -> DataFrame:
    """Remove chunks that occurred before: (doc_id, n_bytes, n_removed, n_spans, kept_sha256), a row for each input row.

    Reads doc_id (whole number) and text, as UTF-8 bytes. Texts are cut where a gear rolling hash of the last
    32 bytes says so (some 130 bytes a chunk), so a shifted copy has the same chunks. A chunk goes if its
    128-bit digest occurs at an earlier place, in a document of smaller doc_id or before it in its own;
    n_spans counts maximal runs of removed bytes. Chunks under 41 bytes are ends of texts, short texts among them.

    `stretch`: what an earlier document has goes with the parts before its first cut and after its last one, too. A chunk that an
    earlier document has is compared byte by byte with the surroundings of the chunk's first place of all, in the smallest doc_id, and goes with
    all bytes on either side that are equal there, whole characters only. Chunks that only their own text has before aren't stretched. As cuts depend on
    the SEEN bytes before them, equal bytes reach at most that much beyond the neighbouring chunks, or these are repeats themselves.

    `marks`, with `stretch`: passages without a whole chunk go, too, among them runs of one word. The context of a mark (see `mark_points`)
    is looked up and stretched as a chunk is, so every stretch of REACH - 1 bytes or more that an earlier document has is found
    whatever its cuts are, and shorter ones, from CONTEXT bytes on, where they hold a mark. Repeats within a text go by chunks only.
    Each mark is compared with its own first place: where that is a document with little more than the context, the bytes between marks may stay.

    Texts are chunked once; digests are reduced by min and joined back, digests that very many chunks have
    by a broadcast of at most 4096 of them; no group of equal chunks is gathered. Only texts that lose something
    meet their spans. Null text is empty. A null doc_id neither gives nor loses anything. Rows of one doc_id with
    different texts don't affect each other, equal ones are cut alike; each comes back. Empty input: no rows.
    """
    if marks and not stretch:
        raise ValueError("marks need stretch")
    base, spark = keyed(docs), docs.sparkSession
    paths = [new_path(spark, name) for name in ("chunks", "chunk-firsts", "chunk-places", "chunk-sources")]
    chunks = materialize(base.filter("doc_id is not null").mapInArrow(_chunks(marks), _CHUNKS), "chunks", paths[0])
    first = chunks.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("n"))
    first = materialize(first.filter("first_id < last_id").drop("last_id"), "chunk-firsts", paths[1])
    none = F.lit(None).cast("binary")
    if stretch:
        met = materialize(join_hot(chunks.drop("again"), first.withColumn("weight", F.col("n")), ["h1", "h2"], "weight"), "chunk-places", paths[2])
        copies = _with_sources(base, met, paths[3])
    else:
        copies = join_hot(chunks.filter("not again"), first, ["h1", "h2"], "n").filter("doc_id > first_id").select("doc_id", "row_key", "lo", "hi", none.alias("s_left"), none.alias("s_right"))
    own = chunks.filter("again").select("doc_id", "row_key", "lo", "hi", none.alias("s_left"), none.alias("s_right"))
    spans = materialize(copies.unionByName(own), "chunk-repeats")
    for path in paths:
        drop(spark, path)
    lists = spans.groupBy(F.col("doc_id").alias("span_id")).agg(F.collect_list(F.struct("row_key", "lo", "hi", "s_left", "s_right")).alias("all_spans"))
    losing = base.join(lists, F.col("doc_id") == F.col("span_id")).select("doc_id", "row_key", "text", own_spans())
    return with_cuts(base, losing.mapInArrow(_cut_stretched, CUT))
