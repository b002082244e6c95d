"""Suffix dedup by bucket-pointer refinement: bytes covered by a long string of an earlier document go."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.bytesops import U64, blocks, byte_codes, byte_view, mix, randoms, signed, span_hashes

#: Bytes of a repeated string, and of a sample.
LENGTH, Q = 50, 16
#: Bytes of stretches that are refined at once; a sample's stretches stay together.
AT_ONCE = 1 << 18
#: Bytes of text that one bucket of sampled q-grams stands for.
BUCKET_BYTES = 2_000_000
#: Stretches around one sample from which on their strings are dealt one by one; they are counted in one document of COUNTED.
HOT_STRETCHES, COUNTED = BUCKET_BYTES // (2 * LENGTH), 8
_MULTIPLIERS = dict(zip((1, 2, 4, 8), randoms(41, 4), strict=True))


def short_names(data: np.ndarray) -> np.ndarray:
    """A number for each 16-byte string, which only picks samples and deals out the work; unequal strings may share one."""
    names = byte_codes(data)
    for step, multiplier in _MULTIPLIERS.items():
        if len(names) <= step:
            return np.zeros(0, U64)
        names = names[:-step] * multiplier + names[step:]
    names ^= names >> U64(32)
    names *= U64(0xD6E8FEB86659FD93)
    return names ^ (names >> U64(29))


def _group_starts(keys: np.ndarray) -> np.ndarray:
    """Of each place in sorted `keys` the place where its group of equal keys starts."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))


def _sorted(keys: np.ndarray, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and their places (below n), by key; one number for both is sorted if they fit in it."""
    bits = n.bit_length()
    if len(keys) and int(keys.max()).bit_length() + bits > 63:
        order = np.argsort(keys)
        return keys[order], places[order]
    both = keys << bits
    both |= places
    both.sort()
    return both >> bits, both & ((1 << bits) - 1)


def refine(data: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, buckets): the places of equal LENGTH-byte strings and their bucket pointers, by bucket.

    room: bytes from each place to the end of its stretch. The initial buckets are those of the sorted
    q-grams, q being the bytes that fit in one number; a bucket's pointer is where it starts in the order. A
    bucket of several places is refined by sorting these on the pointers of the places q, then 2q, 4q ...
    bytes on, which earlier refinement has made stand for as many bytes, up to LENGTH. The new buckets take
    pointers within the old one's range, so those of single places never change. Nothing is hashed: equal
    pointers mean equal bytes.
    """
    n, letters = len(data), np.bincount(data, minlength=256) > 0
    codes, bits = (np.cumsum(letters) - 1)[data], max(1, int(letters.sum() - 1).bit_length())
    have = max(1, min(LENGTH // 2, (63 - n.bit_length()) // bits))
    places = np.flatnonzero(room >= have)
    grams = codes[places]
    for k in range(1, have):
        grams = grams << bits | codes[places + k]
    grams, places = _sorted(grams, places, n)
    pointers = np.zeros(n, np.int64)
    pointers[places] = _group_starts(grams)
    while have < LENGTH:
        offset = min(have, LENGTH - have)
        own = pointers[places]
        several = np.bincount(own, minlength=1)[own] > 1
        have += offset
        places = places[several & (room[places] >= have)]
        keys, places = _sorted(pointers[places] * n + pointers[places + offset], places, n)
        own = pointers[places]
        pointers[places] = own + _group_starts(keys) - _group_starts(own)
    return places, pointers[places]


def repeated(bodies: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, lo, hi): what of each stretch a stretch of a smaller document holds as well, in strings of LENGTH bytes.

    Equal strings have equal samples, so stretches are refined sample by sample, many small ones at once.
    """
    sizes = np.array([len(b) for b in bodies], np.int64)
    body, ends = np.frombuffer(b"".join(bodies), np.uint8), np.cumsum(sizes)
    names = np.append(short_names(body), np.full(Q - 1, ~U64(0), U64))
    for k in range(1, Q):
        names[ends - k] = ~U64(0)  # strings over an end
    sample = np.minimum.reduceat(names, ends - sizes)
    order = np.argsort(sample, kind="stable")
    filled, opens, out = np.cumsum(sizes[order]), np.append(_group_starts(sample[order]), len(order)), []
    a = 0
    while a < len(order):
        b = int(np.searchsorted(filled, filled[a] - sizes[order[a]] + AT_ONCE, "right"))
        b = int(opens[b]) if opens[b] > a else int(np.searchsorted(opens, opens[a], "right"))
        own = order[a:b]
        data = np.frombuffer(b"".join([bodies[k] for k in own.tolist()]), np.uint8)
        size, a = sizes[own], b
        end = np.cumsum(size)
        owner = np.repeat(np.arange(len(own)), size)
        places, buckets = refine(data, end[owner] - np.arange(len(data)))
        if not len(places):
            continue
        held, start = docs[own][owner[places]], _group_starts(buckets)
        groups = np.flatnonzero(start == np.arange(len(start)))
        first = np.minimum.reduceat(held, groups)
        hit = np.sort(places[held > np.repeat(first, np.diff(np.append(groups, len(held))))])
        if len(hit):
            who, lo = owner[hit], hit - (end - size)[owner[hit]]
            new = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (lo[1:] > lo[:-1] + 1)]))
            out.append((own[who[new]], lo[new], lo[np.append(new[1:], len(lo)) - 1] + LENGTH))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        values, have = np.minimum(values[:-have], values[have:]), 2 * have
    more = width - have
    return np.minimum(values[:-more], values[more:]) if more else values


def segments(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, sample, first, number) of the runs of consecutive 50-byte strings of a row with one sample.

    Row r is data[bounds[r]:bounds[r + 1]]. The sample of a string is the smallest number among its 35
    16-byte strings', so equal strings have equal samples. Runs are cut to 50 strings at most.
    """
    size = np.diff(bounds)
    strings = np.maximum(size - LENGTH + 1, 0)
    none = np.zeros(0, np.int64)
    if not strings.any():
        return none, np.zeros(0, U64), none, none
    least = _sliding_min(short_names(data), LENGTH - Q + 1)
    rows = np.repeat(np.arange(len(size)), strings)
    at = np.arange(len(rows)) + np.repeat(bounds[:-1] - np.cumsum(strings) + strings, strings)
    least = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (rows[1:] != rows[:-1])
    start = np.flatnonzero(new)
    number = np.diff(np.append(start, len(at)))
    if number.max() > LENGTH:
        parts = -(-number // LENGTH)
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start, number = np.repeat(start, parts) + step * LENGTH, np.minimum(np.repeat(number, parts) - step * LENGTH, LENGTH)
    return rows[start], mix(least[start]), at[start], number


def _ask(parts: int):
    """Rows (part, base, samples, docs, kinds): sampled q-grams of a batch of texts, packed by part of the key space.

    Kind 0: of one document of the batch; 1: of several, sent for the smallest only. The others of these are
    known to be in two documents and not the first: kind 2, dealt by document as nobody has to meet them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_view(batch.column(1))
            keys, docs, ids = [np.zeros(0, U64)], [np.zeros(0, np.int64)], batch.column(0).fill_null(0).to_numpy()
            for a, b in blocks(offsets):
                row, sample, _, _ = segments(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                keys.append(sample)
                docs.append(ids[a:b][row])
            key, doc = np.concatenate(keys), np.concatenate(docs)
            if not len(key):
                continue
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            once = np.ones(len(key), bool)
            once[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            key, doc = key[once], doc[once]
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(start, len(key)))
            several = np.repeat(doc[start + size - 1] > doc[start], size)
            first = doc == np.repeat(doc[start], size)
            kind = np.where(first, several.astype(np.uint8), 2).astype(np.uint8)
            part = np.where(kind == 2, mix(doc.view(U64)) % U64(parts), key % U64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            edges = np.flatnonzero(np.diff(part[order], prepend=-1))
            rows = []
            for a, b in zip(edges, np.append(edges[1:], len(order)), strict=True):
                at = order[a:b]
                base = int(doc[at].min())
                far = int(doc[at].max()) - base >= 1 << 32
                top = key[at] >> U64(24)
                rows.append((int(part[at[0]]), base, far, top.astype(np.uint32).tobytes() + (top >> U64(32)).astype(np.uint8).tobytes(), (doc[at] - base).astype(np.int64 if far else np.uint32).tobytes(), kind[at].tobytes()))
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["part", "base", "far", "samples", "docs", "kinds"])

    return run


def _answer(rows: pa.Table) -> pa.Table:
    """Of one part: for each document its samples that two or more documents have, twice the sample plus 1 if it is the first."""
    keys, docs, kinds = [], [], []
    for base, far, samples, ids, kind in zip(*(rows[c].to_pylist() for c in ("base", "far", "samples", "docs", "kinds")), strict=True):
        n = len(kind)
        keys.append(np.frombuffer(samples, np.uint32, n).astype(np.int64) | np.frombuffer(samples, np.uint8, n, 4 * n).astype(np.int64) << 32)
        docs.append(np.frombuffer(ids, np.int64 if far else np.uint32).astype(np.int64) + base)
        kinds.append(np.frombuffer(kind, np.uint8))
    key, doc, kind = np.concatenate(keys), np.concatenate(docs), np.concatenate(kinds)
    known = kind == 2
    out_doc, out = [doc[known]], [key[known] * 2]
    key, doc, several = key[~known], doc[~known], kind[~known] == 1
    if len(key):
        order = np.lexsort((doc, key))
        key, doc, several = key[order], doc[order], several[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(start, len(key)))
        shared = np.repeat((doc[start + size - 1] > doc[start]) | np.logical_or.reduceat(several, start), size)
        first = doc == np.repeat(doc[start], size)
        out_doc.append(doc[shared])
        out.append((key * 2 + first)[shared])
    doc, value = np.concatenate(out_doc), np.concatenate(out)
    order = np.argsort(doc, kind="stable")
    doc, value = doc[order], value[order]
    start = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])[: len(doc)])
    lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(doc)).astype(np.int32)), pa.array(value))
    return pa.table({"doc_id": pa.array(doc[start], pa.int64()), "samples": lists})


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, row_key, compressed text): what travels between stages is about half of the text."""
    for batch in batches:
        texts = [pa.compress(t, "zstd", asbytes=True) if t else b"" for t in batch.column(2).cast(pa.large_binary()).to_pylist()]
        sizes = pa.array([len(t or "") for t in batch.column(2).cast(pa.large_binary()).to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes, pa.array(texts, pa.binary())], ["doc_id", "row_key", "size", "packed"])


def unpack(size: int, packed: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, size, "zstd", asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sample, n): stretches around each sample that has several in a batch of texts."""
    for batch in batches:
        data, offsets = byte_view(batch.column(0))
        keys = [segments(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])[1] >> U64(24) for a, b in blocks(offsets)]
        key, n = np.unique(np.concatenate([np.zeros(0, U64), *keys]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(signed(key[n > 1])), pa.array(n[n > 1].astype(np.int64))], ["sample", "n"])


def hot_samples(base: DataFrame) -> np.ndarray:
    """The samples, in order, that have about HOT_STRETCHES stretches or more: one in that many stretches at most, so few."""
    some = base.filter(F.col("doc_id").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(COUNTED)) == 0)).select("text")
    found = some.mapInArrow(_tally, "sample long, n long").groupBy("sample").agg(F.sum("n").alias("n")).filter(F.col("n") >= HOT_STRETCHES // COUNTED)
    return np.sort(np.array([r["sample"] for r in found.select("sample").collect()], np.int64))


def _offer(parts: int, hot: Broadcast[np.ndarray]):
    """Of texts with their shared samples, rows (part, docs, rows, at, ends, body, low, high) of the segments to compare.

    Equal segments of a batch are sent for their smallest document only; in the others they are copies for
    certain. These go along as stretches (low, high), joined where they meet, under parts by document.
    Stretches around a hot sample are split into their strings, and each has the part of its own name.
    """
    names = ["part", "docs", "rows", "at", "ends", "body", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [unpack(n, t) for n, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            ids, row_keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            offsets, fields = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64), [[np.zeros(0, np.int64)] for _ in range(7)]
            wanted = batch.column(4)
            for x, y in blocks(offsets):
                data, bounds = np.concatenate(texts[x:y]), offsets[x : y + 1] - offsets[x]
                r, sample, at, number = segments(data, bounds)
                if not len(r):
                    continue
                lists = wanted.slice(x, y - x)
                shared = np.sort((np.repeat(np.arange(y - x), lists.value_lengths().to_numpy()) << 40) | (lists.flatten().to_numpy() >> 1))
                key = (r << 40) | (sample >> U64(24)).astype(np.int64)
                have = np.flatnonzero(shared[np.minimum(np.searchsorted(shared, key), len(shared) - 1)] == key)
                split = np.isin((sample[have] >> U64(24)).astype(np.int64), hot.value)
                pieces = np.where(split, number[have], 1)
                one = np.repeat(np.arange(len(have)), pieces)
                split, have = split[one], have[one]
                r, lo = r[have], at[have] + np.arange(len(one)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                hi = lo + np.where(split, 1, number[have]) + LENGTH - 1
                name = span_hashes(byte_codes(data), lo, hi)
                part = (np.where(split, name, sample[have]) % U64(parts)).astype(np.int64)
                for f, v in zip(fields, (r + x, ids[x:y][r], row_keys[x:y][r], lo - bounds[r], hi - bounds[r], signed(name), part), strict=True):
                    f.append(v.astype(np.int64))
            which, doc, row, a, b, name, part = (np.concatenate(x) for x in fields)
            if not len(doc):
                continue
            order = np.lexsort((doc, name))
            which, doc, row, a, b, name, part = (x[order] for x in (which, doc, row, a, b, name, part))
            start = _group_starts(name)
            copy = doc > doc[start]
            at = offsets[which] + a
            copy[copy] = _same_bytes(np.concatenate(texts), at[copy], at[start[copy]], (b - a)[copy], (b - a)[start[copy]])
            rows = []
            send = np.flatnonzero(~copy)
            send = send[np.argsort(part[send], kind="stable")]
            edges = np.flatnonzero(np.diff(part[send], prepend=-1))
            for x, y in zip(edges, np.append(edges[1:], len(send)), strict=True):
                own = send[x:y]
                body = b"".join(texts[w][i:j].tobytes() for w, i, j in zip(which[own], a[own], b[own], strict=True))
                body = pa.compress(body, "zstd", asbytes=True)
                rows.append((int(part[own[0]]), doc[own], row[own], a[own].astype(np.int32), np.cumsum(b[own] - a[own]).astype(np.int32), body, [], []))
            known = np.flatnonzero(copy)
            known = known[np.lexsort((a[known], which[known]))]
            if len(known):
                w, lo, hi = which[known], a[known], b[known]
                opens = np.concatenate([[True], (w[1:] != w[:-1]) | (lo[1:] > hi[:-1])])
                first = np.flatnonzero(opens)
                last = np.append(first[1:], len(lo)) - 1
                home = (mix(doc[known][first].view(U64)) % U64(parts)).astype(np.int64)
                by = np.argsort(home, kind="stable")
                edges = np.flatnonzero(np.diff(home[by], prepend=-1))
                for x, y in zip(edges, np.append(edges[1:], len(by)), strict=True):
                    own = by[x:y]
                    rows.append((int(home[own[0]]), doc[known][first][own], row[known][first][own], [], [], b"", lo[first][own].astype(np.int32), hi[last][own].astype(np.int32)))
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return run


def _same_bytes(data: np.ndarray, one: np.ndarray, other: np.ndarray, size: np.ndarray, other_size: np.ndarray) -> np.ndarray:
    """Whether the stretches of `data` at `one` and `other`, of 50 bytes or more, are equal."""
    eight = np.ndarray(len(data) - 7, "<u8", data, 0, (1,))  # eight bytes from every place on
    same = size == other_size
    for k in range(0, int(size.max(initial=0)), 8):
        at = np.minimum(k, size - 8)
        near = np.flatnonzero(same)
        same[near] = eight[one[near] + at[near]] == eight[other[near] + at[near]]
    return same


def _compare(table: pa.Table) -> pa.Table:
    """Of one part: (doc_id, row_key, lo, hi) of the stretches that a smaller document has, and those already known."""
    flat = lambda name: np.concatenate([np.zeros(0, np.int64), *[x.values.to_numpy().astype(np.int64) for x in table[name]]])
    known = np.array([len(x) > 0 for x in table["low"].to_pylist()], bool)
    passed = table.filter(pa.array(known))
    pick = lambda t, name: np.concatenate([np.zeros(0, np.int64), *[x.values.to_numpy().astype(np.int64) for x in t[name]]])
    out = [[pick(passed, "docs")], [pick(passed, "rows")], [flat("low")], [flat("high")]]
    sent = table.filter(pa.array(~known))
    docs, rows, at = (pick(sent, n) for n in ("docs", "rows", "at"))
    if len(docs):
        kinds: dict[bytes, int] = {}  # equal stretches are one
        kind, sizes = [], []
        for e, b in zip(sent["ends"], sent["body"].to_pylist(), strict=True):
            e = e.values.to_numpy().tolist()
            body = unpack(e[-1], b).tobytes()
            for i, j in zip([0, *e], e, strict=False):
                kind.append(kinds.setdefault(body[i:j], len(kinds)))
                sizes.append(j - i)
        kind, sizes = np.array(kind), np.array(sizes, np.int64)
        least = np.full(len(kinds), np.iinfo(np.int64).max)
        np.minimum.at(least, kind, docs)
        copy = docs > least[kind]
        for x, v in zip(out, (docs, rows, at, at + sizes), strict=True):
            x.append(v[copy])
        which, lo, hi = repeated(list(kinds), least)
        # What holds for a kind holds for each of its stretches in the kind's smallest document.
        by = np.argsort(which, kind="stable")
        which, lo, hi = which[by], lo[by], hi[by]
        mine = np.flatnonzero(~copy)
        a, b = (np.searchsorted(which, kind[mine], side) for side in ("left", "right"))
        one = np.repeat(mine, b - a)
        take = np.repeat(a, b - a) + np.arange(len(one)) - np.repeat(np.cumsum(b - a) - (b - a), b - a)
        for x, v in zip(out, (docs[one], rows[one], at[one] + lo[take], at[one] + hi[take]), strict=True):
            x.append(v)
    return pa.table({n: pa.array(np.concatenate(x), pa.int64()) for n, x in zip(("doc_id", "row_key", "lo", "hi"), out, strict=True)})


def _cut_packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [unpack(n, t).tobytes() for n, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield from cut(iter([pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary()), batch.column(4)], ["doc_id", "row_key", "text", "spans"])]))


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (doc_id, row_key, text, spans): what is left when the bytes of the spans go."""
    names = ["doc_id", "row_key", "n_removed", "n_spans", "kept_sha256", "kept"]
    for batch in batches:
        data, offsets = byte_view(batch.column(2))
        rows = []
        for r, (doc, row, spans) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3), strict=True)):
            text = data[offsets[r] : offsets[r + 1]]
            step = np.zeros(len(text) + 1, np.int64)
            np.add.at(step, spans.values.field("lo").to_numpy(), 1)
            np.add.at(step, spans.values.field("hi").to_numpy(), -1)
            gone = np.cumsum(step[:-1]) > 0
            kept = text[~gone].tobytes()
            rows.append((doc, row, int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum()), hashlib.sha256(kept).hexdigest(), kept))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [[]] * 6, kinds, strict=True)], names)


def span_lists(spans: DataFrame) -> DataFrame:
    """(span_id, all_spans): the spans of a doc_id, with row_key."""
    span = F.struct("row_key", F.col("lo").cast("int").alias("lo"), F.col("hi").cast("int").alias("hi"))
    return spans.groupBy(F.col("doc_id").alias("span_id")).agg(F.collect_set(span).alias("all_spans"))


def own_spans() -> Column:
    return F.filter("all_spans", lambda s: s["row_key"] == F.col("row_key")).alias("spans")


CUT = "doc_id long, row_key long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def with_cuts(base: DataFrame, changed: DataFrame) -> DataFrame:
    """Every row of `base` (doc_id, row_key, text) with n_bytes, n_removed, n_spans, kept_sha256; `changed` as of `cut`.

    Rows that `changed` lacks keep their text. Equal rows of one doc_id are cut alike.
    """
    changed = changed.groupBy(F.col("doc_id").alias("c_id"), F.col("row_key").alias("c_key")).agg(
        F.first("n_removed").alias("n_removed"), F.first("n_spans").alias("n_spans"), F.first("kept_sha256").alias("cut_sha256")
    )
    text = F.coalesce("text", F.lit(""))
    whole = base.select("doc_id", "row_key", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("whole_sha256"))
    return whole.join(changed, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("row_key") == F.col("c_key")), "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"),
    )


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, text); row_key, 64 bits of hash, tells texts of one doc_id apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("row_key"), F.col("text").cast("string").alias("text"))


def offers(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(packed texts, offered): the texts compressed, and what of them is to be compared, by part."""
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(16, math.ceil(size / BUCKET_BYTES))
    asked = base.select("doc_id", "text").mapInArrow(_ask(parts), "part long, base long, far boolean, samples binary, docs binary, kinds binary")
    shared = asked.groupBy("part").applyInArrow(_answer, "doc_id long, samples array<long>")
    per_doc = shared.groupBy("doc_id").agg(F.flatten(F.collect_list("samples")).alias("samples"))
    packed = base.mapInArrow(pack, "doc_id long, row_key long, size long, packed binary")
    hot = base.sparkSession.sparkContext.broadcast(hot_samples(base))
    offered = packed.join(per_doc.withColumnRenamed("doc_id", "span_id"), F.col("doc_id") == F.col("span_id")).select("doc_id", "row_key", "size", "packed", "samples").mapInArrow(
        _offer(parts, hot), "part long, docs array<long>, rows array<long>, at array<int>, ends array<int>, body binary, low array<int>, high array<int>"
    )
    return packed, offered


def repeated_spans(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(packed texts, spans): the texts compressed, and the stretches in them that a smaller document has."""
    packed, offered = offers(base)
    return packed, offered.groupBy("part").applyInArrow(_compare, "doc_id long, row_key long, lo long, hi long")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Remove what earlier documents have: (doc_id, n_bytes, n_removed, n_spans, kept_sha256), a row for each input row.

    Reads doc_id (whole number) and text, as UTF-8 bytes. A byte goes if some 50-byte string that covers it
    also starts in a document of smaller doc_id; all strings are judged on the input. Every string's sample
    is the least numbered of its 16-byte strings, so equal strings meet under one sample; samples that one
    document has alone are left out first. The stretches around the others are compared part by part of the
    sample space by bucket-pointer refinement (see `refine`), which decides equality by bytes, and the
    smallest document of each last bucket keeps the string.

    A part stands for some 2 MB of text, so parts grow in number and not in size; within a batch equal
    stretches (byte by byte) are sent once, so a text in very many documents comes to one piece a batch. Samples with very many
    stretches (some 20,000, counted beforehand in an eighth of the documents) have each string dealt by its own
    name, so a frequent phrase with different neighbours is spread over all parts. Texts travel compressed.
    Null text is empty. A null doc_id neither gives nor loses anything. Rows of one doc_id don't affect each
    other; each comes back. Texts under 50 bytes stay. Empty input: no rows.
    """
    base = keyed(docs)
    packed, spans = repeated_spans(base)
    cuts = packed.join(span_lists(spans), F.col("doc_id") == F.col("span_id")).select("doc_id", "row_key", "size", "packed", own_spans())
    changed = cuts.mapInArrow(_cut_packed, CUT)
    return with_cuts(base, changed)


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(hex(encode(text)), '') AS h FROM documents),
g AS (SELECT doc_id, unnest(generate_series(0, length(h) // 2 - 50)) AS pos, h FROM d WHERE length(h) >= 100),
s AS (SELECT doc_id, pos, substr(h, 2 * pos + 1, 100) AS string FROM g),
f AS (SELECT string, min(doc_id) AS first_id FROM s GROUP BY string HAVING count(*) > 1),
r AS (SELECT doc_id, pos FROM s JOIN f USING (string) WHERE doc_id > first_id),
o AS (SELECT *, coalesce(pos > lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 50, true)::INT AS opens FROM r),
i AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM o),
p AS (SELECT doc_id, min(pos) AS lo, max(pos) + 50 AS hi FROM i GROUP BY doc_id, span),
q AS (SELECT *, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS since FROM p),
k AS (
  SELECT q.doc_id, sum(hi - lo)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans, max(hi) AS last,
    string_agg(substr(h, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo) AS kept
  FROM q JOIN d ON d.doc_id = q.doc_id GROUP BY q.doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""
