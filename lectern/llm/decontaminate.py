"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit check."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.bytesops import U64, blocks, byte_view, mix, randoms, words
from lectern.llm.shared import WORD

#: Word edits that a copy may have, as a share of the item's words, and the share of such copies to find.
EDIT_SHARE, TARGET_RECALL = 0.2, 0.95
#: Window lengths in words; a suffix of an item is indexed by the longest that it fills, if that is a quarter of the item or more.
WINDOWS = (4, 8, 16, 32)
#: Items of more words have 128 to 256 of the longest windows indexed, evenly spread. Items shorter than any window are looked up whole.
LONG = 4 * WINDOWS[-1]
#: Independent walks of the embedding, symbols sampled for a key, items and words that one broadcast index holds at most.
WALKS, SAMPLED, ITEMS_AT_ONCE, WORDS_AT_ONCE = 4, 4, 5000, 250_000
#: Pairs whose edits are counted in step, and words of their regions.
_PAIRS_AT_ONCE, _CELLS = 512, 1 << 17
#: Bits of a hash that the bit maps before the exact look-ups take: of each key's table, and of seeds and words.
_KEY_BITS, _WORD_BITS = 18, 20


def repetitions(share: float = EDIT_SHARE, recall: float = TARGET_RECALL) -> int:
    """Keys needed: sampled symbols all agree with probability (1 - 2 share)**SAMPLED, as a word edit moves about two of the walk's symbols."""
    return math.ceil(math.log(1 - recall) / math.log(1 - (1 - 2 * share) ** SAMPLED))


def _plan() -> list[tuple[int, int, list[int]]]:
    """(window, walk, sampled steps) of every key."""
    draw = np.random.default_rng(31)
    each = -(-repetitions() // WALKS)
    return [(w, t, sorted(draw.choice(w + w // 2, SAMPLED, replace=False).tolist())) for w in WINDOWS for t in range(WALKS) for _ in range(each)]


_PLAN = _plan()
_SALT = randoms(32, SAMPLED + 1)


def _coins(symbols: np.ndarray) -> list[np.ndarray]:
    """For every walk, 64 coins of each symbol."""
    return [mix(symbols + U64(2 * walk + 1)) for walk in range(WALKS)]


def _keys(symbols: np.ndarray, coins: list[np.ndarray], starts: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the key, its values) for the window of `window` words at each start.

    CGK walk: at every step the symbol under the pointer is put out, and a fair coin that depends on walk,
    step and symbol alone moves the pointer on. Past the window's end a blank is put out.
    """
    ends, last = starts + window, len(symbols) - 1
    for walk in range(WALKS):
        steps = [(k, at) for k, (w, t, at) in enumerate(_PLAN) if (w, t) == (window, walk)]
        wanted = {s for _, at in steps for s in at}
        pointer, seen = starts.copy(), {}
        for step in range(max(wanted) + 1):
            at = np.minimum(pointer, last)
            if step in wanted:
                seen[step] = np.where(pointer < ends, symbols[at], U64(0))
            pointer += ((coins[walk][at] >> U64(step)) & U64(1)).astype(np.int64)
        for k, at in steps:
            key = np.full(len(starts), _SALT[-1] * np.uint64(1), U64) * U64(k + 1)
            for n, s in enumerate(at):
                key += seen[s] * _SALT[n]
            yield k, mix(key)


def _top(values: np.ndarray, bits: int) -> np.ndarray:
    return (values >> U64(64 - bits)).astype(np.int64)


def _bitmap(values: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(1 << bits, bool)
    out[_top(values, bits)] = True
    return out


def _pairs(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes[:-1] * _SALT[0] + hashes[1:] * _SALT[1]) if len(hashes) > 1 else np.zeros(0, U64)


def _grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive words."""
    out = np.zeros(max(0, len(hashes) - n + 1), U64)
    for k in range(n):
        out += hashes[k : k + len(out)] * _SALT[k]
    return mix(out)


@dataclass
class Index:
    """The windows of a bounded number of items, by LSH key."""

    ids: list[int]
    items: list[np.ndarray]
    tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # a key's sorted values, item, offset
    seeds: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    short: list[tuple[int, np.ndarray, np.ndarray]] = field(default_factory=list)  # words, sorted hashes of whole items, item

    def build(self) -> Index:
        self.seeds = np.unique(np.concatenate([_pairs(x) for x in self.items] + [np.zeros(0, U64)]))
        found: dict[int, list] = {k: [] for k in range(len(_PLAN))}
        for i, item in enumerate(self.items):
            coins = _coins(item)
            for w, longer in zip(WINDOWS, (*WINDOWS[1:], 1 << 30), strict=True):
                starts = np.arange(max(0, len(item) - longer + 1), max(0, len(item) - w + 1))
                if len(item) > LONG and w == WINDOWS[-1]:
                    starts = starts[:: len(item) // LONG]
                elif 4 * w < len(item):
                    continue
                for k, values in _keys(item, coins, starts, w) if len(starts) else ():
                    found[k].append((values, np.full(len(starts), i), starts))
        for k in range(len(_PLAN)):
            parts = found[k] or [(np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
            values, item, offset = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(values, kind="stable")
            self.tables.append((values[order], item[order], offset[order]))
        for n in range(1, WINDOWS[0]):
            item = np.array([i for i, x in enumerate(self.items) if len(x) == n], np.int64)
            if len(item):
                values = np.concatenate([_grams(self.items[i], n) for i in item])
                order = np.argsort(values, kind="stable")
                self.short.append((n, values[order], item[order]))
        return self

    def prepare(self) -> None:
        """Bit maps, made in each task rather than sent."""
        if not hasattr(self, "maps"):
            self.maps = [_bitmap(t[0], _KEY_BITS) if len(t[0]) else None for t in self.tables]
            self.seed_map = _bitmap(self.seeds, _WORD_BITS)
            self.sizes = np.array([len(x) for x in self.items], np.int64)
            self.salts = mix(np.arange(1, len(self.items) + 1).astype(U64))
            self.words = _bitmap(np.concatenate([mix(x ^ s) for x, s in zip(self.items, self.salts, strict=True)] + [np.zeros(0, U64)]), _WORD_BITS)

    def candidates(self, symbols: np.ndarray, rows: np.ndarray, row_ends: np.ndarray) -> np.ndarray:
        """Distinct (row, item, word at which it would start) of all windows that share a key with an indexed one."""
        pairs = _pairs(symbols)
        at = np.flatnonzero(self.seed_map[_top(pairs, _WORD_BITS)])
        if len(at):
            near = np.minimum(np.searchsorted(self.seeds, pairs[at]), len(self.seeds) - 1)
            at = at[self.seeds[near] == pairs[at]]
        room = row_ends[rows[at]] - at
        at, room, out = at[room > 1], room[room > 1], [np.zeros(0, np.int64)]
        coins = _coins(symbols) if len(at) else []
        for w in WINDOWS:
            starts = at[room >= w]
            for k, values in _keys(symbols, coins, starts, w) if len(starts) else ():
                table, item, offset = self.tables[k]
                if not len(table):
                    continue
                maybe = np.flatnonzero(self.maps[k][_top(values, _KEY_BITS)])
                low, high = (np.searchsorted(table, values[maybe], side) for side in ("left", "right"))
                n = high - low
                hit = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = np.repeat(starts[maybe], n)
                out.append(((rows[start] * len(self.items) + item[hit]) << 32) + start - offset[hit] + (1 << 31))
        packed = np.unique(np.concatenate(out))
        pair, start = packed >> 32, (packed & ((1 << 32) - 1)) - (1 << 31)
        return np.stack([pair // len(self.items), pair % len(self.items), start], 1) if len(packed) else np.zeros((0, 3), np.int64)

    def exact(self, symbols: np.ndarray, rows: np.ndarray, row_ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row, item, word) of the first place in each row of every item that is shorter than any window."""
        for n, table, item in self.short:
            values = _grams(symbols, n)
            starts = np.flatnonzero(row_ends[rows[: len(values)]] - np.arange(len(values)) >= n)
            low, high = (np.searchsorted(table, values[starts], side) for side in ("left", "right"))
            count = high - low
            hit = item[np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
            start = np.repeat(starts, count)
            _, at = np.unique(rows[start] * len(self.items) + hit, return_index=True)
            yield rows[start[at]], hit[at], start[at]

    def merged(self, found: np.ndarray) -> np.ndarray:
        """(row, item, first and last word at which it would start): starts that a long item's slack covers make one candidate."""
        row, item, at = found.T
        near = at // np.where(self.sizes[item] > LONG, np.maximum((EDIT_SHARE * self.sizes[item]).astype(np.int64), 1), 1)
        opens = np.ones(len(found), bool)
        opens[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (near[1:] != near[:-1])
        start = np.flatnonzero(opens)
        return np.column_stack([found[start], at[np.append(start[1:], len(found)) - 1] if len(found) else at])

    def plausible(self, found: np.ndarray, symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Candidates, by the item's size, whose region has words of the item's own often enough; fewer can't be within the edits."""
        found = self.merged(found)
        found = found[np.argsort(self.sizes[found[:, 1]], kind="stable")]
        edges = np.searchsorted(self.sizes[found[:, 1]], [0, *(LONG << k for k in range(32))], "right")
        return np.concatenate([self._plausible(found[a:b], symbols, first) for a, b in zip(edges, edges[1:], strict=False)])

    def _plausible(self, found: np.ndarray, symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
        if not len(found):
            return found
        row, item, at, till = found.T
        slack = (EDIT_SHARE * self.sizes[item]).astype(np.int64)
        low, high = np.maximum(first[row], at - slack), np.minimum(first[row + 1], till + self.sizes[item] + slack)
        seen = np.zeros(len(found), np.int64)
        for step in range(int((high - low).max())):
            here = np.minimum(low + step, len(symbols) - 1)
            seen += self.words[_top(mix(symbols[here] ^ self.salts[item]), _WORD_BITS)] & (low + step < high)
        return found[seen >= self.sizes[item] - slack]


def edit_distances(patterns: list[np.ndarray], regions: list[np.ndarray]) -> np.ndarray:
    """Fewest word edits between each pattern and any stretch of its region; all pairs in step."""
    n, wide = max(map(len, patterns)), max(map(len, regions))
    p, r = np.zeros((len(patterns), n), U64), np.full((len(regions), wide), 1, U64)
    for k, (x, y) in enumerate(zip(patterns, regions, strict=True)):
        p[k, : len(x)], r[k, : len(y)] = x, y
    sizes, along = np.array([len(x) for x in patterns]), np.arange(wide + 1)
    row, out = np.zeros((len(patterns), wide + 1), np.int64), np.zeros(len(patterns), np.int64)
    for i in range(n):
        new = row + 1
        np.minimum(new[:, 1:], row[:, :-1] + (r != p[:, i : i + 1]), out=new[:, 1:])
        row = np.minimum.accumulate(new - along, axis=1) + along
        out = np.where(sizes == i + 1, row.min(1), out)
    return out


def _search(index: Index, symbols: np.ndarray, rows: np.ndarray, n: int) -> list[tuple[int, int, int, int]]:
    """(row, item, edits, first word) of every item that a row holds, each with its best place."""
    first = np.searchsorted(rows, np.arange(n + 1))
    found = index.plausible(index.candidates(symbols, rows, first[1:]), symbols, first)
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for r, i, at in index.exact(symbols, rows, first[1:]):
        best.update(zip(zip(r.tolist(), i.tolist(), strict=True), zip([0] * len(r), (at - first[r]).tolist(), strict=True), strict=True))
    part = 0
    while part < len(found):
        widest = 2 * int(index.sizes[found[min(part + _PAIRS_AT_ONCE, len(found)) - 1, 1]])
        end = part + max(1, min(_PAIRS_AT_ONCE, _CELLS // widest))
        some, regions, patterns = found[part:end].tolist(), [], []
        part = end
        for r, i, at, till in some:
            slack = int(EDIT_SHARE * len(index.items[i]))
            patterns.append(index.items[i])
            regions.append(symbols[max(first[r], at - slack) : min(first[r + 1], till + len(index.items[i]) + slack)])
        for (r, i, at, _), edits in zip(some, edit_distances(patterns, regions).tolist(), strict=True):
            if edits <= int(EDIT_SHARE * len(index.items[i])):
                place = (edits, max(0, at - int(first[r])))
                best[r, i] = min(best.get((r, i), place), place)
    return [(r, i, *place) for (r, i), place in best.items()]


def _indexes(benchmark: DataFrame) -> Iterator[Broadcast[Index]]:
    """The benchmark's items in blocks, each as a broadcast index of bounded size."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower(F.col("text").cast("string")).alias("text")).filter("item_id is not null and text is not null")
    n_items, n_words = items.agg(F.count("*"), F.coalesce(F.sum(F.regexp_count("text", F.lit(WORD))), F.lit(0))).first()
    parts = max(1, -(-n_items // ITEMS_AT_ONCE), -(-n_words // WORDS_AT_ONCE))
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).toArrow()
        data, offsets = byte_view(rows["text"])
        hashes, row, _, _ = words(data[offsets[0] : offsets[-1]], offsets - offsets[0])
        yield spark.sparkContext.broadcast(Index(rows["item_id"].to_pylist(), np.split(hashes, np.searchsorted(row, np.arange(1, rows.num_rows)))).build())


def _found(index: Index, texts: pa.Array) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, edits, first word) of the items that lower-case texts hold."""
    index.prepare()
    data, offsets = byte_view(texts)
    for a, b in blocks(offsets, 1 << 20):
        hashes, row, _, _ = words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        for r, i, edits, at in _search(index, hashes, row, b - a):
            yield a + r, i, edits, at


def find_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Benchmark items that documents hold: (doc_id, item_id, edits, item_words, first_word), a row for each pair.

    docs: doc_id, text; benchmark: item_id, text. Words are compared in lower case. A document holds an
    item of n words if some stretch of it is at most floor(0.2 n) word edits away. Every pair of adjacent
    words that some item has is a seed (so few edits leave some seed of an item whole); from each seed the
    document's windows of 4, 8, 16 and 32 words are embedded by CGK walks and looked up, by repeated samples
    of the embedding, among the windows of the items: of each suffix of an item the longest that it fills. What
    agrees in any of the keys is confirmed by the exact edit distance. Items of over 128 words have 128 to 256 windows
    of 32 words indexed, evenly spread, since walks over longer windows lose step at so many edits (README).
    Items of fewer than four words allow no edit and are looked up whole, at every word; empty items and texts
    and nulls match nothing. Rows of one doc_id are merged, equal item ids too, each with its fewest edits (ties:
    the first place); null doc_ids are one. A very long text is one step of a task; other columns aren't read.
    Items are indexed in blocks of some 5000, and of some 250,000 words, so that what is broadcast stays
    bounded, and every block looks at all documents.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"))
    total = None
    for index in _indexes(benchmark):

        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = [(batch.column(0)[r].as_py(), index.value.ids[i], edits, len(index.value.items[i]), at) for r, i, edits, at in _found(index.value, batch.column(1))]
                columns = list(zip(*out, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "edits", "item_words", "first_word"])

        found = texts.mapInArrow(search, "doc_id long, item_id long, edits long, item_words long, first_word long")
        total = found if total is None else total.union(found)
    best = F.min(F.struct("edits", "item_words", "first_word"))
    return total.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that hold no benchmark item (see `find_items`); no shuffle.

    Each row is judged by its own text, whatever its doc_id: null, or shared with a row that goes.
    """
    for index in _indexes(benchmark):

        def keep(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(len(batch), bool)
                clean[[r for r, *_ in _found(index.value, batch.columns[-1])]] = False
                kept = batch.filter(pa.array(clean))
                yield pa.RecordBatch.from_arrays(kept.columns[:-1], kept.schema.names[:-1])

        docs = docs.select("*", F.lower(F.col("text").cast("string")).alias("lower case")).mapInArrow(keep, docs.schema)
    return docs
