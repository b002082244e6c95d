"""Rule tables of thousands of regexes: which texts can match which rule is told by an equi-join on what each regex requires."""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator, Sequence
from re import _constants as op
from re import _parser

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.keyed import one_per_key
from lectern.operators.rules import winners
from lectern.operators.tables import kept

#: Bytes of the pieces that texts and rules meet by, long ones first.
PIECES = (32, 16, 8, 4)
#: Bits of the filter that tells which pieces some rule goes by: 2 MB, however many rules there are.
FILTER_BITS = 1 << 24
#: Bytes that one step of the piece search works on.
_BLOCK = 1 << 20
#: What the parser of this process and that of the matching engine may read differently: such a pattern has no literal here.
_UNSURE = re.compile(r"\(\?[a-zA-Z-]*[uxdaLU]|&&|\[[^\]]*\[|\\0|\\v|\\Q|\\N")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class _Runs:
    """Runs of characters that stand side by side in every match."""

    def __init__(self) -> None:
        self.done: list[str] = []
        self.open = ""

    def end(self) -> None:
        self.done.append(self.open)
        self.open = ""

    def follow(self, items: Sequence) -> None:
        for kind, arg in items:
            if kind is op.LITERAL:
                self.open += chr(arg)
            elif kind is op.SUBPATTERN and not arg[1] and not arg[2]:
                self.follow(arg[3])
            elif kind is op.ATOMIC_GROUP:
                self.follow(arg)
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and arg[0] >= 1:
                self.follow(arg[2])  # the first time stands right behind what is before
                if arg[1] != 1:
                    self.end()
            elif kind not in (op.AT, op.ASSERT, op.ASSERT_NOT):  # these take no characters
                self.end()


def required_literals(pattern: str) -> list[str]:
    """The runs of characters, A-Z as a-z, that every match of the pattern holds; none if none is known."""
    if _UNSURE.search(pattern):
        return []
    runs = _Runs()
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("error")
            runs.follow(_parser.parse(re.sub(r"\(\?<(?=[A-Za-z])", "(?P<", pattern)))
    except (re.error, RecursionError, OverflowError, Warning):
        return []
    runs.end()
    return [r.translate(str.maketrans(_UPPER, _LOWER)) for r in runs.done if r]


def _folded(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BYTES = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _piece_hashes(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, hashes) of the pieces of each length at every place; row r is data[bounds[r]:bounds[r + 1]], A-Z as a-z."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    left = bounds[1:][rows] - np.arange(len(data))
    h, width = _BYTES[_FOLD[data]], 1
    while width < PIECES[0]:
        nearer, farther = h.copy(), h[width:] * _MIX
        nearer ^= nearer >> np.uint64(29)
        nearer[: len(farther)] += farther ^ (farther >> np.uint64(32))
        h, width = nearer * _MIX, 2 * width
        if width in PIECES:
            whole = left >= width
            yield width, rows[whole], (h ^ (h >> np.uint64(31)))[whole]


def _blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, bounds) of consecutive rows of a text column, some _BLOCK bytes at once; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if at[-1] > at[0] else np.zeros(0, np.uint8)
    start = 0
    while start < len(column):
        end = max(start + 1, int(np.searchsorted(at, at[start] + _BLOCK, "right")) - 1)
        yield start, data[at[start] : at[end]], at[start : end + 1] - at[start]
        start = end


def _distinct(rows: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((piece, rows))
    rows, piece = rows[order], piece[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (piece[1:] != piece[:-1])
    return rows[new], piece[new]


def _place(piece: np.ndarray) -> np.ndarray:
    return (piece & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def rule_index(rules: DataFrame) -> DataFrame:
    """Each rule (rule_no, priority, match_rx) with its literals and the piece of them that the fewest rules have, ties by the longer, then the smaller hash.

    A piece is 4, 8, 16 or 32 bytes side by side, known by a hash. Rules whose pattern requires no run of 4 bytes have a null piece. Written once;
    reuse it for every batch of texts.
    """

    def literals(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part.assign(literals=part["match_rx"].map(required_literals))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in _blocks(batch.column(1)):
                for width, rows, piece in _piece_hashes(data, bounds):
                    rows, piece = _distinct(rows, piece)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(first + rows)), pa.array(np.full(len(rows), width, np.int32)), pa.array(piece.view(np.int64))], ["rule_no", "width", "piece"])

    own = rules.select("rule_no", "priority", "match_rx").filter("match_rx is not null")
    own = kept(own.mapInPandas(literals, "rule_no int, priority int, match_rx string, literals array<string>"), "rule-literals")
    found = own.select("rule_no", F.explode("literals").alias("literal")).mapInArrow(pieces, "rule_no int, width int, piece long").distinct()
    rare = found.join(found.groupBy("piece").agg(F.count("*").alias("n")).hint("merge"), "piece")
    rare = one_per_key(rare, ["rule_no"], [F.col("n"), F.col("width").desc(), F.col("piece")]).select("rule_no", "piece")
    return kept(own.join(rare.hint("merge"), "rule_no", "left"), "rule-index")


def _piece_filter(index: DataFrame) -> np.ndarray:
    """Which places of FILTER_BITS the pieces of the rules fall on: put together by tasks, 512 rows of 4 KB at most."""
    place = F.col("piece").bitwiseAND(FILTER_BITS - 1)
    parts = index.filter("piece is not null").groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    size = 8 * 4096
    held = np.zeros(FILTER_BITS + size, bool)
    for r in parts:
        # bucket n holds the places from (n - 1) * size + 1 on, and bucket 0 those up to 0
        held[max(0, r["bucket"] * size - size + 1) :][:size] |= np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little").view(bool)
    return np.packbits(held[:FILTER_BITS])


def _text_pieces(texts: DataFrame, index: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, piece): the distinct pieces of each text (key, _text) that the filter of the rules' pieces lets through."""
    bits = texts.sparkSession.sparkContext.broadcast(_piece_filter(index))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.unpackbits(bits.value).view(bool)
        for batch in batches:
            for first, data, bounds in _blocks(batch.column(len(key))):
                for _, rows, piece in _piece_hashes(data, bounds):
                    there = held[_place(piece)]
                    rows, piece = _distinct(rows[there], piece[there])
                    if len(rows):
                        at = pa.array(first + rows)
                        yield pa.RecordBatch.from_arrays([*[batch.column(i).take(at) for i in range(len(key))], pa.array(piece.view(np.int64))], [*key, "piece"])

    own = texts.select(*key, "_text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.select(*key).schema.fields)
    return own.mapInArrow(pieces, f"{kinds}, piece long")


def candidates(texts: DataFrame, index: DataFrame, text: str, key: Sequence[str]) -> DataFrame:
    """(key, text, rule_no, priority, match_rx): the pairs that a regex has to decide.

    A text meets the rules whose piece it holds, by an equi-join of keys and pieces, so that no text is repeated; of these stay those
    whose whole literal it holds. Pieces that no rule goes by are left out before, by a filter of fixed size. The rules are shuffled, never
    broadcast, since there may be very many. Rules without piece meet every text, so they should be few; they are written by themselves,
    so that Spark sees how small they are, and broadcasts them only below its own limit.
    """
    own = texts.select(*key, F.col(text).alias("_text")).filter("_text is not null")
    with_piece = index.filter("piece is not null")
    met = _text_pieces(own, index, key).join(with_piece.hint("merge"), "piece").drop("piece")
    held = met.join(own.hint("merge"), list(key)).withColumn("_folded", _folded(F.col("_text"))).filter(F.forall("literals", lambda x: F.col("_folded").contains(x)))
    loose = kept(index.filter("piece is null").select("rule_no", "priority", "match_rx"), "rules-without-piece")
    apart = own.join(loose, F.expr("length(_text) >= 0 or length(match_rx) < 0"))
    columns = [*key, "_text", "rule_no", "priority", "match_rx"]
    return held.select(*columns).unionByName(apart.select(*columns)).withColumnRenamed("_text", text)


def match_rules_indexed(texts: DataFrame, rules: DataFrame, text: str, key: Sequence[str], case_sensitive: bool = False, index: DataFrame | None = None) -> DataFrame:
    """(key, rule_no, priority, n_matches, n_best) of each matched text, as `match_rules_joined` has them, for thousands of rules.

    A regex is tried only on texts that hold what it requires (`candidates`). `key` identifies a text. Give `index` to
    use the index of an earlier call.
    """
    pattern = F.concat(F.lit("" if case_sensitive else "(?i)"), F.col("match_rx"))
    pairs = candidates(texts, rule_index(rules) if index is None else index, text, key)
    return winners(pairs.filter(F.rlike(F.col(text), pattern)), key)
