"""Fill-in-the-middle texts: lines dealt to prefix, middle and suffix by Arrow kernels, a batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.bytesops import blocks, byte_view

# The marks of prefix, suffix and middle, and the seed of the digest that deals the cuts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7


def draws(doc_id: Column, seed: int = SEED, n: int = 4) -> list[Column]:
    """The first n groups of eight hex digits of a document's digest, as whole numbers; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(n)]


def _remainder(values: pa.Array, by: pa.Array | int) -> pa.Array:
    return pc.subtract(values, pc.multiply(pc.divide(values, by), by))


def _texts(column: pa.Array) -> Iterator[pa.Array]:
    """Pieces of a text column, nulls as empty texts, each of about a block of bytes or of one longer text."""
    _, offsets = byte_view(column)
    text = pc.fill_null(column.cast(pa.string()), "")
    for a, b in blocks(offsets):
        yield text.slice(a, b - a)


def _units(text: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """The lines of all texts in one array, each with its text's row and its ordinal there, and every text's number of lines."""
    pieces = pc.split_pattern(text, pattern="\n")
    length = pc.list_value_length(pieces).cast(pa.int64())
    row, piece = pc.list_parent_indices(pieces).cast(pa.int64()), pc.list_flatten(pieces)
    starts = pc.subtract(pc.cumulative_sum(length), length)
    ordinal = pc.subtract(pa.array(np.arange(len(piece))), pc.take(starts, row))
    last = pc.equal(ordinal, pc.subtract(pc.take(length, row), 1))
    unit = pc.if_else(last, piece, pc.binary_join_element_wise(piece, "\n", ""))
    real = pc.not_equal(unit, "")  # what stands behind a final line end is no line
    row, unit, ordinal = (pc.filter(x, real) for x in (row, unit, ordinal))
    return row, unit, ordinal, pa.array(np.bincount(row.to_numpy(), minlength=len(text)))


def _joined(row: pa.Array, unit: pa.Array, role: pa.Array, n: int) -> pa.Array:
    """The units that have the role, put together again for each of the n texts."""
    row, unit = pc.filter(row, role), pc.filter(unit, role)
    edges = np.concatenate([[0], np.cumsum(np.bincount(row.to_numpy(), minlength=n))])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), unit), "")


def _dealer(rate: int, spm: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for text in _texts(batch.column(1)):
                ids, h1, h2, h3, h4 = (batch.column(c).slice(at, len(text)) for c in (0, 2, 3, 4, 5))
                at += len(text)
                row, unit, ordinal, n = _units(text)
                places = pc.add(n, 1)
                one, two = _remainder(h1, places), _remainder(h2, places)
                first, second = (pc.take(cut, row) for cut in (pc.min_element_wise(one, two), pc.max_element_wise(one, two)))
                in_prefix, in_suffix = pc.less(ordinal, first), pc.greater_equal(ordinal, second)
                in_middle = pc.invert(pc.or_(in_prefix, in_suffix))
                prefix, middle, suffix = (_joined(row, unit, role, len(text)) for role in (in_prefix, in_middle, in_suffix))
                marked = [pc.match_substring(text, mark) for mark in (PREFIX, SUFFIX, MIDDLE)]
                plain = pc.greater_equal(_remainder(h3, 100), rate)
                for reason in (pc.equal(text, ""), *marked):
                    plain = pc.or_(plain, reason)
                is_spm = pc.less(_remainder(h4, 100), spm)
                psm_text = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
                spm_text = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
                form = pc.if_else(plain, "plain", pc.if_else(is_spm, "spm", "psm"))
                output = pc.if_else(plain, text, pc.if_else(is_spm, spm_text, psm_text))
                none = pa.scalar(None, pa.int64())
                chars = [pc.if_else(plain, none, pc.utf8_length(part).cast(pa.int64())) for part in (prefix, middle)]
                yield pa.RecordBatch.from_arrays([ids, n, form, *chars, output], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return deal


def fill_in_middle(docs: DataFrame, rate: int = 100, spm: int = 50, seed: int = SEED) -> DataFrame:
    """Texts with their middle at the end: (doc_id, n, form, prefix_chars, middle_chars, output), one row for each input row.

    Reads doc_id and text. A text is cut into its n lines, each with its line end. Two numbers of the document's
    digest, modulo n + 1, say after how many lines prefix and middle end; two more whether it is changed at all
    (`rate` in a hundred) and into which order (`spm` in a hundred of these): psm is <P>prefix<S>suffix<M>middle, spm
    <S>suffix<P>prefix<M>middle. So the outcome depends on id and text only, however rows are dealt. Lengths count code points.

    A batch is one pipeline of Arrow kernels over some 256 KB of texts: lines are split into lists, flattened
    with the row of their text, numbered, filtered by role, made into lists again and joined; nothing is shuffled.
    Null and empty texts, and texts that hold one of the three marks, stay as they are: plain, with null lengths.
    A null doc_id draws like an empty one; rows of one doc_id have the same draws, whatever their texts. There
    is no order, so no ties. A very long text is one step of a task, of up to 2 GB. Other columns aren't read.
    Empty input: no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[h.alias(f"h{k}") for k, h in enumerate(draws(F.col("doc_id"), seed), 1)])
    return rows.mapInArrow(_dealer(rate, spm), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(changed: DataFrame) -> DataFrame:
    """`changed` (form and output among its columns) with the column restored: the text as it was.

    Marks are found by splitting at them: no part holds one, and none can arise where a part meets a mark.
    Null output is null; a form other than psm and spm, or output without its three marks, is left as it is. A column
    restored is replaced.
    """
    kept = [c for c in changed.columns if c != "restored"]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in changed.schema if f.name in kept]

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, form = 0, batch.column(kept.index("form"))
            for output in _texts(batch.column(kept.index("output"))):
                own, rows = batch.slice(at, len(output)), form.slice(at, len(output))
                at += len(output)
                one_mark = pc.replace_substring(pc.replace_substring(output, PREFIX, SUFFIX), MIDDLE, SUFFIX)
                moved = pc.and_(pc.is_in(rows, value_set=pa.array(["psm", "spm"])), pc.equal(pc.count_substring(one_mark, SUFFIX), 3))
                parts = pc.split_pattern(pc.if_else(moved, one_mark, SUFFIX * 3), pattern=SUFFIX)
                one, two, middle = (pc.list_element(parts, k) for k in (1, 2, 3))
                is_spm = pc.equal(rows, "spm")
                psm_text, spm_text = (pc.binary_join_element_wise(a, middle, b, "") for a, b in ((one, two), (two, one)))
                text = pc.if_else(moved, pc.if_else(is_spm, spm_text, psm_text), output)
                text = pc.if_else(pc.is_valid(own.column(kept.index("output"))), text, pa.scalar(None, pa.string()))
                yield pa.RecordBatch.from_arrays([*own.columns, text], [*kept, "restored"])

    return changed.select(*[f"`{c}`" for c in kept]).mapInArrow(rebuild, ", ".join([*fields, "restored string"]))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
d AS (
  SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM d),
p AS (
  SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM c),
o AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END AS output FROM p)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(output) AS output_sha256, sha256(text) AS restored_sha256 FROM o
"""
