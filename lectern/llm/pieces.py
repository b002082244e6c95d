"""Encoding by the merges of a SentencePiece model, with a table of every prefix's last token."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.bytesops import blocks, byte_view

MODEL = "piece_bpe_32k.model"
#: What stands for a blank inside a model.
BLANK = "▁"
#: Entries of a worker's tables of short stretches and of pairs in each of two generations: memory, not results.
MEMO, PAIRS = 1 << 18, 1 << 19
#: Stretches up to this length are remembered.
SHORT = 48


class Pieces:
    """A merge-type SentencePiece model: its pieces, the automaton that finds them, and which pairs of them can meet.

    The model's merging takes the adjacent pair whose joined piece scores best, the leftmost among equals, until none is
    left. What it makes of a text is a sequence in which every two neighbours, merged by themselves, stay the two that they are;
    and there is only one such sequence, since within two neighbours merges come in the same order as in the text.
    So the last token of a prefix is the one piece that ends it and can follow the last token of what is before it.
    """

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.library = model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        ids = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.text = {i: model.id_to_piece(i) for i in ids}
        self.id = {p: i for i, p in self.text.items()}
        self.score = {p: model.get_score(i) for p, i in self.id.items()}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.begin, self.end = model.bos_id(), model.eos_id()
        self.chars = chars = {c for p in self.id for c in p}
        if not all(model.is_byte(b) for b in self.bytes) or any(c not in self.id for c in chars) or any(model.is_unused(i) for i in ids) or self._unigram():
            raise ValueError("not a model of merges with bytes for unknown characters")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        # A text may be cut wherever no piece has the two characters side by side, so around unknown ones too.
        self.beside = {a + b for p in self.id for a, b in zip(p, p[1:], strict=False)}
        self.words = "\n" not in self.id and not any(pair[1] == BLANK and pair[0] != BLANK for pair in self.beside)
        self.size, self.whole = n, {}
        self.pairs, self.old_pairs, self.seen, self.old_seen = {}, {}, {}, {}

    def _unigram(self) -> bool:
        """Whether scores are log probabilities and no ranks of merges: then joining isn't by best score."""
        return not all(float(s).is_integer() for s in self.score.values())

    def merged(self, text: str) -> list[str]:
        """What merging makes of a short stretch, merge by merge."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, 0
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def alone(self, token: int) -> bool:
        """Whether merging makes the piece of just its characters."""
        found = self.whole.get(token)
        if found is None:
            found = self.whole[token] = len(self.merged(self.text[token])) == 1
        return found

    def meet(self, key: int) -> bool:
        """Whether two pieces, left * size + right, stay as they are when they stand side by side; remembered."""
        found = self.old_pairs.get(key)
        if found is None:
            left, right = (self.text[t] for t in divmod(key, self.size))
            found = self.merged(left + right) == [left, right]
        if len(self.pairs) >= PAIRS:
            self.pairs, self.old_pairs = {}, self.pairs
        self.pairs[key] = found
        return found

    def prefix_table(self, stretch: str) -> tuple[list[int], list[int]]:
        """For every prefix of a stretch of known characters its last token, and that one's length."""
        size, known, whole, n = self.size, self.pairs.get, self.whole.get, len(stretch) + 1
        last, lengths, done = [0] * n, [0] * n, 0
        for at, (token, length) in self.automaton.iter(stretch):
            if at >= done:  # the prefix that ends here has no token yet
                if length > at:
                    fits = whole(token)
                    if fits is None:
                        fits = self.alone(token)
                else:
                    key = last[at + 1 - length] * size + token
                    fits = known(key)
                    if fits is None:
                        fits, known = self.meet(key), self.pairs.get
                if fits:
                    done = at + 1
                    last[done], lengths[done] = token, length
        return last, lengths

    def read_off(self, part: str) -> tuple[int, ...]:
        """The tokens of a part of known characters, from the end of its prefix table; bytes for one unknown character."""
        if part[0] not in self.chars:
            return tuple(self.bytes[b] for b in part.encode())
        (last, lengths), found, at = self.prefix_table(part), [], len(part)
        while at:
            found.append(last[at])
            at -= lengths[at]
        return tuple(found[::-1])

    def tokens(self, stretch: str) -> tuple[int, ...]:
        """The tokens of a stretch: of what is before its last cut, and of the rest part by part; remembered if it is short."""
        found = self.old_seen.get(stretch)
        if found is None:
            beside, end = self.beside, len(stretch)
            while end > 1 and stretch[end - 2 : end] not in beside:
                end -= 1
            if self.chars.issuperset(stretch[:end]):
                parts = [stretch[:end], *stretch[end:]]
            else:
                cuts = [0, *[k for k in range(1, end) if stretch[k - 1 : k + 1] not in beside], *range(end, len(stretch) + 1)]
                parts = [stretch[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            found = self.part(parts[0]) if len(parts) > 1 else self.read_off(stretch)
            for part in parts[1:]:
                found += self.part(part)
        self.remember(stretch, found)
        return found

    def part(self, part: str) -> tuple[int, ...]:
        found = self.seen.get(part) or self.old_seen.get(part)
        if found is None:
            found = self.read_off(part)
            self.remember(part, found)
        return found

    def remember(self, stretch: str, tokens: tuple[int, ...]) -> None:
        if len(stretch) <= SHORT:
            if len(self.seen) >= MEMO:
                self.seen, self.old_seen = {}, self.seen
            self.seen[stretch] = tokens

    def stretches(self, text: str) -> Iterator[str]:
        """A normalized text in stretches that no piece goes across: words with the blanks before them, line ends."""
        if not self.words:
            if text:
                yield text
            return
        for no, line in enumerate(text.split("\n")):
            if no:
                yield "\n"
            blanks, words = "", line.split(BLANK)
            if words[0]:
                yield words[0]
            for word in words[1:]:
                blanks += BLANK
                if word:
                    yield blanks + word
                    blanks = ""
            if blanks:
                yield blanks

    def encode(self, text: str) -> list[int]:
        """Ids of a text between begin and end."""
        ids, seen = [self.begin], self.seen.get
        for stretch in self.stretches(self.library.normalize(text)):
            found = seen(stretch)
            if found is None:
                found, seen = self.tokens(stretch), self.seen.get
            ids += found
        ids.append(self.end)
        return ids


@lru_cache(2)
def pieces(path: str | None = None) -> Pieces:
    """A worker's model; without a path the public tokenizers' one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    return Pieces(path)


def _column(texts: pa.Array) -> Iterator[list[str]]:
    data, offsets = byte_view(texts)
    for a, b in blocks(offsets, most=1 << 20):
        yield [bytes(data[offsets[r] : offsets[r + 1]]).decode("utf-8", "replace") for r in range(a, b)]


def encode_pieces(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Every text's token ids: (doc_id, ids), one row for each input row.

    Reads doc_id and text. Ids are those of the model's own library, with begin and end. For every prefix of a
    stretch the unique last token is stored: an automaton gives the pieces that end there, and the one that can stand next to
    the last token before it is taken, so each character is looked at once, however long the stretch; ids are read off from the end.
    Texts are cut where no piece has two characters side by side, and short stretches are remembered by each worker, within a bound.

    `path` is the model's file on every worker, by default the public tokenizers' one. A null or empty text has begin
    and end only; bytes that aren't UTF-8 become replacement characters. Rows are independent: repeated rows and rows of
    one doc_id are encoded each. There is no order, so no ties. A very long text is one step of a task. Other columns aren't
    read. Empty input: no rows. Models other than merge models with bytes for unknown characters are refused.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            at = 0
            for texts in _column(batch.column(1)):
                found = [np.array(model.encode(t), np.int32) for t in texts]
                edges = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), ids], ["doc_id", "ids"])
                at += len(texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode_pieces(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Of (doc_id, ids) the texts that the ids stand for: (doc_id, ids, ids_le, text).

    The model's library decodes; ids_le is the ids as little-endian unsigned 32-bit numbers. Null ids are an empty list; ids
    that are null or that the model doesn't have are an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            lists = batch.column(1).fill_null([])
            edges, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4")
            for a, b in blocks(edges.astype(np.int64), most=1 << 18):
                own = [values[edges[r] : edges[r + 1]] for r in range(a, b)]
                texts = model.library.decode([x.tolist() for x in own])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), lists.slice(a, b - a), pa.array([x.tobytes() for x in own], pa.binary()), pa.array(texts, pa.string())],
                    ["doc_id", "ids", "ids_le", "text"],
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, ids_le binary, text string")
