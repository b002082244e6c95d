"""Fill-in-the-middle, piece encoding and hard negatives against plain versions."""

import hashlib
import math
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lectern.llm import infilling, negatives, pieces, queries

SF = "/root/testdata/sf0.001"


def plain_middle(doc_id, text, rate=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    if h4 % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_in_middle(spark):
    rng = random.Random(3)
    bits = ["a", "ż", "😀", "\n", "\n\n", "<", "<S", "S>", "P>", "M>", " ", "\r\n", "\x00", "日本\n"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(40))), "x", i) for i in range(600)]
    rows += [(7, "again\nand again", "x", 1), (7, "again\nand again", "x", 1), (7, "another\ntext\n", "x", 1), (None, "no\nid", "x", 1), (700, None, None, None), (701, "", "x", 1)]
    rows += [(702, "with <M>\nmark", "x", 1), (703, "long line\n" * 60_000, "x", 1), (704, "x" * 700_000, "x", 1), (705, "\n" * 300_000, "x", 1), (-5, "one line", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n long").repartition(5)
    for options in ({}, {"rate": 40, "spm": 10, "seed": 9}, {"rate": 0}):
        back = infilling.restored(infilling.fill_in_middle(docs, **options)).collect()
        got = sorted(((r.doc_id, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in back), key=repr)
        assert got == sorted(((i, plain_middle(i, t, **options)) for i, t, *_ in rows), key=repr)
        assert sorted((repr(r.doc_id), r.restored) for r in back) == sorted((repr(i), t or "") for i, t, *_ in rows)
    forms = {r[1] for _, r in ((i, plain_middle(i, t)) for i, t, *_ in rows)}
    assert forms == {"plain", "psm", "spm"}
    assert infilling.fill_in_middle(docs.filter("false")).count() == 0
    odd = spark.createDataFrame([(None, "<P>a", 1, "old"), ("psm", None, 2, "old"), ("other", "t", 3, "old")], "form string, output string, `a b` long, restored string")
    assert sorted((r["a b"], r.restored) for r in infilling.restored(odd).collect()) == [(1, "<P>a"), (2, None), (3, "t")]


def test_middle_needs_no_shuffle(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = infilling.fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan


@pytest.fixture(scope="module")
def model():
    return pieces.pieces()


def test_pieces_are_the_librarys(model):
    rng = random.Random(4)
    bits = ["a", "b", "e", "t", "h", " ", "  ", "\n", "▁", "the", "ing", "ą", "ł", "①", "日", "本", "<s>", "<0x41>", "0", "1", "9", ".", "...", "=", "\t", "\r\n", "😀", "\x00", "addEvent", "Listener", "aaaa"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["", " ", "▁" * 999, "a" * 5000, "ab" * 3000, "日本語" * 2000, "".join(rng.choice("abcdefgh") for _ in range(30_000)), " lead and trail ", "́x"]
    assert [model.encode(t) for t in texts] == model.library.encode(texts, add_bos=True, add_eos=True)


def test_prefix_table_holds_every_prefixs_last_token(model):
    rng = random.Random(5)
    for _ in range(200):
        stretch = "▁" + "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 40)))
        last, lengths = model.prefix_table(stretch)
        for n in range(1, len(stretch) + 1):
            found = model.library.encode(stretch[1:n], out_type=str) if n > 1 else ["▁"]
            assert (model.text[last[n]], lengths[n]) == (found[-1], len(found[-1]))


def test_memory_of_pieces_turns_over(monkeypatch):
    monkeypatch.setattr(pieces, "MEMO", 8)
    small, texts = pieces.Pieces(pieces_path()), [r.decode() for r in (b"some words and some more words", b"other words, quite other ones", b"some words")]
    assert [small.encode(t) for t in texts * 3] == small.library.encode(texts * 3, add_bos=True, add_eos=True)
    assert len(small.seen) <= 8 and len(small.pairs) <= 8


def pieces_path():
    import public_tokenizers

    return public_tokenizers.path(pieces.MODEL)


def test_pieces_of_rows(spark, model):
    rows = [(1, "twice"), (1, "twice"), (1, "another"), (None, "no id"), (2, None), (3, ""), (4, "long words " * 50_000), (5, "x" * 300_000)]
    docs = spark.createDataFrame([(i, t, 0, t) for i, t in rows], "doc_id long, text string, ids int, ids_le string").repartition(3)
    got = pieces.decode_pieces(pieces.encode_pieces(docs)).collect()
    want = [(i, model.library.encode(t or "", add_bos=True, add_eos=True), t or "") for i, t in rows]
    assert sorted(map(repr, ((r.doc_id, r.ids, r.text) for r in got))) == sorted(map(repr, want))
    assert all(bytes(r.ids_le) == np.array(r.ids, "<u4").tobytes() for r in got)
    bad = docs.limit(1).select("doc_id", F.lit(b"a\xffb").cast("string").alias("text"))
    assert pieces.encode_pieces(bad).first().ids == model.library.encode("a�b", add_bos=True, add_eos=True)
    assert pieces.decode_pieces(pieces.encode_pieces(docs.filter("false"))).count() == 0


def test_piece_query(spark, model):
    texts = dict(duckdb.sql(f"select doc_id, coalesce(text, '') from '{SF}/documents.parquet'").fetchall())
    digest = lambda b: hashlib.sha256(b).hexdigest()
    got = queries.op12_sentencepiece(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = model.library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest(np.array(ids, "<u4").tobytes()))
        assert r.decoded_sha256 == digest(model.library.decode(ids).encode())


def plain_negatives(rows, every=100, positives=5, k=5, least=80, most=100, scale=256):
    one = {}
    for i, label, v in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        one[i] = min(one.get(i, (label, v)), (label, v))
    lengths = defaultdict(int)
    for _, v in one.values():
        lengths[len(v)] += 1
    width = min(lengths, key=lambda d: (-lengths[d], d)) if lengths else 0
    one = {i: (label, [math.floor(scale * x) for x in v]) for i, (label, v) in one.items() if len(v) == width}
    out = []
    for a in (i for i in one if i % every == 0):
        label, own = one[a]
        scored = sorted((-sum(x * y for x, y in zip(own, v)), i, other == label) for i, (other, v) in one.items() if i != a)
        for down, p, _ in [s for s in scored if s[2]][:positives]:
            fits = [s for s in scored if not s[2] and least * -down <= most * -s[0] <= most * -down][:k]
            out += [(a, p, n, i, -down, -d) for n, (d, i, _) in enumerate(fits, 1)]
    return sorted(out)


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, label int, embedding array<float>, score int, slot string").repartition(3)


def test_hard_negatives(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((4, 6))
    near = [(i, int(rng.integers(3)), (base[i % 4] + 0.3 * rng.standard_normal(6)).astype(np.float32).tolist()) for i in range(900)]
    hot = [(900 + i, i % 3, [1.0, 0.5, 0.0, 0.0, -0.5, 1.0]) for i in range(500)]  # copies, with ties everywhere
    odd = [(2000, None, [1.0] * 6), (2100, 1, None), (2200, 1, [1.0] * 5 + [None]), (2300, 1, [float("nan")] * 6), (2400, 1, [float("inf")] * 6), (2500, 1, []), (2600, 1, [1.0]), (None, 1, [1.0] * 6)]
    odd += [(2700, 0, [0.0] * 6), (2800, 77, [1.0] * 6), (0, 2, [0.5] * 6), (0, 2, [0.5] * 6), (-100, 1, [-1.0] * 6)]
    rows = near + hot + odd
    got = negatives.hard_negatives(vectors_of(spark, rows))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain_negatives(rows)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100
    other = dict(every=50, positives=2, negatives=3, least=30, most=90, scale=16.0)
    assert sorted(map(tuple, negatives.hard_negatives(vectors_of(spark, rows), **other).collect())) == plain_negatives(rows, 50, 2, 3, 30, 90, 16)
    for few in ([], [(1, 1, [1.0])], [(100, 1, [1.0])], [(100, 1, [1.0]), (2, 1, [1.0]), (3, 2, [0.9])], [(100, 1, [0.0]), (2, 1, [1.0]), (3, 2, [-1.0])]):
        assert sorted(map(tuple, negatives.hard_negatives(vectors_of(spark, few)).collect())) == plain_negatives(few)
    with pytest.raises(ValueError, match="scale"):
        negatives.hard_negatives(vectors_of(spark, [(1, 1, [1e30])]))


def test_steps_of_any_size_keep_the_same_candidates(monkeypatch):
    """A shard's answers by steps of a few rows, with batches that end anywhere, are those of one step."""
    rng = np.random.default_rng(8)
    rows = [(0, 0, i, int(rng.integers(3)), rng.integers(-3, 4, 4).astype(float).tolist(), None) for i in rng.permutation(300)]
    asked = [(0, 1, i, int(rng.integers(3)), rng.integers(-3, 4, 4).astype(float).tolist(), [20, 9, 3][: 1 + i % 3]) for i in range(1000, 1040)]
    schema = pa.schema([("shard", pa.int32()), ("asked", pa.int32()), ("vec_id", pa.int64()), ("label", pa.int64()), ("embedding", pa.list_(pa.float64())), ("limits", pa.list_(pa.int64()))])

    def answers(size, run):
        every = rows + asked
        batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in every[at : at + size]], schema=schema) for at in range(0, len(every), size)]
        return sorted(tuple(r.values()) for b in run(iter(batches)) for r in b.to_pylist())

    same, other = negatives._same_label(1.0, 4), negatives._other_labels(1.0, 4, 50, 100)
    whole = [answers(1000, run) for run in (same, other)]
    monkeypatch.setattr(negatives, "ROWS", 7)
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    assert [answers(13, run) for run in (same, other)] == whole
    assert len(whole[1]) == len({(r[0], r[2]) for r in whole[1]})  # a row is in one slot of an anchor only
    for anchor, slot, _, score in whole[1]:
        limits = next(r[5] for r in asked if r[2] == anchor)
        assert score <= limits[slot] and (slot + 1 == len(limits) or score > limits[slot + 1])


def test_queries_equal_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name in ("op11_fill_in_middle", "op13_hard_negatives"):
        df = queries.QUERIES[name](spark, SF)
        got, want = df.collect(), con.sql(queries.ORACLE_SQL[name]).select(*df.columns).fetchall()
        assert sorted(map(tuple, got)) == sorted(want) and got
