"""Quality, neighbours, URLs, mixing, decontamination, counts and the pipeline on small fixtures."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import decontaminate, mixing, neighbours, quality, token_counts, url_templates

SF = "/root/testdata/sf0.001"


def test_quality(spark):
    rng = random.Random(1)
    words = [f"{a}{b}" for a in ("sto", "ra", "len", "mi", "tor") for b in ("na", "ki", "del", "sou", "va")]
    good = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(8, 60))).capitalize() + "."
    bad = lambda: rng.choice([" ".join([rng.choice(words)] * 30), " ".join(w + "###" for w in rng.choices(words, k=20))])
    rows = [(i, bad() if i % 4 == 0 else good(), "x", 0.5) for i in range(600)] + [(1000, "", "x", 1.0), (1001, None, "x", 1.0), (None, good(), "x", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, at string, score double")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(600)] + [(None, 1), (5, None), (7, 3), (9999, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.classify_quality(docs, labels).collect()}
    assert len(got) == len(rows)
    for i in range(600):
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= got[i].score <= 1 and got[i].predicted == int(got[i].score >= 0.3)
    held = [i for i in range(600) if got[i].held_out]
    assert sum(got[i].predicted == int(i % 4 != 0) for i in held) / len(held) > 0.97
    assert got[1000].score == got[1001].score == 0 and got[None].held_out is False
    assert quality.keep_quality(docs, labels).columns == docs.columns
    nothing = quality.classify_quality(docs, labels.filter("false")).agg(F.max("score"), F.min("score")).first()
    assert tuple(nothing) == (0.5, 0.0)
    assert quality.classify_quality(docs.filter("false"), labels).count() == 0


def test_quality_votes_are_those_of_the_nearest(spark):
    """Scores against votes counted one text and one neighbour at a time; long, repeated and clashing rows."""
    from lectern.llm.bytesops import byte_view
    from lectern.llm.shared import read
    import pyarrow as pa

    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    extra = spark.createDataFrame([(90001, "word and more " * 200_000, 1, 2), (90002, "same", 1, 2), (90002, "same", 1, 2), (90002, "other", 1, 2)], "doc_id long, text string, quality int, held_out int")
    docs = docs.select("doc_id", "text", F.lit(0).alias("quality"), F.lit(0).alias("held_out")).union(extra)
    model = quality.fit(docs, labels)
    got = sorted((r.doc_id, r.score) for r in quality.classify_quality(docs, labels).collect())
    rows = docs.select("doc_id", "text").collect()
    want = []
    for r in rows:
        data, offsets = byte_view(pa.array([r.text]))
        x = quality.term_frequencies(data, offsets)[0]
        if not x.any():
            want.append((r.doc_id, 0.0))
            continue
        y = x * model.weights
        y = (y / np.linalg.norm(y)) @ model.axes
        y = y / np.linalg.norm(y)
        cosines = [(-float(np.dot(v, y)), k) for k, v in enumerate(model.vectors)]
        best = sorted(cosines)[: quality.NEIGHBOURS]
        weights = [max(-c, 1e-6) ** 4 for c, _ in best]
        want.append((r.doc_id, sum(w * model.labels[k] for w, (_, k) in zip(weights, best)) / sum(weights)))
    assert len(got) == len(want) and [i for i, _ in got] == sorted(i for i, _ in want)
    assert all(abs(a[1] - b[1]) < 1e-3 for a, b in zip(got, sorted(want)))
    again = sorted((r.doc_id, r.score) for r in quality.classify_quality(docs.repartition(7), labels.repartition(3)).collect())
    assert all(abs(a[1] - b[1]) < 1e-6 for a, b in zip(got, again))


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.standard_normal((700, 16)), np.repeat(rng.standard_normal((1, 16)), 60, 0)]).astype(np.float32)
    rows = [(i, p.tolist(), 1, "c") for i, p in enumerate(points)]
    odd = [(900, None, 1, "c"), (1000, [0.0] * 16, 1, "c"), (1100, [float("nan")] + [1.0] * 15, 1, "c"), (1200, [1.0, None] + [1.0] * 14, 1, "c"), (1300, [1.0], 1, "c"), (None, [1.0] * 16, 1, "c"), (0, points[0].tolist(), 1, "c")]
    vectors = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, cell int, shard string")
    got = {}
    for r in neighbours.nearest(vectors).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == set(range(0, 760, 100))
    hits = 0
    p = points.astype(np.float64)
    for q, found in got.items():
        d = np.sqrt(((p - p[q]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(len(p)), d))[:10]
        assert sorted(found) == list(range(1, 11))
        assert [v for v, _ in sorted(found.values(), key=lambda x: (x[1], x[0]))] == [found[k][0] for k in sorted(found)]
        assert all(math.isclose(d[v], s, abs_tol=1e-12) for v, s in found.values())
        hits += len({v for v, _ in found.values()} & set(best.tolist()))
    assert hits >= 0.9 * 10 * len(got)
    assert neighbours.nearest(vectors.filter("vec_id in (100, 101, 102)")).count() == 2
    assert neighbours.nearest(vectors.filter("false")).count() == 0


def test_chi_square():
    assert abs(neighbours.chi_square_quantile(0.95, 8) - 15.507) < 1e-3


def test_urls(spark):
    urls = [f"https://Shop.example.com/{kind}/{i}" for kind in ("fr", "de", "it") for i in range(30)]
    urls += ["http://a.ORG/x", "https://b.example.org/es/1", "https://example.org/en/12", "https://example.org/en/2", "https://notexample.org/es/1", "x", None, "", "https://c.com", "ftp://u@h:1/p?q://r", "https://a.org?x/"]
    pages = spark.createDataFrame([(i, u, "t", "r") for i, u in enumerate(urls)] + [(None, urls[0], "t", "r")], "page_id long, url string, host string, template string")
    got = {r.page_id: r for r in url_templates.judge_urls(pages).collect()}

    def want(u):
        if u is None or "://" not in u:
            return "", "", None
        rest = u.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = rest[:cut].lower(), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
        fits = [r for r in url_templates.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        return host, path, max(fits, key=lambda r: len(r[1] + r[2]), default=None)

    for i, u in enumerate(urls):
        host, path, rule = want(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule and rule[1] + rule[2])
        assert got[i].verdict in ("allow", "block") and (rule is None or got[i].verdict == rule[0])
    assert len(got) == len(urls) + 1
    labels = spark.createDataFrame([(f"https://shop.example.com/it/{i}", 1) for i in range(40)], "url string, bad int")
    again = {r.page_id: r.verdict for r in url_templates.judge_urls(pages, labels=labels).collect()}
    assert all(again[i] == "block" for i in range(60, 90))
    assert url_templates.judge_urls(pages.filter("false")).count() == 0


def waterfill(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        left, all_w = total - sum(fixed.values()), sum(w[s] for s in free)
        share = {s: left * w[s] / all_w for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed |= {s: most * sizes[s] for s in over}


def test_mixing(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["b", "a", None, "é", "B", "tiny"] if i % 50 == 0 else ["b", "a", None, "é", "B"]), " x\t" * rng.choice([0, 1, 3, 40, 200]), 1, 2) for i in range(900)]
    rows += [(5000, "a", None, 1, 2), (None, "a", "x y", 1, 2), (7, "a", "x y", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, size int, taken int")
    got = mixing.mix_sources(docs).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix_sources(docs.repartition(5)).collect()), key=repr) and len(got) == len(rows)
    sizes = {}
    for _, s, t, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    goal, taken = waterfill(sizes), {}
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, goal[r.source], rel_tol=1e-12) and 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 20
    assert mixing.mix_sources(docs.filter("false")).count() == 0
    assert {r.taken for r in mixing.mix_sources(docs.filter("doc_id = 5000")).collect()} == {0}


def brute_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_decontamination(spark):
    rng = random.Random(6)
    words = [f"v{i}" for i in range(300)]
    items = [[rng.choice(words) for _ in range(rng.randrange(12, 60))] for _ in range(20)]
    docs = []
    for i in range(200):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 200))]
        if i % 2:
            copy = list(items[i % 20])
            for _ in range(rng.randrange(0, int(0.3 * len(copy)))):
                p = rng.randrange(len(copy))
                copy[p : p + 1] = rng.choice([[], [rng.choice(words)], [copy[p], rng.choice(words)]])
            at = rng.randrange(len(text))
            text[at:at] = copy
        docs.append((i, " ".join(text).title(), "z", 1))
    docs += [(500, None, "z", 1), (501, "", "z", 1), (None, " ".join(items[3]), "z", 1), (1, docs[1][1], "z", 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, leak_id string, edits int")
    b = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)] + [(None, "a"), (77, None), (78, ""), (79, "v1 v2")], "item_id long, text string")
    want = {}
    for i, t, *_ in docs:
        for k, item in enumerate(items):
            edits = brute_edits(item, (t or "").lower().split())
            if edits <= int(0.2 * len(item)):
                want[i, k] = edits
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.find_items(d, b).collect()}
    assert set(got) <= set(want) and all(got[p] >= want[p] for p in got)
    assert len(got) >= 0.95 * len(want) and all(p in got for p in want if want[p] <= 2)
    clean = decontaminate.decontaminate(d, b)
    assert clean.columns == d.columns and {r.doc_id for r in clean.collect() if r.doc_id is not None} == {i for i, *_ in docs if i is not None} - {i for i, _ in got}
    assert decontaminate.find_items(d.filter("false"), b).count() == 0 and decontaminate.find_items(d, b.filter("false")).count() == 0


def test_decontamination_of_short_and_long_items(spark, monkeypatch):
    """Items of 1 to 4 and of 128 to 900 words, in one block of items and in several."""
    rng = random.Random(8)
    words = [f"v{i}" for i in range(2000)]
    items = [rng.sample(words, n) for n in (1, 2, 2, 3, 3, 4, 4, 128, 129, 140, 200, 257, 300, 520, 900)]
    docs = []
    for i in range(60):
        text, item = [rng.choice(words) for _ in range(rng.randrange(5, 200))], items[i % 15]
        copy = list(item)
        for _ in range(rng.randrange(0, int((0, 0.05, 0.15, 0.25)[i // 15] * len(copy)) + 1)):
            p = rng.randrange(len(copy))
            copy[p : p + 1] = rng.choice([[], [rng.choice(words)], [copy[p], rng.choice(words)]])
        at = rng.choice([0, len(text), rng.randrange(len(text))])
        text[at:at] = copy
        docs.append((i, " ".join(text).title()))
    docs += [(60, items[3][0]), (61, " ".join(items[3])), (62, " ".join(items[3][:2])), (63, items[3][2]), (64, " ".join(["same"] * 400))]
    items.append(["same"] * 300)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    want = {}
    for i, t in docs:
        for k, item in enumerate(items):
            if (edits := brute_edits(item, t.lower().split())) <= int(0.2 * len(item)):
                want[i, k] = edits
    for at_once in (250_000, 900):
        monkeypatch.setattr(decontaminate, "WORDS_AT_ONCE", at_once)
        got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.find_items(d, b).collect()}
        assert got == want and {k for _, k in got} == set(range(16))


def test_token_counts(spark, tmp_path):
    encode = token_counts._encoding(token_counts.VOCABULARY, token_counts.PATTERN).encode_ordinary
    n = lambda t: len(encode(t)) if t else 0
    rows = [("insert", "a", "en", "Hello there, world!", None), ("insert", "a", "en", None, None), ("insert", None, "pl", "Zażółć", None), ("delete", "a", "en", "world", None), ("revise", "a", "en", "new text", "old"), ("what", "a", "en", "x", None), (None, "a", "en", "x", None)]
    changes = spark.createDataFrame(rows, "kind string, source string, lang string, text string, old_text string")
    store = f"file://{tmp_path}/store"
    for batch in (1, 2, 1, 2):  # replays count once
        token_counts.commit(token_counts.token_deltas(changes), store, batch)
    got = {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in token_counts.totals(spark, store).collect()}
    one = n("Hello there, world!") - n("world") + n("new text") - n("old")
    assert got == {("a", "en"): (2, 2 * one), (None, "pl"): (2, 2 * n("Zażółć"))}
    token_counts.commit(token_counts.token_deltas(changes.filter("false")), store, 2)
    assert {r.n_docs for r in token_counts.totals(spark, store).collect()} == {1}


def test_token_totals_survive_crashes(spark, tmp_path, monkeypatch):
    store, schema = f"file://{tmp_path}/store", "kind string, source string, lang string, text string, old_text string"
    one, two = (token_counts.token_deltas(spark.createDataFrame([("insert", s, "en", "some words here", None)], schema)) for s in ("a", "b"))
    assert token_counts.totals(spark, store).count() == 0
    token_counts.commit(one, store, 7)
    before = token_counts.totals(spark, store).collect()

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(token_counts, "_publish", crash)
        for batch in (7, 8):
            with pytest.raises(OSError):
                token_counts.commit(two, store, batch)
    assert token_counts.totals(spark, store).collect() == before
    token_counts.commit(two, store, 8)
    assert token_counts.compact(spark, store) == 2 * 2 + 1  # unpublished batches and totals, and the first totals
    token_counts.commit(one, store, 8)
    assert [(r.source, r.n_docs) for r in token_counts.totals(spark, store).collect()] == [("a", 2)]


def test_token_count_query(spark):
    from lectern.llm.queries import QUERIES
    from lectern.llm.shared import read

    encode, want = token_counts._encoding(token_counts.VOCABULARY, token_counts.PATTERN).encode_ordinary, {}
    for r in read(spark, SF, "documents").collect():
        n, t = want.get((r.source, r.lang), (0, 0))
        want[r.source, r.lang] = (n + 1, t + (len(encode(r.text)) if r.text else 0))
    assert {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in QUERIES["op9_token_counts"](spark, SF).collect()} == want


def test_queries_have_the_contracted_columns(spark):
    from lectern.llm.queries import QUERIES

    want = {
        "op1_near_duplicates": ["doc_id", "n_shingles", "component_id", "kept"],
        "op2_quality": ["doc_id", "held_out", "score", "predicted"],
        "op3_nearest_neighbours": ["query_id", "rank", "vec_id", "score"],
        "op5_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        "op6_url_filter": ["page_id", "host", "path", "rule", "verdict"],
        "op7_source_mix": ["doc_id", "size", "source_size", "target", "taken"],
    }
    for name, columns in want.items():
        assert set(columns) <= set(QUERIES[name](spark, SF).columns), name


def test_pipeline(spark):
    import corpus_pipeline as p
    from lectern.llm.shared import materialize, read

    docs = read(spark, SF, "documents")
    whole = {r.doc_id: r.text for r in docs.collect()}
    steps = [docs]
    for _, stage in p.STAGES:
        steps.append(materialize(stage(spark, steps[-1], SF), "test-stage"))
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in steps]
    assert all(s.columns == p.COLUMNS for s in steps[1:-1]) and all(b <= a for a, b in zip(ids, ids[1:]))
    kept = {r.doc_id for r in quality.classify_quality(docs, read(spark, SF, "labels")).filter("predicted = 1").collect()}
    assert ids[1] == kept
    from tests.llm.test_dedup import brute_lines, shingles

    lines_left = {i: t for i, (t, n) in brute_lines([(i, whole[i]) for i in kept]).items() if not n or t.strip(" \t\n\v\f\r")}
    assert {r.doc_id: r.text for r in steps[2].collect()} == lines_left
    sets, gone = {i: shingles(t) for i, t in lines_left.items()}, set()
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                gone.add(b)
    assert ids[3] == set(sets) - gone
    assert {tuple(r) for r in p.run(spark, SF).collect()} == {tuple(r) for r in steps[-1].collect()}


def test_long_urls_and_texts(spark):
    url = "https://long.example.com/fr/" + "a/" * 100_000 + "?q"
    pages = spark.createDataFrame([(1, url, "r"), (1, url, "r"), (2, "https://x.net/" + "9" * 500_000, "r")], "page_id long, url string, rule string")
    got = sorted(url_templates.judge_urls(pages).collect(), key=lambda r: r.page_id)
    assert [(r.page_id, r.rule, len(r.path)) for r in got] == [(1, "com/fr/", 200_004), (1, "com/fr/", 200_004), (2, None, 500_001)]
    docs = spark.createDataFrame([(1, "a", "w " * 1_000_000, 0), (2, "b", "w", 0), (2, "b", "w", 0)], "doc_id long, source string, text string, target int")
    mixed = mixing.mix_sources(docs).collect()
    assert sorted((r.doc_id, r.size) for r in mixed) == [(1, 1_000_000), (2, 1), (2, 1)] and all(r.taken <= 3 * r.size for r in mixed)


def test_decontamination_judges_each_row(spark):
    rng = random.Random(41)
    item = " ".join(f"b{rng.randrange(900)}" for _ in range(40))
    long_text = "word " * 300_000 + item + " word" * 300_000
    rows = [(None, item, 1), (None, "clean text", 1), (3, item, 1), (3, "clean too", 1), (4, long_text, 1), (5, None, 1), (6, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted((str(r.doc_id), r.text) for r in decontaminate.decontaminate(docs, b).collect() if r.text) == [("3", "clean too"), ("None", "clean text")]
    assert decontaminate.decontaminate(docs, b).count() == 4


def test_pipeline_stages_on_nulls_and_nothing(spark):
    import corpus_pipeline as p

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    words = " ".join(f"w{i}" for i in range(60))
    odd = [(None, None, None, None, None), (None, words, None, "a", None), (1, "", "en", None, 0), (1, words, "en", "a", 5), (1, words, "en", "a", 5), (2, None, "en", "b", None), (3, "x" * 100_000, "en", "b", 1)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in p.STAGES:
            got = stage(spark, docs, SF)
            assert got.count() <= len(rows)


@pytest.mark.parametrize("lead", ["x/y/z/v/w", "a/b/c/d/e/f/g/h/i/j/k/l/m", "/".join("abcdefghijklmnopqrstuvw")])
def test_url_templates_of_deep_paths(spark, lead):
    """Segments far down a path decide, beyond the tree's levels as well."""
    urls = [f"http://h.net/{lead}/{kind}/p{i}" for i in range(100) for kind in ("good", "bad")]
    labels = spark.createDataFrame([(u, int("/bad/" in u)) for u in urls], "url string, bad int")
    pages = spark.createDataFrame(list(enumerate(urls + [f"http://h.net/{lead}/bad/p999/"])), "page_id long, url string")
    got = url_templates.judge_urls(pages, labels=labels).collect()
    assert len(got) == 201 and all(r.verdict == ("block" if "/bad/" in r.path else "allow") for r in got)


def test_token_log_of_many_batches(spark, tmp_path):
    """Commits, replays and compaction over a long log, of which the driver sees single rows only."""
    store = f"file://{tmp_path}/store"
    batch = lambda n: spark.createDataFrame([("s", "x", "t", 1, n)], "source string, lang string, tokenizer string, n_docs long, n_tokens long")
    for n in range(1, 6):
        token_counts.commit(batch(n), store, n)
    assert token_counts.compact(spark, store) == 4
    token_counts.commit(batch(10), store, 2)  # replaces the 2 that the compacted log knows
    token_counts.commit(batch(100), store, 6)
    assert [tuple(r) for r in token_counts.totals(spark, store).collect()] == [("s", "x", "t", 6, 1 + 10 + 3 + 4 + 5 + 100)]
    assert token_counts.compact(spark, store) == 3 and token_counts.compact(spark, store) == 0
    token_counts.commit(batch(0), store, 6)
    assert token_counts.totals(spark, store).first().n_tokens == 23
    assert len(list((tmp_path / "store" / "log").glob("0*.json"))) == 2
