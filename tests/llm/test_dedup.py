"""Near-duplicates, chunk, suffix and line dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import chunks, lines, minhash, suffixes

WORDS = [f"w{i}x{i * 7919 % 1009}" for i in range(400)]
DOCS = "doc_id long, text string, key string, size long, id long, spans string, print string"


def frame(spark, texts, extra=True):
    rows = [(i, t, "k", 1, 2, "s", "p") for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def passage(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = passage(rng, 120)
    shared = " ".join(passage(rng, 30))
    out = [" ".join(base)]
    for k in range(25):  # near copies of all degrees
        words = list(base)
        for _ in range(k // 4):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        out.append(" ".join(words))
    out += [" ".join(passage(rng, rng.randrange(1, 90))) for _ in range(30)]
    out += [f"{' '.join(passage(rng, 9))} {shared} {' '.join(passage(rng, 11))}" for _ in range(6)]
    out += [out[0]] * 5 + ["", None, "  \n\t ", "one", "One", "a b c d", "żółw " * 40, "x" * 5000, "ab" * 3000, "é" * 120]
    line = " ".join(passage(rng, 28))
    out += [f"head {k}\n{line}\n\n{' '.join(passage(rng, 12))}\n{line}\ntail" for k in range(4)]
    order = list(range(len(out)))
    rng.shuffle(order)
    return [(i * 3, out[j]) for i, j in enumerate(order)]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_near_duplicates(spark, texts):
    sets = {i: shingles(t) for i, t in texts}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = minhash.near_duplicates(frame(spark, texts + texts[:3] + [(None, "a b c d e f")])).collect()
    assert len(got) == len(texts) + 4
    for r in got:
        if r.doc_id is None:
            assert (r.n_shingles, r.component_id, r.kept) == (2, None, True)
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), root(r.doc_id), root(r.doc_id) == r.doc_id)


def test_one_bad_centre_loses_no_link(spark):
    """A star: copies that are like the base alone, and a smaller doc_id that is like none of them."""
    rng = random.Random(9)
    base = passage(rng, 200)
    texts = [(99, " ".join(base))]
    for k in range(20):
        words = list(base)
        for p in rng.sample(range(0, 200, 9), 4):
            words[p] = f"own{k}{p}"
        texts.append((k, " ".join(words)))
    got = {r.component_id for r in minhash.near_duplicates(frame(spark, texts)).collect()}
    assert got == {0}


def brute_suffix(texts):
    seen, out = set(), {}
    for i, t in sorted(texts):
        b = (t or "").encode()
        own = {b[p : p + 50] for p in range(len(b) - 49)}
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if b[p : p + 50] in seen:
                gone[p : p + 50] = b"\1" * 50
        seen |= own
        out[i] = (len(b), sum(gone), len(re.findall(b"\1+", gone)), hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())
    return out


def test_suffixes(spark, texts):
    want = brute_suffix(texts)
    got = suffixes.remove_repeats(frame(spark, texts + texts[:2])).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]


def test_suffixes_over_many_partitions(spark, texts):
    want = brute_suffix(texts)
    got = suffixes.remove_repeats(frame(spark, texts).repartition(7)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


def test_suffixes_tell_swapped_bytes_apart(spark):
    """Neighbouring blocks of 1 to 16 bytes change places: no 50-byte string over them is a copy."""
    rng, texts = random.Random(12), []
    for k in range(120):
        text, n = "".join(rng.choices("abcdefgh +", k=150)), (1, 2, 4, 8, 16)[k % 5]
        p = rng.randrange(40, 80)
        swapped = text[:p] + text[p + n : p + 2 * n] + text[p : p + n] + text[p + 2 * n :]
        a, b = (np.frombuffer(t[p - 30 : p + 70].encode(), np.uint8) for t in (text, swapped))
        places, buckets = suffixes.refine(np.concatenate([a, b]), np.tile(np.arange(100, 0, -1), 2))
        bucket = dict(zip(places.tolist(), buckets.tolist()))
        equal = [i in bucket and bucket[i] == bucket.get(100 + i) for i in range(51)]
        assert equal == [bytes(a[i : i + 50]) == bytes(b[i : i + 50]) for i in range(51)]
        texts += [(2 * k, text), (2 * k + 1, swapped)]
    got = suffixes.remove_repeats(frame(spark, texts)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute_suffix(texts)


def test_refined_buckets_are_those_of_equal_strings():
    rng = np.random.default_rng(15)
    for letters in (1, 2, 20):
        parts = [rng.integers(97, 97 + letters, n) for n in (49, 50, 51, 99, 300)]
        parts.append(np.concatenate([parts[4][10:80], parts[3]]))
        data = np.concatenate(parts).astype(np.uint8)
        room = np.concatenate([np.arange(len(p), 0, -1) for p in parts])
        strings = {}
        for p in np.flatnonzero(room >= 50).tolist():
            strings.setdefault(bytes(data[p : p + 50]), set()).add(p)
        found = {}
        for p, b in zip(*(x.tolist() for x in suffixes.refine(data, room))):
            found.setdefault(b, set()).add(p)
        assert {frozenset(x) for x in strings.values() if len(x) > 1} == {frozenset(x) for x in found.values() if len(x) > 1}


def test_span_hashes_tell_symmetric_strings_apart():
    """Thue-Morse words share every polynomial modulo a power of two."""
    from lectern.llm.bytesops import byte_codes, span_hashes

    word = np.array([bin(i).count("1") & 1 for i in range(2048)])
    data = np.concatenate([word, 1 - word]).astype(np.uint8) + 97
    for second in (False, True):
        a, b = span_hashes(byte_codes(data, second), np.array([0, 2048]), np.array([2048, 4096]), second)
        assert a != b


def test_suffixes_spread_a_frequent_phrase(spark, texts, monkeypatch):
    """One phrase with ever different neighbours: right results, and no part with most of its stretches."""
    rng = random.Random(14)
    text = lambda: " ".join(passage(rng, 8))
    hot = [(1000 + i, f"{text()} a common heading of 30 b. {text()}") for i in range(200)]
    hot += [(2000 + i, f"{text()} {hot[i][1]}") for i in range(20)]
    monkeypatch.setattr(suffixes, "HOT_STRETCHES", 64)
    base = suffixes.keyed(frame(spark, hot).repartition(3))
    assert len(suffixes.hot_samples(base)) > 0
    sizes = [r.n for r in suffixes.offers(base)[1].selectExpr("part", "size(docs) as n").groupBy("part").agg({"n": "sum"}).toDF("part", "n").collect()]
    assert len(sizes) == 16 and max(sizes) < 0.2 * sum(sizes)
    got = suffixes.remove_repeats(frame(spark, texts + hot).repartition(3)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute_suffix(texts + hot)


def brute_chunks(data):
    """Chunks by a gear hash that is rolled byte by byte."""
    gear, low, cuts = 0, [], []
    for i, c in enumerate(data):
        gear = (2 * gear + int(chunks._GEAR[c])) % 2**32
        inside = i + 1 < len(data) and data[i + 1] & 0xC0 == 0x80
        if gear < 2 ** (32 - chunks.CUT_BITS) and not inside:
            if not low or i - low[-1] > chunks.NEAREST:
                cuts.append(i + 1)
            low.append(i)
    ends, at = [], 0
    for end in sorted({*cuts, len(data)} - {0}):
        ends += [x for x in range(at + chunks.MOST, end, chunks.MOST) if data[x] & 0xC0 != 0x80] + [end]
        at = end
    return [(a, b, data[a:b]) for a, b in zip([0, *ends], ends)]


def test_chunks(spark, texts):
    seen, want = set(), {}
    texts = texts + [(5000 + i, t) for i, t in enumerate([" ".join(WORDS[:60]) * 3, "short", "short", "x" * 40_000 + "short"])]
    for i, t in sorted(texts):
        data = (t or "").encode()
        parts, gone = brute_chunks(data), bytearray(len(data))
        assert b"".join(p[2] for p in parts) == data
        for a, b, part in parts:
            if part in seen:
                gone[a:b] = b"\1" * (b - a)
            seen.add(part)
        want[i] = (len(data), sum(gone), len(re.findall(b"\1+", gone)), hashlib.sha256(bytes(c for c, g in zip(data, gone) if not g)).hexdigest())
    got = chunks.dedup_chunks(frame(spark, texts + texts[:3] + [(None, "x" * 300)])).collect()
    assert len(got) == len(texts) + 4
    for r in got:
        if r.doc_id is not None:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]
    assert sum(r.n_removed > 0 for r in got) > 5


def test_chunks_stretched(spark, texts):
    """Copies go with all that their first place has around them, before the first cut and after the last one too."""
    rng, shared = random.Random(21), [" ".join(passage(random.Random(100 + k), 150)) + f" żółw{k}" for k in range(12)]
    texts = texts + [(7000 + i, f"{' '.join(passage(rng, 20))} é{shared[i % 12]}ł {' '.join(passage(rng, 20))}") for i in range(36)]
    texts += [(5000 + i, t) for i, t in enumerate([" ".join(WORDS[:60]) * 3, "short", "short", "x" * 40_000 + "short"])]
    first, want, whole = {}, {}, 0
    for i, t in sorted(texts):
        data = (t or "").encode()
        parts, gone, own = brute_chunks(data), bytearray(len(data)), {}
        for a, b, part in parts:
            if part in own:
                gone[a:b] = b"\1" * (b - a)
            if part in first:
                source, at = first[part]
                lo, hi, s_lo, s_hi = a, b, at, at + b - a
                while lo and s_lo and data[lo - 1] == source[s_lo - 1]:
                    lo, s_lo = lo - 1, s_lo - 1
                while hi < len(data) and s_hi < len(source) and data[hi] == source[s_hi]:
                    hi, s_hi = hi + 1, s_hi + 1
                while lo < a and data[lo] & 0xC0 == 0x80:
                    lo += 1
                while b < hi < len(data) and data[hi] & 0xC0 == 0x80:
                    hi -= 1
                gone[lo:hi] = b"\1" * (hi - lo)
            own.setdefault(part, (data, a))
        for part, place in own.items():
            first.setdefault(part, place)
        want[i] = (len(data), sum(gone), len(re.findall(b"\1+", gone)), hashlib.sha256(bytes(c for c, g in zip(data, gone) if not g)).hexdigest())
        if i >= 7012 and i < 7036:
            whole += sum(gone) >= len(shared[(i - 7000) % 12].encode())
    assert whole >= 20  # of 24 copies of a passage, nearly all have a cut, and go from end to end
    got = chunks.dedup_chunks(frame(spark, texts + texts[:3] + [(None, "x" * 300)]), stretch=True).collect()
    assert len(got) == len(texts) + 4
    assert [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got if r.doc_id is not None and (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) != want[r.doc_id]] == []
    plain = {r.doc_id: r.n_removed for r in chunks.dedup_chunks(frame(spark, texts)).collect()}
    assert all(plain[i] <= w[1] for i, w in want.items()) and sum(plain[i] < w[1] for i, w in want.items()) > 20


def brute_mark_ends(data):
    """Ends of the marks, by looking through each window."""
    gear, keys = 0, []
    for i, c in enumerate(data):
        gear = (2 * gear + int(chunks._GEAR[c])) % 2**32
        keys.append((gear, -i))
    least = sorted({-min(keys[a : a + chunks.WINDOW])[1] for a in range(31, len(data) - chunks.WINDOW - (chunks.CONTEXT - 32) + 1)})
    found = set(least)
    for a, b in zip(least, least[1:]):
        if b - a <= chunks.CONTEXT and keys[a][0] == keys[b][0]:
            for at, step in ((a, a - b), (b, b - a)):
                while 31 <= at + step < len(data) - (chunks.CONTEXT - 32) and keys[at + step][0] == keys[at][0] and at + step not in found:
                    at += step
                    found.add(at)
    return [x + 1 for x in sorted(found)]


def brute_marks(data):
    """(context, start, end) of the marks, those of equal contexts that follow each other as one."""
    out = []
    for lo, hi in ((e - 32, e + chunks.CONTEXT - 32) for e in brute_mark_ends(data)):
        if out and out[-1][0] == data[lo:hi] and lo + chunks.CONTEXT - out[-1][2] <= chunks.CONTEXT:
            out[-1] = (out[-1][0], out[-1][1], hi)
        else:
            out.append((data[lo:hi], lo, hi))
    return out


def brute_passages(texts):
    """Chunks and contexts of marks that an earlier document has, stretched around their first place, and chunks that their own text has before."""
    first, want = {}, {}
    for i, t in sorted(texts):
        data = (t or "").encode()
        gone, own = bytearray(len(data)), {}
        cut = [(part, a, b) for a, b, part in brute_chunks(data)]
        for k, (part, a, b) in enumerate(cut + brute_marks(data)):
            if k < len(cut) and part in own:
                gone[a:b] = b"\1" * (b - a)
            own[part] = min(own.get(part, (data, a, b)), (data, a, b), key=lambda x: x[1:])
            if part in first:
                source, s_lo, s_hi = first[part]
                lo, hi = a, b
                while lo and s_lo and data[lo - 1] == source[s_lo - 1]:
                    lo, s_lo = lo - 1, s_lo - 1
                while hi < len(data) and s_hi < len(source) and data[hi] == source[s_hi]:
                    hi, s_hi = hi + 1, s_hi + 1
                while lo < hi and data[lo] & 0xC0 == 0x80:
                    lo += 1
                while lo < hi < len(data) and data[hi] & 0xC0 == 0x80:
                    hi -= 1
                gone[lo:hi] = b"\1" * (hi - lo)
        for part, at in own.items():
            first.setdefault(part, at)
        want[i] = (len(data), sum(gone), len(re.findall(b"\1+", gone)), hashlib.sha256(bytes(c for c, g in zip(data, gone) if not g)).hexdigest())
    return want


def test_passages_without_a_whole_chunk(spark, texts, tmp_path):
    """The query takes passages that no two cuts fall into, and runs of one word, which have no cuts at all."""
    from lectern.llm import queries

    rng, short = random.Random(31), []
    for k in range(400):
        text = " ".join(passage(random.Random(500 + k), 60))[: chunks.REACH - 12] + f" żółw{k} é"
        if len(brute_chunks(text.encode())) <= 2 and len(text.encode()) >= chunks.REACH - 1:
            short.append(text)
    assert len(short) >= 8
    runs = [f"{w} " * (1200 // len(w)) for w in ("Tionaux.", "Ener,", "treêaux", "a")]
    planted = [(7000 + i, f"{' '.join(passage(rng, 20 + i % 7))} {(short[:8] + runs)[i % 12]} {' '.join(passage(rng, 20 + i % 5))}") for i in range(36)]
    texts = texts + planted + [(5000 + i, t) for i, t in enumerate([" ".join(WORDS[:60]) * 3, "short", "short", "x" * 40_000 + "short"])]
    want = brute_passages(texts)
    frame(spark, texts + texts[:3] + [(None, "x" * 300)]).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op4_chunk_dedup(spark, str(tmp_path)).collect() if r.doc_id is not None}
    assert {i: w for i, w in got.items() if w != want[i]} == {} and len(got) == len(want)
    for i, _ in planted[12:]:
        assert got[i][1] >= len((short[:8] + runs)[(i - 7000) % 12].encode())
    stretched = {r.doc_id: r.n_removed for r in chunks.dedup_chunks(frame(spark, texts), stretch=True).collect()}
    assert all(stretched[i] <= w[1] for i, w in want.items()) and sum(stretched[i] == 0 for i, _ in planted[12:]) >= 8


def test_marks_of_odd_rows():
    """Marks depend on near bytes alone, whatever stands in the same block."""
    rng = random.Random(8)
    rows = [b"", b"a", b"x" * 255, b"x" * 254, b"", b"ab" * 400, *(bytes(rng.choices(b"abc ", k=n)) for n in (254, 255, 256, 1000, 5)), b""]
    data, bounds = np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0, *map(len, rows)])
    found, ends = chunks.mark_points(chunks._gear_hashes(data, bounds), bounds)
    for r, row in enumerate(rows):
        want = brute_mark_ends(row)
        assert want == list(ends[found == r] - bounds[r])
        assert bool(want) == (len(row) >= chunks.REACH - 1)


def test_chunks_resist_shifts():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 123, 20_000).astype(np.uint8)
    moved = np.concatenate([rng.integers(97, 123, 13).astype(np.uint8), data])
    a, b = ({bytes(d[x:y]) for x, y in zip([0, *e[:-1]], e)} for d, e in ((d, chunks.cut_points(d, np.array([0, len(d)]))[1]) for d in (data, moved)))
    assert len(a & b) >= len(a) - 2


def brute_lines(texts, least=8):
    seen, out = {}, {}
    for i, t in sorted(texts):
        parts = (t or "").split("\n")
        rows = [(n, x, len(re.findall(r"[^\x20\x09-\x0d]+", x))) for n, x in enumerate(parts)]
        rows = [r for r in rows if r[2]]
        gone = set()
        for k in range(len(rows)):
            total, j = 0, k
            while j < len(rows) and total < least:
                total, j = total + rows[j][2], j + 1
            if total >= least:
                body = tuple(r[1] for r in rows[k:j])
                if body in seen:
                    gone |= set(range(rows[k][0], rows[j - 1][0] + 1))
                seen.setdefault(body, (i, rows[k][0]))
        out[i] = (None if t is None else "\n".join(x for n, x in enumerate(parts) if n not in gone), len(gone))
    return out


@pytest.mark.parametrize("least", [1, 8, 25])
def test_lines(spark, texts, least):
    rng = random.Random(31)
    some = [" ".join(passage(rng, n)) for n in (1, 1, 2, 2, 3, 3, 4, 5, 6, 9, 12)]
    more = [(1000 + k, "\n".join(rng.choice(some + [""]) for _ in range(rng.randrange(1, 40)))) for k in range(40)]
    more += [(2000, "\n".join(rng.choice(some) for _ in range(5000))), (2001, "x" * 200_000)]
    want = brute_lines(texts + more, least)
    got = lines.dedup_lines(frame(spark, texts + more + texts[:2] + [(None, "a")]), least, carry=["key"]).collect()
    assert len(got) == len(texts) + len(more) + 3 and {r.key for r in got} == {"k"}
    for r in got:
        if r.doc_id is not None:
            assert (r.text, r.n_removed) == want[r.doc_id]
            assert (r.n_runs > 0) == (r.n_removed > 0)
    assert sum(r.n_removed > 0 for r in got) > 5


@pytest.mark.parametrize("run", [minhash.near_duplicates, suffixes.remove_repeats, chunks.dedup_chunks, lines.dedup_lines])
def test_empty(spark, run):
    assert run(frame(spark, [])).collect() == []
    assert len(run(frame(spark, [(None, None), (1, None), (1, None)])).collect()) == 3


def components_of(texts):
    """Smallest doc_id that each reaches; rows of one doc_id are one node."""
    parent = {i: i for i, _ in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [(i, shingles(t)) for i, t in texts]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i in parent}


def test_one_doc_id_with_two_texts(spark):
    rng = random.Random(21)
    base, other = passage(rng, 60), passage(rng, 60)
    near = lambda words: " ".join(words[:-1] + ["own"])
    texts = [(5, " ".join(base)), (5, near(other)), (9, " ".join(other)), (11, near(base)), (12, " ".join(passage(rng, 40))), (5, ""), (5, None)]
    got = {(r.doc_id, r.n_shingles): r.component_id for r in minhash.near_duplicates(frame(spark, texts)).collect()}
    want = components_of(texts)
    assert want == {5: 5, 9: 5, 11: 5, 12: 12} and {d: c for (d, _), c in got.items()} == want


def test_near_duplicates_with_shingles_that_all_texts_have(spark, monkeypatch):
    """A heading in every text, near copies across bad centres, and joins that deal out hot keys."""
    from lectern.llm import shared

    rng = random.Random(22)
    heading, texts = " ".join(passage(rng, 12)), []
    for g in range(12):
        base = passage(rng, 70)
        for k in range(6):
            words = list(base)
            for p in rng.sample(range(0, 70, 10), k % 4):
                words[p] = rng.choice(WORDS)
            texts.append((len(texts), f"{heading} {' '.join(words)}"))
    texts += [(len(texts) + i, texts[0][1]) for i in range(30)]
    monkeypatch.setattr(shared, "HOT_KEYS", 1 << 40)
    builtin = max
    monkeypatch.setattr(shared, "max", lambda *a: 2 if a[0] == 1000 else builtin(*a), raising=False)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, texts)).collect()}
    assert got == components_of(texts)


def test_texts_of_one_document_with_equal_short_hashes(spark):
    """Two texts of one doc_id whose 32-bit hashes are equal are cut each by itself."""
    from lectern.llm import chunks, suffixes

    texts = spark.range(120_000).select(F.concat(F.sha2(F.col("id").cast("string"), 512), F.lit(" and more")).alias("text"), F.hash(F.concat(F.sha2(F.col("id").cast("string"), 512), F.lit(" and more"))).alias("h"))
    h = texts.groupBy("h").agg(F.count("*").alias("n"), F.collect_list("text").alias("t")).filter("n > 1").first()
    one, two = sorted(h.t)[:2]
    rows = [(1, one), (2, one), (2, two)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for run in (suffixes.remove_repeats, chunks.dedup_chunks):
        got = sorted((r.doc_id, r.n_bytes, r.kept_sha256) for r in run(docs).filter("doc_id = 2").collect())
        assert (2, len(two), hashlib.sha256(two.encode()).hexdigest()) in got, run
    removed = sorted(r.n_removed for r in suffixes.remove_repeats(docs).collect())
    assert removed == [0, 0, len(one)]


def test_template_texts_form_no_pairs_and_similar_ones_stay(spark, monkeypatch):
    """Texts of one template and 17 % own words meet in its shingles, but none has room for a partner of their size; similar texts do."""
    rng = random.Random(9)
    common = [f"t{i}" for i in range(200)]
    texts = [(i, " ".join(common + [f"o{i}x{k}" for k in range(42)])) for i in range(300)]
    base = [f"s{i}" for i in range(120)]
    for i in range(300, 340):
        words = list(base)
        for _ in range(rng.randrange(5)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        texts.append((i, " ".join(words[: rng.randrange(95, 121)])))
    frame_ = spark.createDataFrame(texts, "id long, text string")
    left = frame_.select("id", F.lit(True).alias("other"), F.col("id").alias("c"))
    seen, keep = [], minhash.materialize

    def counted(df, name, *more):
        made = keep(df, name, *more)
        if name == "near-prefixes":
            seen.append({bool(r.template): r.n for r in made.groupBy((F.col("id") < 300).alias("template")).agg(F.count("*").alias("n")).collect()})
        return made

    monkeypatch.setattr(minhash, "materialize", counted)
    pairs = {(r.u, r.v) for r in minhash._similar_across(frame_, left).collect()}
    assert len(seen) == 2 and seen[0][True] > 3000 and True not in seen[1]
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in texts)}
    similar = {(a, b) for a in range(300, 340) for b in range(300, a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert len(similar) > 30 and similar <= pairs and all(v >= 300 for _, v in pairs)
