"""Vector codes, collocations and repeated passages against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eqlake.llm import collocations, repeats, vector_codes
from eqlake.llm.bitmaps import Bitmap, bitmap_of
from eqlake.llm.common import on_equal

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------------------
# Helpers
# ---------------------------------------------------------------------------


def test_on_equal_joins_hot_and_null_keys(spark):
    rows = spark.createDataFrame([("hot", i) for i in range(50)] + [(None, 50 + i) for i in range(30)] + [("a", 80), ("none", 81)], "k string, i int").cache()
    values = spark.createDataFrame([("hot", 1), (None, 2), ("a", 3), ("unused", 4)], "k string, v int")
    want = Counter([1] * 50 + [2] * 30 + [3])
    for share in (1, 3, 1000):
        got = [r.v for r in on_equal(rows, values, ["k"], share=share).collect()]
        assert len(got) == 82 and Counter(v for v in got if v is not None) == want
        assert on_equal(rows, values, ["k"], how="inner", share=share).count() == 81
        assert on_equal(rows, values, ["k"], how="left_semi", share=share).columns == ["k", "i"]
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert on_equal(rows, values, ["k"], how="inner", share=3, counts=counts).count() == 81


def test_bitmaps_hold_what_was_put_in(spark):
    rng = random.Random(1)
    hashes = [rng.getrandbits(64) for _ in range(2_000)] + [0, (1 << 64) - 1]
    rows = [(x - (1 << 64) if x >> 63 else x,) for x in hashes]
    known = Bitmap(*bitmap_of(spark.createDataFrame(rows, "h long").cache()))
    assert known.has(np.array(hashes, dtype=np.uint64)).all() and all(known.holds(x) for x in hashes)
    others = np.array([rng.getrandbits(64) for _ in range(20_000)], dtype=np.uint64)
    assert known.has(others).mean() < 0.01
    assert not Bitmap(*bitmap_of(spark.createDataFrame([], "h long"))).has(others).any()


# ---------------------------------------------------------------------------
# Vector codes
# ---------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, id string, codes string, x int, n int"


def _plain_lloyd(rows, parts=16, entries=64, rounds=2):
    """Whole scans in Python integers."""
    kept = sorted((r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = -(-max((len(r[1]) for r in kept), default=0) // parts) * parts
    w = dim // parts
    vs = [[int(np.floor(256 * float(np.float32(x)))) for x in r[1]] + [0] * (dim - len(r[1])) for r in kept]
    books = [[v[p * w : (p + 1) * w] for v in vs[:entries]] for p in range(parts)]

    def assign():
        out = []
        for v in vs:
            found = [min((sum((a - b) ** 2 for a, b in zip(v[p * w : (p + 1) * w], e)), i) for i, e in enumerate(books[p])) for p in range(parts)]
            out.append(found)
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [v[p * w : (p + 1) * w] for v, f in zip(vs, found) if f[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    found = assign()
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for r, e in zip(kept, errors):
        by_label[r[2]] += e
    return Counter((r[0], "".join(f"{i:02x}" for _, i in f), e, by_label[r[2]], sha) for r, f, e in zip(kept, found, errors))


def _coded(spark, rows):
    df = spark.createDataFrame([(*r, "i", "c", 1, 2) for r in rows], VECTORS).repartition(3)
    return Counter(tuple(r) for r in vector_codes.vector_code_rows(df).collect())


def test_vector_codes_equal_plain_rounds(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(size=32).astype(np.float32).tolist(), int(i % 3) if i % 4 else None) for i in rng.permutation(300)]
    rows += [(None, rows[0][1], 1), (7, rows[5][1], None), (7, rows[5][1], None)]  # no id, a repeated one
    rows += [(900, None, 1), (901, [float("nan")] * 32, 1), (902, [float("inf")] + [0.0] * 31, 1), (903, [None] + [0.0] * 31, 1)]
    assert _coded(spark, rows) == _plain_lloyd(rows)


def test_vector_codes_of_ties_and_odd_lengths(spark):
    rng = np.random.default_rng(6)
    # Few different numbers: many ties and many unused entries.
    rows = [(i, (rng.integers(-2, 3, 20) / 256).tolist(), 1) for i in range(150)] + [(200, [1.0] * 3, 2), (201, [], None), (202, [0.5] * 33, 2)]
    assert _coded(spark, rows) == _plain_lloyd(rows)
    assert _coded(spark, rows[:5]) == _plain_lloyd(rows[:5])  # fewer rows than entries
    assert _coded(spark, []) == Counter() and _coded(spark, [(1, None, 1)]) == Counter()
    with pytest.raises(Exception, match="beyond"):
        _coded(spark, [(1, [1e9] * 16, 1)])


def test_active_entries_give_what_a_whole_scan_gives():
    rng = np.random.default_rng(7)
    for trial in range(30):
        x = rng.integers(-3, 4, (200, 2))
        before = rng.integers(-3, 4, (16, 2))
        after = before.copy()
        moved = rng.random(16) < trial / 30
        after[moved] += rng.integers(-2, 3, (int(moved.sum()), 2))
        code, best = vector_codes.nearest(x, before)
        got = vector_codes.reassigned(x, code, best, after, (after != before).any(axis=1))
        want = vector_codes.nearest(x, after)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


# ---------------------------------------------------------------------------
# Collocations
# ---------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, f long, h long, phrase string, ws string, n long, k long"


def _docs(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, 2, "p", "w", 3, 4) for r in rows], DOCS).repartition(3)


def _plain_collocations(rows, least, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, 6):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i : i + k])] += 1
    cands = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    inner = {(lang, ws[i : i + m]) for (lang, ws), a in cands.items() for m in range(2, len(ws)) for i in range(len(ws) - m + 1) if a >= cands[lang, ws[i : i + m]]}
    out = []
    for lang in n:
        rows_of = []
        for (g, ws), a in cands.items():
            if g == lang and (g, ws) not in inner:
                cuts = [(1000 * a * n[g] // (f[g, ws[:k]] * f[g, ws[k:]]), k, f[g, ws[:k]], f[g, ws[k:]]) for k in range(1, len(ws))]
                s, _, left, right = min(cuts)
                rows_of.append((-s, -a, " ".join(ws).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows_of)[:top], 1)]
    return sorted(out)


def _corpus(seed=3, n=250):
    rng = random.Random(seed)
    vocabulary = ["new", "york", "city", "of", "the", "Hall", "ÉTÉ", "x\x0by", "a", " ", "b-c", "日本"]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary) + rng.choice(["", "", "", ",", ".", "\n", "\t"]) for _ in range(rng.randint(0, 60))]
        if i % 3 == 0:
            words += ["the", "new", "york", "city", "hall"] * rng.randint(1, 3)
        rows.append((i, " ".join(words), ["en", "fr", None, "und"][min(i % 5, 3)]))
    return rows + [(1, None, "en"), (2, "", "xx"), (None, " \t ", None), rows[0], rows[0]]


def test_collocations_equal_brute_force(spark):
    rows = _corpus()
    df = _docs(spark, rows)
    for least, top in ((5, 2000), (40, 3)):
        got = sorted(tuple(r) for r in collocations.collocations(df, min_count=least, top=top).collect())
        want = _plain_collocations(rows, least, top)
        assert want and got == want
    assert collocations.collocations(_docs(spark, []), min_count=5).count() == 0
    assert collocations.collocations(_docs(spark, [(1, None, None)])).count() == 0


def test_a_phrase_counts_in_one_long_text(spark):
    text = "Alpha beta gamma. " * 5_000 + " ".join(f"w{i}" for i in range(3_000))
    got = [tuple(r) for r in collocations.collocations(_docs(spark, [(1, text, "en")])).collect()]
    assert got == _plain_collocations([(1, text, "en")], 100) and [g[2] for g in got] == ["alpha beta gamma"]


def test_summaries_lose_no_frequent_key():
    rng = np.random.default_rng(2)
    for trial in range(20):
        keys = np.concatenate([rng.integers(0, 5_000, 20_000), rng.integers(0, 30, 3_000), np.full(90, 9_999)]).astype(np.uint64)
        rng.shuffle(keys)
        least = int(rng.integers(40, 120))
        summary = collocations.MisraGries(len(keys) // least + 1)
        for some in np.array_split(keys, 1 + trial):
            summary.add(*np.unique(some, return_counts=True))
            summary.fold()
        assert len(summary.keys) <= summary.capacity and summary.error < least
        true = dict(zip(*(x.tolist() for x in np.unique(keys, return_counts=True))))
        kept = set(summary.survivors(least).tolist())
        assert {k for k, n in true.items() if n >= least} <= kept
        assert all(n <= true[k] <= n + summary.error for k, n in zip(summary.keys.tolist(), summary.counts.tolist()))


def test_scores_pass_64_bits(spark):
    wide = "cast({} as decimal(18, 0))".format
    expr = f"({wide('a')} * {wide('n')} * cast(1000 as decimal(4, 0))) div ({wide('l')} * {wide('r')})"
    a, n, l, r = 10**13, 3 * 10**15 + 7, 10**13 + 1, 2 * 10**14 + 3
    assert spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long").select(F.expr(expr)).first()[0] == 1000 * a * n // (l * r)


# ---------------------------------------------------------------------------
# Repeated passages
# ---------------------------------------------------------------------------


def _plain_repeats(texts, length=200):
    data = [(t or "").encode() for t in texts]
    n = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if n[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest()))
    return out


def _removed(spark, rows):
    df = _docs(spark, [(i, t, "en") for i, t in rows])
    done = repeats.remove_repeats(df).collect()
    return Counter((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in done)


def _want(rows):
    return Counter((i, *x) for (i, _), x in zip(rows, _plain_repeats([t for _, t in rows])))


def _passages(seed=11):
    rng = random.Random(seed)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij é") for _ in range(rng.randint(2, 9))) for _ in range(n))
    shared, edge = words(90), words(45)
    texts = [words(rng.randint(0, 80)) for _ in range(15)]
    texts += [f"{words(20)} {shared} {words(20)}" for _ in range(6)]
    # Cuts of the passage: what each pair shares begins and ends elsewhere.
    texts += [f"{words(9)}|{shared[i * 17 :]}{words(3)}" for i in range(6)] + [f"{words(2)}{shared[: 150 + 31 * i]}|{words(5)}" for i in range(12)]
    base = words(150)
    texts += [base, base, base.replace(base[300:310], "##########"), base[:199], base[:200], base[1:201], words(10) + edge + words(10) + edge]
    texts += ["a" * 1_000, "ab" * 400, "abc" * 90 + "x", "ba" * 120, None, "", "é" * 150, "z" * 200]
    return texts


def test_repeats_equal_brute_force(spark):
    rows = [(i if i % 9 else None, t) for i, t in enumerate(_passages())]
    rows += [rows[16], rows[16], (5, "id again")]
    want = _want(rows)
    assert sum(1 for x in want if x[2]) > 30 and _removed(spark, rows) == want


def test_hot_grams_are_divided(spark, monkeypatch):
    rows = list(enumerate(_passages(12)))
    for hot, chunk in ((1, 1), (3, 2)):
        monkeypatch.setattr(repeats, "HOT", hot)
        monkeypatch.setattr(repeats, "CHUNK", chunk)
        assert _removed(spark, rows) == _want(rows)


def test_repeats_in_a_text_longer_than_a_slice(spark):
    rng = random.Random(13)
    long = "".join(rng.choices("abcdefgh ", k=repeats.SLICE + 60_000))
    at = repeats.SLICE
    texts = [long, long[at - 500 : at + 700], "unlike " * 3, long[5 : 5 + 201] + "tail", long[-200:]]
    rows = list(enumerate(texts))
    assert _removed(spark, rows) == _want(rows)


def test_a_passage_repeated_within_a_text_gives_few_rows(spark):
    rng = random.Random(17)
    part = "".join(rng.choices("abcdefgh", k=9))
    noise = lambda n: "".join(rng.choices("ijklmnop ", k=n))

    def members(times):
        texts = [part * times, noise(150) + part * times + noise(150) + part * times, None]
        df = spark.createDataFrame([(bytes([i]) * 16, (t or "").encode()) for i, t in enumerate(texts)], "row binary, body binary")
        grams = spark.sparkContext.broadcast(bitmap_of(repeats.repeated_grams(df, 200)))
        return repeats.members_of(df, grams, 200).collect()

    few, many = members(60), members(600)
    assert len(few) < 30 and len(many) < 30
    assert sum(r.n for r in many if r.wid is not None) > 1_500

    # In one text and in others, in rows that come twice, across slices, and next to what does not repeat.
    long = part * (repeats.SLICE // 9 + 200)
    texts = [part * 60, noise(150) + part * 60 + noise(150) + part * 60, noise(300) + (part * 23)[:205], noise(250), long[:1_500] + noise(210)]
    rows = [*enumerate(texts), (0, texts[0]), (1, texts[1]), (1, texts[1]), (None, texts[3] + "!")]
    assert _removed(spark, rows) == _want(rows)
    (got,) = repeats.remove_repeats(_docs(spark, [(1, noise(100) + "|" + long + "|" + noise(100), "en")])).collect()
    assert [(s.start, s.end) for s in got.spans] == [(101, 101 + len(long))] and len(got.kept) == 202


def test_no_repeats_and_empty_tables(spark):
    assert _removed(spark, []) == Counter()
    rows = [(1, "x" * 199), (2, "x" * 199), (3, None)]
    assert _removed(spark, rows) == _want(rows)


def test_spans_are_runs_of_the_input(spark):
    # Two repeated strings that touch are one run; what is left may hold a repeat again.
    one, two = "p" * 99 + "q" * 101, "r" * 150 + "s" * 50
    rows = [(1, f"{one}{two}end"), (2, one + "#"), (3, "#" + two)]
    (first,) = [r for r in repeats.remove_repeats(_docs(spark, [(i, t, None) for i, t in rows])).collect() if r.doc_id == 1]
    assert [(s.start, s.end) for s in first.spans] == [(0, 400)] and bytes(first.kept) == b"end"
