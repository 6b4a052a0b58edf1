"""Collocations, vector codes and the permutation index: brute force, and the defined cases."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from framelearn.llm import collocations, permutation_index, vector_codes
from pyspark.sql import functions as F

# --- 11 phrase collocations -----------------------------------------------


def brute_phrases(rows, max_words=3, min_count=10, percent=50, keep=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(words)
            for o in range(1, max_words + 1):
                for i in range(len(words) - o + 1):
                    f[lang, words[i : i + o]] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    found = {}
    for (lang, g), a in candidates.items():
        cuts = [(1_000_000 * a * a // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        holds = [b for (other, h), b in candidates.items() if other == lang and len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h)))]
        if not any(100 * b >= percent * a for b in holds):
            found.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    out = []
    for lang, group in found.items():
        for rank, (score, a, g, left, right) in enumerate(sorted(group)[:keep], 1):
            out.append((lang, rank, g.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def speech(seed, n, words):
    r = random.Random(seed)
    return "".join(r.choice(words) + r.choice([" ", " ", " ", "\t ", ". ", ",", "\n", " \x0b"]) for _ in range(n))


VOCABULARY = "The the of New York city née zu Zu a-b x y \U0001f600 it's".split(" ")
TEXTS = [(speech(k, 60, VOCABULARY[: 4 + k % 8]), ["en", "de", None, "a\tb", ""][k % 5]) for k in range(60)]
TEXTS += [(None, "en"), ("", None), (" . ,\t", "fr"), ("new york " * 400, "en"), ("new york " * 400, "en"), ("one", "xx")]


@pytest.mark.parametrize("size,limits", [(3, {}), (3, {"max_rows": 0}), (2, {}), (4, {}), (4, {"max_rows": 0})])
def test_phrases_equal_brute_force(spark, size, limits):
    docs = spark.createDataFrame([(*t, "x", "x", "x", 1) for t in TEXTS], "text string, lang string, f string, code string, w1 string, `order` int").repartition(3)
    got = collocations.phrase_collocations(docs, max_words=size, keep=15, **limits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(TEXTS, size, keep=15)


def test_phrases_exact_beyond_64_bits(spark):
    counts = spark.createDataFrame([("a", "", 1, 4_000_000_000), ("b", "", 1, 5_000_000_000), ("a", "b", 2, 3_999_999_999)], "g1 string, g2 string, `order` int, f long")
    (row,) = collocations._scored(counts, ["g1", "g2"], "", 1_000_000, {}).collect()
    assert row.score == 1_000_000 * 3_999_999_999**2 // (4_000_000_000 * 5_000_000_000)


def test_phrases_of_nothing(spark):
    assert collocations.phrase_collocations(spark.createDataFrame([], "text string, lang string")).collect() == []
    assert collocations.phrase_collocations(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")).collect() == []


# --- 12 vector codes ------------------------------------------------------


def brute_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[int(math.floor(x * 1024)) if abs(x) < 2**40 else int(x) * 1024 for x in v] for _, v, _ in kept]
    w = len(whole[0]) // parts
    cut = [[v[p * w : (p + 1) * w] for v in whole] for p in range(parts)]
    books = [[list(x) for x in c[:entries]] for c in cut]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [near(x, books[p])[1] for x in cut[p]]
            for e in set(own):
                group = [x for x, k in zip(cut[p], own) if k == e]
                books[p][e] = [sum(c) // len(group) for c in zip(*group)]
    found = [[near(x, books[p]) for x in cut[p]] for p in range(parts)]
    errors = [sum(f[i][0] for f in found) for i in range(len(kept))]
    by = Counter()
    for (_, _, lab), e in zip(kept, errors):
        by[lab] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    most = 2**63 - 1
    return sorted(((i, "".join(f"{f[k][1]:02x}" for f in found), min(errors[k], most), min(by[lab], most), sha) for k, (i, _, lab) in enumerate(kept)), key=repr)


SCHEMA = "vec_id long, embedding array<double>, label int, x string, id string, codes string"


def vectors_of(seed, n, width, clusters, spreads):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, width))
    v = centres[r.integers(0, clusters, n)] + spreads * r.normal(size=(n, width))
    return [(int(k), [float(x) for x in v[k]], int(k % 3) if k % 7 else None) for k in range(n)]


ODD = [(900, None, 1), (901, [None] + [0.0] * 7, 1), (902, [float("nan")] * 8, 2), (903, [float("-inf")] * 8, None), (None, [0.25] * 8, 1), (5, [0.25] * 8, 1), (5, [0.25] * 8, 1)]


@pytest.mark.parametrize(
    "rows,kw",
    [
        (vectors_of(1, 700, 8, 9, 0.02) + ODD, {"entries": 40}),
        (vectors_of(2, 300, 8, 300, 0.5), {"entries": 13, "rounds": 2}),
        (vectors_of(3, 30, 8, 3, 0.0) * 3, {}),
        (vectors_of(4, 40, 8, 3, 0.1) + [(77, [1e30, -1e25] * 4, 2), (78, [3e17] * 8, None)], {"entries": 7}),
        (ODD[-1:], {}),
    ],
)
def test_codes_equal_brute_force(spark, rows, kw):
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(3)
    got = vector_codes.codes_digest(df, **kw)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_codes(rows, **kw)


def test_trees_prune_and_assign_whole_nodes():
    r = np.random.default_rng(0)
    centres = r.integers(-100_000, 100_000, size=(64, 8))
    x = centres[r.integers(0, 64, 4096)] + r.integers(-30, 30, size=(4096, 8))
    tree = vector_codes.Tree.thawed(vector_codes.Tree.grow(x, 16).frozen(), 8)
    codes, sums, counts, work = vector_codes.assign(tree, vector_codes.codebook(centres))
    far = ((tree.rows[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (codes == far.argmin(axis=1)).all() and (x[tree.order] == tree.rows).all()
    assert (counts == np.bincount(codes, minlength=64)).all() and (sums.sum(axis=0) == x.sum(axis=0)).all()
    assert work < 0.3 * 4096 * 64


def test_codes_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vector_codes.codes_digest(empty).collect() == []
    assert vector_codes.codes_digest(spark.createDataFrame([(1, None, 1, "", "", "")], SCHEMA)).collect() == []
    with pytest.raises(ValueError, match="components"):
        vector_codes.codes_digest(spark.createDataFrame([(1, [1.0] * 8, 1, "", "", ""), (2, [1.0] * 4, 1, "", "", "")], SCHEMA))
    one = spark.createDataFrame([(1, [], None, "", "", ""), (2, [0.5, -0.5, 1.0, 2.0], None, "", "", "")], SCHEMA)
    assert [tuple(r)[:4] for r in vector_codes.codes_digest(one).collect()] == [(2, "00000000", 0, 0)]


# --- 13 permutation index -------------------------------------------------


def brute_neighbours(rows, k, asks):
    kept = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    asked = {}
    for i, v in sorted(kept):
        if asks(i):
            asked.setdefault(i, v)
    out = []
    for q, v in asked.items():
        far = []
        for i, x in kept:
            if i != q:
                total = 0.0
                for a, b in zip(x, v):
                    total += (a - b) * (a - b)
                far.append((math.sqrt(total), i))
        out += [(q, rank, i, score) for rank, (score, i) in enumerate(sorted(far)[:k], 1)]
    return sorted(out)


NEAR = "vec_id long, embedding array<double>, ids string, x string, query string, rank int"


@pytest.mark.parametrize("query_bytes", [1 << 26, 700])
def test_neighbours_equal_brute_force(spark, query_bytes):
    rows = [(i, v) for i, v, _ in vectors_of(5, 400, 8, 9, 0.3)]
    rows += [(1000 + k, rows[3][1]) for k in range(60)] + [(20, rows[4][1]), (30, rows[30][1])]
    rows += [(i, v) for i, v, _ in ODD] + [(40, [0.0] * 8), (1100, [0.0] * 8), (1110, [])]
    rows = [r for r in rows if r[1] != []] + [(1110, None)]
    df = spark.createDataFrame([(*r, "x", "x", "x", 1) for r in rows], NEAR).repartition(3)
    got = permutation_index.permutation_search(df.filter("vec_id % 10 = 0"), df, 10, pivots=16, prefix=8, query_bytes=query_bytes)
    assert got.columns == ["query", "rank", "vec", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_neighbours(rows, 10, lambda i: i % 10 == 0)


def test_index_ranks_by_footrule_and_recalls(spark):
    rows = [(i, v) for i, v, _ in vectors_of(6, 3000, 16, 12, 0.25)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    asked = df.filter("vec_id % 50 = 0")
    found = permutation_index.permutation_search(asked, df, 10, pivots=64, prefix=32, at_least=0, share=0.1).cache()
    exact = permutation_index.exact_search(asked, df, 10, pivots=64, prefix=32).cache()
    assert sorted(tuple(r) for r in exact.collect()) == brute_neighbours(rows, 10, lambda i: i % 50 == 0)
    assert permutation_index.recall(found, exact) >= 0.9
    x = np.array([v for _, v in rows[:200]])
    orders = permutation_index.ordered_pivots(x, x[:20], 8)
    files = permutation_index.Files.posted(orders, 20)
    place = [{p: k for k, p in enumerate(o)} for o in orders.tolist()]
    want = [sum(abs(place[r][p] - k) if p in place[r] else 8 for k, p in enumerate(orders[7].tolist())) for r in range(200)]
    assert files.footrule(orders[7]).tolist() == want


def test_neighbours_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    one = spark.createDataFrame([(100, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert permutation_index.permutation_search(empty, empty).collect() == []
    assert permutation_index.permutation_search(one.filter(F.lit(False)), one).collect() == []
    assert permutation_index.permutation_search(one, one).collect() == []
    named = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 1.0]), ("c", [1.0, 1.0])], "vec_id string, embedding array<float>")
    assert [(r.query, r.vec) for r in permutation_index.permutation_search(named, named, 1).collect()] == [("a", "b"), ("b", "c"), ("c", "b")]
