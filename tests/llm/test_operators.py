"""Each numbered operator on small fixtures: brute force, and NULLs, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import math
import random
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pytest
from framelearn.llm import chat, decontam, fingerprints, html_extract, jaccard_join, license_scan, line_dedup, packing, suffix_dedup, toxicity
from framelearn.llm.common import components
from framelearn.llm.queries import tokenizer_file
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, _t string, sid string, score string, h1 string, _drop string, sketch string, bucket string"


def frame(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x", "x", "x") for r in rows], DOCS)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi omicron pi rho sigma tau".split()


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(30)) for _ in range(n))


LONG = prose(6000, 7)
EDGE = [(1, "one line"), (2, None), (3, ""), (None, "no id"), (5, "same"), (5, "same"), (6, " \n\t "), (7, LONG), (8, LONG), (9, "été ÀB\nçà")]


# --- 6 line dedup ---------------------------------------------------------


def brute_lines(rows, min_docs):
    space = " \t\n\x0b\x0c\r"

    def key(line):
        return line.strip(space).translate({c: c + 32 for c in range(65, 91)})

    texts = [(d, t or "") for d, t in rows]
    n = Counter(k for _, t in texts for k in {key(x) for x in t.split("\n")} if k)
    out = []
    for d, t in texts:
        lines = t.split("\n")
        kept = [x for x in lines if n[key(x)] < min_docs]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches,fanout", [(4, 2), (3, 3), (1, 2)])
def test_line_dedup(spark, batches, fanout):
    r = random.Random(batches)
    pool = [prose(3, k) for k in range(12)] + ["  Menu ", "MENU", "menu\t", "", "   "]
    rows = [(k, "\n".join(r.choice(pool) for _ in range(r.randrange(6)))) for k in range(40)] + EDGE
    got = line_dedup.line_dedup(frame(spark, rows), min_docs=4, batches=batches, fanout=fanout)
    assert rows_of(got) == brute_lines(rows, 4)


def test_line_dedup_keeps_columns_and_empty(spark):
    docs = frame(spark, [])
    assert line_dedup.line_dedup(docs).collect() == []
    clash = docs.withColumns({c: F.lit("x") for c in ("row", "t", "body", "drop", "kept", "_n_lines")})
    assert line_dedup.drop_frequent_lines(clash, counted=False).columns == clash.columns
    one = frame(spark, [(k, "a\nb") for k in range(3)]).withColumn("row", F.lit("y"))
    cut = line_dedup.drop_frequent_lines(one, min_docs=3, counted=False).collect()
    assert [(r.text, r._t, r.row) for r in cut] == [("", "x", "y")] * 3


# --- 9 toxicity -----------------------------------------------------------


def labelled(n, seed):
    r = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        toxic = r.random() < 0.3
        text = prose(r.randrange(5, 60), (seed, k).__hash__())
        if toxic:
            text += " " + r.choice(["vilexa", "vilexb", "vilexon"]) + " " + prose(3, k)
        rows.append((k, text))
        labels.append((k, int(toxic)))
    return rows, labels


def test_toxicity_held_out(spark):
    rows, labels = labelled(400, 3)
    known = spark.createDataFrame([*labels, (1, None), (None, 1), labels[0]], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(frame(spark, rows), known).collect()}
    truth = dict(labels)
    held = [k for k in truth if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(got[k].held_out == (k in set(held)) for k in truth)
    assert all(0 <= g.score <= 1 and g.predicted == int(g.score >= 0.5) for g in got.values())
    assert sum(got[k].predicted == truth[k] for k in held) >= 0.95 * len(held)
    # labels of held-out rows are not read
    other = spark.createDataFrame([(k, 1 - t if k in set(held) else t) for k, t in labels], "doc_id long, toxic int")
    again = {r.doc_id: r.score for r in toxicity.toxicity(frame(spark, rows), other).collect()}
    assert all(abs(again[k] - got[k].score) < 1e-9 for k in truth)
    kept = {r.doc_id for r in toxicity.without_toxic(frame(spark, rows), known).collect()}
    assert kept == {k for k in got if not got[k].predicted}


def test_toxicity_edges(spark):
    rows, labels = labelled(200, 5)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    edge = [(1000 + k, t) for k, (_, t) in enumerate(EDGE)] + [(None, None)]
    got = toxicity.toxicity(frame(spark, rows + edge), known).collect()
    assert len(got) == 200 + len(edge) and all(0 <= r.score <= 1 for r in got)
    empty = [r.score for r in got if r.doc_id in (1001, 1002, 1006, None)]
    assert len(set(empty)) == 1
    assert toxicity.toxicity(frame(spark, []), known).collect() == []
    none = toxicity.toxicity(frame(spark, EDGE), known.limit(0)).collect()
    assert {r.score for r in none} == {0.0}


def test_gram_hashes_agree():
    words = [b"ab", b"abcdefgh", "é".encode()]
    joined = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    blank = np.flatnonzero(joined == 0x20)
    starts = np.concatenate(([0], np.repeat(blank[:-1], np.diff(blank))))
    gram, context = toxicity.gram_cells(joined, starts, 4)
    text = joined.tobytes()
    for t in range(1, len(text)):
        s = max(int(starts[t]), t - 3)
        assert int(gram[t]) == toxicity._hash_alone(text[s : t + 1])
        assert int(context[t]) == toxicity._hash_alone(text[s:t])


def test_word_ratios_are_exact(spark):
    """Each word's ratio is the sum over its own grams; an unseen gram has its context's, whatever else was counted."""
    r = random.Random(8)
    words = sorted({"".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 9))).encode() for _ in range(3000)})
    counts = [(w, r.randrange(3), r.randrange(1, 3)) for w in words[::2]] + [(w, 0, 0) for w in words[1::2]]
    counted = spark.createDataFrame([(bytearray(w), t, o) for w, t, o in counts], "word binary, nt long, no long")
    ratios, defaults = (x.cache() for x in toxicity.class_ratios(counted, 4))
    seen, unseen = ({bytes(r["gram"]): r["ratio"] for r in x.collect()} for x in (ratios, defaults))
    tables = toxicity.named(ratios, defaults)
    got = {bytes(r["word"]): r["ratio"] for r in toxicity.word_ratios(counted, *tables, 4).collect()}
    sent = dict(zip(words, toxicity.Ratios(*toxicity.held(*tables, 4)).of(words)))
    assert got.keys() == set(words)
    missing = 0
    for w in words:
        s, want = b" " + w + b" ", 0.0
        for t in range(1, len(s)):
            gram = s[max(0, t - 3) : t + 1]
            missing += gram not in seen
            want += seen.get(gram, unseen.get(gram[:-1], 0.0))
        assert abs(got[w] - want) < 1e-9 and abs(sent[w] - want) < 1e-9
    assert missing > 100


def test_telling_words_against_plain_counts(spark):
    """Words by the texts they stand in: counted anew from the texts, discounted and smoothed by hand."""
    r = random.Random(4)
    vocabulary = ["".join(r.choice("abcdef") for _ in range(r.randrange(1, 4))) for _ in range(60)]
    texts = [(r.choice([1, 0, 0, None]), " ".join(r.choices(vocabulary, k=r.randrange(0, 12)))) for _ in range(150)]
    rows = spark.createDataFrame(texts, "toxic int, text string").repartition(3)
    counted = rows.mapInArrow(toxicity._word_counts, "word binary, " + ", ".join(f"{c} long" for c in toxicity.COUNTS))
    told, other = toxicity.telling_words(counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in toxicity.COUNTS]), 2.0)
    got = {bytes(x["word"]).decode(): x["told"] for x in told.collect()}
    n = {c: Counter(w for t, text in texts if t == c for w in set(text.split())) for c in (1, 0, None)}
    total = {c: sum(n[c].values()) for c in n}
    left = {c: sum(min(2.0, k) for k in n[c].values()) for c in (1, 0)}

    def chance(word, c):
        return max(n[c][word] - 2.0, 0.0) / total[c] + left[c] / total[c] * max(n[None][word], 1) / total[None]

    assert got.keys() == n[1].keys() | n[0].keys()
    assert all(abs(got[w] - math.log(chance(w, 1) / chance(w, 0))) < 1e-9 for w in got)
    assert abs(other - math.log(left[1] / total[1] * total[0] / left[0])) < 1e-9


def test_toxicity_counts_all_rows(spark, monkeypatch):
    """Labelled rows of part 1 beyond those that fit the curve are counted, and the words of unlabelled texts shape the lower orders."""
    rows, labels = labelled(300, 11)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = frame(spark, [*rows, (5000, "zyzzyva")])
    taken = []
    whole = toxicity.class_ratios
    monkeypatch.setattr(toxicity, "class_ratios", lambda counts, order: taken.append(counts) or whole(counts, order))
    toxicity.toxicity(docs, known, fit_rows=20).count()
    got = {bytes(r["word"]): (r["nt"], r["no"]) for r in taken[0].collect()}
    text, toxic = dict(rows), dict(labels)
    part = {k: zlib.crc32(str(k).encode()) % 5 for k in text}
    first = sorted((k for k in text if part[k] == 1), key={r[0]: r[1] for r in known.select("doc_id", F.xxhash64("doc_id")).collect()}.get)[:20]
    counted = [k for k in text if part[k] and k not in first]
    want = [Counter(w for k in counted if toxic[k] == c for w in toxicity.words_of(text[k])) for c in (1, 0)]
    every = {w for t in text.values() for w in toxicity.words_of(t)} | {b"zyzzyva"}
    assert got == {w: (want[0][w], want[1][w]) for w in every}
    shared = {bytes(r["gram"]) for r in toxicity.shared_model(taken[0].select("word"), 6, 0.75).collect()}
    assert b"zyzz" in shared


def test_toxicity_joined_equals_held(spark):
    rows, labels = labelled(150, 9)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = frame(spark, [*rows, *EDGE, rows[0]])
    a, b = (toxicity.toxicity(docs, known, held_grams=n).collect() for n in (10**6, 10))
    assert [(x[0], x[1], x[3]) for x in sorted(a, key=repr)] == [(x[0], x[1], x[3]) for x in sorted(b, key=repr)]
    assert np.allclose(sorted(x.score for x in a), sorted(x.score for x in b), atol=1e-6)
    assert rows_of(toxicity.without_toxic(docs, known, held_grams=10)) == rows_of(toxicity.without_toxic(docs, known))


def test_toxicity_in_parts_equals_whole(spark, monkeypatch):
    """Tables beyond what a task holds at a time are sent in parts: the same figures to the bit, and no text is joined."""
    rows, labels = labelled(150, 9)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = frame(spark, [*rows, *EDGE, rows[0]])
    whole, kept = rows_of(toxicity.toxicity(docs, known)), rows_of(toxicity.without_toxic(docs, known))
    monkeypatch.delattr(toxicity, "joined_features")
    counts = []
    sent = toxicity.sent
    monkeypatch.setattr(toxicity, "HELD_PARTS", 40)
    monkeypatch.setattr(toxicity, "REMEMBERED", 50)
    monkeypatch.setattr(toxicity, "AT_A_TIME", 20)
    monkeypatch.setattr(toxicity, "sent", lambda *a: counts.append(sent(*a)) or counts[-1])
    assert rows_of(toxicity.toxicity(docs, known, held_grams=300)) == whole
    assert rows_of(toxicity.without_toxic(docs, known, held_grams=300)) == kept
    assert all(len(c) > 2 for c in counts)
    # of equal words in any order, and of none
    tables = [c.value for c in counts[0][1:]]
    ratios = toxicity.Ratios(*counts[0][0].value["table"], more=[lambda t=t: t for t in tables])
    words = toxicity.words_of(LONG)[:90]
    assert np.array_equal(ratios.of(words), np.concatenate([ratios.of([w]) for w in words])) and len(ratios.of([])) == 0
    assert sum(len(t[3][0]) for t in tables) and all(len(t[k][0]) for t in tables for k in (0, 1))


def left_in_workers(spark, kind):
    """How many objects of a class, by its name, the Python workers still hold when they run another job's tasks."""

    def count(batches):
        import gc

        import pyarrow as pa

        for _ in batches:
            pass
        gc.collect()
        yield pa.RecordBatch.from_arrays([pa.array([sum(type(x).__name__ == kind for x in gc.get_objects())])], names=["n"])

    return spark.range(0, 64, 1, 32).mapInArrow(count, "n long").agg(F.sum("n")).first()[0]


def test_workers_let_go_of_models(spark):
    rows, labels = labelled(150, 9)
    docs = frame(spark, rows)
    assert toxicity.without_toxic(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).count()
    assert left_in_workers(spark, "Ratios") == 0
    assert packing.token_pieces(docs, tokenizer_file()).count()
    assert left_in_workers(spark, "TextEncoder") == 0


def test_toxicity_filters_in_place(spark):
    rows, labels = labelled(150, 9)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    given = [*rows, *[(1000 + k, t) for k, (_, t) in enumerate(EDGE)], rows[0]]
    docs = frame(spark, given).withColumn("more", F.create_map(F.lit("a"), "doc_id"))
    kept = toxicity.without_toxic(docs, known)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    # the rows are not sent to Python and back for a flag
    assert "MapInArrow" not in plan and "ArrowEvalPython" in plan
    score = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, known).collect()}
    assert sorted((r.doc_id, r.text or "", r.more["a"]) for r in kept.collect()) == sorted((k, t or "", k) for k, t in given if not score[k])


# --- 4 packing ------------------------------------------------------------


def test_packing(spark):
    rows = EDGE + [(100 + k, prose(1 + (k * 37) % 300, k)) for k in range(60)]
    path = tokenizer_file()
    got = [r.asDict() for r in packing.pack(frame(spark, rows), path, capacity=128, with_ids=True).collect()]
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    want = Counter()
    for d, t in rows:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 2]
        first = len(ids) if len(ids) <= 128 else len(ids) % 128 or 128
        cuts = [0, *range(first, len(ids) + 1, 128)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(d, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), tuple(ids[a:b]))] += 1
    assert Counter((g["doc_id"], g["piece"], g["start"], g["length"], g["ids_crc32"], tuple(g["ids"])) for g in got) == want
    bins = {}
    for g in got:
        bins.setdefault(g["sequence_id"], []).append((g["offset"], g["length"]))
    for cells in bins.values():
        at = 0
        for offset, length in sorted(cells):
            assert offset == at
            at += length
        assert at <= 128
    total = sum(g["length"] for g in got)
    assert len(bins) <= 1.05 * -(-total // 128) + 1
    assert packing.pack(frame(spark, []), path).collect() == []


def test_encoder_equals_tokenizer():
    with open(tokenizer_file(), "rb") as f:
        encode = packing.TextEncoder(f.read())
    r = random.Random(2)
    texts = ["", "  a  b", "a ", "\n\n a \n\n", "it's  we'll", "a <|endoftext|> b", "日本 語 12.5km", " x y"]
    texts += ["".join(r.choice(" \n\tab'sé1.") for _ in range(25)) for _ in range(300)]
    for t in texts:
        assert np.frombuffer(encode(t), "<u4").tolist() == encode.whole.encode(t, add_special_tokens=False).ids


def test_local_search_empties_bins():
    for counts, capacity, least in (({3: 9, 4: 7}, 10, 6), ({62: 4, 78: 3, 15: 9, 26: 5, 29: 3}, 100, 9)):
        first, best = packing.best_fit(counts, capacity), packing.packing_plan(counts, capacity)
        assert sum(n for _, n in best) == least < sum(n for _, n in first)
        for plan in (first, best):
            assert all(sum(b) <= capacity for b, _ in plan)
            assert sum((Counter({x: c * n for x, c in Counter(b).items()}) for b, n in plan), Counter()) == Counter(counts)


def test_local_search_goes_on_to_the_end():
    """More than 2000 exchanges are made when they gain."""
    pieces = [1000 + k for k in range(2010)]
    [(bins, n)] = packing.local_search([((x,), 1) for x in pieces], sum(pieces))
    assert n == 1 and sorted(bins) == pieces


# --- 8 license scan -------------------------------------------------------


def test_license_scan(spark):
    filler = prose(80, 1)
    rows = EDGE + [
        (20, f"{filler}\nReleased under the MIT-License. MIT license\n{filler}"),
        (21, "Licensed under the Apache License, Version 2.0."),
        (22, f"all words reserved right {filler}"),
        (23, f"{filler} Licensed under CC BY-NC 4.0. {filler}"),
        (24, "mit license mit licenses xmit license"),
        (25, "All\nrights reserved"),
    ]
    got = {}
    for r in license_scan.license_scan(frame(spark, rows)).collect():
        got.setdefault(r.doc_id, r)
    split = re.compile(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    for d, t in rows:
        words = [w for w in split.split((t or "").translate({c: c + 32 for c in range(65, 91)})) if w]
        at = [(i, label) for p, label in license_scan.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        r = got[d]
        assert (r.n_words, r.n_base) == (len(words), len(at))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in at}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
    assert got[20].labels == "mit" and got[20].n_base == 2
    assert got[21].labels == "apache" and got[23].labels == "cc" and got[23].score > 0.85
    assert got[22].labels == "" and got[22].score == 0 and got[25].labels == "" and got[24].n_base == 1


def test_license_wrapped_statements(spark):
    """Every statement is found wherever its lines are broken; a blank line parts statements."""
    statements = [(label, t) for label, ts in sorted(license_scan.TEMPLATES.items()) for t in ts if label != "all-rights"]
    rows, want = [], {}
    for k, (label, t) in enumerate(statements):
        for j, (width, prefix, end) in enumerate([(72, "", "\n"), (30, " * ", "\r\n"), (18, "# ", "\n")]):
            lines = textwrap.wrap(f"{prose(9, k)} {t} {prose(9, j)}", width)
            rows.append((100 * k + j, end.join(prefix + line for line in lines)))
            want[100 * k + j] = label
    words = license_scan.TEMPLATES["bsd"][0].split()
    rows.append((9000, " ".join(words[:10]) + "\n\n" + " ".join(words[10:])))
    want[9000] = ""
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.license_scan(frame(spark, rows)).collect()}
    assert all(want[d] in got[d][0].split(",") and got[d][1] == (1.0 if want[d] else 0.0) for d in want), got


def test_license_containment_is_exact():
    """The filters lose no block that reaches the threshold."""
    r = random.Random(4)
    words = [f"w{k}" for k in range(14)]
    templates = {"a": [" ".join(r.sample(words, 6))], "b": [" ".join(r.sample(words, 9)), " ".join(r.sample(words, 3))]}
    known = license_scan.Templates(templates, 0.8, {w.encode(): r.randrange(50) for w in words})
    for _ in range(500):
        block = [w.encode() for w in r.choices([*words, "x", "y"], k=r.randrange(1, 14))]
        want = {k: len({*block} & {x for x in known.rank if known.rank[x] in ranks}) for k, (_, ranks, _) in enumerate(known.sets)}
        assert known.matches(block) == {k: c for k, c in want.items() if c >= known.sets[k][2]}


# --- 3 HTML ---------------------------------------------------------------


def test_html_extraction(spark):
    body = "".join(f"<p>{prose(30, k)}</p>" for k in range(3))
    text = "\n".join(prose(30, k) for k in range(3))
    rows = [
        (1, "u", f"<html><head><title>t</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href='/'>a</a></ul></nav>"
         f"<div class=\"ad\">{prose(9, 5)}</div><article><h1>T &amp; U</h1>{body}<p><b>open<br>line<p>last&nbsp;one</article><footer>&copy; x</footer>"),
        (2, "u", None),
        (3, None, ""),
        (4, "u", f"<main><header><h1>H</h1></header>{body}<aside>side</aside><form><p>mail</p></form><section id='comments'><p>{prose(20, 9)}</p></section></main>"),
        (5, "u", f"<div><a href='/x'>one</a> <a href='/y'>two</a></div>{body}<div class='cookie-notice'>We use cookies</div>"),
        (6, "u", "<article><p>a < b &lt;i&gt; <!-- <p>no</p> --> c"),
        (6, "u", "<" * 50),
        (7, "u", "<article>" + "<b>" * 3000 + "deep" + "<p>x" * 1000),
    ]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")
    got = [r.asDict() for r in html_extract.extract(pages).collect()]
    by = {}
    for g in got:
        assert g["n_chars"] == len(g["text"])
        by.setdefault(g["page_id"], []).append(g["text"])
    assert by[1] == [f"T & U\n{text}\nopen line\nlast one"]
    assert by[2] == [""] and by[3] == [""]
    assert by[4] == [f"H\n{text}"] and by[5] == [text]
    assert "a < b <i> c" in by[6] and by[7][0].startswith("deep\nx\nx")
    assert html_extract.extract(pages.limit(0)).collect() == []


def test_html_wrappers_keep_the_article():
    tree = html_extract.train()
    body = "".join(f"<p>{prose(30, k)}</p>" for k in range(3))
    text = "\n".join(prose(30, k) for k in range(3))
    mail = "<form><p>your mail</p></form><div class='comments'><article><p>first</p></article></div>"
    for page in (
        f"<form id='aspnetForm'><article>{body}</article>{mail}</form>",
        f"<form id='aspnetForm'><div>{body}</div></form>",
        f"<div class='layout with-sidebar'><div class='content'>{body}</div><div class='sidebar'><p>more</p></div></div>",
        f"<div id='page-header-social'><main>{body}</main>{mail}</div>",
        f"<div class='with-sidebar'><article>{body}</article></div><nav><p>{prose(300, 1)}</p></nav>",
    ):
        assert html_extract.main_text(page, tree) == text, page
    titled = f"<article><div class='entry-header'><h1>T</h1></div>{body}<div class='share'><p>tell</p></div></article>"
    assert html_extract.main_text(titled, tree) == "T\n" + text
    short = f"<article><p>{prose(9, 4)}</p></article><div class='sidebar'>{body}</div>"
    assert html_extract.main_text(short, tree) == prose(9, 4)
    deep = "<div class='nav'>" + "<div>" * 600 + "x" + "</div>" * 600 + "<p>menu</p></div>" + f"<article>{body}</article>"
    assert html_extract.main_text(deep, tree) == text


def _features_used(node):
    return set() if node.feature < 0 else {html_extract.FEATURES[node.feature]} | _features_used(node.low) | _features_used(node.high)


def test_tree_reads_density_and_neighbours():
    used = _features_used(html_extract.train())
    assert "density" in used and used & {"density_before", "density_after"} and used & {"words_before", "words_after"}


def test_html_pages_without_named_regions():
    """Held-out pages: pieces marked 1 are article text, 0 are not; each holds one block."""
    link = "<a href='/x'>{}</a>".format
    menu = [(f"<li>{link(w)}</li>", 0) for w in ("Home", "News of today", "About us")]
    cells = [(f"<td>{w}</td>", 1) for w in ("Oak", "12 m", "Ash", "9 m")]
    held_out = [
        [*menu, (f"<h1>{prose(7, 1)}</h1>", 1), (f"<p>{prose(52, 2)}</p>", 1), ("<li>Milk</li>", 1), ("<li>Two eggs</li>", 1), (f"<p>{prose(31, 3)}</p>", 1), ("<p>Copyright 2024 Some House</p>", 0)],
        [(f"<p>{link('Home')}</p>", 0), (f"<p>{link('Archive')}</p>", 0), (f"<h2>{prose(5, 9)}</h2>", 1), (f"<p>{prose(44, 4)}</p>", 1), *cells, (f"<p>{prose(37, 5)}</p>", 1)],
        [("<p>We use cookies to improve this page. Accept all.</p>", 0), (f"<div>{prose(41, 6)}</div>", 1), ("<div>He left.</div>", 1), (f"<div>{prose(29, 7)}</div>", 1), (f"<div>{link('Next page')}</div>", 0)],
        [(f"<div>{link('One')}</div>", 0), (f"<div>{link('Two')}</div>", 0), (f"<h1>{prose(4, 8)}</h1>", 1), *[(f"<p>{prose(n, n)}</p>", 1) for n in (63, 4, 19, 88)], ("<h3>More</h3>", 0), *menu * 2],
        [(f"<p>{prose(35, 1)}</p>", 1), (f"<p>{link(prose(9, 2))}</p>", 1), (f"<p>{prose(48, 3)}</p>", 1), (f"<div>{link('Log in')} {link('Sign up')}</div>", 0)],
        [(f"<td>{link('Start')}</td>", 0), (f"<td>{link('Shop')}</td>", 0), (f"<td>{prose(95, 3)}</td>", 1), ("<td>All rights reserved. Privacy policy</td>", 0)],
        [(f"<div>{prose(n, n)}</div>", 1) for n in (3, 6, 2, 14, 5)],
        [(f"<p>{prose(120, 2)} {link('a source')} {prose(60, 4)}</p>", 1)],
    ]
    tree = html_extract.train()
    right = total = 0
    for page in held_out:
        found = html_extract.blocks("".join(piece for piece, _ in page))
        assert len(found) == len(page)
        right += (html_extract.decide(tree, html_extract.features(found)) == [label for _, label in page]).sum()
        total += len(page)
    assert total >= 50 and right / total >= 0.95, (right, total)


def test_html_names_are_hints():
    tree = html_extract.train()
    body, more = prose(30, 1), prose(24, 2)
    for wrap in ("<article>{}</article>", "<main>{}</main>", "<div class='content'>{}</div>"):
        for name in ("id='side-effects'", "class='search-algorithms'", "id='legalAspects'", "class='tags-in-use'"):
            page = wrap.format(f"<p>{body}</p><section {name}><h2>Head</h2><p>{more}</p><ul><li>nausea</li><li>thirst</li></ul></section>")
            assert html_extract.main_text(page, tree) == f"{body}\nHead\n{more}\nnausea\nthirst", page
        for name in ("share-buttons", "related-posts", "site-footer", "comment-list", "cookie_notice", "adsBox", "navbar"):
            page = wrap.format(f"<p>{body}</p><div class='{name}'><p>{more}</p></div><p>{body}</p>")
            assert html_extract.main_text(page, tree) == f"{body}\n{body}", page
    # in a named article without such names no figure speaks against a block
    rng = np.random.default_rng(3)
    n = 20_000
    x = np.column_stack([rng.integers(1, 200, n), rng.random(n).round(1), rng.integers(0, 5, n), np.ones(n), rng.integers(0, 99, n), rng.random(n).round(1), rng.integers(0, 99, n), rng.random(n).round(1), rng.integers(1, 90, n), np.zeros(n), rng.integers(0, 4, n)])
    assert html_extract.decide(tree, x).all()
    # phrases, links and short ends of a named article are its text
    page = f"<article><p>{body}</p><p>Copyright and cookies</p><p><a href='/'>all of it</a></p><p>See the newsletter.</p></article>"
    assert html_extract.main_text(page, tree) == f"{body}\nCopyright and cookies\nall of it\nSee the newsletter."


def test_tree_learns_its_table():
    x, y = html_extract._training_table()
    assert (html_extract.decide(html_extract.train(), x) == y).mean() >= 0.95


# --- 7 fingerprints -------------------------------------------------------


def brute_shingles(text, n=5):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", (text or "").lower()) if w]
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def test_fingerprints(spark):
    near = prose(300, 1)
    rows = [(3 * k, prose(20 + 13 * k, k)) for k in range(30)] + [(200, near), (201, near + " tail"), (202, None), (203, ""), (7, "a b"), (7, "z y x"), (None, "first")]
    got = fingerprints.document_fingerprints(frame(spark, rows)).collect()
    ordered = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = {}
    for (d, t), (_, u) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + u[:half]
        a, b, c = brute_shingles(t), brute_shingles(edited), brute_shingles(u)
        want[(d, len(t), hashlib.sha256(edited.encode()).hexdigest())] = [1.0 if not a and not x else len(a & x) / len(a | x) for x in (b, c)]
    assert len(got) == len(rows)
    for r in got:
        near_edited, near_next = want[(r.doc_id, r.n_chars, r.edited_sha256)]
        assert abs(r.near_edited - near_edited) < 0.2 and abs(r.near_next - near_next) < 0.2
    assert len(fingerprints.document_fingerprints(frame(spark, [(1, "x y")])).collect()) == 1
    assert fingerprints.document_fingerprints(frame(spark, [])).collect() == []


def test_sketch_algebra(spark):
    a, b = prose(1500, 1), prose(1500, 2)
    docs = spark.createDataFrame([(1, a, a + " " + b), (2, b, a + " " + b)], "g long, text string, both string")
    s = docs.select("g", fingerprints.sketch(F.col("text")).alias("x"), fingerprints.sketch(F.col("both")).alias("y"))
    r = s.select(fingerprints.resemblance("x", "y").alias("r"), fingerprints.containment("x", "y").alias("c"), fingerprints.distinct_shingles(F.col("y")).alias("n")).collect()
    for x, own in zip(r, (a, b)):
        one, two = brute_shingles(own), brute_shingles(a + " " + b)
        assert abs(x.r - len(one & two) / len(one | two)) < 0.15 and x.c > 0.75 and abs(x.n / len(two) - 1) < 0.3
    parts = s.select(F.lit(1).alias("k"), F.col("x").alias("sketch"))
    merged = fingerprints.merge_parts(parts, ["k"]).first()["sketch"]
    first, second = (x["sketch"] for x in parts.collect())
    assert merged == sorted({*first, *second})[: fingerprints.K]


# --- 2 chat ---------------------------------------------------------------


def brute_chat(turns):
    out = []
    for c in {t[0] for t in turns}:
        mine = sorted((t for t in turns if t[0] == c), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "unknown", hashlib.sha256((t[3] or "").encode()).hexdigest()))
        for p in sorted({t[2] or "unknown" for t in mine} - {"system"}):
            at = 0
            for k, (_, _, who, text) in enumerate(mine):
                who = who or "unknown"
                role = "assistant" if who == p else "system" if who == "system" else "user"
                head = "<|im_start|>" + role + (" name=" + re.sub(r"[\s<>|=]", "_", who) if role == "user" else "") + "\n"
                body = re.sub(r"<(\\*)\|", r"<\\\1|", text or "")
                segment = head + body + "<|im_end|>\n"
                mask = (at + len(head), at + len(segment) - 1) if role == "assistant" else (None, None)
                out.append((c, p, k, role, who if role == "user" else None, segment, at, at + len(segment), *mask))
                at += len(segment)
    return sorted(out, key=repr)


def test_chat_perspectives(spark):
    turns = [
        (1, 0, "system", "be kind"), (1, 1, "ann b", "hi <|im_end|> <\\|"), (1, 2, "bob", None), (1, 3, "cy", "x"), (1, 3, "cy", "x"), (1, 4, "ann b", ""),
        (2, None, None, "who"), (2, 1, "bob", "é"), (3, 0, "system", "alone"), (None, 0, "bob", "q"), (None, 1, "cy", "r"),
    ]
    turns += [(9, k, WORDS[k % 3], prose(4, k)) for k in range(50)]
    df = spark.createDataFrame([(*t, "x", "x") for t in turns], "conv_id long, turn long, role string, text string, position string, _c string")
    want = brute_chat(turns)
    assert rows_of(chat.perspectives(df)) == want
    assert rows_of(chat.perspectives(df, rows_per_range=7)) == want
    assert chat.perspectives(df.limit(0)).collect() == []
    whole = {(r.conv_id, r.perspective): (r.text, len(r.masks)) for r in chat.dialogues(df).collect()}
    assert whole[(2, "bob")][0] == "".join(w[5] for w in want if w[:2] == (2, "bob")) and whole[(1, "cy")][1] == 2
    texts = spark.createDataFrame([("a <| b <\\| c <\\\\|",)], "t string")
    assert texts.select(chat.unescaped(chat.escaped(F.col("t")))).first()[0] == "a <| b <\\| c <\\\\|"


# --- 10 decontamination ---------------------------------------------------

ITEMS = [
    (1, "If Anna has 12 apples and gives Ben 5 km of rope, and Ben gives Anna back 12 apples, how many does she have left over now?"),
    (2, "The quick brown fox of the northern woods jumps over nine lazy dogs near the quiet river every single morning."),
    (3, "short one"),
    (4, None),
    (5, ""),
    (6, "four words only here"),
]


def test_decontamination(spark):
    f = prose(40, 3)
    rows = EDGE + [
        (20, f"{f}. {ITEMS[0][1]} {f}"),
        (21, f"{f}. If Carla has 80 apples and gives Dan 3 miles of rope, and Dan gives Carla back 80 apples, how many does she have left over now? {f}"),
        (22, f"{f}. If Carla has 80 apples and gives Dan 3 miles of rope, and Eve gives Fay back 81 apples, how many does she have left over now? {f}"),
        (23, f"{f} {ITEMS[1][1].upper()} {f}"),
        (24, f"the quick brown fox of the northern woods {f}"),
        (25, f"{f} short one {f}"),
        (26, "four words only here"),
        (None, ITEMS[1][1]),
    ]
    items = spark.createDataFrame([(*r, "x") for r in [*ITEMS, ITEMS[0]]], "item_id long, text string, share string")
    got = {(r.doc_id, r.item_id): r for r in decontam.benchmark_leaks(frame(spark, rows), items).collect()}
    assert set(got) == {(20, 1), (21, 1), (23, 2), (26, 6), (None, 2)}
    assert got[(20, 1)].verbatim and not got[(21, 1)].verbatim and got[(21, 1)].n_changed > 0
    kept = [r.doc_id for r in decontam.without_leaks(frame(spark, rows), items).collect()]
    assert sorted(kept, key=repr) == sorted([d for d, t in rows if d not in (20, 21, 23, 26) and t != ITEMS[1][1]], key=repr)
    assert decontam.benchmark_leaks(frame(spark, rows), items.limit(0)).collect() == []
    assert decontam.benchmark_leaks(frame(spark, []), items).collect() == []


def test_reparameterised_items(spark):
    f = prose(40, 4)
    first = "yesterday the farmer Maria Lopez sold 5 red baskets and 5 blue baskets to her neighbour Karl, while old Ann Lee Park from New York carried 30 kg of corn home to Maria Lopez by cart"
    second = "on most days the two brothers Tom and Sam walk 14 miles to reach the small village school in the hills"
    rows = [
        # names of other lengths, three of them; equal numbers of the item with different ones; both
        (1, f"{f} {first.replace('Maria Lopez', 'Eva').replace('Ann Lee Park', 'Bo').replace('New York', 'Paris')} {f}"),
        (2, f"{f} {first.replace('5 red', '8 red')} {f}"),
        (3, f"{f} {first.replace('5 red', '6 red').replace('5 blue', '9 blue').replace('Karl', 'Jan Berg')} {f}"),
        (4, f"{f} {second.replace(' Tom', chr(10) + 'Peter').replace('14', '20')} {f}"),
        (5, f"{f} {second} {f}"),
        # every value of its own
        (6, f"{f} {first.replace('5 blue', '7 blue').replace('home to Maria Lopez', 'home to Zoe').replace('neighbour Karl', 'neighbour Zoe')} {f}"),
        (7, f"{f} the farmer sold baskets and her neighbour carried corn home by cart {f}"),
    ]
    items = spark.createDataFrame([(1, first), (2, second)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.benchmark_leaks(frame(spark, rows), items).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 1), (4, 2), (5, 2)}
    assert all(got[k].share == 1.0 for k in got)
    assert got[(5, 2)].verbatim and [got[k].n_changed for k in [(1, 1), (2, 1), (3, 1), (4, 2)]] == [4, 1, 3, 2]
    strict = decontam.benchmark_leaks(frame(spark, rows), items, max_broken=1.0)
    assert {(r.doc_id, r.item_id) for r in strict.collect()} == set(got) | {(6, 1)}


# --- 5 suffix dedup -------------------------------------------------------


def brute_repeats(rows, width):
    texts = [(d, (t or "").encode()) for d, t in rows]
    n = Counter(t[i : i + width] for _, t in texts for i in range(len(t) - width + 1))
    out = []
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - width + 1):
            if n[t[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        spans = sum(bool(g) and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def test_suffix_dedup(spark):
    r = random.Random(6)
    base = prose(400, 1)
    rows = [(100 + k, (v := r.randrange(2000), prose(r.randrange(40), k) + base[v : v + r.randrange(600)] + prose(r.randrange(30), -k))[1]) for k in range(40)]
    rows += EDGE[:7] + [(50, "ab" * 300), (51, "é" * 200), (52, base), (53, base)]
    want = brute_repeats(rows, 100)
    assert rows_of(suffix_dedup.repeats_digest(frame(spark, rows), width=100)) == want
    assert rows_of(suffix_dedup.repeats_digest(frame(spark, rows), width=100, task_bytes=3000, bucket_bytes=500)) == want
    cut = {r.doc_id: r for r in suffix_dedup.remove_repeats(frame(spark, rows), width=100).collect()}
    for d, size, removed, spans, sha in want:
        if d != 5:
            assert hashlib.sha256(cut[d].kept).hexdigest() == sha and len(cut[d].spans) == spans
            assert sum(s["end"] - s["start"] for s in cut[d].spans) == removed
    assert suffix_dedup.repeats_digest(frame(spark, [])).collect() == []


def test_suffix_sort():
    r = random.Random(8)
    assert (suffix_dedup._shifts() >= 0).all()
    for width, alphabet in ((70, b"ab"), (400, b"abcd")):
        block = bytes(r.choice(alphabet) for _ in range(900))
        text = np.frombuffer(block + b"x" + block[100:] + b"aaaa" * 300 + block[:500], np.uint8)
        starts = np.arange(len(text) - width + 1)
        order, _ = suffix_dedup.sorted_suffixes(text, starts, width)
        raw = text.tobytes()
        assert [raw[i : i + width] for i in order] == sorted(raw[i : i + width] for i in starts)
        n = Counter(raw[i : i + width] for i in starts)
        assert suffix_dedup.repeated_starts(text, starts, width).tolist() == [n[raw[i : i + width]] > 1 for i in starts]


# --- 1 Jaccard join -------------------------------------------------------


def brute_components(rows, words, percent):
    def tokens(t):
        w = [x for x in re.split(rb"[\x20\x09-\x0d]+", (t or "").encode().lower()) if x]
        return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else (frozenset([tuple(w)]) if w else frozenset())

    sets = [(d, tokens(t)) for d, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = Counter()
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    kinds = {s for _, s in sets if s}
    for a in kinds:
        links[a] = sum(a != b and 100 * len(a & b) >= percent * len(a | b) for b in kinds)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i)) if s else d, links[s]) for i, (d, s) in enumerate(sets)), key=repr)


def near_copies(seed, groups=12, size=12):
    r = random.Random(seed)
    rows = []
    for g in range(groups):
        base = prose(r.choice([3, 8, 30, 90, 200]), (seed, g).__hash__()).split()
        for _ in range(r.randrange(1, size)):
            copy = list(base)
            for _ in range(r.randrange(0, 1 + len(base) // 20)):
                copy[r.randrange(len(copy))] = f"edit{r.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    return rows


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80)])
def test_jaccard_components(spark, words, percent, monkeypatch):
    rows = near_copies(words) + EDGE
    want = brute_components(rows, words, percent)
    assert rows_of(jaccard_join.jaccard_components(frame(spark, rows), words, percent)) == want
    monkeypatch.setattr(jaccard_join, "GROUP_SETS", 4)
    monkeypatch.setattr(jaccard_join, "BLOCK", 3)
    assert rows_of(jaccard_join.jaccard_components(frame(spark, rows), words, percent)) == want


def test_jaccard_shuffles_tokens_once(spark, monkeypatch):
    sets = spark.createDataFrame([(k, 9, 3, [t + k // 2 for t in range(6)], [70]) for k in (*range(30), 3)], "sid long, n long, slack long, counted array<long>, late array<long>")
    seen = []
    monkeypatch.setattr(jaccard_join, "keep", lambda df, *how: seen.append(df) or df)
    assert jaccard_join.candidate_groups(sets, 90).count() == 30
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    # by token for counts and rows at once, then by set; the late tokens' exchange names all columns
    assert plan.count("Exchange hashpartitioning(token") == 1 and plan.count("Exchange hashpartitioning(") == 3
    assert "Join" not in plan


def test_jaccard_texts_are_not_shuffled(spark, monkeypatch):
    """Names of texts beyond one broadcast go in two; whole and cut groups alike."""
    rows = near_copies(1, groups=6)
    docs = frame(spark, rows)
    want = brute_components(rows, 3, 80)
    kept = rows_of(jaccard_join.one_of_each(docs, 3, 80).select("doc_id", "text"))
    monkeypatch.setattr(jaccard_join, "GROUP_SETS", 4)
    monkeypatch.setattr(jaccard_join, "BLOCK", 3)
    sets = jaccard_join.described(docs, 3, 80, jaccard_join.workspace(spark, "test"))
    placed = jaccard_join._placed(jaccard_join.candidate_groups(sets.filter("n > 0"), 80), 80)
    whole = {bool(r[0]) for r in placed.select(F.col("left_block") < 0).distinct().collect()}
    most = max(r["count"] for r in placed.select("sid", F.col("left_block") < 0).distinct().groupBy(F.col("(left_block < 0)")).count().collect())
    assert most > 1
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", -(-most // 2))
    members = jaccard_join._wanted_sets(docs, sets, placed, 3)
    plan = members._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan and plan.count("Scan ExistingRDD") > len(whole)
    assert {(r["sid"], r["task"], r["left_block"], r["side"]) for r in members.collect()} == {(r["sid"], r["task"], r["left_block"], r["side"]) for r in placed.collect()}
    assert rows_of(jaccard_join.jaccard_components(docs, 3, 80)) == want
    assert rows_of(jaccard_join.one_of_each(docs, 3, 80).select("doc_id", "text")) == kept


def test_jaccard_blocks_hold_few_tokens(spark, monkeypatch):
    """A group of few sets with many tokens is cut too, and its links stay."""
    monkeypatch.setattr(jaccard_join, "GROUP_TOKENS", 4000)
    groups = spark.createDataFrame([(k, 1, 1000 + k) for k in range(40)], "sid long, grp long, n long")
    places = jaccard_join._placed(groups, 90).collect()
    size = {}
    for r in places:
        size[r.left_block, r.right_block] = size.get((r.left_block, r.right_block), 0) + 1000 + r.sid
    assert len(size) > 1 and max(size.values()) <= 4000 + 2 * 1040
    met = {pair for block in size for pair in _pairs_of(places, block)}
    assert met == {(a, b) for a in range(40) for b in range(a + 1, 40)}
    monkeypatch.setattr(jaccard_join, "GROUP_TOKENS", 100)
    rows = near_copies(4, 6)
    assert rows_of(jaccard_join.jaccard_components(frame(spark, rows), 3, 90)) == brute_components(rows, 3, 90)


def _pairs_of(places, block):
    sides = [{r.sid for r in places if (r.left_block, r.right_block) == block and r.side == k} for k in (0, 1)]
    others = sides[1] or sides[0]
    return {(min(a, b), max(a, b)) for a in sides[0] for b in others if a != b}


def test_jaccard_keeps_one(spark):
    rows = near_copies(1, groups=6) + EDGE
    components_ = brute_components(rows, 5, 80)
    kept = jaccard_join.one_of_each(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert set(ids) == {c for _, n, c, _ in components_ if n} | {2, 3, 6} and max(ids.values()) == 1
    assert jaccard_join.jaccard_components(frame(spark, [])).collect() == []


def test_linked_pairs_equal_brute_force():
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 60, 120).astype(np.uint64)
    sets = []
    for _ in range(60):
        own = base[r.random(120) < 0.95]
        sets.append(np.unique(np.concatenate((own, r.integers(0, 1 << 60, r.integers(0, 12)).astype(np.uint64)))))
    i, j = jaccard_join.linked_pairs(sets, 80)
    want = [(a, b) for a in range(60) for b in range(a + 1, 60) if 100 * (c := len(np.intersect1d(sets[a], sets[b]))) >= 80 * (len(sets[a]) + len(sets[b]) - c)]
    assert 0 < len(want) < 1770 and sorted(zip(i.tolist(), j.tolist())) == want


def test_components(spark):
    r = random.Random(9)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1100)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: find(k) for k in root if any((k in e and e[0] != e[1]) for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
