import re

import pytest
from pyspark.sql import functions as F

from framelearn.operators import bpe, text
from framelearn.plans import scale

PATTERN = r"""([,.:;?_"()']|--|\s)"""
TEXTS = [
    'Hello, world. Is this-- a test?',
    "a---b -- c --- it's (odd) \"quoted\"; _x_:y",
    "tabs\tand\nnew lines\r\n\x0bvertical no-break　wide \x1f unit \x1c file",
    "Well! <|endoftext|> <|unk|>",
    "   ",
    "",
    "é" * 3 + "-" * 5 + "ß",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def split_plain(t, bang=False):
    pattern = PATTERN.replace("?_", "?_!") if bang else PATTERN
    return [p for p in re.split(pattern, t) if p.strip()]


@pytest.mark.parametrize("bang", [False, True])
def test_tokens_equal_plain_split(docs, bang):
    got = {r["doc_id"]: r["tokens"] for r in text.tokenize(docs, bang=bang).collect()}
    assert got == {i: split_plain(t, bang) for i, t in enumerate(TEXTS)}


def test_null_text_stays_null(spark):
    row = text.tokenize(spark.createDataFrame([(1, None)], "doc_id long, text string")).first()
    assert row["tokens"] is None


def plain_vocab(texts, specials=()):
    words = sorted({t for x in texts for t in split_plain(x)})
    return {t: i for i, t in enumerate([*words, *specials])}


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 3])
def test_vocab_is_sorted_and_specials_come_last(docs, rows_per_bucket):
    specials = [text.END_OF_TEXT, text.UNKNOWN]
    vocab = text.build_vocab(text.tokenize(docs), specials=specials, rows_per_bucket=rows_per_bucket)
    got = {r["token"]: r["id"] for r in vocab.collect()}
    assert got == plain_vocab(TEXTS, specials)


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}])
def test_encode_and_decode(spark, docs, limits):
    known = docs.filter("doc_id < 4")
    vocab = text.build_vocab(text.tokenize(known), specials=[text.END_OF_TEXT, text.UNKNOWN])
    table = {r["token"]: r["id"] for r in vocab.collect()}
    ids = text.encode(text.tokenize(docs), vocab, on_unknown="unk", **limits)
    got = {r["doc_id"]: r["ids"] for r in ids.collect()}
    assert got == {i: [table.get(t, table[text.UNKNOWN]) for t in split_plain(x)] for i, x in enumerate(TEXTS)}
    names = {v: k for k, v in table.items()}
    back = {r["doc_id"]: r["decoded"] for r in text.decode(ids, vocab, **limits).collect()}
    for i, values in got.items():
        assert back[i] == re.sub(r"\s+([,.?!\"()'])", r"\1", " ".join(names[v] for v in values))


REPEATED = [(1, ["a", "b"]), (1, ["b"]), (None, ["a"]), (None, ["a"]), (2, None), (2, []), (3, ["b", "?", "a"]), (3, ["?"]), (3, [None, "a"]), (3, ["a", None])]


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}])
def test_repeated_and_null_keys_keep_their_own_ids(spark, limits):
    rows = spark.createDataFrame(REPEATED, "doc_id long, tokens array<string>").repartition(3)
    vocab = spark.createDataFrame([("a", 0), ("b", 1), (text.UNKNOWN, 2)], "token string, id long")
    table = {"a": 0, "b": 1}

    def sorted_rows(pairs):
        return sorted(((k, v) for k, v in pairs), key=repr)

    ids = text.encode(rows, vocab, on_unknown="unk", **limits)
    assert ids.columns == ["doc_id", "tokens", "ids"]
    want = [(k, None if t is None else [table.get(x, 2) for x in t]) for k, t in REPEATED]
    assert sorted_rows((r["doc_id"], r["ids"]) for r in ids.collect()) == sorted_rows(want)
    back = text.decode_arrays(ids.drop("tokens"), vocab, "ids", "tokens", **limits)
    names = ["a", "b", text.UNKNOWN]
    assert sorted_rows((r["doc_id"], r["tokens"]) for r in back.collect()) == sorted_rows((k, None if v is None else [names[i] for i in v]) for k, v in want)
    lists = spark.createDataFrame([("a", [7]), ("b", [8, 9]), ("?", [])], "token string, ids array<long>")
    known = rows.filter("tokens is null or not exists(tokens, x -> x is null)")
    strung = text.encode_by_dictionary(known, lists, **limits).collect()
    each = {"a": [7], "b": [8, 9], "?": []}
    want = [(k, None if t is None else [i for x in t for i in each[x]]) for k, t in REPEATED if t is None or None not in t]
    assert sorted_rows((r["doc_id"], r["ids"]) for r in strung) == sorted_rows(want)


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}])
def test_strict_encode_raises_on_unknown(spark, docs, limits):
    vocab = text.build_vocab(text.tokenize(docs.filter("doc_id = 0")))
    with pytest.raises(Exception, match="not in vocabulary"):
        text.encode(text.tokenize(docs), vocab, **limits).collect()


@pytest.mark.parametrize("n", [0, 4, 5, 6, 17])
@pytest.mark.parametrize("length,stride", [(4, 1), (4, 4), (4, 7), (1, 1)])
def test_windows(spark, n, length, stride):
    ids = list(range(100, 100 + n))
    df = spark.createDataFrame([(1, ids)], "doc_id long, ids array<long>")
    want = [(ids[i : i + length], ids[i + 1 : i + length + 1]) for i in range(0, n - length, stride)]
    rows = text.lm_windows(df, length, stride).orderBy("chunk_id").collect()
    assert [(r["input_ids"], r["target_ids"]) for r in rows] == want
    long = df.select("doc_id", F.posexplode("ids").alias("pos", "id"))
    rows = text.lm_windows_long(long, length, stride, ["doc_id"]).orderBy("chunk_id").collect()
    assert [(r["chunk_id"], r["input_ids"], r["target_ids"]) for r in rows] == [(k, a, b) for k, (a, b) in enumerate(want)]


def test_window_count_matches_range(spark):
    df = spark.range(0, 40).select(F.col("id").alias("n"), text.window_count(F.col("id"), 7, 3).alias("k"))
    assert all(r["k"] == len(range(0, r["n"] - 7, 3)) for r in df.collect())


@pytest.mark.parametrize("shuffle", [False, True])
def test_dataset_batches(spark, docs, shuffle):
    vocab = text.build_vocab(text.tokenize(docs), specials=[text.UNKNOWN])
    kw = {"batch_size": 3, "length": 4, "stride": 2, "shuffle": shuffle, "seed": 5}
    full = text.lm_dataset(docs, vocab, drop_last=False, **kw).collect()
    assert sorted(r["idx"] for r in full) == list(range(len(full)))
    assert all(r["batch_id"] == r["idx"] // 3 for r in full)
    cut = text.lm_dataset(docs, vocab, drop_last=True, **kw).collect()
    assert len(cut) == len(full) // 3 * 3
    again = text.lm_dataset(docs.repartition(3), vocab, drop_last=False, **kw).collect()
    assert sorted(map(tuple, full), key=str) == sorted(map(tuple, again), key=str)


def test_joined_pieces_and_stream(spark):
    rows = [(g, i, f"text {g}{i}, end") for g in "ab" for i in range(7 if g == "a" else 1)]
    df = spark.createDataFrame(rows, "g string, i long, text string")
    for size in (3, 100):
        got = text.concat_documents(df, ["g"], ["i"], max_docs=size, rows_per_bucket=2).orderBy("g", "piece").collect()
        for g in "ab":
            whole = "".join(r["joined"] for r in got if r["g"] == g)
            assert whole == text.SEPARATOR.join(t for h, _, t in rows if h == g)
            assert max(r["n_docs"] for r in got) <= size
    stream = text.token_stream(text.tokenize(df), ["g"], ["i"], rows_per_bucket=2).orderBy("g", "pos").collect()
    for g in "ab":
        mine = [r for r in stream if r["g"] == g]
        assert [r["pos"] for r in mine] == list(range(len(mine)))
        assert [r["token"] for r in mine] == split_plain(text.SEPARATOR.join(t for h, _, t in rows if h == g))


def test_joined_pieces_end_by_bytes(spark):
    sizes = [10, 0, 45, 3, 3, 200, 0, 1]  # NULL and empty texts, one longer than several pieces
    rows = [("a", i, None if n == 0 else "ä" * (n // 2) + "x" * (n % 2)) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "g string, i long, text string")
    sep = len(text.SEPARATOR)
    for buckets in (2, 100):
        got = text.concat_documents(df, ["g"], ["i"], max_bytes=60, rows_per_bucket=buckets).orderBy("piece").collect()
        assert "".join(r["joined"] for r in got) == text.SEPARATOR.join(t or "" for _, _, t in rows)
        assert all(len(r["joined"].encode()) < 60 + max(sizes) + sep for r in got) and sum(r["n_docs"] for r in got) == len(rows)
        assert [r["piece"] for r in got] == sorted({r["piece"] for r in got}) and len(got) > 3
    # ten-megabyte texts: a piece stays under its bound and one document
    big = spark.range(6).select(F.lit("a").alias("g"), F.col("id").alias("i"), F.repeat(F.lit("word and "), 1_165_085).alias("text"))
    sizes = [r["n"] for r in text.concat_documents(big, ["g"], ["i"], max_bytes=16 << 20).select(F.octet_length("joined").alias("n")).collect()]
    assert len(sizes) == 4 and max(sizes) < (16 << 20) + 10_485_765 + 2 * sep


# --- byte pairs -----------------------------------------------------------


def plain_bpe(counts, n):
    """One merge at a time, straight from the definition."""
    words = {w: [*w, bpe.END_OF_WORD] for w in counts}
    merges = []
    for _ in range(n):
        pairs = {}
        for w, s in words.items():
            for p in zip(s, s[1:]):
                pairs[p] = pairs.get(p, 0) + counts[w]
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p))
        merges.append(best)
        for w, s in words.items():
            out, i = [], 0
            while i < len(s):
                if tuple(s[i : i + 2]) == best:
                    out.append(s[i] + s[i + 1])
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            words[w] = out
    return merges, words


COUNTS = {
    "low": 5, "lower": 2, "newest": 6, "widest": 3, "aaaa": 4, "aaa": 4, "abab": 3, "xyxy": 3, "zqzq": 3, "banana": 2,
    "bandana": 2, "<|endoftext|>": 1, "é": 2, "déjà": 3, "aab": 3, "baa": 3,
}


@pytest.mark.parametrize("cut_every", [2, 32])
def test_training_takes_the_same_merges_as_one_at_a_time(spark, cut_every):
    words = spark.createDataFrame(list(COUNTS.items()), "word string, freq long")
    want, _ = plain_bpe(COUNTS, 40)
    got = bpe.bpe_train(words, 40, cut_every=cut_every)
    assert [(a, b) for _, a, b in got] == want
    assert [r for r, _, _ in got] == list(range(len(got)))


@pytest.mark.parametrize("n", [0, 10])
def test_training_stops_when_no_pair_is_left(spark, n):
    words = spark.createDataFrame([("ab", 1)], "word string, freq long")
    assert [(a, b) for _, a, b in bpe.bpe_train(words, 10, index_from=n)] == plain_bpe({"ab": 1}, 10)[0]
    assert bpe.bpe_train(words.filter("freq > 1"), 10, index_from=n) == []


@pytest.mark.parametrize("kw", [{"index_from": 0, "fetch": 6, "fan": 2}, {"index_from": 5, "fetch": 512, "cut_every": 2}])
def test_index_takes_the_same_merges_and_reads_only_the_words_they_touch(spark, kw):
    # "a" + "bc" and "ab" + "c" spell the same symbol
    counts = {**COUNTS, "abc": 4, "bc": 9, "abcab": 2, "xabcx": 5, "ab": 8}
    words = spark.createDataFrame(list(counts.items()), "word string, freq long")
    n = 22 if kw["index_from"] else 34
    want, _ = plain_bpe(counts, n)
    trace = []
    got = bpe.bpe_train(words, n, trace=trace, **kw)
    assert [(a, b) for _, a, b in got] == want
    state = {w: [*w, bpe.END_OF_WORD] for w in counts}
    read = 0
    for step in trace:
        touched = {w for w, s in state.items() if any((a, b) in set(zip(s, s[1:])) for a, b in step["merges"])}
        if "postings" in step:
            assert step["words"] == len(touched)
            read += step["words"]
        for a, b in step["merges"]:
            state = {w: bpe.merge_symbols(s, lambda x, y, p=(a, b): 0 if (x, y) == p else None) for w, s in state.items()}
    assert 0 < read < 0.5 * len(trace) * len(counts)


def test_split_equals_training_result(spark):
    merges, words = plain_bpe(COUNTS, 25)
    table = bpe.merges_frame(spark, [(i, a, b) for i, (a, b) in enumerate(merges)])
    df = spark.createDataFrame([(w,) for w in COUNTS], "word string")
    got = {r["word"]: r["parts"] for r in bpe.split_words(df, table).collect()}
    assert got == words


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}])
def test_byte_pair_round_trip_with_specials(spark, docs, limits):
    tokens = text.tokenize(docs.filter(F.length(F.trim("text")) > 0)).select("doc_id", "tokens")
    counts = text.token_counts(tokens).withColumnRenamed("token", "word")
    merges = bpe.merges_frame(spark, bpe.bpe_train(counts, 10))
    specials = [text.END_OF_TEXT]
    parts = bpe.bpe_encode_long(text.explode_tokens(tokens, ["doc_id"]), merges, specials=specials)
    vocab = bpe.symbol_vocab(merges, parts, specials)
    ids = bpe.bpe_encode(tokens, merges, vocab, specials=specials, **limits)
    end = vocab.filter(F.col("token") == text.END_OF_TEXT).first()["id"]
    assert end in ids.filter("doc_id = 3").first()["ids"]
    back = bpe.bpe_decode(ids.select("doc_id", F.posexplode("ids").alias("pos", "id")), vocab, specials=specials)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {
        r["doc_id"]: " ".join(r["tokens"]) for r in tokens.collect()
    }


def test_decode_of_arrays_equals_decode_of_rows(spark):
    rows = [(1, [0, 2, 3]), (2, [1, 3]), (2, [4, 0, 3, 3]), (3, []), (4, None), (None, [3])]
    df = spark.createDataFrame(rows, "doc_id long, ids array<long>")
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("ab", 2), (bpe.END_OF_WORD, 3), ("!", 4)], "token string, id long")
    want = bpe.bpe_decode(df.select("doc_id", F.posexplode("ids").alias("pos", "id")), vocab, specials=["!"])
    got = bpe.bpe_decode(df, vocab, specials=["!"], ids="ids")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 3


def exchanges(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join"), df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_joined_documents_are_numbered_in_one_pass(spark):
    rows = [("en", i, "x" * (7 * i % 50)) for i in range(40)]
    df = spark.createDataFrame(rows, "lang string, doc_id long, text string").localCheckpoint()
    out = text.concat_documents(df, ["lang"], ["doc_id"], max_docs=8, max_bytes=300)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Window ") == 1
    pieces = [r["joined"] for r in out.orderBy("piece").collect()]
    assert "".join(pieces) == text.SEPARATOR.join(t for _, _, t in rows) and len(pieces) > 5


def test_byte_pairs_are_encoded_without_a_shuffle(spark, docs):
    docs = docs.localCheckpoint()
    merges = bpe.merges_frame(spark, [(0, "t", "h"), (1, "th", "e")])
    tokens = text.tokenize(docs).select("doc_id", "tokens")
    vocab = bpe.symbol_vocab(merges, bpe.bpe_encode_long(text.explode_tokens(tokens, ["doc_id"]), merges))
    ranks = bpe.byte_ranks(spark, [(0, "74", "68")])
    for made in (bpe.bpe_encode(tokens, merges, vocab), bpe.bpe_encode_long(text.explode_tokens(tokens, ["doc_id"]), merges), bpe.encode_ranks(docs, ranks)):
        assert exchanges(made) == (0, 0)


def test_a_large_vocabulary_meets_the_words_of_a_chunk_once(spark):
    """Copies of a document are not spread out word by word."""
    df = spark.createDataFrame([(i, ["a", "b", "a", None]) for i in range(300)], "doc_id long, tokens array<string>")
    vocab = spark.createDataFrame([("a", 0), ("b", 1), (text.UNKNOWN, 2)], "token string, id long")
    for chunk in (10, 1_000_000):
        found = text._look_up(df, "tokens", "f", vocab, "token", "id", 0, 0, chunk)
        assert sorted(tuple(r) for r in found.select("doc_id", "f").collect()) == [(i, [0, 1, 0, None]) for i in range(300)]
    plan = text.encode(df, vocab, on_unknown="unk", max_rows=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "FlatMapCoGroupsInArrow" in plan


def test_long_look_ups_keep_rows_in_chunks_and_do_not_shuffle_them(spark):
    rows = [(k, p, t) for k in (1, 1, None, 2) for p, t in enumerate(["a", "b", None, "?", "a"])]
    df = spark.createDataFrame(rows, "doc_id long, pos int, token string").repartition(3)
    right = spark.createDataFrame([(0, "a", "x"), (None, "b", None), (5, "c", "z")], "id long, token string, mark string")
    for how in ("left", "inner"):
        want = df.join(right, ["token"], how)
        got = scale.lookup_join(df, right, ["token"], how, kept=False, max_rows=0)
        assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "FlatMapCoGroupsInArrow" in plan and "anti" not in plan.lower()
    empty = scale.lookup_join(df.filter("pos > 9"), right, ["token"], "left", kept=False, max_rows=0)
    assert empty.columns == ["token", "doc_id", "pos", "id", "mark"] and not empty.collect()


def test_chunks_hold_rows_once_and_leave_other_columns_alone(spark):
    rows = [(i, [f"w{i % 7}", None, "a"] if i % 5 else None, {"k": i}, b"\x00") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>, more map<string,int>, raw binary").repartition(3)
    lookup = spark.createDataFrame([(f"w{i}", [i]) for i in range(5)], "token string, ids array<long>")
    for chunk, size in ((10, 1 << 30), (10**6, 1), (10**6, 1 << 30)):
        found = scale.chunk_lookup(df, "tokens", "f", lookup, "token", "ids", chunk, size)
        assert found.columns == [*df.columns, "f"]
        want = [(*r, None if r[1] is None else [[r[0] % 7] if r[0] % 7 < 5 else None, None, None]) for r in rows]
        assert sorted((tuple(r) for r in found.collect()), key=lambda r: r[0]) == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # rows travel packed: their own columns meet no shuffle
    assert "RepartitionByExpression" not in plan


def test_rank_file_equals_the_library(spark, tmp_path):
    tiktoken = pytest.importorskip("tiktoken")
    import base64

    # a small consistent rank table: all bytes, then pairs learned on a few words
    ranks = {bytes([b]): b for b in range(256)}
    merges, _ = plain_bpe({w: n for w, n in COUNTS.items() if w.isascii()}, 30)
    for a, b in merges:
        if bpe.END_OF_WORD not in (a, b) and bpe.END_OF_WORD not in a + b and (a + b).encode() not in ranks:
            ranks[(a + b).encode()] = len(ranks)
    path = tmp_path / "ranks.txt"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    special = {text.END_OF_TEXT: len(ranks)}
    lib = tiktoken.Encoding("t", pat_str=bpe.PIECES, mergeable_ranks=ranks, special_tokens=special)
    check_ranks(spark, str(path), lib, special)


def test_full_rank_file_equals_the_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    files = pytest.importorskip("public_tokenizers")
    import base64

    path = files.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    special = {text.END_OF_TEXT: len(ranks)}
    lib = tiktoken.Encoding("t", pat_str=bpe.PIECES, mergeable_ranks=ranks, special_tokens=special)
    check_ranks(spark, path, lib, special)


def check_ranks(spark, path, lib, special):
    texts = [*TEXTS, "the lowest newest  widest bananas don't\n\n  we'll 123 4 ½ 漢字 emoji 😀!", "end.<|endoftext|> Next<|endoftext|>", "x" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ranks = bpe.read_ranks(spark, path)
    want = {i: lib.encode(t, allowed_special=set(special)) for i, t in enumerate(texts)}
    for limits in ({}, {"max_rows": 0}):
        ids = bpe.encode_ranks(df, ranks, specials=special, **limits)
        assert {r["doc_id"]: r["ids"] for r in ids.collect()} == want
    back = bpe.decode_ranks(ids.select("doc_id", "ids"), ranks, specials=special)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == dict(enumerate(texts))
