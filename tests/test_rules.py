"""No switch, filter or size changes an answer: NULL keys, blank texts, control characters, shapes, padding, streams."""

import duckdb
import numpy as np
import pytest
from framelearn.operators import batches, bpe, images, models, tensors, text, vectors
from framelearn.plans import catalog, scale
from framelearn.sources import readers
from framelearn.streaming import streams
from pyspark.sql import functions as F


def test_split_joins_the_lowest_rank(spark):
    merges = bpe.merges_frame(spark, [(0, "b", "c"), (1, "abc", "d"), (2, "a", "bc"), (9, "b", "c")])
    words = spark.createDataFrame([("abcd",), (None,)], "word string")
    got = {r["word"]: r["parts"] for r in bpe.split_words(words, merges).collect()}
    assert got == {"abcd": ["abcd", "</w>"], None: None}


def test_control_characters_survive(spark):
    words = ["a\x02b", "\x01\x03", "a\x01ab", "x\x01bx"]
    df = spark.createDataFrame([(w, 3) for w in words], "word string, freq long")
    got = bpe.word_symbols(df).select("word", bpe.symbol_array(F.col("symbols")).alias("s")).collect()
    assert {r["word"]: r["s"] for r in got} == {w: [*w, "</w>"] for w in words}
    merges = bpe.bpe_train(df, 6)
    parts = {r["word"]: r["parts"] for r in bpe.split_words(df, bpe.merges_frame(spark, merges)).collect()}
    assert all("".join(parts[w]) == w + "</w>" for w in words)


BLANK = ["src_1_corpus_preview", "tok_1_tokenize", "tok_3_token_counts", "tok_4_vocab", "tok_8_encode_unk", "tok_8_encode_unk_joined", "tok_10_decode", "tok_15_shift_pair", "tok_11_concat_documents"]


@pytest.mark.parametrize("name", BLANK)
def test_blank_documents(spark, tmp_path, name):
    rows = [(0, "one, two", "en"), (1, "", "en"), (2, "  \n", "fr"), (3, None, "fr"), (4, "zwei two three", "de"), (5, "two three", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.QUERIES[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(catalog.SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(map(repr, (tuple(r) for r in got.select(columns).collect()))) == sorted(map(repr, want.fetchall()))


@pytest.mark.parametrize("rows_per_bucket", [100_000, 3])
def test_null_keys_are_numbered_first(spark, rows_per_bucket):
    keys = [None, *range(20)]
    df = spark.createDataFrame([(k, None if k and k % 3 else "g") for k in keys], "k int, g string")
    got = {r["k"]: r["idx"] for r in scale.dense_index(df, ["k"], rows_per_bucket=rows_per_bucket).collect()}
    assert got == {k: i for i, k in enumerate(keys)}
    by = {(r["g"], r["k"]): r["idx"] for r in scale.dense_index(df, ["k"], ["g"], rows_per_bucket=rows_per_bucket).collect()}
    for g in ("g", None):
        mine = [k for k in keys if (None if k and k % 3 else "g") == g]
        assert [by[(g, k)] for k in mine] == list(range(len(mine)))
    two = df.select("k", F.col("k").alias("l"))
    assert {r["k"]: r["idx"] for r in scale.dense_index(two, ["k", "l"], rows_per_bucket=rows_per_bucket).collect()} == got
    assert scale.key_at_rank(df, ["k"], 0, small=4, buckets=3) == (None,)
    assert scale.key_at_rank(df, ["k"], 7, small=4, buckets=3) == (6,)


def test_null_keys_in_splits_and_slices(spark):
    df = spark.createDataFrame([(None,), *[(k,) for k in range(9)]], "k int")
    parts = batches.split_sequential(df, ["k"], 0.3)
    assert [sorted((r["k"] for r in p.collect()), key=str) for p in parts][0] == [0, 1, None]
    assert sum(p.count() for p in parts) == 10
    assert [r["k"] for r in batches.slice_rows(df, ["k"], 0, 2).orderBy("k").collect()] == [None, 0]


def test_ragged_rows_are_an_error(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 4.0, 5.0, 6.0],)], "x array<double>").coalesce(1)
    double = tensors.row_function(lambda x: 2 * x, 3)
    with pytest.raises(Exception, match="values where 3 are needed"):
        df.select(double("x")).collect()
    ok = spark.createDataFrame([([1.0, 2.0, 3.0],), (None,)], "x array<double>").coalesce(1)
    assert [r[0] for r in ok.select(double("x")).collect()] == [[2.0, 4.0, 6.0], None]
    ragged = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0])], "k long, v array<double>").coalesce(1)
    with pytest.raises(Exception, match="values where"):
        vectors.knn_join(ragged, ragged, 1, "k", "v").collect()


@pytest.mark.parametrize("size,kernel,stride,padding", [(2, 1, 1, 1), (3, 3, 2, 3), (4, 2, 1, 0), (1, 3, 1, 2)])
def test_convolution_has_every_cell(spark, size, kernel, stride, padding):
    r = np.random.default_rng(size)
    img, weight, bias = r.normal(size=(2, 2, size, size)), r.normal(size=(3, 2, kernel, kernel)), r.normal(size=3)
    rows = [(n, c, y, x, float(v)) for (n, c, y, x), v in np.ndenumerate(img)]
    pixels = spark.createDataFrame(rows, "img_id int, c int, y int, x int, v double")
    out = (size + 2 * padding - kernel) // stride + 1
    wide = np.pad(img, ((0, 0), (0, 0), (padding, padding), (padding, padding)))
    want = {}
    for n in range(2):
        for o in range(3):
            for y in range(out):
                for x in range(out):
                    cut = wide[n, :, y * stride : y * stride + kernel, x * stride : x * stride + kernel]
                    want[(n, o, y, x)] = (cut * weight[o]).sum() + bias[o]
    got = images.conv2d(pixels, images.kernel_frame(spark, weight, bias), size, size, stride, padding).collect()
    assert {(r["img_id"], r["c"], r["y"], r["x"]) for r in got} == set(want)
    assert all(abs(r["v"] - want[(r["img_id"], r["c"], r["y"], r["x"])]) < 1e-9 for r in got)


def test_cnn_takes_null_and_mixed_images(spark):
    r = np.random.default_rng(1)
    arrays = {f"{b}.{k}.{w}": r.normal(size=s) for b, i in (("block_1", 1), ("block_2", 2)) for k, n in ((0, i), (1, 2)) for w, s in (("weight", (2, n, 3, 3)), ("bias", (2,)))}
    arrays |= {"classifier.weight": r.normal(size=(3, 8)), "classifier.bias": r.normal(size=3)}
    small, wide = r.normal(size=(1, 8, 8)), r.normal(size=(1, 9, 8))
    rows = [(0, 1, 8, 8, small.ravel().tolist()), (1, 1, 8, 8, None), (2, 1, 9, 8, wide.ravel().tolist()), (3, None, 8, 8, small.ravel().tolist())]
    df = spark.createDataFrame(rows, "img_id int, channels int, height int, width int, pixels array<double>").coalesce(1)
    got = {r["img_id"]: r["logits"] for r in images.predict_cnn(df, models.params_frame(spark, arrays)).collect()}
    assert got[1] is None and got[3] is None
    assert np.allclose(got[0], images.cnn_forward(small[None], arrays)[0]) and np.allclose(got[2], images.cnn_forward(wide[None], arrays)[0])


def test_unreadable_images_keep_a_row(spark, tmp_path):
    import struct
    import zlib

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\1\2\3")) + chunk(b"IEND", b"")
    for name, body in (("a/bad.png", b"no picture"), ("b/good.png", png)):
        (tmp_path / "train" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "train" / name).write_bytes(body)
    got = {r["class_name"]: r for r in readers.decode_rgb(readers.read_image_folder(spark, str(tmp_path))).collect()}
    assert got["a"]["label"] == 0 and got["a"]["data"] is None and got["a"]["height"] is None
    assert got["b"]["label"] == 1 and got["b"]["data"] == [1, 2, 3]


def test_stream_with_a_vocabulary_beyond_a_broadcast(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, "b zzz"), (3, "")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/in")
    vocab = text.build_vocab(text.tokenize(docs.filter("doc_id = 1")), specials=[text.END_OF_TEXT, text.UNKNOWN])
    stream = streams.file_stream(spark, f"{tmp_path}/in", docs.schema)
    with pytest.raises(ValueError, match="run_encoded"):
        streams.encode_stream(stream, vocab, max_rows=0)
    for k, limits in enumerate(({"max_rows": 0}, {})):
        streams.run_encoded(stream, vocab, f"{tmp_path}/out{k}", f"{tmp_path}/check{k}", **limits)
        got = {r["doc_id"]: r["ids"] for r in spark.read.parquet(f"{tmp_path}/out{k}").collect()}
        assert got == {1: [0, 1], 2: [1, 3], 3: []}


@pytest.mark.parametrize("length,stride,block", [(3, 1, 8), (5, 7, 5), (4, 4, 16), (6, 2, 3)])
def test_windows_of_blocks_equal_windows_of_rows(spark, length, stride, block):
    df = spark.createDataFrame([(k, list(range(100 * k, 100 * k + n))) for k, n in enumerate((0, 3, 7, 8, 9, 40, 41))], "doc_id long, ids array<long>")
    long = df.select("doc_id", F.posexplode("ids").alias("pos", "id"))
    want = sorted(map(tuple, text.lm_windows(df, length, stride).collect()))
    assert sorted(map(tuple, text.lm_windows_long(long, length, stride, ["doc_id"], block=block).collect())) == want


def test_dataset_joins_offsets_to_documents(spark):
    df = spark.createDataFrame([(k, "a b c d e f g h") for k in range(5)], "doc_id long, text string")
    vocab = text.build_vocab(text.tokenize(df), specials=[text.END_OF_TEXT, text.UNKNOWN])
    out = text.lm_dataset(df, vocab, length=2, stride=2, shuffle=False)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join")  # windows are cut above the join
    assert [r["idx"] for r in out.orderBy("idx").collect()] == list(range(12))


def test_cells_find_the_neighbours(spark, sf_dir):
    src = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("key"), F.col("embedding").alias("vector"))
    want = {(r["query"], r["key"]) for r in vectors.knn_join(src, src, 5).collect()}
    for kw, least in (({"cells": 8, "probes": 8}, 1.0), ({"cells": 8, "probes": 8, "part_rows": 7}, 1.0), ({"cells": 8, "probes": 7}, 0.9)):
        got = {(r["query"], r["key"]) for r in vectors.knn_cells(src, src, 5, **kw).collect()}
        assert len(want & got) >= least * len(want)
    assert vectors.knn_cells(src, src.limit(0), 5).collect() == []


def test_special_tokens_glued_to_words(spark):
    df = spark.createDataFrame([("end.<|endoftext|>Next<|endoftext|>",)], "text string")
    assert text.tokenize(df, specials=[text.END_OF_TEXT]).first()["tokens"] == ["end", ".", text.END_OF_TEXT, "Next", text.END_OF_TEXT]


def test_available_documents_with_a_vocabulary_of_any_size(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, "b zzz"), (3, "")], "doc_id long, text string")
    docs.repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    vocab = text.build_vocab(text.tokenize(docs.filter("doc_id = 1")), specials=[text.END_OF_TEXT, text.UNKNOWN])
    stream = streams.table_stream(spark, str(tmp_path), "documents.parquet")
    for k, limits in enumerate(({"max_rows": 0}, {})):
        streams.encode_available(stream, vocab, f"{tmp_path}/out{k}", f"{tmp_path}/check{k}", **limits)
        got = {r["doc_id"]: r["ids"] for r in spark.read.parquet(f"{tmp_path}/out{k}").collect()}
        assert got == {1: [0, 1], 2: [1, 3], 3: []}


def test_reshape_of_rows_that_do_not_fill_the_last_slab(spark, tmp_path):
    rows = [(i, [float(64 * i + j) for j in range(64)]) for i in range(6)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {tuple(r) for r in catalog.QUERIES["tn_2_reshape"](spark, str(tmp_path)).collect()}
    assert got == {(f // 256, f // 16 % 16, f % 16, float(f)) for f in range(6 * 64)}
