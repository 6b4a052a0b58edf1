import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelearn.functions import columns as C
from framelearn.operators import graphs as GR
from framelearn.operators import images as IM
from framelearn.operators import metrics, models, training
from framelearn.plans import scale
from framelearn.sources import files, readers, writers
from framelearn.sources.generators import blobs, line_data, row_ids
from framelearn.streaming import streams

# --- training -------------------------------------------------------------


@pytest.mark.parametrize("loss,n_out", [("bce", 1), ("ce", 3), ("l1", 1), ("mse", 1)])
@pytest.mark.parametrize("dropout", [0.0, 0.3])
def test_gradient_equals_finite_differences(loss, n_out, dropout):
    rng = np.random.RandomState(1)
    x, rows = rng.randn(7, 4), np.arange(7)
    y = {"bce": rng.randint(0, 2, 7), "ce": rng.randint(0, 3, 7)}.get(loss, rng.randn(7)).astype(float)
    layers = models.layer_list(models.mlp_arrays([4, 5, 5, n_out], seed=2))
    flat = training._flatten(layers)

    def at(v):
        return training.gradient(x, y, rows, training._unflatten(v, layers), loss, dropout=dropout, seed=1, step=3)

    grad = at(flat)[0]
    for k in range(len(flat)):
        step = np.zeros_like(flat)
        step[k] = 1e-6
        want = (at(flat + step)[2] - at(flat - step)[2]) / 2e-6
        assert abs(grad[k] - want) < 1e-4


def test_summed_gradient_does_not_depend_on_partitions(spark):
    rng = np.random.RandomState(0)
    rows = [(i, [float(v) for v in rng.randn(3)], float(rng.randint(0, 3))) for i in range(90)]
    df = spark.createDataFrame(rows, "row long, features array<double>, label double")
    layers = models.layer_list(models.mlp_arrays([3, 4, 3], seed=0))
    x, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    want, counts, value, right = training.gradient(x, y, np.arange(90), layers, "ce")
    for parts, groups in ((1, 64), (7, 64), (7, 2)):
        grad, got, loss, share, n = training.summed_gradient(df.repartition(parts), layers, "ce", groups=groups)
        assert n == 90 and np.allclose(grad, want / 90) and np.isclose(loss, value / 90) and np.isclose(share, right / 90)
        assert np.array_equal(got, counts)


def test_line_is_fitted_by_the_update_rule(spark):
    df = line_data(row_ids(spark, 50), 0.0, 0.02, 0.7, 0.3)
    fit = training.fit_linear_sgd(df, "x", "y", "l1", lr=0.01, epochs=8, init=(0.1, 0.0))
    x = np.arange(50) * 0.02
    y, w, b = 0.7 * x + 0.3, 0.1, 0.0
    for _ in range(8):
        s = np.sign(w * x + b - y)
        w, b = w - 0.01 * np.mean(s * x), b - 0.01 * np.mean(s)
    assert np.isclose(fit.arrays["weight"][0], w) and np.isclose(fit.arrays["bias"][0], b)
    losses = [r["value"] for r in fit.history.orderBy("epoch").collect()]
    assert losses == sorted(losses, reverse=True)


def test_training_lowers_the_loss_and_reports_f1(spark):
    data = blobs(row_ids(spark, 400), centers=4, std=1.0, seed=42)
    data = data.select("row_id", (models.features("x1", "x2")).alias("features"), "label")
    fit = training.fit_mlp(data, [2, 10, 10, 4], "ce", lr=0.1, epochs=6, optimizer="adam", test=data, seed=1)
    rows = {(r["metric"], r["epoch"]): r["value"] for r in fit.history.collect()}
    assert rows["train_loss", 5] < rows["train_loss", 0] and 0 <= rows["test_f1", 5] <= 1
    assert {m for m, _ in rows} >= {"train_loss", "train_acc", "train_f1", "test_loss", "test_acc", "test_f1", "lr", "seconds"}


def test_plateau_halves_the_rate():
    rule, lr = training.Plateau(factor=0.5, patience=2), 1.0
    seen = [lr := rule.update(lr, loss) for loss in (3, 2, 2, 2, 2, 2, 2, 2)]
    assert seen == [1.0, 1.0, 1.0, 1.0, 0.5, 0.5, 0.5, 0.25]


def test_dropout_mask_rate_and_scale():
    mask = training.dropout_mask(np.arange(4000), 10, 0, 42, 1, 0.2)
    assert set(np.unique(mask)) == {0.0, 1.25} and abs((mask == 0).mean() - 0.2) < 0.01
    assert np.array_equal(mask[:50], training.dropout_mask(np.arange(50), 10, 0, 42, 1, 0.2))
    assert not np.array_equal(mask, training.dropout_mask(np.arange(4000), 10, 0, 42, 2, 0.2))


# --- parameters on disk ---------------------------------------------------


def test_saved_parameters_score_the_same(spark, tmp_path):
    params = models.params_frame(spark, models.mlp_arrays([2, 3, 1], seed=5))
    path = str(tmp_path / "new" / "model")
    writers.save_params(params, path)
    df = spark.createDataFrame([(1, [0.5, -1.0]), (2, None)], "i long, features array<double>")
    a = models.predict_mlp(df, params).orderBy("i").collect()
    assert a == models.predict_mlp(df, readers.load_params(spark, path, params)).orderBy("i").collect()
    other = models.params_frame(spark, models.mlp_arrays([2, 4, 1], seed=5))
    with pytest.raises(ValueError, match="other shape"):
        readers.load_params(spark, path, other)
    with pytest.raises(ValueError, match="unexpected"):
        readers.load_params(spark, path, params.filter("name <> 'layers.0.bias'"))


# --- images ---------------------------------------------------------------


def png(img):
    """A PNG of an H, W, 3 array of bytes."""

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    h, w, _ = img.shape
    raw = b"".join(b"\0" + img[y].tobytes() for y in range(h))
    head = struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root, rng = tmp_path_factory.mktemp("images"), np.random.RandomState(0)
    made = {}
    for split, name, count in (("train", "steak", 3), ("train", "pizza", 2), ("test", "sushi", 1)):
        where = root / split / name
        where.mkdir(parents=True)
        for k in range(count):
            img = rng.randint(0, 256, (5 + k, 4, 3)).astype(np.uint8)
            (where / f"{k}.png").write_bytes(png(img))
            made[f"{split}/{name}/{k}.png"] = img
    return root, made


def test_image_folder(spark, folder):
    root, made = folder
    rows = readers.decode_rgb(readers.read_image_folder(spark, str(root))).collect()
    assert len(rows) == len(made)
    for r in rows:
        img = made["/".join(r["path"].split("/")[-3:])]
        assert (r["height"], r["width"], r["channels"]) == img.shape
        assert r["data"] == img.reshape(-1).tolist()
        assert r["label"] == sorted({"steak", "pizza", "sushi"}).index(r["class_name"])
        assert r["split"] == r["path"].split("/")[-3]


def test_pictures_written_and_read_again(spark, tmp_path):
    rng = np.random.RandomState(1)
    made = {f"train/c{k % 2}/{k}.png": rng.randint(0, 256, (3 + k, 2, n)) for k, n in enumerate((1, 3, 3, 4))}
    rows = [(name, *img.shape, img.reshape(-1).tolist()) for name, img in made.items()] + [("train/c0/none.png", None, None, None, None)]
    df = spark.createDataFrame(rows, "name string, height int, width int, channels int, data array<int>").repartition(2)
    for _ in range(2):  # writing again leaves the same files
        files.write_files(IM.encode_png(df), str(tmp_path))
    got = {"/".join(r["path"].split("/")[-3:]): r for r in readers.decode_rgb(readers.read_image_folder(spark, str(tmp_path))).collect()}
    assert set(got) == set(made)  # Spark's readers leave out files without a byte
    for name, img in made.items():
        r = got[name]
        assert (r["height"], r["width"], r["channels"]) == img.shape and r["data"] == img.reshape(-1).tolist()
        assert (r["split"], r["class_name"], r["label"]) == ("train", name[6:8], int(name[7]))
    text = spark.createDataFrame([("a/b.txt", "é\n"), ("c.txt", None), ("d.txt", "")], "name string, content string")
    files.write_files(text, f"file://{tmp_path}/texts")
    assert (tmp_path / "texts/a/b.txt").read_text() == "é\n" and (tmp_path / "texts/c.txt").read_bytes() == b""
    assert sorted(p.name for p in (tmp_path / "texts").rglob("*") if p.is_file() and p.suffix == ".txt") == ["b.txt", "c.txt", "d.txt"]


def test_image_steps(spark, folder):
    root, made = folder
    df = IM.to_tensor(readers.decode_rgb(readers.read_image_folder(spark, str(root))))
    steps = IM.compose(IM.grayscale, lambda d: IM.resize(d, 3, 2))
    for r in df.collect():
        img = made["/".join(r["path"].split("/")[-3:])]
        assert np.allclose(np.reshape(r["pixels"], (3, *img.shape[:2])), img.transpose(2, 0, 1) / 255.0)
    for r in IM.to_uint8(df).collect():
        img = made["/".join(r["path"].split("/")[-3:])]
        assert np.abs(np.array(r["data"]) - img.reshape(-1)).max() <= 1
    for r in steps(df).collect():
        img = made["/".join(r["path"].split("/")[-3:])] / 255.0
        grey = img @ np.array(IM.GREY)
        want = IM.resize_weights(img.shape[0], 3) @ grey @ IM.resize_weights(img.shape[1], 2).T
        assert (r["channels"], r["height"], r["width"]) == (1, 3, 2) and np.allclose(r["pixels"], want.reshape(-1))


def test_directory_inventory(spark, folder):
    import os

    root, _ = folder
    paths = readers.list_files(spark, str(root))
    got = {r["dir"]: (r["n_dirs"], r["n_files"]) for r in readers.directory_inventory(paths, f"file:{root}").collect()}
    want = {os.path.relpath(p, root).replace(".", ""): (len(d), len(f)) for p, d, f in os.walk(root)}
    assert got == want


def test_file_glob(spark, folder):
    assert readers.list_files(spark, str(folder[0]), "0.png").count() == 3


def plain_conv(img, w, b, stride, pad):
    wide = np.pad(img, ((0, 0), (pad, pad), (pad, pad)))
    oh, ow = ((n + 2 * pad - w.shape[2]) // stride + 1 for n in img.shape[1:])
    out = np.zeros((len(w), oh, ow))
    for o, y, x in np.ndindex(out.shape):
        out[o, y, x] = (wide[:, y * stride : y * stride + w.shape[2], x * stride : x * stride + w.shape[3]] * w[o]).sum() + b[o]
    return out


@pytest.mark.parametrize("stride,pad", [(1, 1), (2, 0), (2, 1), (1, 0)])
def test_convolution_and_pool_on_odd_sizes(spark, stride, pad):
    rng = np.random.RandomState(3)
    img, w, b = rng.randn(3, 7, 9), rng.randn(2, 3, 3, 3), rng.randn(2)
    df = spark.createDataFrame([(1, 3, 7, 9, img.reshape(-1).tolist())], "img_id long, channels int, height int, width int, pixels array<double>")
    px = IM.long_pixels(df)
    want = plain_conv(img, w, b, stride, pad)
    got = np.full(want.shape, np.nan)
    for r in IM.conv2d(px, IM.kernel_frame(spark, w, b), 7, 9, stride, pad).collect():
        got[r["c"], r["y"], r["x"]] = r["v"]
    assert np.allclose(got, want)
    pooled = np.full((3, 3, 4), np.nan)
    for r in IM.max_pool(px, 7, 9).collect():
        pooled[r["c"], r["y"], r["x"]] = r["v"]
    assert np.allclose(pooled, img[:, :6, :8].reshape(3, 3, 2, 4, 2).max(axis=(2, 4)))
    if stride == 1 and pad == 1:
        assert np.allclose(IM._conv(img[None], w, b)[0], want)


@pytest.mark.parametrize("stride,pad", [(1, 1), (2, 1), (3, 0)])
def test_convolution_by_tiles_with_halo(spark, stride, pad):
    rng = np.random.RandomState(4)
    w, b = rng.randn(2, 2, 3, 2), rng.randn(2)
    imgs = {name: rng.randn(2, 23, 5) for name in ("a", "b", None)}
    imgs["c"] = np.zeros((2, 23, 5))
    imgs["c"][1, 22, 4] = 3.0  # an image with one pixel only has every output cell too
    rows = [(k, int(c), int(y), int(x), float(v)) for k, img in imgs.items() for (c, y, x), v in np.ndenumerate(img) if k != "c" or v]
    rows += [("a", 7, 0, 0, 1.0), ("a", 0, 99, 0, 1.0), ("a", 0, 0, 0, None)]
    px = spark.createDataFrame(rows, "img_id string, c int, y int, x int, v double").repartition(3)
    for kw in ({}, {"tile_cells": 1}, {"tile_cells": 90, "block_rows": 50}):
        got = {}
        for r in IM.conv2d(px, IM.kernel_frame(spark, w, b), 23, 5, stride, pad, **kw).collect():
            assert got.setdefault(r["img_id"], {}).setdefault((r["c"], r["y"], r["x"]), r["v"]) == r["v"]
        assert set(got) == set(imgs)
        for k, img in imgs.items():
            wide = np.pad(img, ((0, 0), (pad, pad), (pad, pad)))
            oh, ow = (23 + 2 * pad - 3) // stride + 1, (5 + 2 * pad - 2) // stride + 1
            want = {(o, y, x): (wide[:, y * stride : y * stride + 3, x * stride : x * stride + 2] * w[o]).sum() + b[o] for o, y, x in np.ndindex(2, oh, ow)}
            assert got[k].keys() == want.keys() and all(abs(got[k][c] - want[c]) < 1e-9 for c in want)
    assert IM.conv2d(px, IM.kernel_frame(spark, w, b), 2, 1).collect() == []


# --- graphs ---------------------------------------------------------------


@pytest.fixture(scope="module")
def odd_graphs(spark):
    """A lone node, a graph of one node, a self-loop, a hub, and a graph without nodes."""
    nodes = [(1, n, [float(n), 1.0], [float(n), 0.0, 0.0]) for n in range(6)] + [(2, 0, [5.0, -1.0], [0.0] * 3), (3, 0, [2.0, 2.0], [0.0] * 3)]
    edges = [(1, n, 0, [1.0]) for n in range(1, 5)] + [(1, 0, n, [1.0]) for n in range(1, 5)] + [(3, 0, 0, [0.5])]
    graphs = [(1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0)]
    return (
        spark.createDataFrame(graphs, "graph_id long, y double"),
        spark.createDataFrame(nodes, "graph_id long, node_id long, x array<double>, pos array<double>"),
        spark.createDataFrame(edges, "graph_id long, src long, dst long, attr array<double>"),
    )


HOT = {"max_rows": 0, "hot_rows": 2, "hot_parts": 3}


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}, HOT])
def test_neighbour_sum(odd_graphs, limits):
    _, nodes, edges = odd_graphs
    sent = GR.endpoints(edges, nodes, ["x"], **limits)
    got = {(r["graph_id"], r["node_id"]): r["agg"] for r in GR.neighbour_sum(sent, nodes, "x_j", 2).collect()}
    assert got[1, 0] == [10.0, 4.0] and got[1, 3] == [0.0, 1.0]
    assert got[1, 5] == [0.0, 0.0] and got[2, 0] == [0.0, 0.0] and got[3, 0] == [2.0, 2.0]


def test_pooling_and_undirected(odd_graphs):
    graphs, nodes, edges = odd_graphs
    got = {r["graph_id"]: r["emb"] for r in GR.pool_graphs(nodes, 2, graphs).collect()}
    assert got == {1: [15.0, 6.0, 5.0, 1.0], 2: [5.0, -1.0, 5.0, -1.0], 3: [2.0, 2.0, 2.0, 2.0], 4: [0.0] * 4}
    assert sorted(map(tuple, GR.to_undirected(edges).collect())) == [(1, 0, 1), (1, 0, 2), (1, 0, 3), (1, 0, 4), (3, 0, 0)]


def test_message_layer_paths_agree(spark, odd_graphs):
    from framelearn.plans.model_queries import weight, bias

    graphs, nodes, edges = odd_graphs
    arrays = {}
    for part, at, n_in in (("msg", 0, 6), ("upd", 2, 4)):
        base = f"conv1.{part}"
        for k, n in ((0, n_in), (1, 2)):
            arrays[f"{base}.{k}.weight"], arrays[f"{base}.{k}.bias"] = weight(at + k, 2, n), bias(at + k, 2)
        for name, v in (("mean", 0.1), ("var", 1.5), ("gamma", 1.0), ("beta", 0.2)):
            arrays[f"{base}.norm.{name}"] = np.full(2, v)

    def run(shuffled, **limits):
        n, e = (nodes.repartition(5), edges.repartition(3)) if shuffled else (nodes, edges)
        out = GR.mp_layer(n, GR.with_lengths(e, n, **limits), arrays, "conv1", **limits)
        return {(r["graph_id"], r["node_id"]): [round(v, 9) for v in r["x"]] for r in out.collect()}

    assert run(False) == run(True) == run(False, max_rows=0) == run(True, **HOT)


def test_graph_blocks_equal_joined_layers(spark, odd_graphs):
    from framelearn.plans.model_queries import bias, weight

    graphs, nodes, edges = odd_graphs
    arrays = {"proj.weight": weight(9, 2, 2), "proj.bias": bias(9, 2)}
    for conv in ("conv1", "conv2"):
        for part, at, n_in in (("msg", 0, 6), ("upd", 2, 4)):
            base = f"{conv}.{part}"
            for k, n in ((0, n_in), (1, 2)):
                arrays[f"{base}.{k}.weight"], arrays[f"{base}.{k}.bias"] = weight(at + k, 2, n), bias(at + k, 2)
            for name, v in (("mean", 0.1), ("var", 1.5), ("gamma", 1.0), ("beta", 0.2)):
                arrays[f"{base}.norm.{name}"] = np.full(2, v)
    params = models.params_frame(spark, arrays)
    stray = edges.unionByName(edges.limit(1).withColumn("dst", F.lit(12345).cast(edges.schema["dst"].dataType)))

    def run(e, **kw):
        return {r["graph_id"]: [round(v, 9) for v in r["emb"]] for r in GR.embed_graphs(graphs, nodes, e, params, **kw).collect()}

    want = run(edges, graph_rows=0)
    assert set(want) == {1, 2, 3, 4} and want[4] == [0.0] * 4 and any(want[1])
    assert run(edges) == run(stray) == run(stray, block_rows=1) == run(edges, graph_rows=5) == want
    none = GR.embed_graphs(graphs.limit(0), nodes.limit(0), edges.limit(0), params)
    assert none.collect() == []
    # one shuffle of nodes and of edges, however many layers there are
    plan = GR.embed_blocks(nodes, edges, arrays, 10, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


# --- files and streams ----------------------------------------------------


def test_corpus_files(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.txt").write_text(f"file {k}\nsecond line é" * (k + 1), encoding="utf-8")
    rows = readers.read_corpus(spark, str(tmp_path)).collect()
    assert {r["path"][-5:]: r["text"] for r in rows} == {f"{k}.txt": f"file {k}\nsecond line é" * (k + 1) for k in range(3)}
    head = {r["path"][-5:]: (r["n_chars"], r["head"]) for r in readers.corpus_preview(readers.read_corpus(spark, str(tmp_path))).collect()}
    assert head["2.txt"][0] == 60 and len(head["2.txt"][1]) == 60


def test_graph_tables_round_trip(odd_graphs, spark, tmp_path):
    writers.save_graphs(*odd_graphs, str(tmp_path))
    for a, b in zip(odd_graphs, readers.read_graphs(spark, str(tmp_path))):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_split_is_a_partition_filter(spark, tmp_path):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 8, "train").otherwise("test"))
    writers.save_split(df, str(tmp_path / "t"))
    test = readers.read_labelled_vectors(spark, str(tmp_path / "t"), "test")
    assert test.count() == 2 and "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().executedPlan().toString()


def test_late_rows_are_dropped_and_a_restart_goes_on(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "ts timestamp, v double"

    def arrive(name, rows):
        spark.sql("SELECT 1")  # the session is up
        df = spark.createDataFrame(rows, "ts string, v double").select(F.col("ts").cast("timestamp").alias("ts"), "v")
        df.coalesce(1).write.mode("append").parquet(src)

    def run():
        stream = streams.file_stream(spark, src, schema)
        streams.run_available(streams.windowed_metrics(stream, {"m": F.avg("v")}, window="1 hour", delay="10 minutes"), out, state)
        return {r["start"].hour: (r["n_rows"], r["m"]) for r in spark.read.parquet(out).collect()}

    arrive("a", [("2024-01-01 00:10:00", 1.0), ("2024-01-01 00:50:00", 3.0), ("2024-01-01 02:30:00", 5.0)])
    assert run() == {0: (2, 2.0)}
    # 00:20 is behind the watermark; 02:25 is not
    arrive("b", [("2024-01-01 00:20:00", 100.0), ("2024-01-01 02:25:00", 7.0), ("2024-01-01 04:00:00", 1.0)])
    assert run() == {0: (2, 2.0), 2: (2, 6.0)}


def test_running_metrics_of_a_stream_are_those_of_the_table(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    streams.use_state_store(spark)
    # two epochs of 3 batches of 4 rows and a short one; a NULL value, a batch without values, rows without a place
    rows = [("2024-01-01 00:00:00", e, i // 4, None if i == 1 or i // 4 == 2 else float(i + 10 * e)) for e in (0, 1) for i in range(14)]
    rows = [(str(np.datetime64(t) + np.timedelta64(60 * i, "s")).replace("T", " "), *r) for i, (t, *r) in enumerate(rows)]
    lost = [("2024-01-01 00:00:00", None, 0, 1.0), ("2024-01-01 00:00:00", 0, None, 1.0), (None, 0, 0, 1.0)]

    def frame(part):
        return spark.createDataFrame(part, "ts string, epoch int, batch_id long, v double").withColumn("ts", F.col("ts").cast("timestamp"))

    def arrive(part):
        frame(part).coalesce(1).write.mode("append").parquet(src)

    def run():
        stream = streams.file_stream(spark, src, "ts timestamp, epoch int, batch_id long, v double")
        streams.run_available(streams.running_metrics(stream, ["v"], 4, delay="1 hour"), out, state)
        return {tuple(r) for r in spark.read.parquet(out).collect()}

    want = {
        tuple(r)
        for r in metrics.running_metric(metrics.batch_metrics(frame(rows), {"v": F.col("v")}), "v").select("epoch", "batch_id", "n_rows", "v", "running").collect()
    }
    assert len(want) == 8
    # the second batch arrives before the first: nothing comes out before its turn
    arrive(rows[4:8] + rows[14:20] + lost)
    assert run() == {r for r in want if r[:2] == (1, 0)}
    arrive(rows[:4] + rows[8:14] + rows[20:])
    assert run() == {r for r in want if r[1] < 3}  # both short batches wait for the watermark
    arrive([("2024-01-01 02:00:00", 7, 0, 1.0)])
    assert run() == want
    arrive([("2024-01-01 03:00:00", 7, 0, 1.0), ("2024-01-01 03:00:00", 0, 1, 99.0)])  # a batch that is out takes no more rows
    assert {r for r in run() if r[0] != 7} == want


def test_activations(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([-1000.0, 0.0, 1000.0],)], "z array<double>")
    rows = df.select(C.softmax("z").alias("p"), C.argmax("z").alias("a"), C.logsumexp("z").alias("l")).collect()
    assert rows[0]["a"] == 1 and abs(sum(rows[0]["p"]) - 1) < 1e-12
    assert rows[1]["p"] == [0.0, 0.0, 1.0] and rows[1]["l"] == 1000.0
    half = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "v double")
    assert [r[0] for r in half.select(C.round_label("v")).collect()] == [0.0, 2.0, 2.0, -0.0]


def test_small_side_limits_hold_for_parameters(spark):
    big = models.params_frame(spark, {"w": np.zeros((30, 30))})
    with pytest.raises(ValueError):
        scale.small_rows(big, "the parameter table", max_bytes=1000)


@pytest.mark.parametrize("kw", [{"optimizer": "sgd", "lr": 0.1}, {"optimizer": "adam", "lr": 0.01, "dropout": 0.3}])
def test_ways_to_take_batches_give_the_same_weights(spark, kw):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(v) for v in rng.normal(size=5)], int(rng.integers(0, 3))) for i in range(57)] + [(99, None, 1), (98, [1.0] * 5, None)]
    df = spark.createDataFrame(rows, "row_id long, features array<double>, label int").repartition(3)

    def fitted(**more):
        return training.fit_mlp(df, [5, 6, 3], "ce", seed=4, epochs=2, batch_size=15, **kw, **more)

    plain = fitted(how="steps")
    for more in ({}, {"relay_rows": 16}, {"how": "barrier", "workers": 3}):
        fit = fitted(**more)
        for name, values in plain.arrays.items():
            assert np.abs(values - fit.arrays[name]).max() < 1e-12
        a, b = ({(r.epoch, r.metric): r.value for r in f.history.collect() if r.metric != "seconds"} for f in (plain, fit))
        assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)
    with pytest.raises(ValueError, match="unknown way"):
        fitted(how="together")


def test_jobs_of_an_epoch_do_not_depend_on_the_number_of_batches(spark):
    df = spark.createDataFrame([(k, [k / 40.0], k % 2) for k in range(40)], "row_id long, features array<double>, label int")
    context = spark.sparkContext

    def jobs(**more):
        context.setJobGroup(f"fit {more}", "fit")
        training.fit_mlp(df, [1, 2], "ce", **more)
        found = len(context.statusTracker().getJobIdsForGroup(f"fit {more}"))
        context.setJobGroup("other", "")
        return found

    for how in ("relay", "barrier"):
        one = jobs(how=how, epochs=1, batch_size=40)
        many = jobs(how=how, epochs=1, batch_size=10 if how == "barrier" else 1)
        assert one == many
        assert jobs(how=how, epochs=3, batch_size=40) - jobs(how=how, epochs=2, batch_size=20) == jobs(how=how, epochs=2, batch_size=40) - one
