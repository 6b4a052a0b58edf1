"""Images as rows: ``(img_id, channels, height, width, pixels)``, pixels in C, H, W order.

Two forms of the same work: a long table of pixels, which is convolved by blocks of
tiles and pooled by a grouped aggregate, for images of any size; and one Arrow pass
over whole images, which is the form for many small ones. Both give the same numbers.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelearn.functions.columns import let
from framelearn.operators.models import param_arrays
from framelearn.operators.tensors import rows_matrix
from framelearn.plans.scale import settle, small_rows, unnest

#: Weights of red, green and blue in a grey value (ITU-R 601).
GREY = (0.299, 0.587, 0.114)


# --- array form -----------------------------------------------------------


def image_function(fn: Callable[[np.ndarray], np.ndarray]):
    """A function on one C, H, W array as an Arrow function of (pixels, channels, height, width)."""

    result = "struct<channels int, height int, width int, pixels array<double>>"

    @F.arrow_udf(result)
    def apply(pixels: pa.Array, channels: pa.Array, height: pa.Array, width: pa.Array) -> pa.Array:
        shapes, flats, lengths, valid = [], [], [], []
        sizes = zip(channels.to_pylist(), height.to_pylist(), width.to_pylist())
        for n, shape in enumerate(sizes):
            if not pixels[n].is_valid or None in shape:
                shapes.append((0, 0, 0)), lengths.append(0), valid.append(False)
                continue
            values = pixels[n].values.to_numpy(zero_copy_only=False).astype(np.float64)
            made = np.ascontiguousarray(fn(values.reshape(shape)), dtype=np.float64)
            shapes.append(made.shape), flats.append(made.reshape(-1)), lengths.append(made.size), valid.append(True)
        offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
        flat = pa.array(np.concatenate(flats) if flats else np.empty(0))
        parts = [pa.array([s[k] for s in shapes], pa.int32()) for k in range(3)]
        return pa.StructArray.from_arrays(
            [*parts, pa.ListArray.from_arrays(offsets, flat)],
            names=["channels", "height", "width", "pixels"],
            mask=pa.array([not v for v in valid]),
        )

    return apply


def map_images(df: DataFrame, fn: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Replace every image by ``fn`` of it (C, H, W in and out)."""
    parts = ("pixels", "channels", "height", "width")
    kept = [c for c in df.columns if c not in parts]
    ready = settle(df, "_p", F.struct(*parts)).select(*kept, "_p")
    made = image_function(fn)(*[F.col(f"_p.{c}") for c in parts])
    return ready.withColumn("_m", made).select(*kept, "_m.channels", "_m.height", "_m.width", "_m.pixels")


def to_tensor(df: DataFrame, raw: str = "data") -> DataFrame:
    """Row-major H, W, C values 0..255 in ``raw`` (array) -> C, H, W values 0..1 in ``pixels``."""
    plane = F.col("height") * F.col("width")

    def moved(s: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(s["v"]) - 1),
            lambda i: F.get(s["v"], (i % s["n"]) * s["c"] + F.floor(i / s["n"]).cast("int")) / 255.0,
        )

    bound = F.struct(F.col(raw).alias("v"), F.col("channels").alias("c"), plane.alias("n"))
    return df.withColumn("pixels", F.when(F.size(raw) > 0, let(bound, moved)).otherwise(F.array().cast("array<double>")))


def to_uint8(df: DataFrame) -> DataFrame:
    """C, H, W values 0..1 back to 0..255 integers in H, W, C order, as ``data``."""
    plane = F.col("height") * F.col("width")

    def moved(s: Column) -> Column:
        def byte(i: Column) -> Column:
            v = F.get(s["v"], (i % s["c"]) * s["n"] + F.floor(i / s["c"]).cast("int")) * 255.0
            return F.floor(F.least(F.lit(255.0), F.greatest(F.lit(0.0), v))).cast("int")

        return F.transform(F.sequence(F.lit(0), F.size(s["v"]) - 1), byte)

    bound = F.struct(F.col("pixels").alias("v"), F.col("channels").alias("c"), plane.alias("n"))
    return df.withColumn("data", F.when(F.size("pixels") > 0, let(bound, moved)).otherwise(F.array().cast("array<int>")))


def png_bytes(img: np.ndarray) -> bytes:
    """A PNG of an H, W, C array of bytes with one, two, three or four channels."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    height, width, channels = img.shape
    colours = {1: 0, 2: 4, 3: 2, 4: 6}[channels]  # the format's numbers for grey and colour, without and with alpha
    rows = np.hstack([np.zeros((height, 1), np.uint8), img.reshape(height, -1).astype(np.uint8)])
    head = struct.pack(">IIBBBBB", width, height, 8, colours, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def encode_png(df: DataFrame, out: str = "content") -> DataFrame:
    """Add the PNG file of ``data`` (H, W, C values 0..255, red first); NULL images give NULL."""

    @F.arrow_udf("binary")
    def encoded(data: pa.Array, height: pa.Array, width: pa.Array, channels: pa.Array) -> pa.Array:
        found = []
        for k, size in enumerate(zip(height.to_pylist(), width.to_pylist(), channels.to_pylist())):
            whole = data[k].is_valid and None not in size
            found.append(png_bytes(data[k].values.to_numpy(zero_copy_only=False).reshape(size)) if whole else None)
        return pa.array(found, pa.binary())

    ready = settle(df, "_p", F.struct("data", "height", "width", "channels"))
    return ready.withColumn(out, encoded(*[F.col(f"_p.{c}") for c in ("data", "height", "width", "channels")])).drop("_p")


def grayscale(df: DataFrame) -> DataFrame:
    """One grey channel from three colour channels; one-channel images stay as they are."""
    n = F.col("height") * F.col("width")
    r, g, b = (F.slice(F.col("pixels"), 1 + k * n, n) for k in range(3))
    rg = F.zip_with(r, g, lambda x, y: x * GREY[0] + y * GREY[1])
    grey = F.zip_with(rg, b, lambda x, y: x + y * GREY[2])
    return df.withColumn("pixels", F.when(F.col("channels") == 3, grey).otherwise(F.col("pixels"))).withColumn(
        "channels", F.lit(1)
    )


def resize_weights(size: int, out: int) -> np.ndarray:
    """Bilinear weights (out x size) with pixel centres at .5; widened when shrinking."""
    scale = size / out
    reach = max(scale, 1.0)
    centers = (np.arange(out) + 0.5) * scale
    w = np.maximum(0.0, 1.0 - np.abs(np.arange(size)[None, :] + 0.5 - centers[:, None]) / reach)
    return w / w.sum(axis=1, keepdims=True)


def resize(df: DataFrame, height: int, width: int) -> DataFrame:
    def scaled(img: np.ndarray) -> np.ndarray:
        rows, cols = resize_weights(img.shape[1], height), resize_weights(img.shape[2], width)
        return rows @ img @ cols.T

    return map_images(df, scaled)


def flatten(df: DataFrame, out: str = "features") -> DataFrame:
    """The image as one vector; C, H, W order is already the flat order."""
    return df.withColumn(out, F.col("pixels"))


def compose(*steps: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Several image steps as one, in order."""

    def run(df: DataFrame) -> DataFrame:
        for step in steps:
            df = df.transform(step)
        return df

    return run


# --- long form ------------------------------------------------------------


def long_pixels(df: DataFrame, key: str = "img_id") -> DataFrame:
    """``(img_id, c, y, x, v)``."""
    plane, width = F.col("height") * F.col("width"), F.col("width")
    long = unnest(df, [key, plane.alias("_n"), width.alias("_w")], "pixels", "v", "_i")
    inside = F.col("_i") % F.col("_n")
    return long.select(
        key,
        F.floor(F.col("_i") / F.col("_n")).cast("int").alias("c"),
        F.floor(inside / F.col("_w")).cast("int").alias("y"),
        (inside % F.col("_w")).cast("int").alias("x"),
        F.col("v").cast("double").alias("v"),
    )


def kernel_frame(spark: SparkSession, weight: np.ndarray, bias: np.ndarray | None = None) -> DataFrame:
    """``(co, c, ky, kx, w, b)`` from an array (out, in, kh, kw)."""
    bias = np.zeros(weight.shape[0]) if bias is None else bias
    rows = [(int(o), int(c), int(ky), int(kx), float(w), float(bias[o])) for (o, c, ky, kx), w in np.ndenumerate(weight)]
    return spark.createDataFrame(rows, "co int, c int, ky int, kx int, w double, b double")


def kernel_array(kernel: DataFrame) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Weights (out, in, kh, kw), biases, and the numbers of the output channels, of a kernel whose size is checked."""
    rows = small_rows(kernel, "the kernel")
    outs = sorted({r["co"] for r in rows})
    shape = [max(r[c] for r in rows) + 1 for c in ("c", "ky", "kx")]
    weight, bias = np.zeros((len(outs), *shape)), np.zeros(len(outs))
    place = {co: k for k, co in enumerate(outs)}
    for r in rows:
        weight[place[r["co"]], r["c"], r["ky"], r["kx"]] += r["w"]
        bias[place[r["co"]]] = r["b"]
    return weight, bias, outs


def conv2d(
    pixels: DataFrame,
    kernel: DataFrame,
    height: int,
    width: int,
    stride: int = 1,
    padding: int = 0,
    key: str = "img_id",
    tile_cells: int = 1 << 20,
    block_rows: int = 500_000,
) -> DataFrame:
    """Convolution of long pixels ``(img_id, c, y, x, v)`` to long pixels.

    Cells outside the image count as zero, and so do pixels without a row. All
    images have this height and width; an image with any pixel has every output
    cell, with the bias alone where only padding is met.

    An image is cut into tiles of output rows whose input has at most some ``tile_cells``
    cells; a pixel row in reach of two tiles, the halo, goes to both. Pixels are shuffled
    once, by blocks of tiles, and each block is convolved by numpy. An image of any
    size spreads over tasks, and a pixel is sent as often as it has tiles, never once per weight.
    """
    weight, bias, outs = kernel_array(kernel)
    channels, kh, kw = weight.shape[1:]
    out_h, out_w = ((n + 2 * padding - m) // stride + 1 for n, m in ((height, kh), (width, kw)))
    kind = pixels.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, c int, y int, x int, v double"
    if out_h < 1 or out_w < 1:
        return pixels.sparkSession.createDataFrame([], schema)
    wide = width + 2 * padding
    tile = int(min(out_h, max(1, (tile_cells // (channels * wide) - kh) // stride + 1)))
    tiles, deep = -(-out_h // tile), (tile - 1) * stride + kh
    sent = pixels.select(F.col(key).alias("k"), "c", "y", "x", F.col("v").cast("double").alias("v"))
    if tiles == 1:
        sent = sent.withColumn("t", F.lit(0))
    else:
        last = F.greatest(F.lit(0), F.least(F.lit(out_h - 1), F.floor((F.col("y") + padding) / stride)))
        first = F.least(last, F.greatest(F.lit(0), F.ceil((F.col("y") + padding - kh + 1) / F.lit(stride))))
        reach = F.sequence(F.floor(first / tile).cast("int"), F.floor(last / tile).cast("int"))
        # every tile of an image is there, also where it has no pixels
        bare = sent.select("k").distinct().select("k", *[F.lit(None).cast(sent.schema[c].dataType).alias(c) for c in ("c", "y", "x", "v")])
        bare = bare.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
        sent = sent.withColumn("t", F.explode(reach)).unionByName(bare)
    cores = pixels.sparkSession.sparkContext.defaultParallelism
    rows = pixels.count()
    blocks = max(1, -(-rows // block_rows), min(cores, rows // 1000))
    shared = pixels.sparkSession.sparkContext.broadcast((weight, bias, np.array(outs, np.int32)))

    def convolve(group):
        weight, bias, outs = shared.value
        names = group["k"].combine_chunks().dictionary_encode(null_encoding="encode")
        c, y, x, t = (pc.fill_null(group[n], -1).to_numpy().astype(np.int64) for n in ("c", "y", "x", "t"))
        v = pc.fill_null(group["v"], 0.0).to_numpy()
        which, place = np.unique(np.asarray(names.indices) * tiles + t, return_inverse=True)
        local = y + padding - t * tile * stride
        inside = (c >= 0) & (c < channels) & (x >= 0) & (x < width) & (y >= 0) & (y < height) & (local >= 0) & (local < deep)
        cell = ((place * channels + c) * deep + local) * wide + x + padding
        order = np.argsort(cell, kind="stable")
        order = order[inside[order]]
        cell, v = cell[order], v[order]
        size, parts = channels * deep * wide, []
        step = max(1, tile_cells // size)
        for at in range(0, len(which), step):
            own = which[at : at + step]
            lo, hi = np.searchsorted(cell, [at * size, (at + len(own)) * size])
            flat = np.bincount(cell[lo:hi] - at * size, weights=v[lo:hi], minlength=len(own) * size)
            views = np.lib.stride_tricks.sliding_window_view(flat.reshape(len(own), channels, deep, wide), (kh, kw), axis=(2, 3))[:, :, ::stride, ::stride]
            made = np.einsum("nchwij,ocij->nohw", views, weight, optimize=True) + bias[None, :, None, None]
            n, o, h, w = made.shape
            top = own % tiles * tile
            oy = np.broadcast_to(top[:, None, None, None] + np.arange(h)[None, None, :, None], made.shape)
            real = (oy < out_h).reshape(-1)
            image = np.broadcast_to((own // tiles)[:, None, None, None], made.shape).reshape(-1)[real]
            out = np.broadcast_to(outs[None, :, None, None], made.shape).reshape(-1)[real]
            ox = np.broadcast_to(np.arange(w), made.shape).reshape(-1)[real]
            columns = [names.dictionary.take(pa.array(image)), pa.array(out), pa.array(oy.reshape(-1)[real].astype(np.int32)), pa.array(ox.astype(np.int32)), pa.array(made.reshape(-1)[real])]
            parts.append(pa.table(columns, names=[key, "c", "y", "x", "v"]))
        return pa.concat_tables(parts)

    dealt = sent.withColumn("_b", F.pmod(F.xxhash64("k", "t"), F.lit(blocks)))
    return dealt.groupBy("_b").applyInArrow(convolve, schema)


def max_pool(pixels: DataFrame, height: int, width: int, size: int = 2, key: str = "img_id") -> DataFrame:
    """Largest value of each size x size square; rows and columns left over are dropped."""
    kept = pixels.filter((F.col("y") < height // size * size) & (F.col("x") < width // size * size))
    cell = [F.floor(F.col(c) / size).cast("int").alias(c) for c in ("y", "x")]
    return kept.groupBy(key, "c", *cell).agg(F.max("v").alias("v"))


# --- convolutional network ------------------------------------------------


def _conv(img: np.ndarray, weight: np.ndarray, bias: np.ndarray, padding: int = 1) -> np.ndarray:
    """A batch (n, c, h, w) against (out, c, kh, kw), stride 1."""
    kh, kw = weight.shape[2:]
    wide = np.pad(img, ((0, 0), (0, 0), (padding, padding), (padding, padding)))
    views = np.lib.stride_tricks.sliding_window_view(wide, (kh, kw), axis=(2, 3))
    return np.einsum("nchwij,ocij->nohw", views, weight, optimize=True) + bias[None, :, None, None]


def _pool(img: np.ndarray, size: int = 2) -> np.ndarray:
    n, c, h, w = img.shape
    h, w = h // size * size, w // size * size
    return img[:, :, :h, :w].reshape(n, c, h // size, size, w // size, size).max(axis=(3, 5))


def cnn_forward(img: np.ndarray, p: Mapping[str, np.ndarray]) -> np.ndarray:
    """Two blocks of convolution-ReLU-convolution-ReLU-pool, then one linear layer."""
    for block in ("block_1", "block_2"):
        for k in (0, 1):
            img = np.maximum(_conv(img, p[f"{block}.{k}.weight"], p[f"{block}.{k}.bias"]), 0.0)
        img = _pool(img)
    return img.reshape(len(img), -1) @ p["classifier.weight"].T + p["classifier.bias"]


def predict_cnn(df: DataFrame, params: DataFrame, out: str = "logits", chunk: int = 256) -> DataFrame:
    """Add the network's class logits. Sizes may differ as far as the last layer allows; NULL images give NULL. No shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(param_arrays(params))

    @F.arrow_udf("array<double>")
    def score(pixels: pa.Array, channels: pa.Array, height: pa.Array, width: pa.Array) -> pa.Array:
        sizes = list(zip(*(c.to_pylist() for c in (channels, height, width))))
        whole = [p.is_valid and None not in size for p, size in zip(pixels, sizes)]
        found: list = [None] * len(pixels)
        for size in {z for z, ok in zip(sizes, whole) if ok}:  # images of one size are scored together
            at = [i for i, ok in enumerate(whole) if ok and sizes[i] == size]
            img = rows_matrix(pixels.take(pa.array(at)), size[0] * size[1] * size[2]).reshape(-1, *size)
            for k in range(0, len(at), chunk):
                for i, z in zip(at[k : k + chunk], cnn_forward(img[k : k + chunk], shared.value)):
                    found[i] = z
        return pa.array(found, pa.list_(pa.float64()))

    parts = ("pixels", "channels", "height", "width")
    ready = settle(df, "_p", F.struct(*parts))
    return ready.withColumn(out, score(*[F.col(f"_p.{c}") for c in parts])).drop("_p")


def as_images(df: DataFrame, key: str, col: str, channels: int, height: int, width: int, keep: Sequence[str] = ()) -> DataFrame:
    """An image table from flat C, H, W vectors of one known size."""
    return df.select(
        F.col(key).alias("img_id"),
        *keep,
        F.lit(channels).alias("channels"),
        F.lit(height).alias("height"),
        F.lit(width).alias("width"),
        F.col(col).cast("array<double>").alias("pixels"),
    )
