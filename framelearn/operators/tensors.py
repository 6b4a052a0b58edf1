"""Tensors as coordinate tables ``(i0, i1, ..., v)`` and as rows with one array.

Shape changes are projections on the coordinates. Products over a shared index
work on blocks, so what is shuffled is a block, not a pair of numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import prod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelearn.plans.scale import BROADCAST_BYTES, dense_index, fits, lookup_join, small_rows


def axes(df: DataFrame) -> list[str]:
    """Coordinate columns ``i0, i1, ...`` in order."""
    names = [c for c in df.columns if c[0] == "i" and c[1:].isdigit()]
    return sorted(names, key=lambda c: int(c[1:]))


# --- building and reading -------------------------------------------------


def from_arrays(df: DataFrame, key: str, col: str) -> DataFrame:
    """Rows with one array each -> a matrix ``(i0, i1, v)`` with the key as row number."""
    return df.select(F.col(key).cast("long").alias("i0"), F.posexplode(col).alias("i1", "v")).select(
        "i0", F.col("i1").cast("long").alias("i1"), F.col("v").cast("double").alias("v")
    )


def full_like(t: DataFrame, value: float) -> DataFrame:
    """Zeros, ones or any constant in the shape of ``t``."""
    return t.withColumn("v", F.lit(float(value)))


def rank_and_shape(t: DataFrame) -> DataFrame:
    """One row: number of axes and size of each, from the largest coordinates."""
    names = axes(t)
    sizes = [(F.max(a) + 1).alias(f"n{k}") for k, a in enumerate(names)]
    return t.agg(*sizes).select(F.lit(len(names)).alias("rank"), *[f"n{k}" for k in range(len(names))])


def shape_of(t: DataFrame) -> tuple[int, ...]:
    return tuple(rank_and_shape(t).first()[1:])


def item(t: DataFrame) -> DataFrame:
    """The single number of a one-element tensor; more elements are an error."""
    one = F.when(F.count("v") == 1, F.max("v")).otherwise(
        F.raise_error(F.lit("only a tensor with one element has an item")).cast("double")
    )
    return t.agg(one.alias("v"))


# --- element arithmetic ---------------------------------------------------


def with_scalar(t: DataFrame, op: str, k: float, out: str = "v") -> DataFrame:
    v, k = F.col("v"), F.lit(k)
    result = {"add": v + k, "sub": v - k, "mul": v * k, "div": F.try_divide(v, k)}[op]
    return t.withColumn(out, result)


def elementwise(a: DataFrame, b: DataFrame, op: str = "mul") -> DataFrame:
    """Two tensors, the second broadcast over leading axes it lacks (trailing axes line up)."""
    ours, theirs = axes(a), axes(b)
    shared = ours[len(ours) - len(theirs) :]
    renamed = b.select(*[F.col(t).alias(o) for t, o in zip(theirs, shared)], F.col("v").alias("_w"))
    joined = lookup_join(a, renamed, shared, "inner")
    v, w = F.col("v"), F.col("_w")
    result = {"add": v + w, "sub": v - w, "mul": v * w, "div": F.try_divide(v, w), "eq": v == w}[op]
    return joined.select(*ours, result.alias("v"))


def set_cell(t: DataFrame, coord: Sequence[int], value: float) -> DataFrame:
    here = reduce(lambda p, q: p & q, [F.col(a) == c for a, c in zip(axes(t), coord)])
    return t.withColumn("v", F.when(here, F.lit(float(value))).otherwise(F.col("v")))


def get_cell(t: DataFrame, coord: Sequence[int]) -> DataFrame:
    return t.filter(reduce(lambda p, q: p & q, [F.col(a) == c for a, c in zip(axes(t), coord)])).select("v")


# --- shapes ---------------------------------------------------------------


def flat_index(names: Sequence[str], shape: Sequence[int]) -> Column:
    """Row-major position of a cell."""
    return reduce(lambda acc, nc: acc * nc[0] + F.col(nc[1]), zip(shape[1:], names[1:]), F.col(names[0]))


def reshape(t: DataFrame, new: Sequence[int], old: Sequence[int] | None = None) -> DataFrame:
    """Same numbers in row-major order under another shape; -1 stands for the size that fits."""
    old = tuple(old) if old is not None else shape_of(t)
    size = prod(old)
    new = list(new)
    if new.count(-1) == 1:
        rest = prod(n for n in new if n != -1)
        new[new.index(-1)] = size // rest if rest else 0
    if prod(new) != size:
        raise ValueError(f"cannot reshape {old} to {tuple(new)}")
    flat = t.select(flat_index(axes(t), old).alias("_f"), "v")
    out = []
    for k in range(len(new)):
        below = prod(new[k + 1 :])
        out.append((F.floor(F.col("_f") / below).cast("long") % new[k]).alias(f"i{k}"))
    return flat.select(*out, "v")


def unsqueeze(t: DataFrame, dim: int) -> DataFrame:
    names = axes(t)
    cols = [F.col(c) for c in names]
    cols.insert(dim, F.lit(0).cast("long"))
    return t.select(*[c.alias(f"i{k}") for k, c in enumerate(cols)], "v")


def squeeze(t: DataFrame, shape: Sequence[int] | None = None) -> DataFrame:
    """Drop axes of size 1."""
    shape = shape if shape is not None else shape_of(t)
    kept = [a for a, n in zip(axes(t), shape) if n != 1]
    return t.select(*[F.col(a).alias(f"i{k}") for k, a in enumerate(kept)], "v")


def permute(t: DataFrame, order: Sequence[int]) -> DataFrame:
    names = axes(t)
    return t.select(*[F.col(names[o]).alias(f"i{k}") for k, o in enumerate(order)], "v")


def transpose(t: DataFrame) -> DataFrame:
    return permute(t, list(reversed(range(len(axes(t))))))


def stack(tensors: Sequence[DataFrame], dim: int = 0) -> DataFrame:
    """Tensors of one shape along a new axis."""
    placed = []
    for k, t in enumerate(tensors):
        wide = unsqueeze(t, dim)
        placed.append(wide.withColumn(f"i{dim}", F.lit(k).cast("long")))
    return reduce(lambda a, b: a.unionByName(b), placed)


def concat(tensors: Sequence[DataFrame], dim: int = 0, shapes: Sequence[Sequence[int]] | None = None) -> DataFrame:
    """Tensors one after another along an axis."""
    shapes = shapes if shapes is not None else [shape_of(t) for t in tensors]
    offset, placed = 0, []
    for t, shape in zip(tensors, shapes):
        placed.append(t.withColumn(f"i{dim}", F.col(f"i{dim}") + F.lit(offset)))
        offset += shape[dim]
    return reduce(lambda a, b: a.unionByName(b), placed)


# --- products -------------------------------------------------------------


def _blocks(t: DataFrame, row: str, col: str, size: int) -> DataFrame:
    """Cells grouped into square blocks: at most size*size cells per group."""
    return (
        t.withColumn("_r", F.floor(F.col(row) / size))
        .withColumn("_c", F.floor(F.col(col) / size))
        .withColumn("_p", ((F.col(row) % size) * size + F.col(col) % size).cast("int"))
        .groupBy("_r", "_c")
        .agg(F.collect_list("_p").alias("p"), F.collect_list("v").alias("x"))
    )


def matmul(a: DataFrame, b: DataFrame, block: int = 128) -> DataFrame:
    """Matrix product of two coordinate matrices, absent cells being zero.

    Cells are packed into blocks, blocks meet on the shared block index, and the
    partial products are summed per cell. When one side fits a broadcast it is
    sent to the other's tasks: a tall matrix times a small one has few shared
    indexes, and a shuffle on them would end in few tasks. Only cells with a
    stored contribution come out.
    """
    left = _blocks(a, "i0", "i1", block).select(F.col("_r").alias("I"), F.col("_c").alias("K"), F.col("p").alias("ap"), F.col("x").alias("ax"))
    right = _blocks(b, "i0", "i1", block).select(F.col("_r").alias("K"), F.col("_c").alias("J"), F.col("p").alias("bp"), F.col("x").alias("bx"))
    if fits(b):
        right = F.broadcast(right)
    elif fits(a):
        left = F.broadcast(left)
    pairs = left.join(right, "K").select("I", "J", "ap", "ax", "bp", "bx")

    def multiply(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                at = {c: batch.column(c)[n].values.to_numpy(zero_copy_only=False) for c in ("ap", "ax", "bp", "bx")}
                x, y = np.zeros((2, block * block))
                x[at["ap"]], y[at["bp"]] = at["ax"], at["bx"]
                hit_x, hit_y = np.zeros((2, block * block))
                hit_x[at["ap"]], hit_y[at["bp"]] = 1.0, 1.0
                x, y, hit_x, hit_y = (m.reshape(block, block) for m in (x, y, hit_x, hit_y))
                r, c = np.nonzero(hit_x @ hit_y)
                v = (x @ y)[r, c]
                i = r.astype(np.int64) + batch.column("I")[n].as_py() * block
                j = c.astype(np.int64) + batch.column("J")[n].as_py() * block
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(v)], names=["i0", "i1", "v"])

    parts = pairs.mapInArrow(multiply, "i0 long, i1 long, v double")
    return parts.groupBy("i0", "i1").agg(F.sum("v").alias("v"))


def rows_times_matrix(df: DataFrame, col: str, matrix: DataFrame, out: str) -> DataFrame:
    """Each row's vector times a matrix that is small enough to send to every task. No shuffle."""
    cells = small_rows(matrix, "the matrix", max_bytes=BROADCAST_BYTES)
    w = np.zeros((1 + max((r["i0"] for r in cells), default=-1), 1 + max((r["i1"] for r in cells), default=-1)))
    for r in cells:
        w[r["i0"], r["i1"]] = r["v"]
    shared = df.sparkSession.sparkContext.broadcast(w)
    return df.withColumn(out, row_function(lambda x: x @ shared.value, len(w))(F.col(col)))


def rows_matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """An array column without NULL rows as a matrix; rows of another length than ``width`` (or the first row's) are an error."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    wanted = int(lengths[0]) if width is None else width
    if (lengths != wanted).any():
        raise ValueError(f"a row has {int(lengths[lengths != wanted][0])} values where {wanted} are needed")
    flat = column.flatten()
    if flat.null_count:
        raise ValueError("a row holds a NULL value")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), wanted)


def row_function(fn, width: int | None = None):
    """A numpy function on a matrix of rows as an Arrow function on an array column.

    NULL rows give NULL. All other rows of a batch must have ``width`` values, or as many as its first one.
    """

    @F.arrow_udf("array<double>")
    def apply(column: pa.Array) -> pa.Array:
        keep = column.drop_null()
        if len(keep) == 0:
            return pa.nulls(len(column), pa.list_(pa.float64()))
        x = rows_matrix(keep, width)
        y = np.ascontiguousarray(fn(x), dtype=np.float64)
        flat = pa.array(y.reshape(-1))
        if column.null_count == 0:
            offsets = np.arange(len(keep) + 1, dtype=np.int32) * y.shape[1]
            return pa.ListArray.from_arrays(pa.array(offsets), flat)
        valid = np.asarray(column.is_valid())
        offsets = np.concatenate([[0], np.cumsum(valid * y.shape[1])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), flat, mask=pa.array(~valid))

    return apply


def for_each(df: DataFrame, small: DataFrame, out: str) -> DataFrame:
    """Every row with every row of a small table, as a struct column: an explode, not a join."""
    rows = small_rows(small, "the small table", max_rows=10_000)
    name = f"struct<{','.join(f'{f.name}:{f.dataType.simpleString()}' for f in small.schema.fields)}>"
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, small.schema.fields)]) for r in rows]
    return df.withColumn(out, F.explode(F.array(*structs).cast(f"array<{name}>")))


# --- standardising --------------------------------------------------------


def fit_stats(df: DataFrame, col: str) -> DataFrame:
    """Mean and sample standard deviation, one row; give it the training rows only."""
    return df.agg(F.avg(col).alias("mu"), F.stddev_samp(col).alias("sigma"))


def _stats(stats: DataFrame) -> tuple[float, float]:
    row = stats.first()
    return row["mu"], row["sigma"]


def standardize(df: DataFrame, col: str, stats: DataFrame, out: str) -> DataFrame:
    mu, sigma = _stats(stats)
    return df.withColumn(out, F.try_divide(F.col(col) - F.lit(mu), F.lit(sigma)))


def destandardize(df: DataFrame, col: str, stats: DataFrame, out: str) -> DataFrame:
    mu, sigma = _stats(stats)
    return df.withColumn(out, F.col(col) * F.lit(sigma) + F.lit(mu))


# --- vectors per group ----------------------------------------------------


def vector_sum(df: DataFrame, by: Sequence[str], col: str, dim: int, out: str = "agg") -> DataFrame:
    """Element-wise sum of vectors per group; partial sums are formed before the shuffle."""
    sums = [F.sum(F.col(col)[k]) for k in range(dim)]
    return df.groupBy(*by).agg(F.array(*sums).alias(out))


def feature_stats(df: DataFrame, col: str, dim: int) -> tuple[list[float], list[float]]:
    """Mean and population variance of every vector position, in one pass."""
    cols = [F.avg(F.col(col)[k]) for k in range(dim)] + [F.var_pop(F.col(col)[k].cast("double")) for k in range(dim)]
    row = df.agg(*cols).first()
    return list(row[:dim]), list(row[dim:])


def batch_norm(
    df: DataFrame,
    col: str,
    out: str,
    mean: Sequence[float],
    var: Sequence[float],
    gamma: Sequence[float] | None = None,
    beta: Sequence[float] | None = None,
    eps: float = 1e-5,
) -> DataFrame:
    """(x - mean) / sqrt(var + eps) * gamma + beta per position, with given statistics."""
    m, s = np.asarray(mean), np.sqrt(np.asarray(var) + eps)
    g = np.ones_like(m) if gamma is None else np.asarray(gamma)
    b = np.zeros_like(m) if beta is None else np.asarray(beta)
    cells = [
        (F.col(col)[k] - F.lit(float(m[k]))) / F.lit(float(s[k])) * F.lit(float(g[k])) + F.lit(float(b[k]))
        for k in range(len(m))
    ]
    return df.withColumn(out, F.array(*cells))


def frame_from(df: DataFrame, spec: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Typed frame: ``(source, type, name)`` triples, cast and renamed."""
    return df.select(*[F.col(src).cast(kind).alias(name) for src, kind, name in spec])


def class_ids(df: DataFrame, col: str) -> DataFrame:
    """``(class_name, label)``: distinct names in order from 0."""
    names = df.select(F.col(col).alias("class_name")).distinct()
    return dense_index(names, ["class_name"], name="label").withColumn("label", F.col("label").cast("int"))


def with_class_ids(df: DataFrame, col: str) -> DataFrame:
    ids = class_ids(df, col).withColumnRenamed("class_name", col)
    return lookup_join(df, ids, [col], "inner")
