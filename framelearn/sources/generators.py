"""Made data: lines, circles, blobs, grids, random tensors.

Each generator fills in the rows of a table of ids (``spark.range(n)`` will do),
so it is as parallel as that table. Random numbers come from a hash of the row's
key and the seed: a retried task or another partitioning gives the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import prod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelearn.plans.scale import dense_index, gaussian, uniform


def row_ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).withColumnRenamed("id", "row_id")


def steps(start: float, end: float, step: float) -> int:
    """How many values a half-open range with this step has."""
    from math import ceil

    return max(0, ceil((end - start) / step))


def line_data(ids: DataFrame, start: float, step: float, weight: float, bias: float, key: str = "row_id") -> DataFrame:
    """x = start + id * step (never summed up step by step) and y = weight * x + bias."""
    x = F.lit(start) + F.col(key) * F.lit(step)
    return ids.select(F.col(key), x.alias("x"), (F.lit(weight) * x + F.lit(bias)).alias("y"))


def tensor_cells(spark: SparkSession, shape: Sequence[int]) -> DataFrame:
    """All coordinates of a shape."""
    cells = []
    for k in range(len(shape)):
        below = prod(shape[k + 1 :])
        cells.append((F.floor(F.col("id") / below) % shape[k]).cast("long").alias(f"i{k}"))
    return spark.range(prod(shape)).select(*cells)


def tensor_full(spark: SparkSession, shape: Sequence[int], value: float) -> DataFrame:
    return tensor_cells(spark, shape).withColumn("v", F.lit(float(value)))


def random_value(keys: Sequence[str], kind: str = "uniform", seed: int = 0, low: int = 0, high: int = 1) -> Column:
    """``uniform`` in [0, 1), ``normal``, or ``int`` in [low, high), fixed by the keys."""
    if kind == "uniform":
        return uniform(*keys, seed=seed)
    if kind == "normal":
        return gaussian(*keys, seed=seed)
    if kind == "int":
        return (F.lit(low) + F.floor(uniform(*keys, seed=seed) * (high - low))).cast("long")
    raise ValueError(f"unknown kind {kind}")


def random_like(cells: DataFrame, kind: str = "uniform", seed: int = 0, **kw) -> DataFrame:
    keys = [c for c in cells.columns if c != "v"]
    return cells.select(*keys, random_value(keys, kind, seed, **kw).alias("v"))


def tensor_rand(spark: SparkSession, shape: Sequence[int], kind: str = "uniform", seed: int = 0, **kw) -> DataFrame:
    return random_like(tensor_cells(spark, shape), kind, seed, **kw)


def circles(
    ids: DataFrame, noise: float = 0.0, seed: int = 0, factor: float = 0.8, key: str = "row_id", **kw
) -> DataFrame:
    """Two circles round the origin: the first half outer (label 0), the rest inner (label 1)."""
    n = ids.count()
    placed = dense_index(ids, [key], name="_i", rows=n, **kw)
    outer, inner = n // 2, n - n // 2
    inside = F.col("_i") >= outer
    turn = F.when(inside, (F.col("_i") - outer) / F.lit(float(max(inner, 1)))).otherwise(
        F.col("_i") / F.lit(float(max(outer, 1)))
    )
    angle = 2 * F.pi() * turn
    radius = F.when(inside, F.lit(factor)).otherwise(F.lit(1.0))
    x1, x2 = radius * F.cos(angle), radius * F.sin(angle)
    if noise:
        x1 = x1 + F.lit(noise) * gaussian(key, seed=seed, stream=0)
        x2 = x2 + F.lit(noise) * gaussian(key, seed=seed, stream=1)
    return placed.select(key, x1.alias("x1"), x2.alias("x2"), inside.cast("int").alias("label"))


def blobs(
    ids: DataFrame, centers: int = 4, std: float = 1.0, seed: int = 0, box: float = 10.0, key: str = "row_id", **kw
) -> DataFrame:
    """Normal clouds round seeded centres in [-box, box), rows dealt to the centres in turn."""
    placed = dense_index(ids, [key], name="_i", **kw).withColumn("label", (F.col("_i") % centers).cast("int"))
    cells = []
    for axis in range(2):
        center = F.lit(-box) + 2 * box * uniform("label", seed=seed, stream=101 + axis)
        cells.append((center + F.lit(std) * gaussian(key, seed=seed, stream=axis)).alias(f"x{axis + 1}"))
    return placed.select(key, *cells, "label")


def grid(df: DataFrame, x: str, y: str, n: int = 101, pad: float = 0.1) -> DataFrame:
    """n x n points over the bounding box of two columns, widened by ``pad``; x runs fastest."""
    lo_x, hi_x, lo_y, hi_y = df.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    if lo_x is None:
        return df.sparkSession.createDataFrame([], "row_id long, x double, y double")

    def along(place: Column, lo: float, hi: float) -> Column:
        lo, hi = float(lo) - pad, float(hi) + pad
        inner = F.lit(lo) + place * F.lit((hi - lo) / (n - 1))
        return F.when(place == n - 1, F.lit(hi)).otherwise(inner)

    i = F.col("id")
    return df.sparkSession.range(n * n).select(
        i.alias("row_id"),
        along(i % n, lo_x, hi_x).alias("x"),
        along(F.floor(i / n), lo_y, hi_y).alias("y"),
    )
