"""Scoring of linear and multi-layer models over tables, and what follows from the scores.

Parameters are a small table ``(name, storage_id, shape, values)``; its size is
checked before it is sent to the tasks. Scoring is one Arrow pass over the rows
with a numpy product per batch, and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelearn.functions import columns as C
from framelearn.operators.metrics import is_multiclass
from framelearn.operators.tensors import row_function
from framelearn.plans.scale import lookup_join, settle, small_rows
from framelearn.sources.generators import grid

PARAM_SCHEMA = "name string, storage_id string, shape array<int>, values array<double>"


# --- parameters -----------------------------------------------------------


def params_frame(spark: SparkSession, arrays: Mapping[str, np.ndarray], shared: Mapping[str, str] | None = None) -> DataFrame:
    """A parameter table from named arrays; ``shared`` names the storage of tied ones."""
    shared = shared or {}
    rows = [
        (name, shared.get(name, name), [int(n) for n in a.shape], [float(v) for v in np.asarray(a).reshape(-1)])
        for name, a in arrays.items()
    ]
    return spark.createDataFrame(rows, PARAM_SCHEMA)


def param_arrays(params: DataFrame) -> dict[str, np.ndarray]:
    """Named arrays from a parameter table of checked size."""
    rows = small_rows(params.select("name", "shape", "values"), "the parameter table")
    return {r["name"]: np.asarray(r["values"], dtype=np.float64).reshape(r["shape"]) for r in rows}


def list_params(params: DataFrame) -> DataFrame:
    return params.select("name", "shape", "values").orderBy("name")


def mlp_arrays(sizes: Sequence[int], seed: int = 0) -> dict[str, np.ndarray]:
    """Seeded start values, uniform within 1/sqrt(inputs), for layers of these sizes."""
    rng = np.random.RandomState(seed)
    out = {}
    for k, (n_in, n_out) in enumerate(zip(sizes, sizes[1:])):
        bound = 1.0 / np.sqrt(n_in)
        out[f"layers.{k}.weight"] = rng.uniform(-bound, bound, (n_out, n_in))
        out[f"layers.{k}.bias"] = rng.uniform(-bound, bound, n_out)
    return out


def layer_list(arrays: Mapping[str, np.ndarray], prefix: str = "layers") -> list[tuple[np.ndarray, np.ndarray]]:
    layers = []
    while f"{prefix}.{len(layers)}.weight" in arrays:
        k = len(layers)
        layers.append((arrays[f"{prefix}.{k}.weight"], arrays[f"{prefix}.{k}.bias"]))
    return layers


# --- scoring --------------------------------------------------------------


def features(*cols: str) -> Column:
    return F.array(*[F.col(c).cast("double") for c in cols])


def predict_linear(df: DataFrame, params: DataFrame, x: Sequence[str], out: str = "pred") -> DataFrame:
    """weight * x + bias, as a plain column expression."""
    arrays = param_arrays(params)
    weights = arrays["weight"].reshape(-1)
    total = F.lit(float(arrays["bias"].reshape(-1)[0]))
    for name, w in zip(x, weights):
        total = F.lit(float(w)) * F.col(name) + total
    return df.withColumn(out, total)


def forward(x: np.ndarray, layers, relu: bool = True) -> np.ndarray:
    for k, (w, b) in enumerate(layers):
        x = x @ w.T + b
        if relu and k + 1 < len(layers):
            x = np.maximum(x, 0.0)
    return x


def predict_mlp(
    df: DataFrame, params: DataFrame, col: str = "features", out: str = "logits", relu: bool = True, prefix: str = "layers"
) -> DataFrame:
    """Add the last layer's outputs; ``relu=False`` chains the linear layers only."""
    layers = layer_list(param_arrays(params), prefix)
    shared = df.sparkSession.sparkContext.broadcast(layers)
    score = row_function(lambda x: forward(x, shared.value, relu), layers[0][0].shape[1])
    return settle(df, "_x", F.col(col)).withColumn(out, score("_x")).drop("_x")


def binary_label(logits: str = "logits") -> Column:
    return C.round_label(C.sigmoid(F.col(logits)[0])).cast("int")


def predict(df: DataFrame, params: DataFrame, key: str, col: str = "features", binary: bool = False, **kw) -> DataFrame:
    """``(key, pred)`` for every row, in one pass."""
    scored = predict_mlp(df.select(key, col), params, col, "_z", **kw)
    return scored.select(key, (binary_label("_z") if binary else C.argmax("_z")).alias("pred"))


def classify(scored: DataFrame, classes: DataFrame | None = None, logits: str = "logits", places: int = 3) -> DataFrame:
    """Add the predicted class, its probability, and its name when ``(label, class_name)`` is given."""
    out = scored.withColumn("pred", C.argmax(logits)).withColumn("prob", C.top_probability(logits, places))
    if classes is None:
        return out
    names = classes.select(F.col("label").alias("pred"), "class_name")
    return lookup_join(out, names, ["pred"], "left")


def evaluate(scored: DataFrame, model_name: str, loss: Column, metric: Column, engine: str = "spark") -> DataFrame:
    """One row: model name, loss, metric, where it ran."""
    row = scored.agg(loss.alias("eval_loss"), metric.alias("eval_acc"))
    return row.select(F.lit(model_name).alias("model_name"), "eval_loss", "eval_acc", F.lit(engine).alias("device"))


def evaluate_batches(
    scored: DataFrame, model_name: str, loss: Column, metric: Column, batch: str = "batch_id", engine: str = "spark"
) -> DataFrame:
    """The same as a plain mean over batches; ``loss`` and ``metric`` are row columns."""
    per = scored.groupBy(batch).agg(F.avg(loss).alias("l"), F.avg(metric).alias("m"))
    return evaluate(per, model_name, F.avg("l"), F.avg("m"), engine)


def decision_surface(
    df: DataFrame, params: DataFrame, x: str, y: str, label: str, n: int = 101, pad: float = 0.1, **kw
) -> DataFrame:
    """Predicted class on a grid over the data's bounding box; binary or multi-class by the labels seen."""
    points = grid(df, x, y, n, pad).withColumn("features", features("x", "y"))
    scored = predict_mlp(points, params, "features", "_z", **kw)
    many = is_multiclass(df, label).first()["multiclass"]
    return scored.select("row_id", "x", "y", (C.argmax("_z") if many else binary_label("_z")).alias("pred"))


Scorer = Callable[[DataFrame], DataFrame]
