"""Gradient descent over tables.

A step over all rows is one Spark job: every partition adds up the gradient of its own
rows, the partial gradients are summed in groups, and the driver adds a few vectors
of the model's size and updates the weights. Steps over mini-batches share jobs: either a
task takes all steps of a range of batches and hands the weights on to the next, or
the tasks of a barrier stage hold a share of every batch, exchange their partial
gradients after each one and take the same step each. Rows never leave the
executors; the training table is cached for the length of the fit.
"""

from __future__ import annotations

import base64
import copy
import pickle
import time
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelearn.operators.batches import shuffle_rows
from framelearn.operators.models import layer_list, mlp_arrays, params_frame
from framelearn.operators.tensors import rows_matrix
from framelearn.session import discard, scratch

HISTORY = "run string, epoch int, metric string, value double"


@dataclass
class Fit:
    """Learned arrays, their parameter table, and ``(run, epoch, metric, value)`` rows."""

    arrays: dict[str, np.ndarray]
    params: DataFrame
    history: DataFrame


# --- linear model ---------------------------------------------------------


def fit_linear_sgd(
    df: DataFrame,
    x: str,
    y: str,
    loss: str = "l1",
    lr: float = 0.01,
    epochs: int = 100,
    init: tuple[float, float] = (0.0, 0.0),
    every: int = 1,
    run: str = "linear",
) -> Fit:
    """Full-batch descent on ``w * x + b``; each epoch is one aggregate of a few sums."""
    w, b = init
    rows = []
    data = df.select(F.col(x).alias("x"), F.col(y).alias("y")).dropna().persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for epoch in range(epochs):
            err = F.lit(w) * F.col("x") + F.lit(b) - F.col("y")
            if loss == "l1":
                slope, value = F.signum(err), F.abs(err)
            elif loss == "mse":
                slope, value = 2.0 * err, err * err
            else:
                raise ValueError(f"unknown loss {loss}")
            gw, gb, mean = data.agg(F.avg(slope * F.col("x")), F.avg(slope), F.avg(value)).first()
            if mean is None:
                break
            if epoch % every == 0:
                rows.append((run, epoch, "train_loss", mean))
            w, b = w - lr * gw, b - lr * gb
    finally:
        data.unpersist()
    arrays = {"weight": np.array([w]), "bias": np.array([b])}
    spark = df.sparkSession
    return Fit(arrays, params_frame(spark, arrays), spark.createDataFrame(rows, HISTORY))


# --- multi-layer model ----------------------------------------------------


def _softmax(z):
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def loss_and_slope(z: np.ndarray, y: np.ndarray, loss: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per-row loss, its slope at the outputs, and whether the row's prediction is right."""
    if loss == "bce":
        logit = z[:, 0]
        value = np.maximum(logit, 0) - logit * y + np.log1p(np.exp(-np.abs(logit)))
        p = np.exp(-np.logaddexp(0.0, -logit))
        return value, (p - y)[:, None], np.rint(p) == y
    if loss == "ce":
        p = _softmax(z)
        at = (np.arange(len(y)), y.astype(int))
        slope = p.copy()
        slope[at] -= 1.0
        top = z.max(axis=1)
        value = np.log(np.exp(z - top[:, None]).sum(axis=1)) + top - z[at]
        return value, slope, z.argmax(axis=1) == y
    err = z[:, 0] - y
    if loss == "l1":
        return np.abs(err), np.sign(err)[:, None], np.abs(err) < 0.5
    if loss == "mse":
        return err * err, (2 * err)[:, None], np.abs(err) < 0.5
    raise ValueError(f"unknown loss {loss}")


#: Modulus and multipliers of the dropout draw: products of two residues stay below 2**63, so SQL can repeat them.
DRAW_MODULUS, DRAW_ROW, DRAW_UNIT = 2**31 - 1, 48_271, 69_621


def draw_salt(layer: int, seed: int, step: int) -> int:
    return ((seed * 1_000_003 + step) * 1_009 + layer) % DRAW_MODULUS


def dropout_mask(rows: np.ndarray, units: int, layer: int, seed: int, step: int, rate: float) -> np.ndarray:
    """Kept units scaled by 1/(1-rate); fixed by row key, unit, layer, seed and step."""
    p = DRAW_MODULUS
    h = (rows.astype(np.int64) % p * DRAW_ROW)[:, None] + np.arange(1, units + 1, dtype=np.int64) * DRAW_UNIT
    h = (h + draw_salt(layer, seed, step)) % p
    for _ in range(3):
        h = (h * h % p + DRAW_ROW * h + 11) % p
    return (h / p >= rate) / (1.0 - rate)


def _rate(dropout: float | Sequence[float], layer: int) -> float:
    """One rate for all hidden layers, or a list with one per hidden layer."""
    return dropout[layer] if isinstance(dropout, Sequence) else dropout


def class_counts(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hits, predictions and labels per class, for F1."""
    c, pred, y = z.shape[1], z.argmax(axis=1), y.astype(int)
    return np.concatenate([np.bincount(v, minlength=c)[:c] for v in (y[pred == y], pred, y)]).astype(float)


def macro_f1_of(counts: np.ndarray) -> float:
    tp, predicted, support = counts.reshape(3, -1)
    seen = predicted + support > 0
    return float(np.mean(2 * tp[seen] / (predicted + support)[seen])) if seen.any() else float("nan")


def gradient(x, y, rows, layers, loss, relu=True, dropout=0.0, seed=0, step=0):
    """Summed gradient, class counts, summed loss and number of right rows for a block of rows."""
    inputs, masks = [x], []
    for k, (w, b) in enumerate(layers):
        z = inputs[-1] @ w.T + b
        if k + 1 < len(layers):
            mask = (z > 0).astype(float) if relu else np.ones_like(z)
            if _rate(dropout, k):
                mask = mask * dropout_mask(rows, z.shape[1], k, seed, step, _rate(dropout, k))
            masks.append(mask)
            inputs.append(z * mask)
    value, slope, right = loss_and_slope(z, y, loss)
    parts = []
    for k in range(len(layers) - 1, -1, -1):
        parts.append(slope.sum(axis=0))
        parts.append((slope.T @ inputs[k]).reshape(-1))
        if k:
            slope = (slope @ layers[k][0]) * masks[k - 1]
    counts = class_counts(z, y) if loss == "ce" else np.zeros(0)
    return np.concatenate(parts[::-1]), counts, value.sum(), float(right.sum())


def _flatten(layers) -> np.ndarray:
    return np.concatenate([p.reshape(-1) for w, b in layers for p in (w, b)])


def _unflatten(flat: np.ndarray, layers) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for w, b in layers:
        nw = flat[at : at + w.size].reshape(w.shape)
        at += w.size
        out.append((nw, flat[at : at + b.size].reshape(b.shape)))
        at += b.size
    return out


def summed_gradient(data: DataFrame, layers, loss: str, groups: int = 64, **kw) -> tuple[np.ndarray, np.ndarray, float, float, int]:
    """Mean gradient, class counts, mean loss, share of right rows and row count over ``(features, label, row)``."""
    shared = data.sparkSession.sparkContext.broadcast(layers)
    n_in, size = layers[0][0].shape[1], sum(w.size + b.size for w, b in layers)
    width = size + (3 * len(layers[-1][1]) if loss == "ce" else 0) + 3

    def partial(batches):
        from pyspark import TaskContext

        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                x = rows_matrix(batch.column("features"), n_in)
                y = batch.column("label").to_numpy(zero_copy_only=False)
                rows = batch.column("row").to_numpy(zero_copy_only=False)
                g, counts, value, right = gradient(x, y, rows, shared.value, loss, **kw)
                total += np.concatenate([g, counts, [value, right, batch.num_rows]])
        if total[-1]:
            part = TaskContext.get().partitionId()
            vector = pa.ListArray.from_arrays(pa.array([0, width], pa.int32()), pa.array(total))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part % groups], pa.int32()), pa.array([part], pa.int32()), vector], names=["g", "part", "v"]
            )

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        return pd.DataFrame({"g": pdf["g"].iloc[:1], "part": pdf["part"].iloc[:1], "v": [np.sum(np.stack(pdf["v"]), axis=0)]})

    schema = "g int, part int, v array<double>"
    parts = data.select("features", "label", "row").mapInArrow(partial, schema)
    if data.rdd.getNumPartitions() > groups:
        parts = parts.groupBy("g").applyInPandas(add, schema)
    rows = sorted(parts.collect(), key=lambda r: r["part"])
    shared.unpersist()
    if not rows:
        return np.zeros(size), np.zeros(width - size - 3), float("nan"), float("nan"), 0
    total = np.sum([np.asarray(r["v"]) for r in rows], axis=0)
    n = total[-1]
    return total[:size] / n, total[size:-3], total[-3] / n, total[-2] / n, int(n)


#: Rows of the range of batches that one task takes in turn.
RELAY_ROWS = 1_000_000


def batch_steps(dealt: DataFrame, numbers: range, flat: np.ndarray, layers, opt, loss: str, step: int, together: bool, **kw) -> tuple:
    """The steps of the batches ``numbers`` over ``(batch_id, features, label, row)``, as one job.

    Each partition is sorted by batch. ``together`` makes them the tasks of a barrier stage,
    each of which holds a row at least; otherwise there is one partition.
    Returns the new weights, the step count, and the summed rows, loss, right rows
    and class counts; ``opt`` takes over its new state. A lost task repeats the job
    from its first weights, which gives the same result.
    """
    shared = dealt.sparkSession.sparkContext.broadcast((flat, layers, opt))
    n_in, size = layers[0][0].shape[1], len(flat)
    width = size + (3 * len(layers[-1][1]) if loss == "ce" else 0) + 3

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import BarrierTaskContext, TaskContext

        context = BarrierTaskContext.get() if together else TaskContext.get()
        flat, layers, opt = shared.value
        opt = copy.copy(opt)
        ks, x, y, rows = np.zeros(0, np.int64), np.zeros((0, n_in)), np.zeros(0), np.zeros(0, np.int64)
        sums, more, taken = np.zeros(width - size), True, step
        for k in numbers:
            while more and (not len(ks) or ks[-1] <= k):
                batch = next(batches, None)
                more = batch is not None
                if more and batch.num_rows:
                    got = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("batch_id", "label", "row")]
                    ks, y, rows = (np.concatenate(both) for both in zip((ks, y, rows), got))
                    x = np.concatenate([x, rows_matrix(batch.column("features"), n_in)])
            cut = int(np.searchsorted(ks, k, "right"))
            partial = np.zeros(width)
            if cut:
                g, counts, value, right = gradient(x[:cut], y[:cut], rows[:cut], _unflatten(flat, layers), loss, step=taken, **kw)
                partial = np.concatenate([g, counts, [value, right, cut]])
            ks, x, y, rows = ks[cut:], x[cut:], y[cut:], rows[cut:]
            if together:
                parts = context.allGather(base64.b64encode(partial.tobytes()).decode())
                partial = np.sum([np.frombuffer(base64.b64decode(p)) for p in parts], axis=0)
            if partial[-1]:
                flat, taken, sums = opt.step(flat, partial[:size] / partial[-1]), taken + 1, sums + partial[size:]
        if context.partitionId() == 0:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((flat, vars(opt), taken, sums))], pa.binary())], names=["state"])

    (row,) = dealt.mapInArrow(steps, "state binary", barrier=together).collect()
    shared.unpersist()
    flat, held, step, sums = pickle.loads(row["state"])
    for name, value in held.items():
        setattr(opt, name, value)
    return flat, step, int(sums[-1]), sums[-3], sums[-2], sums[:-3]


@dataclass
class Sgd:
    lr: float

    def step(self, flat, grad):
        return flat - self.lr * grad


@dataclass
class Adam:
    lr: float
    beta1: float = 0.9
    beta2: float = 0.999
    eps: float = 1e-8
    t: int = 0
    m: np.ndarray | None = None
    v: np.ndarray | None = None

    def step(self, flat, grad):
        if self.m is None:
            self.m, self.v = np.zeros_like(flat), np.zeros_like(flat)
        self.t += 1
        self.m = self.beta1 * self.m + (1 - self.beta1) * grad
        self.v = self.beta2 * self.v + (1 - self.beta2) * grad * grad
        m = self.m / (1 - self.beta1**self.t)
        v = self.v / (1 - self.beta2**self.t)
        return flat - self.lr * m / (np.sqrt(v) + self.eps)


@dataclass
class Plateau:
    """Multiply the learning rate by ``factor`` after ``patience`` epochs without a better loss."""

    factor: float = 0.5
    patience: int = 5
    threshold: float = 1e-4
    best: float = field(default=float("inf"))
    bad: int = 0

    def update(self, lr: float, loss: float) -> float:
        if loss < self.best * (1 - self.threshold):
            self.best, self.bad = loss, 0
            return lr
        self.bad += 1
        if self.bad > self.patience:
            self.bad = 0
            return lr * self.factor
        return lr


def _prepared(df: DataFrame, key: str, col: str, label: str) -> DataFrame:
    rows = df.select(
        F.col(key).cast("long").alias("row"), F.col(col).cast("array<double>").alias("features"), F.col(label).cast("double").alias("label")
    )
    return rows.dropna()


def fit_mlp(
    df: DataFrame,
    sizes: Sequence[int],
    loss: str,
    key: str = "row_id",
    col: str = "features",
    label: str = "label",
    lr: float = 0.1,
    epochs: int = 10,
    batch_size: int | None = None,
    optimizer: str = "sgd",
    plateau: Plateau | None = None,
    dropout: float | Sequence[float] = 0.0,
    relu: bool = True,
    seed: int = 0,
    init: Mapping[str, np.ndarray] | None = None,
    test: DataFrame | None = None,
    every: int = 1,
    run: str = "mlp",
    how: str = "relay",
    workers: int = 8,
    relay_rows: int = RELAY_ROWS,
) -> Fit:
    """Train a stack of linear layers with ReLU between them.

    ``loss`` is ``bce`` (one logit, labels 0/1), ``ce`` (class logits), ``l1`` or
    ``mse``. Without ``batch_size`` a step uses all rows; with it, rows are
    shuffled by a seeded hash each epoch, and ``how`` says who takes the steps:

    * ``relay``: one task after the other, each all steps of ``relay_rows`` rows, for small
      batches, whose steps follow each other too fast to be shared;
    * ``barrier``: ``workers`` tasks together (at most as many as cores), one job per epoch,
      for batches worth sharing: Spark's exchange waits a second per step;
    * ``steps``: a job per step, where batches are large and barrier stages cannot run.

    All three take the same steps; jobs per epoch do not depend on the batch size in the first two.
    """
    if how not in ("relay", "barrier", "steps"):
        raise ValueError(f"unknown way {how}")
    layers = layer_list(init if init is not None else mlp_arrays(sizes, seed))
    opt = {"sgd": Sgd, "adam": Adam}[optimizer](lr)
    flat, rows, step, started = _flatten(layers), [], 0, time.time()
    data = _prepared(df, key, col, label).persist(StorageLevel.MEMORY_AND_DISK)
    held = _prepared(test, key, col, label).persist(StorageLevel.MEMORY_AND_DISK) if test is not None else None
    options = {"relu": relu, "dropout": dropout, "seed": seed}
    try:
        total_rows = data.count() if batch_size else 0
        tasks = min(workers, df.sparkSession.sparkContext.defaultParallelism, total_rows)
        for epoch in range(epochs):
            dealt, blocks = None, [] if batch_size else [data]
            seen, value_sum, right_sum, counts = 0, 0.0, 0.0, 0.0
            if batch_size:
                n_batches = -(-total_rows // batch_size)
                placed = shuffle_rows(data, ["row"], seed, epoch, name="_idx", rows=total_rows)
                placed = placed.withColumn("batch_id", F.floor(F.col("_idx") / batch_size).cast("long"))
                if how == "barrier":
                    spread = placed.repartitionById(tasks, (F.col("_idx") % tasks).cast("int")).sortWithinPartitions("_idx")
                    ranges = [(spread, range(n_batches))]
                elif how == "relay":
                    each = max(1, relay_rows // batch_size)
                    folder = scratch(df.sparkSession, "batches")
                    placed = placed.withColumn("_part", F.floor(F.col("batch_id") / each).cast("int"))
                    placed.repartition("_part").write.partitionBy("_part").parquet(folder)
                    # the folder's name gives the part, so a range reads its own files only
                    kept = df.sparkSession.read.schema(placed.schema).parquet(folder)
                    ranges = [
                        (kept.filter(F.col("_part") == k // each).coalesce(1).sortWithinPartitions("_idx"), range(k, min(k + each, n_batches)))
                        for k in range(0, n_batches, each)
                    ]
                else:
                    dealt = placed.drop("_idx").repartitionByRange("batch_id").persist(StorageLevel.MEMORY_AND_DISK)
                    blocks = (dealt.filter(F.col("batch_id") == k) for k in range(n_batches))
                for own, numbers in [] if how == "steps" else ranges:
                    own = own.select("batch_id", "features", "label", "row")
                    flat, step, n, value, right, hits = batch_steps(own, numbers, flat, layers, opt, loss, step, how == "barrier", **options)
                    seen, value_sum, right_sum, counts = seen + n, value_sum + value, right_sum + right, counts + hits
                if how == "relay":
                    discard(df.sparkSession, folder)
            for block in blocks:
                grad, hits, value, right, n = summed_gradient(block, _unflatten(flat, layers), loss, step=step, **options)
                if n == 0:
                    continue
                flat, step = opt.step(flat, grad), step + 1
                seen, value_sum, right_sum = seen + n, value_sum + value * n, right_sum + right * n
                counts = counts + hits
            if dealt is not None:
                dealt.unpersist()
            if not seen:
                break
            watched = value_sum / seen
            found = {"train_loss": watched, "train_acc": 100.0 * right_sum / seen, "lr": opt.lr}
            if loss == "ce":
                found["train_f1"] = macro_f1_of(counts)
            if held is not None:
                _, hits, value, right, n = summed_gradient(held, _unflatten(flat, layers), loss, relu=relu)
                if n:
                    watched = value
                    found.update(test_loss=value, test_acc=100.0 * right)
                    if loss == "ce":
                        found["test_f1"] = macro_f1_of(hits)
            found["seconds"] = time.time() - started
            if epoch % every == 0:
                rows.extend((run, epoch, name, float(v)) for name, v in found.items())
            if plateau is not None:
                opt.lr = plateau.update(opt.lr, watched)
    finally:
        data.unpersist()
        if held is not None:
            held.unpersist()
    arrays = {}
    for k, (w, b) in enumerate(_unflatten(flat, layers)):
        arrays[f"layers.{k}.weight"], arrays[f"layers.{k}.bias"] = w, b
    spark = df.sparkSession
    return Fit(arrays, params_frame(spark, arrays), spark.createDataFrame(rows, HISTORY))
