"""Column expressions: activations, vector arithmetic, losses and metrics.

Everything here stays in the JVM. Losses and metrics are aggregate columns, so
several of them share one pass over the scored table. Rows in which the label
or the prediction is NULL do not count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value once, so that it is not computed again for every array element.

    A value that comes from a Python function must be bound this way before a
    lambda uses it, since Spark cannot run such a function inside a lambda.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- scalars and vectors -------------------------------------------------


def sigmoid(z) -> Column:
    return 1.0 / (1.0 + F.exp(-as_col(z)))


def round_label(p) -> Column:
    """Half-to-even rounding, as array libraries do it."""
    return F.rint(as_col(p))


def relu(v) -> Column:
    return F.greatest(as_col(v), F.lit(0.0))


def relu_vec(v) -> Column:
    return F.transform(as_col(v), lambda x: F.greatest(x, F.lit(0.0)))


def vec_sum(v) -> Column:
    return F.aggregate(as_col(v), F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return vec_sum(F.zip_with(as_col(a), as_col(b), lambda x, y: x.cast("double") * y.cast("double")))


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def distance(p, q) -> Column:
    """Euclidean distance of two positions."""
    return F.sqrt(
        vec_sum(F.zip_with(as_col(p), as_col(q), lambda x, y: (x - y).cast("double") * (x - y).cast("double")))
    )


def cosine(a, b) -> Column:
    """NULL when one of the vectors is all zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def softmax(z) -> Column:
    def from_exp(e):
        return let(vec_sum(e), lambda s: F.transform(e, lambda x: x / s))

    def from_max(v):
        return let(F.array_max(v), lambda m: let(F.transform(v, lambda x: F.exp(x - m)), from_exp))

    return let(as_col(z), from_max)


def logsumexp(z) -> Column:
    def from_max(v):
        return let(F.array_max(v), lambda m: m + F.log(vec_sum(F.transform(v, lambda x: F.exp(x - m)))))

    return let(as_col(z), from_max)


def argmax(z) -> Column:
    """Index of the largest entry, the first one on ties."""
    return let(as_col(z), lambda v: F.array_position(v, F.array_max(v)) - 1).cast("int")


def top_probability(z, places: int = 3) -> Column:
    return F.round(F.array_max(softmax(z)), places)


def concat_vec(*parts) -> Column:
    return F.concat(*[as_col(p) for p in parts])


# --- losses and metrics over rows ---------------------------------------


def _error(p, y) -> Column:
    return as_col(p) - as_col(y)


def l1_loss(p, y) -> Column:
    return F.avg(F.abs(_error(p, y)))


def mse_loss(p, y) -> Column:
    return F.avg(_error(p, y) * _error(p, y))


def bce_row(z, y) -> Column:
    z, y = as_col(z), as_col(y)
    return F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))


def bce_logits_loss(z, y) -> Column:
    return F.avg(bce_row(z, y))


def ce_row(z, y) -> Column:
    return logsumexp(z) - F.get(as_col(z), as_col(y).cast("int"))


def cross_entropy_loss(z, y, weights: list[float] | None = None) -> Column:
    loss = ce_row(z, y)
    if weights is None:
        return F.avg(loss)
    w = F.get(F.array(*[F.lit(float(v)) for v in weights]), as_col(y).cast("int"))
    return F.try_divide(F.sum(w * loss), F.sum(F.when(loss.isNotNull(), w)))


def accuracy_pct(y, p) -> Column:
    """Percent of rows whose prediction equals the label; NULL without rows."""
    return F.avg((as_col(y) == as_col(p)).cast("double")) * 100.0


def accuracy_within(p, y, tol: float = 0.5) -> Column:
    return F.avg((F.abs(_error(p, y)) < tol).cast("double"))


def r2_score(p, y) -> Column:
    both = F.when(as_col(p).isNotNull(), as_col(y))
    total = F.var_pop(both) * F.count(both)
    return 1.0 - F.try_divide(F.sum(_error(p, y) * _error(p, y)), total)


def relative_accuracy(p, y) -> Column:
    """1 - mean(|p - y| / y); rows whose label is 0 are left out."""
    return 1.0 - F.avg(F.try_divide(F.abs(_error(p, y)), as_col(y)))


def mae_accuracy(p, y) -> Column:
    return (1.0 - l1_loss(p, y)) * 100.0
