"""Aggregates, losses and evaluation metrics as grouped jobs.

Every job first reduces to one row per group, class pair or batch with map-side
combining; whatever follows works on that small table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelearn.functions.columns import as_col
from framelearn.plans.scale import maybe_broadcast, running_total


def mode_value(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent value per group, the smallest one on ties.

    Counted in two steps, so no buffer holds all distinct values of a group.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    pick = F.min_by(F.col(value), F.struct(-F.col("_n"), F.col(value)))
    return counts.groupBy(*by).agg(pick.alias("mode"), F.max("_n").alias("mode_count"))


def arg_extreme(df: DataFrame, value: str, index: str, by: Sequence[str] = ()) -> DataFrame:
    """Index of the largest and of the smallest value, the first one on ties."""
    v, i = F.col(value), F.col(index)
    return df.groupBy(*by).agg(
        F.max_by(i, F.struct(v, -i)).alias("argmax"), F.min_by(i, F.struct(v, i)).alias("argmin")
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)


def label_counts(df: DataFrame, label: str, classes: DataFrame, class_id: str, class_name: str) -> DataFrame:
    """Rows per label in class order, with the class names."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    named = counts.join(maybe_broadcast(classes), F.col(label) == F.col(class_id), "left")
    return named.select(label, class_name, "n").orderBy(label)


def is_multiclass(df: DataFrame, label: str) -> DataFrame:
    """Number of distinct labels, and whether there are more than two."""
    distinct = df.select(label).distinct().agg(F.count(label).alias("n_classes"))
    return distinct.withColumn("multiclass", F.col("n_classes") > 2)


def distinct_error(lg_k: int = 14) -> float:
    """Standard error of ``estimated_distinct``, as a share, with 2^lg_k registers."""
    return 1.04 / 2 ** (lg_k / 2)


def distinct_sketches(df: DataFrame, col: str, by: Sequence[str] = (), lg_k: int = 14) -> DataFrame:
    """``(by, sketch)``: a mergeable sketch of the distinct values of each group, a few kilobytes whatever their number.

    Values are sketched as text, so that all types count alike; NULL is no value.
    """
    return df.groupBy(*by).agg(F.hll_sketch_agg(F.col(col).cast("string"), F.lit(lg_k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of larger groups from those of their parts, which equal those of a pass over all rows."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated_distinct(sketches: DataFrame) -> DataFrame:
    """Replace ``sketch`` by ``n_distinct``, near the true number: mostly within twice ``distinct_error``, as a share.

    A sketch that was never united would be estimated from its history as well; united
    with itself it gives what its registers tell, the same however it was put together.
    """
    return sketches.withColumn("n_distinct", F.hll_sketch_estimate(F.hll_union("sketch", "sketch"))).drop("sketch")


def param_count(params: DataFrame) -> DataFrame:
    """Numbers in a parameter table; storage shared by two names counts once."""
    return params.dropDuplicates(["storage_id"]).agg(F.sum(F.size("values")).cast("long").alias("n_params"))


# --- classification -------------------------------------------------------


def confusion_long(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Rows per (truth, prediction) pair; NULL on either side does not count."""
    both = F.when(F.col(truth).isNotNull() & F.col(pred).isNotNull(), F.lit(1))
    # a filter on the counts cannot sink below them, where it would compute the prediction again
    pairs = df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(F.count(both).alias("n"))
    return pairs.filter("n > 0")


def confusion_matrix(df: DataFrame, truth: str, pred: str, classes: Sequence) -> DataFrame:
    """Rows are true classes, columns ``pred_<class>`` predicted ones; all classes appear."""
    long = confusion_long(df, truth, pred)
    sums = [F.coalesce(F.sum(F.when(F.col("pred") == c, F.col("n"))), F.lit(0)).alias(f"pred_{c}") for c in classes]
    rows = df.sparkSession.createDataFrame([(c,) for c in classes], ["class"])
    rows = rows.select(F.col("class").cast(df.schema[truth].dataType).alias("truth"))
    return rows.join(long, "truth", "left").groupBy("truth").agg(*sums).orderBy("truth")


def classification_report(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support for every class seen in truth or prediction."""
    cell = F.array(
        F.struct(F.col("truth").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("pred").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
    )
    hits = F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(F.lit(0))
    parts = confusion_long(df, truth, pred).select(hits.alias("hits"), F.explode(cell).alias("c")).select("hits", "c.*")
    # a hit stands in two cells (as truth and as prediction), so it is counted on the truth side
    per = parts.groupBy("class").agg(
        F.sum(F.when(F.col("support") > 0, F.col("hits")).otherwise(F.lit(0))).alias("tp"),
        F.sum("support").alias("support"),
        F.sum("predicted").alias("predicted"),
    )
    tp = F.col("tp").cast("double")

    def ratio(under: Column) -> Column:
        return F.coalesce(F.try_divide(tp, under.cast("double")), F.lit(0.0))

    return per.select(
        "class",
        ratio(F.col("predicted")).alias("precision"),
        ratio(F.col("support")).alias("recall"),
        F.coalesce(F.try_divide(2.0 * tp, (F.col("support") + F.col("predicted")).cast("double")), F.lit(0.0)).alias("f1"),
        "support",
    )


def macro_f1(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Plain mean of the F1 of all classes that occur in truth or prediction."""
    return classification_report(df, truth, pred).agg(F.avg("f1").alias("macro_f1"), F.count(F.lit(1)).alias("n_classes"))


# --- epochs and batches ---------------------------------------------------


def batch_metrics(df: DataFrame, metrics: Mapping[str, Column], epoch: str = "epoch", batch: str = "batch_id") -> DataFrame:
    """Mean of each row metric per batch, with the batch's size."""
    return df.groupBy(epoch, batch).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.avg(c).alias(name) for name, c in metrics.items()]
    )


def epoch_metrics(
    df: DataFrame,
    metrics: Mapping[str, Column],
    mode: str = "batch_mean",
    epoch: str = "epoch",
    batch: str = "batch_id",
) -> DataFrame:
    """Per-epoch metrics.

    ``batch_mean`` is the plain mean over batches, in which a short last batch
    weighs as much as a full one; ``sample_mean`` weighs batches by their rows.
    """
    if mode == "sample_mean":
        return df.groupBy(epoch).agg(*[F.avg(c).alias(name) for name, c in metrics.items()])
    if mode != "batch_mean":
        raise ValueError(f"unknown mode {mode}")
    per_batch = batch_metrics(df, metrics, epoch, batch)
    return per_batch.groupBy(epoch).agg(*[F.avg(name).alias(name) for name in metrics])


def running_metric(
    per_batch: DataFrame,
    metric: str,
    epoch: str = "epoch",
    batch: str = "batch_id",
    by: str = "so_far",
    **kw,
) -> DataFrame:
    """Add ``running``: the mean of a batch metric up to and including each batch.

    ``by="all"`` divides by the number of all batches of the epoch instead.
    """
    out = running_total(per_batch, [batch], F.col(metric), [epoch], name="_before", kind="double", **kw)
    total = F.col("_before") + F.col(metric)
    if by == "all":
        sizes = per_batch.groupBy(epoch).agg(F.count(F.lit(1)).alias("_batches"))
        out = out.join(maybe_broadcast(sizes), epoch)
        return out.withColumn("running", total / F.col("_batches")).drop("_before", "_batches")
    out = running_total(out, [batch], None, [epoch], name="_count", **kw)
    return out.withColumn("running", total / (F.col("_count") + 1)).drop("_before", "_count")


def every_nth(df: DataFrame, col: str, n: int) -> DataFrame:
    return df.filter(as_col(col) % n == 0)
