"""Registered queries: aggregates, losses, metrics, splits and batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from framelearn.functions import columns as C
from framelearn.operators import batches, metrics
from framelearn.plans.registry import query, rnd, sql_rnd, table
from framelearn.plans.scale import dense_index, lookup_join

# --- stand-ins for scored rows -------------------------------------------


def scored_lines(spark, d):
    """Regression: price in thousands against a price of 1.5 per unit of quantity."""
    return table(spark, d, "lineitem").select(
        (F.col("l_quantity") * 1.5).alias("p"), (F.col("l_extendedprice") / 1000.0).alias("y"), "l_returnflag"
    )


SQL_LINES = "s AS (SELECT l_quantity * 1.5::DOUBLE AS p, l_extendedprice / 1000.0::DOUBLE AS y, l_returnflag FROM lineitem)"


def scored_docs(spark, d):
    """Binary: the quality label against a logit from the text's length."""
    return lookup_join(
        table(spark, d, "documents").select("doc_id", "n_chars"), table(spark, d, "labels"), ["doc_id"], "inner"
    ).select("doc_id", ((F.col("n_chars") - 2000) / 1000.0).alias("z"), F.col("quality").alias("y"), "toxic")


SQL_DOCS = "s AS (SELECT doc_id, (n_chars - 2000) / 1000.0::DOUBLE AS z, quality AS y, toxic FROM documents JOIN labels USING (doc_id))"


def scored_vectors(spark, d):
    """Ten classes: each logit is three times the sum of every tenth entry."""
    e = F.col("embedding")
    sums = [reduce(lambda a, b: a + b, [e[j].cast("double") for j in range(k, 64, 10)]) for k in range(10)]
    return table(spark, d, "embeddings").select("vec_id", F.array(*[s * 3.0 for s in sums]).alias("z"), F.col("label").alias("y"))


_LOGITS = ", ".join(
    "(" + " + ".join(f"embedding[{j + 1}]::DOUBLE" for j in range(k, 64, 10)) + ") * 3.0::DOUBLE" for k in range(10)
)
SQL_VECTORS = f"""s AS (SELECT vec_id, [{_LOGITS}] AS z, label AS y FROM embeddings),
l AS (SELECT vec_id, y, unnest(range(10))::INT AS k, unnest(z) AS v FROM s),
mx AS (SELECT vec_id, max(v) AS m FROM l GROUP BY 1),
pr AS (SELECT l.vec_id, y, k, v, m, exp(v - m) AS e, sum(exp(v - m)) OVER (PARTITION BY l.vec_id) AS t FROM l JOIN mx USING (vec_id)),
am AS (SELECT vec_id, any_value(y) AS y, min(k) FILTER (WHERE v = m) AS pred, max(e / t) AS top FROM pr GROUP BY 1)"""


def predicted(spark, d):
    return scored_vectors(spark, d).select("vec_id", "y", C.argmax("z").alias("pred"))


# --- plain aggregates -----------------------------------------------------


@query("a_1_min_max", "SELECT l_returnflag, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem GROUP BY 1")
def a_1(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi")
    )


@query(
    "a_2_mean_sum",
    f"SELECT l_returnflag, {sql_rnd('avg(l_extendedprice)')} AS mean, sum(l_quantity) AS total FROM lineitem GROUP BY 1",
)
def a_2(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        rnd(F.avg("l_extendedprice")).alias("mean"), F.sum("l_quantity").alias("total")
    )


@query(
    "a_3_mode",
    """WITH c AS (SELECT l_returnflag, l_quantity, count(*) AS n FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC, l_quantity) AS k FROM c)
SELECT l_returnflag, l_quantity AS mode, n AS mode_count FROM r WHERE k = 1""",
)
def a_3(spark, d):
    return metrics.mode_value(table(spark, d, "lineitem"), "l_quantity", ["l_returnflag"])


@query(
    "a_4_argmax_argmin",
    """WITH r AS (SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS hi,
 row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey) AS lo FROM orders)
SELECT o_orderpriority, max(o_orderkey) FILTER (WHERE hi = 1) AS argmax, max(o_orderkey) FILTER (WHERE lo = 1) AS argmin FROM r GROUP BY 1""",
)
def a_4(spark, d):
    return metrics.arg_extreme(table(spark, d, "orders"), "o_totalprice", "o_orderkey", ["o_orderpriority"])


@query("a_5_value_counts", "SELECT label, count(*) AS n FROM embeddings GROUP BY label ORDER BY n DESC, label")
def a_5(spark, d):
    return metrics.value_counts(table(spark, d, "embeddings"), "label")


@query(
    "a_6_label_counts",
    "SELECT label, n_name AS class_name, count(*) AS n FROM embeddings LEFT JOIN nation ON label = n_nationkey GROUP BY 1, 2",
)
def a_6(spark, d):
    classes = table(spark, d, "nation").select(F.col("n_nationkey").alias("class_id"), F.col("n_name").alias("class_name"))
    return metrics.label_counts(table(spark, d, "embeddings"), "label", classes, "class_id", "class_name")


@query(
    "a_7_is_multiclass",
    "SELECT count(DISTINCT label) AS n_classes, count(DISTINCT label) > 2 AS multiclass FROM embeddings",
)
def a_7(spark, d):
    return metrics.is_multiclass(table(spark, d, "embeddings"), "label")


@query(
    "a_7_distinct_estimate",
    "SELECT l_linestatus, count(DISTINCT l_orderkey) AS n_exact, true AS near, true AS merged FROM lineitem GROUP BY 1",
)
def a_7_estimate(spark, d):
    """Distinct orders per line status by sketches of its parts, held against the exact number and a whole pass."""
    rows, by = table(spark, d, "lineitem"), ["l_linestatus"]
    parts = metrics.distinct_sketches(rows, "l_orderkey", ["l_linestatus", "l_returnflag"])
    merged = metrics.estimated_distinct(metrics.merge_sketches(parts, by))
    whole = metrics.estimated_distinct(metrics.distinct_sketches(rows, "l_orderkey", by)).withColumnRenamed("n_distinct", "n_whole")
    exact = rows.select("l_linestatus", "l_orderkey").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("n_exact"))
    both = exact.join(merged, by).join(whole, by)
    near = F.abs(F.col("n_distinct") - F.col("n_exact")) <= 4 * metrics.distinct_error() * F.col("n_exact")
    return both.select(*by, "n_exact", near.alias("near"), (F.col("n_distinct") == F.col("n_whole")).alias("merged"))


@query("a_7_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def a_7_distinct(spark, d):
    return table(spark, d, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query(
    "a_8_mean_std",
    f"SELECT {sql_rnd('avg(o_totalprice)')} AS mean, {sql_rnd('stddev_samp(o_totalprice)')} AS std FROM orders",
)
def a_8(spark, d):
    return table(spark, d, "orders").agg(
        rnd(F.avg("o_totalprice")).alias("mean"), rnd(F.stddev_samp("o_totalprice")).alias("std")
    )


@query(
    "a_9_row_count",
    "SELECT 'lineitem' AS name, count(*) AS n FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'events', count(*) FROM events",
)
def a_9(spark, d):
    counts = [
        table(spark, d, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name in ("lineitem", "orders", "events")
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


# --- losses and metrics ---------------------------------------------------

_REGRESSION = {
    "a_11_l1_loss": (C.l1_loss, "avg(abs(p - y))"),
    "a_12_mse_loss": (C.mse_loss, "avg((p - y) * (p - y))"),
    "a_16_accuracy_within": (lambda p, y: C.accuracy_within(p, y, 10.0), "avg((abs(p - y) < 10.0)::INT)"),
    "a_17_r2": (
        C.r2_score,
        "1 - sum((p - y) * (p - y)) / nullif(sum((y - my) * (y - my)), 0)",
    ),
    "a_18_relative_accuracy": (C.relative_accuracy, "1 - avg(abs(p - y) / nullif(y, 0))"),
    "a_19_mae_accuracy": (C.mae_accuracy, "100 * (1 - avg(abs(p - y)))"),
}


def _regression(name, fn, expr):
    @query(
        name,
        f"""WITH {SQL_LINES}, t AS (SELECT *, avg(y) OVER (PARTITION BY l_returnflag) AS my FROM s)
SELECT l_returnflag, {sql_rnd(expr)} AS metric, count(*) AS n FROM t GROUP BY 1""",
    )
    def run(spark, d):
        return scored_lines(spark, d).groupBy("l_returnflag").agg(
            rnd(fn("p", "y")).alias("metric"), F.count(F.lit(1)).alias("n")
        )

    return run


for _name, (_fn, _expr) in _REGRESSION.items():
    _regression(_name, _fn, _expr)


@query(
    "a_13_bce_logits",
    f"WITH {SQL_DOCS} SELECT toxic, {sql_rnd('avg(greatest(z, 0) - z * y + ln(1 + exp(-abs(z))))')} AS loss FROM s GROUP BY 1",
)
def a_13(spark, d):
    return scored_docs(spark, d).groupBy("toxic").agg(rnd(C.bce_logits_loss("z", "y")).alias("loss"))


_CE = "(m + ln(t) - v)"


@query(
    "a_14_cross_entropy",
    f"WITH {SQL_VECTORS} SELECT y, {sql_rnd(f'avg({_CE})')} AS loss FROM pr WHERE k = y GROUP BY 1",
)
def a_14(spark, d):
    return scored_vectors(spark, d).groupBy("y").agg(rnd(C.cross_entropy_loss("z", "y")).alias("loss"))


@query(
    "a_14_cross_entropy_weighted",
    f"WITH {SQL_VECTORS} SELECT {sql_rnd(f'sum((1 + y) * {_CE}) / sum(1 + y)')} AS loss FROM pr WHERE k = y",
)
def a_14_weighted(spark, d):
    weights = [1.0 + k for k in range(10)]
    return scored_vectors(spark, d).agg(rnd(C.cross_entropy_loss("z", "y", weights)).alias("loss"))


@query(
    "a_15_accuracy",
    f"WITH {SQL_DOCS} SELECT toxic, {sql_rnd('100.0 * avg((round_even(1 / (1 + exp(-z)), 0) = y)::INT)')} AS accuracy, count(*) AS n FROM s GROUP BY 1",
)
def a_15(spark, d):
    scored = scored_docs(spark, d).withColumn("p", C.round_label(C.sigmoid("z")))
    return scored.groupBy("toxic").agg(
        rnd(C.accuracy_pct("y", "p")).alias("accuracy"), F.count(F.lit(1)).alias("n")
    )


@query("a_20_confusion_long", f"WITH {SQL_VECTORS} SELECT y AS truth, pred, count(*) AS n FROM am GROUP BY 1, 2")
def a_20(spark, d):
    return metrics.confusion_long(predicted(spark, d), "y", "pred")


@query(
    "a_20_confusion_matrix",
    f"WITH {SQL_VECTORS}, c AS (SELECT unnest(range(12))::INT AS truth) SELECT truth, "
    + ", ".join(f"count(*) FILTER (WHERE pred = {k}) AS pred_{k}" for k in range(12))
    + " FROM c LEFT JOIN am ON truth = y GROUP BY 1",
)
def a_20_matrix(spark, d):
    """Classes 10 and 11 occur neither in truth nor in prediction."""
    return metrics.confusion_matrix(predicted(spark, d), "y", "pred", list(range(12)))


_SQL_REPORT = f"""{SQL_VECTORS}, cls AS (SELECT y AS c FROM am UNION SELECT pred FROM am),
rep AS (SELECT c, count(*) FILTER (WHERE y = c AND pred = c) AS tp, count(*) FILTER (WHERE y = c) AS support,
  count(*) FILTER (WHERE pred = c) AS predicted FROM cls, am GROUP BY c)"""


@query(
    "a_21_macro_f1",
    f"WITH {_SQL_REPORT} SELECT {sql_rnd('avg(2.0::DOUBLE * tp / (support + predicted))')} AS macro_f1, count(*) AS n_classes FROM rep",
)
def a_21(spark, d):
    out = metrics.macro_f1(predicted(spark, d), "y", "pred")
    return out.withColumn("macro_f1", rnd(F.col("macro_f1")))


@query(
    "a_22_classification_report",
    f"""WITH {_SQL_REPORT} SELECT c AS "class", {sql_rnd('coalesce(tp::DOUBLE / nullif(predicted, 0), 0)')} AS precision,
{sql_rnd('coalesce(tp::DOUBLE / nullif(support, 0), 0)')} AS recall, {sql_rnd('2.0::DOUBLE * tp / (support + predicted)')} AS f1, support FROM rep""",
)
def a_22(spark, d):
    out = metrics.classification_report(predicted(spark, d), "y", "pred")
    return out.select("class", *[rnd(F.col(c)).alias(c) for c in ("precision", "recall", "f1")], "support")


# --- batches of scored rows ----------------------------------------------


def batched(spark, d, size=32):
    """Orders as scored rows in batches of 32; the epoch is the order's status."""
    rows = table(spark, d, "orders").select("o_orderkey", (F.col("o_totalprice") / 1000.0).alias("y"), "o_orderpriority")
    rows = batches.assign_batches(rows, ["o_orderkey"], size)
    err = F.abs(F.col("y") - 150.0)
    return rows.select("o_orderkey", "batch_id", (F.col("batch_id") % 3).cast("int").alias("epoch"), err.alias("loss"))


_SQL_BATCHED = """b AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 32 AS batch_id, abs(o_totalprice / 1000.0::DOUBLE - 150) AS loss FROM orders),
e AS (SELECT *, (batch_id % 3)::INT AS epoch FROM b),
pb AS (SELECT epoch, batch_id, count(*) AS n_rows, avg(loss) AS loss, avg((loss < 50)::INT) AS hit FROM e GROUP BY 1, 2)"""


def _row_metrics():
    return {"loss": F.col("loss"), "hit": (F.col("loss") < 50).cast("double")}


def _rounded(df, *cols):
    return df.select(*[c for c in df.columns if c not in cols], *[rnd(F.col(c)).alias(c) for c in cols])


@query(
    "a_23_epoch_batch_mean",
    f"WITH {_SQL_BATCHED} SELECT epoch, {sql_rnd('avg(loss)')} AS loss, {sql_rnd('avg(hit)')} AS hit FROM pb GROUP BY 1",
)
def a_23(spark, d):
    return _rounded(metrics.epoch_metrics(batched(spark, d), _row_metrics()), "loss", "hit")


@query(
    "a_24_epoch_sample_mean",
    f"WITH {_SQL_BATCHED} SELECT epoch, {sql_rnd('sum(loss * n_rows) / sum(n_rows)')} AS loss, {sql_rnd('sum(hit * n_rows) / sum(n_rows)')} AS hit FROM pb GROUP BY 1",
)
def a_24(spark, d):
    return _rounded(metrics.epoch_metrics(batched(spark, d), _row_metrics(), "sample_mean"), "loss", "hit")


def _running_sql(divide):
    return f"""WITH {_SQL_BATCHED},
r AS (SELECT epoch, batch_id, sum(loss) OVER w / {divide} AS running FROM pb
  WINDOW w AS (PARTITION BY epoch ORDER BY batch_id ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY epoch))
SELECT epoch, batch_id, {sql_rnd('running')} AS running FROM r WHERE batch_id % 40 = 0"""


def _running(spark, d, by):
    per_batch = metrics.batch_metrics(batched(spark, d), _row_metrics()).select("epoch", "batch_id", "loss")
    out = metrics.every_nth(metrics.running_metric(per_batch, "loss", by=by), "batch_id", 40)
    return out.select("epoch", "batch_id", rnd(F.col("running")).alias("running"))


@query("ord_7_running_metric", _running_sql("count(*) OVER w"))
def ord_7(spark, d):
    return _running(spark, d, "so_far")


@query("ord_7_running_metric_of_all", _running_sql("count(*) OVER a"))
def ord_7_all(spark, d):
    return _running(spark, d, "all")


@query(
    "j_7_prediction_label",
    f"""WITH {SQL_VECTORS}, t AS (SELECT vec_id AS row_id, y, pred FROM am)
SELECT row_id, y AS label, pred, y = pred AS correct FROM t""",
)
def j_7(spark, d):
    both = predicted(spark, d).withColumnRenamed("vec_id", "row_id")
    labels = table(spark, d, "embeddings").select(F.col("vec_id").alias("row_id"), "label")
    return labels.join(both.select("row_id", "pred"), "row_id").withColumn("correct", F.col("label") == F.col("pred"))


@query("p_5_equality", "SELECT l_returnflag, l_linestatus, count(*) FILTER (WHERE l_returnflag = l_linestatus) AS n_equal, count(*) AS n FROM lineitem GROUP BY 1, 2")
def p_5(spark, d):
    same = F.col("l_returnflag") == F.col("l_linestatus")
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count_if(same).alias("n_equal"), F.count(F.lit(1)).alias("n")
    )


_SQL_STATS = "st AS (SELECT avg(o_totalprice) AS mu, stddev_samp(o_totalprice) AS sd FROM orders)"


@query(
    "p_13_standardize",
    f"WITH {_SQL_STATS} SELECT o_orderkey, {sql_rnd('(o_totalprice - mu) / sd')} AS scaled, {sql_rnd('(o_totalprice - mu) / sd * sd + mu', 4)} AS restored FROM orders, st",
)
def p_13(spark, d):
    from framelearn.operators.tensors import destandardize, fit_stats, standardize

    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    stats = fit_stats(rows, "o_totalprice")
    out = destandardize(standardize(rows, "o_totalprice", stats, "scaled"), "scaled", stats, "restored")
    return out.select("o_orderkey", rnd(F.col("scaled")).alias("scaled"), rnd(F.col("restored"), 4).alias("restored"))


@query(
    "p_19_class_names",
    "SELECT vec_id, label, n_name AS class_name FROM embeddings LEFT JOIN nation ON label = n_nationkey",
)
def p_19(spark, d):
    classes = table(spark, d, "nation").select(F.col("n_nationkey").alias("label"), F.col("n_name").alias("class_name"))
    return lookup_join(table(spark, d, "embeddings").select("vec_id", "label"), classes, ["label"], "left")


@query("p_23_every_nth", "SELECT event_id, event_type, value FROM events WHERE event_id % 100 = 0")
def p_23(spark, d):
    return metrics.every_nth(table(spark, d, "events").select("event_id", "event_type", "value"), "event_id", 100)


# --- order, split, batch --------------------------------------------------


@query("ord_1_sorted_distinct", "SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS idx FROM (SELECT DISTINCT p_type FROM part)")
def ord_1(spark, d):
    return dense_index(table(spark, d, "part").select("p_type").distinct(), ["p_type"])


@query(
    "ord_2_top_n",
    """WITH r AS (SELECT o_orderpriority, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
SELECT * FROM r WHERE rank <= 5""",
)
def ord_2(spark, d):
    rows = table(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return batches.top_n(rows, "o_totalprice", 5, ["o_orderkey"], ["o_orderpriority"])


_SPLIT_OUT = "count(*) AS n, sum(o_orderkey)::BIGINT AS keys, max(o_orderkey) AS last_key"


def _split_summary(df):
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.max("o_orderkey").alias("last_key")
    )


def _split_sql(order):
    return f"""WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {order}) - 1 AS i, count(*) OVER () AS n FROM orders)
SELECT CASE WHEN i < floor(0.8 * n) THEN 'train' ELSE 'test' END AS split, {_SPLIT_OUT} FROM r GROUP BY 1"""


_HASH = "('0x'||substr(md5(o_orderkey||':42:0'),1,15))::BIGINT, o_orderkey"


@query("ord_3_split_sequential", _split_sql("o_totalprice, o_orderkey"))
def ord_3(spark, d):
    rows = table(spark, d, "orders").select("o_totalprice", "o_orderkey")
    train, test = batches.split_sequential(rows, ["o_totalprice", "o_orderkey"])
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return _split_summary(both)


@query("ord_4_split_random", _split_sql(_HASH))
def ord_4(spark, d):
    return _split_summary(batches.with_split(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], seed=42))


@query(
    "ord_4_split_threshold",
    f"SELECT CASE WHEN ('0x'||substr(md5(o_orderkey||':42:0'),1,15))::BIGINT < {int(0.8 * 2**60)} THEN 'train' ELSE 'test' END AS split, {_SPLIT_OUT} FROM orders GROUP BY 1",
)
def ord_4_threshold(spark, d):
    return _split_summary(batches.split_by_threshold(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], seed=42))


def _batch_sql(order, drop):
    keep = "WHERE i < n // 64 * 64" if drop else ""
    return f"""WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {order}) - 1 AS i, count(*) OVER () AS n FROM orders)
SELECT i // 64 AS batch_id, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM r {keep} GROUP BY 1"""


def _batch_summary(df):
    return df.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query("ord_5_batches", _batch_sql("o_orderkey", False))
def ord_5(spark, d):
    return _batch_summary(batches.assign_batches(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], 64))


@query("ord_5_batches_drop_last", _batch_sql(_HASH, True))
def ord_5_drop(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey")
    return _batch_summary(batches.assign_batches(rows, ["o_orderkey"], 64, drop_last=True, shuffle=True, seed=42))


@query(
    "ord_5_graph_batches",
    """WITH g AS (SELECT conv_id, (row_number() OVER (ORDER BY conv_id) - 1) // 32 AS batch_id FROM (SELECT DISTINCT conv_id FROM conversations))
SELECT batch_id, count(DISTINCT conv_id) AS n_graphs, count(*) AS n_nodes FROM g JOIN conversations USING (conv_id) GROUP BY 1""",
)
def ord_5_graphs(spark, d):
    nodes = table(spark, d, "conversations").select("conv_id", "turn")
    graphs = batches.assign_batches(nodes.select("conv_id").distinct(), ["conv_id"], 32)
    sizes = nodes.groupBy("conv_id").agg(F.count(F.lit(1)).alias("nodes"))
    return lookup_join(graphs, sizes, ["conv_id"], "inner").groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_graphs"), F.sum("nodes").alias("n_nodes")
    )


@query(
    "ord_6_shuffle",
    "SELECT o_orderkey, row_number() OVER (ORDER BY ('0x'||substr(md5(o_orderkey||':42:3'),1,15))::BIGINT, o_orderkey) - 1 AS idx FROM orders",
)
def ord_6(spark, d):
    return batches.shuffle_rows(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], seed=42, epoch=3)


def _permuted_sql(seed: int, epoch: int) -> str:
    """``batches.permuted`` for ``pos`` of ``placed``, of n rows: passes of rounds on a grid, as relations."""
    p, f = batches.MIX_MODULUS, batches.MIX_FACTOR
    keys = batches.permutation_plan(1, seed, epoch)[2]

    def mixed(x, key):
        h = f"(({x}) % {p} * {f} + {key}) % {p}"
        return h, f"(h * h % {p} + h * {f} + 11) % {p}"

    steps, at = [], "g0"
    for walk in range(batches.WALKS):
        steps.append(f"s{walk}_0 AS (SELECT *, v AS was, v % a AS l, v // a AS r FROM {at})")
        last = f"s{walk}_0"
        for k, (x, y) in enumerate(keys):
            for side, (own, other, size, key) in enumerate((("l", "r", "a", x), ("r", "l", "b", y))):
                first, again = mixed(other, key)
                name = f"s{walk}_{k}_{side}"
                steps.append(
                    f"{name} AS (SELECT * EXCLUDE (h, {own}), ({own} + h) % {size} AS {own} FROM (SELECT * REPLACE ({again} AS h) FROM (SELECT * REPLACE ({again} AS h) FROM (SELECT *, {first} AS h FROM {last}))))"
                )
                last = name
        at = f"g{walk + 1}"
        # the first pass is for all rows, the others for places beyond the last position
        again = "true" if walk == 0 else "was >= n"
        steps.append(f"{at} AS (SELECT * EXCLUDE (v, was, l, r), CASE WHEN {again} THEN r * a + l ELSE was END AS v FROM {last})")
    return ",\n".join(steps), at


_STEPS, _LAST = _permuted_sql(42, 3)
_PERMUTED = f"""WITH placed AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders),
side AS (SELECT *, floor(sqrt(n - 1))::BIGINT + 1 AS a FROM placed),
g0 AS (SELECT *, (n + a - 1) // a AS b, pos AS v FROM side),
{_STEPS}
SELECT o_orderkey, v::BIGINT AS idx, (v // 64)::BIGINT AS batch_id FROM {_LAST}"""


@query("ord_6_shuffle_permuted", _PERMUTED)
def ord_6_permuted(spark, d):
    """An epoch's shuffled batches by arithmetic on positions that were numbered once."""
    rows = table(spark, d, "orders").select("o_orderkey")
    placed = dense_index(rows, ["o_orderkey"], name="pos")
    return batches.permuted_batches(placed, "pos", rows.count(), 64, seed=42, epoch=3).drop("pos")


@query(
    "ord_9_second_batch",
    "WITH r AS (SELECT o_orderkey, o_totalprice, (row_number() OVER (ORDER BY o_orderkey) - 1) // 32 AS batch_id FROM orders) SELECT * FROM r WHERE batch_id = 1",
)
def ord_9(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return batches.nth_batch(rows, ["o_orderkey"], 32, 1)


@query(
    "p_1_slice_rows",
    """WITH r AS (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS i, count(*) OVER () AS n FROM events)
SELECT event_id, CASE WHEN i < 10 THEN 'head' WHEN i >= n - 10 THEN 'tail' ELSE 'slice' END AS part FROM r
WHERE i < 10 OR (i >= 100 AND i < 200) OR i >= n - 10""",
)
def p_1(spark, d):
    rows, order = table(spark, d, "events").select("ts", "event_id"), ["ts", "event_id"]
    parts = {
        "head": batches.head(rows, order, 10),
        "slice": batches.slice_rows(rows, order, 100, 200),
        "tail": batches.tail(rows, order, 10),
    }
    return reduce(lambda a, b: a.unionByName(b), [p.select("event_id", F.lit(k).alias("part")) for k, p in parts.items()])


@query(
    "src_8_sample",
    "SELECT doc_id, source FROM documents ORDER BY ('0x'||substr(md5(doc_id||':42:0'),1,15))::BIGINT, doc_id LIMIT 25",
)
def src_8(spark, d):
    return batches.sample_n(table(spark, d, "documents").select("doc_id", "source"), ["doc_id"], 25, seed=42)
