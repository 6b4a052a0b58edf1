"""Registered queries: activations, scoring, training, images, graphs, sources, streams."""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
from pyspark.sql import functions as F

from framelearn.functions import columns as C
from framelearn.operators import graphs as GR
from framelearn.operators import images as IM
from framelearn.operators import metrics, models, tensors, training
from framelearn.operators.batches import split_random
from framelearn.plans.metric_queries import SQL_VECTORS, predicted, scored_docs, scored_vectors, SQL_DOCS
from framelearn.plans.registry import query, rnd, sql_rnd, table
from framelearn.plans.scale import dense_index, lookup_join, spread, unnest
from framelearn.plans.tensor_queries import _CIRCLE, SQL_X, circles, sql_gauss
from framelearn.plans.text_queries import SQL_PART_VOCAB, _ID_DIGEST, _id_digest, part_vocab
from framelearn.session import shared_dir
from framelearn.sources import files, readers, writers
from framelearn.streaming import streams

# --- weights by rule ------------------------------------------------------


def weight(layer, n_out, n_in):
    i, j = np.arange(n_out)[:, None], np.arange(n_in)[None, :]
    return ((i * 7 + j * 13 + layer * 5) % 11 - 5) / 10.0


def bias(layer, n_out):
    return ((np.arange(n_out) * 3 + layer) % 5 - 2) / 10.0


def mlp_params(spark, sizes, prefix="layers", first=0):
    arrays = {}
    for k, (n_in, n_out) in enumerate(zip(sizes, sizes[1:])):
        arrays[f"{prefix}.{k}.weight"] = weight(first + k, n_out, n_in)
        arrays[f"{prefix}.{k}.bias"] = bias(first + k, n_out)
    return arrays


def sql_weight(layer, i, j):
    return f"((({i}*7 + {j}*13 + {layer * 5}) % 11 - 5) / 10.0::DOUBLE)"


def sql_linear(name, src, keys, layer, n_out, post="{z}"):
    """A linear layer over a long relation (keys, j, v) as a CTE of the same form."""
    total = f"(sum(s.v * {sql_weight(layer, 'o.i', 's.j')}) + (((o.i*3 + {layer}) % 5 - 2) / 10.0::DOUBLE))"
    cols = ", ".join(f"s.{k}" for k in keys.split(", "))
    return (
        f"{name}z AS MATERIALIZED (SELECT {cols}, o.i AS j, {total} AS z FROM {src} s, (SELECT unnest(range({n_out})) AS i) o GROUP BY {cols}, o.i), "
        f"{name} AS (SELECT {keys}, j, {post.format(z='z')} AS v FROM {name}z)"
    )


RELU = "greatest({z}, 0.0::DOUBLE)"


def sql_mlp(name, src, keys, sizes, relu=True, first=0):
    """CTEs of a stack of layers; the last one is called ``name``."""
    parts, at = [], src
    for k, n_out in enumerate(sizes[1:]):
        last = k + 2 == len(sizes)
        here = name if last else f"{name}_{k}"
        parts.append(sql_linear(here, at, keys, first + k, n_out, RELU if relu and not last else "{z}"))
        at = here
    return ",\n".join(parts)


# --- activations ----------------------------------------------------------


@query("p_7_sigmoid", f"WITH {SQL_DOCS} SELECT doc_id, {sql_rnd('1 / (1 + exp(-z))')} AS p FROM s")
def p_7(spark, d):
    return scored_docs(spark, d).select("doc_id", rnd(C.sigmoid("z")).alias("p"))


@query("p_8_round_label", "SELECT l_quantity / 2 AS q, count(*) AS n, round_even(l_quantity / 2, 0) AS r FROM lineitem GROUP BY 1, 3")
def p_8(spark, d):
    half = F.col("l_quantity") / 2
    return table(spark, d, "lineitem").groupBy(half.alias("q"), C.round_label(half).alias("r")).agg(F.count(F.lit(1)).alias("n"))


@query("p_9_softmax", f"WITH {SQL_VECTORS} SELECT vec_id, k, {sql_rnd('e / t')} AS p FROM pr")
def p_9(spark, d):
    out = scored_vectors(spark, d).select("vec_id", F.posexplode(C.softmax("z")).alias("k", "p"))
    return out.withColumn("p", rnd(F.col("p")))


@query("p_10_argmax", f"WITH {SQL_VECTORS} SELECT vec_id, y, pred FROM am")
def p_10(spark, d):
    return predicted(spark, d)


@query("p_11_relu", f"WITH {SQL_VECTORS} SELECT vec_id, k, {sql_rnd('greatest(v, 0)')} AS v FROM l")
def p_11(spark, d):
    out = scored_vectors(spark, d).select("vec_id", F.posexplode(C.relu_vec("z")).alias("k", "v"))
    return out.withColumn("v", rnd(F.col("v")))


@query("p_12_top_probability", f"WITH {SQL_VECTORS} SELECT vec_id, {sql_rnd('top', 3)} AS prob FROM am")
def p_12(spark, d):
    return scored_vectors(spark, d).select("vec_id", rnd(C.top_probability("z", 12), 3).alias("prob"))


# --- linear model ---------------------------------------------------------


def line_params(spark, d):
    """Least-squares slope and intercept of price on quantity, as a parameter table."""
    src = table(spark, d, "lineitem")
    fit = src.agg(F.regr_slope("l_extendedprice", "l_quantity").alias("w"), F.regr_intercept("l_extendedprice", "l_quantity").alias("b"))
    w, b = fit.first()
    return models.params_frame(spark, {"weight": np.array([w]), "bias": np.array([b])})


_SQL_LINE = "f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS w, regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem)"


@query(
    "ml_1_predict_linear",
    f"WITH {_SQL_LINE} SELECT l_quantity, count(*) AS n, {sql_rnd('max(w * l_quantity + b)', 4)} AS pred FROM lineitem, f GROUP BY 1",
)
def ml_1(spark, d):
    out = models.predict_linear(table(spark, d, "lineitem"), line_params(spark, d), ["l_quantity"])
    return out.groupBy("l_quantity").agg(F.count(F.lit(1)).alias("n"), rnd(F.max("pred"), 4).alias("pred"))


_EPOCHS = 5


def _linear_sql():
    parts = ["d AS (SELECT l_quantity / 50 AS x, l_extendedprice / 100000 AS y FROM lineitem)", "e0 AS (SELECT 0.1::DOUBLE AS w, 0.0::DOUBLE AS b)"]
    for k in range(_EPOCHS):
        parts.append(
            f"g{k} AS MATERIALIZED (SELECT avg(sign(w*x+b-y)*x) AS gw, avg(sign(w*x+b-y)) AS gb, avg(abs(w*x+b-y)) AS loss FROM d, e{k})"
        )
        parts.append(f"e{k + 1} AS MATERIALIZED (SELECT w - 0.01::DOUBLE*gw AS w, b - 0.01::DOUBLE*gb AS b FROM e{k}, g{k})")
    rows = [f"SELECT 'loss_{k}' AS name, {sql_rnd('loss', 7)} AS value FROM g{k}" for k in range(_EPOCHS)]
    rows += [f"SELECT '{n}', {sql_rnd(c, 7)} FROM e{_EPOCHS}" for n, c in (("weight", "w"), ("bias", "b"))]
    return "WITH " + ",\n".join(parts) + " " + " UNION ALL ".join(rows)


@query("ml_2_fit_linear", _linear_sql())
def ml_2(spark, d):
    src = table(spark, d, "lineitem").select((F.col("l_quantity") / 50).alias("x"), (F.col("l_extendedprice") / 100000).alias("y"))
    fit = training.fit_linear_sgd(src, "x", "y", "l1", lr=0.01, epochs=_EPOCHS, init=(0.1, 0.0))
    losses = fit.history.select(F.concat(F.lit("loss_"), F.col("epoch").cast("string")).alias("name"), "value")
    final = fit.params.select("name", F.col("values")[0].alias("value"))
    return losses.unionByName(final).select("name", rnd(F.col("value"), 7).alias("value"))


# --- multi-layer models ---------------------------------------------------

_DEEP = [64, 15, 15, 15, 10]


def deep_logits(spark, d):
    """The four-layer model over the labelled vectors."""
    src = spread(table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").alias("features")), "vec_id")
    return models.predict_mlp(src, models.params_frame(spark, mlp_params(spark, _DEEP)))


_SQL_DEEP = f"""{SQL_X.replace('i0', 'vec_id').replace('vec_id AS vec_id', 'vec_id').replace('i1', 'j')},
{sql_mlp('z', 'x', 'vec_id', _DEEP)},
mx AS (SELECT vec_id, max(v) AS m FROM z GROUP BY 1),
pr AS (SELECT z.vec_id, j, v, m, exp(v - m) / sum(exp(v - m)) OVER (PARTITION BY z.vec_id) AS p, sum(exp(v - m)) OVER (PARTITION BY z.vec_id) AS t FROM z JOIN mx USING (vec_id)),
am AS (SELECT vec_id, (min(j) FILTER (WHERE v = m))::INT AS pred, max(p) AS prob FROM pr GROUP BY 1),
sc AS (SELECT vec_id, label, pred, prob, m + ln(t) - v AS loss FROM am JOIN embeddings USING (vec_id) JOIN pr USING (vec_id) WHERE pr.j = label)"""


@query("ml_3_predict_mlp", f"WITH {_SQL_DEEP} SELECT vec_id, j::INT AS k, {sql_rnd('v')} AS z FROM z")
def ml_3(spark, d):
    out = unnest(deep_logits(spark, d), ["vec_id"], "logits", "z", "k")
    return out.withColumn("z", rnd(F.col("z")))


def order_features(spark, d):
    src = table(spark, d, "orders")
    return src.select(
        F.col("o_orderkey").alias("row_id"),
        F.array(F.col("o_totalprice") / 100000, F.col("o_custkey") / 1000).alias("features"),
    )


_SQL_ORDERS = """x AS (SELECT o_orderkey AS row_id, 0 AS j, o_totalprice / 100000 AS v FROM orders
UNION ALL SELECT o_orderkey, 1, o_custkey / 1000.0::DOUBLE FROM orders)"""


@query(
    "ml_3_predict_mlp_no_relu",
    f"WITH {_SQL_ORDERS}, {sql_mlp('z', 'x', 'row_id', [2, 5, 1], relu=False)} SELECT row_id, {sql_rnd('v')} AS z FROM z",
)
def ml_3_linear(spark, d):
    params = models.params_frame(spark, mlp_params(spark, [2, 5, 1]))
    out = models.predict_mlp(order_features(spark, d), params, relu=False)
    return out.select("row_id", rnd(F.col("logits")[0]).alias("z"))


@query(
    "ml_3_predict_mlp_binary",
    f"WITH {_SQL_ORDERS}, {sql_mlp('z', 'x', 'row_id', [2, 10, 10, 1])} SELECT row_id, round_even(1 / (1 + exp(-v)), 0)::INT AS pred FROM z",
)
def ml_3_binary(spark, d):
    params = models.params_frame(spark, mlp_params(spark, [2, 10, 10, 1]))
    return models.predict(order_features(spark, d), params, "row_id", binary=True)


@query(
    "ml_10_evaluate",
    f"WITH {_SQL_DEEP} SELECT 'deep' AS model_name, {sql_rnd('avg(loss)')} AS eval_loss, {sql_rnd('100 * avg((label = pred)::INT)')} AS eval_acc, 'spark' AS device FROM sc",
)
def ml_10(spark, d):
    scored = deep_logits(spark, d).withColumn("pred", C.argmax("logits"))
    out = models.evaluate(scored, "deep", C.cross_entropy_loss("logits", "label"), C.accuracy_pct("label", "pred"))
    return out.withColumn("eval_loss", rnd(F.col("eval_loss"))).withColumn("eval_acc", rnd(F.col("eval_acc")))


@query(
    "ml_10_evaluate_batches",
    f"""WITH {_SQL_DEEP}, b AS (SELECT vec_id // 32 AS batch_id, avg(loss) AS l, 100 * avg((label = pred)::INT) AS a FROM sc GROUP BY 1)
SELECT 'deep' AS model_name, {sql_rnd('avg(l)')} AS eval_loss, {sql_rnd('avg(a)')} AS eval_acc, 'spark' AS device FROM b""",
)
def ml_10_batches(spark, d):
    scored = deep_logits(spark, d).withColumn("pred", C.argmax("logits")).withColumn("batch_id", F.floor(F.col("vec_id") / 32))
    hit = (F.col("label") == F.col("pred")).cast("double") * 100.0
    out = models.evaluate_batches(scored, "deep", C.ce_row("logits", "label"), hit)
    return out.withColumn("eval_loss", rnd(F.col("eval_loss"))).withColumn("eval_acc", rnd(F.col("eval_acc")))


@query("ml_11_predict", f"WITH {_SQL_DEEP} SELECT vec_id, pred FROM am")
def ml_11(spark, d):
    src = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("features"))
    return models.predict(src, models.params_frame(spark, mlp_params(spark, _DEEP)), "vec_id")


@query(
    "ml_12_classify",
    f"WITH {_SQL_DEEP} SELECT vec_id, pred, {sql_rnd('prob', 3)} AS prob, n_name AS class_name FROM am LEFT JOIN nation ON pred = n_nationkey",
)
def ml_12(spark, d):
    classes = table(spark, d, "nation").select(F.col("n_nationkey").alias("label"), F.col("n_name").alias("class_name"))
    out = models.classify(deep_logits(spark, d), classes, places=12)
    return out.select("vec_id", "pred", rnd(F.col("prob"), 3).alias("prob"), "class_name")


_SURFACE = [2, 10, 10, 10]
_SQL_SURFACE = f"""box AS (SELECT min(embedding[1])::DOUBLE - 0.1::DOUBLE AS x0, max(embedding[1])::DOUBLE + 0.1::DOUBLE AS x1,
  min(embedding[2])::DOUBLE - 0.1::DOUBLE AS y0, max(embedding[2])::DOUBLE + 0.1::DOUBLE AS y1 FROM embeddings),
grid AS (SELECT g AS row_id, CASE WHEN g % 101 = 100 THEN x1 ELSE x0 + (g % 101) * ((x1 - x0) / 100.0::DOUBLE) END AS x,
  CASE WHEN g // 101 = 100 THEN y1 ELSE y0 + (g // 101) * ((y1 - y0) / 100.0::DOUBLE) END AS y FROM box, (SELECT unnest(range(10201)) AS g)),
gx AS (SELECT row_id, 0 AS j, x AS v FROM grid UNION ALL SELECT row_id, 1, y FROM grid),
{sql_mlp('z', 'gx', 'row_id', _SURFACE)}, mx AS (SELECT row_id, max(v) AS m FROM z GROUP BY 1)"""


@query(
    "ml_13_decision_surface",
    f"WITH {_SQL_SURFACE} SELECT row_id, min(j)::INT AS pred FROM z JOIN mx USING (row_id) WHERE v = m GROUP BY 1",
)
def ml_13(spark, d):
    e = F.col("embedding")
    src = table(spark, d, "embeddings").select(e[0].cast("double").alias("x"), e[1].cast("double").alias("y"), "label")
    params = models.params_frame(spark, mlp_params(spark, _SURFACE))
    return models.decision_surface(src, params, "x", "y", "label").select("row_id", "pred")


# --- training -------------------------------------------------------------


def doc_features(spark, d):
    src = table(spark, d, "documents").select("doc_id", "n_chars", F.length(F.regexp_replace("text", "[^ ]", "")).alias("gaps"))
    joined = lookup_join(src, table(spark, d, "labels"), ["doc_id"], "inner")
    return joined.select(
        F.col("doc_id").alias("row_id"),
        F.array(F.col("n_chars") / 10000, F.col("gaps") / 1000).alias("features"),
        F.col("quality").alias("label"),
    )


def vector_rows(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("row_id"), F.col("embedding").alias("features"), "label")


def _history(fit, *wanted):
    """Chosen metrics per epoch, and the sum of every learned array under epoch -1."""
    kept = fit.history.filter(F.col("metric").isin(list(wanted)))
    sums = fit.params.select(
        F.lit("").alias("run"),
        F.lit(-1).alias("epoch"),
        F.col("name").alias("metric"),
        C.vec_sum("values").alias("value"),
    )
    return kept.unionByName(sums).select("epoch", "metric", rnd(F.col("value")).alias("value"))


def _mask_sql(name, source, layer, seed, step, rate):
    """name(r, i, m): the dropout factor of each unit, drawn as ``training.dropout_mask`` draws it."""
    p, a, b = training.DRAW_MODULUS, training.DRAW_ROW, training.DRAW_UNIT
    h = f"SELECT r, i, (r::BIGINT % {p} * {a} + (i + 1) * {b} + {training.draw_salt(layer, seed, step)}) % {p} AS h FROM {source}"
    for _ in range(3):
        h = f"SELECT r, i, (h * h % {p} + {a} * h + 11) % {p} AS h FROM ({h})"
    return f"{name} AS MATERIALIZED (SELECT r, i, (h::DOUBLE / {p} >= {rate}::DOUBLE)::INT / (1 - {rate}::DOUBLE) AS m FROM ({h}))"


def _forward_sql(tag, step, n_layers, x, y, dropout=None, seed=0):
    """Activations a<tag>_k and outputs z<tag>_k of rows (x, y) with the weights of a step."""
    parts = [f"a{tag}_0 AS (SELECT r, j, v FROM {x} JOIN {y} USING (r) UNION ALL SELECT r, -1, 1 FROM {y})"]
    for k in range(n_layers):
        parts.append(f"z{tag}_{k} AS MATERIALIZED (SELECT r, i, sum(v * w) AS v FROM a{tag}_{k} JOIN w{step}_{k} USING (j) GROUP BY 1, 2)")
        if k + 1 < n_layers and dropout and dropout[k]:
            parts.append(_mask_sql(f"k{tag}_{k}", f"z{tag}_{k}", k, seed, step, dropout[k]))
            parts.append(f"a{tag}_{k + 1} AS (SELECT r, i AS j, greatest(v, 0) * m AS v FROM z{tag}_{k} JOIN k{tag}_{k} USING (r, i) UNION ALL SELECT r, -1, 1 FROM {y})")
        elif k + 1 < n_layers:
            parts.append(f"a{tag}_{k + 1} AS (SELECT r, i AS j, greatest(v, 0) AS v FROM z{tag}_{k} UNION ALL SELECT r, -1, 1 FROM {y})")
    return parts


def _loss_sql(tag, loss, z, y):
    """l<tag>(r, loss, hit) and the slope of the loss at the outputs, d<tag>(r, i, v)."""
    if loss == "ce":
        return [
            f"x{tag} AS (SELECT r, max(v) AS top FROM {z} GROUP BY 1)",
            f"t{tag} AS (SELECT r, any_value(top) AS top, sum(exp(v - top)) AS t, min(i) FILTER (WHERE v = top) AS pred FROM {z} JOIN x{tag} USING (r) GROUP BY 1)",
            f"d{tag} AS MATERIALIZED (SELECT r, i, exp(v - top) / t - (i = y)::INT AS v FROM {z} JOIN t{tag} USING (r) JOIN {y} USING (r))",
            f"l{tag} AS MATERIALIZED (SELECT r, ln(t) + top - v AS loss, (pred = y)::INT AS hit FROM {z} JOIN t{tag} USING (r) JOIN {y} USING (r) WHERE i = y)",
        ]
    if loss == "bce":
        slope, value = "1 / (1 + exp(-v)) - y", "greatest(v, 0) - v * y + ln(1 + exp(-abs(v)))"
        hit = "(round_even(1 / (1 + exp(-v)), 0) = y)"
    else:
        slope, value, hit = "sign(v - y)", "abs(v - y)", "(abs(v - y) < 0.5)"
    return [
        f"d{tag} AS MATERIALIZED (SELECT r, i, {slope} AS v FROM {z} JOIN {y} USING (r))",
        f"l{tag} AS MATERIALIZED (SELECT r, {value} AS loss, {hit}::INT AS hit FROM {z} JOIN {y} USING (r))",
    ]


def sql_fit(data, sizes, loss, lr, epochs, batches=None, adam=False, test=False, final=None, dropout=None, seed=0, plateau=None, also=(), extra=()):
    """The same training in SQL: relations for weights, activations and slopes per step.

    ``data`` defines dx(r, j, v) and dy(r, y), with ``test`` also tx and ty. Biases
    are weights at j = -1. With ``batches`` each epoch deals rows by seeded hash.
    ``final`` is a query over the last test outputs, zt(r, i, v), instead of the history.
    ``dropout`` has a rate per hidden layer, ``plateau`` a rule for the learning
    rate; ``also`` adds the metrics lr and train_f1, ``extra`` further rows over zt.
    """
    n_layers, parts, rows, step = len(sizes) - 1, [data], [], 0
    parts.append(f"lr0 AS (SELECT {lr}::DOUBLE AS lr, 'inf'::DOUBLE AS best, 0 AS bad)")
    last = n_layers - 1
    for k, (n_in, n_out) in enumerate(zip(sizes, sizes[1:])):
        grid = f"(SELECT unnest(range({n_out})) AS i) a, (SELECT unnest(range(-1, {n_in})) AS j) b"
        rule = f"CASE WHEN j = -1 THEN ((i*3 + {k}) % 5 - 2) / 10.0::DOUBLE ELSE {sql_weight(k, 'i', 'j')} END"
        parts.append(f"w0_{k} AS (SELECT i, j, {rule} AS w, 0.0::DOUBLE AS m, 0.0::DOUBLE AS q FROM {grid})")
    for epoch in range(epochs):
        count = batches or 1
        if batches:
            size = f"((SELECT count(*) FROM dy) + {batches - 1}) // {batches}"
            place = f"row_number() OVER (ORDER BY ('0x'||substr(md5(r||':0:{epoch}'),1,15))::BIGINT, r) - 1"
            parts.append(f"deal{epoch} AS MATERIALIZED (SELECT r, y, ({place}) // ({size}) AS b FROM dy)")
        for b in range(count):
            s = step
            parts.append(f"y{s} AS (SELECT r, y FROM deal{epoch} WHERE b = {b})" if batches else f"y{s} AS (SELECT r, y FROM dy)")
            parts += _forward_sql(s, s, n_layers, "dx", f"y{s}", dropout, seed)
            parts += _loss_sql(s, loss, f"z{s}_{last}", f"y{s}")
            parts.append(f"d{s}_{last} AS (SELECT * FROM d{s})")
            for k in range(last, 0, -1):
                kept, factor = (f" JOIN k{s}_{k - 1} m ON m.r = d.r AND m.i = w.j", " * any_value(m.m)") if dropout and dropout[k - 1] else ("", "")
                parts.append(
                    f"d{s}_{k - 1} AS MATERIALIZED (SELECT d.r, w.j AS i, sum(d.v * w.w) * (any_value(p.v) > 0)::INT{factor} AS v FROM d{s}_{k} d JOIN w{s}_{k} w USING (i) "
                    f"JOIN z{s}_{k - 1} p ON p.r = d.r AND p.i = w.j{kept} GROUP BY 1, 2)"
                )
            for k in range(n_layers):
                parts.append(f"g{s}_{k} AS MATERIALIZED (SELECT i, j, sum(d.v * a.v) / (SELECT count(*) FROM y{s}) AS g FROM d{s}_{k} d JOIN a{s}_{k} a USING (r) GROUP BY 1, 2)")
                if adam:
                    m, q = "(0.9::DOUBLE * m + 0.1::DOUBLE * g)", "(0.999::DOUBLE * q + 0.001::DOUBLE * g * g)"
                    move = f"{m} / (1 - power(0.9::DOUBLE, {s + 1})) / (sqrt({q} / (1 - power(0.999::DOUBLE, {s + 1}))) + 1e-8::DOUBLE)"
                    new = f"w - (SELECT lr FROM lr{epoch if plateau else 0}) * {move} AS w, {m} AS m, {q} AS q"
                else:
                    new = f"w - (SELECT lr FROM lr{epoch if plateau else 0}) * g AS w, m, q"
                parts.append(f"w{s + 1}_{k} AS MATERIALIZED (SELECT i, j, {new} FROM w{s}_{k} JOIN g{s}_{k} USING (i, j))")
            step += 1
        mine = " UNION ALL ".join(f"SELECT loss, hit FROM l{t}" for t in range(step - count, step))
        kinds = [("train", mine)]
        if test:
            parts += _forward_sql(f"t{epoch}", step, n_layers, "tx", "ty")
            parts += _loss_sql(f"t{epoch}", loss, f"zt{epoch}_{last}", "ty")
            kinds.append(("test", f"SELECT loss, hit FROM lt{epoch}"))
        for kind, source in kinds:
            parts.append(f"h{kind}{epoch} AS (SELECT avg(loss) AS loss, 100 * avg(hit) AS acc FROM ({source}))")
            rows += [f"SELECT {epoch} AS epoch, '{kind}_{n}' AS metric, {sql_rnd(n)} AS value FROM h{kind}{epoch}" for n in ("loss", "acc")]
        if "lr" in also:
            rows.append(f"SELECT {epoch}, 'lr', {sql_rnd('lr')} FROM lr{epoch if plateau else 0}")
        if "train_f1" in also:
            guesses = " UNION ALL ".join(f"SELECT pred, y FROM t{t} JOIN y{t} USING (r)" for t in range(step - count, step))
            per_class = "SELECT c, count(*) FILTER (WHERE pred = c AND y = c) AS tp, count(*) FILTER (WHERE pred = c) + count(*) FILTER (WHERE y = c) AS n"
            parts.append(
                f"f{epoch} AS (SELECT avg(2.0::DOUBLE * tp / n) AS f1 FROM ({per_class} FROM (SELECT unnest(range({sizes[-1]})) AS c), ({guesses}) GROUP BY c) WHERE n > 0)"
            )
            rows.append(f"SELECT {epoch}, 'train_f1', {sql_rnd('f1')} FROM f{epoch}")
        if plateau:
            better, worn = f"loss < best * (1 - {plateau.threshold}::DOUBLE)", f"bad + 1 > {plateau.patience}"
            parts.append(
                f"lr{epoch + 1} AS MATERIALIZED (SELECT CASE WHEN {better} OR NOT ({worn}) THEN lr ELSE lr * {plateau.factor}::DOUBLE END AS lr, "
                f"CASE WHEN {better} THEN loss ELSE best END AS best, CASE WHEN {better} OR {worn} THEN 0 ELSE bad + 1 END AS bad "
                f"FROM lr{epoch}, h{'test' if test else 'train'}{epoch})"
            )
    if final:
        parts.append(f"zt AS (SELECT * FROM zt{epochs - 1}_{last})")
        return "WITH " + ",\n".join(parts) + "\n" + final
    if extra:
        parts.append(f"zt AS (SELECT * FROM zt{epochs - 1}_{last})")
        rows += extra
    for k in range(n_layers):
        for n, cond in (("weight", "j >= 0"), ("bias", "j = -1")):
            rows.append(f"SELECT -1, 'layers.{k}.{n}', {sql_rnd('sum(w)')} FROM w{step}_{k} WHERE {cond}")
    return "WITH " + ",\n".join(parts) + "\n" + " UNION ALL ".join(rows)


_LOSS = ("train_loss", "train_acc")
_FIT_DOCS = """f AS (SELECT doc_id AS r, n_chars / 10000.0::DOUBLE AS x0, length(regexp_replace(text, '[^ ]', '', 'g')) / 1000.0::DOUBLE AS x1, quality AS y FROM documents JOIN labels USING (doc_id)),
dx AS (SELECT r, 0 AS j, x0 AS v FROM f UNION ALL SELECT r, 1, x1 FROM f), dy AS (SELECT r, y FROM f)"""
_FIT_ORDERS = """dx AS (SELECT o_orderkey AS r, 0 AS j, (o_custkey + 0.37::DOUBLE) / 997.0::DOUBLE AS v FROM orders), dy AS (SELECT o_orderkey AS r, o_totalprice / 100000 AS y FROM orders)"""
_FIT_VECTORS = """dx AS (SELECT vec_id AS r, unnest(range(64)) AS j, unnest(embedding)::DOUBLE AS v FROM embeddings), dy AS (SELECT vec_id AS r, label AS y FROM embeddings)"""


def _start(sizes):
    return mlp_params(None, sizes)


@query("ml_4_fit_binary", sql_fit(_FIT_DOCS, [2, 10, 10, 1], "bce", 0.1, 3))
def ml_4(spark, d):
    sizes = [2, 10, 10, 1]
    return _history(training.fit_mlp(doc_features(spark, d), sizes, "bce", lr=0.1, epochs=3, init=_start(sizes)), *_LOSS)


_FIT_CIRCLES = f"""{_CIRCLE},
pt AS (SELECT row_id AS r, label AS y, r * cos(t) + 0.03::DOUBLE * {sql_gauss('row_id', 42, 0)} AS x0, r * sin(t) + 0.03::DOUBLE * {sql_gauss('row_id', 42, 1)} AS x1,
  row_number() OVER (ORDER BY ('0x'||substr(md5(row_id||':42:0'),1,15))::BIGINT, row_id) - 1 AS pos, count(*) OVER () AS n FROM a),
dy AS (SELECT r, y FROM pt WHERE pos < floor(0.8 * n)), ty AS (SELECT r, y FROM pt WHERE pos >= floor(0.8 * n)),
dx AS (SELECT r, 0 AS j, x0 AS v FROM pt UNION ALL SELECT r, 1, x1 FROM pt), tx AS (SELECT * FROM dx)"""


@query("ml_4_fit_circles", sql_fit(_FIT_CIRCLES, [2, 10, 10, 1], "bce", 0.1, 3, test=True))
def ml_4_circles(spark, d):
    """Circles with one point per customer, split at random, with test metrics."""
    points = circles(spark, d, 0.03).select("row_id", models.features("x1", "x2").alias("features"), "label")
    train, test = split_random(points, ["row_id"], 0.8, seed=42)
    sizes = [2, 10, 10, 1]
    fit = training.fit_mlp(train, sizes, "bce", lr=0.1, epochs=3, test=test, init=_start(sizes))
    return _history(fit, *_LOSS, "test_loss", "test_acc")


@query("ml_5_fit_regression", sql_fit(_FIT_ORDERS, [1, 10, 10, 1], "l1", 0.01, 2))
def ml_5(spark, d):
    src = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.array((F.col("o_custkey") + 0.37) / 997).alias("features"),
        (F.col("o_totalprice") / 100000).alias("label"),
    )
    sizes = [1, 10, 10, 1]
    return _history(training.fit_mlp(src, sizes, "l1", lr=0.01, epochs=2, init=_start(sizes)), *_LOSS)


@query("ml_6_fit_classes", sql_fit(_FIT_VECTORS, [64, 10, 10, 10], "ce", 0.1, 3))
def ml_6(spark, d):
    sizes = [64, 10, 10, 10]
    return _history(training.fit_mlp(vector_rows(spark, d), sizes, "ce", lr=0.1, epochs=3, init=_start(sizes)), *_LOSS)


@query("ml_7_fit_mini_batches", sql_fit(_FIT_VECTORS, [64, 10, 10], "ce", 0.1, 2, batches=4))
def ml_7(spark, d):
    rows, sizes = vector_rows(spark, d), [64, 10, 10]
    size = -(-rows.count() // 4)
    return _history(training.fit_mlp(rows, sizes, "ce", lr=0.1, epochs=2, batch_size=size, init=_start(sizes)), *_LOSS)


@query("ml_8_fit_adam", sql_fit(_FIT_VECTORS, [64, 10, 10], "ce", 0.001, 3, adam=True))
def ml_8_adam(spark, d):
    sizes = [64, 10, 10]
    return _history(training.fit_mlp(vector_rows(spark, d), sizes, "ce", lr=0.001, epochs=3, optimizer="adam", init=_start(sizes)), *_LOSS)


def _strict_plateau():
    return training.Plateau(factor=0.5, patience=0, threshold=0.5)


@query(
    "ml_8_fit_options",
    sql_fit(_FIT_VECTORS, [64, 10, 10], "ce", 0.001, 4, adam=True, dropout=[0.2], seed=42, plateau=_strict_plateau(), also=("lr", "train_f1")),
)
def ml_8(spark, d):
    """Adam, dropout and a learning rate that halves on a plateau."""
    sizes = [64, 10, 10]
    fit = training.fit_mlp(
        vector_rows(spark, d), sizes, "ce", lr=0.001, epochs=4, optimizer="adam", dropout=0.2, plateau=_strict_plateau(), seed=42, init=_start(sizes)
    )
    return _history(fit, *_LOSS, "lr", "train_f1")


@query(
    "ml_19_history",
    "SELECT 'timed' AS run, metric, count(*) AS n_epochs, min(value) AS least FROM ("
    + sql_fit(_FIT_VECTORS, [64, 10], "ce", 0.1, 3, also=("lr", "train_f1"))
    + ") WHERE epoch >= 0 GROUP BY metric",
)
def ml_19(spark, d):
    """The history without the seconds, which no run repeats."""
    fit = training.fit_mlp(vector_rows(spark, d), [64, 10], "ce", lr=0.1, epochs=3, run="timed", init=_start([64, 10]))
    kept = fit.history.filter("metric <> 'seconds'").withColumn("value", rnd(F.col("value")))
    return kept.groupBy("run", "metric").agg(F.count(F.lit(1)).alias("n_epochs"), F.min("value").alias("least"))


def class_params(spark, d):
    """One vector of means per class, and the same storage under a second name."""
    long = table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("k", "v"))
    means = long.groupBy("label", "k").agg(F.avg(F.col("v").cast("double")).alias("m"))
    packed = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("k", "m"))).alias("p"))
    values = F.transform("p", lambda x: x["m"])
    name = F.concat(F.lit("class_"), F.col("label").cast("string"))
    own = packed.select(
        F.concat(name, F.lit(".weight")).alias("name"), name.alias("storage_id"), F.array(F.size("p")).alias("shape"), values.alias("values")
    )
    tied = own.withColumn("name", F.concat("storage_id", F.lit(".tied")))
    return own.unionByName(tied)


_SQL_CLASS = "m AS (SELECT label, j, avg(v) AS v FROM (SELECT label, unnest(range(64)) AS j, unnest(embedding)::DOUBLE AS v FROM embeddings) GROUP BY 1, 2)"
_SQL_CLASS_NAMES = f"""{_SQL_CLASS}, n AS (SELECT 'class_' || label || '.weight' AS name, * FROM m UNION ALL SELECT 'class_' || label || '.tied', * FROM m)"""


def _param_summary(df):
    return df.select(
        "name", F.size("values").alias("n_values"), F.col("shape")[0].alias("n0"), rnd(C.vec_sum("values")).alias("total")
    )


@query(
    "ml_20_list_params",
    f"WITH {_SQL_CLASS_NAMES} SELECT name, count(*)::INT AS n_values, 64 AS n0, {sql_rnd('sum(v)')} AS total FROM n GROUP BY 1",
)
def ml_20(spark, d):
    return _param_summary(models.list_params(class_params(spark, d)))


@query("a_10_param_count", f"WITH {_SQL_CLASS} SELECT count(*) AS n_params FROM m")
def a_10(spark, d):
    return metrics.param_count(class_params(spark, d))


# --- images ---------------------------------------------------------------


def pictures(spark, d):
    """Each vector as a picture of one channel and 8 x 8 pixels."""
    return IM.as_images(table(spark, d, "embeddings"), "vec_id", "embedding", 1, 8, 8)


def color_pictures(spark, d):
    """Three channels: the vector, the vector backwards, and its absolute values."""
    e = F.col("embedding").cast("array<double>")
    three = F.concat(e, F.reverse(e), F.transform(e, F.abs))
    src = table(spark, d, "embeddings").select("vec_id", three.alias("p"))
    return IM.as_images(src, "vec_id", "p", 3, 8, 8)


SQL_PX = "px AS (SELECT vec_id AS img_id, 0 AS c, (j // 8)::INT AS y, (j % 8)::INT AS x, v FROM (SELECT vec_id, unnest(range(64)) AS j, unnest(embedding)::DOUBLE AS v FROM embeddings))"
SQL_PX3 = """px AS (SELECT vec_id AS img_id, 0 AS c, (j // 8)::INT AS y, (j % 8)::INT AS x, v FROM e
UNION ALL SELECT vec_id, 1, ((63 - j) // 8)::INT, ((63 - j) % 8)::INT, v FROM e UNION ALL SELECT vec_id, 2, (j // 8)::INT, (j % 8)::INT, abs(v) FROM e)"""
SQL_E = "e AS (SELECT vec_id, unnest(range(64)) AS j, unnest(embedding)::DOUBLE AS v FROM embeddings)"


def _px(df):
    return df.select("img_id", "c", "y", "x", rnd(F.col("v")).alias("v"))


_PX_OUT = f"SELECT img_id, c, y, x, {sql_rnd('v')} AS v FROM"


@query(
    "p_14_to_tensor",
    f"""WITH {SQL_E}, {SQL_PX3}, raw AS (SELECT img_id, c, y, x, floor(least(255, greatest(0, v * 255))) AS q FROM px)
SELECT img_id, c, y, x, {sql_rnd('q / 255.0::DOUBLE')} AS v FROM raw""",
)
def p_14(spark, d):
    raw = IM.to_uint8(color_pictures(spark, d)).drop("pixels")
    return _px(IM.long_pixels(IM.to_tensor(raw)))


@query(
    "p_18_to_uint8",
    f"WITH {SQL_E}, {SQL_PX3} SELECT img_id, (y * 24 + x * 3 + c)::INT AS at, floor(least(255, greatest(0, v * 255)))::INT AS value FROM px",
)
def p_18(spark, d):
    return IM.to_uint8(color_pictures(spark, d)).select("img_id", F.posexplode("data").alias("at", "value"))


@query(
    "p_15_grayscale",
    f"WITH {SQL_E}, {SQL_PX3} SELECT img_id, 0 AS c, y, x, {sql_rnd('sum(v * CASE c WHEN 0 THEN 0.299::DOUBLE WHEN 1 THEN 0.587::DOUBLE ELSE 0.114::DOUBLE END)')} AS v FROM px GROUP BY 1, 3, 4",
)
def p_15(spark, d):
    return _px(IM.long_pixels(IM.grayscale(color_pictures(spark, d))))


def _resize_sql(out, src="px"):
    reach = max(8 / out, 1.0)
    wt = f"greatest(0, 1 - abs({{i}} + 0.5::DOUBLE - ({{o}} + 0.5::DOUBLE) * {8 / out}::DOUBLE) / {reach}::DOUBLE)"
    return f"""w0 AS (SELECT o, i, {wt.format(i='i', o='o')} AS w FROM (SELECT unnest(range({out}))::INT AS o), (SELECT unnest(range(8))::INT AS i)),
w AS (SELECT o, i, w / sum(w) OVER (PARTITION BY o) AS w FROM w0),
r AS (SELECT img_id, c, a.o AS y, b.o AS x, sum(v * a.w * b.w) AS v FROM {src} JOIN w a ON a.i = y JOIN w b ON b.i = x GROUP BY 1, 2, 3, 4)"""


@query("p_16_resize_smaller", f"WITH {SQL_PX}, {_resize_sql(5)} {_PX_OUT} r")
def p_16(spark, d):
    return _px(IM.long_pixels(IM.resize(pictures(spark, d), 5, 5)))


@query("p_16_resize_larger", f"WITH {SQL_PX}, {_resize_sql(12)} {_PX_OUT} r")
def p_16_up(spark, d):
    return _px(IM.long_pixels(IM.resize(pictures(spark, d), 12, 12)))


@query("p_17_flatten", f"WITH {SQL_E}, {SQL_PX3} SELECT img_id, (c * 64 + y * 8 + x)::INT AS at, {sql_rnd('v')} AS v FROM px")
def p_17(spark, d):
    out = IM.flatten(color_pictures(spark, d)).select("img_id", F.posexplode("features").alias("at", "v"))
    return out.withColumn("v", rnd(F.col("v")))


@query(
    "p_22_compose",
    f"""WITH {SQL_E}, {SQL_PX3}, g AS (SELECT img_id, 0 AS c, y, x, sum(v * CASE c WHEN 0 THEN 0.299::DOUBLE WHEN 1 THEN 0.587::DOUBLE ELSE 0.114::DOUBLE END) AS v FROM px GROUP BY 1, 3, 4),
{_resize_sql(4, 'g')} {_PX_OUT} r""",
)
def p_22(spark, d):
    steps = IM.compose(IM.grayscale, lambda df: IM.resize(df, 4, 4))
    return _px(IM.long_pixels(steps(color_pictures(spark, d))))


def _conv_sql(src, name, n_out, layer, size, stride=1, padding=1, n_in=1, post="{z}"):
    """Convolution with kernels by rule: row o of the layer's weights, flattened (c, ky, kx)."""
    out = (size + 2 * padding - 3) // stride + 1
    wt = sql_weight(layer, "o.i", "(p.c * 9 + k.ky * 3 + k.kx)")
    z = f"(sum(p.v * {wt}) + (((o.i*3 + {layer}) % 5 - 2) / 10.0::DOUBLE))"
    return f"""{name}z AS MATERIALIZED (SELECT p.img_id, o.i::INT AS c, ((p.y + {padding} - k.ky) // {stride})::INT AS y, ((p.x + {padding} - k.kx) // {stride})::INT AS x, {z} AS z
FROM {src} p, (SELECT unnest(range({n_out})) AS i) o, (SELECT unnest(range(9)) // 3 AS ky, unnest(range(9)) % 3 AS kx) k
WHERE p.y + {padding} - k.ky >= 0 AND p.x + {padding} - k.kx >= 0 AND (p.y + {padding} - k.ky) % {stride} = 0 AND (p.x + {padding} - k.kx) % {stride} = 0
  AND (p.y + {padding} - k.ky) // {stride} < {out} AND (p.x + {padding} - k.kx) // {stride} < {out}
GROUP BY 1, o.i, 3, 4), {name} AS (SELECT img_id, c, y, x, {post.format(z='z')} AS v FROM {name}z)"""


def kernel(layer, n_out, n_in):
    return weight(layer, n_out, n_in * 9).reshape(n_out, n_in, 3, 3)


@query("ml_14_conv2d", f"WITH {SQL_PX}, {_conv_sql('px', 'r', 3, 0, 8)} {_PX_OUT} r")
def ml_14(spark, d):
    k = IM.kernel_frame(spark, kernel(0, 3, 1), bias(0, 3))
    return _px(IM.conv2d(IM.long_pixels(pictures(spark, d)), k, 8, 8, padding=1))


@query("ml_14_conv2d_stride", f"WITH {SQL_E}, {SQL_PX3}, {_conv_sql('px', 'r', 2, 1, 8, 2, 0)} {_PX_OUT} r")
def ml_14_stride(spark, d):
    k = IM.kernel_frame(spark, kernel(1, 2, 3), bias(1, 2))
    return _px(IM.conv2d(IM.long_pixels(color_pictures(spark, d)), k, 8, 8, stride=2, padding=0))


@query(
    "a_28_max_pool",
    f"WITH {SQL_PX}, r AS (SELECT img_id, c, (y // 3)::INT AS y, (x // 3)::INT AS x, max(v) AS v FROM px WHERE y < 6 AND x < 6 GROUP BY 1, 2, 3, 4) {_PX_OUT} r",
)
def a_28(spark, d):
    return _px(IM.max_pool(IM.long_pixels(pictures(spark, d)), 8, 8, 3))


def _pool_sql(src, name):
    return f"{name} AS (SELECT img_id, c, (y // 2)::INT AS y, (x // 2)::INT AS x, max(v) AS v FROM {src} GROUP BY 1, 2, 3, 4)"


_HIDDEN = 3
_CNN_SQL = ",\n".join(
    [
        SQL_PX,
        _conv_sql("px", "c1", _HIDDEN, 20, 8, post=RELU),
        _conv_sql("c1", "c2", _HIDDEN, 21, 8, post=RELU),
        _pool_sql("c2", "q1"),
        _conv_sql("q1", "c3", _HIDDEN, 22, 4, post=RELU),
        _conv_sql("c3", "c4", _HIDDEN, 23, 4, post=RELU),
        _pool_sql("c4", "q2"),
        "flat AS (SELECT img_id, (c * 4 + y * 2 + x) AS j, v FROM q2)",
        sql_linear("z", "flat", "img_id", 24, 10),
    ]
)


def cnn_params(spark):
    arrays, n_in = {}, 1
    for layer, name in ((20, "block_1.0"), (21, "block_1.1"), (22, "block_2.0"), (23, "block_2.1")):
        arrays[f"{name}.weight"], arrays[f"{name}.bias"] = kernel(layer, _HIDDEN, n_in), bias(layer, _HIDDEN)
        n_in = _HIDDEN
    arrays["classifier.weight"], arrays["classifier.bias"] = weight(24, 10, _HIDDEN * 4), bias(24, 10)
    return models.params_frame(spark, arrays)


@query("ml_15_predict_cnn", f"WITH {_CNN_SQL} SELECT img_id, j::INT AS k, {sql_rnd('v', 5)} AS z FROM z")
def ml_15(spark, d):
    src = spread(pictures(spark, d), "img_id")
    out = unnest(IM.predict_cnn(src, cnn_params(spark)), ["img_id"], "logits", "z", "k")
    return out.withColumn("z", rnd(F.col("z"), 5))


# --- graphs ---------------------------------------------------------------


def conversation_graphs(spark, d):
    """Conversations as graphs: turns are nodes, neighbouring turns are linked both ways."""
    src = table(spark, d, "conversations")
    size = (F.length("text") / 1000.0).alias("size")
    turns = dense_index(src.select("conv_id", "turn", "role", size), ["turn"], ["conv_id"])
    is_role = [(F.col("role") == r).cast("double") for r in ("user", "assistant", "system")]
    nodes = turns.select(
        F.col("conv_id").alias("graph_id"),
        F.col("turn").alias("node_id"),
        F.array("size", *is_role).alias("x"),
        F.array(F.col("turn").cast("double"), F.col("size"), F.lit(0.0)).alias("pos"),
    )
    after = turns.select("conv_id", (F.col("idx") - 1).alias("idx"), F.col("turn").alias("next"), F.col("role").alias("next_role"))
    links = lookup_join(turns, after, ["conv_id", "idx"], "inner")
    same = F.array((F.col("role") == F.col("next_role")).cast("double"))
    ends = F.array(
        F.struct(F.col("turn").alias("src"), F.col("next").alias("dst")),
        F.struct(F.col("next").alias("src"), F.col("turn").alias("dst")),
    )
    edges = links.select(F.col("conv_id").alias("graph_id"), same.alias("attr"), F.explode(ends).alias("e")).select("graph_id", "e.*", "attr")
    graphs = src.groupBy(F.col("conv_id").alias("graph_id")).agg(F.avg(F.length("text") / 1000.0).alias("y"))
    return graphs, nodes, edges


SQL_GRAPH = """t AS (SELECT conv_id AS g, turn AS n, length(text) / 1000.0::DOUBLE AS size, role,
  lead(turn) OVER w AS nn, lead(role) OVER w AS nr FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
ed AS (SELECT g, n AS src, nn AS dst, (role = nr)::INT::DOUBLE AS attr FROM t WHERE nn IS NOT NULL
  UNION ALL SELECT g, nn, n, (role = nr)::INT::DOUBLE FROM t WHERE nn IS NOT NULL),
dist AS (SELECT e.g, e.src, e.dst, sqrt((a.n - b.n) * (a.n - b.n) + (a.size - b.size) * (a.size - b.size)) AS dist
  FROM ed e JOIN t a ON a.g = e.g AND a.n = e.src JOIN t b ON b.g = e.g AND b.n = e.dst),
nx AS (SELECT g, n, 0 AS j, size AS v FROM t UNION ALL SELECT g, n, 1, (role = 'user')::INT FROM t
  UNION ALL SELECT g, n, 2, (role = 'assistant')::INT FROM t UNION ALL SELECT g, n, 3, (role = 'system')::INT FROM t)"""


@query(
    "src_5_graph_sizes",
    f"WITH {SQL_GRAPH} SELECT (SELECT count(DISTINCT g) FROM t) AS n_graphs, (SELECT count(*) FROM t) AS n_nodes, 4 AS n_node_features, (SELECT count(*) FROM ed) AS n_edges, 1 AS n_edge_features",
)
def src_5(spark, d):
    return GR.graph_sizes(*conversation_graphs(spark, d))


@query(
    "j_3_edge_endpoints",
    f"""WITH {SQL_GRAPH} SELECT e.g AS graph_id, e.src, e.dst, a.role AS role_j, b.role AS role_i FROM ed e
JOIN t a ON a.g = e.g AND a.n = e.src JOIN t b ON b.g = e.g AND b.n = e.dst""",
)
def j_3(spark, d):
    _, nodes, edges = conversation_graphs(spark, d)
    names = F.array(F.lit("user"), F.lit("assistant"), F.lit("system"))
    out = GR.endpoints(edges, nodes, ["x"])
    role = {m: F.get(names, C.argmax(F.slice(f"x_{m}", 2, 3))) for m in ("j", "i")}
    return out.select("graph_id", "src", "dst", role["j"].alias("role_j"), role["i"].alias("role_i"))


@query(
    "j_4_node_graph",
    f"WITH {SQL_GRAPH}, y AS (SELECT g, avg(size) AS y FROM t GROUP BY 1) SELECT g AS graph_id, n AS node_id, {sql_rnd('size - y')} AS off FROM t JOIN y USING (g)",
)
def j_4(spark, d):
    graphs, nodes, _ = conversation_graphs(spark, d)
    out = lookup_join(nodes, graphs, ["graph_id"], "inner")
    return out.select("graph_id", "node_id", rnd(F.col("x")[0] - F.col("y")).alias("off"))


@query("p_20_edge_length", f"WITH {SQL_GRAPH} SELECT g AS graph_id, src, dst, {sql_rnd('dist')} AS dist FROM dist")
def p_20(spark, d):
    _, nodes, edges = conversation_graphs(spark, d)
    return GR.with_lengths(edges, nodes).select("graph_id", "src", "dst", rnd(F.col("dist")).alias("dist"))


_SQL_MSG_IN = """{0}in AS (SELECT e.g, e.src, e.dst, x.j, x.v FROM ed e JOIN {1} x ON x.g = e.g AND x.n = e.dst
UNION ALL SELECT e.g, e.src, e.dst, 4 + x.j, x.v FROM ed e JOIN {1} x ON x.g = e.g AND x.n = e.src
UNION ALL SELECT g, src, dst, 8, attr FROM ed UNION ALL SELECT g, src, dst, 9, dist FROM dist)"""


@query(
    "p_21_concat_features",
    f"WITH {SQL_GRAPH}, {_SQL_MSG_IN.format('m', 'nx')} SELECT g AS graph_id, src, dst, j::INT AS j, {sql_rnd('v')} AS v FROM min",
)
def p_21(spark, d):
    _, nodes, edges = conversation_graphs(spark, d)
    ends = GR.endpoints(GR.with_lengths(edges, nodes), nodes, ["x"])
    joined = C.concat_vec("x_i", "x_j", "attr", F.array("dist"))
    out = ends.select("graph_id", "src", "dst", F.posexplode(joined).alias("j", "v"))
    return out.withColumn("v", rnd(F.col("v")))


@query(
    "a_25_neighbour_sum",
    f"""WITH {SQL_GRAPH}, s AS (SELECT e.g, e.dst AS n, x.j, sum(x.v) AS v FROM ed e JOIN nx x ON x.g = e.g AND x.n = e.src GROUP BY 1, 2, 3)
SELECT nx.g AS graph_id, nx.n AS node_id, nx.j::INT AS j, {sql_rnd('coalesce(s.v, 0)')} AS v FROM nx LEFT JOIN s USING (g, n, j)""",
)
def a_25(spark, d):
    _, nodes, edges = conversation_graphs(spark, d)
    out = GR.neighbour_sum(GR.endpoints(edges, nodes, ["x"]), nodes, "x_j", 4)
    return out.select("graph_id", "node_id", F.posexplode("agg").alias("j", "v")).withColumn("v", rnd(F.col("v")))


@query(
    "a_26_pool_graphs",
    f"""WITH {SQL_GRAPH}, p AS (SELECT g, j, sum(v) AS v FROM nx GROUP BY 1, 2 UNION ALL SELECT g, j + 4, max(v) FROM nx GROUP BY 1, 2)
SELECT g AS graph_id, j::INT AS j, {sql_rnd('v')} AS v FROM p""",
)
def a_26(spark, d):
    graphs, nodes, _ = conversation_graphs(spark, d)
    out = GR.pool_graphs(nodes, 4, graphs).select("graph_id", F.posexplode("emb").alias("j", "v"))
    return out.withColumn("v", rnd(F.col("v")))


@query(
    "a_27_batch_norm",
    f"""WITH {SQL_X}, st AS (SELECT i1, avg(v) AS m, var_pop(v) AS s FROM x GROUP BY 1)
SELECT i0 AS vec_id, i1::INT AS j, {sql_rnd('(v - m) / sqrt(s + 1e-5::DOUBLE) * 2 + 0.5::DOUBLE')} AS v FROM x JOIN st USING (i1)""",
)
def a_27(spark, d):
    src = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    mean, var = tensors.feature_stats(src, "e", 64)
    out = tensors.batch_norm(src, "e", "n", mean, var, [2.0] * 64, [0.5] * 64)
    return out.select("vec_id", F.posexplode("n").alias("j", "v")).withColumn("v", rnd(F.col("v")))


@query("a_29_undirected_edges", f"WITH {SQL_GRAPH} SELECT DISTINCT g AS graph_id, least(src, dst) AS a, greatest(src, dst) AS b FROM ed")
def a_29(spark, d):
    return GR.to_undirected(conversation_graphs(spark, d)[2])


def graph_arrays(n_layers=5, h=4):
    arrays = {"proj.weight": weight(0, h, 4), "proj.bias": bias(0, h)}
    for k in range(1, n_layers + 1):
        for part, at, n_in in (("msg", 0, 2 * h + 2), ("upd", 2, 2 * h)):
            base = f"conv{k}.{part}"
            arrays[f"{base}.0.weight"], arrays[f"{base}.0.bias"] = weight(10 * k + at, h, n_in), bias(10 * k + at, h)
            arrays[f"{base}.1.weight"], arrays[f"{base}.1.bias"] = weight(10 * k + at + 1, h, h), bias(10 * k + at + 1, h)
            i = np.arange(h)
            arrays[f"{base}.norm.mean"], arrays[f"{base}.norm.var"] = 0.1 * (i % 3), 1 + 0.5 * (i % 2)
            arrays[f"{base}.norm.gamma"], arrays[f"{base}.norm.beta"] = np.ones(h), 0.05 * i
    for k, (n_in, n_out) in enumerate(((2 * h, 4), (4, 2), (2, 1))):
        arrays[f"head.{k}.weight"], arrays[f"head.{k}.bias"] = weight(90 + k, n_out, n_in), bias(90 + k, n_out)
    return arrays


_NORM = "greatest(({z} - 0.1::DOUBLE * (j % 3)) / sqrt(1 + 0.5::DOUBLE * (j % 2) + 1e-5::DOUBLE) + 0.05::DOUBLE * j, 0.0::DOUBLE)"


def _layer_sql(src, out, k, post="{z}"):
    """One message-passing layer over node relation (g, n, j, v)."""
    p = f"l{k}"
    return ",\n".join(
        [
            _SQL_MSG_IN.format(p, src),
            sql_linear(f"{p}m0", f"{p}in", "g, src, dst", 10 * k, 4, _NORM),
            sql_linear(f"{p}m1", f"{p}m0", "g, src, dst", 10 * k + 1, 4),
            f"{p}a AS (SELECT g, dst AS n, j, sum(v) AS v FROM {p}m1 GROUP BY 1, 2, 3)",
            f"{p}u AS (SELECT g, n, j, v FROM {src} UNION ALL SELECT x.g, x.n, 4 + x.j, coalesce(a.v, 0) FROM {src} x LEFT JOIN {p}a a USING (g, n, j))",
            sql_linear(f"{p}u0", f"{p}u", "g, n", 10 * k + 2, 4, _NORM),
            sql_linear(out, f"{p}u0", "g, n", 10 * k + 3, 4, post),
        ]
    )


@query("ml_16_message_layer", f"WITH {SQL_GRAPH}, {_layer_sql('nx', 'h1', 1)} SELECT g AS graph_id, n AS node_id, j::INT AS j, {sql_rnd('v')} AS v FROM h1")
def ml_16(spark, d):
    _, nodes, edges = conversation_graphs(spark, d)
    out = GR.mp_layer(nodes, GR.with_lengths(edges, nodes), graph_arrays(1), "conv1")
    return unnest(out, ["graph_id", "node_id"], "x", "v", "j").withColumn("v", rnd(F.col("v")))


_SQL_MODEL = ",\n".join(
    [SQL_GRAPH, sql_linear("h0", "nx", "g, n", 0, 4, RELU)]
    + [_layer_sql(f"h{k - 1}", f"h{k}", k, RELU) for k in range(1, 6)]
    + [
        "emb AS (SELECT g, j, sum(v) AS v FROM h5 GROUP BY 1, 2 UNION ALL SELECT g, j + 4, max(v) FROM h5 GROUP BY 1, 2)",
        sql_mlp("z", "emb", "g", [8, 4, 2, 1], first=90),
    ]
)


@query("ml_17_predict_graph", f"WITH {_SQL_MODEL} SELECT g AS graph_id, {sql_rnd('v', 5)} AS pred FROM z")
def ml_17(spark, d):
    params = models.params_frame(spark, graph_arrays())
    out = GR.predict_graph(*conversation_graphs(spark, d), params)
    return out.select("graph_id", rnd(F.col("pred"), 5).alias("pred"))


_SQL_HEAD = f"""{SQL_GRAPH}, emb AS (SELECT g, j, sum(v) AS v FROM nx GROUP BY 1, 2 UNION ALL SELECT g, j + 4, max(v) FROM nx GROUP BY 1, 2),
gy AS (SELECT g, avg(size) AS y, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM t GROUP BY g),
st AS (SELECT avg(y) AS mu, stddev_samp(y) AS sd FROM gy WHERE pos < floor(0.8 * n)),
dy AS (SELECT g AS r, (y - mu) / sd AS y FROM gy, st WHERE pos < floor(0.8 * n)),
ty AS (SELECT g AS r, (y - mu) / sd AS y FROM gy, st WHERE pos >= floor(0.8 * n)),
dx AS (SELECT g AS r, j, v FROM emb), tx AS (SELECT * FROM dx)"""
_SQL_R2 = f"""SELECT {sql_rnd('1 - sum((y - p) * (y - p)) / nullif(sum((y - m) * (y - m)), 0)')} AS r2, count(*) AS n_graphs
FROM (SELECT gy.y, zt.v * sd + mu AS p, avg(gy.y) OVER () AS m FROM zt JOIN gy ON gy.g = zt.r, st)"""


@query("ml_18_fit_graph_head", sql_fit(_SQL_HEAD, [8, 4, 2, 1], "l1", 0.01, 3, adam=True, test=True))
def ml_18(spark, d):
    graphs, nodes, edges = conversation_graphs(spark, d)
    fit, _ = GR.fit_graph_head(GR.pool_graphs(nodes, 4, graphs), graphs, [4, 2], lr=0.01, epochs=3, init=_start([8, 4, 2, 1]))
    return _history(fit, *_LOSS, "test_loss", "test_acc")


@query("ml_18_graph_head_r2", sql_fit(_SQL_HEAD, [8, 4, 2, 1], "l1", 0.01, 3, adam=True, test=True, final=_SQL_R2))
def ml_18_r2(spark, d):
    """R2 of the trained head on the original scale."""
    graphs, nodes, edges = conversation_graphs(spark, d)
    _, preds = GR.fit_graph_head(GR.pool_graphs(nodes, 4, graphs), graphs, [4, 2], lr=0.01, epochs=3, init=_start([8, 4, 2, 1]))
    return preds.agg(rnd(C.r2_score("pred", "y")).alias("r2"), F.count(F.lit(1)).alias("n_graphs"))


@query(
    "ml_18_graph_head_options",
    sql_fit(
        _SQL_HEAD, [8, 8, 4, 1], "l1", 0.01, 4, adam=True, test=True, dropout=[0.2, 0.0], seed=42, plateau=training.Plateau(), also=("lr",),
        extra=[f"SELECT -1, 'test_r2', r2 FROM ({_SQL_R2})"],
    ),
)
def ml_18_options(spark, d):
    """The head with dropout after its first layer and the plateau rule."""
    graphs, nodes, edges = conversation_graphs(spark, d)
    fit, preds = GR.fit_graph_head(
        GR.pool_graphs(nodes, 4, graphs), graphs, [8, 4], lr=0.01, epochs=4, dropout=[0.2, 0.0], seed=42, plateau=training.Plateau(), init=_start([8, 8, 4, 1])
    )
    r2 = preds.agg(rnd(C.r2_score("pred", "y")).alias("value")).select(F.lit(-1).alias("epoch"), F.lit("test_r2").alias("metric"), "value")
    return _history(fit, *_LOSS, "lr", "test_loss", "test_acc").unionByName(r2)


# --- sources and sinks ----------------------------------------------------


@query(
    "src_2_class_ids",
    "WITH c AS (SELECT source, (row_number() OVER (ORDER BY source) - 1)::INT AS label FROM (SELECT DISTINCT source FROM documents)) SELECT doc_id, source, label FROM documents JOIN c USING (source)",
)
def src_2(spark, d):
    return tensors.with_class_ids(table(spark, d, "documents").select("doc_id", "source"), "source")


_PICTURE = "list_transform(embedding[1:48], lambda x: floor(least(255.0::DOUBLE, greatest(0.0::DOUBLE, (x::DOUBLE + 0.5) * 255)))::BIGINT)"


@query(
    "src_3_decode",
    f"""WITH p AS (SELECT vec_id, 'class_' || label AS class_name, {_PICTURE} AS d FROM embeddings),
c AS (SELECT class_name, (row_number() OVER (ORDER BY class_name) - 1)::INT AS label FROM (SELECT DISTINCT class_name FROM p))
SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN 'test' ELSE 'train' END AS split, class_name, label, 4 AS height, 4 AS width, 3 AS channels,
  list_sum(d)::BIGINT AS total, list_sum(list_transform(range(1, 49), lambda i: i * d[i]))::BIGINT AS weighted FROM p JOIN c USING (class_name)""",
)
def src_3(spark, d):
    """Vectors written as a folder of pictures, which is read and decoded again."""
    where = f"{shared_dir(spark)}/pictures-{uuid.uuid4().hex}"
    byte = F.transform(F.slice("embedding", 1, 48), lambda x: F.floor(F.least(F.lit(255.0), F.greatest(F.lit(0.0), (x.cast("double") + 0.5) * 255))).cast("int"))
    src = table(spark, d, "embeddings").select(
        F.concat_ws("/", F.when(F.col("vec_id") % 5 == 0, "test").otherwise("train"), F.concat(F.lit("class_"), "label"), F.concat("vec_id", F.lit(".png"))).alias("name"),
        byte.alias("data"),
        *[F.lit(n).alias(c) for n, c in ((4, "height"), (4, "width"), (3, "channels"))],
    )
    files.write_files(IM.encode_png(src), where)
    read = readers.decode_rgb(readers.read_image_folder(spark, where))
    cells = F.zip_with("data", F.sequence(F.lit(1), F.size("data")), lambda v, i: v * i)
    total = [F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x) for c in (F.col("data"), cells)]
    return read.select(
        F.regexp_extract("path", r"([0-9]+)\.png$", 1).cast("long").alias("vec_id"),
        *("split", "class_name", "label", "height", "width", "channels"),
        total[0].alias("total"),
        total[1].alias("weighted"),
    )


@query(
    "src_4_labelled_split",
    "SELECT label, count(*) AS n, min(vec_id) AS first_id FROM embeddings WHERE vec_id % 5 = 0 GROUP BY 1",
)
def src_4(spark, d):
    """The table written by split and one split read back."""
    where = f"{shared_dir(spark)}/labelled-{uuid.uuid4().hex}"
    src = table(spark, d, "embeddings").withColumn("split", F.when(F.col("vec_id") % 5 == 0, "test").otherwise("train"))
    writers.save_split(src, where)
    test = readers.read_labelled_vectors(spark, where, "test")
    return test.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id"))


@query(
    "src_7_directory_inventory",
    """WITH p AS (SELECT string_split(regexp_replace(url, '^[a-z]+://|[?#].*$', '', 'g'), '/') AS s FROM pages),
w AS (SELECT s, unnest(range(0, len(s))) AS k FROM p),
st AS (SELECT array_to_string(s[1:k], '/') AS dir, CASE WHEN k < len(s) - 1 THEN s[k + 1] END AS child, k = len(s) - 1 AS own FROM w)
SELECT dir, count(DISTINCT child) AS n_dirs, sum(own::INT)::BIGINT AS n_files FROM st GROUP BY 1""",
)
def src_7(spark, d):
    """The pages' addresses as file paths."""
    path = F.regexp_replace("url", "^[a-z]+://|[?#].*$", "")
    return readers.directory_inventory(table(spark, d, "pages").select(path.alias("path")))


@query(
    "src_15_16_save_load_params",
    f"WITH {_SQL_CLASS_NAMES} SELECT name, count(*)::INT AS n_values, 64 AS n0, {sql_rnd('sum(v)')} AS total FROM n GROUP BY 1",
)
def src_15_16(spark, d):
    params, where = class_params(spark, d), f"{shared_dir(spark)}/params-{uuid.uuid4().hex}"
    writers.save_params(params, where)
    return _param_summary(readers.load_params(spark, where, expected=params))


@query(
    "src_17_write_text",
    "SELECT lang, sum(len(string_split(text, chr(10))))::BIGINT AS n_lines, (sum(length(text)) - sum(len(string_split(text, chr(10))) - 1))::BIGINT AS n_chars FROM documents GROUP BY 1",
)
def src_17(spark, d):
    """The corpus written as text files, one folder per language, and read back by line."""
    where = f"{shared_dir(spark)}/text-{uuid.uuid4().hex}"
    writers.write_text(table(spark, d, "documents"), where, by=["lang"])
    lines = spark.read.schema("value string, lang string").text(where)
    return lines.groupBy("lang").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_chars"))


# --- streams --------------------------------------------------------------


@query("st_1_encode_stream", f"WITH {SQL_PART_VOCAB} " + _ID_DIGEST.format("ids"))
def st_1(spark, d):
    """Documents arriving as files give the rows of the batch job."""
    where = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    docs = streams.table_stream(spark, d, "documents.parquet")
    streams.encode_available(docs, part_vocab(spark, d), where, where + "-state")
    return _id_digest(spark.read.schema("doc_id long, ids array<long>").parquet(where))


@query(
    "st_2_windowed_metrics",
    f"""WITH e AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS start, abs(value - 50) AS loss, (value > 50) = (event_type = 'purchase') AS hit, ts FROM events)
SELECT start, count(*) AS n_rows, {sql_rnd('avg(loss)')} AS loss, {sql_rnd('100 * avg(hit::INT)')} AS acc FROM e
WHERE start + INTERVAL '1 hour' <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes' GROUP BY 1""",
)
def st_2(spark, d):
    """Hourly loss and accuracy; the hours the watermark has not passed stay open."""
    where = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    events = streams.table_stream(spark, d, "events.parquet")
    scored = events.select(
        "ts", F.abs(F.col("value") - 50).alias("loss"), ((F.col("value") > 50) == (F.col("event_type") == "purchase")).cast("int").alias("hit")
    )
    out = streams.windowed_metrics(scored, {"loss": F.avg("loss"), "acc": F.avg("hit") * 100})
    streams.run_available(out, where, where + "-state")
    done = spark.read.parquet(where)
    return done.select(F.col("start").cast("timestamp_ntz").alias("start"), "n_rows", rnd(F.col("loss")).alias("loss"), rnd(F.col("acc")).alias("acc"))


@query(
    "st_2_running_metrics",
    f"""WITH e AS (SELECT (event_id // 1250)::BIGINT AS epoch, (event_id % 1250) // 25 AS batch_id, abs(value - 50) AS loss, ((value > 50) = (event_type = 'purchase'))::INT AS hit FROM events),
b AS (SELECT epoch, batch_id, count(*) AS n_rows, avg(loss) AS loss, avg(hit) AS hit FROM e GROUP BY 1, 2 HAVING count(*) = 25)
SELECT epoch, batch_id::BIGINT AS batch_id, n_rows, {sql_rnd('loss', 9)} AS loss, {sql_rnd('avg(loss) OVER w', 9)} AS running_loss, {sql_rnd('avg(hit) OVER w', 9)} AS running_hit
FROM b WINDOW w AS (PARTITION BY epoch ORDER BY batch_id ROWS UNBOUNDED PRECEDING)""",
)
def st_2_running(spark, d):
    """Loss and accuracy up to the current batch while events arrive; the unfinished last batch stays open.

    With 25 rows a batch and 50 batches an epoch no mean lies half way between two numbers of nine places.
    """
    where = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    streams.use_state_store(spark)
    events = streams.table_stream(spark, d, "events.parquet")
    scored = events.select(
        "ts", F.floor(F.col("event_id") / 1250).alias("epoch"), F.floor(F.col("event_id") % 1250 / 25).alias("batch_id"),
        F.abs(F.col("value") - 50).alias("loss"), ((F.col("value") > 50) == (F.col("event_type") == "purchase")).cast("int").alias("hit"),
    )
    streams.run_available(streams.running_metrics(scored, ["loss", "hit"], 25), where, where + "-state")
    done = spark.read.parquet(where)
    return done.select("epoch", "batch_id", "n_rows", *[rnd(F.col(c), 9).alias(c) for c in ("loss", "running_loss", "running_hit")])
