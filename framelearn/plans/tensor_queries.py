"""Registered queries: tensor algebra, generators, typed frames, vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from framelearn.functions import columns as C
from framelearn.operators import tensors as T
from framelearn.operators import text, vector_lists, vectors
from framelearn.plans.registry import query, rnd, sql_rnd, table
from framelearn.plans.scale import spread, unnest
from framelearn.plans.text_queries import SQL_LONG
from framelearn.sources import generators as G
from framelearn.sources import readers

SQL_X = "x AS (SELECT vec_id AS i0, unnest(range(64))::BIGINT AS i1, unnest(embedding)::DOUBLE AS v FROM embeddings)"


def matrix(spark, d):
    return T.from_arrays(table(spark, d, "embeddings"), "vec_id", "embedding")


def column_means(spark, d):
    """A vector ``(i0, v)``: the mean of each column of the matrix."""
    return matrix(spark, d).groupBy(F.col("i1").alias("i0")).agg(F.avg("v").alias("v"))


SQL_W = "w AS (SELECT i1 AS i0, avg(v) AS v FROM x GROUP BY 1)"


def rounded(df, places=6):
    return df.select(*[c for c in df.columns if c != "v"], rnd(F.col("v"), places).alias("v"))


# --- element arithmetic ---------------------------------------------------


@query(
    "p_3_scalar_arithmetic",
    f"WITH {SQL_X} SELECT i0, i1, v + 10 AS added, v - 10 AS subtracted, v * 10 AS multiplied, v / 10 AS divided FROM x",
)
def p_3(spark, d):
    x = matrix(spark, d)
    names = {"add": "added", "sub": "subtracted", "mul": "multiplied", "div": "divided"}
    for op, name in names.items():
        x = T.with_scalar(x, op, 10.0, out=name)
    return x.drop("v")


@query("p_4_broadcast_multiply", f"WITH {SQL_X}, {SQL_W} SELECT x.i0, x.i1, {sql_rnd('x.v * w.v', 9)} AS v FROM x JOIN w ON x.i1 = w.i0")
def p_4(spark, d):
    return rounded(T.elementwise(matrix(spark, d), column_means(spark, d), "mul"), 9)


@query("p_6_set_cell", f"WITH {SQL_X} SELECT i0, i1, CASE WHEN i0 = 7 AND i1 = 3 THEN 100.0::DOUBLE ELSE v END AS v FROM x")
def p_6(spark, d):
    return T.set_cell(matrix(spark, d), (7, 3), 100.0)


@query("p_6_get_cell", f"WITH {SQL_X} SELECT v FROM x WHERE i0 = 7 AND i1 = 3")
def p_6_get(spark, d):
    return T.get_cell(matrix(spark, d), (7, 3))


@query(
    "p_2_cast",
    "SELECT l_orderkey, l_linenumber, l_quantity::INT AS qty, l_extendedprice::FLOAT::DOUBLE AS price, l_linenumber::DOUBLE AS line FROM lineitem",
)
def p_2(spark, d):
    return T.frame_from(
        table(spark, d, "lineitem"),
        [("l_orderkey", "long", "l_orderkey"), ("l_linenumber", "int", "l_linenumber"), ("l_quantity", "int", "qty"),
         ("l_extendedprice", "float", "price"), ("l_linenumber", "double", "line")],
    ).withColumn("price", F.col("price").cast("double"))


@query("src_9_typed_frame", "SELECT o_orderkey AS row_id, o_totalprice AS x1, o_custkey::DOUBLE AS x2, (o_orderstatus = 'F')::INT AS label FROM orders")
def src_9(spark, d):
    rows = table(spark, d, "orders").withColumn("done", F.col("o_orderstatus") == "F")
    return T.frame_from(
        rows, [("o_orderkey", "long", "row_id"), ("o_totalprice", "double", "x1"), ("o_custkey", "double", "x2"), ("done", "int", "label")]
    )


# --- shapes ---------------------------------------------------------------


@query("tn_1_rank_and_shape", "SELECT 2 AS rank, max(vec_id) + 1 AS n0, 64::BIGINT AS n1 FROM embeddings")
def tn_1(spark, d):
    return T.rank_and_shape(matrix(spark, d))


@query("tn_2_reshape", f"WITH {SQL_X}, f AS (SELECT i0 * 64 + i1 AS f, v FROM x) SELECT f // 256 AS i0, f // 16 % 16 AS i1, f % 16 AS i2, v FROM f")
def tn_2(spark, d):
    x = matrix(spark, d)
    # four rows fill a slab; the last slab has no cells for rows that are not there
    slabs = -(-T.shape_of(x)[0] // 4)
    return T.reshape(x, (-1, 16, 16), old=(4 * slabs, 64))


@query("tn_3_stack", f"WITH {SQL_X}, s AS (SELECT 0::BIGINT AS i0, i0 AS i1, i1 AS i2, v FROM x UNION ALL SELECT 1, i0, i1, v * 2 FROM x) SELECT * FROM s")
def tn_3(spark, d):
    x = matrix(spark, d)
    return T.stack([x, T.with_scalar(x, "mul", 2.0)])


@query("tn_4_concat", f"WITH {SQL_X} SELECT i0, i1, v FROM x UNION ALL SELECT i0 + (SELECT max(i0) + 1 FROM x), i1, v + 1 FROM x")
def tn_4(spark, d):
    x = matrix(spark, d)
    return T.concat([x, T.with_scalar(x, "add", 1.0)], dim=0)


@query("tn_5_squeeze_unsqueeze", f"WITH {SQL_X} SELECT 0::BIGINT AS i0, i0 AS i1, 0::BIGINT AS i2, i1 AS i3, v FROM x")
def tn_5(spark, d):
    x = matrix(spark, d)
    back = T.squeeze(T.unsqueeze(T.unsqueeze(x, 0), 3))
    return T.unsqueeze(T.unsqueeze(back, 1), 0)


@query("tn_6_permute", f"WITH {SQL_X} SELECT f // 8 AS i0, i0 AS i1, f % 8 AS i2, v FROM (SELECT i0, i1 AS f, v FROM x)")
def tn_6(spark, d):
    cube = T.reshape(matrix(spark, d), (-1, 8, 8))
    return T.permute(cube, (1, 0, 2))


@query("tn_6_transpose", f"WITH {SQL_X} SELECT i1 AS i0, i0 AS i1, v FROM x")
def tn_6_t(spark, d):
    return T.transpose(matrix(spark, d))


@query("tn_7_item", f"WITH {SQL_X} SELECT {sql_rnd('sum(v)')} AS v FROM x")
def tn_7(spark, d):
    return rounded(T.item(matrix(spark, d).agg(F.sum("v").alias("v"))))


@query(
    "j_6_matmul",
    f"WITH {SQL_X} SELECT a.i1 AS i0, b.i1 AS i1, {sql_rnd('sum(a.v * b.v)')} AS v FROM x a JOIN x b ON a.i0 = b.i0 GROUP BY 1, 2",
)
def j_6(spark, d):
    x = matrix(spark, d)
    return rounded(T.matmul(T.transpose(x), x))


@query(
    "j_6_rows_times_matrix",
    f"""WITH {SQL_X}, m AS (SELECT label AS j, i1 AS k, avg(v) AS w FROM x JOIN embeddings ON vec_id = i0 GROUP BY 1, 2)
SELECT x.i0 AS vec_id, m.j AS label, {sql_rnd('sum(x.v * m.w)')} AS score FROM x JOIN m ON x.i1 = m.k GROUP BY 1, 2""",
)
def j_6_rows(spark, d):
    """Every vector times the matrix of class means."""
    src = table(spark, d, "embeddings")
    long = src.select("label", F.posexplode("embedding").alias("k", "v"))
    means = long.groupBy(F.col("k").alias("i0"), F.col("label").alias("i1")).agg(F.avg("v").alias("v"))
    out = T.rows_times_matrix(src.select("vec_id", "embedding"), "embedding", means, "scores")
    return unnest(out, ["vec_id"], "scores", "score", "label").withColumn("score", rnd(F.col("score")))


@query(
    "j_5_rows_by_parameters",
    f"""WITH {SQL_X}, p AS (SELECT label, avg(v) AS w FROM x JOIN embeddings ON vec_id = i0 GROUP BY 1)
SELECT i0, i1, label, {sql_rnd('v * w', 9)} AS v FROM x, p""",
)
def j_5(spark, d):
    long = table(spark, d, "embeddings").select("label", F.explode("embedding").alias("v"))
    params = long.groupBy("label").agg(F.avg("v").alias("w"))
    out = T.for_each(matrix(spark, d), params, "p")
    return rounded(out.select("i0", "i1", "p.label", (F.col("v") * F.col("p.w")).alias("v")), 9)


# --- generators over a table's keys ---------------------------------------


@query("src_10_line_data", "SELECT o_orderkey AS row_id, o_orderkey * 0.02::DOUBLE AS x, 0.7::DOUBLE * (o_orderkey * 0.02::DOUBLE) + 0.3::DOUBLE AS y FROM orders")
def src_10(spark, d):
    return G.line_data(table(spark, d, "orders").select(F.col("o_orderkey").alias("row_id")), 0.0, 0.02, 0.7, 0.3)


@query("src_11_zeros_ones_like", f"WITH {SQL_X} SELECT i0, i1, 0.0::DOUBLE AS zero, 1.0::DOUBLE AS one FROM x")
def src_11(spark, d):
    x = matrix(spark, d)
    return T.full_like(x, 0.0).withColumnRenamed("v", "zero").withColumn("one", F.lit(1.0))


def sql_uniform(key, seed, stream):
    return f"(('0x'||substr(md5({key}||':{seed}:{stream}'),1,15))::BIGINT / {float(2**60)!r}::DOUBLE)"


def sql_gauss(key, seed, stream=0):
    return (
        f"(sqrt(-2.0 * ln(1.0 - {sql_uniform(key, seed, 2 * stream)})) * "
        f"cos(2.0 * pi() * {sql_uniform(key, seed, 2 * stream + 1)}))"
    )


_CELL = "i0||':'||i1"


@query(
    "src_11_random_like",
    f"WITH {SQL_X} SELECT i0, i1, {sql_rnd(sql_uniform(_CELL, 42, 0))} AS uniform, {sql_rnd(sql_gauss(_CELL, 42))} AS normal, "
    f"floor(10 * {sql_uniform(_CELL, 42, 0)})::BIGINT AS whole FROM x",
)
def src_11_random(spark, d):
    x = matrix(spark, d)
    u = G.random_like(x, "uniform", 42).withColumnRenamed("v", "uniform")
    n = G.random_value(["i0", "i1"], "normal", 42)
    w = G.random_value(["i0", "i1"], "int", 42, low=0, high=10)
    return u.select("i0", "i1", rnd(F.col("uniform")).alias("uniform"), rnd(n).alias("normal"), w.alias("whole"))


_CIRCLE = """c AS (SELECT c_custkey AS row_id, count(*) OVER () AS n, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer),
h AS (SELECT *, n // 2 AS outer_n, n - n // 2 AS inner_n, i >= n // 2 AS inside FROM c),
a AS (SELECT row_id, inside::INT AS label, CASE WHEN inside THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END AS r,
  2 * pi() * CASE WHEN inside THEN (i - outer_n) / inner_n::DOUBLE ELSE i / outer_n::DOUBLE END AS t FROM h)"""


def _circles_sql(noise):
    x1, x2 = "r * cos(t)", "r * sin(t)"
    if noise:
        x1 += f" + {noise}::DOUBLE * {sql_gauss('row_id', 42, 0)}"
        x2 += f" + {noise}::DOUBLE * {sql_gauss('row_id', 42, 1)}"
    return f"WITH {_CIRCLE} SELECT row_id, {sql_rnd(x1)} AS x1, {sql_rnd(x2)} AS x2, label FROM a"


def circles(spark, d, noise):
    ids = table(spark, d, "customer").select(F.col("c_custkey").alias("row_id"))
    return G.circles(ids, noise=noise, seed=42)


def _points(df):
    return df.select("row_id", rnd(F.col("x1")).alias("x1"), rnd(F.col("x2")).alias("x2"), "label")


@query("src_12_circles", _circles_sql(0))
def src_12(spark, d):
    return _points(circles(spark, d, 0.0))


@query("src_12_circles_noise", _circles_sql(0.03))
def src_12_noise(spark, d):
    return _points(circles(spark, d, 0.03))


@query(
    "src_13_blobs",
    f"""WITH c AS (SELECT c_custkey AS row_id, (row_number() OVER (ORDER BY c_custkey) - 1) % 4 AS k FROM customer)
SELECT row_id, {sql_rnd(f"-10 + 20 * {sql_uniform('k', 42, 101)} + 1.5::DOUBLE * {sql_gauss('row_id', 42, 0)}")} AS x1,
{sql_rnd(f"-10 + 20 * {sql_uniform('k', 42, 102)} + 1.5::DOUBLE * {sql_gauss('row_id', 42, 1)}")} AS x2, k::INT AS label FROM c""",
)
def src_13(spark, d):
    ids = table(spark, d, "customer").select(F.col("c_custkey").alias("row_id"))
    return _points(G.blobs(ids, centers=4, std=1.5, seed=42))


SQL_GRID = """box AS (SELECT min(l_quantity) - 0.1::DOUBLE AS x0, max(l_quantity) + 0.1::DOUBLE AS x1,
  min(l_discount) - 0.1::DOUBLE AS y0, max(l_discount) + 0.1::DOUBLE AS y1 FROM lineitem),
grid AS (SELECT g AS row_id, CASE WHEN g % 101 = 100 THEN x1 ELSE x0 + (g % 101) * ((x1 - x0) / 100.0::DOUBLE) END AS x,
  CASE WHEN g // 101 = 100 THEN y1 ELSE y0 + (g // 101) * ((y1 - y0) / 100.0::DOUBLE) END AS y FROM box, (SELECT unnest(range(10201)) AS g))"""


@query("src_14_grid", f"WITH {SQL_GRID} SELECT row_id, {sql_rnd('x', 9)} AS x, {sql_rnd('y', 9)} AS y FROM grid")
def src_14(spark, d):
    out = G.grid(table(spark, d, "lineitem"), "l_quantity", "l_discount")
    return out.select("row_id", rnd(F.col("x"), 9).alias("x"), rnd(F.col("y"), 9).alias("y"))


# --- vectors --------------------------------------------------------------


def word_vectors(spark, d):
    return readers.read_vectors(spark, f"{d}/embeddings.parquet", "vec_id", "embedding")


_NORM = "sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)))"


@query("src_6_vectors", f"SELECT vec_id AS key, 64 AS dim, {sql_rnd(_NORM)} AS norm FROM embeddings")
def src_6(spark, d):
    return word_vectors(spark, d).select("key", F.size("vector").alias("dim"), rnd(C.norm("vector")).alias("norm"))


@query(
    "j_8_vector_lookup",
    "SELECT p.pos, vec_id AS key, unnest(range(64))::INT AS i, unnest(embedding)::DOUBLE AS v FROM embeddings JOIN (VALUES (0,2),(1,3),(2,5),(3,1),(4,3)) p(pos, k) ON k = vec_id",
)
def j_8(spark, d):
    out = vectors.lookup(word_vectors(spark, d), [2, 3, 5, 1, 3])
    return out.select("pos", "key", F.posexplode("vector").alias("i", "v")).withColumn("v", F.col("v").cast("double"))


@query("vec_1_vector_of_key", "SELECT vec_id AS key, unnest(range(64))::INT AS i, unnest(embedding)::DOUBLE AS v FROM embeddings WHERE vec_id = 17")
def vec_1(spark, d):
    out = vectors.lookup(word_vectors(spark, d), [17])
    return out.select("key", F.posexplode("vector").alias("i", "v")).withColumn("v", F.col("v").cast("double"))


_DOT = "list_sum(list_transform(range(1, 65), lambda i: a.embedding[i]::DOUBLE * b.embedding[i]::DOUBLE))"
_COS = f"({_DOT} / nullif(sqrt(list_sum(list_transform(a.embedding, lambda x: x::DOUBLE*x::DOUBLE))) * sqrt(list_sum(list_transform(b.embedding, lambda x: x::DOUBLE*x::DOUBLE))), 0))"
_PAIRS = "FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"


def _neighbours(spark, d):
    keys = word_vectors(spark, d).select(F.col("key").alias("a"), (F.col("key") + 1).alias("b"))
    return vectors.similarity(word_vectors(spark, d), keys)


@query("vec_2_cosine", f"SELECT a.vec_id AS a, b.vec_id AS b, {sql_rnd(_COS)} AS similarity {_PAIRS}")
def vec_2(spark, d):
    return _neighbours(spark, d).select("a", "b", rnd(F.col("similarity")).alias("similarity"))


@query("vec_3_distance", f"SELECT a.vec_id AS a, b.vec_id AS b, {sql_rnd(f'1 - {_COS}')} AS distance {_PAIRS}")
def vec_3(spark, d):
    return _neighbours(spark, d).select("a", "b", rnd(F.col("distance")).alias("distance"))


_MEAN = f"""{SQL_X}, nrm AS (SELECT i0, sqrt(sum(v * v)) AS n FROM x GROUP BY 1),
u AS (SELECT x.i0, x.i1, v / n AS v FROM x JOIN nrm USING (i0) WHERE n > 0),
q AS (SELECT i1, avg(CASE WHEN i0 = 42 THEN -v ELSE v END) AS v FROM u WHERE i0 IN (3, 17, 42) GROUP BY 1),
qn AS (SELECT sqrt(sum(v * v)) AS n FROM q)"""


@query(
    "vec_4_most_similar",
    f"""WITH {_MEAN} SELECT u.i0 AS key, {sql_rnd('sum(u.v * q.v) / any_value(qn.n)')} AS similarity FROM u JOIN q USING (i1), qn
WHERE u.i0 NOT IN (3, 17, 42) GROUP BY 1 ORDER BY sum(u.v * q.v) DESC, 1 LIMIT 5""",
)
def vec_4(spark, d):
    out = vectors.most_similar(word_vectors(spark, d), positive=[3, 17], negative=[42], n=5)
    return out.select("key", rnd(F.col("similarity")).alias("similarity"))


_SQL_KNN = f"""WITH {SQL_X}, nrm AS (SELECT i0, sqrt(sum(v * v)) AS n FROM x GROUP BY 1),
u AS (SELECT x.i0, x.i1, v / n AS v FROM x JOIN nrm USING (i0) WHERE n > 0),
s AS (SELECT a.i0 AS query, b.i0 AS key, sum(a.v * b.v) AS similarity FROM u a JOIN u b ON a.i1 = b.i1 AND a.i0 <> b.i0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, key) AS rank FROM s)
SELECT query, key, {sql_rnd('similarity')} AS similarity, rank FROM r WHERE rank <= 5"""


def _knn(spark, d, **kw):
    src = spread(word_vectors(spark, d), "key")
    out = vectors.knn_join(src, src, 5, **kw)
    return out.select("query", "key", rnd(F.col("similarity")).alias("similarity"), F.col("rank").cast("long").alias("rank"))


@query("vec_5_knn_join", _SQL_KNN)
def vec_5(spark, d):
    return _knn(spark, d)


@query("vec_5_knn_join_blocks", _SQL_KNN)
def vec_5_blocks(spark, d):
    """The path for queries beyond a broadcast: blocks of both sides."""
    return _knn(spark, d, max_rows=0, block_rows=512)


@query(
    "vec_5_knn_cells",
    f"""WITH {SQL_X}, nrm AS (SELECT i0, sqrt(sum(v * v)) AS n FROM x GROUP BY 1),
u AS (SELECT x.i0, x.i1, v / n AS v FROM x JOIN nrm USING (i0) WHERE n > 0),
c AS (SELECT i0, row_number() OVER (ORDER BY ('0x'||substr(md5(i0||':3:0'), 1, 15))::BIGINT, i0) - 1 AS c FROM (SELECT DISTINCT i0 FROM u)),
near AS (SELECT u.i0, c.c, row_number() OVER (PARTITION BY u.i0 ORDER BY sum(u.v * w.v) DESC, c.c) AS place FROM c JOIN u w USING (i0) JOIN u ON u.i1 = w.i1 WHERE c.c < 16 GROUP BY 1, 2),
ways AS (SELECT a.i0 AS query, b.i0 AS key FROM near a JOIN near b USING (c) WHERE a.place <= 12 AND b.place = 1 AND a.i0 <> b.i0),
s AS (SELECT query, key, sum(a.v * b.v) AS similarity FROM ways JOIN u a ON a.i0 = query JOIN u b ON b.i0 = key AND b.i1 = a.i1 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, key) AS rank FROM s)
SELECT query, key, {sql_rnd('similarity')} AS similarity, rank FROM r WHERE rank <= 5""",
)
def vec_5_cells(spark, d):
    """Nearest neighbours among the vectors of the nearest cells."""
    src = spread(word_vectors(spark, d), "key")
    out = vectors.knn_cells(src, src, 5, cells=16, probes=12, seed=3)
    return out.select("query", "key", rnd(F.col("similarity")).alias("similarity"), F.col("rank").cast("long").alias("rank"))


@query("vec_5_knn_lists", _SQL_KNN)
def vec_5_lists(spark, d):
    """Nearest neighbours by codes, the 125 best reranked: on the given vectors no neighbour is lost."""
    src = spread(word_vectors(spark, d), "key")
    out = vector_lists.knn_lists(src, src, 5, cells=16, probes=16, rerank=125, seed=3)
    return out.select("query", "key", rnd(F.col("similarity")).alias("similarity"), F.col("rank").cast("long").alias("rank"))


@query(
    "vec_6_word_vectors",
    f"""WITH {SQL_LONG},
once AS (SELECT a.token AS a, b.token AS b, count(*) AS n FROM long a JOIN long b ON a.doc_id = b.doc_id AND b.pos - a.pos BETWEEN 1 AND 2 GROUP BY 1, 2),
pairs AS (SELECT token, context, sum(n) AS n FROM (SELECT a AS token, b AS context, n FROM once UNION ALL SELECT b, a, n FROM once) GROUP BY 1, 2),
sums AS (SELECT token, sum(n) AS s FROM pairs GROUP BY 1),
info AS (SELECT p.token, greatest(ln(p.n * (SELECT sum(s) FROM sums)::DOUBLE / (a.s::DOUBLE * b.s::DOUBLE)), 0) AS i,
  ('0x'||substr(md5(p.context||':7:0'), 1, 15))::BIGINT AS h FROM pairs p JOIN sums a ON p.token = a.token JOIN sums b ON p.context = b.token),
cells AS (SELECT token, k, sum(i * (2 * ((h >> k) & 1) - 1)) AS v FROM info, (SELECT unnest(range(8)) AS k) GROUP BY 1, 2)
SELECT token AS key, k::INT AS dim, {sql_rnd("v", 3)} AS value FROM cells""",
)
def vec_6(spark, d):
    docs = spread(table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    out = vectors.word_vectors(text.tokenize(docs), size=8, window=2, seed=7)
    return out.select("key", F.posexplode("vector").alias("dim", "value")).withColumn("value", rnd(F.col("value"), 3))


@query("vec_6_word_vectors_low_rank")
def vec_6_low_rank(spark, d):
    """Leading eigenvectors of the information table; held against numpy in the tests, as SQL has no such iteration."""
    docs = spread(table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    return vectors.word_vectors_low_rank(text.tokenize(docs), size=16, more=8, rounds=4, seed=7)
