import datetime as dt
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelearn.operators import batches, metrics, tensors, text, vector_lists, vectors
from framelearn.plans import scale
from framelearn.session import materialize, shared_dir


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, and keys that the right side lacks."""
    rng = random.Random(3)
    rows = [(i, 7 if i % 3 == 0 else rng.randrange(60)) for i in range(900)]
    right = [(k, f"name {k}") for k in range(50)]
    return spark.createDataFrame(rows, "i long, k long"), spark.createDataFrame(right, "k long, name string")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_paths_agree(skewed, how):
    left, right = skewed
    want = sorted(map(str, left.join(right, "k", how).select("i", "k", "name").collect()))
    ways = {
        "broadcast": {},
        "shuffle": {"max_rows": 0},
        "hot": {"max_rows": 0, "hot_rows": 100, "hot_parts": 4},
    }
    for kw in ways.values():
        got = scale.lookup_join(left, right, ["k"], how, **kw).select("i", "k", "name").collect()
        assert sorted(map(str, got)) == want


def test_only_hot_keys_are_hot(skewed):
    left, _ = skewed
    assert [r["k"] for r in scale.hot_keys(left, ["k"], hot_rows=100, hot_parts=4)] == [7]
    assert scale.hot_keys(left, ["k"]) == []


def test_size_is_measured(spark):
    df = spark.createDataFrame([(i, "x" * 100, [1.0] * 10) for i in range(50)], "i long, s string, v array<double>")
    rows, size = scale.measured(df)
    assert rows == 50 and size >= 50 * 180
    assert scale.fits(df) and not scale.fits(df, max_rows=49) and not scale.fits(df, max_bytes=1000)
    with pytest.raises(ValueError):
        scale.small_rows(df, "table", max_rows=10)


KEYS = {
    "long": ("k long", lambda i: (i * 7919) % 1009 - 300),
    "double": ("k double", lambda i: ((i * 7919) % 1009) / 7 - 50),
    "string": ("k string", lambda i: f"é'{(i * 7919) % 1009}\\" if i % 2 else f"z{i}"),
    "time": ("k timestamp_ntz", lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=(i * 7919) % 1009)),
    "date": ("k date", lambda i: dt.date(2000, 1, 1) + dt.timedelta(days=(i * 7919) % 1009)),
}


@pytest.mark.parametrize("kind", KEYS)
def test_dense_index_over_many_ranges(spark, kind):
    schema, make = KEYS[kind]
    keys = sorted({make(i) for i in range(500)})
    shuffled = keys[:]
    random.Random(1).shuffle(shuffled)
    df = spark.createDataFrame([(k,) for k in shuffled], schema)
    out = scale.dense_index(df, ["k"], rows_per_bucket=20)
    assert [r["k"] for r in sorted(out.collect(), key=lambda r: r["idx"])] == keys
    assert sorted(r["idx"] for r in out.collect()) == list(range(len(keys)))


def test_index_with_ties_in_the_first_column_and_groups(spark):
    rows = [(i % 3, 5 if i % 2 else i % 11, i) for i in range(400)]
    df = spark.createDataFrame(rows, "g long, a long, b long")
    out = scale.dense_index(df, ["a", "b"], ["g"], rows_per_bucket=16).collect()
    for g in range(3):
        mine = sorted((r for r in out if r["g"] == g), key=lambda r: r["idx"])
        assert [(r["a"], r["b"]) for r in mine] == sorted((a, b) for h, a, b in rows if h == g)
        assert [r["idx"] for r in mine] == list(range(len(mine)))


def test_running_total_of_values(spark):
    df = spark.createDataFrame([(i, float(i % 5)) for i in range(300)], "i long, v double")
    out = scale.running_total(df, ["i"], F.col("v"), name="t", kind="double", rows_per_bucket=7).orderBy("i").collect()
    total = 0.0
    for r in out:
        assert r["t"] == total
        total += r["v"]


def test_ranges_do_not_run_in_one_task(spark):
    df = spark.range(5000).withColumnRenamed("id", "i")
    out = scale.dense_index(df, ["i"], rows_per_bucket=100)
    assert "hashpartitioning(_b" in plan(out)


@pytest.mark.parametrize("rank", [0, 1, 250, 498, 499])
def test_key_at_rank(spark, rank):
    df = spark.createDataFrame([((i * 7919) % 1009, i) for i in range(500)], "a long, b long")
    want = sorted((r["a"], r["b"]) for r in df.collect())
    assert scale.key_at_rank(df, ["a", "b"], rank, small=10, buckets=8) == want[rank]
    hashed = df.withColumn("_h", scale.order_hash("b", seed=1)).select("_h", "b")
    want = sorted(tuple(r) for r in hashed.collect())
    assert scale.key_at_rank(hashed, ["_h", "b"], rank, small=10, buckets=8, hashed=True) == want[rank]


def test_key_at_rank_past_the_end_and_repeated_keys(spark):
    df = spark.range(10).withColumnRenamed("id", "i")
    assert scale.key_at_rank(df, ["i"], 10) is None
    same = spark.createDataFrame([(1,)] * 50, "i long")
    with pytest.raises(ValueError, match="identify"):
        scale.key_at_rank(same, ["i"], 20, small=10, buckets=4)


def test_hash_order_does_not_depend_on_partitions(spark):
    df = spark.range(200).withColumnRenamed("id", "i")
    a = batches.shuffle_rows(df.repartition(1), ["i"], seed=3, epoch=1, rows_per_bucket=20)
    b = batches.shuffle_rows(df.repartition(7), ["i"], seed=3, epoch=1)
    other = batches.shuffle_rows(df, ["i"], seed=3, epoch=2)
    order = [r["i"] for r in sorted(a.collect(), key=lambda r: r["idx"])]
    assert order == [r["i"] for r in sorted(b.collect(), key=lambda r: r["idx"])]
    assert order != [r["i"] for r in sorted(other.collect(), key=lambda r: r["idx"])]


@pytest.mark.parametrize("n", [0, 1, 9, 10, 101])
def test_splits_have_exact_sizes(spark, n):
    df = spark.range(n).withColumnRenamed("id", "i")
    for train, test in (batches.split_sequential(df, ["i"]), batches.split_random(df, ["i"], seed=4)):
        a, b = [r["i"] for r in train.collect()], [r["i"] for r in test.collect()]
        assert len(a) == int(0.8 * n) and sorted(a + b) == list(range(n))
    marked = batches.with_split(df, ["i"], 0.8, seed=4)
    assert marked.filter("split = 'train'").count() == int(0.8 * n)


@pytest.mark.parametrize("lo,hi", [(0, 3), (2, 5), (-3, None), (0, -4), (8, 99), (50, None), (5, 5)])
def test_slices_follow_list_rules(spark, lo, hi):
    values = list(range(100, 110))
    df = spark.createDataFrame([(v,) for v in values], "i long")
    assert sorted(r["i"] for r in batches.slice_rows(df, ["i"], lo, hi).collect()) == values[lo:hi]


@pytest.mark.parametrize("drop_last", [False, True])
def test_batches(spark, drop_last):
    df = spark.range(23).withColumnRenamed("id", "i")
    got = batches.assign_batches(df, ["i"], 5, drop_last=drop_last, rows_per_bucket=4).collect()
    assert sorted((r["i"], r["batch_id"]) for r in got) == [(i, i // 5) for i in range(20 if drop_last else 23)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 17, 1000, 4099])
def test_keyed_permutation_is_one_to_one(spark, n):
    df = spark.range(n)
    one, two, again = ([r[0] for r in df.repartition(k + 1).select("id", batches.permuted(F.col("id"), n, 7, e).alias("v")).orderBy("id").select("v").collect()] for k, e in enumerate((0, 1, 0)))
    assert sorted(one) == sorted(two) == list(range(n)) and one == again
    if n >= 1000:
        assert one != two and one != list(range(n))
        # neighbours come apart, and no place is favoured
        assert sum(abs(a - b) < n / 100 for a, b in zip(one, one[1:])) < 0.05 * n
        assert abs(sum(v for v in one[: n // 2]) / (n // 2) - n / 2) < 0.05 * n
    dealt = batches.permuted_batches(df, "id", n, 4, seed=7, drop_last=True)
    sizes = [r["count"] for r in dealt.groupBy("batch_id").count().collect()]
    assert sizes == [4] * (n // 4)
    assert "Exchange" not in dealt._jdf.queryExecution().executedPlan().toString()


def test_sketches_merge_to_a_whole_pass(spark):
    df = spark.range(30_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 2).alias("h"), F.when(F.col("id") % 10 > 0, F.col("id") % 7001).alias("v"))
    whole = metrics.distinct_sketches(df, "v", ["g"])
    merged = metrics.merge_sketches(metrics.distinct_sketches(df, "v", ["g", "h"]), ["g"])
    a, b = ({r["g"]: r["n_distinct"] for r in metrics.estimated_distinct(x).collect()} for x in (whole, merged))
    exact = {r["g"]: r["n"] for r in df.groupBy("g").agg(F.count_distinct("v").alias("n")).collect()}
    assert a == b and all(abs(a[g] - exact[g]) <= 4 * metrics.distinct_error() * exact[g] for g in exact)
    assert metrics.estimated_distinct(metrics.distinct_sketches(df.limit(0), "v")).first()[0] == 0


def test_same_seed_same_sample(spark):
    df = spark.range(100).withColumnRenamed("id", "i")
    a = {r["i"] for r in batches.sample_n(df, ["i"], 7, seed=1).collect()}
    assert a == {r["i"] for r in batches.sample_n(df.repartition(5), ["i"], 7, seed=1).collect()}
    assert a != {r["i"] for r in batches.sample_n(df, ["i"], 7, seed=2).collect()} and len(a) == 7


# --- vectors and tensors --------------------------------------------------


@pytest.fixture(scope="module")
def vecs(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(20)]  # copies
    rows.append((999, [0.0] * 6))
    return spark.createDataFrame(rows, "key long, vector array<double>")


@pytest.mark.parametrize("kw", [{}, {"max_rows": 0, "block_rows": 16}, {"max_rows": 0}])
def test_nearest_neighbours_equal_brute_force(vecs, kw):
    import numpy as np

    rows = {r["key"]: np.array(r["vector"]) for r in vecs.collect()}
    unit = {k: v / np.linalg.norm(v) for k, v in rows.items() if np.linalg.norm(v) > 0}
    got = {}
    for r in vectors.knn_join(vecs, vecs, 4, **kw).collect():
        got.setdefault(r["query"], {})[r["rank"]] = (r["key"], round(r["similarity"], 9))
    assert set(got) == set(unit)
    for q, u in unit.items():
        best = sorted(((-round(float(u @ v), 9), k) for k, v in unit.items() if k != q))[:4]
        assert [s for _, s in sorted(got[q].values(), key=lambda x: -x[1])] == [-s for s, _ in best]
        assert len({k for k, _ in got[q].values()}) == 4


def test_blocks_meet_in_groups(vecs):
    """A vector is sent to each group of blocks, not to each block, with the same neighbours; groups are of bounded size and every core has some."""
    want = sorted(tuple(r) for r in vectors.knn_join(vecs, vecs, 4).select("query", F.round("similarity", 9), "rank").collect())
    # pairs of blocks meet in whichever of many tasks
    vecs.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    for size, block, groups in ((1 << 25, 1, 14), (1 << 25, 16, 5), (0, 16, 5)):
        out = vectors.knn_join(vecs, vecs, 4, max_rows=0, block_rows=block, group_bytes=size)
        sent = [int(n) for n in re.findall(r"explode\(sequence\(cast\(0 as bigint\), cast\((\d+)", out._jdf.queryExecution().analyzed().toString())]
        assert sent and all(n < groups * 2 for n in sent), sent
        assert sorted(tuple(r) for r in out.select("query", F.round("similarity", 9), "rank").collect()) == want
    vecs.sparkSession.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_pairs_are_counted_once(spark):
    """Both rows of a pair come from one, also beside NULL and for a token beside itself, and are not shuffled again."""
    lists = [["b", "a", "b", "b"], ["a", None, "b"], [None, "a", None], ["c"], []]
    tokens = spark.createDataFrame([(ts,) for ts in lists], "tokens array<string>")
    want = Counter()
    for ts in lists:
        for i, a in enumerate(ts):
            for b in ts[i + 1 : i + 3]:
                want[a, b] += 1
                want[b, a] += 1
    out = vectors.neighbour_counts(tokens)
    assert plan(out).count("Exchange hashpartitioning") == 1
    assert {(r["token"], r["context"]): r["n"] for r in out.collect()} == want and out.count() == len(want)

@pytest.mark.parametrize("kw", [{}, {"part_rows": 7}])
def test_lists_with_all_cells_and_codes_equal_the_exact_join(spark, vecs, kw):
    found = vector_lists.knn_lists(vecs, vecs, 4, cells=5, parts=4, probes=5, rerank=1000, **kw).collect()
    exact = vectors.knn_join(vecs, vecs, 4).collect()

    def shown(rows):
        return sorted((r["query"], r["rank"], round(r["similarity"], 9)) for r in rows)

    assert shown(found) == shown(exact)
    named = vecs.withColumn("key", F.col("key").cast("string"))
    assert vector_lists.knn_lists(named.limit(3), named, 2, cells=3, probes=3, **kw).count() == 6
    empty = vecs.filter("key = 999")
    assert vector_lists.knn_lists(vecs, empty, 3).collect() == [] == vector_lists.knn_lists(empty, vecs, 3, cells=4).collect()


@pytest.mark.parametrize("clustered,probes,rerank", [(True, 4, 60), (False, 16, 200)])
def test_lists_recall_while_few_vectors_are_read(spark, clustered, probes, rerank):
    import numpy as np

    r = np.random.default_rng(1)
    base = r.normal(size=(2000, 24)) if not clustered else r.normal(size=(40, 24))[r.integers(0, 40, 2000)] + 0.3 * r.normal(size=(2000, 24))
    vecs = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(base)], "key long, vector array<double>")
    asked = vecs.filter("key % 20 = 0")
    lists = vector_lists.build_lists(vecs, cells=16, parts=12, sample_rows=1000)
    assert {x["key"] for x in lists.codes.collect()} == set(range(2000))
    found = vector_lists.search_lists(asked, lists, 10, probes=probes, rerank=rerank)
    exact = vectors.knn_join(asked, vecs, 10)
    share = exact.select("query", "key").intersect(found.select("query", "key")).count() / exact.count()
    assert share >= 0.9 and rerank <= 0.25 * 2000


def test_similarity_of_a_zero_vector_is_null(spark, vecs):
    pairs = spark.createDataFrame([(0, 999), (0, 0)], "a long, b long")
    got = {r["b"]: r["similarity"] for r in vectors.similarity(vecs, pairs).collect()}
    assert got[999] is None and abs(got[0] - 1) < 1e-12


def test_most_similar_needs_known_keys(vecs):
    with pytest.raises(KeyError):
        vectors.most_similar(vecs, [0], [12345])


@pytest.mark.parametrize("block", [2, 128])
def test_matmul(spark, block):
    import numpy as np

    rng = np.random.RandomState(0)
    a, b = rng.rand(5, 7), rng.rand(7, 3)
    frames = [
        spark.createDataFrame([(int(i), int(j), float(v)) for (i, j), v in np.ndenumerate(m)], "i0 long, i1 long, v double")
        for m in (a, b)
    ]
    got = np.zeros((5, 3))
    for r in tensors.matmul(*frames, block=block).collect():
        got[r["i0"], r["i1"]] = r["v"]
    assert np.allclose(got, a @ b)


def test_shape_errors(spark):
    from framelearn.sources.generators import tensor_full

    t = tensor_full(spark, (3, 4), 1.0)
    with pytest.raises(ValueError):
        tensors.reshape(t, (5, 2))
    with pytest.raises(Exception, match="one element"):
        tensors.item(t).collect()
    assert tensors.shape_of(tensors.reshape(t, (2, -1))) == (2, 6)


def test_stacked_and_joined_shapes(spark):
    from framelearn.sources.generators import tensor_full, tensor_rand

    t = tensor_full(spark, (3, 4), 1.0)
    assert tensors.shape_of(tensors.stack([t, t], 1)) == (3, 2, 4)
    assert tensors.shape_of(tensors.concat([t, t], 1)) == (3, 8)
    a, b = (tensor_rand(spark, (3, 4), "normal", 42).orderBy("i0", "i1").collect() for _ in range(2))
    assert a == b


def test_vectors_of_null_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [3.0, 4.0])], "i long, v array<double>")
    out = df.withColumn("w", tensors.row_function(lambda x: x * 2)("v")).orderBy("i").collect()
    assert [r["w"] for r in out] == [[2.0, 4.0], None, [6.0, 8.0]]


# --- metrics on edges -----------------------------------------------------


def test_metrics_without_rows_and_with_nulls(spark):
    from framelearn.functions import columns as C

    empty = spark.createDataFrame([], "p double, y double")
    row = empty.agg(C.l1_loss("p", "y"), C.accuracy_pct("y", "p"), C.r2_score("p", "y"), C.relative_accuracy("p", "y")).first()
    assert list(row) == [None] * 4
    some = spark.createDataFrame([(1.0, 1.0), (None, 2.0), (3.0, None), (2.0, 0.0)], "p double, y double")
    row = some.agg(C.l1_loss("p", "y"), C.accuracy_pct("y", "p"), C.relative_accuracy("p", "y")).first()
    assert list(row) == [1.0, 50.0, 1.0]
    flat = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "p double, y double")
    assert flat.agg(C.r2_score("p", "y")).first()[0] is None


def test_mode_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([(3,), (1,), (3,), (1,), (2,)], "v int")
    assert tuple(metrics.mode_value(df, "v").first()) == (1, 2)


def test_empty_classes_in_the_report(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (2, 1)], "y int, p int")
    got = {r["class"]: tuple(r)[1:] for r in metrics.classification_report(df, "y", "p").collect()}
    assert got[0] == (1.0, 0.5, 2 / 3, 2) and got[1] == (0.0, 0.0, 0.0, 0) and got[2] == (0.0, 0.0, 0.0, 1)
    assert abs(metrics.macro_f1(df, "y", "p").first()["macro_f1"] - 2 / 9) < 1e-12


# --- shared folder --------------------------------------------------------


def test_checkpoints_go_to_the_shared_folder(spark):
    assert shared_dir(spark) == shared_dir(spark)
    df = materialize(spark.range(5))
    assert df.count() == 5 and "Scan ExistingRDD" in plan(df)


def _information(token_lists, window=2):
    """Names and the dense table of positive pointwise mutual information, by plain counting."""
    names = sorted({t for ts in token_lists for t in ts})
    place = {t: i for i, t in enumerate(names)}
    n = np.zeros((len(names), len(names)))
    for ts in token_lists:
        for i in range(len(ts)):
            for j in range(i + 1, min(len(ts), i + window + 1)):
                n[place[ts[i]], place[ts[j]]] += 1
                n[place[ts[j]], place[ts[i]]] += 1
    s = n.sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        return names, np.where(n > 0, np.maximum(np.log(n * s.sum() / np.outer(s, s)), 0), 0)


def _filled(found, names, size):
    vectors_by_key = {r["key"]: r["vector"] for r in found.collect()}
    return np.array([vectors_by_key.get(t, [0.0] * size) for t in names])


def _nearest(x, k=5):
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    scores = x @ x.T
    np.fill_diagonal(scores, -2)
    return np.argsort(-scores, axis=1, kind="stable")[:, :k]


def test_low_rank_vectors_span_the_leading_eigenvectors(spark):
    rng = random.Random(4)
    lists = [[f"{topic}{min(rng.randrange(12), rng.randrange(12))}" for _ in range(40)] for topic in "abcdef" for _ in range(12)]
    lists += [[], ["alone"], ["a0", "b0", "c0", "d0"]]
    names, table = _information(lists)
    values, directions = np.linalg.eigh(table)
    lead = np.argsort(-np.abs(values))[:6]
    tokens = spark.createDataFrame([(ts,) for ts in lists] + [(None,)], "tokens array<string>")
    for kw in ({}, {"max_rows": 0, "hot_rows": 30, "hot_parts": 4}):
        got = vectors.word_vectors_low_rank(tokens, size=6, more=14, rounds=6, seed=2, **kw)
        x = _filled(got, names, 6)
        want = directions[:, lead] @ np.diag(np.abs(values[lead])) @ directions[:, lead].T
        assert np.abs(x @ x.T - want).max() < 1e-4 * np.abs(values).max()
        assert np.allclose((x * x).sum(axis=0), np.abs(values[lead]), rtol=1e-4)


def test_low_rank_vectors_of_few_tokens(spark):
    few = spark.createDataFrame([(["x", "y"],), (["x", "y", "x"],)], "tokens array<string>")
    got = {r["key"]: r["vector"] for r in vectors.word_vectors_low_rank(few, size=4, more=2, rounds=2).collect()}
    names, table = _information([["x", "y"], ["x", "y", "x"]])
    x = np.array([got[t] for t in names])
    values, directions = np.linalg.eigh(table)
    assert x.shape == (2, 4) and np.allclose(x @ x.T, directions @ np.diag(np.abs(values)) @ directions.T, atol=1e-9)
    assert vectors.word_vectors_low_rank(few.limit(0), size=4, more=2, rounds=2).collect() == []
    with pytest.raises(ValueError):
        vectors.word_vectors_low_rank(few, size=60, more=8)


def test_low_rank_neighbours_are_nearer_than_projected_ones(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("lang = 'en' and n_chars < 1500 and doc_id < 60").select("doc_id", "text")
    tokens = materialize(text.tokenize(docs))
    names, table = _information([r["tokens"] or [] for r in tokens.select("tokens").collect()])
    want = _nearest(table)

    def overlap(found):
        got = _nearest(_filled(found, names, 16))
        return np.mean([len(set(a) & set(b)) for a, b in zip(got, want)]) / 5

    low = overlap(vectors.word_vectors_low_rank(tokens, size=16, more=8, rounds=4, seed=7))
    projected = overlap(vectors.word_vectors(tokens, size=16, seed=7))
    print(f"neighbours kept by rank 16: {low:.3f}, by projection: {projected:.3f}, of {len(names)} words")
    assert low > 1.5 * projected


def test_running_total_of_groups_shuffles_rows_once(spark):
    rows = [(None if i % 3 == 0 else i % 3, i, 1 + i % 4) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, k int, n long")
    out = scale.running_total(df, ["k"], F.col("n"), ["g"], name="o", rows_per_bucket=30)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1
    want = {k: sum(n for h, j, n in rows if h == g and j < k) for g, k, _ in rows}
    assert {r["k"]: r["o"] for r in out.collect()} == want
