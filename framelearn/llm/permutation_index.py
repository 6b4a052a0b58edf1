"""Nearest neighbours by a permutation index: pivots, inverted files, footrule order, exact rerank.

A bounded sample of ``pivots`` vectors (the least by a seeded hash) are pivots. Every vector
is represented by its ``prefix`` nearest pivots in order and posted, with each of them
and its rank there, in the pivots' inverted files. The index is a table of blocks of at most
``BLOCK`` distinct vectors, each with its own files, its vectors and their ids, so a block
answers a query alone and no list of a popular pivot ever meets in one task.

A query reads the files of its own nearest pivots. The footrule distance of a vector adds
up how far each of these pivots stands from its place in the query's order; a pivot that
the vector lacks counts as standing behind its prefix. The ``share`` of a block that comes
first in this order (at least ``at_least`` vectors, and all that tie with the last) is
reranked by the exact distance. A share is no bound on what is found in total: it grows
with the table, and a share of 1 is the exact search. Recall depends on how the vectors
are spread; measure it with ``exact_search``.

Equal vectors are indexed once, with their k + 1 smallest ids, which is all that a result of
k rows can name; that leaves out one's own id too, so copies crowd out nothing.

Defined cases: vectors that are NULL, empty or zero, or that hold a NULL, NaN or infinite
component, and rows with a NULL id take no part on either side; an id that asks twice asks
with its least vector; rows with the query's id are never its neighbours; a repeated row
is a neighbour as often as it stands; equal distances go to the smaller id; vectors of
differing lengths are an error; an empty table, or no query, gives no row; further columns
of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelearn.llm.common import narrow, stored, workspace
from framelearn.plans.scale import BROADCAST_BYTES, order_hash, spread

#: Distinct vectors of one block.
BLOCK = 8192


def _valid(df: DataFrame) -> DataFrame:
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = df.withColumn("x", F.col("x").cast("array<double>")).filter(F.col("id").isNotNull() & F.col("x").isNotNull())
    return whole.filter(~bad).filter(F.exists("x", lambda c: c != 0))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def ordered_pivots(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each row, nearest first, ties to the earlier pivot."""
    with np.errstate(over="ignore", invalid="ignore"):
        far = (pivots**2).sum(axis=1)[None] - 2.0 * (x @ pivots.T)
    return np.argsort(far, axis=1, kind="stable")[:, :prefix].astype(np.int32)


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to one vector; components are added in order, as a plain loop would."""
    total = np.zeros(len(x))
    with np.errstate(over="ignore"):
        for c in range(x.shape[1]):
            d = x[:, c] - q[c]
            total += d * d
    return np.sqrt(total)


class Files:
    """The inverted files of a block: for each pivot, the rows that hold it and its rank there."""

    def __init__(self, starts: np.ndarray, rows: np.ndarray, ranks: np.ndarray, n: int):
        self.starts, self.rows, self.ranks, self.n = starts, rows, ranks, n

    @classmethod
    def posted(cls, orders: np.ndarray, pivots: int) -> Files:
        n, prefix = orders.shape
        by = np.argsort(orders.reshape(-1), kind="stable")
        starts = np.searchsorted(orders.reshape(-1)[by], np.arange(pivots + 1))
        return cls(starts, (by // prefix).astype(np.int32), (by % prefix).astype(np.int16), n)

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Distance of every row's order from ``order``; each pivot that a row lacks costs the whole prefix."""
        prefix = len(order)
        total = np.full(self.n, prefix * prefix, np.int64)
        for place, pivot in enumerate(order):
            at = slice(self.starts[pivot], self.starts[pivot + 1])
            total[self.rows[at]] += np.abs(self.ranks[at].astype(np.int64) - place) - prefix
        return total


def _first(distance: np.ndarray, at_least: int, share: float) -> np.ndarray:
    """Rows of the nearest share, with all that tie with the last."""
    want = max(at_least, int(np.ceil(share * len(distance))))
    if want >= len(distance):
        return np.arange(len(distance))
    return np.flatnonzero(distance <= np.partition(distance, want - 1)[want - 1])


def _nearest(far: np.ndarray, names: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((names, far))[:k]
    return far[order], names[order]


def build_index(rows: DataFrame, k: int, pivots: np.ndarray, prefix: int, path: str) -> DataFrame:
    """The index as a stored table, one row per block: ids, vectors, inverted files."""
    kind = rows.schema["id"].dataType.simpleString()
    # of equal vectors the k + 1 smallest ids; a limit in the map tasks comes first, so a vector of any frequency is a few rows
    own = rows.withColumn("_n", F.row_number().over(Window.partitionBy("x").orderBy("id"))).filter(F.col("_n") <= k + 1)
    distinct = own.groupBy("x").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    n, width = len(pivots), pivots.shape[1]

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = _matrix(part["x"], width)
                files = Files.posted(ordered_pivots(x, pivots, prefix), n)
                one = pa.array([0, part.num_rows], pa.int32())
                bits = [pa.array([a.tobytes()], pa.binary()) for a in (x, files.starts.astype(np.int64), files.rows, files.ranks)]
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(one, part["ids"]), *bits], names=["ids", "x", "starts", "rows", "ranks"])

    return stored(distinct.mapInArrow(post, f"ids array<array<{kind}>>, x binary, starts binary, rows binary, ranks binary"), path)


def search_index(index: DataFrame, queries: pa.Table, k: int, pivots: np.ndarray, prefix: int, at_least: int, share: float, kind: str) -> DataFrame:
    """The k nearest of each query that each task found: ``(query, vec, score)``."""
    width = pivots.shape[1]
    asked = index.sparkSession.sparkContext.broadcast((queries["id"].combine_chunks(), _matrix(queries["x"].combine_chunks(), width)))
    schema = f"query {kind}, vec {kind}, score double"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q = asked.value
        q_names, orders = q_ids.to_numpy(zero_copy_only=False), ordered_pivots(q, pivots, prefix)
        best: list = [None] * len(q)
        for batch in batches:
            for b in range(batch.num_rows):
                held = {c: batch[c][b] for c in ("ids", "x", "starts", "rows", "ranks")}
                x = np.frombuffer(held["x"].as_py(), float).reshape(-1, width)
                files = Files(*[np.frombuffer(held[c].as_py(), t) for c, t in (("starts", np.int64), ("rows", np.int32), ("ranks", np.int16))], len(x))
                lists = held["ids"].values
                offsets = np.asarray(lists.offsets)
                names = lists.values.to_numpy(zero_copy_only=False)
                for j in range(len(q)):
                    rows = _first(files.footrule(orders[j]), at_least, share)
                    far = distances(x[rows], q[j])
                    if len(rows) > k + 1:  # a vector beyond the first k + 1 distances has k others before it
                        bar = np.partition(far, k)[k]
                        rows, far = rows[far <= bar], far[far <= bar]
                    many = offsets[rows + 1] - offsets[rows]
                    at = np.repeat(offsets[rows], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    own, named = np.repeat(far, many), names[at]
                    other = named != q_names[j]
                    own, named = own[other], named[other]
                    if best[j] is not None:
                        own, named = np.concatenate([best[j][0], own]), np.concatenate([best[j][1], named])
                    best[j] = _nearest(own, named, k)
        found = [(j, b) for j, b in enumerate(best) if b is not None and len(b[0])]
        if found:
            at = np.concatenate([np.full(len(b[0]), j) for j, b in found])
            vec = pa.array(np.concatenate([b[1] for _, b in found]), q_ids.type)
            yield pa.RecordBatch.from_arrays([q_ids.take(pa.array(at)), vec, pa.array(np.concatenate([b[0] for _, b in found]))], names=["query", "vec", "score"])

    return index.mapInArrow(search, schema)


def _sized(rows: DataFrame) -> int | None:
    sizes = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if sizes[0] != sizes[1]:
        raise ValueError(f"vectors have {sizes[0]} to {sizes[1]} components; all must have as many")
    return sizes[0]


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy("score", "vec")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query", "rank", "vec", "score")


def permutation_search(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    pivots: int = 256,
    prefix: int = 128,
    share: float = 0.35,
    at_least: int = 500,
    seed: int = 0,
    query_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(query, rank, vec, score)``: the ``k`` nearest found of every query, by Euclidean distance.

    ``pivots`` bounds the sample that the index is fitted on. Queries go to all tasks in
    parts of at most ``query_bytes``, one pass over the index for each part.
    """
    spark, folder = vectors.sparkSession, workspace(vectors.sparkSession, "permutations")
    rows, asked = _valid(narrow(vectors, id=key, x=vector)), _valid(narrow(queries, id=key, x=vector))
    kind = rows.schema["id"].dataType.simpleString()
    width = _sized(rows)
    asked = stored(asked.groupBy("id").agg(F.min("x").alias("x")), f"{folder}/queries")
    n_queries = asked.count()
    if width is None or not n_queries:
        return _ranked(spark.createDataFrame([], f"query {kind}, vec {kind}, score double"), k)
    if _sized(asked) != width:
        raise ValueError("queries and vectors differ in length")
    sample = rows.orderBy(order_hash("id", seed=seed), "id", "x").limit(pivots).select("x").collect()
    table = np.unique(np.array([r["x"] for r in sample], float), axis=0)
    prefix = min(prefix, len(table))
    index = build_index(spread(rows), k, table, prefix, f"{folder}/index")
    passes = -(-n_queries * (8 * width + 64) // query_bytes)
    found = []
    for part in range(passes):
        own = asked if passes == 1 else asked.filter(F.pmod(F.xxhash64("id"), F.lit(passes)) == part)
        got = own.orderBy("id").toArrow()
        if got.num_rows:
            found.append(stored(search_index(index, got, k, table, prefix, at_least, share, kind), f"{folder}/found-{part}"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return _ranked(every, k)


def exact_search(queries: DataFrame, vectors: DataFrame, k: int = 10, **kw) -> DataFrame:
    """The same with every vector reranked: what recall is measured against."""
    return permutation_search(queries, vectors, k, **{**kw, "share": 1.0})


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of the exact neighbours that were found."""
    both = exact.select("query", "vec", F.lit(1).alias("_w")).join(found.select("query", "vec", F.lit(1).alias("_f")), ["query", "vec"], "left")
    row = both.agg(F.count("_w"), F.count("_f")).first()
    return row[1] / row[0] if row[0] else 1.0
