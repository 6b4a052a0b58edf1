"""Graphs as three tables and message passing as joins and sums.

``graphs(graph_id, y)``, ``nodes(graph_id, node_id, x, pos)``,
``edges(graph_id, src, dst, attr)``. Keys are (graph, node) pairs, so one graph
with a third of all nodes still spreads over all tasks, and a node with a third
of all edges is joined by its own broadcast row and summed in part before the
shuffle. Graphs that fit a task are embedded by blocks of whole graphs instead,
with one shuffle for all layers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelearn.functions import columns as C
from framelearn.operators.batches import with_split
from framelearn.operators.models import forward, layer_list, param_arrays
from framelearn.operators.tensors import fit_stats, row_function, rows_matrix, standardize, vector_sum
from framelearn.operators.training import Fit, fit_mlp
from framelearn.plans.scale import fits, hot_keys, lookup_join, settle
from framelearn.session import materialize

NODE = ["graph_id", "node_id"]


def graph_sizes(graphs: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: graphs, nodes, edges, and the widths of node and edge features."""
    names = ("n_graphs", "n_nodes", "n_node_features", "n_edges", "n_edge_features")
    parts = [
        graphs.agg(F.count(F.lit(1)).alias("n_graphs")),
        nodes.agg(F.count(F.lit(1)).alias("n_nodes"), F.max(F.size("x")).alias("n_node_features")),
        edges.agg(F.count(F.lit(1)).alias("n_edges"), F.max(F.size("attr")).alias("n_edge_features")),
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(*[F.max(n).alias(n) for n in names])


def endpoint_plan(edges: DataFrame, nodes: DataFrame, **limits) -> dict:
    """How the ends are joined, found once for all layers: whether the nodes fit a broadcast, else the hot ends.

    ``nodes`` must be as wide as in the layers.
    """
    sizes = {k: v for k, v in limits.items() if k in ("max_rows", "max_bytes")}
    bars = {k: v for k, v in limits.items() if k in ("hot_rows", "hot_parts")}
    small = fits(nodes, **sizes)
    return {"small": small, "hot": {end: [] if small else hot_keys(edges, ["graph_id", end], **bars) for end in ("src", "dst")}}


def endpoints(edges: DataFrame, nodes: DataFrame, cols: Sequence[str] = ("x", "pos"), plan: dict | None = None, **limits) -> DataFrame:
    """Edges with the columns of both ends: ``<col>_j`` of the source, ``<col>_i`` of the target."""
    out = edges
    for end, mark in (("src", "j"), ("dst", "i")):
        side = nodes.select("graph_id", F.col("node_id").alias(end), *[F.col(c).alias(f"{c}_{mark}") for c in cols])
        known = {"small": plan["small"], "hot": plan["hot"][end]} if plan else {}
        out = lookup_join(out, side, ["graph_id", end], "inner", **limits, **known)
    return out


def with_lengths(edges: DataFrame, nodes: DataFrame, **limits) -> DataFrame:
    """Edges with ``dist``, the distance of their ends."""
    ends = endpoints(edges, nodes, ["pos"], **limits)
    return ends.withColumn("dist", C.distance("pos_j", "pos_i")).drop("pos_j", "pos_i")


def neighbour_sum(edges: DataFrame, nodes: DataFrame, col: str, dim: int, out: str = "agg") -> DataFrame:
    """Sum of edge vectors per target node; zeros for nodes without incoming edges."""
    sums = vector_sum(edges, ["graph_id", "dst"], col, dim, out).withColumnRenamed("dst", "node_id")
    zeros = F.array(*[F.lit(0.0)] * dim)
    return nodes.join(sums, NODE, "left").withColumn(out, F.coalesce(out, zeros))


def to_undirected(edges: DataFrame) -> DataFrame:
    """Each connected pair once, smaller node first."""
    return edges.select("graph_id", F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()


def pool_graphs(nodes: DataFrame, dim: int, graphs: DataFrame | None = None, col: str = "x") -> DataFrame:
    """Sum and largest value of every node feature per graph, side by side in ``emb``.

    With ``graphs`` given, graphs without nodes get zeros.
    """
    v = F.col(col)
    pooled = nodes.groupBy("graph_id").agg(
        F.array(*[F.sum(v[k]) for k in range(dim)], *[F.max(v[k]) for k in range(dim)]).alias("emb")
    )
    if graphs is None:
        return pooled
    zeros = F.array(*[F.lit(0.0)] * (2 * dim))
    return graphs.select("graph_id").join(pooled, "graph_id", "left").withColumn("emb", F.coalesce("emb", zeros))


# --- message passing ------------------------------------------------------


def norm_block(x: np.ndarray, p: Mapping[str, np.ndarray], prefix: str) -> np.ndarray:
    """Linear, normalisation with stored statistics, ReLU, linear."""
    x = x @ p[f"{prefix}.0.weight"].T + p[f"{prefix}.0.bias"]
    scale = p[f"{prefix}.norm.gamma"] / np.sqrt(p[f"{prefix}.norm.var"] + 1e-5)
    x = np.maximum((x - p[f"{prefix}.norm.mean"]) * scale + p[f"{prefix}.norm.beta"], 0.0)
    return x @ p[f"{prefix}.1.weight"].T + p[f"{prefix}.1.bias"]


def mp_layer(nodes: DataFrame, edges: DataFrame, params: Mapping[str, np.ndarray], prefix: str, plan: dict | None = None, **limits) -> DataFrame:
    """One round: message MLP on [x_i, x_j, attr, dist], sum per target, update MLP on [x, sum].

    ``edges`` must carry ``dist``. Returns the nodes with new ``x``.
    """
    own = {k: v for k, v in params.items() if k.startswith(prefix + ".")}
    shared = nodes.sparkSession.sparkContext.broadcast(own)
    message = row_function(lambda x: norm_block(x, shared.value, f"{prefix}.msg"))
    update = row_function(lambda x: norm_block(x, shared.value, f"{prefix}.upd"))
    ends = endpoints(edges, nodes, ["x"], plan, **limits)
    ends = settle(ends, "_in", C.concat_vec("x_i", "x_j", F.col("attr").cast("array<double>"), F.array("dist")))
    sent = ends.select("graph_id", "dst", message("_in").alias("m"))
    dim = len(own[f"{prefix}.msg.1.bias"])
    summed = neighbour_sum(sent, nodes.select("graph_id", "node_id", "x"), "m", dim)
    return summed.select("graph_id", "node_id", update(C.concat_vec("x", "agg")).alias("x"))


def _message_layers(arrays: Mapping[str, np.ndarray]) -> list[str]:
    return sorted({k.split(".")[0] for k in arrays if k.startswith("conv")}, key=lambda s: int(s[4:]))


def _features(column, width: int | None = None) -> np.ndarray:
    return rows_matrix(column.combine_chunks().cast(pa.list_(pa.float64())), width) if len(column) else np.zeros((0, width or 0))


def _block_embeddings(nodes: pa.Table, edges: pa.Table, arrays: Mapping[str, np.ndarray]) -> tuple[pa.Array, np.ndarray]:
    """Graph ids and graph vectors of whole graphs: every layer over arrays, with edges in the order of their targets."""
    nodes = nodes.sort_by("graph_id")
    keys = pd.MultiIndex.from_arrays([nodes["graph_id"].to_pandas(), nodes["node_id"].to_pandas()])
    ends = [keys.get_indexer(pd.MultiIndex.from_arrays([edges["graph_id"].to_pandas(), edges[c].to_pandas()])) for c in ("src", "dst")]
    order = np.argsort(ends[1], kind="stable")
    order = order[(ends[0][order] >= 0) & (ends[1][order] >= 0)]
    src, dst = ends[0][order], ends[1][order]
    pos = _features(nodes["pos"])
    dist = np.sqrt(((pos[src] - pos[dst]) ** 2).sum(axis=1))[:, None]
    attr = _features(edges["attr"])[order] if len(order) else np.zeros((0, len(arrays["conv1.msg.0.weight"][0]) - 2 * len(arrays["proj.bias"]) - 1))
    first = np.flatnonzero(np.r_[True, dst[1:] != dst[:-1]]) if len(dst) else np.zeros(0, int)
    x = np.maximum(_features(nodes["x"]) @ arrays["proj.weight"].T + arrays["proj.bias"], 0.0)
    for name in _message_layers(arrays):
        summed = np.zeros((len(x), len(arrays[f"{name}.msg.1.bias"])))
        if len(dst):
            sent = norm_block(np.hstack([x[dst], x[src], attr, dist]), arrays, f"{name}.msg")
            summed[dst[first]] = np.add.reduceat(sent, first, axis=0)
        x = np.maximum(norm_block(np.hstack([x, summed]), arrays, f"{name}.upd"), 0.0)
    graph = nodes["graph_id"].combine_chunks()
    codes = pd.factorize(graph.to_pandas())[0]
    begin = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return graph.take(pa.array(begin)), np.hstack([np.add.reduceat(x, begin, axis=0), np.maximum.reduceat(x, begin, axis=0)])


def embed_blocks(nodes: DataFrame, edges: DataFrame, arrays: Mapping[str, np.ndarray], rows: int, block_rows: int) -> DataFrame:
    """``(graph_id, emb)`` of graphs that fit a task: nodes and edges are shuffled once, by block of graphs, for all layers."""
    blocks = max(1, -(-rows // block_rows), min(nodes.sparkSession.sparkContext.defaultParallelism, rows // 1000))
    shared = nodes.sparkSession.sparkContext.broadcast(dict(arrays))
    kind = nodes.schema["graph_id"].dataType.simpleString()

    def embed(left, right):
        if not left.num_rows:
            return pa.table({"graph_id": left["graph_id"], "emb": pa.array([], pa.list_(pa.float64()))})
        ids, vectors = _block_embeddings(left, right, shared.value)
        offsets = pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1])
        return pa.table({"graph_id": ids, "emb": pa.ListArray.from_arrays(offsets, pa.array(vectors.reshape(-1)))})

    def dealt(df: DataFrame, *cols: str) -> DataFrame:
        return df.select("graph_id", *cols, F.pmod(F.xxhash64("graph_id"), F.lit(blocks)).alias("_block"))

    left, right = dealt(nodes, "node_id", "x", "pos"), dealt(edges, "src", "dst", "attr")
    return left.groupBy("_block").cogroup(right.groupBy("_block")).applyInArrow(embed, f"graph_id {kind}, emb array<double>")


def embed_graphs(
    graphs: DataFrame, nodes: DataFrame, edges: DataFrame, params: DataFrame, graph_rows: int = 1_000_000, block_rows: int = 200_000, **limits
) -> DataFrame:
    """Graph vectors: node projection, every message layer with ReLU, add and max pooling.

    Graphs of up to ``graph_rows`` nodes and edges go by blocks of some ``block_rows``
    rows, each of which runs all layers in its task. Larger graphs are spread over all
    tasks by joins; their nodes are checkpointed between layers, so a lost executor
    repeats one layer at most and the plan does not grow with depth.
    """
    arrays = param_arrays(params)
    counts = nodes.select("graph_id", F.lit(1).alias("n")).unionByName(edges.select("graph_id", F.lit(1).alias("n")))
    sizes = counts.groupBy("graph_id").agg(F.sum("n").alias("n"))
    total, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    if most <= graph_rows:
        pooled = embed_blocks(nodes, edges, arrays, total, block_rows)
    else:  # at most total / graph_rows ids
        large = F.broadcast(sizes.filter(F.col("n") > graph_rows).select("graph_id"))
        parts = [[df.join(large, "graph_id", how) for df in (nodes, edges)] for how in ("left_anti", "left_semi")]
        pooled = embed_blocks(*parts[0], arrays, total, block_rows).unionByName(_embed_joined(*parts[1], arrays, **limits))
    zeros = F.array(*[F.lit(0.0)] * (2 * len(arrays["proj.bias"])))
    return graphs.select("graph_id").join(pooled, "graph_id", "left").withColumn("emb", F.coalesce("emb", zeros))


def _embed_joined(nodes: DataFrame, edges: DataFrame, arrays: Mapping[str, np.ndarray], **limits) -> DataFrame:
    """``(graph_id, emb)`` of graphs of any size, by one message layer after the other."""
    project = nodes.sparkSession.sparkContext.broadcast((arrays["proj.weight"], arrays["proj.bias"]))
    relu = row_function(lambda x: np.maximum(x, 0.0))
    start = row_function(lambda x: np.maximum(x @ project.value[0].T + project.value[1], 0.0))
    state = materialize(nodes.select("graph_id", "node_id", start("x").alias("x")))
    lengths = materialize(with_lengths(edges, nodes, **limits))
    plan = endpoint_plan(lengths, state, **limits)
    for name in _message_layers(arrays):
        state = mp_layer(state, lengths, arrays, name, plan, **limits).withColumn("x", relu("x"))
        state = materialize(state)
    return pool_graphs(state, len(arrays["proj.bias"]))


def predict_graph(graphs: DataFrame, nodes: DataFrame, edges: DataFrame, params: DataFrame, out: str = "pred", **limits) -> DataFrame:
    """``(graph_id, pred)``: the whole graph model."""
    embedded = embed_graphs(graphs, nodes, edges, params, **limits)
    head = embedded.sparkSession.sparkContext.broadcast(layer_list(param_arrays(params), "head"))
    score = row_function(lambda x: forward(x, head.value))
    return embedded.select("graph_id", score("emb")[0].alias(out))


def fit_graph_head(
    embedded: DataFrame, graphs: DataFrame, hidden: Sequence[int], share: float = 0.8, **kw
) -> tuple[Fit, DataFrame]:
    """Train the head on graph vectors against a standardised target.

    The split is sequential by graph; mean and deviation come from the training
    graphs only. Returns the fit and the test predictions on the original scale,
    ``(graph_id, pred, y)``, for R2.
    """
    rows = with_split(embedded.join(graphs, "graph_id"), ["graph_id"], share)
    rows = materialize(rows)
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    stats = fit_stats(train, "y")
    dim = rows.select(F.max(F.size("emb"))).first()[0]
    scaled = [standardize(part, "y", stats, "label") for part in (train, test)]
    options = {"loss": "l1", "optimizer": "adam", "lr": 0.001, "run": "graph_head", **kw}
    fit = fit_mlp(scaled[0], [dim, *hidden, 1], key="graph_id", col="emb", test=scaled[1], **options)
    layers = test.sparkSession.sparkContext.broadcast(layer_list(fit.arrays))
    mu, sigma = stats.first()
    score = row_function(lambda x: forward(x, layers.value) * sigma + mu)
    return fit, test.select("graph_id", score("emb")[0].alias("pred"), "y")
