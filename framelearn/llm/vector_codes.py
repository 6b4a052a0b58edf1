"""Vector code compression: codebooks by a dual-tree Lloyd iteration in exact integers.

Vectors become integers (each component times ``scale``, rounded down) and are cut into
equal parts. Blocks of at most ``BLOCK`` vectors are built once and written as rows of a
table: for each part position a tree over the block's parts, with the box and the sum of
every node, and the parts themselves in the tree's order. A round sends the codebooks,
``entries`` short vectors a part with a tree of their own, to all blocks and goes down
both trees together:

* a pair of nodes is dropped when the least distance of its boxes is above the greatest
  distance of another pair of the same part node, and a single entry also when another
  one is nearer to every point of the part node's box;
* a part node with one entry left is assigned whole, by its cached sum;
* parts of leaves that stay uncertain are compared one by one, in integers.

All bounds are integers too, so nothing is lost to rounding and ties reach the leaves,
where the lower entry wins: the codes are those of comparing all parts with all entries.
A task returns one sum per entry, Spark adds them up, and only the codebooks
(parts * entries rows) come to the driver. Numbers whose squares could pass 64 bits are
held as Python integers of any size.

Defined cases: a vector that is NULL or empty, or holds a NULL, NaN or infinite component,
gives no row; vectors of differing lengths, or of a length that the parts do not divide, are an
error; repeated rows and ids are rows of their own (the codebook's first entries go by id,
NULL last, then by vector); fewer vectors than entries give that many entries; an empty
table gives no row; errors beyond a long stay at its greatest value; further columns of
any name are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelearn.llm.common import narrow, stored, workspace
from framelearn.plans.scale import lookup_join

#: Vectors of one block, parts of one leaf, and candidate pairs compared at once.
BLOCK, LEAF, PAIRS = 4096, 16, 1 << 17

_MOST = 2**63 - 1


# --- integers of any size -------------------------------------------------


def _whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles: int64 where squares of differences fit, else Python integers."""
    widest = 2.0 ** (30 - math.ceil(math.log2(max(1, values.shape[-1])) / 2))
    with np.errstate(over="ignore"):
        scaled = np.floor(values * float(scale))
    if not scaled.size or np.abs(scaled).max() < widest:
        return scaled.astype(np.int64)
    exact = [int(math.floor(x * scale)) if abs(x) < 2**40 else int(x) * scale for x in values.reshape(-1).tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


def _frozen(a: np.ndarray) -> bytes:
    if a.dtype == object:
        return b"o" + ",".join(map(str, a.reshape(-1))).encode()
    return b"i" + a.astype(np.int64).tobytes()


def _thawed(raw: bytes, width: int) -> np.ndarray:
    if raw[:1] == b"o":
        a = np.array([int(x) for x in raw[1:].decode().split(",")] if len(raw) > 1 else [], dtype=object)
    else:
        a = np.frombuffer(raw, np.int64, offset=1)
    return a.reshape(-1, width)


def _alike(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as Python integers when one is."""
    return (a.astype(object), b.astype(object)) if object in (a.dtype, b.dtype) else (a, b)


# --- trees ----------------------------------------------------------------


def _starts(n: int, level: int) -> np.ndarray:
    """First places of the 2^level nodes of a level; node i has the children 2i and 2i+1."""
    return (np.arange((1 << level) + 1) * n) >> level


class Tree:
    """A balanced tree over rows: an order, and each level's boxes and sums."""

    def __init__(self, rows: np.ndarray, order: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.rows, self.order, self.levels = rows, order, levels

    @classmethod
    def grow(cls, x: np.ndarray, leaf: int) -> Tree:
        n = len(x)
        depth = max(0, (n // leaf).bit_length() - 1)
        order = np.arange(n)
        for level in range(depth):
            at = _starts(n, level)
            halves = _starts(n, level + 1)
            for i in range(1 << level):
                own = order[at[i] : at[i + 1]]
                along = x[own, np.argmax(np.ptp(x[own], axis=0))]
                cut = halves[2 * i + 1] - at[i]
                order[at[i] : at[i + 1]] = own[np.argsort(along, kind="stable") if x.dtype == object else np.argpartition(along, cut)]
        rows = x[order]
        at = _starts(n, depth)[:-1]
        lo, hi, total = (f.reduceat(rows, at, axis=0) for f in (np.minimum, np.maximum, np.add))
        levels = [(lo, hi, total)]
        for _ in range(depth):
            lo, hi, total = np.minimum(lo[::2], lo[1::2]), np.maximum(hi[::2], hi[1::2]), total[::2] + total[1::2]
            levels.append((lo, hi, total))
        return cls(rows, order, levels[::-1])

    def frozen(self) -> dict:
        joined = [np.concatenate([level[k] for level in self.levels]) for k in range(3)]
        return {"rows": _frozen(self.rows), "places": self.order.astype(np.int32).tobytes(), **{k: _frozen(a) for k, a in zip(("lo", "hi", "total"), joined)}}

    @classmethod
    def thawed(cls, held: dict, width: int) -> Tree:
        parts = [_thawed(held[k], width) for k in ("lo", "hi", "total")]
        depth = len(parts[0]).bit_length()
        levels = [tuple(p[(1 << d) - 1 : (2 << d) - 1] for p in parts) for d in range(depth)]
        return cls(_thawed(held["rows"], width), np.frombuffer(held["places"], np.int32), levels)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = _alike(a, b)
    d = a - b
    return (d * d).sum(axis=1)


def _bounds(lo, hi, e_lo, e_hi) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance of two boxes, pair by pair."""
    lo, e_lo = _alike(lo, e_lo)
    hi, e_hi = _alike(hi, e_hi)
    above, below = lo - e_hi, e_lo - hi
    gap = np.maximum(np.maximum(above, below), 0)
    reach = np.maximum(np.abs(above), np.abs(below))
    return (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)


def _beaten(lo, hi, entry, other) -> np.ndarray:
    """Whether ``other`` is strictly nearer than ``entry`` to every point of the box.

    The difference of the two squared distances is linear in the point, so its
    greatest value lies in a corner that each component chooses by itself.
    """
    entry, other = _alike(entry, other)
    lo, hi = _alike(lo, hi)
    lo, entry = _alike(lo, entry)
    lean = entry - other
    corner = np.where(lean > 0, hi, lo)
    return ((2 * corner - entry - other) * lean).sum(axis=1) < 0


def assign(tree: Tree, book: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest entry of every row of ``tree`` (in its order), sums and counts by entry, and distances computed."""
    n, width, size = len(tree.rows), tree.rows.shape[1], len(book.rows)
    kind = object if object in (tree.rows.dtype, book.rows.dtype) else np.int64
    codes = np.zeros(n, np.int64)
    sums, counts = np.zeros((size, width), tree.rows.dtype), np.zeros(size, np.int64)
    p, e = np.zeros(1, np.int64), np.zeros(1, np.int64)
    p_level, e_level, last, work = 0, 0, len(book.levels), 0
    while True:
        if e_level < last:  # one level down in the tree of entries; below its leaves are single entries, by number
            e_level += 1
            if e_level < last:
                p, e = np.repeat(p, 2), (e[:, None] * 2 + np.arange(2)).reshape(-1)
            else:
                at = _starts(size, last - 1)
                many = at[e + 1] - at[e]
                p, e = np.repeat(p, many), book.order[np.repeat(at[e], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
        single = e_level == last
        e_lo, e_hi = (book.entries[e], book.entries[e]) if single else (book.levels[e_level][0][e], book.levels[e_level][1][e])
        lo, hi, total = tree.levels[p_level]
        least, most = _bounds(lo[p], hi[p], e_lo, e_hi)
        work += len(p)
        first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
        bar = np.minimum.reduceat(most, first)
        stay = least <= np.repeat(bar, np.diff(np.r_[first, len(p)]))
        if single:
            near = np.minimum.reduceat(np.where(most == np.repeat(bar, np.diff(np.r_[first, len(p)])), np.arange(len(p)), len(p)), first)
            stay &= ~_beaten(lo[p], hi[p], e_lo, e_lo[np.repeat(near, np.diff(np.r_[first, len(p)]))])
        p, e = p[stay], e[stay]
        if single:
            at = _starts(n, p_level)
            first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
            many = np.diff(np.r_[first, len(p)])
            sure = np.repeat(many == 1, many)
            for node, entry in zip(p[sure], e[sure]):  # whole nodes
                codes[at[node] : at[node + 1]] = entry
            np.add.at(sums, e[sure], total[p[sure]])
            np.add.at(counts, e[sure], at[p[sure] + 1] - at[p[sure]])
            p, e = p[~sure], e[~sure]
            if not len(p):
                return codes, sums, counts, work
        if p_level + 1 < len(tree.levels):
            p_level += 1
            # children in order of their number, each with all candidates of its parent
            first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
            many = np.repeat(np.diff(np.r_[first, len(p)]), 2)
            begin = np.repeat(first, 2)
            e = e[np.repeat(begin, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
            p = np.repeat((p[first][:, None] * 2 + np.arange(2)).reshape(-1), many)
        elif single:
            break
    # leaves that stay uncertain: every part against its leaf's candidates
    at = _starts(n, p_level)
    first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
    many = np.diff(np.r_[first, len(p)])
    sizes = at[p[first] + 1] - at[p[first]]
    ends = np.cumsum(sizes * many)
    step = 0
    while step < len(first):
        until = max(step + 1, int(np.searchsorted(ends, (ends[step - 1] if step else 0) + PAIRS, "right")))
        row = np.concatenate([np.repeat(np.arange(at[p[first[k]]], at[p[first[k]] + 1]), many[k]) for k in range(step, until)])
        entry = np.concatenate([np.tile(e[first[k] : first[k] + many[k]], sizes[k]) for k in range(step, until)])
        far = _squared(tree.rows[row], book.entries[entry]).astype(kind)
        work += len(row)
        begin = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        near = np.repeat(np.minimum.reduceat(far, begin), np.diff(np.r_[begin, len(row)]))
        best = np.minimum.reduceat(np.where(far == near, entry, size), begin)
        rows = row[begin]
        codes[rows] = best
        np.add.at(sums, best, tree.rows[rows])
        np.add.at(counts, best, 1)
        step = until
    return codes, sums, counts, work


def codebook(entries: np.ndarray) -> Tree:
    """A tree over the entries, with the entries by number beside it."""
    tree = Tree.grow(entries, 1)
    tree.entries = entries
    return tree


# --- Spark ----------------------------------------------------------------

_FIELDS = ("rows", "places", "lo", "hi", "total")
_TREE = f"struct<{', '.join(f'{f}: binary' for f in _FIELDS)}>"
_TREES = pa.list_(pa.struct([(f, pa.binary()) for f in _FIELDS]))


def _valid(df: DataFrame) -> DataFrame:
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return df.withColumn("x", F.col("x").cast("array<double>")).filter(F.size("x") > 0).filter(~bad)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _blocks(rows: DataFrame, width: int, parts: int, scale: int) -> DataFrame:
    """One row per block: ids, labels, and a tree for every part position."""
    ids, labels = (rows.schema[c].dataType.simpleString() for c in ("id", "label"))
    each = width // parts

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                own = batch.slice(at, BLOCK)
                x = _whole(_matrix(own["x"], width), scale)
                trees = [Tree.grow(x[:, k * each : (k + 1) * each], LEAF).frozen() for k in range(parts)]
                offsets = pa.array([0, own.num_rows], pa.int32())
                held = [pa.ListArray.from_arrays(offsets, own[c]) for c in ("id", "label")]
                yield pa.RecordBatch.from_arrays([*held, pa.array([trees], _TREES)], names=["ids", "labels", "trees"])

    return rows.mapInArrow(build, f"ids array<{ids}>, labels array<{labels}>, trees array<{_TREE}>")


def _trees(held: pa.Scalar, each: int) -> list[Tree]:
    return [Tree.thawed(tree, each) for tree in held.as_py()]


def _round(blocks: DataFrame, books, each: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Count and sum of the parts of every used entry: by task, then added up by Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        held = [codebook(b) for b in books.value]
        for batch in batches:
            for k in range(batch.num_rows):
                for part, (tree, book) in enumerate(zip(_trees(batch["trees"][k], each), held)):
                    _, sums, counts, _ = assign(tree, book)
                    for entry in np.flatnonzero(counts).tolist():
                        had = found.get((part, entry), (0, [0] * each))
                        found[part, entry] = (had[0] + int(counts[entry]), [a + int(b) for a, b in zip(had[1], sums[entry])])
        if found:
            columns = [[k[0] for k in found], [k[1] for k in found], [v[0] for v in found.values()], [[str(x) for x in v[1]] for v in found.values()]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["part", "entry", "n", "s"])

    def added(key, group):
        sums = [sum(map(int, column)) for column in zip(*group["s"].to_pylist())]
        return pa.table({"part": [key[0].as_py()], "entry": [key[1].as_py()], "n": [sum(group["n"].to_pylist())], "s": [[str(x) for x in sums]]}, schema=group.schema)

    kind = "part int, entry int, n long, s array<string>"
    rows = blocks.mapInArrow(partial, kind).groupBy("part", "entry").applyInArrow(added, kind).collect()
    return {(r["part"], r["entry"]): (r["n"], [int(x) for x in r["s"]]) for r in rows}


def _entries(rows: list[list[int]], each: int) -> np.ndarray:
    """Entries as int64, or as Python integers when they are beyond what int64 arithmetic holds."""
    if not rows or not each or max(abs(x) for r in rows for x in r) < 2 ** (30 - math.ceil(math.log2(max(1, each)) / 2)):
        return np.array(rows, np.int64).reshape(len(rows), each)
    return np.array(rows, dtype=object).reshape(len(rows), each)


def vector_codes(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
) -> tuple[DataFrame, list[list[list[int]]]]:
    """``(id, label, codes array<int>, error)`` of every valid vector, and the final codebooks by part and entry."""
    if entries > 65_536:
        raise ValueError("codebooks have at most 65536 entries, since they go to every task")
    spark, folder = vectors.sparkSession, workspace(vectors.sparkSession, "codes")
    rows = _valid(narrow(vectors, id=key, x=vector, label=label))
    ids, labels = (rows.schema[c].dataType.simpleString() for c in ("id", "label"))
    kind = f"id {ids}, label {labels}, codes array<int>, error long"
    sizes = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if sizes[0] is None:
        return spark.createDataFrame([], kind), [[] for _ in range(parts)]
    width, each = sizes[0], sizes[0] // parts
    if sizes[0] != sizes[1] or width % parts:
        raise ValueError(f"vectors have {sizes[0]} to {sizes[1]} components; all must have as many, and {parts} equal parts")
    first = rows.orderBy(F.asc_nulls_last("id"), "x").limit(entries).select("x").collect()
    start = _whole(np.array([r["x"] for r in first], float).reshape(len(first), width), scale)
    books = [[[int(v) for v in r[k * each : (k + 1) * each]] for r in start] for k in range(parts)]
    blocks = stored(_blocks(rows, width, parts, scale), f"{folder}/blocks")

    def sent():
        return spark.sparkContext.broadcast([_entries(b, each) for b in books])

    for _ in range(rounds):
        shared = sent()
        for (part, entry), (n, total) in _round(blocks, shared, each).items():
            books[part][entry] = [s // n for s in total]
        shared.unpersist()
    shared = sent()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [codebook(b) for b in shared.value]
        for batch in batches:
            for k in range(batch.num_rows):
                own = {c: batch[c][k] for c in ("ids", "labels")}
                n = len(own["ids"])
                codes, error = np.zeros((n, parts), np.int32), np.zeros(n, object)
                for part, (tree, book) in enumerate(zip(_trees(batch["trees"][k], each), held)):
                    found, _, _, _ = assign(tree, book)
                    codes[tree.order, part] = found
                    error[tree.order] += _squared(tree.rows, book.entries[found]).astype(object)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * parts), pa.array(codes.reshape(-1)))
                errors = pa.array([min(x, _MOST) for x in error], pa.int64())
                yield pa.RecordBatch.from_arrays([own["ids"].values, own["labels"].values, flat, errors], names=["id", "label", "codes", "error"])

    return stored(blocks.mapInArrow(coded, kind), f"{folder}/codes"), books


def codebooks_digest(books: list[list[list[int]]]) -> str:
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    return hashlib.sha256(text.encode()).hexdigest()


def codes_digest(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", **kw) -> DataFrame:
    """Per vector: id, code in hexadecimal, error, the error of all vectors of its label, and the codebooks' hash."""
    coded, books = vector_codes(vectors, key, vector, label, **kw)
    hexes = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    # labels may be NULL and one may hold most rows: sums are combined before the shuffle and joined by a key without NULLs
    named = coded.withColumn("_l", F.struct(F.col("label").isNull().alias("no"), F.col("label")))
    named = named.withColumn("_l", F.to_json("_l"))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_MOST).cast("decimal(38,0)")).cast("long")
    sums = named.groupBy("_l").agg(total.alias("label_error"))
    both = lookup_join(named, sums, ["_l"], "left")
    return both.select(F.col("id").alias(key), hexes.alias("code"), "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
