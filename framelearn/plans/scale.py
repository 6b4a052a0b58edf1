"""Plan shapes that hold when the data grows or one key holds a large share.

* ``fits`` / ``maybe_broadcast``  a side is broadcast only after its size is measured
* ``lookup_join``                 join to a table with unique keys; hot keys get their own path
* ``chunk_lookup``                look up a column, or the elements of an array column, without shuffling the rows' keys
* ``key_at_rank``                 the key at a position in the order, without sorting the table
* ``running_total``/``dense_index``  prefix sums and 0..n-1 ids without a one-task window
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelearn.functions.columns import let
from framelearn.session import keep, materialize

#: Largest side that is broadcast or brought to the driver.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

#: A key is hot when it holds this many rows; there are never more than HOT_PARTS hot keys.
HOT_ROWS = 1_000_000
HOT_PARTS = 1024

#: Elements and bytes that end a chunk of rows when a table beyond a broadcast is looked up.
CHUNK_ELEMENTS, CHUNK_BYTES = 4_000_000, 64 * 1024 * 1024

#: Rows that one key range aims at when positions are counted, and the most ranges there are.
ROWS_PER_BUCKET = 100_000
MAX_BUCKETS = 16_384


def _width(field: T.StructField) -> Column:
    col = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(col) + 16
    elif isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StringType):
            size = F.octet_length(F.array_join(col, "")) + 16 * F.size(col)
        else:
            size = 8 * F.size(col) + 16
    else:
        size = F.lit(8)
    return F.coalesce(size, F.lit(8)).cast("long")


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes, by one aggregate."""
    width = reduce(lambda a, b: a + b, [_width(f) for f in df.schema.fields])
    row = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return row[0], row[1]


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    rows, size = measured(df)
    return rows <= max_rows and size <= max_bytes


def maybe_broadcast(df: DataFrame, **limits) -> DataFrame:
    return F.broadcast(df) if fits(df, **limits) else df


def small_rows(df: DataFrame, what: str, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES):
    """Rows of a table whose size has been checked, on the driver."""
    if not fits(df, max_rows, max_bytes):
        raise ValueError(f"{what} is larger than {max_rows} rows or {max_bytes} bytes")
    return df.collect()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use every core when a scan gives fewer partitions than there are; else leave it alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def unnest(df: DataFrame, keep: Sequence, array, value: str, pos: str | None = None) -> DataFrame:
    """One row per array element, computing the array once.

    A plain explode makes the optimiser add a filter on the array's size below
    it, in which a computed array (a regular expression, a Python function) is
    computed a second time. The outer form with a filter on top gives the same
    rows without that.
    """
    at = pos or "_at"
    out = df.select(*keep, F.posexplode_outer(array).alias(at, value)).filter(F.col(at).isNotNull())
    return out if pos else out.drop(at)


def settle(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later steps see as a plain one, never as its expression.

    For arguments of Python functions that contain lambdas: merged into the call,
    they are at times left unplanned. The one-element explode keeps them apart.
    """
    return df.withColumn(name, F.explode_outer(F.array(value)))


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS, hot_parts: int = HOT_PARTS):
    """The ``hot_parts`` most frequent keys among those holding ``hot_rows`` rows: one pass over the table."""
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= hot_rows)
    return counts.orderBy(F.desc("n")).limit(hot_parts).select(*on).collect()


def list_like(column: pa.Array, elements: pa.Array, nullable: bool = True) -> pa.Array:
    """The elements in lists as long as those of the column, NULL where it is NULL."""
    kind = pa.list_(pa.field("element", elements.type, nullable))
    ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(column), 0))
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends.cast(pa.int32())])
    return pa.ListArray.from_arrays(offsets, elements, type=kind, mask=column.is_null())


def chunk_lookup(
    df: DataFrame, col: str, out: str, lookup: DataFrame, key: str, value: str, chunk: int = CHUNK_ELEMENTS, max_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Add ``out``: the column ``col`` with each value, or each element of an array, replaced by its ``value`` in ``lookup``, NULL where it has none.

    ``key`` is unique and not NULL in ``lookup``, which may be of any size. Rows are
    read once and kept as compressed chunks of about ``chunk`` elements, in which an
    element is a number into the chunk's list of distinct ones. Only these lists
    are joined to the table, so an element that fills the corpus meets it once a
    chunk; values come back by number. Rows are never told apart by keys of their
    own, which may repeat or be NULL.
    """
    kind, source = lookup.schema[value].dataType, df.schema[col].dataType
    listed = isinstance(source, T.ArrayType)
    at = df.columns.index(col)
    packed = T.StructType().add("_c", "long").add("_k", T.ArrayType(source.elementType if listed else source)).add("_b", "binary")

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, elements, size = TaskContext.get().partitionId() << 32, [], 0, 0

        def packed_chunk() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            column = rows.column(at).combine_chunks()
            kinds = (column.flatten() if listed else column).dictionary_encode()
            rows = rows.set_column(at, col, list_like(column, kinds, column.type.value_field.nullable) if listed else kinds)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(rows)
            names = pa.ListArray.from_arrays(pa.array([0, len(kinds.dictionary)], pa.int32()), kinds.dictionary)
            return pa.RecordBatch.from_arrays([pa.array([made], pa.int64()), names, pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["_c", "_k", "_b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            elements += len(batch.column(at).flatten()) if listed else batch.num_rows
            size += batch.nbytes
            if elements >= chunk or size >= max_bytes:
                yield packed_chunk()
                made, held, elements, size = made + 1, [], 0, 0
        if held:
            yield packed_chunk()

    chunks = keep(df.mapInArrow(pack, packed), "zstd")
    # an element is in a chunk once: no key is hot
    named = unnest(chunks, ["_c"], "_k", "_e", "_i").join(lookup.select(F.col(key).alias("_key"), F.col(value).alias("_v")), F.col("_e") == F.col("_key"))
    found = named.select(F.col("_c").alias("_d"), "_i", "_v")
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(kind) if listed else kind)])

    def replace(blobs: pa.Table, values: pa.Table) -> pa.Table:
        rows = pa.ipc.open_stream(blobs["_b"][0].as_buffer()).read_all()
        column = rows.column(at).combine_chunks()
        kinds = column.flatten() if listed else column
        places = np.full(len(kinds.dictionary), -1, np.int64)
        places[values["_i"].to_numpy()] = np.arange(values.num_rows)
        given, got = kinds.dictionary.take(kinds.indices), values["_v"].combine_chunks().take(pa.array(places, mask=places < 0)).take(kinds.indices)
        if listed:
            given, got = list_like(column, given, column.type.value_field.nullable), list_like(column, got)
        return rows.set_column(at, col, given).append_column(out, got)

    return chunks.select("_c", "_b").groupBy("_c").cogroup(found.groupBy("_d")).applyInArrow(replace, schema)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    hot_parts: int = HOT_PARTS,
    hot: Sequence | None = None,
    small: bool | None = None,
    kept: bool | None = None,
) -> DataFrame:
    """Join ``left`` to ``right``, whose ``on`` columns are unique and not NULL.

    A small right side is broadcast. Beyond that both sides shuffle on the key,
    except the few hot keys: their right rows (one per key) are broadcast, so a
    key that holds a third of the left side never meets in one task. ``hot`` may
    name the hot keys when they are known; otherwise one pass counts them. ``small``
    may say whether the right side fits a broadcast when that is known. With
    hot keys the left side is kept, so that its two parts do not compute it again;
    ``kept`` says that it is stored already (True), or is not and costly to run
    twice (False). Then it meets a large right side by ``chunk_lookup`` when there is
    one key of one type: its rows are stored once, in chunks, and none is shuffled by the key.
    """
    on = list(on)
    if fits(right, max_rows, max_bytes) if small is None else small:
        return left.join(F.broadcast(right), on, how)
    if kept is False:
        if len(on) == 1 and how in ("left", "inner") and left.schema[on[0]].dataType == right.schema[on[0]].dataType:
            return _chunk_join(left, right, on[0], how)
        left = keep(left)
    hot = hot_keys(left, on, hot_rows, hot_parts) if hot is None else list(hot)
    if not hot:
        return left.join(right, on, how)
    if kept is None:
        left = keep(left)
    schema = T.StructType([left.schema[c] for c in on])
    keys = F.broadcast(left.sparkSession.createDataFrame(hot, schema))
    cold_part = left.join(keys, on, "left_anti").join(right, on, how)
    hot_part = left.join(keys, on, "left_semi").join(F.broadcast(right.join(keys, on, "left_semi")), on, how)
    return cold_part.unionByName(hot_part)


def _chunk_join(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """The columns and rows of ``left.join(right, key, how)``, by ``chunk_lookup``."""
    others = [c for c in right.columns if c != key]
    values = right.filter(F.col(key).isNotNull()).select(F.col(key), F.struct(*[F.col(f"`{c}`") for c in others], F.lit(True).alias("_there")).alias("_r"))
    found = chunk_lookup(left, key, "_r", values, key, "_r")
    if how == "inner":
        found = found.filter(F.col("_r").isNotNull())
    return found.select(key, *[F.col(f"`{c}`") for c in left.columns if c != key], *[F.col("_r").getField(c).alias(c) for c in others])


def order_hash(*cols, seed: int = 0, epoch: int = 0) -> Column:
    """A 60-bit hash of the key columns that any engine can repeat."""
    parts = [c if isinstance(c, Column) else F.col(c) for c in cols]
    text = F.concat_ws(":", *[p.cast("string") for p in parts], F.lit(str(seed)), F.lit(str(epoch)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def uniform(*cols, seed: int = 0, stream: int = 0) -> Column:
    """A number in [0, 1) fixed by the key columns, not by the partition it is drawn in."""
    return order_hash(*cols, seed=seed, epoch=stream) / F.lit(float(2**60))


def gaussian(*cols, seed: int = 0, stream: int = 0) -> Column:
    """A standard normal number fixed by the key columns (Box-Muller)."""
    u = 1.0 - uniform(*cols, seed=seed, stream=2 * stream)
    v = uniform(*cols, seed=seed, stream=2 * stream + 1)
    return F.sqrt(-2.0 * F.log(u)) * F.cos(2.0 * F.pi() * v)


def _key(order: Sequence[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])


def _sorted_keys(keys) -> list[tuple]:
    """Keys in Spark's ascending order, where NULL comes first."""
    return sorted(keys, key=lambda k: tuple((v is not None, v) for v in k))


def _literal(values, schema: T.StructType, order: Sequence[str]) -> Column:
    parts = [F.lit(v).cast(schema[c].dataType).alias(c) for c, v in zip(order, values)]
    return parts[0] if len(parts) == 1 else F.struct(*parts)


def _sql_literal(value, kind: T.DataType) -> str:
    if value is None:
        return f"cast(NULL as {kind.simpleString()})"
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return f"cast({value} as {kind.simpleString()})"
    raw = str(value).encode().hex()
    return f"cast(cast(X'{raw}' as string) as {kind.simpleString()})"


def split_points(df: DataFrame, order: Sequence[str], buckets: int, rows: int, per_bucket: int = 16) -> list[tuple]:
    """At most ``buckets - 1`` keys that cut the order into near-equal ranges.

    A hash sample of the keys decides only how even the ranges are, never the result.
    """
    if buckets <= 1:
        return []
    want = buckets * per_bucket
    keys = df.select(*order)
    if rows > want:
        share = int(2**31 * min(1.0, want / rows))
        keys = keys.filter(F.xxhash64(*order).bitwiseAND(F.lit(2**31 - 1)) < share)
    found = _sorted_keys({tuple(r) for r in keys.limit(4 * want).collect()})
    step = max(1, len(found) // buckets)
    return found[step::step][: buckets - 1]


def range_bucket(points: list[tuple], schema: T.StructType, order: Sequence[str]) -> Column:
    """How many of the sorted points are <= the row's key, by binary search in one literal array.

    When the leading columns already tell the points apart, only they are
    compared; rows that tie on them share a range, which keeps the order right.
    """
    if not points:
        return F.lit(0)
    used = 1
    while used < len(order) and len({p[:used] for p in points}) < 0.9 * len(points):
        used += 1
    order, points = list(order)[:used], _sorted_keys({p[:used] for p in points})
    if used == 1:  # every key is at or above NULL, and a NULL key compares as below all others
        points = [p for p in points if p[0] is not None]
    if not points:
        return F.lit(0)
    kinds = [schema[c].dataType for c in order]
    if used == 1:
        cells = [_sql_literal(p[0], kinds[0]) for p in points]
    else:
        cells = [
            "named_struct(" + ", ".join(f"'{c}', {_sql_literal(v, k)}" for c, v, k in zip(order, p, kinds)) + ")" for p in points
        ]
    table, key = F.expr(f"array({', '.join(cells)})"), _key(order)
    steps = [1 << k for k in reversed(range(len(points).bit_length()))]

    def search(k: Column) -> Column:
        def onward(at: Column, step: Column) -> Column:
            return at + F.when(F.get(table, at + step - 1) <= k, step).otherwise(F.lit(0))

        return F.aggregate(F.array(*[F.lit(n) for n in steps]), F.lit(0), onward)

    return let(key, search)


HASH_RANGE = 1 << 60


def hash_bucket(col: str, buckets: int, lo: int = 0, hi: int = HASH_RANGE) -> Column:
    """Equal ranges of an ``order_hash``, which is spread evenly: plain arithmetic, no sample."""
    width = max(1, -(-(hi - lo) // buckets))
    return F.expr(f"cast((`{col}` - {lo}L) div {width}L as int)")


def key_at_rank(
    df: DataFrame, order: Sequence[str], rank: int, small: int = 100_000, buckets: int = 256, hashed: bool = False
):
    """The key at position ``rank`` (from 0) when ``df`` is sorted by ``order``.

    ``order`` must identify a row. Each round counts rows per key range and goes
    on with the one range that holds the position, so no row is shuffled and at
    most ``small`` keys reach the driver. ``hashed`` says that the first column
    is an ``order_hash``, whose ranges need no sample. None past the end.
    """
    current = df.select(*order)
    rows = current.count()
    if rank < 0 or rank >= rows:
        return None
    lo, hi = 0, HASH_RANGE
    while rows > small:
        even = hashed and hi - lo > buckets
        if even:
            bucket = hash_bucket(order[0], buckets, lo, hi)
        else:
            bucket = range_bucket(split_points(current, order, buckets, rows), df.schema, order)
        counts = {r[0]: r[1] for r in current.groupBy(bucket.alias("b")).count().collect()}
        for b in sorted(counts):
            if rank < counts[b]:
                break
            rank -= counts[b]
        if even:
            width = -(-(hi - lo) // buckets)
            lo, hi = lo + b * width, min(hi, lo + (b + 1) * width)
            current = current.filter(F.col(order[0]).between(lo, hi - 1))
        elif counts[b] == rows:
            raise ValueError(f"{list(order)} does not identify a row")
        else:
            current = current.filter(bucket == b)
        rows = counts[b]
    return _sorted_keys(tuple(r) for r in current.collect())[rank]


def below(order: Sequence[str], key, schema: T.StructType) -> Column:
    """Rows that sort before ``key``, NULL first; a single column stays a filter the scan can use."""
    if len(order) == 1:
        return F.lit(False) if key[0] is None else F.col(order[0]).isNull() | (F.col(order[0]) < _literal(key, schema, order))
    return _key(order) < _literal(key, schema, order)


def running_total(
    df: DataFrame,
    order: Sequence[str],
    value: Column | None = None,
    by: Sequence[str] = (),
    name: str = "idx",
    rows_per_bucket: int = ROWS_PER_BUCKET,
    rows: int | None = None,
    kind: str = "long",
    hashed: bool = False,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Add the sum of ``value`` over all earlier rows of the group (1 per row by default).

    ``order`` must identify a row within its group. Rows are put into key ranges
    of about ``rows_per_bucket``; a window runs inside a range only, and each
    range gets the total of the ranges before it. A table or group of any size
    is therefore spread over many tasks. ``hashed`` says that the first column is
    an ``order_hash``. ``keys_from`` may give the same ordering columns (and what
    ``value`` reads) from a cheaper table, which then serves the counting pass.
    """
    order, by = list(order), list(by)
    value = F.lit(1) if value is None else value
    rows = df.count() if rows is None else rows
    buckets = min(MAX_BUCKETS, -(-rows // rows_per_bucket))
    if hashed:  # ranges cost nothing here, so use the cores
        buckets = max(buckets, min(df.sparkSession.sparkContext.defaultParallelism, rows // 1000))
    before = (Window.unboundedPreceding, -1)
    if buckets <= 1:
        part = Window.partitionBy(*(by or [F.lit(0)])).orderBy(*order).rowsBetween(*before)
        return df.withColumn(name, F.coalesce(F.sum(value).over(part), F.lit(0)).cast(kind))
    counted = df if keys_from is None else keys_from
    if hashed:
        bucket = hash_bucket(order[0], buckets)
    else:
        bucket = range_bucket(split_points(counted, order, buckets, rows), df.schema, order)
    bucketed = df.withColumn("_b", bucket).withColumn("_v", value)
    totals = counted.withColumn("_b", bucket).withColumn("_v", value).groupBy(*by, "_b").agg(F.sum("_v").alias("_t"))
    # one row per range (and group): the window below never sees more ranges than MAX_BUCKETS
    over = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_b").rowsBetween(*before)
    totals = totals.withColumn("_o", F.coalesce(F.sum("_t").over(over), F.lit(0))).drop("_t")
    inside = Window.partitionBy(*by, "_b").orderBy(*order).rowsBetween(*before)
    ranked = bucketed.withColumn("_r", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    # totals of groups are stored, measured and broadcast if small: NULL-safe keys would shuffle the rows a second time
    totals = maybe_broadcast(materialize(totals)) if by else F.broadcast(totals)
    # every range has a total; the outer join only spares a NULL test that would search the range again
    a, b = ranked.alias("_ranked"), totals.alias("_totals")
    same = reduce(lambda x, y: x & y, [F.col(f"_ranked.{c}").eqNullSafe(F.col(f"_totals.{c}")) for c in [*by, "_b"]])
    joined = a.join(b, same, "left")
    return joined.select(*[F.col(f"_ranked.`{c}`") for c in df.columns], (F.col("_ranked._r") + F.col("_totals._o")).cast(kind).alias(name))


def dense_index(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), name: str = "idx", **kw) -> DataFrame:
    """Position 0..n-1 of each row in the order (within its group)."""
    return running_total(df, order, None, by, name, **kw)
