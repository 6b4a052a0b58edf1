"""Slices, splits, shuffles and batches by position.

Positions are found by counting key ranges, so a split or slice is a filter on
the key and needs no sort of the table; numbering rows for batches sorts inside
key ranges only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelearn.functions.columns import let
from framelearn.plans.scale import below, dense_index, key_at_rank, order_hash


def _from(df: DataFrame, order: Sequence[str], rank: int, hashed: bool = False) -> Column | None:
    """Condition for rows at position ``rank`` or later; None when there are none."""
    key = key_at_rank(df, order, rank, hashed=hashed)
    return None if key is None else ~below(order, key, df.schema)


def slice_rows(df: DataFrame, order: Sequence[str], lo: int = 0, hi: int | None = None) -> DataFrame:
    """Rows at positions ``lo <= i < hi``; negative positions count from the end."""
    if lo < 0 or (hi is not None and hi < 0):
        n = df.count()
        lo = max(0, n + lo) if lo < 0 else lo
        hi = max(0, n + hi) if hi is not None and hi < 0 else hi
    if hi is not None and hi <= lo:
        return df.limit(0)
    out = df
    if lo > 0:
        start = _from(df, order, lo)
        if start is None:
            return df.limit(0)
        out = out.filter(start)
    if hi is not None:
        end = _from(df, order, hi)
        if end is not None:
            out = out.filter(~end)
    return out


def head(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return slice_rows(df, order, 0, n)


def tail(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return slice_rows(df, order, -n)


def split_sequential(
    df: DataFrame, order: Sequence[str], share: float = 0.8, hashed: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The first ``int(share * n)`` rows in order, and the rest."""
    cut = int(share * df.count())
    later = _from(df, order, cut, hashed)
    if later is None:
        return df, df.limit(0)
    return df.filter(~later), df.filter(later)


def split_random(df: DataFrame, key: Sequence[str], share: float = 0.8, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """A seeded split with exactly ``int(share * n)`` rows in the first part.

    The rows with the smallest key hashes come first; only the hash at the cut is
    searched for, the rows themselves are not moved.
    """
    hashed = df.withColumn("_h", order_hash(*key, seed=seed))
    first, rest = split_sequential(hashed, ["_h", *key], share, hashed=True)
    return first.drop("_h"), rest.drop("_h")


def with_split(df: DataFrame, key: Sequence[str], share: float = 0.8, seed: int | None = None) -> DataFrame:
    """Both parts in one table, marked ``train`` or ``test`` in ``split``."""
    order = list(key) if seed is None else ["_h", *key]
    base = df if seed is None else df.withColumn("_h", order_hash(*key, seed=seed))
    later = _from(base, order, int(share * base.count()), hashed=seed is not None)
    mark = F.lit("train") if later is None else F.when(later, F.lit("test")).otherwise(F.lit("train"))
    return base.withColumn("split", mark).drop("_h")


def split_by_threshold(df: DataFrame, key: Sequence[str], share: float = 0.8, seed: int = 0) -> DataFrame:
    """A split by hash value alone: no pass over the data, sizes only nearly exact."""
    train = order_hash(*key, seed=seed) < F.lit(int(share * 2**60))
    return df.withColumn("split", F.when(train, F.lit("train")).otherwise(F.lit("test")))


def shuffle_rows(df: DataFrame, key: Sequence[str], seed: int = 0, epoch: int = 0, name: str = "idx", **kw) -> DataFrame:
    """Add each row's place in the order of a seeded hash; another epoch gives another order."""
    hashed = df.withColumn("_h", order_hash(*key, seed=seed, epoch=epoch))
    return dense_index(hashed, ["_h", *key], name=name, hashed=True, **kw).drop("_h")


def sample_n(df: DataFrame, key: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` rows picked by a seeded hash; the same seed picks the same rows."""
    return df.orderBy(order_hash(*key, seed=seed), *key).limit(n)


def top_n(df: DataFrame, value: str, n: int, ties: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows with the largest value (per group), ranked from 1; ties go to the smaller key.

    Each task drops what cannot be among its first ``n`` before the shuffle.
    """
    if not by:
        best = df.orderBy(F.desc(value), *ties).limit(n)
        return dense_index(best.withColumn("_v", -F.col(value)), ["_v", *ties], name="rank").withColumn(
            "rank", F.col("rank") + 1
        ).drop("_v")
    over = Window.partitionBy(*by).orderBy(F.desc(value), *ties)
    return df.withColumn("rank", F.row_number().over(over).cast("long")).filter(F.col("rank") <= n)


def assign_batches(
    df: DataFrame,
    key: Sequence[str],
    size: int,
    drop_last: bool = False,
    shuffle: bool = False,
    seed: int = 0,
    epoch: int = 0,
    **kw,
) -> DataFrame:
    """Add ``batch_id``: ``size`` consecutive rows each, in key order or in seeded hash order."""
    rows = df.count()
    if shuffle:
        placed = shuffle_rows(df, key, seed, epoch, name="_idx", rows=rows, **kw)
    else:
        placed = dense_index(df, key, name="_idx", rows=rows, **kw)
    if drop_last:
        placed = placed.filter(F.col("_idx") < rows // size * size)
    return placed.withColumn("batch_id", F.floor(F.col("_idx") / size).cast("long")).drop("_idx")


# --- shuffles without a sort ------------------------------------------------

#: Modulus and multiplier of the keyed permutation's mixing; products of two residues stay below 2**63.
MIX_MODULUS, MIX_FACTOR = 2**31 - 1, 48_271

#: Rounds of one pass, and the most passes of a place that leaves the table's positions.
ROUNDS, WALKS = 4, 16


def permutation_plan(n: int, seed: int, epoch: int) -> tuple[int, int, list[tuple[int, int]], int]:
    """Sides ``a`` and ``b`` of the grid that the positions lie in, keys of the rounds, and passes."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    b = max(1, -(-n // a))
    keys = [tuple((seed * 1_000_003 + epoch * 7_919 + 2 * k + side + 1) * 69_621 % MIX_MODULUS for side in (0, 1)) for k in range(ROUNDS)]
    return a, b, keys, min(WALKS, a * b - n + 1)


def permuted(pos: Column, n: int, seed: int = 0, epoch: int = 0) -> Column:
    """A keyed permutation of the positions 0..n-1: arithmetic on one row, no sort and no shuffle.

    A position is a cell of an a x b grid with few cells more than ``n``. Each round
    turns the row by a mixture of the column and the column by one of the row,
    which is one to one; a place beyond the last position goes through again. Among
    the fewer than sqrt(n) + 1 such cells 16 passes in a row do not happen in practice; if they did, it is an error.
    """
    a, b, keys, walks = permutation_plan(n, seed, epoch)

    def mixed(x: Column, key: Column) -> Column:
        h = (x % MIX_MODULUS * MIX_FACTOR + key) % MIX_MODULUS
        for _ in range(2):
            h = (h * h % MIX_MODULUS + h * MIX_FACTOR + 11) % MIX_MODULUS
        return h

    rounds = F.array(*[F.struct(F.lit(x).cast("long").alias("x"), F.lit(y).cast("long").alias("y")) for x, y in keys])

    def once(v: Column) -> Column:
        def turned(s: Column, k: Column) -> Column:
            left = (s["l"] + mixed(s["r"], k["x"])) % a
            return let(left, lambda x: F.struct(x.alias("l"), ((s["r"] + mixed(x, k["y"])) % b).alias("r")))

        start = F.struct((v % a).alias("l"), F.floor(v / a).cast("long").alias("r"))
        return F.aggregate(rounds, start, turned, lambda s: s["r"] * a + s["l"])

    found = once(pos.cast("long"))
    if walks > 1:
        found = F.aggregate(F.sequence(F.lit(2), F.lit(walks)), found, lambda v, _: F.when(v >= n, once(v)).otherwise(v))
    return let(found, lambda v: F.when(v >= n, F.raise_error(F.lit("the permutation left its positions")).cast("long")).otherwise(v))


def permuted_batches(placed: DataFrame, pos: str, n: int, size: int, seed: int = 0, epoch: int = 0, drop_last: bool = False) -> DataFrame:
    """Add ``idx`` and ``batch_id`` of an epoch to rows numbered once, 0..n-1, in ``pos``: a projection.

    ``dense_index`` numbers the rows, once for all epochs.
    """
    dealt = placed.withColumn("idx", permuted(F.col(pos), n, seed, epoch))
    if drop_last:
        dealt = dealt.filter(F.col("idx") < n // size * size)
    return dealt.withColumn("batch_id", F.floor(F.col("idx") / size).cast("long"))


def nth_batch(df: DataFrame, key: Sequence[str], size: int, k: int) -> DataFrame:
    """The k-th batch in key order with its ``batch_id``: a filter on the key, no row is numbered."""
    return slice_rows(df, key, k * size, (k + 1) * size).withColumn("batch_id", F.lit(k).cast("long"))


def batch(df: DataFrame, k: int) -> DataFrame:
    """The k-th batch of a table with batch numbers."""
    return df.filter(F.col("batch_id") == k)
