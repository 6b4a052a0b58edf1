"""Shared helpers: working folders in the shared store, task-side batches, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelearn.session import materialize, shared_dir, tidy


def workspace(spark: SparkSession, what: str) -> str:
    """A new folder for one run: below the folder that all executors share, in one named by the application."""
    return f"{shared_dir(spark).rstrip('/')}/framelearn-llm/{spark.sparkContext.applicationId}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and read it back: the lineage is cut and any executor can read it again."""
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``workspace`` named, through Hadoop's file systems."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def by_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]):
    """A function for ``mapInArrow`` that treats each batch alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if out is not None:
                yield out

    return run


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, under the operator's own names, so that no other column can clash."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def packed_rows(df: DataFrame) -> DataFrame:
    """Each row as one struct, ``row``, beside which an operator may put columns of any name."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unpacked(columns: list[str], **changed) -> list:
    """The columns of ``row`` again, with ``changed`` ones in their place."""
    return [(changed[c] if c in changed else F.col("row").getField(c)).alias(c) for c in columns]


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows (node, root), root the smallest node of each component.

    Alternates "every neighbour points at the smallest one" from the larger and
    the smaller side until nothing moves; every round is one grouped pass over
    rows of two numbers, combined before the shuffle, and no list of neighbours
    is ever built. Rounds are checkpointed. The number of rounds grows with the
    logarithm of the longest path. Nodes without an edge are not returned.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    pairs = materialize(pairs)
    for _ in range(max_rounds):
        # large star: each neighbour of u that is larger than u points at the smallest of u and its neighbours
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = pairs.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # small star: u and all its smaller neighbours point at the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        small = materialize(small)
        moved = small.join(pairs, ["u", "v"], "left_anti").limit(1).count()
        if not moved and small.count() == pairs.count():
            pairs = small
            break
        pairs = small
        del both, least, large, small
        tidy(pairs.sparkSession)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())
