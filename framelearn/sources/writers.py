"""Writing parameters, text and batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save_params(params: DataFrame, path: str) -> None:
    """Write a parameter table; the folder is made when missing."""
    params.write.mode("overwrite").parquet(path)


def write_text(df: DataFrame, path: str, col: str = "text", by: Sequence[str] = ()) -> None:
    """One line per line of text, in as many files as there are partitions; a folder per value of ``by``."""
    writer = df.select(F.col(col).cast("string").alias("value"), *by).write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).text(path)


def save_graphs(graphs: DataFrame, nodes: DataFrame, edges: DataFrame, path: str) -> None:
    for name, df in (("graphs", graphs), ("nodes", nodes), ("edges", edges)):
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def save_split(df: DataFrame, path: str, by: str = "split") -> None:
    """A table laid out by split, so that reading one split skips the other's files."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)
