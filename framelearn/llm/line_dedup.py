"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches. Each batch's line hashes, counted per document, are
merge-anti-joined with the keys that the earlier runs have settled (found in
enough documents already) and what is left is added as a run of its own: a
table bucketed and sorted by hash, so that the merge shuffles the batch only.
When a level holds ``fanout`` runs, they are merged into one run of the next
level. A key is frequent when a run has settled it or its counts over all
runs reach the bar.
"""

from __future__ import annotations

import uuid
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelearn.llm.common import by_batch, discard, narrow, packed_rows, stored, unpacked, workspace
from framelearn.session import materialize

#: ASCII white space, stripped from both ends of a key.
SPACE = b" \t\n\x0b\x0c\r"

MIN_DOCS = 10
MIN_CHARS = 1
BATCHES = 4
FANOUT = 2

LINES = T.StructType(
    [
        T.StructField("t", T.BinaryType()),
        T.StructField("h", T.BinaryType()),
        T.StructField("at", T.ArrayType(T.IntegerType())),
        T.StructField("batch", T.IntegerType()),
    ]
)


def line_key(line: bytes) -> bytes:
    """A line as it is compared: ASCII white space stripped at both ends, A-Z lower-cased."""
    return line.strip(SPACE).lower()


def _line_rows(min_chars: int, batches: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        t, h, at, part = [], [], [], []
        for text in batch.column(0):
            raw = (text.as_py() or "").encode()
            name = xxhash.xxh3_128_digest(raw)
            places: dict[bytes, list[int]] = {}
            for i, line in enumerate(raw.split(b"\n")):
                key = line_key(line)
                if len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars):
                    places.setdefault(key, []).append(i)
            for key, where in places.items():
                t.append(name)
                h.append(xxhash.xxh3_128_digest(key))
                at.append(where)
                part.append(name[0] % batches)
        return pa.RecordBatch.from_arrays(
            [pa.array(t, pa.binary()), pa.array(h, pa.binary()), pa.array(at, pa.list_(pa.int32())), pa.array(part, pa.int32())],
            names=["t", "h", "at", "batch"],
        )

    return by_batch(run)


def line_rows(texts: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """One row per document and distinct key: text hash ``t``, key hash ``h``, the line numbers, the batch.

    ``texts`` has the one column of texts. Keys under ``min_chars`` code points give no row.
    """
    return texts.mapInArrow(_line_rows(min_chars, batches), LINES)


class LineRuns:
    """Levelled runs of (h, n): sorted, bucketed tables in the shared folder, newest level first."""

    def __init__(self, spark: SparkSession, folder: str, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark, self.folder, self.min_docs, self.fanout = spark, folder, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def absorb(self, keys: DataFrame) -> None:
        """Add one batch: a row per document and distinct key, column ``h``."""
        counts = keys.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
        for name in [n for level in self.levels for n in level]:
            settled = self.spark.table(name).filter(F.col("n") >= self.min_docs).select("h")
            counts = counts.join(settled, "h", "left_anti")
        self._add(counts, 0)

    def _add(self, run: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        dealt = run.select("h", "n").repartition(self.buckets, "h")
        dealt.write.bucketBy(self.buckets, "h").sortBy("h").option("path", f"{self.folder}/{name}").saveAsTable(name)
        if len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.levels[level], []
            self._add(self._sum(merged), level + 1)
            self._drop(merged)

    def _sum(self, names: list[str]) -> DataFrame:
        rows = reduce(DataFrame.unionByName, [self.spark.table(n) for n in names])
        return rows.groupBy("h").agg(F.sum("n").alias("n"))

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")
            discard(self.spark, f"{self.folder}/{name}")

    def frequent(self) -> DataFrame:
        """Keys found in at least ``min_docs`` documents of all batches so far."""
        names = [n for level in self.levels for n in level]
        return self._sum(names).filter(F.col("n") >= self.min_docs).select("h")

    def close(self) -> None:
        for names in self.levels:
            self._drop(names)
        self.levels = []


@F.pandas_udf(T.StringType())
def _without(text, dropped):
    import pandas as pd

    def cut(body, places):
        if body is None or places is None:
            return None
        gone = set(places)
        return "\n".join(line for i, line in enumerate(body.split("\n")) if i not in gone)

    return pd.Series([cut(b, p) for b, p in zip(text, dropped)], dtype=object)


@F.pandas_udf(T.BinaryType())
def _text_hash(text):
    import pandas as pd

    return pd.Series([xxhash.xxh3_128_digest((x or "").encode()) for x in text], dtype=object)


def drop_frequent_lines(
    docs: DataFrame,
    text: str = "text",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    counted: bool = True,
) -> DataFrame:
    """Every row of ``docs`` with its text cut, plus ``_n_lines`` and ``_n_dropped`` if ``counted``.

    A line's key is the line without ASCII white space at its ends, A-Z
    lower-cased. A key of at least ``min_chars`` code points that stands in at
    least ``min_docs`` rows loses all its lines in every row; the others stay,
    joined by a line feed. Each row counts as a document, repeated rows and ids
    included; ids are not read. A NULL or empty text is one empty line: NULL
    becomes empty. An empty table gives an empty one. All columns are kept,
    whatever their names. Equal texts share their hash, so copies are counted
    row by row but listed once.
    """
    spark = docs.sparkSession
    folder = workspace(spark, "lines")
    rows = stored(line_rows(narrow(docs, text=text), min_chars, batches), f"{folder}/rows", "batch")
    runs = LineRuns(spark, folder, min_docs, fanout)
    for k in range(batches):
        runs.absorb(rows.filter(F.col("batch") == k).select("h"))
    frequent = materialize(runs.frequent())
    runs.close()
    found = rows.select("t", "h", "at").join(frequent, "h", "left_semi").groupBy("t").agg(F.flatten(F.collect_set("at")).alias("drop"))
    body = F.coalesce(F.col("row").getField(text), F.lit(""))
    # the row alone is shuffled; its text is taken out again behind the join
    joined = packed_rows(docs).withColumn("t", _text_hash(body)).join(found, "t", "left").drop("t").withColumn("body", body)
    cut = _without(F.when(F.col("drop").isNotNull(), F.col("body")), F.col("drop"))
    kept = joined.withColumn("kept", F.coalesce(cut, F.col("body")))
    counts = [
        (F.octet_length("body") - F.octet_length(F.replace(F.col("body"), F.lit("\n"), F.lit(""))) + 1).cast("long").alias("_n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("_n_dropped"),
    ]
    return kept.select(*unpacked(docs.columns, **{text: F.col("kept")}), *(counts if counted else []))


def line_dedup(docs: DataFrame, **parameters) -> DataFrame:
    """The digest: doc_id, n_lines, n_dropped, kept_sha256 for every row (see ``drop_frequent_lines``)."""
    kept = drop_frequent_lines(narrow(docs, doc_id="doc_id", text="text"), **parameters)
    return kept.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))
