"""The batch operators on arriving data."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from framelearn.operators.text import encode, tokenize
from framelearn.plans.scale import BROADCAST_BYTES, BROADCAST_ROWS, fits


def file_stream(spark: SparkSession, path: str, schema, glob: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream, in arrival order."""
    reader = spark.readStream.schema(schema).format("parquet")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a folder as a stream, be it one file or a folder of files."""
    table = spark.read.parquet(f"{folder}/{name}")
    if [f.rsplit("/", 1)[-1] for f in table.inputFiles()] == [name]:
        return file_stream(spark, folder, table.schema, name)
    return file_stream(spark, f"{folder}/{name}", table.schema)


def encode_stream(
    docs: DataFrame,
    vocab: DataFrame,
    key: str = "doc_id",
    col: str = "text",
    bang: bool = False,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Arriving documents to id arrays with a fixed vocabulary, unknown tokens as ``<|unk|>``.

    The vocabulary must be within the broadcast limits: the look-up then is a
    projection and keeps no state. ``run_encoded`` takes a vocabulary of any size.
    """
    if not fits(vocab, max_rows, max_bytes):
        raise ValueError("the vocabulary is beyond a broadcast: use run_encoded, which joins it batch by batch")
    return encode(tokenize(docs.select(key, col), col, bang=bang), vocab, on_unknown="unk").select(key, "ids")


def run_encoded(
    docs: DataFrame, vocab: DataFrame, path: str, checkpoint: str, key: str = "doc_id", col: str = "text", bang: bool = False, **limits
) -> None:
    """Encode what has arrived with the batch operator and stop; the vocabulary may be of any size.

    Each micro-batch is written to a folder of its own, ``batch_id=<n>``, in
    overwrite mode, so a batch that is run again after a failure leaves no row twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        ids = encode(tokenize(batch.select(key, col), col, bang=bang), vocab, on_unknown="unk", **limits).select(key, "ids")
        ids.write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    writer = docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def encode_available(
    docs: DataFrame, vocab: DataFrame, path: str, checkpoint: str, key: str = "doc_id", col: str = "text", bang: bool = False,
    max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES,
) -> None:
    """Encode what has arrived into a Parquet folder and stop: in place by ``encode_stream`` while the
    vocabulary is within the limits, else batch by batch by ``run_encoded``."""
    limits = {"max_rows": max_rows, "max_bytes": max_bytes}
    if fits(vocab, **limits):
        run_available(encode_stream(docs, vocab, key, col, bang, **limits), path, checkpoint)
    else:
        run_encoded(docs, vocab, path, checkpoint, key, col, bang, **limits)


def windowed_metrics(
    scored: DataFrame,
    metrics: Mapping[str, Column],
    ts: str = "ts",
    window: str = "1 hour",
    delay: str = "10 minutes",
    by: Sequence[str] = (),
) -> DataFrame:
    """Metrics per event-time window; rows later than the delay are dropped, state is one row per window."""
    timed = scored.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    out = timed.groupBy(F.window(ts, window), *by).agg(
        F.count(F.lit(1)).alias("n_rows"), *[c.alias(name) for name, c in metrics.items()]
    )
    return out.select(F.col("window.start").alias("start"), *by, "n_rows", *metrics)


def running_metrics(
    scored: DataFrame,
    metrics: Sequence[str],
    batch_size: int,
    epoch: str = "epoch",
    batch: str = "batch_id",
    ts: str = "ts",
    delay: str = "10 minutes",
    first: int = 0,
) -> DataFrame:
    """``(epoch, batch, n_rows, <metric>, running_<metric>)`` while rows arrive, as ``running_metric`` gives for a table.

    ``metrics`` are numeric columns of the stream. A batch's mean leaves out NULLs;
    ``running_`` is the sum of the means so far divided by the number of batches
    so far, NULL where the batch has no value. Batches of an epoch are numbered
    from ``first`` and come out in that order, each once: a batch when it holds
    ``batch_size`` rows and all before it are out, and whatever is still open
    when the watermark has passed the epoch's newest row (a short last batch,
    or batches behind a number that never came). Rows without epoch, batch or
    time, and rows of a batch that is out, take no part; repeated rows count
    again. An empty stream gives no row.

    Every task sums its rows per batch before the shuffle, so an epoch's task
    gets a few rows per batch however long the batches are. The state is one row
    per open batch and one per epoch, in the RocksDB store that the query needs
    (``use_state_store``) and its checkpoint, so a restart goes on where it was.
    """
    names, k = list(metrics), len(metrics)
    used = scored.filter(F.col(epoch).isNotNull() & F.col(batch).isNotNull() & F.col(ts).isNotNull())
    rows = used.select(
        F.col(epoch).alias("e"), F.col(batch).cast("long").alias("b"), F.col(ts).cast("timestamp").alias("t"),
        *[F.col(m).cast("double").alias(f"m{j}") for j, m in enumerate(names)],
    )
    wanted = [("t", "max"), ([], "count_all"), *[(f"m{j}", how) for j in range(k) for how in ("sum", "count")]]

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if part.num_rows:
                found = pa.Table.from_batches([part]).group_by(["e", "b"]).aggregate(wanted)
                order = ["e", "b", "t_max", "count_all", *[f"m{j}_{how}" for j in range(k) for how in ("sum", "count")]]
                out = found.select(order).rename_columns(["e", "b", "t", "n", *[f"{c}{j}" for j in range(k) for c in "sc"]])
                yield from out.combine_chunks().to_batches()

    kind = scored.schema[epoch].dataType.simpleString()
    columns = "".join(f", s{j} double, c{j} long" for j in range(k))
    partial = rows.mapInArrow(combine, f"e {kind}, b long, t timestamp, n long{columns}").withWatermark("t", delay)
    partial = partial.withColumn("ms", F.unix_millis("t"))
    cells = ", ".join(f"s{j} double, c{j} long" for j in range(k))
    totals = ", ".join(f"t{j} double" for j in range(k))
    result = ", ".join(f"m{j} double, r{j} double" for j in range(k))

    class Running(StatefulProcessor):
        """``past``: the next batch to come out, batches out, newest time, open batches, and the sum of means per metric."""

        def init(self, handle) -> None:
            self.handle = handle
            self.open = handle.getMapState("open", "b long", f"n long, {cells}")
            self.past = handle.getValueState("past", f"next long, batches long, until long, held long, {totals}")

        def _past(self) -> list:
            return list(self.past.get() or [first, 0, -1, 0, *[0.0] * k])

        def _out(self, key: tuple, past: list, number: int, cell: tuple) -> list:
            """One batch comes out: ``past`` moves on and the batch's row is returned."""
            past[0], past[1] = number + 1, past[1] + 1
            row = [key[0], number, cell[0]]
            for j in range(k):
                total, count = cell[1 + 2 * j], cell[2 + 2 * j]
                if count:
                    past[4 + j] += total / count
                row += [total / count if count else None, past[4 + j] / past[1] if count else None]
            return row

        def _frame(self, rows: list) -> Iterator[pd.DataFrame]:
            if rows:
                values = [f"{c}{j}" for j in range(k) for c in "mr"]
                yield pd.DataFrame(rows, columns=["e", "b", "n", *values]).astype(dict.fromkeys(values, "Float64"))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            past, new = self._past(), {}
            for frame in rows:  # Spark renames columns that begin with an underscore here
                sums = [f"{c}{j}" for j in range(k) for c in "sc"]
                for b, ms, n, *values in frame[["b", "ms", "n", *sums]].itertuples(index=False, name=None):
                    if b >= past[0]:
                        cell = new.setdefault(int(b), [0, *[0.0, 0] * k])
                        cell[0] += int(n)
                        for j, v in enumerate(values):
                            if v is not None and v == v:  # a sum without values is missing
                                cell[1 + j] += float(v) if j % 2 == 0 else int(v)
                        past[2] = max(past[2], int(ms))
            known = set()  # touched batches that have a row in the state; each question to the store is a round trip
            if past[3]:
                for b, cell in new.items():
                    old = self.open.getValue((b,))
                    if old is not None:
                        known.add(b)
                        new[b] = [x + y for x, y in zip(cell, old)]
            done = []
            while past[3] or new:
                b = past[0]
                cell = new.get(b)
                if cell is None and past[3]:
                    cell = self.open.getValue((b,))
                    known |= {b} if cell is not None else set()
                if cell is None or cell[0] < batch_size:
                    break
                done.append(self._out(key, past, b, cell))
                new.pop(b, None)
                if b in known:
                    self.open.removeKey((b,))
                    past[3] -= 1
            for b, cell in new.items():
                self.open.updateValue((b,), tuple(cell))
                past[3] += b not in known
            self.past.update(tuple(past))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if past[3]:
                self.handle.registerTimer(past[2] + 1)
            yield from self._frame(done)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            past = self._past()
            left = sorted((b[0], tuple(cell)) for b, cell in self.open.iterator())
            done = [self._out(key, past, b, cell) for b, cell in left]
            self.open.clear()
            past[3] = 0
            self.past.update(tuple(past))
            yield from self._frame(done)

        def close(self) -> None:
            pass

    out = partial.groupBy("e").transformWithStateInPandas(Running(), f"e {kind}, b long, n long, {result}", "append", "EventTime")
    means = [F.col(f"{c}{j}").alias(p + m) for j, m in enumerate(names) for c, p in (("m", ""), ("r", "running_"))]
    return out.select(F.col("e").alias(epoch), F.col("b").alias(batch), F.col("n").alias("n_rows"), *means)


def use_state_store(spark: SparkSession) -> None:
    """Keep the state of new streams in RocksDB, which ``running_metrics`` needs; running streams are not touched."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what has arrived into a Parquet folder and stop; a restart goes on from the checkpoint."""
    writer = stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start(path).awaitTermination()
