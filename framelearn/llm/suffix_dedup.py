"""Removal of repeated byte strings: suffixes sorted bucket by bucket, long ties resolved by a difference cover.

A suffix counts by its first ``width`` bytes, a window. The bucket of a window is
the smallest hash among its ``GRAM``-byte runs, so equal windows share a bucket,
and neighbouring windows mostly do too: they travel together as one record, the
bytes that they span. Windows of a record that occurs twice are repeated; a
record whose bucket has no other record holds unique windows. Only records that
share a bucket with different ones are read again and sorted.

Each task sorts the suffixes of some buckets, a few megabytes of text. They are
sorted by their first bytes to the cover's period ``v``; what still ties is
told apart by precomputed ranks of the sample positions whose place modulo
``v`` lies in the cover: for any two places some shift under ``v`` takes both to
sample positions. Equal neighbours in the sorted order are repeated windows. A
bucket too large for one task is split by the windows' own hashes instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelearn.llm.common import by_batch, narrow, stored, workspace
from framelearn.session import materialize

#: Bytes of a repeated string.
WIDTH = 400
#: Bytes whose hashes choose the bucket.
GRAM = 32
#: Bytes of text that a task sorts at a time, and beyond which one bucket is split by window hashes.
TASK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
#: Bytes of text whose windows are cut together.
CHUNK = 2 << 20

#: A perfect difference set: every shift modulo 57 is the difference of two members.
COVER, PERIOD = (0, 1, 3, 13, 32, 36, 43, 52), 57

_MASK24 = np.uint64((1 << 24) - 1)
_RANDOM = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _shifts() -> np.ndarray:
    """For each pair of remainders the smallest shift that takes both into the cover."""
    table = np.full((PERIOD, PERIOD), -1, dtype=np.int64)
    for d in reversed(range(PERIOD)):
        members = [(c - d) % PERIOD for c in COVER]
        for a in members:
            table[a, members] = d
    if (table < 0).any():
        raise ValueError("the cover misses a difference")
    return table


# --- records ---------------------------------------------------------------


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` bytes (a power of two)."""
    h, base, m = _RANDOM[data], _BASE, 1
    while m < size:
        h = h[:-m] * np.uint64(base) + h[m:]
        base = base * base % (1 << 64)
        m *= 2
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _least_in_windows(key: np.ndarray, w: int) -> np.ndarray:
    """The least of each ``w`` neighbouring keys, by running minima inside blocks of ``w``."""
    n = len(key) - w + 1
    rows = -(-len(key) // w)
    padded = np.full(rows * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(key)] = key
    blocks = padded.reshape(rows, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def cut_records(pieces: list[bytes], width: int = WIDTH, gram: int = GRAM):
    """Records of some texts: (text number, first window, windows, bucket) arrays.

    A record is a longest run of neighbouring windows that choose the same place.
    """
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    if len(data) < width:
        return none
    hashes = _gram_hashes(data, gram)
    key = (hashes & ~_MASK24) | np.arange(len(hashes), dtype=np.uint64)
    least = (_least_in_windows(key, width - gram + 1) & _MASK24).astype(np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    owner = np.repeat(np.arange(len(pieces)), sizes)[: len(least)]
    at = np.arange(len(least))
    valid = at - first[owner] <= sizes[owner] - width
    starts = valid & np.concatenate(([True], (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]) | ~valid[:-1]))
    begin = np.flatnonzero(starts)
    if not len(begin):
        return none
    ends = np.concatenate((begin[1:], [len(least)]))
    # a run also ends where the text's last window lies
    ends = np.minimum(ends, first[owner[begin]] + sizes[owner[begin]] - width + 1)
    return owner[begin], begin - first[owner[begin]], ends - begin, hashes[least[begin]]


def _text_pieces(raw: bytes, width: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of a text such that each window lies in exactly one piece that starts it."""
    for a in range(0, max(1, len(raw) - width + 1), CHUNK):
        yield a, raw[a : a + CHUNK + width - 1]


RECORDS = "bucket bigint, r1 bigint, r2 bigint, t1 bigint, t2 bigint, start bigint, n bigint"


def _records(width: int):
    def emit(held) -> pa.RecordBatch:
        owner, start, n, bucket = cut_records([p for _, _, _, p in held], width)
        t1, t2, offset = (np.array([h[k] for h in held], dtype=np.int64) for k in range(3))
        digests = b"".join(
            xxhash.xxh3_128_digest(held[o][3][s : s + m + width - 1]) for o, s, m in zip(owner.tolist(), start.tolist(), n.tolist())
        )
        r = np.frombuffer(digests, np.int64).reshape(-1, 2)
        columns = [bucket.view(np.int64), r[:, 0], r[:, 1], t1[owner], t2[owner], offset[owner] + start, n]
        return pa.RecordBatch.from_arrays([pa.array(c.copy()) for c in columns], names=["bucket", "r1", "r2", "t1", "t2", "start", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for t1, t2, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                raw = (text.as_py() or "").encode()
                if len(raw) < width:
                    continue
                for offset, piece in _text_pieces(raw, width):
                    held.append((t1, t2, offset, piece))
                    size += len(piece)
                    if size >= CHUNK:
                        yield emit(held)
                        held, size = [], 0
        if held:
            yield emit(held)

    return run


# --- sorting ---------------------------------------------------------------


def _words_at(padded: np.ndarray) -> np.ndarray:
    """A view of the big-endian 8-byte number that begins at each byte."""
    return np.ndarray((len(padded) - 7,), dtype=">u8", buffer=padded, strides=(1,))


def cover_ranks(text: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the sample positions among themselves by at least ``depth`` bytes; equal ones share a rank."""
    n = len(text)
    sample = np.flatnonzero(np.isin(np.arange(n) % PERIOD, COVER))
    first = [words[sample + 8 * k].astype(np.uint64) for k in range(8)]
    order = np.lexsort(first[::-1])
    changed = np.zeros(len(sample), dtype=bool)
    for k in first:
        s = k[order]
        changed[1:] |= s[1:] != s[:-1]
    rank = np.zeros(n + 16 * PERIOD + depth, dtype=np.int64)
    rank[sample[order]] = np.cumsum(changed) + 1
    known, reach = PERIOD, 64  # ranks hold ``reach`` bytes; a multiple of the period under it leads to a sample position
    while reach < depth:
        a, b = rank[sample], rank[sample + known]
        order = np.lexsort((b, a))
        changed = np.concatenate(([False], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])))
        rank[sample[order]] = np.cumsum(changed) + 1
        reach += known
        known = reach // PERIOD * PERIOD
    return rank


def sorted_suffixes(text: np.ndarray, starts: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """``starts`` in the order of their suffixes, and the padded text's words.

    Suffixes are compared by at least ``width`` bytes: first by 64 bytes, eight at a time, then by the cover's ranks.
    """
    padded = np.concatenate((text, np.zeros(width + 16 * PERIOD + 64, np.uint8)))
    words = _words_at(padded)
    order = starts.copy()
    group = np.zeros(len(order), dtype=np.int64)  # the slot at which a slot's group of ties begins
    active = np.arange(len(order))
    for k in range(8):
        if not len(active):
            break
        key = words[order[active] + 8 * k].astype(np.uint64)
        moved = np.lexsort((key, group[active]))
        order[active] = order[active][moved]
        g, s = group[active], key[moved]  # groups are runs of slots, so their ids stay in place
        fresh = np.concatenate(([True], (g[1:] != g[:-1]) | (s[1:] != s[:-1])))
        group[active] = active[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        active = _ties(group, active)
    if not len(active):
        return order, words
    rank, shift = cover_ranks(text, words, width), _shifts()
    while len(active):
        g = group[active]
        head = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
        size = np.diff(np.concatenate((head, [len(g)])))
        pivot = np.repeat(order[active[head + size // 2]], size)
        own = order[active]
        d = shift[pivot % PERIOD, own % PERIOD]
        side = np.sign(rank[own + d] - rank[pivot + d])
        moved = np.lexsort((side, g))
        order[active] = own[moved]
        s = side[moved]
        fresh = np.concatenate(([True], (g[1:] != g[:-1]) | (s[1:] != s[:-1])))
        group[active] = active[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        active = _ties(group, active[s != 0])  # equal to the pivot: in place
    return order, words


def _ties(group: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Those slots whose group has more than one of them."""
    g = group[slots]
    if not len(g):
        return slots
    same = np.concatenate(([False], g[1:] == g[:-1], [False]))
    return slots[same[1:] | same[:-1]]


def repeated_starts(text: np.ndarray, starts: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """For each start whether its window stands at another start too."""
    order, words = sorted_suffixes(text, starts, width)
    equal = np.zeros(len(order) + 1, dtype=bool)  # slot k and the one before it
    pairs = np.arange(1, len(order))
    for k in [*range(0, width - 7, 8), *([width - 8] if width % 8 else [])]:
        if not len(pairs):
            break
        pairs = pairs[words[order[pairs] + k] == words[order[pairs - 1] + k]]
    equal[pairs] = True
    flag = np.zeros(len(text), dtype=bool)
    flag[order[equal[1:] | equal[:-1]]] = True
    return flag[starts]


FOUND = "t1 bigint, t2 bigint, a bigint, b bigint"


def _runs(flags: np.ndarray) -> np.ndarray:
    """Begin and end of each run of set flags."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edge.reshape(-1, 2)


def _sort_bucket(width: int):
    def run(rows: pa.Table) -> pa.Table:
        seen, keep = set(), []
        ids = list(zip(*(rows[c].to_pylist() for c in ("t1", "t2", "start", "n", "single"))))
        for i, row in enumerate(ids):
            if row[:3] not in seen:  # equal texts may have sent a record twice
                seen.add(row[:3])
                keep.append(i)
        texts = [rows["bytes"][i].as_py() for i in keep]
        text = np.frombuffer(b"".join(texts), np.uint8)
        offset = np.concatenate(([0], np.cumsum([len(t) for t in texts])[:-1])).astype(np.int64)
        count = np.array([ids[i][3] for i in keep], dtype=np.int64)
        begin = np.concatenate(([0], np.cumsum(count)[:-1]))
        starts = np.arange(count.sum()) - np.repeat(begin - offset, count)
        flags = repeated_starts(text, starts, width)
        out = [[], [], [], []]
        for k, i in enumerate(keep):
            t1, t2, start, n, single = ids[i]
            if single:
                for a, b in _runs(flags[begin[k] : begin[k] + n]).tolist():
                    for column, value in zip(out, (t1, t2, start + a, start + b)):
                        column.append(value)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["t1", "t2", "a", "b"])

    return run


# --- the job ---------------------------------------------------------------


def _fetch(width: int):
    """(t1, t2, text, wanted records) -> a row per record with its bytes; a text seen before in the task is skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            rows = [[] for _ in range(8)]
            size = 0
            for t1, t2, text, wanted in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("t1", "t2", "text", "wanted"))):
                name = t1.as_py(), t2.as_py()
                if name in seen:
                    continue
                seen.add(name)
                raw = text.as_py().encode()
                for w in wanted.as_py():
                    piece = raw[w["start"] : w["start"] + w["n"] + width - 1]
                    size += len(piece)
                    for column, value in zip(rows, (*name, w["start"], w["n"], w["single"], w["split"], w["bucket"], piece)):
                        column.append(value)
                if size > CHUNK:
                    yield _wanted_batch(rows)
                    rows, size = [[] for _ in range(8)], 0
            yield _wanted_batch(rows)

    return run


WANTED = "t1 bigint, t2 bigint, start bigint, n bigint, single boolean, split boolean, bucket bigint, bytes binary"


def _wanted_batch(rows) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.bool_()] * 2 + [pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names=[x.split()[0] for x in WANTED.split(", ")])


def _window_rows(width: int):
    """Records of split buckets -> a row per window: two hashes of its bytes, its place, whether its record is single."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        t1, t2, start, n, single = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("t1", "t2", "start", "n", "single"))
        raw = batch.column(batch.schema.get_field_index("bytes"))
        digests = b"".join(xxhash.xxh3_128_digest(memoryview(x.as_py())[k : k + width]) for x, m in zip(raw, n) for k in range(m))
        w = np.frombuffer(digests, np.int64).reshape(-1, 2)
        count = np.array(n, dtype=np.int64)
        begin = np.concatenate(([0], np.cumsum(count)[:-1])) if len(n) else np.zeros(0, np.int64)
        place = np.arange(count.sum()) - np.repeat(begin, count) + np.repeat(np.array(start, dtype=np.int64), count)
        columns = [w[:, 0].copy(), w[:, 1].copy(), np.repeat(np.array(t1, np.int64), count), np.repeat(np.array(t2, np.int64), count), place]
        return pa.RecordBatch.from_arrays(
            [*[pa.array(c) for c in columns], pa.array(np.repeat(np.array(single, bool), count))], names=["w1", "w2", "t1", "t2", "a", "single"]
        )

    return by_batch(run)


CUT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("kept", T.BinaryType()),
    ]
)


def removed_spans(n_bytes: int, single: list, found: list, width: int) -> np.ndarray:
    """Maximal runs of bytes under a repeated window: all windows repeat but those of single records, of which the found ones do."""
    n = n_bytes - width + 1
    if n <= 0:
        return np.zeros((0, 2), np.int64)
    change = np.zeros(n + 1, dtype=np.int32)
    change[0] = 1
    for r in single:
        change[r["start"]] -= 1
        change[r["start"] + r["n"]] += 1
    for r in found:
        change[r["a"]] += 1
        change[r["b"]] -= 1
    spans = _runs(np.cumsum(change[:-1]) > 0) + np.array([0, width - 1])
    if len(spans) < 2:
        return spans
    apart = np.concatenate(([True], spans[1:, 0] > spans[:-1, 1]))
    return np.column_stack((spans[apart, 0], spans[np.concatenate((apart[1:], [True])), 1]))


def _cut(width: int, digest: bool):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc, size, gone, spans_of, kept = [], [], [], [], []
        for d, text, single, found in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text", "single", "found"))):
            raw = (text.as_py() or "").encode()
            spans = removed_spans(len(raw), single.as_py() or [], found.as_py() or [], width).tolist()
            left = b"".join(raw[a:b] for a, b in zip([0, *[s[1] for s in spans]], [*[s[0] for s in spans], len(raw)]))
            doc.append(d.as_py())
            size.append(len(raw))
            gone.append(len(raw) - len(left))
            spans_of.append(len(spans) if digest else [{"start": a, "end": b} for a, b in spans])
            kept.append(hashlib.sha256(left).hexdigest() if digest else left)
        kinds = [pa.int64()] * 4 + [pa.string()] if digest else [pa.int64()] * 3 + [pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
        names = DIGEST.names if digest else CUT.names
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((doc, size, gone, spans_of, kept), kinds)], names=names)

    return by_batch(run)


DIGEST = T.StructType([*CUT.fields[:3], T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())])


def _repeats(docs: DataFrame, width: int, task_bytes: int, bucket_bytes: int, digest: bool) -> DataFrame:
    spark = docs.sparkSession
    texts = narrow(docs, doc_id="doc_id", text="text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("t1"),
        F.xxhash64(F.lit(1), F.coalesce("text", F.lit(""))).alias("t2"),
    )
    folder = workspace(spark, "suffixes")
    # one row per distinct record, combined before the shuffle: its occurrences, and the place of one
    cut = texts.select("t1", "t2", "text").mapInArrow(_records(width), RECORDS)
    records = cut.groupBy("bucket", "r1", "r2").agg(
        F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("t1", "t2", "start", "n")]
    )
    records = stored(records.drop("r1", "r2"), f"{folder}/records")
    # buckets in which a record that occurs once meets another one
    sizes = records.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("kinds"), F.count(F.when(F.col("copies") == 1, 1)).alias("singles"), F.sum(F.col("n") + width - 1).alias("bytes")
    )
    sizes = materialize(sizes.filter("kinds > 1 and singles > 0").select("bucket", "bytes"))
    total = sizes.agg(F.sum("bytes").alias("b")).first()["b"] or 0
    tasks = max(1, -(-total // task_bytes), min(int(spark.conf.get("spark.sql.shuffle.partitions")), total >> 18))
    single = F.col("copies") == 1
    wanted = records.join(sizes, "bucket").select(
        "t1", "t2", F.struct("start", "n", single.alias("single"), (F.col("bytes") > bucket_bytes).alias("split"), "bucket").alias("w")
    )
    wanted = wanted.groupBy("t1", "t2").agg(F.collect_list("w").alias("wanted"))
    fetched = texts.join(wanted, ["t1", "t2"]).select("doc_id", "t1", "t2", "text", "wanted").mapInArrow(_fetch(width), WANTED)
    fetched = stored(fetched, f"{folder}/fetched")
    sorts = fetched.filter("not split").withColumn("task", F.pmod(F.hash("bucket"), F.lit(int(tasks))))
    found = sorts.groupBy("task").applyInArrow(_sort_bucket(width), FOUND)
    # buckets beyond a task: windows meet by their own hashes, equal windows of one place counted once
    windows = fetched.filter("split").mapInArrow(_window_rows(width), "w1 bigint, w2 bigint, t1 bigint, t2 bigint, a bigint, single boolean").distinct()
    often = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w1", "w2")
    split = windows.filter("single").join(often, ["w1", "w2"]).select("t1", "t2", "a", (F.col("a") + 1).alias("b"))
    runs = found.unionByName(split).groupBy("t1", "t2").agg(F.collect_list(F.struct("a", "b")).alias("found"))
    singles = records.filter(single).groupBy("t1", "t2").agg(F.collect_list(F.struct("start", "n")).alias("single"))
    joined = texts.join(singles, ["t1", "t2"], "left").join(runs, ["t1", "t2"], "left").select("doc_id", "text", "single", "found")
    return joined.mapInArrow(_cut(width, digest), DIGEST if digest else CUT)


def remove_repeats(docs: DataFrame, width: int = WIDTH, task_bytes: int = TASK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans and the kept bytes of every row of ``docs(doc_id, text)``.

    Texts are UTF-8 bytes. A byte goes when a string of ``width`` bytes over it
    also starts elsewhere, in any row, overlapping or not; no string crosses
    rows. A NULL or empty text has no bytes; repeated rows remove each other
    whole when they have ``width`` bytes; ids (NULL, repeated) are not read; an
    empty table gives an empty one; other columns are not read. ``width`` must
    be over the bucket's ``GRAM`` bytes.
    """
    if width <= max(GRAM, 64):
        raise ValueError("width must be over 64")
    return _repeats(docs, width, task_bytes, bucket_bytes, False)


def repeats_digest(docs: DataFrame, width: int = WIDTH, task_bytes: int = TASK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: ``remove_repeats`` with a checksum for the bytes."""
    return _repeats(docs, width, task_bytes, bucket_bytes, True)
