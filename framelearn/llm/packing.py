"""Packing token pieces into sequences: best fit decreasing, then a swap-based local search.

Only a piece's length matters for where it fits, and there are at most
``capacity`` lengths. So the packing is planned on the counts per length: bins
with the same contents are one pattern with a count. Best fit decreasing fills
patterns a length at a time; the local search then exchanges pieces one for
one, two for one, or moves them between underfull patterns, each time
increasing the sum of squared fills, until bins empty. The plan says which ranks
of each length go to which bins; the pieces are ranked on the executors and
look up their place. No piece passes through the driver.
"""

from __future__ import annotations

import array
import json
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelearn.llm.common import by_batch, narrow, stored, workspace
from framelearn.operators.bpe import PIECES as PIECE_PATTERN
from framelearn.plans.scale import order_hash, running_total

CAPACITY = 1024
END_ID = 2

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)
PIECES_WITH_IDS = T.StructType([*PIECES.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])


# --- tokens ----------------------------------------------------------------


def _little(ids: list[int]) -> bytes:
    cells = array.array("I", ids)
    if sys.byteorder != "little":
        cells.byteswap()
    return cells.tobytes()


#: White space other than the blank and the line feed.
_ODD_SPACE = [chr(c) for c in (0x09, 0x0B, 0x0C, 0x0D, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_NEIGHBOURS = ["  ", " \n", "\n ", "\n\n"]


class TextEncoder:
    """Ids of a tokenizer file's text as little-endian 32-bit bytes.

    For a byte-level file whose merges are in the order of their ids the work is
    done by the rank encoder, which gives the same ids in a fraction of the time.
    The piece pattern looks ahead only to cut runs of white space, so texts
    without such runs are cut by a pattern that need not look ahead. Texts that
    hold the string of a special token go through the tokenizer itself.
    """

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_buffer(file)
        described = json.loads(file)
        self.special = [t["content"] for t in described.get("added_tokens") or []]
        self.runs, self.single = self._ranks(described)

    @staticmethod
    def _ranks(described: dict):
        pre, model = described.get("pre_tokenizer") or {}, described["model"]
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        if not plain or described.get("normalizer") or model.get("type") != "BPE" or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
            return None, None
        vocab = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        order = [vocab[a + b] for a, b in merges]
        if any(x >= y for x, y in zip(order, order[1:])):
            return None, None
        import tiktoken

        # the printable stand-ins of byte-level files: printable Latin-1 bytes stand for themselves, others follow from 256
        kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte_of = {chr(b): b for b in kept}
        byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(kept))}
        special = {t["content"] for t in described.get("added_tokens") or []}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in special}
        looking, plain = PIECE_PATTERN, PIECE_PATTERN.replace(r"\s+(?!\S)|\s+", r"\s")
        return tuple(tiktoken.Encoding("text", pat_str=p, mergeable_ranks=ranks, special_tokens={}).encode_ordinary for p in (looking, plain))

    def __call__(self, text: str) -> bytes:
        if self.runs is None or any(s in text for s in self.special):
            return _little(self.whole.encode(text, add_special_tokens=False).ids)
        if any(s in text for s in _NEIGHBOURS) or any(c in text for c in _ODD_SPACE):
            return _little(self.runs(text))
        return _little(self.single(text))


def _pieces(spark: SparkSession, file: bytes, capacity: int, end_id: int, with_ids: bool):
    shared = spark.sparkContext.broadcast({"file": file})
    end = _little([end_id])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        # a worker keeps the encoder with the broadcast value, until it gets a task of another job
        cache = shared.value
        if "encoder" not in cache:
            cache["encoder"] = TextEncoder(cache.pop("file"))
        encode = cache["encoder"]
        doc, piece, start, length, crc, ids = [], [], [], [], [], []
        for d, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = encode(text.as_py() or "") + end
            n = len(raw) // 4
            first = n if n <= capacity else n % capacity or capacity
            cuts = [0, *range(first, n + 1, capacity)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                part = raw[4 * a : 4 * b]
                doc.append(d)
                piece.append(k)
                start.append(a)
                length.append(b - a)
                crc.append(zlib.crc32(part))
                if with_ids:
                    ids.append(np.frombuffer(part, "<u4").astype(np.int32))
        columns = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        if with_ids:
            columns.append(pa.array(ids, pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, names=[f.name for f in (PIECES_WITH_IDS if with_ids else PIECES).fields])

    return by_batch(run)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of ``docs(doc_id, text)``.

    A document's ids are the tokenizer's followed by ``end_id``; those of a NULL
    or empty text are ``end_id`` alone. More than ``capacity`` ids are cut into
    pieces of ``capacity``, of which the first may be shorter. The tokenizer
    file is read once and travels with the tasks.
    """
    with open(tokenizer, "rb") as f:
        file = f.read()
    rows = narrow(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(_pieces(rows.sparkSession, file, capacity, end_id, with_ids), PIECES_WITH_IDS if with_ids else PIECES)


# --- the plan --------------------------------------------------------------


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing on counts: (lengths of one bin, number of such bins).

    Equal bins are treated together: a length goes to the fullest bins that it
    fits, as often as it fits into one, before the next fullest.
    """
    open_bins: dict[int, list[list]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r in open_bins if r >= length and open_bins[r]), default=None)
            if room is None:
                room, bins, have = capacity, (), left
            else:
                bins, have = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
            each = room // length
            full = min(have, left // each)
            if full:
                open_bins.setdefault(room - each * length, []).append([(*bins, *[length] * each), full])
                left -= full * each
            rest = have - full
            if rest and left and full < have:
                some = min(left, each)
                if some < each or not full:
                    open_bins.setdefault(room - some * length, []).append([(*bins, *[length] * some), 1])
                    left -= some
                    rest -= 1
            if rest and bins:
                open_bins.setdefault(room, []).append([bins, rest])
    found: Counter = Counter()
    for groups in open_bins.values():
        for bins, n in groups:
            found[tuple(sorted(bins, reverse=True))] += n
    return sorted(found.items(), reverse=True)


def _exchange(a: tuple[int, ...], b: tuple[int, ...], capacity: int):
    """The exchange from bin b to bin a that fills a most: (taken from b, given for it), or None.

    None, one or two pieces of b against none or one of a. Every exchange makes
    the sum of squared fills larger.
    """
    fill_a, fill_b = sum(a), sum(b)
    room = capacity - fill_a
    singles = sorted(set(b))
    own = Counter(b)
    pairs = [(x, y) for i, x in enumerate(singles) for y in singles[i:] if x != y or own[x] > 1]
    best = None
    for give in [(), *[(x,) for x in sorted(set(a))]]:
        for take in [*[(x,) for x in singles], *pairs]:
            more = sum(take) - sum(give)
            if 0 < more <= room and fill_a - fill_b + more > 0 and (best is None or more > best[0]):
                best = (more, take, give)
    return best and best[1:]


def _swap(bins: tuple[int, ...], out: tuple[int, ...], into: tuple[int, ...]) -> tuple[int, ...]:
    rest = Counter(bins)
    rest.subtract(out)
    return tuple(sorted([*rest.elements(), *into], reverse=True))


def local_search(plan: list[tuple[tuple[int, ...], int]], capacity: int, max_moves: int | None = None) -> list[tuple[tuple[int, ...], int]]:
    """Exchange pieces between underfull bins until the least number of bins is reached or nothing gains.

    Every exchange raises the sum of squared fills, so the search ends by itself; ``max_moves`` may stop it earlier.
    """
    bins = Counter(dict(plan))
    least = -(-sum(sum(p) * n for p, n in plan) // capacity)
    moves = 0
    stuck: set[tuple] = set()
    while (max_moves is None or moves < max_moves) and sum(bins.values()) > least:
        under = sorted((p for p, n in bins.items() if n and sum(p) < capacity), key=lambda p: (sum(p), p))
        moved = False
        for b in under:  # the emptiest bins give
            for a in reversed(under):  # the fullest receive
                if (a == b and bins[a] < 2) or sum(a) < sum(b) or (a, b) in stuck:
                    continue
                step = _exchange(a, b, capacity)
                if step is None:
                    stuck.add((a, b))
                    continue
                take, give = step
                times = bins[a] // 2 if a == b else min(bins[a], bins[b])
                bins[a] -= times
                bins[b] -= times
                bins[_swap(a, give, take)] += times
                emptied = _swap(b, take, give)
                if emptied:
                    bins[emptied] += times
                bins += Counter()
                moves, moved = moves + 1, True
                break
            if moved:
                break
        if not moved:
            break
    return sorted(bins.items(), reverse=True)


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY, max_moves: int | None = None) -> list[tuple[tuple[int, ...], int]]:
    return local_search(best_fit(counts, capacity), capacity, max_moves)


def _places(plan: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """Sorted (length, first rank) with the sequence of that rank and the offset; later ranks count on."""
    used: Counter = Counter()
    rows, first = [], 0
    for bins, n in plan:
        offset = 0
        for length in bins:
            rows.append((length, used[length], first, offset))
            used[length] += n
            offset += length
        first += n
    rows.sort()
    return tuple(np.array([r[i] for r in rows], dtype=np.int64) for i in range(4))


_RANK_BITS = 48


def place(pieces: DataFrame, capacity: int = CAPACITY, max_moves: int | None = None) -> DataFrame:
    """Add sequence_id (0..) and offset to ``pieces(doc_id, piece, length, ids_crc32, ...)``.

    The pieces are read twice: to count lengths and to place them. Ranks follow
    a hash of doc_id, piece and checksum; rows equal in these are
    interchangeable. An empty table gives an empty one.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    lengths, ranks, sequences, offsets = _places(packing_plan(counts, capacity, max_moves))
    starts = (lengths << _RANK_BITS) + ranks
    keyed = pieces.withColumn("_hash", order_hash("doc_id", "piece", "ids_crc32"))
    ranked = running_total(keyed, ["_hash"], F.lit(1), ["length"], "_rank", rows=sum(counts.values()), hashed=True).drop("_hash")
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
        at = np.searchsorted(starts, (length << _RANK_BITS) + rank, side="right") - 1
        kept = [batch.column(i) for i, f in enumerate(batch.schema) if f.name != "_rank"]
        kept += [pa.array(sequences[at] + rank - ranks[at]), pa.array(offsets[at])]
        return pa.RecordBatch.from_arrays(kept, names=schema.names)

    return ranked.mapInArrow(by_batch(run), schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, max_moves: int | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Every row is a document, whatever its id (NULL and repeated ids included);
    NULL and empty texts are the end id alone; an empty table gives no pieces;
    other columns are not read.
    """
    folder = workspace(docs.sparkSession, "pieces")
    pieces = stored(token_pieces(docs, tokenizer, capacity, end_id, with_ids), folder)
    return place(pieces, capacity, max_moves)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids, doc_starts of ``pack(..., with_ids=True)``: at most ``capacity`` ids are gathered for each."""
    cells = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = packed.groupBy("sequence_id").agg(cells.alias("c"))
    return rows.select(
        "sequence_id", F.flatten(F.transform("c", lambda x: x["ids"])).alias("ids"), F.transform("c", lambda x: x["offset"]).alias("doc_starts")
    )
