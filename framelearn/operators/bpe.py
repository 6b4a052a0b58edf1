"""Byte-pair merges: learn them from word counts, apply them, and turn them back.

A word is kept as a string of symbols between two control characters, so one
merge is a plain ``replace`` and a pair count is one grouped sum over distinct
words. Words are counted before anything else: the corpus is read once.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import re
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelearn.functions.columns import let
from framelearn.operators.text import collect_positions, decode_arrays, encode
from framelearn.plans.scale import lookup_join, settle, small_rows, unnest
from framelearn.session import discard, materialize, scratch

#: Fixed value: the mark for the end of a word.
END_OF_WORD = "</w>"

_OPEN, _CLOSE = "\x02", "\x03"
#: The three control characters inside a symbol are written as the first one and a letter.
_ESCAPED = {"\x01": "\x01a", _OPEN: "\x01b", _CLOSE: "\x01c"}


def _escape(symbol: str) -> str:
    return "".join(_ESCAPED.get(c, c) for c in symbol)


def symbol_string(word: Column) -> Column:
    """Characters of a word as marked symbols, with the end mark last."""
    plain = reduce(lambda w, e: F.replace(w, F.lit(e[0]), F.lit(e[1])), _ESCAPED.items(), word)
    return F.concat(
        F.regexp_replace(plain, "(?s)(\x01.|.)", f"{_OPEN}$1{_CLOSE}"), F.lit(f"{_OPEN}{END_OF_WORD}{_CLOSE}")
    )


def symbol_array(symbols: Column) -> Column:
    def unescape(parts: Column) -> Column:
        return F.transform(parts, lambda p: reduce(lambda w, e: F.replace(w, F.lit(e[1]), F.lit(e[0])), [*_ESCAPED.items()][::-1], p))

    parts = F.split(F.substring(symbols, F.lit(2), F.length(symbols) - 2), _CLOSE + _OPEN)
    return F.when(F.contains(symbols, F.lit("\x01")), unescape(parts)).otherwise(parts)


def merge_expr(symbols: Column, left: str, right: str) -> Column:
    left, right = _escape(left), _escape(right)
    return F.replace(
        symbols, F.lit(f"{_OPEN}{left}{_CLOSE}{_OPEN}{right}{_CLOSE}"), F.lit(f"{_OPEN}{left}{right}{_CLOSE}")
    )


def word_symbols(words: DataFrame) -> DataFrame:
    """``(word, freq)`` -> ``(word, freq, symbols)``."""
    return words.withColumn("symbols", symbol_string(F.col("word")))


def byte_symbols(words: DataFrame) -> DataFrame:
    """``(word, freq)`` -> ``(word, freq, symbols)`` with the word's UTF-8 bytes in hexadecimal as symbols, no end mark."""
    return words.withColumn("symbols", F.regexp_replace(F.hex("word"), "(..)", f"{_OPEN}$1{_CLOSE}"))


def _pairs(symbols: Column, freq: Column) -> Column:
    def neighbours(s):
        last = F.size(s) - 1
        return F.zip_with(
            F.slice(s, F.lit(1), last),
            F.slice(s, F.lit(2), last),
            lambda a, b: F.struct(a.alias("left"), b.alias("right"), freq.alias("n")),
        )

    return let(symbol_array(symbols), neighbours)


def _sum_pairs(long: DataFrame) -> DataFrame:
    return long.groupBy("left", "right").agg(F.sum("n").alias("n"))


def pair_counts(words: DataFrame) -> DataFrame:
    """How often each pair of neighbouring symbols occurs, weighted by word counts."""
    return _sum_pairs(unnest(words, [], _pairs(F.col("symbols"), F.col("freq")), "p").select("p.*"))


def _count_changes(words: DataFrame, merges: Sequence[tuple[str, str]]) -> DataFrame:
    """Gains and losses of pair counts in the words that the merges touch."""
    old = F.col("symbols")
    new = reduce(lambda s, m: merge_expr(s, *m), merges, old)
    touched = words.select("freq", old.alias("old"), new.alias("new")).filter(F.col("old") != F.col("new"))
    both = F.concat(_pairs(F.col("old"), -F.col("freq")), _pairs(F.col("new"), F.col("freq")))
    return _sum_pairs(unnest(touched, [], both, "p").select("p.*"))


def safe_prefix(ranked: Sequence[tuple[str, str, int]], limit: int) -> list[tuple[str, str]]:
    """The leading pairs that one-at-a-time merging would also take next, in this order.

    Merging (a, b) changes only pairs that share a symbol with it, and a new pair
    is never more frequent than the old pair it came from. So the next pair is
    safe when no pair at least as frequent touches a symbol merged in this round.
    A pair of equal symbols may raise a count of its own and ends the round.
    """
    taken: list[tuple[str, str]] = []
    used: set[str] = set()
    for place, (left, right, n) in enumerate(ranked):
        if len(taken) == limit or left in used or right in used:
            break
        ties = itertools.takewhile(lambda other: other[2] == n, ranked[place + 1 :])
        # a list that ends among pairs of this count may lack some of them
        cut_short = ranked[-1][2] == n
        if taken and (cut_short or any(t[0] in used or t[1] in used for t in ties)):
            break
        taken.append((left, right))
        used.update((left, right))
        if left == right:
            break
    return taken


class PairIndex:
    """An inverted index from pairs of neighbouring symbols to the words that hold them.

    It is a log of runs, Parquet tables of postings ``(h, left, right, word, version,
    freq, symbols, gain)``, each sorted by ``h``, a hash of the pair, so that a scan for
    few pairs reads few pages. ``gain`` is what a posting adds to the pair's count: counts
    are sums over all runs. A word that changes appends postings under its next
    version, without symbols for its old pairs and with its new symbols for its
    new ones. Older postings stay behind and are told by their version, until
    ``fan`` runs of a level are merged into one of the next level; the last level takes
    in the first run too and leaves out what is no longer true.
    """

    SCHEMA = "h long, left string, right string, word string, version int, freq long, symbols string, gain long"
    DELTA, MERGED, FIRST = 0, 1, 2

    def __init__(self, words: DataFrame, fan: int = 8):
        self.spark, self.fan, self.made = words.sparkSession, fan, 0
        self.folder = scratch(self.spark, "pairs")
        self.runs: list[tuple[int, str]] = []
        self._append(words.select("word", "freq", F.lit(0).alias("version"), F.lit(None).cast("string").alias("old"), F.col("symbols").alias("new")), self.FIRST)

    def _write(self, postings: DataFrame, level: int) -> str:
        path = f"{self.folder}/{self.made}"
        self.made += 1
        postings.sortWithinPartitions("h").write.parquet(path)
        self.runs.append((level, path))
        return path

    def _append(self, words: DataFrame, level: int) -> DataFrame:
        """A run from words with their symbols before and after a change."""
        freq = F.col("freq")

        def marked(symbols: Column, weight: Column, live: bool) -> Column:
            return F.when(symbols.isNotNull(), F.transform(_pairs(symbols, weight), lambda p: F.struct(p.alias("p"), F.lit(live).alias("live"))))

        both = F.flatten(F.filter(F.array(marked(F.col("old"), -freq, False), marked(F.col("new"), freq, True)), lambda x: x.isNotNull()))
        long = unnest(words, ["word", "version", "freq", "new"], both, "e")
        pair = [F.col("e.p.left").alias("left"), F.col("e.p.right").alias("right")]
        found = long.select(
            F.xxhash64("e.p.left", "e.p.right").alias("h"), *pair, "word", "version", "freq", F.when(F.col("e.live"), F.col("new")).alias("symbols"), F.col("e.p.n").alias("gain")
        )
        return self._read(self._write(found, level))

    def _read(self, *paths: str) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(*paths)

    def _every(self) -> DataFrame:
        return self._read(*[path for _, path in self.runs])

    def counts(self) -> DataFrame:
        """``(left, right, n)`` of all pairs: a pass over the postings."""
        return _sum_pairs(self._every().select("left", "right", F.col("gain").alias("n"))).filter("n > 0")

    def holding(self, merges: Sequence[tuple[str, str]]) -> DataFrame:
        """``(word, version, freq, symbols)`` of the words that hold one of the pairs now."""
        same = [(F.col("h") == F.xxhash64(F.lit(a), F.lit(b))) & (F.col("left") == a) & (F.col("right") == b) for a, b in merges]
        rows = self._every().filter(reduce(lambda x, y: x | y, same))
        last = F.max(F.struct("version", F.col("symbols").isNotNull().alias("live"), "symbols", "freq")).alias("m")
        return rows.groupBy("word").agg(last).filter("m.live").select("word", "m.version", "m.freq", "m.symbols")

    def merge(self, merges: Sequence[tuple[str, str]]) -> DataFrame:
        """Merge the pairs in the words that hold them; the postings that this added."""
        new = reduce(lambda s, m: merge_expr(s, *m), merges, F.col("symbols"))
        touched = self.holding(merges).select("word", "freq", (F.col("version") + 1).alias("version"), F.col("symbols").alias("old"), new.alias("new"))
        return self._append(touched, self.DELTA)

    def compact(self) -> None:
        """Merge runs of a level once there are ``fan`` of them."""
        for level in (self.DELTA, self.MERGED):
            own = [path for at, path in self.runs if at == level]
            if len(own) < self.fan:
                continue
            whole = level == self.MERGED
            taken = [path for at, path in self.runs if whole or at == level]
            last = F.max(F.struct("version", F.col("symbols").isNotNull().alias("live"), "symbols", "freq")).alias("m")
            rows = self._read(*taken).groupBy("h", "left", "right", "word").agg(last, F.sum("gain").alias("gain"))
            rows = (rows.filter("m.live") if whole else rows).select("h", "left", "right", "word", "m.version", "m.freq", "m.symbols", "gain")
            self._write(rows, self.FIRST if whole else self.MERGED)
            self.runs = [run for run in self.runs if run[1] not in taken]
            for path in taken:
                discard(self.spark, path)

    def close(self) -> None:
        discard(self.spark, self.folder)


def _order(pair: tuple[str, str], n: int) -> tuple:
    return (-n, *pair)


def _train_by_index(index: PairIndex, merges: list, n_merges: int, fetch: int, limit: int, trace: list | None) -> None:
    """Go on merging by the index.

    The driver holds the counts of the first ``fetch`` pairs in merging order, and of
    new pairs that come before the last of these. All other pairs come later, for
    counts of old pairs only fall; so the list is the true order down to that last
    place, and is fetched again when it is used up. A symbol that is spelled like an
    earlier one may raise old pairs: then it is fetched again at once.
    """
    spark = index.spark
    known: dict[tuple[str, str], int] = {}
    bar: tuple | None = None
    seen = {END_OF_WORD} | {a + b for _, a, b in merges}
    while len(merges) < n_merges:
        ranked = sorted(_order(p, n) for p, n in known.items())
        ranked = [(a, b, -n) for n, a, b in ranked if bar is None or (n, a, b) <= bar]
        if not ranked:
            rows = index.counts().orderBy(F.desc("n"), "left", "right").limit(fetch).collect()
            if not rows:
                return
            known = {(r[0], r[1]): r[2] for r in rows}
            bar = _order((rows[-1][0], rows[-1][1]), rows[-1][2]) if len(rows) == fetch else None
            continue
        batch = safe_prefix(ranked, min(n_merges - len(merges), limit))
        done = len(merges)
        merges.extend((done + i, a, b) for i, (a, b) in enumerate(batch))
        if len(merges) == n_merges and trace is None:
            return
        run = index.merge(batch)
        if trace is not None:
            trace.append({"merges": batch, "words": run.select("word").distinct().count(), "postings": run.count()})
        spelled = [a + b for a, b in batch]
        if seen & set(spelled):
            known, bar = {}, None
        else:
            held = spark.createDataFrame([(*p, True) for p in known], "left string, right string, held boolean")
            changes = _sum_pairs(run.select("left", "right", F.col("gain").alias("n"))).filter("n <> 0")
            wanted = changes.join(F.broadcast(held), ["left", "right"], "left").filter(F.col("held") | (F.col("n") >= (1 if bar is None else -bar[0])))
            for row in wanted.collect():
                pair = (row["left"], row["right"])
                if pair in known or bar is None or _order(pair, row["n"]) <= bar:
                    known[pair] = known.get(pair, 0) + row["n"]
                    if known[pair] <= 0:
                        del known[pair]
        seen.update(spelled)
        index.compact()


def bpe_train(
    words: DataFrame,
    n_merges: int,
    fetch: int = 512,
    cut_every: int = 32,
    symbols: Callable[[DataFrame], DataFrame] = word_symbols,
    index_from: int = 64,
    fan: int = 8,
    trace: list | None = None,
) -> list[tuple[int, str, str]]:
    """Learn merges ``(rank, left, right)`` from ``(word, freq)``, most frequent pair first.

    Ties go to the smaller pair in code-point order. Pairs are counted once; after
    that a round adds only the changes in the words it touched. A round may take
    several merges that cannot influence each other, so there are fewer rounds
    than merges. ``symbols`` cuts the words: into characters, or with
    ``byte_symbols`` into bytes.

    The first ``index_from`` merges, whose pairs most words hold, pass over all words;
    the counts are checkpointed each round, the words every ``cut_every`` merges. From
    then on a ``PairIndex`` finds the words that hold a pair, and a round reads and
    writes postings of these words only. ``trace`` gets, for each round, its merges
    and how many words it read.
    """
    cores = words.sparkSession.sparkContext.defaultParallelism
    counted = words.groupBy("word").agg(F.sum("freq").alias("freq"))
    current = materialize(symbols(counted).repartition(cores, "word"))
    merges: list[tuple[int, str, str]] = []
    if index_from > 0:
        counts = materialize(pair_counts(current))
    pending, total = 0, current.count() if trace is not None else 0
    while len(merges) < min(n_merges, index_from):
        top = counts.orderBy(F.desc("n"), "left", "right").limit(fetch).collect()
        batch = safe_prefix([(r[0], r[1], r[2]) for r in top], min(min(n_merges, index_from) - len(merges), cut_every))
        if not batch:
            return merges
        done = len(merges)
        merges.extend((done + i, a, b) for i, (a, b) in enumerate(batch))
        if trace is not None:
            trace.append({"merges": batch, "words": total})
        if len(merges) < n_merges:
            if len(merges) < index_from:
                changes = _count_changes(current, batch)
                counts = materialize(_sum_pairs(counts.unionByName(changes)).filter("n > 0"))
            current = current.withColumn("symbols", reduce(lambda s, m: merge_expr(s, *m), batch, F.col("symbols")))
            pending += len(batch)
            if pending >= cut_every:
                current, pending = materialize(current), 0
    if len(merges) < n_merges:
        index = PairIndex(current, fan)
        try:
            _train_by_index(index, merges, n_merges, max(fetch, 1), cut_every, trace)
        finally:
            index.close()
    return merges


def merges_frame(spark, merges: Iterable[tuple[int, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(merges), "rank int, left string, right string")


def merge_symbols(symbols: list, rank_of) -> list:
    """Join the neighbouring pair of lowest rank, leftmost first, until none has a rank.

    Pairs wait in a heap and are dropped when one of their ends has changed, so a
    very long word costs n log n, not n squared.
    """
    parts, after = list(symbols), list(range(1, len(symbols) + 1))
    before = list(range(-1, len(symbols) - 1))
    heap: list = []

    def offer(i):
        j = after[i] if i >= 0 else len(parts)
        if j < len(parts):
            rank = rank_of(parts[i], parts[j])
            if rank is not None:
                heapq.heappush(heap, (rank, i, parts[i], parts[j]))

    for i in range(len(parts) - 1):
        offer(i)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else len(parts)
        if j >= len(parts) or parts[i] != left or parts[j] != right:
            continue
        parts[i], parts[j], after[i] = left + right, None, after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [p for p in parts if p is not None]


def split_words(words: DataFrame, merges: DataFrame, specials: Sequence[str] = ()) -> DataFrame:
    """``(word)`` -> ``(word, parts)``: every distinct word split once; specials stay whole.

    The neighbouring pair of lowest rank is joined until none has a rank, by an
    Arrow function that holds the list of merges (after a size check). A pair
    listed twice has its lower rank.
    """
    split = _splitter(merges, specials)

    @F.arrow_udf("array<string>")
    def merged(column: pa.Array) -> pa.Array:
        kinds = column.dictionary_encode()
        return split(kinds.dictionary).take(kinds.indices)

    return words.select("word", merged("word").alias("parts"))


#: How many words' parts a worker remembers, and up to which length.
REMEMBERED, REMEMBERED_LENGTH = 1 << 17, 64


def _remembering(shared, work: Callable, kind: pa.DataType) -> Callable[[pa.Array], pa.Array]:
    """A function from strings to one list each: ``work(broadcast value, string)``, whose latest results a worker remembers."""

    def lists(column: pa.Array) -> pa.Array:
        held = shared.value
        if "work" not in held:  # the worker keeps the broadcast value between batches and tasks
            held["work"] = functools.lru_cache(REMEMBERED)(functools.partial(work, held["table"]))
        known, table = held["work"], held["table"]
        return pa.array([known(w) if len(w) <= REMEMBERED_LENGTH else work(table, w) for w in column.to_pylist()], pa.list_(kind))

    return lists


def _splitter(merges: DataFrame, specials: Sequence[str]) -> Callable[[pa.Array], pa.Array]:
    """Words to their symbols by a list of merges, whose size is checked; specials stay whole."""
    rows = small_rows(merges.groupBy("left", "right").agg(F.min("rank").alias("rank")), "the list of merges")
    table = {(r["left"], r["right"]): r["rank"] for r in rows}
    whole = frozenset(specials)

    def split(rank, word):
        if word in whole:
            return [word]
        return merge_symbols([*word, END_OF_WORD], lambda left, right: rank.get((left, right)))

    return _remembering(merges.sparkSession.sparkContext.broadcast({"table": table}), split, pa.string())


def _strung(column: pa.Array, convert: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """Arrays of strings to the lists of their elements strung together; ``convert`` sees each string of a batch once."""
    kinds = column.flatten().dictionary_encode()
    if kinds.indices.null_count:
        raise ValueError("token not in dictionary: NULL")
    lists = convert(kinds.dictionary).take(kinds.indices)

    def ends(sizes: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(pc.fill_null(sizes, 0).cast(pa.int64()))])

    offsets = ends(pc.list_value_length(lists)).take(ends(pc.list_value_length(column))).cast(pa.int32())
    return pa.ListArray.from_arrays(offsets, lists.flatten(), mask=column.is_null())


def bpe_encode_long(
    tokens_long: DataFrame, merges: DataFrame, keys: Sequence[str] = ("doc_id",), specials: Sequence[str] = ()
) -> DataFrame:
    """``(keys, pos, token)`` -> ``(keys, pos, sub, symbol)``.

    Words are split where they stand, by an Arrow function that holds the list of
    merges, so nothing is shuffled.
    """
    words = tokens_long.filter(F.col("token").isNotNull())
    split = _splitter(merges, specials)

    @F.arrow_udf("array<string>")
    def parts(column: pa.Array) -> pa.Array:
        kinds = column.dictionary_encode()
        return split(kinds.dictionary).take(kinds.indices)

    return unnest(words, [*keys, "pos"], parts("token"), "symbol", "sub")


def symbol_vocab(merges: DataFrame, symbols_long: DataFrame, specials: Sequence[str] = ()) -> DataFrame:
    """``(token, id)``: single symbols in order, then merged ones by rank, then the specials."""
    merged = merges.select(F.concat("left", "right").alias("token"), "rank")
    # two merge rules may spell the same symbol; the first one names it
    merged = merged.groupBy("token").agg(F.min("rank").alias("rank"))
    single = symbols_long.select(F.col("symbol").alias("token")).distinct().join(merged.select("token"), "token", "left_anti")
    single = single.filter(~F.col("token").isin(list(specials))) if specials else single
    table = single.select("token", F.lit(-1).alias("rank")).unionByName(merged)
    rows = sorted(small_rows(table, "the symbol vocabulary"), key=lambda r: (r["rank"], r["token"]))
    names = [r["token"] for r in rows] + list(specials)
    return merges.sparkSession.createDataFrame([(t, i) for i, t in enumerate(names)], "token string, id long")


def bpe_encode(
    df: DataFrame,
    merges: DataFrame,
    vocab: DataFrame,
    tokens: str = "tokens",
    specials: Sequence[str] = (),
    **limits,
) -> DataFrame:
    """Add ``ids``, the symbol ids of each document; a symbol outside the vocabulary is an error.

    Words are split where they stand, by an Arrow function that holds the list of
    merges; the symbols then take their ids from the vocabulary.
    """
    split = _splitter(merges, specials)

    @F.arrow_udf("array<string>")
    def symbols(column: pa.Array) -> pa.Array:
        return _strung(column, split)

    known = encode(settle(df, "_w", F.col(tokens)).withColumn("_s", symbols("_w")).drop("_w"), vocab, "_s", "ids", **limits)
    return known.drop("_s")


def bpe_decode(ids_long: DataFrame, vocab: DataFrame, keys: Sequence[str] = ("doc_id",), specials=(), ids: str | None = None) -> DataFrame:
    """``(keys, pos, id)`` -> text: symbols joined, the end mark read as a space.

    ``ids`` may name a column of id arrays instead: the same as the long form of these
    arrays, but a document travels as one row and its symbols are looked up in place.
    """
    token = F.col("token")
    if specials:
        vocab = vocab.withColumn("token", F.when(token.isin(list(specials)), F.concat(token, F.lit(" "))).otherwise(token))
    if ids is None:
        joined = lookup_join(ids_long, vocab, ["id"], "left")
        missing = F.raise_error(F.concat(F.lit("id not in vocabulary: "), F.col("id").cast("string"))).cast("string")
        arrays = collect_positions(joined.withColumn("_s", F.coalesce("token", missing)), keys, "_s", "_p")
    else:
        arrays = _symbols_of_keys(ids_long, vocab, keys, ids)
    return arrays.select(*keys, F.rtrim(F.replace(F.array_join("_p", ""), F.lit(END_OF_WORD), F.lit(" "))).alias("text"))


def _symbols_of_keys(df: DataFrame, vocab: DataFrame, keys: Sequence[str], ids: str) -> DataFrame:
    """``(keys, _p)``: the symbols of a key's id arrays; those of a repeated key are ordered by place, then by symbol."""
    held = settle(df.select(*keys, ids), "_a", F.col(ids)).filter(F.size("_a") > 0)
    held = held.groupBy(*keys).agg(F.collect_list("_a").alias("_l"))
    placed = F.flatten(F.transform("_l", lambda a: F.transform(a, lambda x, i: F.struct(i.alias("pos"), x.alias("id")))))
    held = held.withColumn("_z", F.when(F.size("_l") > 1, placed))
    held = settle(held, "_i", F.when(F.size("_l") > 1, F.transform("_z", lambda z: z["id"])).otherwise(F.get("_l", F.lit(0))))
    found = decode_arrays(held.select(*keys, "_z", "_i"), vocab, "_i", "_t")
    both = F.array_sort(F.zip_with("_z", "_t", lambda z, t: F.struct(z["pos"].alias("pos"), t.alias("t"))))
    return found.select(*keys, F.when(F.col("_z").isNull(), F.col("_t")).otherwise(F.transform(both, lambda x: x["t"])).alias("_p"))


# --- rank files -----------------------------------------------------------

# Fixed value: the pattern that cuts text into pieces before byte merges of the
# widely used 50k-entry vocabulary.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(spark, path: str) -> DataFrame:
    """``(token, rank)`` from a text file with one base64 token and its rank per line."""
    parts = F.split("value", " ")
    lines = spark.read.text(path).filter(F.length("value") > 0)
    return lines.select(F.unbase64(parts[0]).alias("token"), parts[1].cast("long").alias("rank"))


def byte_ranks(spark, merges: Iterable[tuple[int, str, str]]) -> DataFrame:
    """A rank table from merges of ``byte_symbols``: the 256 bytes, then each merged string once."""
    ranks = {bytes([b]): b for b in range(256)}
    for k, (_, left, right) in enumerate(merges):
        ranks.setdefault(bytes.fromhex(left + right), 256 + k)
    return spark.createDataFrame(list(ranks.items()), "token binary, rank long")


def piece_counts(df: DataFrame, col: str = "text", pattern: str = PIECES) -> DataFrame:
    """``(word, freq)``: the pieces of the texts with their counts."""
    pieces = unnest(df, [], piece_array(F.col(col), pattern=pattern), "word")
    return pieces.groupBy("word").agg(F.count(F.lit(1)).alias("freq"))


def piece_array(text: Column, specials: Sequence[str] = (), pattern: str = PIECES) -> Column:
    """Text cut by the pattern; the given special tokens are cut out whole first."""
    find = F.lit("(?U)" + pattern)
    if not specials:
        return F.regexp_extract_all(text, find, F.lit(0))
    either = "|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))
    segments = F.split(text, f"(?<={either})|(?={either})")
    return F.flatten(
        F.transform(
            segments,
            lambda s: F.when(s.isin(list(specials)), F.array(s)).otherwise(F.regexp_extract_all(s, find, F.lit(0))),
        )
    )


def encode_ranks(
    df: DataFrame,
    ranks: DataFrame,
    col: str = "text",
    out: str = "ids",
    specials: dict[str, int] | None = None,
    pattern: str = PIECES,
    **_limits,
) -> DataFrame:
    """Text to ids of a byte-level rank table; ``specials`` maps allowed special tokens to ids.

    Pieces are cut in the JVM and merged where they stand by Arrow tasks that hold
    the rank table (after a size check), so nothing is shuffled; limits of a
    broadcast, which the callers of other encoders give, do not matter here.
    """
    given = dict(specials or {})
    table = {bytes(r["token"]): r["rank"] for r in small_rows(ranks.select("token", "rank"), "the rank table")}

    def merged(rank, piece):
        if piece in given:
            return [given[piece]]
        raw = piece.encode("utf-8")
        if raw in rank:
            return [rank[raw]]
        return [rank[p] for p in merge_symbols([raw[i : i + 1] for i in range(len(raw))], lambda left, right: rank.get(left + right))]

    lists = _remembering(df.sparkSession.sparkContext.broadcast({"table": table}), merged, pa.int64())

    @F.arrow_udf("array<long>")
    def ids(column: pa.Array) -> pa.Array:
        return _strung(column, lists)

    pieces = settle(df, "_pieces", piece_array(F.col(col), list(given), pattern))
    return pieces.withColumn(out, ids("_pieces")).drop("_pieces")


def decode_ranks(
    df: DataFrame,
    ranks: DataFrame,
    ids: str = "ids",
    out: str = "text",
    specials: dict[str, int] | None = None,
    **limits,
) -> DataFrame:
    """Ids back to text: token bytes strung together, bad UTF-8 replaced."""
    table = ranks.select(F.col("rank").alias("id"), F.hex("token").alias("token"))
    if specials:
        rows = [(i, t.encode().hex().upper()) for t, i in specials.items()]
        table = table.unionByName(df.sparkSession.createDataFrame(rows, "id long, token string"))
    found = decode_arrays(df, table, ids, "_t", **limits)
    return found.withColumn(out, F.make_valid_utf8(F.unhex(F.array_join("_t", "")).cast("string"))).drop("_t")
