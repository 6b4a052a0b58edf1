"""Toxicity by two class-conditional Kneser-Ney models over the characters of words.

The top order has absolute-discounted counts of its own for each class; all
lower orders are Kneser-Ney continuation counts shared by both, gathered from
the words of all texts, labelled or not, so a rare
expression that neither class has seen scores alike under both, and one that
only a class has seen tells them apart no more than its counts allow. Above them
stand whole words, counted by the texts they occur in, with an absolute discount
of several texts; what is taken off goes to counts shared by both classes. A
text is compared by the length-normalised log-likelihoods of the whole and of
its most telling window of words and by its most telling word; a logistic curve
fitted on labelled rows that the counts have not seen turns them into a score.

Counting and smoothing are joins and sums over grams. Every gram keeps its own
ratio, an unseen one gets that of its own context, so these tables grow with
the corpus. They travel to the scoring tasks, whole while they are measured to
be small and else in parts, of which a task holds one at a time; its texts stay
where they are. Beyond a number of parts each distinct word gets its ratio by
joins, and the texts' words are joined with those.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelearn.llm.common import by_batch, narrow, packed_rows, unpacked
from framelearn.plans.scale import lookup_join, maybe_broadcast
from framelearn.session import materialize

#: Characters (bytes) of the longest gram, and the discount of every order.
ORDER = 6
DISCOUNT = 0.75
#: Texts taken off the count of every whole word: copies and chance put a word into a few texts of one class.
TEXTS_OFF = 4.0
#: Figures of a text that the curve weighs.
FIGURES = 4
#: Grams, contexts and words whose ratios a task holds at a time; more are sent in so many parts at most, and still more are joined.
HELD_GRAMS = 4_000_000
HELD_PARTS = 16
#: Words in a window.
WINDOW = 8
#: Labelled rows that the two curves' weights are fitted on at most.
FIT_ROWS = 20_000
#: Of five parts by crc32(doc_id): 0 is held out; of part 1 come the rows that fit the curve, all others are counted.
PARTS = 5
#: Words whose ratio a Python worker remembers at a time.
REMEMBERED = 200_000

#: Words whose grams are hashed together.
AT_A_TIME = 20_000

#: ASCII digits become 0, other letters and everything outside ASCII stay, the rest are gaps.
_SYMBOLS = bytes(0x30 if 0x30 <= c <= 0x39 else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_FIRST = np.uint64(0xD6E8FEB86659FD93)
#: A table without rows.
_NOTHING = (np.zeros(0, np.uint64), np.zeros(0))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_SYMBOLS).split()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def gram_cells(joined: np.ndarray, starts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the gram that ends at each byte and of its context.

    ``joined`` holds words each behind one blank, plus a last blank; ``starts``
    gives for each byte the place of its word's leading blank. A gram has at
    most ``order`` bytes and never reaches past the leading blank.
    """
    n = len(joined)
    at = np.arange(n)
    size = np.minimum(at - starts + 1, order)
    value = joined.astype(np.uint64) + np.uint64(1)
    gram = np.zeros(n, np.uint64)
    context = np.full(n, _FIRST)
    run = np.full(n, _FIRST)
    for k in range(1, order + 1):
        # hash of the k bytes that end at each place, the oldest byte last
        shifted = np.zeros(n, np.uint64)
        shifted[k - 1 :] = value[: n - k + 1]
        run = (run ^ shifted) * _MULTIPLIER
        gram = np.where(size == k, run, gram)
    run = np.full(n, _FIRST)
    for k in range(1, order):
        shifted = np.zeros(n, np.uint64)
        shifted[k:] = value[: n - k]
        run = (run ^ shifted) * _MULTIPLIER
        context = np.where(size == k + 1, run, context)
    return _mixed(gram), _mixed(context)


def _hashes(grams: list[bytes]) -> np.ndarray:
    """The hashes of whole grams, as ``gram_cells`` gives them."""
    found, mask, start, multiplier = [], (1 << 64) - 1, int(_FIRST), int(_MULTIPLIER)
    for gram in grams:
        h = start
        for b in reversed(gram):
            h = ((h ^ (b + 1)) * multiplier) & mask
        found.append(h)
    return _mixed(np.array(found, dtype=np.uint64))


def _hash_alone(gram: bytes) -> int:
    """The hash of one gram, as ``gram_cells`` gives it."""
    return int(_hashes([gram])[0])


# --- counts ----------------------------------------------------------------


COUNTS = ("nt", "no", "dt", "dn", "da")


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic or NULL, text) -> words, their counts in either class, and the texts they stand in: toxic, ordinary, given without a label."""
    counts: dict = {1: Counter(), 0: Counter()}
    texts: dict = {1: Counter(), 0: Counter(), None: Counter()}

    def flush():
        every = list(texts[1].keys() | texts[0].keys() | texts[None].keys())
        found = (counts[1], counts[0], texts[1], texts[0], texts[None])
        yield pa.RecordBatch.from_arrays([pa.array(every, pa.binary()), *[pa.array([c[w] for w in every], pa.int64()) for c in found]], names=["word", *COUNTS])
        for c in found:
            c.clear()

    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = words_of(text.as_py())
            if toxic is not None:
                counts[toxic].update(words)
            texts[toxic].update(set(words))
            if sum(map(len, texts.values())) > REMEMBERED:
                yield from flush()
    yield from flush()


def _grams(order: int, top: bool):
    """Top grams (full history) of words with their counts, or all distinct runs of 2 to ``order`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if top:
                counts: tuple[Counter, Counter] = (Counter(), Counter())
                for word, *both in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1).to_pylist()):
                    s = b" " + word + b" "
                    for mine, n in zip(counts, both):
                        if n:
                            for t in range(1, len(s)):
                                mine[s[max(0, t - order + 1) : t + 1]] += n
                every = list(counts[0].keys() | counts[1].keys())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(every, pa.binary()), pa.array([counts[1][g] for g in every], pa.int64()), pa.array([counts[0][g] for g in every], pa.int64())],
                    names=["gram", "nt", "no"],
                )
            else:
                found = set()
                for word in batch.column(0).to_pylist():
                    s = b" " + word + b" "
                    for m in range(2, order + 1):
                        found.update(s[t : t + m] for t in range(len(s) - m + 1))
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary())], names=["gram"])

    return run


def _tail(gram) -> F.Column:
    return F.expr(f"substring({gram}, 2)")


def _head(gram) -> F.Column:
    return F.expr(f"substring({gram}, 1, length({gram}) - 1)")


def shared_model(words: DataFrame, order: int, discount: float) -> DataFrame:
    """(gram, p): the shared Kneser-Ney probability of the last byte behind the others, for grams under ``order`` bytes.

    ``words`` has the distinct words. A gram's weight is the number of distinct
    bytes that stand before it.
    """
    runs = words.select("word").mapInArrow(_grams(order, False), "gram binary").distinct()
    weight = runs.groupBy(_tail("gram").alias("gram")).agg(F.count(F.lit(1)).alias("c"))
    weight = materialize(weight.withColumn("size", F.length("gram")))
    first = weight.filter("size = 1")
    total = first.agg(F.sum("c").alias("t")).first()["t"] or 1
    level = first.select("gram", (F.col("c") / F.lit(float(total))).alias("p"))
    every = level
    for m in range(2, order):
        mine = weight.filter(F.col("size") == m).select("gram", "c", _head("gram").alias("h"), _tail("gram").alias("low"))
        context = mine.groupBy("h").agg(F.sum("c").alias("t"), F.count(F.lit(1)).alias("k"))
        lower = level.select(F.col("gram").alias("low"), F.col("p").alias("q"))
        level = mine.join(context, "h").join(lower, "low").select(
            "gram", ((F.col("c") - discount + discount * F.col("k") * F.col("q")) / F.col("t")).alias("p")
        )
        every = every.unionByName(level)
    return every


def class_ratios(word_counts: DataFrame, order: int = ORDER, discount: float = DISCOUNT) -> tuple[DataFrame, DataFrame]:
    """(gram, ratio) and (context, ratio): log P(toxic) - log P(ordinary) of a seen gram, and of an unseen one by its context.

    ``word_counts(word, nt, no)`` has a row for each distinct word; words that
    no class has counted take part in the shared lower orders.
    """
    grams = word_counts.filter("nt + no > 0").select("word", "nt", "no").mapInArrow(_grams(order, True), "gram binary, nt bigint, no bigint")
    grams = grams.groupBy("gram").agg(F.sum("nt").alias("nt"), F.sum("no").alias("no")).withColumn("h", _head("gram"))
    grams = materialize(grams)
    context = grams.groupBy("h").agg(
        F.sum("nt").alias("ct"), F.sum("no").alias("co"), F.count(F.when(F.col("nt") > 0, 1)).alias("kt"), F.count(F.when(F.col("no") > 0, 1)).alias("ko")
    )
    share = {c: F.when(F.col(f"c{c}") > 0, discount * F.col(f"k{c}") / F.col(f"c{c}")).otherwise(1.0) for c in "to"}
    context = context.select("*", share["t"].alias("lt"), share["o"].alias("lo"))
    low = shared_model(word_counts.select("word"), order, discount).withColumnRenamed("gram", "low")
    seen = grams.withColumn("low", _tail("gram")).join(context, "h").join(low, "low")
    chance = {
        c: F.when(F.col(f"c{c}") > 0, F.greatest(F.col(f"n{c}") - discount, F.lit(0.0)) / F.col(f"c{c}")).otherwise(0.0) + F.col(f"l{c}") * F.col("p") for c in "to"
    }
    ratios = seen.select("gram", (F.log(chance["t"]) - F.log(chance["o"])).alias("ratio"))
    defaults = context.select(F.col("h").alias("gram"), (F.log("lt") - F.log("lo")).alias("ratio"))
    return ratios, defaults


def telling_words(word_counts: DataFrame, off: float = TEXTS_OFF) -> tuple[DataFrame, float]:
    """(word, told) of the words of labelled texts, and the value of all others: log P(word | toxic) - log P(word | ordinary).

    ``word_counts(word, dt, dn, da)``: toxic, ordinary and all texts with the
    word. Up to ``off`` texts of each count are shared out by the counts of all
    texts, labelled or not.
    """
    least = {c: F.sum(F.least(F.col(c).cast("double"), F.lit(float(off)))) for c in ("dt", "dn")}
    sums = word_counts.agg(*[F.sum(c).cast("double").alias(c) for c in ("dt", "dn", "da")], *[least[c].alias(f"off_{c}") for c in least]).first()
    shared = F.greatest(F.col("da"), F.lit(1)) / F.lit(sums["da"] or 1.0)
    chance = [(F.greatest(F.col(c) - off, F.lit(0.0)) + sums[f"off_{c}"] * shared) / sums[c] for c in ("dt", "dn")]
    other = float(np.log(sums["off_dt"] / sums["dt"]) - np.log(sums["off_dn"] / sums["dn"]))
    return word_counts.filter("dt + dn > 0").select("word", (F.log(chance[0]) - F.log(chance[1])).alias("told")), other


def _named(name: str):
    """Rows (gram, value) -> (64-bit hash, value)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(_hashes(batch.column(0).to_pylist()).view(np.int64)), batch.column(1)], names=[name, batch.schema.names[1]])

    return by_batch(run)


def _joined_grams(words: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of the words' grams and of their contexts, word by word, and how many each word has."""
    joined = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    blank = np.flatnonzero(joined == 0x20)
    lengths = np.diff(blank)
    # the blank behind a word ends it and starts the next one: it is read as the end here
    starts = np.concatenate(([0], np.repeat(blank[:-1], lengths)))
    gram, context = gram_cells(joined, starts, order)
    return gram[1:], context[1:], lengths


def _word_grams(order: int):
    """Words -> (word, gram, context): the 64-bit hashes of the gram that ends at each byte of a word and at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, AT_A_TIME):
                words = batch.column(0).slice(k, AT_A_TIME)
                gram, context, lengths = _joined_grams(words.to_pylist(), order)
                owner = words.take(pa.array(np.repeat(np.arange(len(words)), lengths)))
                yield pa.RecordBatch.from_arrays([owner, pa.array(gram.view(np.int64)), pa.array(context.view(np.int64))], names=["word", "gram", "context"])

    return run


def named(ratios: DataFrame, defaults: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gram, ratio) and (context, other) by the 64-bit hashes of grams and contexts."""
    seen = ratios.select("gram", "ratio").mapInArrow(_named("gram"), "gram bigint, ratio double")
    unseen = defaults.select("gram", F.col("ratio").alias("other")).mapInArrow(_named("context"), "context bigint, other double")
    return materialize(seen), materialize(unseen)


def word_ratios(words: DataFrame, seen: DataFrame, unseen: DataFrame, order: int = ORDER) -> DataFrame:
    """(word, ratio) for each of the distinct ``words``: of its bytes and its end, given the bytes before.

    ``seen`` and ``unseen`` as ``named`` gives them. A gram that the classes have
    not seen has the ratio of its context, and 0 when that is unseen too.
    """
    grams = words.select("word").mapInArrow(_word_grams(order), "word binary, gram bigint, context bigint")
    # joined by distinct gram: a context or gram that most words have is one row here
    value = grams.select("gram", "context").distinct().join(seen, "gram", "left").join(unseen, "context", "left")
    value = materialize(value.select("gram", F.coalesce("ratio", "other", F.lit(0.0)).alias("value")))
    found = lookup_join(grams.select("word", "gram"), value, ["gram"])
    return found.groupBy("word").agg(F.sum("value").alias("ratio"))


# --- scoring ---------------------------------------------------------------


def _word_keys(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _keyed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows (word, told) -> (64-bit hash, told)."""
    return pa.RecordBatch.from_arrays([pa.array(_word_keys(batch.column(0).to_pylist()).view(np.int64)), batch.column(1)], names=["word", "told"])


def _collected(seen: DataFrame, unseen: DataFrame, order: int, told: DataFrame | None, other: float) -> tuple:
    def table(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        found = df.toArrow()
        key, ratio = found[0].to_numpy().view(np.uint64), found[1].to_numpy()
        at = np.argsort(key, kind="stable")
        return key[at], ratio[at]

    words = _NOTHING if told is None else table(told.select("word", "told").mapInArrow(by_batch(_keyed), "word bigint, told double"))
    return table(seen), table(unseen), order, words, other


def held(seen: DataFrame, unseen: DataFrame, order: int, most: int = HELD_GRAMS, told: DataFrame | None = None, other: float = 0.0) -> tuple | None:
    """The sorted hashes of grams, contexts and telling words, each with their ratios, and what else ``Ratios`` takes; None when there are more than ``most``."""
    if seen.count() + unseen.count() + (told.count() if told is not None else 0) > most:
        return None
    return _collected(seen, unseen, order, told, other)


def sent(seen: DataFrame, unseen: DataFrame, order: int, most: int, told: DataFrame, other: float) -> list[Broadcast] | None:
    """Broadcasts of what ``held`` gives: one for the workers to keep, or else one for each part of about ``most`` rows; None beyond ``HELD_PARTS``."""
    tables = (seen, unseen, told)
    parts = -(-sum(df.count() for df in tables) // max(most, 1))
    if parts > HELD_PARTS:
        return None
    context = seen.sparkSession.sparkContext
    if parts <= 1:
        return [context.broadcast({"table": _collected(seen, unseen, order, told, other)})]
    # what a worker keeps has no rows of the tables; a part is gone from the driver before the next one comes
    found = [context.broadcast({"table": (_NOTHING, _NOTHING, order, _NOTHING, other)})]
    for k in range(parts):
        mine = [df.filter(F.pmod(F.xxhash64(df.columns[0]), F.lit(parts)) == k) for df in tables]
        found.append(context.broadcast(_collected(*mine[:2], order, mine[2], other)))
    return found


def _read(part: Broadcast) -> tuple:
    """The value of a broadcast, which goes with its last use; ``value`` would stay as long as the worker has tasks of the job."""
    return part.load_from_path(part._path) if getattr(part, "_path", None) else part.value


def _summed(ratio: np.ndarray, size: np.ndarray, window: int) -> tuple[float, float, float]:
    """Ratio per byte of a whole text, of its best window, and the log of its words."""
    a, b = np.concatenate(([0.0], np.cumsum(ratio))), np.concatenate(([0.0], np.cumsum(size)))
    w = min(window, len(ratio))
    best = ((a[w:] - a[:-w]) / (b[w:] - b[:-w])).max()
    return a[-1] / b[-1], best, np.log1p(len(ratio))


def _look_up(table: tuple[np.ndarray, np.ndarray], key: np.ndarray, out: np.ndarray) -> None:
    """Put the ratio of each key of the table into its place."""
    known, ratio = table
    if len(known):
        at = np.minimum(np.searchsorted(known, key), len(known) - 1)
        there = known[at] == key
        out[there] = ratio[at[there]]


class _Numbers(dict):
    """Words and their numbers; a new word gets the next one."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Ratios:
    """The log-likelihood ratio of words, from the tables of grams and contexts, and how telling they are as a whole.

    ``more`` are functions that read further parts of the tables, given as ``held``
    gives them. They are read in turn, once for all new words of some texts.
    """

    def __init__(
        self,
        grams: tuple[np.ndarray, np.ndarray],
        contexts: tuple[np.ndarray, np.ndarray],
        order: int,
        told: tuple[np.ndarray, np.ndarray] = _NOTHING,
        other: float = 0.0,
        more: Sequence[Callable[[], tuple]] = (),
    ):
        self.own, self.order, self.other, self.more = (grams, contexts, order, told, other), order, other, more
        self.forget()

    def forget(self) -> None:
        self.numbers = _Numbers()
        # by the number of a word: its ratio, how telling it is, and its bytes with the blank behind them
        self.ratio, self.told, self.size = np.zeros(0), np.zeros(0), np.zeros(0)

    def numbered(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))

    def found(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ratio of each word (of its bytes and its end, given the bytes before), and how telling it is."""
        keys, told, pieces = _word_keys(words), np.full(len(words), self.other), []
        for k in range(0, len(words), AT_A_TIME):
            gram, context, lengths = _joined_grams(words[k : k + AT_A_TIME], self.order)
            # most grams recur within a batch of words
            distinct, first, back = np.unique(gram, return_index=True, return_inverse=True)
            pieces.append((distinct, context[first], np.full(len(distinct), np.nan), np.zeros(len(distinct)), back.astype(np.int32), np.cumsum(lengths) - lengths))
        for part in (lambda: self.own, *self.more):
            grams, contexts, _, known, _ = part()
            for distinct, context, value, unseen, _, _ in pieces:
                _look_up(grams, distinct, value)
                # the context of a gram without a ratio so far; one that a later part has does not need it
                missing = np.flatnonzero(np.isnan(value))
                other = unseen[missing]
                _look_up(contexts, context[missing], other)
                unseen[missing] = other
            _look_up(known, keys, told)
        ratios = [np.add.reduceat(np.where(np.isnan(value), unseen, value)[back], cuts) for _, _, value, unseen, back, cuts in pieces]
        return np.concatenate([*ratios, np.zeros(0)]), told

    def of(self, words: list[bytes]) -> np.ndarray:
        """The ratio of each word."""
        return self.found(words)[0]

    def learn(self) -> None:
        """Look up the words that were numbered since."""
        new = list(islice(self.numbers, len(self.ratio), None))
        if new:
            size = np.fromiter(map(len, new), np.float64, len(new)) + 1
            self.ratio, self.told, self.size = map(np.concatenate, zip((self.ratio, self.told, self.size), (*self.found(new), size)))

    def features(self, docs: list[np.ndarray], window: int) -> np.ndarray:
        """For each text, given by its words' numbers: ratio per byte of the whole, of its best window, the log of its words, and its most telling word."""
        self.learn()
        out = np.zeros((len(docs), FIGURES))
        for i, at in enumerate(docs):
            if len(at):
                out[i, :3] = _summed(self.ratio[at], self.size[at], window)
                out[i, 3] = self.told[at].max()
        return out


_FIGURES = [f"f{k}" for k in range(FIGURES)]
_FIGURES_TYPE = ", ".join(f"{f} double" for f in _FIGURES)


def _features(shared: list[Broadcast], window: int):
    """Batches of (key columns ..., text) -> key columns and the features; ``shared`` as ``sent`` gives it."""
    kept, *parts = shared

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        # a worker keeps them with the broadcast value, until it gets a task of another job
        cache = kept.value
        if "ratios" not in cache:
            cache["ratios"] = Ratios(*cache.pop("table"), more=[partial(_read, p) for p in parts])
        ratios = cache["ratios"]
        rows, docs = [], []
        for text in batch.column(batch.num_columns - 1):
            docs.append(ratios.numbered(words_of(text.as_py())))
            if len(ratios.numbers) > REMEMBERED:
                rows.append(ratios.features(docs, window))
                ratios.forget()
                docs = []
        if docs:
            rows.append(ratios.features(docs, window))
        x = np.concatenate(rows) if rows else np.zeros((0, FIGURES))
        keys = [batch.column(i) for i in range(batch.num_columns - 1)]
        return pa.RecordBatch.from_arrays([*keys, *[pa.array(x[:, k]) for k in range(FIGURES)]], names=[*batch.schema.names[:-1], *_FIGURES])

    return by_batch(run)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h1, h2, text) -> (h1, h2, word, at): each distinct word of a text with its places."""
    for batch in batches:
        keys: tuple[list[int], list[int]] = ([], [])
        words: list[bytes] = []
        places: list[list[int]] = []

        def flush():
            arrays = [*[pa.array(k, pa.int64()) for k in keys], pa.array(words, pa.binary()), pa.array(places, pa.list_(pa.int32()))]
            return pa.RecordBatch.from_arrays(arrays, names=["h1", "h2", "word", "at"])

        for h1, h2, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            found: dict[bytes, list[int]] = {}
            for k, word in enumerate(words_of(text.as_py())):
                found.setdefault(word, []).append(k)
            keys[0].extend([h1] * len(found))
            keys[1].extend([h2] * len(found))
            words.extend(found)
            places.extend(found.values())
            if len(words) > AT_A_TIME:
                yield flush()
                for part in (*keys, words, places):
                    part.clear()
        yield flush()


def joined_features(texts: DataFrame, words: DataFrame, window: int) -> DataFrame:
    """(h1, h2, f0, f1, f2, f3) for each different text with words of ``texts(h1, h2, text)``, by joins alone."""
    spread = texts.select("h1", "h2", "text").mapInArrow(_places, "h1 bigint, h2 bigint, word binary, at array<int>")
    spread = spread.groupBy("h1", "h2", "word").agg(F.first("at").alias("at"))  # of equal texts one
    priced = lookup_join(spread, words, ["word"])
    cells = F.struct(F.coalesce("ratio", F.lit(0.0)).alias("ratio"), F.length("word").alias("size"), "at", F.coalesce("told", F.lit(0.0)).alias("told"))
    per_text = priced.groupBy("h1", "h2").agg(F.collect_list(cells).alias("cells"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.zeros((batch.num_rows, FIGURES))
        for i, cell in enumerate(batch.column(2)):
            times = cell.values.field("at").value_lengths().to_numpy()
            at = cell.values.field("at").flatten().to_numpy()
            ratio, size = np.zeros(len(at)), np.zeros(len(at))
            ratio[at] = np.repeat(cell.values.field("ratio").to_numpy(), times)
            size[at] = np.repeat(cell.values.field("size").to_numpy(), times) + 1
            x[i, :3] = _summed(ratio, size, window)
            x[i, 3] = cell.values.field("told").to_numpy().max()
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(x[:, k]) for k in range(FIGURES)]], names=["h1", "h2", *_FIGURES])

    return materialize(per_text.mapInArrow(by_batch(run), f"h1 bigint, h2 bigint, {_FIGURES_TYPE}"))


def _hashed_text(df: DataFrame, text) -> DataFrame:
    return df.withColumn("h1", F.xxhash64(text)).withColumn("h2", F.xxhash64(F.lit(1), text))


def _with_features(rows: DataFrame, keys: str, words: DataFrame | None, shared: list[Broadcast] | None, window: int) -> DataFrame:
    """The key columns of ``rows(keys ..., text)``, given as a schema, and the features."""
    if shared is not None:
        return rows.mapInArrow(_features(shared, window), f"{keys}, {_FIGURES_TYPE}")
    rows = _hashed_text(rows, F.col("text"))
    found = joined_features(rows, words, window)
    names = [c for c in rows.columns if c not in ("text", "h1", "h2")]
    some = lookup_join(rows.drop("text"), found, ["h1", "h2"])
    return some.select(*names, *[F.coalesce(f, F.lit(0.0)).alias(f) for f in _FIGURES])


def _design(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = (x - mean) / scale
    return np.column_stack([np.ones(len(z)), z, z[:, 1] * z[:, 2]])


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean and scale of the features and logistic weights, by Newton steps with a small ridge."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = _design(x, mean, scale)
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grade = z.T @ (p - y) + ridge * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), grade)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


SCORED = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
)


def _remainder(column: str) -> F.Column:
    return F.crc32(F.col(column).cast("string")) % PARTS


def train(docs: DataFrame, labels: DataFrame, order: int = ORDER, window: int = WINDOW, fit_rows: int = FIT_ROWS, held_grams: int = HELD_GRAMS):
    """The words' ratios (None while the grams are sent), the grams as ``sent``, and the curve; None without labelled rows of both classes in the counted and the fitted parts.

    ``docs(doc_id, text)``, ``labels(doc_id, toxic)``. Labels of held-out rows
    are dropped before anything is counted. Several labels of one id count as
    the larger; NULL labels and ids are no labels.
    """
    known = narrow(labels, doc_id="doc_id", toxic="toxic").filter("doc_id is not null and toxic is not null")
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")).withColumn("part", _remainder("doc_id")).filter("part <> 0")
    # the ids with the smallest hash, the same ones at every run; their texts are read where they lie
    chosen = materialize(known.filter("part = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
    # every labelled row that does not fit the curve is counted
    counted = known.join(maybe_broadcast(chosen.select("doc_id")), "doc_id", "left_anti")
    rows = docs.join(maybe_broadcast(counted), "doc_id").select("toxic", "text")
    # every word of the corpus has a row, which joins with labels do not shuffle the texts for
    rows = rows.unionByName(docs.select(F.lit(None).cast("int").alias("toxic"), "text"))
    counted = rows.mapInArrow(_word_counts, "word binary, " + ", ".join(f"{c} bigint" for c in COUNTS))
    counted = materialize(counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in COUNTS]))
    if counted.agg((F.max("nt") > 0) & (F.max("no") > 0)).first()[0] is not True:
        return None
    seen, unseen = named(*class_ratios(counted, order))
    told, other = telling_words(counted)
    shared = sent(seen, unseen, order, held_grams, told, other)
    words = None
    if shared is None:
        words = word_ratios(counted, seen, unseen, order).join(told, "word", "left")
        words = materialize(words.withColumn("told", F.coalesce("told", F.lit(other))))
    some = docs.join(maybe_broadcast(chosen), "doc_id").select("toxic", "text")
    found = _with_features(some, "toxic int", words, shared, window).toArrow()
    y = found["toxic"].to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return None
    x = np.column_stack([found[c].to_numpy() for c in _FIGURES])
    # summed in one order at every run
    at = np.lexsort((*x.T, y))
    return words, shared, fit_curve(x[at], y[at])


def _logit(curve: tuple[np.ndarray, np.ndarray, np.ndarray]) -> F.Column:
    mean, scale, w = curve
    z = [(F.col(f"f{k}") - float(mean[k])) / float(scale[k]) for k in range(FIGURES)]
    return F.lit(float(w[0])) + sum(float(w[k + 1]) * z[k] for k in range(FIGURES)) + float(w[FIGURES + 1]) * z[1] * z[2]


def toxicity(docs: DataFrame, labels: DataFrame, order: int = ORDER, window: int = WINDOW, fit_rows: int = FIT_ROWS, held_grams: int = HELD_GRAMS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs(doc_id, text)``.

    ``held_out`` says that crc32 of the id as text is a multiple of 5 (false for
    a NULL id); labels of such rows are never read. NULL and empty texts get
    the score of a text without evidence. Repeated rows are scored alike; an
    empty table gives an empty one. Without labels of both classes every score
    is 0. Ids, languages and sources are no input of a score; other columns are
    not read.
    """
    rows = narrow(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    trained = train(rows, labels, order, window, fit_rows, held_grams)
    rows = rows.select("doc_id", F.coalesce(_remainder("doc_id") == 0, F.lit(False)).alias("held_out"), "text")
    if trained is None:
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    words, shared, curve = trained
    found = _with_features(rows, "doc_id bigint, held_out boolean", words, shared, window)
    score = 1 / (1 + F.exp(-_logit(curve)))
    return found.select("doc_id", "held_out", score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, order: int = ORDER, window: int = WINDOW, fit_rows: int = FIT_ROWS, held_grams: int = HELD_GRAMS) -> DataFrame:
    """``docs`` without the rows predicted as toxic; all columns and repeated rows stay, unread labels as in ``toxicity``.

    While the grams' ratios are few enough to be sent, in parts or whole, a row is kept or not by
    its own text, in place; beyond that rows look their text's features up.
    """
    rows = narrow(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    trained = train(rows, labels, order, window, fit_rows, held_grams)
    if trained is None:
        return docs
    words, shared, curve = trained
    if shared is None:
        named = _hashed_text(packed_rows(docs), F.col("row").getField("text"))
        found = joined_features(_hashed_text(rows, F.col("text")), words, window)
        zero = [F.coalesce(f, F.lit(0.0)).alias(f) for f in _FIGURES]
        kept = lookup_join(named, found, ["h1", "h2"]).select("row", *zero).filter(_logit(curve) < 0)
        return kept.select(*unpacked(docs.columns))
    score = _features(shared, window)

    @F.arrow_udf("boolean")
    def stays(text: pa.Array) -> pa.Array:
        found = next(score(iter([pa.RecordBatch.from_arrays([text], names=["text"])])))
        x = np.column_stack([found.column(k).to_numpy(zero_copy_only=False) for k in range(FIGURES)])
        pa.default_memory_pool().release_unused()
        return pa.array(_design(x, *curve[:2]) @ curve[2] < 0)

    # only texts go to the Python workers and only a flag comes back: the rows stay where they are
    return docs.filter(stays(F.col("text")))
