"""Phrase collocations, by marginalising the counts of the longest windows.

Every place of a piece of text gives one window: its word and the words that
lead it, ``max_words`` columns, padded where the piece ends. Only these windows
are counted. Shorter phrases are never exploded on their own: a phrase of k words
occurs once for each window that begins with it, so Spark's ROLLUP over the leading
columns of the counted windows gives the counts of all shorter phrases, which
together with the windows themselves are every phrase count there is.

The lead columns are cut inside a document's row, by zipping its word array with
itself moved on, so no row is shuffled before windows are counted in the map task.
A first pass numbers the words that reach ``min_count``. While that dictionary is
small enough for a broadcast, windows hold numbers in place of words and a rarer
word counts as padding, because no phrase with it can be a candidate; beyond the
limit windows hold the words themselves. Both ways give the same rows.

A phrase is a candidate from ``min_count`` on. Its score is the least, over the
places where it can be cut in two, of scale * a^2 / (l * r) rounded down; products
are 38-digit decimals. A candidate goes when a longer candidate that holds its words
side by side has at least ``percent`` hundredths of its count.

Defined cases: a NULL text is empty, a NULL language is ``und``; repeated rows count
as often as they stand; ids play no part; an empty table gives no row; further columns
of any name are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelearn.llm.common import narrow, stored, workspace
from framelearn.plans.scale import BROADCAST_BYTES, BROADCAST_ROWS, dense_index, fits, lookup_join, unnest

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Stands for the end of a piece among the words: a character that ends pieces is in no word.
_END = "."


def marked_words(text: Column) -> Column:
    """The words of a text in order, with ``_END`` between pieces."""
    small = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    apart = F.regexp_replace(small, r"[.,;:!?\x0A-\x0D]+", f" {_END} ")
    return F.array_remove(F.split(apart, r"[\x20\x09]+"), "")


def _lead_windows(docs: DataFrame, size: int) -> DataFrame:
    """``(lang, w1..wn)``: one row per word, with the words that lead it; ``_END`` where there are none."""
    words = docs.select("lang", F.explode_outer(F.array(marked_words(F.col("text")))).alias("ws"))
    moved = F.arrays_zip(*[(F.col("ws") if k == 0 else F.slice("ws", k + 1, 2**31 - 1 - k)).alias(f"w{k + 1}") for k in range(size)])
    rows = unnest(words, ["lang"], moved, "w")
    names = [f"w{k + 1}" for k in range(size)]
    rows = rows.select("lang", *[F.coalesce(f"w.{n}", F.lit(_END)).alias(n) for n in names])
    return rows.filter(F.col("w1") != _END)


def _padded(columns: list[Column], pad) -> list[Column]:
    """Codes of a window, padding from the first place that has none."""
    out, open_ = [], F.lit(True)
    for c in columns:
        open_ = open_ & c.isNotNull()
        out.append(F.when(open_, c).otherwise(F.lit(pad)))
    return out


def phrase_counts(docs: DataFrame, size: int, min_count: int, folder: str, max_rows: int, max_bytes: int):
    """Counts of all phrases of 1 to ``size`` words that reach ``min_count``.

    Returns ``(counts, words, totals, pad)``: ``counts(g1..gn, order, f)`` with codes
    that ``pad`` fills up, ``words(code, lang, word)`` or None when a code is
    language, tab, word, and ``totals(lang, n)``.
    """
    singles = unnest(docs, ["lang"], marked_words(F.col("text")), "word").filter(F.col("word") != _END)
    singles = stored(singles.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("f")), f"{folder}/words")
    totals = singles.groupBy("lang").agg(F.sum("f").alias("n"))
    often = singles.filter(F.col("f") >= min_count).select("lang", "word")
    rows, names, codes = _lead_windows(docs, size), [f"w{k + 1}" for k in range(size)], [f"g{k + 1}" for k in range(size)]
    words, pad = None, ""
    if fits(often, max_rows, max_bytes):
        numbered = dense_index(often, ["lang", "word"], name="code")
        words, pad = stored(numbered.withColumn("code", (F.col("code") + 1).cast("int")), f"{folder}/codes"), 0
        for name, code in zip(names, codes):
            known = words.select("lang", F.col("word").alias(name), F.col("code").alias(code))
            rows = rows.join(F.broadcast(known), ["lang", name], "inner" if name == "w1" else "left")
        found = [F.col(c) for c in codes]
    else:
        found = [F.when(F.col(w) != _END, F.concat_ws("\t", "lang", w)) for w in names]
    windows = rows.select(*[c.alias(g) for c, g in zip(_padded(found, pad), codes)])
    windows = windows.groupBy(*codes).agg(F.count(F.lit(1)).alias("f"))
    # the longest phrases are the full windows; a condition on key and count together stays above the count, so that
    # both branches read one exchange
    longest = windows.filter(F.when(F.col(codes[-1]) != pad, F.col("f")) >= min_count)
    counts = longest.select(*codes, F.lit(size).alias("order"), "f")
    if size > 1:
        heads = codes[:-1]
        summed = windows.rollup(*heads).agg(F.sum("f").alias("f"), F.grouping_id().alias("_level"))
        # a prefix of k words is a row whose later columns are rolled up; one that ends in padding is no phrase
        level = {2 ** (size - 1 - k) - 1: k for k in range(1, size)}
        order = reduce(lambda c, x: c.when(F.col("_level") == x[0], x[1]), level.items(), F.when(F.lit(False), 0))
        last = F.get(F.array(*heads), F.col("order") - 1)
        short = summed.withColumn("order", order).filter((F.col("f") >= min_count) & F.col("order").isNotNull()).filter(last != pad)
        filled = [F.coalesce(F.col(g), F.lit(pad)).alias(g) for g in heads]
        counts = counts.unionByName(short.select(*filled, F.lit(pad).alias(codes[-1]), "order", "f"))
    return stored(counts, f"{folder}/counts"), words, totals, pad


def _sub(codes: list[str], start: int, length: Column | int, pad) -> list[Column]:
    """Columns k1..kn: the codes from ``start`` on, ``length`` of them, padded."""
    size = len(codes)
    length = F.lit(length) if isinstance(length, int) else length
    return [
        F.when(F.lit(k) < length, F.col(codes[start + k]) if start + k < size else F.lit(pad)).otherwise(F.lit(pad)).alias(f"k{k + 1}")
        for k in range(size)
    ]


def _scored(counts: DataFrame, codes: list[str], pad, scale: int, limits: dict) -> DataFrame:
    """Candidates with l, r and score of their weakest cut."""
    size, keys = len(codes), [f"k{k + 1}" for k in range(len(codes))]
    # both parts of a candidate reach min_count too, so every one of them is in the table
    known = counts.select(*[F.col(g).alias(k) for g, k in zip(codes, keys)], F.col("f").alias("part"))
    cuts = [counts.filter(F.col("order") > k).withColumn("cut", F.lit(k)) for k in range(1, size)]
    cuts = reduce(DataFrame.unionByName, cuts)
    small = fits(known, **limits)

    def with_part(df: DataFrame, name: str, key) -> DataFrame:
        at = [reduce(lambda c, k: c.when(F.col("cut") == k, key(k)[j]), range(2, size), F.when(F.col("cut") == 1, key(1)[j])).alias(keys[j]) for j in range(size)]
        joined = lookup_join(df.select("*", *at), known, keys, "inner", small=small)
        return joined.withColumnRenamed("part", name).drop(*keys)

    both = with_part(cuts, "l", lambda k: _sub(codes, 0, k, pad))
    both = with_part(both, "r", lambda k: _sub(codes, k, F.col("order") - k, pad))
    f, l, r = [f"cast({c} as decimal(19,0))" for c in "flr"]
    cut = both.withColumn("score", F.expr(f"cast((cast({scale} as decimal(10,0)) * {f} * {f}) div ({l} * {r}) as long)"))
    least = F.min(F.struct("score", "cut", "l", "r"))
    return cut.groupBy(*codes, "order", "f").agg(least.alias("m")).select(*codes, "order", "f", "m.score", "m.l", "m.r")


def _outlived(counts: DataFrame, codes: list[str], pad, percent: int) -> DataFrame:
    """Keys of candidates that a longer candidate holds, with at least ``percent`` hundredths of their count."""
    size = len(codes)
    shorter = []
    for order in range(3, size + 1):
        longer = counts.filter(F.col("order") == order)
        for length in range(2, order):
            for start in range(order - length + 1):
                sub = [c.alias(g) for c, g in zip(_sub(codes, start, length, pad), codes)]
                shorter.append(longer.select(*sub, F.col("f").alias("held")))
    if not shorter:
        return counts.filter(F.lit(False)).select(*codes)
    most = reduce(DataFrame.unionByName, shorter).groupBy(*codes).agg(F.max("held").alias("held"))
    both = counts.join(most, codes, "inner")
    return both.filter(F.lit(100) * F.col("held") >= F.lit(percent) * F.col("f")).select(*codes)


def phrase_collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    max_words: int = 3,
    min_count: int = 10,
    percent: int = 50,
    keep: int = 2000,
    scale: int = 1_000_000,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The ``keep`` best phrases of 2 to ``max_words`` words of each language.

    Rows: lang, rank from 1, phrase, a (its count), l and r (those of the two parts at
    its weakest cut), n (all words of the language), score; by score and a descending,
    then the phrase in byte order. See the module for the rules.
    """
    if max_words < 2:
        raise ValueError("phrases have at least two words")
    folder = workspace(docs.sparkSession, "collocations")
    limits = {"max_rows": max_rows, "max_bytes": max_bytes}
    docs = narrow(docs, text=text, lang=lang).withColumn("lang", F.coalesce("lang", F.lit("und")))
    counts, words, totals, pad = phrase_counts(docs, max_words, min_count, folder, **limits)
    codes = [f"g{k + 1}" for k in range(max_words)]
    candidates = counts.filter(F.col("order") >= 2)
    scored = _scored(counts, codes, pad, scale, limits)
    stay = stored(scored.join(_outlived(candidates, codes, pad, percent), codes, "left_anti"), f"{folder}/scored")
    if words is None:
        split = [F.substring_index(g, "\t", -1).alias(f"w{k + 1}") for k, g in enumerate(codes)]
        language = F.expr("left(g1, length(g1) - length(substring_index(g1, '\t', -1)) - 1)")
        named = stay.withColumn("lang", language).select("*", *split)
    else:
        named = stay
        for k, g in enumerate(codes):
            right = words.select(F.col("code").alias(g), F.col("word").alias(f"w{k + 1}"), *([F.col("lang")] if k == 0 else []))
            named = lookup_join(named, right, [g], "left", small=True)
    phrase = F.array_join(F.slice(F.array(*[f"w{k + 1}" for k in range(max_words)]), F.lit(1), F.col("order")), " ")
    named = named.withColumn("phrase", phrase).select("lang", "phrase", F.col("f").alias("a"), "l", "r", "score")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within parts of a language, so that a language of any size reaches its last window as parts * keep rows
    part = named.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    near = part.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*best))).filter(F.col("_rank") <= keep)
    top = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).filter(F.col("rank") <= keep)
    known = lookup_join(top.drop("_part", "_rank"), totals, ["lang"], "inner", **limits)
    return known.select("lang", "rank", "phrase", *[F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")])
