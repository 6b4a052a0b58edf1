"""Benchmark decontamination on templates, by SQL functions only.

Texts become token sequences in which numbers, names and units are typed
placeholders. Windows of template tokens are hashed and hash-joined with the
benchmark's. Windows that meet at one offset form an alignment; it counts when
it covers enough of the item and its slots are consistent: equal values of the
item stand for equal values in the document, and different for different ones,
but for one slot or a fifth of them. A name of several words is one slot, so a
question with other numbers or longer or shorter names is found like a verbatim copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelearn.functions.columns import let
from framelearn.llm.common import narrow, packed_rows, unpacked
from framelearn.plans.scale import maybe_broadcast
from framelearn.session import materialize

#: Template tokens per window; items with fewer are one window of their own length.
WINDOW = 8
#: Items with fewer tokens cannot be told from ordinary text and are not searched for.
MIN_TOKENS = 4
#: Share of an item's windows that one alignment must cover.
MIN_SHARE = 0.3
#: Share of an alignment's slots that may break the one-to-one rule; one slot always may.
MAX_BROKEN = 0.2

#: Words that are units when they follow a number.
UNITS = (
    "km", "kilometers", "kilometres", "m", "meters", "metres", "cm", "mm", "miles", "mile", "feet", "foot", "ft", "inches", "inch",
    "kg", "kilograms", "g", "grams", "mg", "tons", "pounds", "lb", "lbs", "ounces", "oz", "liters", "litres", "l", "ml", "gallons",
    "hours", "hour", "h", "minutes", "minute", "min", "seconds", "second", "s", "days", "day", "weeks", "week", "months", "month",
    "years", "year", "dollars", "dollar", "cents", "euros", "euro", "usd", "eur", "percent", "degrees", "mph", "kmh", "volts", "watts", "hz",
)

_NUMBER, _NAME, _UNIT, _JOINT = "\u0001", "\u0002", "\u0003", "\u0004"
#: What may stand between the words of a name: a blank or a line's end.
_GAP = "[ \\t\\r\\n]{1,2}"


def marked_tokens(text: Column) -> Column:
    """Lower-case words of a text; numbers, names and units keep their value behind a mark of their type.

    A number is a run of digits, with dots and commas between digits taken out.
    A unit is a listed word behind a number. A name is a capitalised word behind
    a word, comma or semicolon, where no sentence starts; a blank or a line's end
    may stand between. Names that follow each other are one name. Words are runs
    of letters and digits. Control characters count as gaps.
    """
    t = F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x00-\\x08]", " ")
    t = F.regexp_replace(t, "(?<=[0-9])[.,](?=[0-9])", "")
    # a name's first letter is seen behind a lower-case letter, digit, comma or semicolon and a gap
    t = F.regexp_replace(t, f"([\\p{{Ll}}0-9,;]{_GAP})(?=\\p{{Lu}}\\p{{Ll}})", "$1" + _NAME)
    t = F.regexp_replace(t, f"({_NAME}\\p{{L}}+){_GAP}(?={_NAME})", "$1" + _JOINT)
    t = F.replace(t, F.lit(_JOINT + _NAME), F.lit(_JOINT))
    t = F.regexp_replace(t, "([0-9]+)", " " + _NUMBER + "$1 ")
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    t = F.regexp_replace(t, f"({_NUMBER}[0-9]+  ?)(?=(?:{units})(?![\\p{{L}}0-9]))", "$1" + _UNIT)
    t = F.lower(t)
    parts = F.split(t, f"[^\\p{{L}}0-9{_NUMBER}{_NAME}{_UNIT}{_JOINT}]+")
    return F.filter(parts, lambda w: ~w.isin("", _NAME, _UNIT, _NUMBER))


def _kind(token: Column) -> Column:
    return F.substring(token, 1, 1)


def _is_slot(token: Column) -> Column:
    return F.ascii(token) <= 3


def template(tokens: Column) -> Column:
    """Tokens with every value replaced by its type's mark."""
    return F.transform(tokens, lambda w: F.when(_is_slot(w), _kind(w)).otherwise(w))


def _window_hashes(hashes: Column, n: int) -> Column:
    """A struct (n, pos, h) for every run of ``n`` token hashes."""

    def over(h: Column) -> Column:
        size = F.size(h)
        runs = F.transform(
            F.sequence(F.lit(0), size - n), lambda i: F.struct(F.lit(n).alias("n"), i.alias("pos"), F.xxhash64(*[F.get(h, i + j) for j in range(n)]).alias("h"))
        )
        return F.when(size >= n, runs).otherwise(F.array().cast("array<struct<n:int,pos:int,h:bigint>>"))

    return let(hashes, over)


def _token_hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda w: F.xxhash64(F.when(_is_slot(w), _kind(w)).otherwise(w)))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    min_tokens: int = MIN_TOKENS,
    min_share: float = MIN_SHARE,
    max_broken: float = MAX_BROKEN,
) -> DataFrame:
    """Documents that hold benchmark items: one row per distinct (doc_id, text, item_id).

    Returns doc_id, ``text_hash`` (two 64-bit hashes that name the text where ids
    repeat or are NULL), item_id, ``share`` of the item's windows covered by the
    best alignment, ``n_slots`` compared, ``n_changed`` of them with another
    value, ``verbatim`` (no slot changed). An alignment stands while the slots
    beyond the first image of each value, counted from either side, are one or at
    most ``max_broken`` of all. Items with equal ids are one row of
    the benchmark each and are told apart by their text. NULL and empty texts on
    either side match nothing; items under ``min_tokens`` tokens are not
    searched for; empty tables give an empty result. Other columns are not read.

    Document windows are joined with the benchmark's by hash and never meet each
    other, so a passage in many documents costs one row per window. The
    benchmark's windows are broadcast only when measured small.
    """
    items = narrow(benchmark, item_id="item_id", text="text").distinct()
    items = items.withColumn("item_text", F.xxhash64("text")).withColumn("tokens", marked_tokens(F.col("text"))).drop("text")
    items = materialize(items.filter(F.size("tokens") >= min_tokens))
    items = items.withColumn("n", F.least(F.size("tokens"), F.lit(window)))
    lengths = sorted(r["n"] for r in items.select("n").distinct().collect())  # at most ``window`` numbers
    item_hashes = items.withColumn("_h", _token_hashes(F.col("tokens")))

    def item_windows(n: int) -> DataFrame:
        found = item_hashes.filter(F.col("n") == n).withColumn("_w", F.explode(_window_hashes(F.col("_h"), n)))
        return found.select("item_id", "item_text", F.lit(n).alias("n"), F.col("_w.pos").alias("ipos"), F.col("_w.h").alias("h"))

    texts = narrow(docs, doc_id="doc_id", text="text").withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(1), F.col("text")))
    if not lengths:
        none = texts.limit(0).select("doc_id", "h1", "h2", F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id"))
        return _result(none.select("*", *[F.lit(0).alias(c) for c in ("item_text", "share", "n_slots", "n_changed")]))
    known = item_windows(lengths[0])
    for n in lengths[1:]:
        known = known.unionByName(item_windows(n))
    known = materialize(known)
    hashed = texts.withColumn("_h", _token_hashes(marked_tokens(F.col("text"))))
    every = F.concat(*[_window_hashes(F.col("_h"), n) for n in lengths])
    spread = hashed.select("doc_id", "h1", "h2", F.explode(every).alias("_w"))
    spread = spread.select("doc_id", "h1", "h2", F.col("_w.n").alias("n"), F.col("_w.pos").alias("pos"), F.col("_w.h").alias("h"))
    hits = spread.join(maybe_broadcast(known), ["n", "h"])
    sizes = known.groupBy("item_id", "item_text").agg(F.count(F.lit(1)).alias("windows"))
    at = ["doc_id", "h1", "h2", "item_id", "item_text"]
    aligned = hits.groupBy(*at, (F.col("pos") - F.col("ipos")).alias("shift")).agg(F.countDistinct("ipos").alias("met"), F.min("ipos").alias("lo"), F.max(F.col("ipos") + F.col("n")).alias("hi"))
    same_item = F.col("a.item_id").eqNullSafe(F.col("s.item_id")) & (F.col("a.item_text") == F.col("s.item_text"))
    aligned = aligned.alias("a").join(maybe_broadcast(sizes).alias("s"), same_item).select("a.*", (F.col("s.windows")).alias("windows"))
    aligned = materialize(aligned.withColumn("share", F.col("met") / F.col("windows")).filter(F.col("share") >= min_share))

    # slots: only documents with an alignment are read for their values
    named = maybe_broadcast(aligned.select("h1", "h2").distinct())
    chosen = texts.join(named, ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"]).select("h1", "h2", marked_tokens(F.col("text")).alias("d"))
    both = aligned.join(chosen, ["h1", "h2"]).alias("a")
    wanted = maybe_broadcast(items.select("item_id", "item_text", F.col("tokens").alias("i"))).alias("s")
    both = both.join(wanted, same_item).select("a.*", "s.i")
    slots = F.filter(F.sequence("lo", F.col("hi") - 1), lambda p: _is_slot(F.get(F.col("i"), p)))
    pairs = F.transform(slots, lambda p: F.struct(F.get(F.col("i"), p).alias("x"), F.get(F.col("d"), p + F.col("shift").cast("int")).alias("y")))
    both = both.withColumn("pairs", pairs).withColumn("kinds", F.size(F.array_distinct("pairs")))
    images = [F.col("kinds") - F.size(F.array_distinct(F.transform("pairs", lambda p: p[side]))) for side in ("x", "y")]
    agree = F.greatest(*images) <= F.greatest(F.lit(1), F.floor(F.size("pairs") * max_broken))
    checked = both.filter(agree).select(
        *at, "share", F.size("pairs").alias("n_slots"), F.size(F.filter("pairs", lambda p: p["x"] != p["y"])).alias("n_changed")
    )
    return _result(checked)


def _result(rows: DataFrame) -> DataFrame:
    best = F.max(F.struct(F.col("share").cast("double").alias("share"), (-F.col("n_changed")).cast("long").alias("less"), F.col("n_slots").cast("long").alias("n_slots")))
    found = rows.groupBy("doc_id", "h1", "h2", "item_id", "item_text").agg(best.alias("b"))
    return found.select(
        "doc_id", F.struct("h1", "h2").alias("text_hash"), "item_id", F.col("b.share").alias("share"), F.col("b.n_slots").alias("n_slots"),
        (-F.col("b.less")).alias("n_changed"), (F.col("b.less") == 0).alias("verbatim"),
    )


def benchmark_leaks(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """doc_id, item_id, share, n_slots, n_changed, verbatim for each document and item it holds (see ``contaminated``)."""
    return contaminated(docs, benchmark, **parameters).select("doc_id", "item_id", "share", "n_slots", "n_changed", "verbatim")


def without_leaks(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """``docs`` without the rows whose text holds an item; all columns and repeated rows stay."""
    found = contaminated(docs, benchmark, **parameters).select(F.col("text_hash.h1").alias("_x1"), F.col("text_hash.h2").alias("_x2")).distinct()
    text = F.col("row").getField("text")
    named = packed_rows(docs).withColumn("h1", F.xxhash64(text)).withColumn("h2", F.xxhash64(F.lit(1), text))
    kept = named.join(maybe_broadcast(materialize(found)), (F.col("h1") == F.col("_x1")) & (F.col("h2") == F.col("_x2")), "left_anti")
    return kept.select(*unpacked(docs.columns))
