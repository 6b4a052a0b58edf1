"""Bottom-k sketches of shingle hashes, by SQL functions only.

A sketch is the sorted array of the ``k`` smallest distinct 64-bit hashes of a
text's word shingles. The sketch of several parts is the k smallest of their
sketches' union, so sketches merge in any order. Two sketches estimate how
alike the sets are, how much of one lies in the other, and how many distinct
shingles there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelearn.functions.columns import let
from framelearn.llm.common import narrow
from framelearn.plans.scale import range_bucket, split_points

K = 128
WORDS = 5

#: The ASCII white space that parts words.
SPACE = " \t\n\x0b\x0c\r"
_GAP = "[\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    """Lower-cased words ``[^\\x20\\x09-\\x0D]+``; no words for NULL and empty texts."""
    body = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(SPACE))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, _GAP))


def shingle_hashes(text: Column, n: int = WORDS) -> Column:
    """A hash for each run of ``n`` words; one for the whole sequence when there are fewer; none without words."""

    def over(h: Column) -> Column:
        size = F.size(h)
        runs = F.transform(F.sequence(F.lit(0), size - n), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(n)]))
        whole = F.array(F.xxhash64(h))
        return F.when(size >= n, runs).when(size > 0, whole).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), over)


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K, n: int = WORDS) -> Column:
    return smallest(shingle_hashes(text, n), k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(parts: DataFrame, by: list[str], sketch_col: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group of parts.

    Ranks are limited to ``k`` before the shuffle, so a group of any number of
    parts brings at most ``k`` hashes from each task to the next.
    """
    rows = parts.select(*by, F.explode(sketch_col).alias("_h")).distinct()
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("_h"))).filter(F.col("_r") <= k)
    return ranked.groupBy(*by).agg(F.sort_array(F.collect_list("_h")).alias(sketch_col))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the union that both sets hold: of the union's k smallest, those in both. Two empty sets: 1."""
    union = merged(a, b, k)
    shared = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(shared / F.size(union)).cast("double")


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Exact below ``k`` hashes, else (k - 1) over the k-th smallest hash as a share of the hash range."""
    full = F.element_at(a, k).cast("double") / F.lit(2.0**64) + 0.5
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / full)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set that the second holds; 1 for an empty first set."""
    union = distinct_shingles(merged(a, b, k), k)
    found = resemblance(a, b, k) * union / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(found, F.lit(1.0)))


def as_string(a: Column) -> Column:
    """Base 64 of the hashes as big-endian 8-byte numbers."""
    return F.base64(F.unhex(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")))


def with_next(docs: DataFrame, key: str, values: list[str], derive=None, per_task: int = 3) -> DataFrame:
    """Add ``next_<value>`` of the next row in ascending order of ``key``; the last row's next is the first.

    Keys are cut into ranges at some of the keys themselves. The row at a cut is
    also dealt to the range before it, and the very first row to the last
    range, so each range can look one row ahead by itself: one shuffle, no
    single task for the order. NULL keys come first; equal keys are ordered by
    the values. ``derive`` may add columns behind the shuffle.
    """
    spark = docs.sparkSession
    known = docs.filter(F.col(key).isNotNull())
    buckets = per_task * int(spark.conf.get("spark.sql.shuffle.partitions"))
    stats = docs.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("known"), F.min(key).alias("first")).first()
    points = split_points(known, [key], buckets, stats["known"])
    cuts = [p[0] for p in points]
    at = range_bucket(points, docs.schema, [key])
    place = F.struct(F.col("_b").alias("b"), F.lit(0).alias("copy"))
    early = F.struct((F.col("_b") - 1).alias("b"), F.lit(1).alias("copy"))
    wrapped = F.struct(F.lit(len(cuts)).alias("b"), F.lit(2).alias("copy"))
    is_first = F.col(key).isNull() if stats["known"] < stats["n"] else F.col(key) == F.lit(stats["first"])
    is_cut = F.col(key).isin(cuts) if cuts else F.lit(False)
    places = F.filter(F.array(place, F.when(is_cut, early), F.when(is_first, wrapped)), lambda x: x.isNotNull())
    dealt = docs.withColumn("_b", F.coalesce(at, F.lit(0))).withColumn("_p", F.explode(places))
    dealt = dealt.select(*docs.columns, F.col("_p.b").alias("_b"), F.col("_p.copy").alias("_c")).repartition("_b")
    if derive:
        dealt = derive(dealt)
    over = Window.partitionBy("_b").orderBy("_c", F.col(key).asc_nulls_first(), *values)
    added = [c for c in dealt.columns if c not in ("_b", "_c", key)]
    ahead = dealt.select("*", *[F.lead(c).over(over).alias(f"next_{c}") for c in added])
    return ahead.filter(F.col("_c") == 0).drop("_b", "_c")


def document_fingerprints(docs: DataFrame, k: int = K, n: int = WORDS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row.

    The edited text has the last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the next row's text, in ascending order of doc_id
    (NULL first, equal ids by text; after the last the first, so a single row is
    its own next). A NULL text is empty. Texts without words have an empty
    sketch: alike (1) to another one, not at all (0) to any other. Repeated rows
    stay; an empty table gives an empty one; other columns are not read.
    """
    rows = narrow(docs, doc_id="doc_id", text="text").withColumn("text", F.coalesce("text", F.lit("")))
    found = with_next(rows, "doc_id", ["text"], lambda df: df.withColumn("sketch", sketch(F.col("text"), k, n)))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("left(text, cast(length(text) - length(text) div 2 as int))"), F.expr("left(next_text, cast(length(text) div 2 as int))"))
    found = found.withColumn("edited", F.when(half > 0, edited).otherwise(F.col("text")))
    found = found.withColumn("edited_sketch", sketch(F.col("edited"), k, n))
    return found.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_string(F.col("sketch")).alias("fingerprint"),
        as_string(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
    )
