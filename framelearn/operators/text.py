"""Corpus -> tokens -> vocabulary -> ids -> training windows.

Documents stay one row with an array of tokens wherever the step is a
projection, so tokenising, encoding with a vocabulary that fits a broadcast, and
cutting windows need no shuffle. The long form ``(doc, pos, token)`` is there for
vocabularies beyond a broadcast and for streams of tokens longer than one row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelearn.plans.scale import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    CHUNK_ELEMENTS,
    chunk_lookup,
    dense_index,
    fits,
    list_like,
    lookup_join,
    order_hash,
    running_total,
    unnest,
)
from framelearn.session import materialize

# The delimiters that stay as tokens of their own (without and
# with the exclamation mark), the marks that decoding pulls back to the word
# before, the special tokens, and the separator between documents.
DELIMITERS = r"""([,.:;?_"()']|--)"""
DELIMITERS_BANG = r"""([,.:;?_!"()']|--)"""
NO_SPACE_BEFORE = r"""\s+([,.?!"()'])"""
END_OF_TEXT = "<|endoftext|>"
UNKNOWN = "<|unk|>"
SEPARATOR = " <|endoftext|> "

#: White space as Python strings know it: the Unicode property and four control characters.
_SPACES = r"(?U)[\s\x1c-\x1f]+"


# --- tokens ---------------------------------------------------------------


def token_array(text: Column, bang: bool = False) -> Column:
    """Pieces of the text between white space, delimiters kept, blanks dropped."""
    apart = F.regexp_replace(text, DELIMITERS_BANG if bang else DELIMITERS, "\x1f$1\x1f")
    return F.array_remove(F.split(apart, _SPACES), "")


def isolate_specials(text: Column, specials: Sequence[str]) -> Column:
    """Put spaces around special tokens so that they pass the tokeniser whole."""
    for s in specials:
        text = F.replace(text, F.lit(s), F.lit(f" {s} "))
    return text


def tokenize(df: DataFrame, col: str = "text", out: str = "tokens", bang: bool = False, specials: Sequence[str] = ()) -> DataFrame:
    """Add the token array; ``specials`` are cut out whole even where they touch a word."""
    return df.withColumn(out, token_array(isolate_specials(F.col(col), specials), bang))


def explode_tokens(df: DataFrame, keys: Sequence[str], tokens: str = "tokens", out: str = "token") -> DataFrame:
    return unnest(df, keys, tokens, out, "pos")


def collect_positions(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Long form back to one array per key; a key's rows come from one document row."""
    pairs = F.array_sort(F.collect_list(F.struct("pos", value)))
    return df.groupBy(*keys).agg(F.transform(pairs, lambda p: p[value]).alias(out))


# --- vocabulary -----------------------------------------------------------


def token_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    return unnest(df, [], tokens, "token").groupBy("token").agg(F.count(F.lit(1)).alias("freq"))


def build_vocab(df: DataFrame, tokens: str = "tokens", specials: Sequence[str] = (), **kw) -> DataFrame:
    """``(token, id)``: distinct tokens in code-point order from 0, specials after them.

    The corpus is read once: the distinct tokens are kept as a checkpoint, and so
    is the numbered result, which later look-ups measure and read several times.
    A special that also occurs in the corpus keeps only its place at the end.
    """
    words = materialize(unnest(df, [], tokens, "token").distinct())
    size = words.count()
    vocab = dense_index(words, ["token"], name="id", rows=size, **kw)
    if specials:
        vocab = vocab.filter(~F.col("token").isin(list(specials)))
        extra = [(s, size + i) for i, s in enumerate(specials)]
        vocab = vocab.unionByName(df.sparkSession.createDataFrame(extra, "token string, id long"))
    return materialize(vocab)


def vocab_preview(vocab: DataFrame, n: int = 11) -> DataFrame:
    return vocab.orderBy("id").limit(n)


def out_of_vocabulary(tokens_long: DataFrame, vocab: DataFrame) -> DataFrame:
    """Tokens that the vocabulary does not hold, with their counts."""
    counts = tokens_long.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(vocab.select("token"), "token", "left_anti")


# --- ids ------------------------------------------------------------------


def _strict(found: Column, message: str) -> Column:
    return F.when(F.exists(found, lambda i: i.isNull()), F.raise_error(F.lit(message))).otherwise(found)


def _replaced(column: pa.Array, index: pd.Index, values: pa.Array) -> pa.Array:
    """An array of arrays with every element looked up in the index; NULL where it is not there."""
    kinds = column.flatten().dictionary_encode()
    at = index.get_indexer(kinds.dictionary.to_pandas())
    found = values.take(pa.array(at, mask=at < 0)).take(kinds.indices)
    return list_like(column, found)


def _lookup_udf(spark, keys: pa.Array, values: pa.Array, result: str):
    """Array column -> array column by a broadcast dictionary, in Arrow's hash look-up."""
    shared = spark.sparkContext.broadcast({"keys": keys, "values": values})

    @F.arrow_udf(result)
    def look_up(column: pa.Array) -> pa.Array:
        held = shared.value
        if "index" not in held:  # the worker keeps the broadcast value, and so the index, between batches and tasks
            held["index"] = pd.Index(held["keys"].to_pandas())
        return _replaced(column, held["index"], held["values"])

    return look_up


def _arrow_pair(df: DataFrame, key: str, value: str) -> tuple[pa.Array, pa.Array]:
    got = df.select(key, value).toArrow()
    return got[key].combine_chunks(), got[value].combine_chunks()


def encode_long(
    tokens_long: DataFrame, vocab: DataFrame, on_unknown: str = "error", unk: str = UNKNOWN, **limits
) -> DataFrame:
    """Add ``id`` to a table of tokens; hot tokens never meet in one task."""
    joined = lookup_join(tokens_long, vocab, ["token"], "left", kept=False, **limits)
    if on_unknown == "unk":
        found = F.coalesce("id", F.lit(_unknown_id(vocab, unk)))
    else:
        found = F.coalesce("id", F.raise_error(F.concat(F.lit("token not in vocabulary: "), F.coalesce("token", F.lit("NULL")))).cast("long"))
    return joined.withColumn("id", found)


def _unknown_id(vocab: DataFrame, unk: str) -> int:
    row = vocab.filter(F.col("token") == unk).select("id").first()
    if row is None:
        raise ValueError(f"the vocabulary has no {unk}")
    return row[0]


def _look_up(
    df: DataFrame, col: str, out: str, lookup: DataFrame, key: str, value: str, max_rows: int, max_bytes: int, chunk: int = CHUNK_ELEMENTS
) -> DataFrame:
    """Add ``out``: the array ``col`` with each element replaced by its ``value`` in ``lookup``, NULL where it has none.

    A table within the limits is looked up in place, without a shuffle; a larger
    one by chunks of rows (``chunk_lookup``).
    """
    kind = lookup.schema[value].dataType
    if fits(lookup, max_rows, max_bytes):
        keys, values = _arrow_pair(lookup, key, value)
        return df.withColumn(out, _lookup_udf(df.sparkSession, keys, values, f"array<{kind.simpleString()}>")(F.col(col)))
    return chunk_lookup(df, col, out, lookup, key, value, chunk)


def encode(
    df: DataFrame,
    vocab: DataFrame,
    tokens: str = "tokens",
    out: str = "ids",
    on_unknown: str = "error",
    unk: str = UNKNOWN,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Token arrays to id arrays, row by row.

    A vocabulary within the limits is looked up in place, without a shuffle. A
    larger one is joined with the distinct tokens of chunks of rows. Rows come out
    the same either way, whatever their keys.
    """
    found = _look_up(df, tokens, "_f", vocab, "token", "id", max_rows, max_bytes)
    if on_unknown == "unk":
        fill = F.lit(_unknown_id(vocab, unk))
        ids = F.transform("_f", lambda i: F.coalesce(i, fill))
    else:
        ids = _strict(F.col("_f"), "token not in vocabulary")
    return found.withColumn(out, ids).drop("_f")


def encode_by_dictionary(
    df: DataFrame,
    dictionary: DataFrame,
    tokens: str = "tokens",
    out: str = "ids",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Replace every token by its list of ids from ``(token, ids)``; lists are strung together.

    A dictionary within the limits is looked up in place; a larger one is joined
    with the distinct tokens of chunks of rows. Every token must be in it.
    """
    found = _look_up(df, tokens, "_f", dictionary, "token", "ids", max_rows, max_bytes)
    known = found.withColumn("_f", _strict(F.col("_f"), "token not in dictionary"))
    return known.withColumn(out, F.flatten("_f")).drop("_f")


def tidy_text(text: Column) -> Column:
    """Remove the space before , . ? ! " ( ) ' that joining with spaces left."""
    return F.regexp_replace(text, NO_SPACE_BEFORE, "$1")


def decode_arrays(
    df: DataFrame,
    vocab: DataFrame,
    ids: str = "ids",
    out: str = "tokens",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Id arrays to token arrays, row by row; an id outside the vocabulary is an error."""
    found = _look_up(df, ids, "_f", vocab, "id", "token", max_rows, max_bytes)
    return found.withColumn(out, _strict(F.col("_f"), "id not in vocabulary")).drop("_f")


def decode(df: DataFrame, vocab: DataFrame, ids: str = "ids", out: str = "decoded", **limits) -> DataFrame:
    """Id arrays back to text, joined with spaces and tidied."""
    words = decode_arrays(df, vocab, ids, "_t", **limits)
    return words.withColumn(out, tidy_text(F.array_join("_t", " "))).drop("_t")


def decode_long(ids_long: DataFrame, vocab: DataFrame, **limits) -> DataFrame:
    joined = lookup_join(ids_long, vocab.select("id", "token"), ["id"], "left", kept=False, **limits)
    missing = F.raise_error(F.concat(F.lit("id not in vocabulary: "), F.coalesce(F.col("id").cast("string"), F.lit("NULL")))).cast("string")
    return joined.withColumn("token", F.coalesce("token", missing))


# --- joined documents -----------------------------------------------------


#: More documents than a group holds.
_DOCS = 10**15


def concat_documents(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    col: str = "text",
    sep: str = SEPARATOR,
    max_docs: int = 1024,
    max_bytes: int = 64 * 1024 * 1024,
    **kw,
) -> DataFrame:
    """Texts of a group joined in order, as pieces of at most ``max_docs`` documents and about ``max_bytes``.

    Reading a group's pieces in order gives the joined string letter for letter
    (later pieces begin with the separator), while no task holds a whole group.
    A NULL text is joined as an empty one. A piece ends with the document that
    fills its ``max_bytes`` of UTF-8, so it is longer by less than one document;
    ``piece`` numbers rise in order and leave gaps where one document fills
    several pieces.
    """
    # bytes and documents before a text are summed as one number, so that texts travel once for both
    sizes = F.octet_length(F.coalesce(F.col(col), F.lit(""))) + len(sep.encode())
    both = (sizes.cast("decimal(11,0)") * F.lit(_DOCS) + F.lit(1)).cast("decimal(28,0)")
    placed = running_total(df.select(*by, *order, col), order, both, by, name="_both", kind="decimal(38,0)", **kw)
    placed = placed.withColumn("_i", F.expr(f"cast(_both % {_DOCS}L as bigint)")).withColumn("_bytes", F.expr(f"_both div {_DOCS}L")).drop("_both")
    # both parts only ever rise, so their sum tells apart what either of them does
    placed = placed.withColumn("piece", F.floor(F.col("_i") / max_docs) + F.floor(F.col("_bytes") / max_bytes)).drop("_bytes")
    body = F.concat(F.when(F.col("_i") > 0, F.lit(sep)).otherwise(F.lit("")), F.coalesce(F.col(col), F.lit("")))
    parts = F.array_sort(F.collect_list(F.struct("_i", body.alias("t"))))
    return placed.groupBy(*by, "piece").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.array_join(F.transform(parts, lambda p: p["t"]), "").alias("joined"),
    )


def token_stream(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    tokens: str = "tokens",
    sep_token: str = END_OF_TEXT,
    **kw,
) -> DataFrame:
    """``(by, pos, token)``: the tokens of a group's joined documents, numbered through.

    Each document gets the number of tokens before it; nothing is joined to one string.
    """
    placed = running_total(df.select(*by, *order, tokens), order, F.size(tokens) + 1, by, name="_o", **kw)
    with_sep = F.concat(F.array(F.lit(sep_token)), F.col(tokens))
    long = unnest(placed, [*by, "_o"], with_sep, "token", "_p")
    return long.select(*by, (F.col("_o") + F.col("_p") - 1).alias("pos"), "token").filter(F.col("pos") >= 0)


# --- training windows -----------------------------------------------------


def shift_pair(df: DataFrame, offset: int, length: int, ids: str = "ids") -> DataFrame:
    """x = ids[offset : offset+L], y = the same moved on by one; shorter at the end of the text."""
    return df.withColumn("x", F.slice(ids, offset + 1, length)).withColumn("y", F.slice(ids, offset + 2, length))


def next_token_pairs(df: DataFrame, offset: int, length: int, keys: Sequence[str], ids: str = "ids") -> DataFrame:
    """Contexts of 1..L+1 ids from the offset, each with the id that follows."""
    room = F.least(F.lit(length + 1), F.size(ids) - F.lit(offset) - 1)
    steps = F.when(room >= 1, F.sequence(F.lit(1), room))
    grown = unnest(df, [*keys, ids], steps, "n")
    return grown.select(
        *keys,
        "n",
        F.slice(F.col(ids), F.lit(offset + 1), F.col("n")).alias("context"),
        F.get(F.col(ids), F.lit(offset) + F.col("n")).alias("desired"),
    )


def window_count(n: Column, length: int, stride: int) -> Column:
    """How many windows a sequence of n ids gives: the size of range(0, n - L, stride)."""
    return F.greatest(F.lit(0), F.ceil((n - length) / F.lit(stride))).cast("long")


def _windows(df: DataFrame, length: int, stride: int, keys: Sequence[str], ids: str) -> DataFrame:
    """``(keys, chunk_id, w)`` with the L+1 ids of each window."""
    n = F.size(ids)
    starts = F.when(n > length, F.sequence(F.lit(0), n - length - 1, F.lit(stride)))
    cut = unnest(df, [*keys, ids], starts, "_s", "chunk_id")
    window = F.slice(F.col(ids), F.col("_s") + 1, length + 1)
    return cut.select(*keys, F.col("chunk_id").cast("long").alias("chunk_id"), window.alias("w"))


def _pair(length: int, kind: str | None = None) -> list[Column]:
    w = F.col("w") if kind is None else F.col("w").cast(kind)
    return [F.slice(w, 1, length).alias("input_ids"), F.slice(w, 2, length).alias("target_ids")]


def lm_windows(df: DataFrame, length: int, stride: int, keys: Sequence[str] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """Input ids [i, i+L) and target ids [i+1, i+L+1) for i in range(0, n-L, stride). No shuffle."""
    return _windows(df, length, stride, keys, ids).select(*keys, "chunk_id", *_pair(length))


def lm_windows_long(
    df: DataFrame, length: int, stride: int, keys: Sequence[str], pos: str = "pos", value: str = "id", block: int = 65_536
) -> DataFrame:
    """The same windows from the long form, whose positions run from 0 without gaps.

    A stream is cut into blocks of ``block`` positions; each block also gets the
    ``length`` tokens behind it and cuts the windows that start in it. A token
    is sent at most twice, and a group is one block, however long the stream.
    """
    block = max(block, length)
    at = F.floor(F.col(pos) / F.lit(block)).cast("long")
    # the block before needs the first ``length`` tokens of this one
    into = F.when((F.col(pos) % block < length) & (at > 0), F.array(at - 1, at)).otherwise(F.array(at))
    sent = unnest(df, [*keys, pos, value], into, "_b")
    held = sent.groupBy(*keys, "_b").agg(F.array_sort(F.collect_list(F.struct(pos, value))).alias("_c"))
    held = held.withColumn("_v", F.transform("_c", lambda c: c[value])).withColumn("_lo", F.col("_b") * block).drop("_c")
    first = (F.ceil(F.col("_lo") / F.lit(stride)) * stride).cast("long")
    last = F.least(F.col("_lo") + block - 1, F.col("_lo") + F.size("_v") - length - 1).cast("long")
    starts = F.when(first <= last, F.sequence(first, last, F.lit(stride).cast("long")))
    cut = unnest(held, [*keys, "_lo", "_v"], starts, "_s")
    window = F.slice(F.col("_v"), (F.col("_s") - F.col("_lo") + 1).cast("int"), F.lit(length + 1)).alias("w")
    return cut.select(*keys, F.floor(F.col("_s") / F.lit(stride)).cast("long").alias("chunk_id"), window).select(*keys, "chunk_id", *_pair(length))


def lm_dataset(
    df: DataFrame,
    vocab: DataFrame | None = None,
    key: str = "doc_id",
    col: str = "text",
    batch_size: int = 4,
    length: int = 256,
    stride: int = 128,
    shuffle: bool = True,
    drop_last: bool = True,
    seed: int = 0,
    epoch: int = 0,
    bang: bool = False,
    on_unknown: str = "unk",
    encoder: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Text to batches of windows: ``(key, chunk_id, input_ids, target_ids, idx, batch_id)``.

    Ids come from ``vocab`` or from any ``encoder`` that adds an ``ids`` array.

    Without a shuffle the number of a window is its document's offset plus its
    place, so only one number per document is ranked; with one, windows are
    ranked by a seeded hash of their key and shuffled once, as L+1 integers each.
    """
    if encoder is None:
        if vocab is None:
            raise ValueError("give a vocabulary or an encoder")
        tokens = tokenize(df.select(key, col), col, bang=bang).select(key, "tokens")
        docs, n_ids = encode(tokens, vocab, on_unknown=on_unknown), tokens.select(key, F.size("tokens").alias("_n"))
    else:
        docs = materialize(encoder(df.select(key, col)).select(key, "ids"))
        n_ids = docs.select(key, F.size("ids").alias("_n"))
    counts = materialize(n_ids.select(key, window_count(F.col("_n"), length, stride).alias("_n"))).filter("_n > 0")
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    if shuffle:
        windows = _windows(docs.select(key, "ids"), length, stride, [key], "ids")

        def hashed(rows: DataFrame) -> DataFrame:
            return rows.withColumn("_h", order_hash(key, "chunk_id", seed=seed, epoch=epoch))

        keys = unnest(counts, [key], F.sequence(F.lit(0), F.col("_n") - 1), "chunk_id")
        windows = hashed(windows.withColumn("w", F.col("w").cast("array<int>")))
        order = ["_h", key, "chunk_id"]
        placed = dense_index(windows, order, name="idx", rows=total, hashed=True, keys_from=hashed(keys)).drop("_h")
    else:
        offsets = running_total(counts, [key], F.col("_n"), name="_o").select(key, "_o")
        # the offset meets the document, one row, and its windows carry it along
        numbered = lookup_join(docs.select(key, "ids"), offsets, [key], "inner")
        placed = _windows(numbered, length, stride, [key, "_o"], "ids").withColumn("idx", F.col("_o") + F.col("chunk_id")).drop("_o")
    if drop_last:
        placed = placed.filter(F.col("idx") < total // batch_size * batch_size)
    batch_id = F.floor(F.col("idx") / batch_size).cast("long").alias("batch_id")
    return placed.select(key, "chunk_id", *_pair(length, "array<long>"), "idx", batch_id)


# --- vocabulary checks on long tables -------------------------------------


def token_statistics(df: DataFrame, tokens: str = "tokens", col: str = "text") -> DataFrame:
    """Characters, tokens and documents of a corpus in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.length(col)).alias("n_chars"),
        F.sum(F.size(tokens)).alias("n_tokens"),
    )
