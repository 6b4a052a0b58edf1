"""Registered queries: corpus, tokens, vocabulary, ids, windows, byte pairs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from framelearn.operators import bpe, text
from framelearn.plans.registry import query, table
from framelearn.plans.scale import lookup_join, spread, unnest
from framelearn.session import shared_dir
from framelearn.sources import files, readers

# --- shared SQL -----------------------------------------------------------

_P = """'([,.:;?_"()'']|--|\\s)'"""
_P_BANG = """'([,.:;?_!"()'']|--|\\s)'"""


def sql_tokens(expr: str, bang: bool = False) -> str:
    pattern = _P_BANG if bang else _P
    return (
        f"list_filter(string_split(regexp_replace({expr}, {pattern}, chr(31)||'\\1'||chr(31), 'g'), chr(31)), "
        f"lambda x: not regexp_full_match(x, '\\s*'))"
    )


#: doc_id, pos (from 0), token
SQL_LONG = f"""toks AS (SELECT doc_id, {sql_tokens('text')} AS t FROM documents),
long AS (SELECT doc_id, unnest(range(len(t)))::BIGINT AS pos, unnest(t) AS token FROM toks)"""
SQL_VOCAB = "vocab AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS id FROM (SELECT DISTINCT token FROM long))"
#: a vocabulary without the tokens of one language, so that unknown tokens occur
SQL_PART_VOCAB = f"""{SQL_LONG},
base AS (SELECT DISTINCT token FROM long JOIN documents USING (doc_id) WHERE lang <> 'de'),
numbered AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS id FROM base),
vocab AS (SELECT token, id FROM numbered UNION ALL
  SELECT '<|endoftext|>', count(*) FROM numbered UNION ALL SELECT '<|unk|>', count(*) + 1 FROM numbered),
ids AS (SELECT doc_id, pos, coalesce(v.id, (SELECT id FROM vocab WHERE token = '<|unk|>'))::BIGINT AS id
  FROM long LEFT JOIN vocab v USING (token))"""
SQL_SIZES = "sizes AS (SELECT doc_id, count(*) AS n FROM ids GROUP BY doc_id)"


def sql_windows(length: int, stride: int, source: str = "ids", key: str = "doc_id") -> str:
    return f"""starts AS (SELECT {key}, unnest(generate_series(0, n - {length} - 1, {stride}))::BIGINT AS s FROM sizes WHERE n > {length}),
wins AS (SELECT s.{key}, s.s // {stride} AS chunk_id,
  string_agg(i.id::VARCHAR, ',' ORDER BY i.pos) FILTER (WHERE i.pos < s.s + {length}) AS input_ids,
  string_agg(i.id::VARCHAR, ',' ORDER BY i.pos) FILTER (WHERE i.pos > s.s) AS target_ids
  FROM starts s JOIN {source} i ON s.{key} = i.{key} AND i.pos >= s.s AND i.pos <= s.s + {length} GROUP BY 1, 2)"""


# --- shared frames --------------------------------------------------------


def docs(spark, d):
    return spread(table(spark, d, "documents").select("doc_id", "text"), "doc_id")


def tokens(spark, d, bang=False):
    return text.tokenize(docs(spark, d), bang=bang).select("doc_id", "tokens")


def tokens_long(spark, d):
    return text.explode_tokens(tokens(spark, d), ["doc_id"])


def full_vocab(spark, d):
    return text.build_vocab(tokens(spark, d))


def part_vocab(spark, d):
    known = spread(table(spark, d, "documents").filter("lang <> 'de'").select("doc_id", "text"), "doc_id")
    return text.build_vocab(text.tokenize(known), specials=[text.END_OF_TEXT, text.UNKNOWN])


def encoded(spark, d):
    return text.encode(tokens(spark, d), part_vocab(spark, d), on_unknown="unk").select("doc_id", "ids")


def joined(col):
    return F.array_join(col.cast("array<string>"), ",")


# --- sources over text ----------------------------------------------------


@query("src_1_corpus_preview", "SELECT doc_id, length(text)::INT AS n_chars, left(text, 99) AS head FROM documents")
def src_1(spark, d):
    """Documents written as one text file each, and read back whole; a file without a byte is not read, so the list of documents says which are empty."""
    where = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    files.write_files(docs(spark, d).withColumn("name", F.concat("doc_id", F.lit(".txt"))), where, content="text")
    head = readers.corpus_preview(readers.read_corpus(spark, where))
    read = head.select(F.regexp_extract("path", r"([0-9]+)\.txt$", 1).cast("long").alias("doc_id"), "n_chars", "head")
    listed = docs(spark, d).select("doc_id", F.col("text").isNotNull().alias("_given"))
    found = listed.join(read, "doc_id", "left")
    return found.select("doc_id", *[F.when(F.col("_given"), F.coalesce(c, F.lit(empty))).alias(c) for c, empty in (("n_chars", 0), ("head", ""))])


# --- tokens ---------------------------------------------------------------


def _tokens_sql(bang):
    return f"""WITH t AS (SELECT doc_id, {sql_tokens('text', bang)} AS t FROM documents)
SELECT doc_id, len(t)::INT AS n_tokens, md5(array_to_string(t, chr(31))) AS digest FROM t"""


def _tokens_digest(spark, d, bang):
    return tokens(spark, d, bang).select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", "\x1f")).alias("digest")
    )


@query("tok_1_tokenize", _tokens_sql(False))
def tok_1(spark, d):
    return _tokens_digest(spark, d, False)


@query("tok_1_tokenize_bang", _tokens_sql(True))
def tok_1_bang(spark, d):
    return _tokens_digest(spark, d, True)


@query("tok_2_drop_blank", f"WITH {SQL_LONG} SELECT token, count(*) AS n, min(pos) AS first_pos FROM long GROUP BY token")
def tok_2(spark, d):
    return tokens_long(spark, d).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").cast("long").alias("first_pos")
    )


@query(
    "tok_3_token_counts",
    f"""WITH toks AS (SELECT text, {sql_tokens('text')} AS t FROM documents)
SELECT count(*) AS n_docs, sum(length(text))::BIGINT AS n_chars, sum(len(t))::BIGINT AS n_tokens FROM toks""",
)
def tok_3(spark, d):
    return text.token_statistics(text.tokenize(docs(spark, d)))


@query("tok_4_vocab", f"WITH {SQL_LONG}, {SQL_VOCAB} SELECT token, id FROM vocab")
def tok_4(spark, d):
    return full_vocab(spark, d)


@query(
    "tok_5_vocab_specials",
    f"""WITH {SQL_LONG}, {SQL_VOCAB} SELECT token, id FROM vocab UNION ALL SELECT '<|endoftext|>', count(*) FROM vocab
UNION ALL SELECT '<|unk|>', count(*) + 1 FROM vocab""",
)
def tok_5(spark, d):
    return text.build_vocab(tokens(spark, d), specials=[text.END_OF_TEXT, text.UNKNOWN])


@query("tok_6_vocab_preview", f"WITH {SQL_LONG}, {SQL_VOCAB} SELECT token, id FROM vocab ORDER BY id LIMIT 11")
def tok_6(spark, d):
    return text.vocab_preview(full_vocab(spark, d))


#: a blank text has no ids, a NULL one no list of ids
_ID_DIGEST = """SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN count(i.id)::INT END AS n,
  CASE WHEN d.text IS NOT NULL THEN md5(coalesce(string_agg(i.id::VARCHAR, ',' ORDER BY pos), '')) END AS digest
FROM documents d LEFT JOIN {} i ON d.doc_id = i.doc_id GROUP BY d.doc_id, d.text"""


def _id_digest(df):
    return df.select("doc_id", F.size("ids").alias("n"), F.md5(joined(F.col("ids"))).alias("digest"))


@query(
    "tok_7_encode_strict",
    f"WITH {SQL_LONG}, {SQL_VOCAB}, ids AS (SELECT doc_id, pos, id FROM long JOIN vocab USING (token)) "
    + _ID_DIGEST.format("ids"),
)
def tok_7(spark, d):
    return _id_digest(text.encode(tokens(spark, d), full_vocab(spark, d)))


@query("tok_8_encode_unk", f"WITH {SQL_PART_VOCAB} " + _ID_DIGEST.format("ids"))
def tok_8(spark, d):
    return _id_digest(encoded(spark, d))


@query("tok_8_encode_unk_joined", f"WITH {SQL_PART_VOCAB} " + _ID_DIGEST.format("ids"))
def tok_8_joined(spark, d):
    """The path for a vocabulary beyond a broadcast."""
    vocab = part_vocab(spark, d)
    return _id_digest(text.encode(tokens(spark, d), vocab, on_unknown="unk", max_rows=0))


@query(
    "tok_9_out_of_vocabulary",
    f"WITH {SQL_PART_VOCAB} SELECT token, count(*) AS n FROM long WHERE token NOT IN (SELECT token FROM vocab) GROUP BY token",
)
def tok_9(spark, d):
    return text.out_of_vocabulary(tokens_long(spark, d), part_vocab(spark, d))


@query(
    "tok_10_decode",
    f"""WITH {SQL_PART_VOCAB},
words AS (SELECT doc_id, pos, v.token FROM ids JOIN vocab v USING (id)),
plain AS (SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS s FROM words GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(regexp_replace(s, '\\s+([,.?!"()''])', '\\1', 'g'), '') END AS decoded
FROM documents d LEFT JOIN plain p ON d.doc_id = p.doc_id""",
)
def tok_10(spark, d):
    vocab = part_vocab(spark, d)
    ids = text.encode(tokens(spark, d), vocab, on_unknown="unk")
    return text.decode(ids.select("doc_id", "ids"), vocab).select("doc_id", "decoded")


@query(
    "tok_11_concat_documents",
    """WITH o AS (SELECT lang, text, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i FROM documents)
SELECT lang, i // 128 AS piece, count(*) AS n_docs, md5(string_agg(CASE WHEN i > 0 THEN ' <|endoftext|> ' ELSE '' END || coalesce(text, ''), '' ORDER BY i)) AS digest
FROM o GROUP BY 1, 2""",
)
def tok_11(spark, d):
    src = table(spark, d, "documents").select("lang", "doc_id", "text")
    out = text.concat_documents(src, ["lang"], ["doc_id"], max_docs=128, rows_per_bucket=200_000)
    return out.select("lang", "piece", "n_docs", F.md5("joined").alias("digest"))


@query(
    "tok_11_concat_documents_by_bytes",
    """WITH o AS (SELECT lang, text, row_number() OVER w - 1 AS i, coalesce(sum(octet_length(encode(coalesce(text, ''))) + 15) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
  FROM documents WINDOW w AS (PARTITION BY lang ORDER BY doc_id))
SELECT lang, (i // 128 + b // 100000)::BIGINT AS piece, count(*) AS n_docs, md5(string_agg(CASE WHEN i > 0 THEN ' <|endoftext|> ' ELSE '' END || coalesce(text, ''), '' ORDER BY i)) AS digest
FROM o GROUP BY 1, 2""",
)
def tok_11_bytes(spark, d):
    """Pieces of at most 128 documents that end with the document that fills 100,000 bytes."""
    src = table(spark, d, "documents").select("lang", "doc_id", "text")
    out = text.concat_documents(src, ["lang"], ["doc_id"], max_docs=128, max_bytes=100_000, rows_per_bucket=200_000)
    return out.select("lang", "piece", "n_docs", F.md5("joined").alias("digest"))


_SQL_STREAM = f"""toks AS (SELECT lang, doc_id, {sql_tokens('text')} AS t FROM documents),
numbered AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS i FROM toks),
parts AS (SELECT lang, i, CASE WHEN i = 1 THEN t ELSE list_concat(['<|endoftext|>'], t) END AS t FROM numbered),
flat AS (SELECT lang, i, unnest(range(len(t))) AS j, unnest(t) AS token FROM parts),
stream AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY i, j) - 1 AS pos, token FROM flat)"""


@query(
    "tok_11_token_stream",
    f"WITH {_SQL_STREAM} SELECT lang, token, count(*) AS n, sum(pos)::BIGINT AS pos_sum, max(pos) AS last_pos FROM stream GROUP BY 1, 2",
)
def tok_11_stream(spark, d):
    src = text.tokenize(table(spark, d, "documents")).select("lang", "doc_id", "tokens")
    return text.token_stream(src, ["lang"], ["doc_id"]).groupBy("lang", "token").agg(
        F.count(F.lit(1)).alias("n"), F.sum("pos").alias("pos_sum"), F.max("pos").alias("last_pos")
    )


# --- windows --------------------------------------------------------------


@query(
    "tok_15_shift_pair",
    f"""WITH {SQL_PART_VOCAB}, {SQL_SIZES}
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(string_agg(id::VARCHAR, ',' ORDER BY pos) FILTER (WHERE pos >= 50 AND pos < 60), '') END AS x,
  CASE WHEN d.text IS NOT NULL THEN coalesce(string_agg(id::VARCHAR, ',' ORDER BY pos) FILTER (WHERE pos >= 51 AND pos < 61), '') END AS y
FROM documents d LEFT JOIN ids i ON d.doc_id = i.doc_id GROUP BY d.doc_id, d.text""",
)
def tok_15(spark, d):
    pair = text.shift_pair(encoded(spark, d), 50, 10)
    return pair.select("doc_id", joined(F.col("x")).alias("x"), joined(F.col("y")).alias("y"))


@query(
    "tok_16_next_token_pairs",
    f"""WITH {SQL_PART_VOCAB}, {SQL_SIZES},
steps AS (SELECT doc_id, unnest(generate_series(1, least(11, n - 51))) AS n FROM sizes WHERE n > 51)
SELECT s.doc_id, s.n::INT AS n, string_agg(i.id::VARCHAR, ',' ORDER BY i.pos) FILTER (WHERE i.pos < 50 + s.n) AS context,
  max(i.id) FILTER (WHERE i.pos = 50 + s.n) AS desired
FROM steps s JOIN ids i ON s.doc_id = i.doc_id AND i.pos >= 50 AND i.pos <= 50 + s.n GROUP BY 1, 2""",
)
def tok_16(spark, d):
    pairs = text.next_token_pairs(encoded(spark, d), 50, 10, ["doc_id"])
    return pairs.select("doc_id", "n", joined(F.col("context")).alias("context"), "desired")


_WIN_OUT = "SELECT doc_id, chunk_id, md5(input_ids) AS input_ids, md5(target_ids) AS target_ids FROM wins"


def _win_digest(df, *keys):
    return df.select(
        *keys,
        "chunk_id",
        F.md5(joined(F.col("input_ids"))).alias("input_ids"),
        F.md5(joined(F.col("target_ids"))).alias("target_ids"),
    )


@query("tok_17_lm_windows", f"WITH {SQL_PART_VOCAB}, {SQL_SIZES}, {sql_windows(64, 64)} {_WIN_OUT}")
def tok_17(spark, d):
    return _win_digest(text.lm_windows(encoded(spark, d), 64, 64), "doc_id")


@query("tok_17_lm_windows_overlapping", f"WITH {SQL_PART_VOCAB}, {SQL_SIZES}, {sql_windows(64, 16)} {_WIN_OUT}")
def tok_17_overlap(spark, d):
    return _win_digest(text.lm_windows(encoded(spark, d), 64, 16), "doc_id")


@query("tok_17_lm_windows_skipping", f"WITH {SQL_PART_VOCAB}, {SQL_SIZES}, {sql_windows(16, 40)} {_WIN_OUT}")
def tok_17_skip(spark, d):
    return _win_digest(text.lm_windows(encoded(spark, d), 16, 40), "doc_id")


@query(
    "tok_17_lm_windows_stream",
    f"""WITH {_SQL_STREAM}, words AS (SELECT DISTINCT token FROM stream),
vocab AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS id FROM words WHERE token <> '<|endoftext|>'
  UNION ALL SELECT '<|endoftext|>', count(*) - 1 FROM words),
ids AS (SELECT lang, pos, id FROM stream JOIN vocab USING (token)),
sizes AS (SELECT lang, count(*) AS n FROM ids GROUP BY lang),
{sql_windows(128, 128, key='lang')}
SELECT lang, chunk_id, md5(input_ids) AS input_ids, md5(target_ids) AS target_ids FROM wins""",
)
def tok_17_stream(spark, d):
    """Windows over each language's joined documents, cut from the long form."""
    src = text.tokenize(table(spark, d, "documents")).select("lang", "doc_id", "tokens")
    vocab = text.build_vocab(src, specials=[text.END_OF_TEXT])
    stream = text.token_stream(src, ["lang"], ["doc_id"])
    ids = text.encode_long(stream, vocab).select("lang", "pos", "id")
    return _win_digest(text.lm_windows_long(ids, 128, 128, ["lang"]), "lang")


def _dataset_sql(order, batch, length, stride):
    return f"""WITH {SQL_PART_VOCAB}, {SQL_SIZES}, {sql_windows(length, stride)},
placed AS (SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS idx, count(*) OVER () AS total FROM wins)
SELECT doc_id, chunk_id, md5(input_ids) AS input_ids, md5(target_ids) AS target_ids, idx, idx // {batch} AS batch_id
FROM placed WHERE idx < total // {batch} * {batch}"""


def _dataset(spark, d, **kw):
    out = text.lm_dataset(docs(spark, d), part_vocab(spark, d), **kw)
    return _win_digest(out.withColumn("chunk_id", F.col("chunk_id")), "doc_id", "idx", "batch_id")


@query("tok_18_lm_dataset", _dataset_sql("doc_id, chunk_id", 8, 64, 64))
def tok_18(spark, d):
    return _dataset(spark, d, batch_size=8, length=64, stride=64, shuffle=False)


@query(
    "tok_18_lm_dataset_shuffled",
    _dataset_sql("('0x'||substr(md5(doc_id||':'||chunk_id||':7:1'),1,15))::BIGINT, doc_id, chunk_id", 4, 256, 128),
)
def tok_18_shuffled(spark, d):
    return _dataset(spark, d, seed=7, epoch=1)


# --- look-ups -------------------------------------------------------------


@query(
    "j_1_token_to_id",
    f"WITH {SQL_LONG}, {SQL_VOCAB} SELECT doc_id, sum(id * (pos + 1))::BIGINT AS checksum, count(id) AS n FROM long LEFT JOIN vocab USING (token) GROUP BY doc_id",
)
def j_1(spark, d):
    found = lookup_join(tokens_long(spark, d), full_vocab(spark, d), ["token"], "left", kept=False)
    return found.groupBy("doc_id").agg(
        F.sum(F.col("id") * (F.col("pos") + 1)).alias("checksum"), F.count("id").alias("n")
    )


@query("j_2_id_to_token", f"WITH {SQL_PART_VOCAB} SELECT v.token, count(*) AS n FROM ids JOIN vocab v USING (id) GROUP BY 1")
def j_2(spark, d):
    vocab = part_vocab(spark, d)
    ids = text.encode(tokens(spark, d), vocab, on_unknown="unk").select("doc_id", F.posexplode("ids").alias("pos", "id"))
    return text.decode_long(ids, vocab).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


# --- order over tokens ----------------------------------------------------


@query(
    "ord_8_next_token",
    f"""WITH {SQL_LONG}, nxt AS (SELECT token, lead(token) OVER (PARTITION BY doc_id ORDER BY pos) AS next_token FROM long)
SELECT token, next_token, count(*) AS n FROM nxt WHERE next_token IS NOT NULL GROUP BY 1, 2""",
)
def ord_8(spark, d):
    pairs = text.lm_windows(tokens(spark, d), 1, 1, ids="tokens")
    return pairs.groupBy(
        F.col("input_ids")[0].alias("token"), F.col("target_ids")[0].alias("next_token")
    ).agg(F.count(F.lit(1)).alias("n"))


# --- byte pairs -----------------------------------------------------------

_SYM = "regexp_replace(token, '(?s)(.)', chr(2)||'\\1'||chr(3), 'g') || chr(2) || '</w>' || chr(3)"
_SPLIT = "string_split(substr({0}, 2, length({0}) - 2), chr(3)||chr(2))"


def _pairs_cte(name, source):
    return f"""{name}a AS MATERIALIZED (SELECT n, {_SPLIT.format('s')} AS a FROM {source}),
{name} AS MATERIALIZED (SELECT l, r, sum(n)::BIGINT AS n FROM (SELECT n, unnest(a[1:len(a)-1]) AS l, unnest(a[2:len(a)]) AS r FROM {name}a WHERE len(a) > 1) GROUP BY 1, 2)"""


_WORDS = f"{SQL_LONG}, w0 AS MATERIALIZED (SELECT token, count(*) AS n, {_SYM} AS s FROM long GROUP BY token)"
N_MERGES = 12


def _merge_ctes(n):
    parts = []
    for i in range(n):
        parts.append(_pairs_cte(f"p{i}", f"w{i}"))
        parts.append(f"b{i} AS MATERIALIZED (SELECT l, r FROM p{i} ORDER BY n DESC, l, r LIMIT 1)")
        parts.append(
            f"w{i + 1} AS MATERIALIZED (SELECT token, n, replace(s, chr(2)||l||chr(3)||chr(2)||r||chr(3), chr(2)||l||r||chr(3)) AS s FROM w{i}, b{i})"
        )
    return ",\n".join(parts)


def word_counts(spark, d):
    return text.token_counts(tokens(spark, d)).select(F.col("token").alias("word"), "freq")


@query("tok_12_pair_counts", f'WITH {_WORDS}, {_pairs_cte("p", "w0")} SELECT l AS "left", r AS "right", n FROM p')
def tok_12_pairs(spark, d):
    return bpe.pair_counts(bpe.word_symbols(word_counts(spark, d)))


@query(
    "tok_12_bpe_train",
    f"WITH {_WORDS}, {_merge_ctes(N_MERGES)} "
    + " UNION ALL ".join(f'SELECT {i} AS rank, l AS "left", r AS "right" FROM b{i}' for i in range(N_MERGES)),
)
def tok_12(spark, d):
    return bpe.merges_frame(spark, bpe.bpe_train(word_counts(spark, d), N_MERGES))


@query(
    "tok_12_bpe_train_indexed",
    f"WITH {_WORDS}, {_merge_ctes(N_MERGES)} "
    + " UNION ALL ".join(f'SELECT {i} AS rank, l AS "left", r AS "right" FROM b{i}' for i in range(N_MERGES)),
)
def tok_12_indexed(spark, d):
    """The way of later merges from the third merge on: only words that hold a pair are read."""
    return bpe.merges_frame(spark, bpe.bpe_train(word_counts(spark, d), N_MERGES, index_from=2))


@query(
    "tok_13_bpe_encode",
    f"""WITH {_WORDS}, {_merge_ctes(N_MERGES)},
parts AS (SELECT token, {_SPLIT.format('s')} AS a FROM w{N_MERGES}),
flat AS (SELECT doc_id, unnest(a) AS symbol FROM long JOIN parts USING (token))
SELECT doc_id, symbol, count(*) AS n FROM flat GROUP BY 1, 2""",
)
def tok_13(spark, d):
    merges = bpe.merges_frame(spark, bpe.bpe_train(word_counts(spark, d), N_MERGES))
    parts = bpe.bpe_encode_long(tokens_long(spark, d), merges)
    return parts.groupBy("doc_id", "symbol").agg(F.count(F.lit(1)).alias("n"))


@query(
    "tok_14_bpe_round_trip",
    f"WITH {SQL_LONG} SELECT doc_id, md5(string_agg(token, ' ' ORDER BY pos)) AS digest FROM long GROUP BY doc_id",
)
def tok_14(spark, d):
    """Text encoded to symbol ids and decoded again gives its tokens back."""
    merges = bpe.merges_frame(spark, bpe.bpe_train(word_counts(spark, d), N_MERGES))
    words = word_counts(spark, d).select("word")
    vocab = bpe.symbol_vocab(merges, unnest(bpe.split_words(words, merges), [], "parts", "symbol"))
    ids = bpe.bpe_encode(tokens(spark, d), merges, vocab)
    back = bpe.bpe_decode(ids.select("doc_id", "ids"), vocab, ids="ids")
    return back.select("doc_id", F.md5("text").alias("digest"))


# --- byte-level pairs -----------------------------------------------------

#: a word with the blank before it, or one white space character: no look-ahead, so that every engine can cut it
_BYTE_PIECES = r" ?[^\s]+|\s"
_BYTE_LONG = f"""pc AS (SELECT doc_id, regexp_extract_all(text, '{_BYTE_PIECES}') AS t FROM documents),
long AS (SELECT doc_id, unnest(range(len(t))) AS pos, unnest(t) AS token FROM pc),
w0 AS MATERIALIZED (SELECT token, count(*) AS n, regexp_replace(hex(encode(token)), '(..)', chr(2)||'\\1'||chr(3), 'g') AS s FROM long GROUP BY token)"""
_BYTE_MERGED = " UNION ALL ".join(f"SELECT l || r AS sym, {256 + i} AS id FROM b{i}" for i in range(N_MERGES))
_BYTE_IDS = f"""{_BYTE_LONG}, {_merge_ctes(N_MERGES)},
parts AS (SELECT token, {_SPLIT.format('s')} AS a FROM w{N_MERGES}),
merged AS (SELECT sym, min(id) AS id FROM ({_BYTE_MERGED}) GROUP BY 1),
flat AS (SELECT doc_id, pos AS p, unnest(range(len(a))) AS j, unnest(a) AS sym FROM long JOIN parts USING (token)),
ids AS MATERIALIZED (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY p, j) - 1 AS pos, coalesce(m.id, ('0x' || f.sym)::BIGINT) AS id
  FROM flat f LEFT JOIN merged m ON f.sym = m.sym)"""


def byte_merges(spark, d):
    return bpe.bpe_train(bpe.piece_counts(docs(spark, d), pattern=_BYTE_PIECES), N_MERGES, symbols=bpe.byte_symbols)


def _byte_encoded(spark, d):
    ranks = bpe.byte_ranks(spark, byte_merges(spark, d))
    return bpe.encode_ranks(docs(spark, d), ranks, pattern=_BYTE_PIECES).select("doc_id", "ids"), ranks


@query(
    "tok_12_bpe_train_bytes",
    f"WITH {_BYTE_LONG}, {_merge_ctes(N_MERGES)} " + " UNION ALL ".join(f'SELECT {i} AS rank, l AS "left", r AS "right" FROM b{i}' for i in range(N_MERGES)),
)
def tok_12_bytes(spark, d):
    return bpe.merges_frame(spark, byte_merges(spark, d))


@query("tok_13_bpe_bytes", f"WITH {_BYTE_IDS} SELECT doc_id, id, count(*) AS n FROM ids GROUP BY 1, 2")
def tok_13_bytes(spark, d):
    ids, _ = _byte_encoded(spark, d)
    return unnest(ids, ["doc_id"], "ids", "id").groupBy("doc_id", "id").agg(F.count(F.lit(1)).alias("n"))


@query("tok_14_bytes_round_trip", "SELECT doc_id, md5(text) AS digest FROM documents")
def tok_14_bytes(spark, d):
    """Text encoded by learned byte merges and decoded again is the text itself."""
    ids, ranks = _byte_encoded(spark, d)
    return bpe.decode_ranks(ids, ranks).select("doc_id", F.md5("text").alias("digest"))


_BYTE_DATASET = f"""WITH {_BYTE_IDS}, {SQL_SIZES}, {sql_windows(64, 64)},
placed AS (SELECT *, row_number() OVER (ORDER BY doc_id, chunk_id) - 1 AS idx, count(*) OVER () AS total FROM wins)
SELECT doc_id, chunk_id, md5(input_ids) AS input_ids, md5(target_ids) AS target_ids, idx, idx // 8 AS batch_id
FROM placed WHERE idx < total // 8 * 8"""


@query("tok_18_lm_dataset_bytes", _BYTE_DATASET)
def tok_18_bytes(spark, d):
    ranks = bpe.byte_ranks(spark, byte_merges(spark, d))

    def encoder(df):
        return bpe.encode_ranks(df, ranks, pattern=_BYTE_PIECES)

    out = text.lm_dataset(docs(spark, d), encoder=encoder, batch_size=8, length=64, stride=64, shuffle=False)
    return _win_digest(out, "doc_id", "idx", "batch_id")
