"""Registered queries of the numbered operators, each with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelearn.llm import (
    chat,
    collocations,
    decontam,
    fingerprints,
    html_extract,
    jaccard_join,
    license_scan,
    line_dedup,
    packing,
    permutation_index,
    suffix_dedup,
    toxicity,
    vector_codes,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = f"regexp_replace(translate(line, '{_UPPER}', '{_LOWER}'), '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g')"


@query(
    "op6_line_dedup",
    f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
long AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM docs),
keyed AS (SELECT *, {_KEY} AS k FROM long),
often AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10),
marked AS (SELECT a.*, b.k IS NOT NULL AS gone FROM keyed a LEFT JOIN often b ON a.k = b.k)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r""",
)
def op6_line_dedup(spark, d):
    return line_dedup.line_dedup(table(spark, d, "documents"))


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_START, _END = chat.START, chat.END
_NAME_SQL = "regexp_replace(speaker, '[\\s<>|=]', '_', 'g')"


@query(
    "op2_chat_perspectives",
    f"""WITH raw AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
turns AS (SELECT *, speaker = 'system' AS narrates, regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS body,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, sha256(text)) - 1 AS position FROM raw),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE NOT narrates),
seen AS (SELECT t.*, perspective, speaker = perspective AS own,
  CASE WHEN speaker = perspective THEN 'assistant' WHEN narrates THEN 'system' ELSE 'user' END AS role
  FROM turns t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
headed AS (SELECT *, '{_START}' || role || CASE WHEN role = 'user' THEN ' name=' || {_NAME_SQL} ELSE '' END || chr(10) AS head FROM seen),
done AS (SELECT *, head || body || '{_END}' || chr(10) AS segment FROM headed),
placed AS (SELECT *, coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY position
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS st FROM done)
SELECT conv_id, perspective, position::BIGINT AS position, role, CASE WHEN role = 'user' THEN speaker END AS name, segment,
  st AS start, (st + length(segment))::BIGINT AS "end", CASE WHEN own THEN st + length(head) END::BIGINT AS mask_start,
  CASE WHEN own THEN st + length(segment) - 1 END::BIGINT AS mask_end FROM placed""",
)
def op2_chat_perspectives(spark, d):
    return chat.perspectives(table(spark, d, "conversations"))


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark, d):
    return packing.pack(table(spark, d, "documents"), tokenizer_file())


@query("op7_document_fingerprints")
def op7_document_fingerprints(spark, d):
    return fingerprints.document_fingerprints(table(spark, d, "documents"))


@query("op8_license_scan")
def op8_license_scan(spark, d):
    return license_scan.license_scan(table(spark, d, "documents"))


def _tokens_sql(text: str) -> str:
    """``decontam.marked_tokens`` in SQL without look-around: capitals are marked first, digit gaps closed twice."""
    x = f"regexp_replace(coalesce({text}, ''), '[\\x00-\\x08]', ' ', 'g')"
    for _ in range(2):
        x = f"regexp_replace({x}, '([0-9])[.,]([0-9])', '\\1\\2', 'g')"
    x = f"regexp_replace({x}, '(\\p{{Lu}})(\\p{{Ll}})', chr(4) || '\\1\\2', 'g')"
    x = f"replace(regexp_replace({x}, '([\\p{{Ll}}0-9,;][ \\t\\r\\n]{{1,2}})\\x04', '\\1' || chr(2) || chr(2), 'g'), chr(4), '')"
    # names are marked twice, so that joining one to the next leaves the next a mark
    x = f"regexp_replace({x}, '(\\x02\\p{{L}}+)[ \\t\\r\\n]{{1,2}}\\x02', '\\1' || chr(4), 'g')"
    x = f"replace(replace({x}, chr(4) || chr(2), chr(4)), chr(2) || chr(2), chr(2))"
    x = f"regexp_replace({x}, '([0-9]+)', ' ' || chr(1) || '\\1 ', 'g')"
    units = "|".join(sorted(decontam.UNITS, key=len, reverse=True))
    x = f"regexp_replace({x}, '(\\x01[0-9]+  ?)({units})([^\\p{{L}}0-9]|$)', '\\1' || chr(3) || '\\2\\3', 'g')"
    return f"list_filter(regexp_split_to_array(lower({x}), '[^\\p{{L}}0-9\\x01-\\x04]+'), lambda w: w NOT IN ('', chr(1), chr(2), chr(3)))"


_KINDS = "(chr(1), chr(2), chr(3))"
_TEMPLATE = f"list_transform(t, lambda w: CASE WHEN left(w, 1) IN {_KINDS} THEN left(w, 1) ELSE w END)"
_RUN = "array_to_string(m[p + 1 : p + 8], ' ')"


@query(
    "op10_benchmark_decontamination",
    f"""WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_tokens_sql('text')} AS t FROM documents),
items AS MATERIALIZED (SELECT row_number() OVER () AS q, item_id, {_tokens_sql('text')} AS t FROM (SELECT DISTINCT item_id, text FROM benchmark)),
dw AS (SELECT r, p, {_RUN} AS w FROM (SELECT r, {_TEMPLATE} AS m, unnest(range(len(t) - 7)) AS p FROM docs)),
iw AS MATERIALIZED (SELECT q, p, {_RUN} AS w FROM (SELECT q, {_TEMPLATE} AS m, unnest(range(len(t) - 7)) AS p FROM items)),
sizes AS (SELECT q, count(*) AS n FROM iw GROUP BY q),
aligned AS (SELECT r, q, dw.p - iw.p AS shift, count(DISTINCT iw.p) AS met, min(iw.p) AS lo, max(iw.p) + 8 AS hi FROM dw JOIN iw ON dw.w = iw.w GROUP BY 1, 2, 3),
enough AS MATERIALIZED (SELECT a.*, met / n AS share FROM aligned a JOIN sizes USING (q) WHERE met / n >= 0.3),
cells AS (SELECT e.r, e.q, e.shift, i.t AS it, d.t AS dt, unnest(range(lo, hi)) AS p FROM enough e JOIN items i USING (q) JOIN docs d USING (r)),
slots AS (SELECT r, q, shift, it[p + 1] AS x, dt[p + shift + 1] AS y FROM cells WHERE left(it[p + 1], 1) IN {_KINDS}),
fits AS (SELECT r, q, shift, count(*) AS n, count(*) FILTER (WHERE x <> y) AS changed,
  count(DISTINCT x || ' ' || y) - least(count(DISTINCT x), count(DISTINCT y)) <= greatest(1, floor(count(*) * 0.2::DOUBLE)) AS agree FROM slots GROUP BY 1, 2, 3),
best AS (SELECT r, q, max({{'share': share, 'less': -coalesce(changed, 0), 'n': coalesce(n, 0)}}) AS b
  FROM enough LEFT JOIN fits USING (r, q, shift) WHERE coalesce(agree, true) GROUP BY 1, 2)
SELECT doc_id, item_id, b.share AS share, b.n::BIGINT AS n_slots, (-b.less)::BIGINT AS n_changed, b.less = 0 AS verbatim
FROM best JOIN docs USING (r) JOIN items USING (q)""",
)
def op10_benchmark_decontamination(spark, d):
    return decontam.benchmark_leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("op9_toxicity")
def op9_toxicity(spark, d):
    return toxicity.toxicity(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op3_html_extraction")
def op3_html_extraction(spark, d):
    return html_extract.extract(table(spark, d, "pages"))


_WIDTH = 400


@query(
    "op5_suffix_dedup",
    f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT r, unnest(range(len(h) // 2 - {_WIDTH - 1})) AS s, h FROM docs WHERE len(h) >= {2 * _WIDTH}),
windows AS MATERIALIZED (SELECT r, s, md5(substr(h, 2 * s + 1, {2 * _WIDTH})) AS w FROM starts),
often AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
hit AS (SELECT r, s, coalesce(s - lag(s) OVER (PARTITION BY r ORDER BY s) > {_WIDTH}, true) AS fresh FROM windows JOIN often USING (w)),
numbered AS (SELECT r, s, sum(fresh::INT) OVER (PARTITION BY r ORDER BY s) AS k FROM hit),
spans AS (SELECT r, k, min(s) AS lo, max(s) + {_WIDTH} AS hi FROM numbered GROUP BY 1, 2),
gaps AS (SELECT r, k, lo, hi, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY k), 0) AS since FROM spans),
kept AS (SELECT r, sum(hi - lo) AS gone, count(*) AS n, max(hi) AS tail, string_agg(substr(h, 2 * since + 1, 2 * (lo - since)), '' ORDER BY k) AS head
  FROM gaps JOIN docs USING (r) GROUP BY r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
  sha256(from_hex(CASE WHEN n IS NULL THEN h ELSE head || substr(h, 2 * tail + 1) END)) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)""",
)
def op5_suffix_dedup(spark, d):
    return suffix_dedup.repeats_digest(table(spark, d, "documents"))


@query(
    "op1_ngram_jaccard_join",
    f"""WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
sized AS MATERIALIZED (SELECT doc_id, s, len(s) AS n, md5(array_to_string(s, chr(10))) AS k FROM sets),
long AS (SELECT doc_id, unnest(s) AS g FROM sized),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM long a JOIN long b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b, x.k AS ka, y.k AS kb FROM pairs JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
ways AS MATERIALIZED (SELECT a, b, ka, kb FROM links UNION ALL SELECT b, a, kb, ka FROM links),
reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT w.b, reach.r FROM reach JOIN ways w ON w.a = reach.d),
least AS (SELECT d, min(r) AS r FROM reach GROUP BY d),
counts AS (SELECT a, count(DISTINCT kb) FILTER (WHERE ka <> kb) AS c FROM ways GROUP BY a)
SELECT doc_id, n::BIGINT AS n_shingles, r AS component_id, coalesce(c, 0)::BIGINT AS n_links FROM sized JOIN least ON d = doc_id LEFT JOIN counts ON a = doc_id""",
)
def op1_ngram_jaccard_join(spark, d):
    return jaccard_join.jaccard_components(table(spark, d, "documents"), words=3, percent=90)


@query(
    "op11_phrase_collocations",
    f"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS (SELECT lang, o, array_to_string(w[i : i + o - 1], ' ') AS g FROM (SELECT lang, w, o, unnest(range(1, len(w) + 2 - o)) AS i FROM (SELECT lang, w, unnest([1, 2, 3]) AS o FROM words))),
f AS MATERIALIZED (SELECT lang, o, g, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
c AS MATERIALIZED (SELECT lang, o, g, f AS a, string_split(g, ' ') AS s FROM f WHERE o > 1),
cuts AS (SELECT *, array_to_string(s[1 : k], ' ') AS lg, array_to_string(s[k + 1 :], ' ') AS rg FROM (SELECT *, unnest(range(1, o)) AS k FROM c)),
scored AS (SELECT c.lang, c.o, c.g, c.a, min({{'score': ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT, 'k': k, 'l': x.f, 'r': y.f}}) AS m
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = c.lg AND x.o = k JOIN f y ON y.lang = c.lang AND y.g = c.rg AND y.o = c.o - k GROUP BY ALL),
held AS (SELECT lang, g, max(a) AS most FROM (SELECT lang, a, unnest([array_to_string(s[1:2], ' '), array_to_string(s[2:3], ' ')]) AS g FROM c WHERE o = 3) GROUP BY ALL),
stay AS (SELECT s.* FROM scored s LEFT JOIN held h ON h.lang = s.lang AND h.g = s.g AND s.o = 2 WHERE coalesce(100 * most < 50 * a, true)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY m.score DESC, a DESC, g) AS rank FROM stay)
SELECT lang, rank, g AS phrase, a, m.l AS l, m.r AS r, n, m.score AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
)
def op11_phrase_collocations(spark, d):
    return collocations.phrase_collocations(table(spark, d, "documents"))


_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _lloyd_sql(rounds: int) -> str:
    """Rounds of assignment and means, as relations on integers."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (SELECT r, p, min({{'d': list_sum(list_transform(list_zip(s, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': e}}) AS m
  FROM parts JOIN b{k} USING (p) GROUP BY r, p)""")
        if k < rounds:
            steps.append(f"""m{k} AS (SELECT p, e, i, sum(x)::BIGINT AS t, count(*) AS n FROM (SELECT p, m.e AS e, unnest(s) AS x, unnest(range(len(s))) AS i FROM a{k} JOIN parts USING (r, p)) GROUP BY ALL),
n{k} AS (SELECT p, e, list((t - ((t % n) + n) % n) // n ORDER BY i)::BIGINT[] AS c FROM m{k} GROUP BY p, e),
b{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(n.c, b.c) AS c FROM b{k} b LEFT JOIN n{k} n USING (p, e))""")
    return ",\n".join(steps)


@query(
    "op12_vector_codes",
    f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
  list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE {_FINITE}),
parts AS MATERIALIZED (SELECT r, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS s FROM (SELECT r, v, unnest(range(4)) AS p FROM kept)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, s AS c FROM parts WHERE r <= 256),
{_lloyd_sql(4)},
coded AS (SELECT r, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a4 GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b4) AS codebooks_sha256
FROM coded JOIN kept USING (r)""",
)
def op12_vector_codes(spark, d):
    return vector_codes.codes_digest(table(spark, d, "embeddings"))


@query(
    "op13_permutation_index",
    f"""WITH kept AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE {_FINITE} AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_prepend(0.0::DOUBLE, list_transform(list_zip(c.v, q.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), lambda x, y: x + y)) AS score
  FROM kept q JOIN kept c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pairs)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 10""",
)
def op13_permutation_index(spark, d):
    vectors = table(spark, d, "embeddings")
    found = permutation_index.permutation_search(vectors.filter("vec_id % 100 = 0"), vectors)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("vec").alias("vec_id"), "score")
