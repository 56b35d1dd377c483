"""The registered queries of this package: thin, over whole tables, each next to its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read_table
from tidemark.llm.language import languages
from tidemark.llm.lexical import build_index, search
from tidemark.llm.lines import dedup_lines
from tidemark.llm.mixing import mixed
from tidemark.llm.quality import quality
from tidemark.llm.quotes import linked_conversations
from tidemark.llm.ring import shard_documents
from tidemark.llm.rules import judged
from tidemark.llm.runs import word_runs
from tidemark.llm.segments import top_pairs
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.toxicity import toxicity
from tidemark.llm.winnow import contamination

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its own name."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql.strip()
        return function

    return register


@query()
def op1_raked_mix(spark, sf_dir):
    return mixed(read_table(spark, sf_dir, "documents"))


# Words of whole texts, every window of 13 (or all) item words, and each document word inside an occurrence.
OP2_SQL = r"""
WITH tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS span
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS span
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM tokens, lengths WHERE len(w) >= n)),
found AS (SELECT doc_id, p.n, i, item_id FROM places p JOIN windows v ON p.n = v.n AND p.span = v.span),
hit AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM (SELECT DISTINCT doc_id, n, i FROM found)) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM tokens t LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query(OP2_SQL)
def op2_winnowed_contamination(spark, sf_dir):
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 10
"""


@query(OP3_SQL)
def op3_topk_segments(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    return top_pairs(vectors, vectors.filter("vec_id % 100 = 0"))


OP4_SQL = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS spot FROM split),
keyed AS (
  SELECT doc_id, line, spot, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE keeper > doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY spot) FILTER (WHERE keeper IS NULL OR keeper <= doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent USING (key) GROUP BY doc_id
"""


@query(OP4_SQL)
def op4_line_dedup(spark, sf_dir):
    kept = dedup_lines(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op5_quote_links(spark, sf_dir):
    return linked_conversations(read_table(spark, sf_dir, "conversations"))


@query()
def op6_simhash_near_dedup(spark, sf_dir):
    return near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query()
def op7_toxicity(spark, sf_dir):
    scored = toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "offending", F.size("offending").alias("n_offending"))


@query()
def op8_language_id(spark, sf_dir):
    return languages(read_table(spark, sf_dir, "documents"))


@query()
def op9_ring_shards(spark, sf_dir):
    return shard_documents(read_table(spark, sf_dir, "documents"))


@query()
def op10_quality(spark, sf_dir):
    return quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
totals AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM docs WHERE len(w) > 0),
norms AS (SELECT row_id, doc_id, 100 - 75 + ((75 * len(w) * docs) // terms) AS m FROM docs, totals WHERE len(w) > 0),
postings AS (SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(w) AS term FROM docs) GROUP BY row_id, term),
asked AS (
  SELECT item_id, term, count(*) AS repeats
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals),
scores AS (
  SELECT item_id, row_id, doc_id, CAST(sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN norms USING (row_id) GROUP BY item_id, row_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""


@query(OP11_SQL)
def op11_stratified_search(spark, sf_dir):
    return search(build_index(read_table(spark, sf_dir, "documents")), read_table(spark, sf_dir, "benchmark"))


# Lines of more than five documents and of more than 2 % of the host's documents go; equal texts of a host are one document.
OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, string_split(coalesce(text, ''), chr(10)) AS l
  FROM documents),
grams AS (
  SELECT row_id, i, array_to_string(w[i : i + 7], ' ') AS gram FROM (SELECT row_id, w, unnest(range(1, len(w) - 6)) AS i FROM docs)),
again AS (SELECT row_id, gram FROM grams GROUP BY row_id, gram HAVING count(*) > 1),
repeated AS (
  SELECT row_id, count(DISTINCT spot) AS n
  FROM (SELECT row_id, unnest(range(i, i + 8)) AS spot FROM grams JOIN again USING (row_id, gram)) GROUP BY row_id),
lines AS (
  SELECT row_id, source, text, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT row_id, source, text, unnest(l) AS line FROM docs) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
doubled AS (SELECT row_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY row_id),
hosts AS (SELECT source, count(DISTINCT text) AS n FROM docs GROUP BY source),
frequent AS (
  SELECT k.source, key FROM (SELECT source, key, count(DISTINCT text) AS n FROM lines GROUP BY source, key HAVING count(DISTINCT text) > 5) k
  JOIN hosts h ON k.source IS NOT DISTINCT FROM h.source AND k.n * 100 > h.n * 2),
lost AS (
  SELECT row_id, sum(words) AS n FROM lines JOIN frequent f ON lines.key = f.key AND lines.source IS NOT DISTINCT FROM f.source GROUP BY row_id),
base AS (
  SELECT row_id, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         coalesce(doubled.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed_words
  FROM docs LEFT JOIN doubled USING (row_id) LEFT JOIN repeated USING (row_id) LEFT JOIN lost USING (row_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 2 * (n_words - n_removed_words) >= n_words AS kept
FROM base
"""


@query(OP12_SQL)
def op12_line_frequency(spark, sf_dir):
    return judged(read_table(spark, sf_dir, "documents"))


# Equal words q apart, in islands: an island of c words is a run of c + q words if that is four periods; the least q of a stretch is its period.
OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT)) AS code
  FROM documents),
hashed AS (
  SELECT row_id, doc_id, w, len(w) AS n,
         xor(4294967295, list_reduce(list_prepend(4294967295, code),
                                     lambda c, b: list_reduce(list_prepend(xor(c, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
                                                              lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) AS h
  FROM docs),
placed AS (
  SELECT *, CASE WHEN n > 0 THEN (h // 10) % n END AS a, CASE WHEN n > 0 THEN 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) END AS p FROM hashed),
given AS (SELECT *, h IS NOT NULL AND h % 10 = 0 AS tailed FROM placed),
spots AS (SELECT row_id, n, w, a, p, tailed, unnest(range(0, n)) AS i FROM given),
words AS (SELECT row_id, n, i, w[1 + CASE WHEN tailed AND i >= a THEN a + (i - a) % p ELSE i END] AS word FROM spots),
same AS (
  SELECT x.row_id, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.row_id = y.row_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (
  SELECT row_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT row_id, q, i, i - row_number() OVER (PARTITION BY row_id, q ORDER BY i) AS island FROM same) GROUP BY row_id, q, island),
runs AS (
  SELECT row_id, start, length, min(q) AS period FROM islands WHERE length >= 6 AND length >= 4 * q GROUP BY row_id, start, length),
best AS (
  SELECT row_id, start, length, period, row_number() OVER (PARTITION BY row_id ORDER BY length DESC, start, period) AS place FROM runs),
listed AS (
  SELECT row_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM runs GROUP BY row_id),
dropped AS (SELECT DISTINCT row_id, unnest(range(start + period, start + length)) AS i FROM runs),
left_over AS (
  SELECT row_id, string_agg(word, ' ' ORDER BY i) AS body FROM words LEFT JOIN (SELECT row_id, i, true AS gone FROM dropped) USING (row_id, i)
  WHERE gone IS NULL GROUP BY row_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (row_id) LEFT JOIN left_over USING (row_id)
LEFT JOIN (SELECT row_id, start, length, period FROM best WHERE place = 1) USING (row_id)
"""


@query(OP13_SQL)
def op13_word_runs(spark, sf_dir):
    found = word_runs(read_table(spark, sf_dir, "documents"), repeat_tails=True)
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    chosen = found.withColumn("longest", longest).withColumn("length", -F.col("longest.length"))
    return chosen.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        "length",
        F.col("longest.period").alias("period"),
        F.expr("1000 * length div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
