"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, table
from . import (divergence, embedding_dedup, fill_middle, fingerprints, line_dedup, minhash_dedup, mixing, packing, quality, sharding, substring_dedup,
               token_files, warc)

SHARDS = 16
MIX_SEED, MIX_TEMPERATURE = 11, 0.7
THRESHOLD = 0.3


def op1_jump_shards(spark, sf_dir):
    """All documents in 16 shards; with one more shard, rows move only into that one."""
    rows = sharding.shard(table(spark, sf_dir, "documents"), SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op2_minhash_near_dedup(spark, sf_dir):
    found = minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op3_best_fit_packing(spark, sf_dir):
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_embedding_near_dedup(spark, sf_dir):
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_substring_dedup(spark, sf_dir):
    found = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"), keep_text=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_fingerprints(spark, sf_dir):
    return fingerprints.compare_with_edited(table(spark, sf_dir, "documents"))


def op7_poisson_mix(spark, sf_dir):
    """Sources mixed to shares in proportion to size ** 0.7, as large as the input on average."""
    rows = mixing.mix(table(spark, sf_dir, "documents"), seed=MIX_SEED, temperature=MIX_TEMPERATURE)
    return rows.select("doc_id", "source", F.md5("text").alias("text_md5"), F.col("_rate").alias("rate"),
                       F.col("_copy").alias("copy"), F.col("_mix_key").alias("mix_key"))


def op8_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), weights)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op9_line_dedup(spark, sf_dir):
    """Every document with its aligned lines deleted; the text itself and how many lines went."""
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "text")


def op10_token_files(spark, sf_dir):
    """Token files of all documents, read back."""
    target = f"{ensure_checkpoint_dir(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write(table(spark, sf_dir, "documents"), target)
    return token_files.digests(spark, target)


def op11_fill_middle(spark, sf_dir):
    """Every document rearranged; digests of the output and of the text rebuilt from it."""
    rows = fill_middle.fill_middle(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_middle.restored(), 256).alias("restored_sha256"))


def op12_warc(spark, sf_dir):
    """Archives of all pages, read back."""
    target = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(table(spark, sf_dir, "pages"), target)
    return warc.read(spark, target, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_source_divergence(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents"))


#: Copies, keys and rates follow from md5 and plain arithmetic, so DuckDB can repeat op7 row by row.
OP7_SQL = f"""
WITH RECURSIVE per AS (
  SELECT source, sum(octet_length(encode(coalesce(text, ''))) + 1) AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, round(pow(size::DOUBLE, {MIX_TEMPERATURE}) / (SELECT sum(pow(size::DOUBLE, {MIX_TEMPERATURE})) FROM per)
                       * (SELECT sum(size) FROM per)::DOUBLE / size, 6) AS rate FROM per),
terms AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM terms WHERE k + 1 <= ceil(rate + 12 * sqrt(rate) + 25)),
drawn AS (
  SELECT d.doc_id, d.source, md5(d.text) AS text_md5, r.rate,
         ((('0x' || substr(md5('{MIX_SEED}|' || coalesce(d.doc_id::VARCHAR, '\\N') || '|1'), 1, 13))::BIGINT)::DOUBLE + 0.5) / {1 << 52} AS u
  FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
counted AS (
  SELECT any_value(d.doc_id) AS doc_id, any_value(d.source) AS source, any_value(d.text_md5) AS text_md5, any_value(d.rate) AS rate,
         count(*) FILTER (t.c < d.u) AS n
  FROM (SELECT *, row_number() OVER () AS rn FROM drawn) d JOIN terms t ON d.source IS NOT DISTINCT FROM t.source GROUP BY d.rn)
SELECT doc_id, source, text_md5, rate, c.copy::INTEGER AS copy,
       md5('place|{MIX_SEED}|' || coalesce(doc_id::VARCHAR, '\\N') || '|' || c.copy::VARCHAR) AS mix_key
FROM counted, unnest(range(n)) AS c(copy)
"""


OP11_SQL = """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || doc_id::VARCHAR) AS h FROM documents),
drawn AS (
  SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM units),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS prefix, coalesce(array_to_string(u[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(u[b + 1:n], ''), '') AS suffix FROM cuts)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form != 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form != 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

OP12_SQL = """
WITH bodies AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
digits AS (
  SELECT *, list_transform(range(8), lambda g: ('0x' || substr(h, 5 * g + 1, 5))::BIGINT) AS groups,
         min(page_id) OVER (PARTITION BY h, payload_bytes) AS first FROM bodies)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((groups[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id != first THEN first END AS refers_to
FROM digits
"""

OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
uses AS (SELECT r, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS whole FROM uses GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(whole) AS total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM uses SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
sources AS (SELECT DISTINCT lang, source FROM docs),
sums AS (SELECT s.lang, s.source, coalesce(sum(n), 0) AS total FROM sources s LEFT JOIN counts USING (lang, source) GROUP BY ALL),
prices AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (s.total + 5 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.whole + 5)) // (l.total + 5 * l.v) AS q
  FROM sums s JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source != b.source
  LEFT JOIN prices x ON x.lang = a.lang AND x.source = a.source LEFT JOIN prices y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM prices WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def queries():
    def named(f):
        def query(spark, sf_dir):
            ensure_checkpoint_dir(spark)
            return f(spark, sf_dir)
        return query

    return {name: named(f) for name, f in globals().items() if name[:2] == "op" and name[2].isdigit()}


def oracle_sql():
    return {"op7_poisson_mix": OP7_SQL, "op11_fill_middle": OP11_SQL, "op12_warc": OP12_SQL, "op13_source_divergence": OP13_SQL}
