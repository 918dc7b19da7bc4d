"""Registered queries of the text operators, with their DuckDB oracles where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import (bpe, common, decontam, langid, licenses, quality, secret_scan, simhash, sketch, spelling, suffix, toxicity, warc,
               whitening)

QUERIES: dict = {}
ORACLES: dict = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op9_simhash(spark, sf_dir):
    """Fingerprints over 3-word shingles, links at 3 bits or fewer, smallest id per component."""
    return simhash.digest(simhash.near_duplicates(common.table(spark, sf_dir, "documents"), 3, 3))


@register
def op5_suffix_dedup(spark, sf_dir):
    """Bytes of 50-byte strings that start in a document with a smaller id, removed."""
    return suffix.digest(suffix.remove_repeats(common.table(spark, sf_dir, "documents"), 50))


@register
def op4_bpe(spark, sf_dir):
    """Byte-level BPE of every text by a public rank file, and back."""
    return bpe.round_trip(common.table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@register
def op3_quality(spark, sf_dir):
    """Shape counts and tokeniser fertility of every text, with bands per language or script."""
    return quality.digest(quality.assess(common.table(spark, sf_dir, "documents"),
                                         public_tokenizers.path("piece_bpe_32k.model")))


@register
def op2_secrets(spark, sf_dir):
    """Secrets in every text: base rules, and random strings by character Markov models."""
    return secret_scan.digest(secret_scan.scan_documents(common.table(spark, sf_dir, "documents")))


@register
def op7_decontamination(spark, sf_dir):
    """Benchmark items inside documents within the item's error budget."""
    return decontam.matches(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


@register
def op1_warc(spark, sf_dir):
    """Pages written as WARC records, read back, and indexed in URL and time order."""
    return warc.archive_and_index(common.table(spark, sf_dir, "pages"), common.shared_folder(spark, "warc")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "archive", "position")


@register
def op6_language(spark, sf_dir):
    """Language of every text, learned from the documents outside the held-out fold."""
    return langid.digest(langid.predict_all(common.table(spark, sf_dir, "documents")))


@register
def op10_toxicity(spark, sf_dir):
    """Toxicity of every text, learned from the labels outside the held-out fold."""
    return toxicity.predict_all(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


@register
def op8_licenses(spark, sf_dir):
    """Licence of every document from its notices, or from the nearest licensed directory of its path.

    A document whose text is a licence by half of its words or more is its directory's licence file.
    """
    docs = common.table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    files = docs.select(F.col("doc_id").alias("id"), path.alias("path"), "text")
    return licenses.assign(files, licence_share=0.5).withColumnRenamed("id", "doc_id")


@register
def op11_fingerprint(spark, sf_dir):
    """Threshold-scaled sketch of every text and of its edited text, with containment against that and the next text."""
    return sketch.compare_next(common.table(spark, sf_dir, "documents"))


@register
def op12_whitening(spark, sf_dir):
    """Every embedding along the 32 largest components, whitened."""
    return whitening.whiten(common.table(spark, sf_dir, "embeddings"), 32)


@register
def op13_spelling(spark, sf_dir):
    """Words of all texts with their near words, the form of each, and the root of its chain of forms."""
    return spelling.variants(common.table(spark, sf_dir, "documents"))


# CRC-32 bit by bit: every byte of the UTF-8 text (letters below U+0100) is followed by seven steps without input.
# A replacement is an equal deletion at an equal place; an insertion is the other word's deletion.
ORACLES["op13_spelling"] = """
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::varchar, '') AS id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
seen AS (SELECT id, run, count(*) AS c FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, c, xor(list_reduce([4294967295::bigint] || flatten(list_transform(string_split(id || ':' || run, ''),
           lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::bigint, 0, 0, 0, 0, 0, 0, 0]
                           ELSE [195::bigint, 0, 0, 0, 0, 0, 0, 0, unicode(ch)::bigint - 64, 0, 0, 0, 0, 0, 0, 0] END)),
         lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295) AS h
  FROM seen),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         sum(c)::bigint AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(c) >= 3),
dels AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS k
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
shorter AS (SELECT DISTINCT d.word, d.n, w.word AS other, w.n AS m FROM dels d JOIN words w ON w.word = d.k),
near AS (
  SELECT * FROM shorter UNION ALL SELECT other, m, word, n FROM shorter
  UNION ALL SELECT a.word, a.n, b.word, b.n FROM dels a JOIN dels b ON a.i = b.i AND a.k = b.k AND a.word <> b.word),
best AS (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS r, count(*) OVER (PARTITION BY word) AS n_near
  FROM near),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::bigint AS n_near, CASE WHEN b.m >= 2 * w.n THEN b.other END AS form,
         CASE WHEN b.m >= 2 * w.n THEN b.m END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND b.r = 1),
chain AS (
  SELECT word, form AS root, 1 AS depth FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT c.word, f.form, c.depth + 1 FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, depth) AS root FROM chain GROUP BY word)
SELECT f.word, f.form, coalesce(e.root, f.word) AS root, f.n, f.n_near, f.form_n
FROM formed f LEFT JOIN ends e ON e.word = f.word
"""
