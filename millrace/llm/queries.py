"""Registered queries of this subpackage: QUERIES[name](spark, folder), and ORACLE_SQL[name] where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import collocations, divergence, exact_dedup, language_id, near_dedup, ngram_scores, packing, pairwise_quality, pieces, pseudonyms, quality_rules, token_counts, token_files
from millrace.llm.common import pseudonym_key, read_table, tokenizer_file
from millrace.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
#: No secret: the registered query and the pipeline run where none is set, on tables without real persons.
TRIAL_KEY = "not a secret"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, folder: fn(tune(spark), folder)
    return fn


@query
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.decisions(read_table(spark, folder, "documents"))


ORACLE_SQL["op9_exact_dedup"] = r"""
WITH keyed AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
  first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS kept,
  text_sha256
FROM keyed
"""


@query
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs, read_table(spark, folder, "labels")))


@query
def op1_hierarchical_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read_table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query
def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.through_files(read_table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"), 49_408)


@query
def op2_setsketch_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.classes(read_table(spark, folder, "documents"), words=2, percent=80)


@query
def op3_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return pseudonyms.report(read_table(spark, folder, "documents"), pseudonym_key(spark, TRIAL_KEY))


@query
def op6_language_mixtures(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(read_table(spark, folder, "documents"))


@query
def op4_ngram_scores(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_scores.score(read_table(spark, folder, "documents"))


@query
def op7_unigram_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode(read_table(spark, folder, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count(read_table(spark, folder, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(read_table(spark, folder, "documents"))


ORACLE_SQL["op11_collocations"] = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), phrases AS (
  SELECT lang, n_words, phrase, count(*) AS a
  FROM (
    SELECT lang, g.n_words, unnest(list_transform(range(1, len(w) - g.n_words + 2), lambda i: array_to_string(w[i:i + g.n_words - 1], ' '))) AS phrase
    FROM words, (SELECT unnest([1, 2, 3, 4]) AS n_words) g
    WHERE len(w) >= g.n_words
  )
  GROUP BY lang, n_words, phrase
), totals AS (
  SELECT lang, sum(a)::BIGINT AS n FROM phrases WHERE n_words = 1 GROUP BY lang
), often AS (
  SELECT *, string_split(phrase, ' ') AS w FROM phrases WHERE a >= 30
), cuts AS (
  SELECT lang, phrase, n_words, a, w, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, n_words)) AS k FROM often WHERE n_words > 1)
), scored AS (
  SELECT c.lang, c.phrase, c.n_words, c.a, l.a AS l, r.a AS r, ((2000000::HUGEINT * c.a) // (l.a::HUGEINT + r.a))::BIGINT AS score,
    row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (2000000::HUGEINT * c.a) // (l.a::HUGEINT + r.a), k) AS cut
  FROM cuts c
  JOIN often l ON l.lang = c.lang AND l.phrase = c.first
  JOIN often r ON r.lang = c.lang AND r.phrase = c.rest
), inside AS (
  SELECT lang, phrase, max(a) AS most
  FROM (
    SELECT lang, a, unnest(list_transform(range(1, n_words - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
    FROM (SELECT *, unnest(range(2, n_words)) AS size FROM often WHERE n_words > 2)
  )
  GROUP BY lang, phrase
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE cut = 1 AND (i.most IS NULL OR 100::HUGEINT * i.most < 80::HUGEINT * s.a)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query
def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(read_table(spark, folder, "documents"))


ORACLE_SQL["op13_source_divergence"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts
), kept AS (
  SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words GROUP BY lang, source, term
), found AS (
  SELECT c.* FROM counts c JOIN kept USING (lang, term)
), langs AS (
  SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang
), groups AS (
  SELECT g.lang, g.source, coalesce(max(l.v), 0) AS v, coalesce(sum(f.n), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM texts) g
  LEFT JOIN langs l ON l.lang = g.lang
  LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source
  GROUP BY g.lang, g.source
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(f.n, 0) + 1)) // (g.n + g.v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (k.total + 1)) // (l.n + l.v)::HUGEINT AS q
  FROM groups g
  JOIN kept k ON k.lang = g.lang
  JOIN langs l ON l.lang = g.lang
  LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source
  GROUP BY a.lang, a.source, b.source
), rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source != b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM rows
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""


@query
def op12_pairwise_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return pairwise_quality.score(docs, pairwise_quality.fit(docs, read_table(spark, folder, "labels")))
