"""The operators as queries over whole tables, with production parameters,
and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from promo_engine.llm import (ann, bpe, collocations, common, exact_dedup, hard_negatives, hmm_lm, language,
                              line_templates, mixing, ngram_join, quality, sharding, substring_dedup)
from promo_engine.sources.tables import read_table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.remove_repeats(common.documents(spark, sf_dir)))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digest(common.documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.digest(line_templates.drop_recurring(common.documents(spark, sf_dir)))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates, _ = mixing.mix(common.documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))
    return rates.drop("row")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(common.documents(spark, sf_dir))


def op6_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.score(common.documents(spark, sf_dir))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_groups(common.documents(spark, sf_dir)).drop("hash")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(common.documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(common.documents(spark, sf_dir))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(common.documents(spark, sf_dir))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(common.documents(spark, sf_dir))


def _shipped(query: Callable) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(common.ship_package(spark), sf_dir)
    run.__name__ = query.__name__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: _shipped(q) for q in (
        op1_substring_dedup, op2_byte_bpe, op3_line_templates, op4_mixing, op5_exact_dedup, op6_hmm_scores,
        op7_ngram_join, op8_quality, op9_sharding, op10_nearest, op11_hard_negatives, op12_language,
        op13_collocations)}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
spot AS (SELECT r, w, unnest(range(1, len(w) - {substring_dedup.WINDOW_WORDS - 2})) AS i FROM d),
win AS (SELECT r, i, array_to_string(w[i:i + {substring_dedup.WINDOW_WORDS - 1}], ' ') AS k FROM spot),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {substring_dedup.WINDOW_WORDS})) AS i FROM twice),
word AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP3_SQL = rf"""
WITH line AS (SELECT row_number() OVER () AS line_no, doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
one AS (SELECT line_no AS r, doc_id, unnest(parts) AS l, unnest(range(1, len(parts) + 1)) AS pos FROM line),
plain AS (SELECT r, doc_id, pos, l, trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS p FROM one),
mask AS (SELECT r, doc_id, pos, regexp_replace(p, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS m FROM plain),
tok AS (SELECT *, string_split(m, ' ') AS t FROM mask WHERE m <> '' AND len(string_split(m, ' ')) >= {line_templates.MIN_TOKENS}),
leafed AS (SELECT *, len(t) || ' ' || array_to_string(t[1:{line_templates.DEPTH}], ' ') AS leaf FROM tok),
own AS (SELECT m, leaf, count(DISTINCT doc_id) AS docs, min(doc_id) AS first_doc, count(*) AS lines FROM leafed GROUP BY m, leaf),
leaf_ok AS (SELECT leaf, sum(lines) AS total FROM own GROUP BY leaf
            HAVING count(*) > 1 AND sum(docs) >= {line_templates.MIN_DOCS}),
var AS (SELECT leafed.*, total FROM leafed JOIN leaf_ok USING (leaf)),
cell AS (SELECT leaf, total, unnest(t) AS token, unnest(range(1, len(t) + 1)) AS i FROM var),
freq AS (SELECT leaf, i, token, count(*) AS c FROM cell GROUP BY leaf, total, i, token
         HAVING count(*) >= total * {line_templates.MAJORITY}),
top AS (SELECT leaf, i, token FROM (SELECT *, row_number() OVER (PARTITION BY leaf, i ORDER BY c DESC, token DESC) AS k
        FROM freq) WHERE k = 1),
form AS (SELECT DISTINCT leaf, m, t FROM var),
form_cell AS (SELECT leaf, m, len(t) AS n, unnest(t) AS token, unnest(range(1, len(t) + 1)) AS i FROM form),
follow AS (SELECT leaf, m FROM form_cell LEFT JOIN top USING (leaf, i, token) GROUP BY leaf, m, n
           HAVING sum(CASE WHEN top.token IS NOT NULL THEN 1 ELSE 0 END) >= n * {line_templates.SIMILARITY}),
shared AS (SELECT leaf, min(doc_id) AS first_doc FROM leafed SEMI JOIN follow USING (leaf, m) GROUP BY leaf
           HAVING count(DISTINCT doc_id) >= {line_templates.MIN_DOCS}),
dropped AS (SELECT m, min(first_doc) AS first_doc FROM (
    SELECT m, first_doc FROM follow JOIN shared USING (leaf) UNION ALL
    SELECT m, first_doc FROM own WHERE docs >= {line_templates.MIN_DOCS}) GROUP BY m),
gone AS (SELECT r, pos FROM leafed JOIN dropped USING (m) WHERE doc_id <> first_doc),
kept AS (SELECT r, count(*) AS n, string_agg(l, chr(10) ORDER BY pos) AS k FROM plain ANTI JOIN gone USING (r, pos) GROUP BY r)
SELECT doc_id, coalesce(len(parts), 0) AS n_lines, coalesce(len(parts), 0) - coalesce(n, 0) AS n_dropped,
       sha256(coalesce(k, '')) AS kept_sha256
FROM line LEFT JOIN kept ON line_no = r
"""

OP5_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n
           FROM documents),
k AS (SELECT doc_id, n, first_value(doc_id) OVER (PARTITION BY n ORDER BY length(t) DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY n) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n) AS text_sha256 FROM k
"""

OP7_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM d),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM g),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n AS n, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
      GROUP BY 1, 2, 3),
link AS (SELECT a, b FROM p WHERE c >= {ngram_join.THRESHOLD} * (n - c) - 1e-9),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
cls AS (SELECT a AS doc_id, min(b) AS class_id, count(*) AS class_size FROM reach GROUP BY a),
num AS (SELECT a AS doc_id, count(*) AS n_links FROM link GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, class_size, doc_id = class_id AS kept
FROM cls LEFT JOIN num USING (doc_id)
"""

OP11_SQL = rf"""
WITH r AS (SELECT vec_id, CASE WHEN vec_id % {hard_negatives.FLIP_STEP} = 0 THEN (label + 1) % {hard_negatives.LABELS} ELSE label END AS label,
                  list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * x::DOUBLE)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT vec_id AS anchor_id, label, v FROM r WHERE vec_id % {hard_negatives.ANCHOR_STEP} = 0),
p AS (SELECT anchor_id, a.label, r.vec_id, r.label = a.label AS same, list_dot_product(a.v, r.v)::BIGINT AS s
      FROM a JOIN r ON r.vec_id <> a.anchor_id AND len(r.v) = len(a.v)),
pos AS (SELECT anchor_id, vec_id AS positive_id, s AS positive_score FROM p WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, vec_id) <= {hard_negatives.POSITIVES})
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, s AS negative_score
FROM pos JOIN p USING (anchor_id)
WHERE NOT same AND {hard_negatives.LOW}::HUGEINT * positive_score <= 100::HUGEINT * s
      AND 100::HUGEINT * s <= {hard_negatives.HIGH}::HUGEINT * positive_score
QUALIFY rank <= {hard_negatives.NEGATIVES}
"""

OP13_SQL = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
piece AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
word AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
spot AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM word, (SELECT unnest(range(1, {collocations.LONGEST + 1})) AS k)),
f AS (SELECT lang, k, w[i:i + k - 1] AS w, count(*) AS f FROM spot GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT * FROM f WHERE k > 1 AND f >= {collocations.MIN_COUNT}),
cut AS (SELECT *, unnest(range(1, k)) AS j FROM cand),
scored AS (SELECT c.lang, c.w, c.f AS a, x.f AS l, y.f AS r, ({collocations.SCALE} * c.f::HUGEINT) // (x.f + y.f) AS score, j
           FROM cut c JOIN f x ON x.lang = c.lang AND x.w = c.w[1:j] JOIN f y ON y.lang = c.lang AND y.w = c.w[j + 1:c.k]),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, j) = 1),
inner_part AS (SELECT lang, f, k, w, unnest(range(2, k)) AS m FROM cand),
inside AS (SELECT lang, f, w, m, unnest(range(1, k - m + 2)) AS i FROM inner_part),
around AS (SELECT lang, w[i:i + m - 1] AS w, max(f) AS f FROM inside GROUP BY ALL),
kept AS (SELECT least.* FROM least LEFT JOIN around USING (lang, w)
         WHERE around.f IS NULL OR {collocations.COVER[1]} * around.f < {collocations.COVER[0]} * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ')) AS rank,
       array_to_string(w, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN total USING (lang) QUALIFY rank <= {collocations.TOP}
"""

ORACLES = {"op1_substring_dedup": OP1_SQL, "op3_line_templates": OP3_SQL, "op5_exact_dedup": OP5_SQL,
           "op7_ngram_join": OP7_SQL, "op11_hard_negatives": OP11_SQL,
           "op13_collocations": OP13_SQL}
