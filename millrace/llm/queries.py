"""The operators' queries over their whole tables, and the SQL checks of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import caps, collocations, exact, jaccard, langid, licenses, mixing, packing, pii, quotes, suffix, toxicity, whitening
from millrace.llm.common import UPPER, settled, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (session, folder) under its name."""
    def keep(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(settled(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql:
            SQL[fn.__name__] = sql
        return run
    return keep


@query(f"""
WITH norm AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS t FROM documents),
     groups AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM norm GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM norm JOIN groups USING (t)
""")
def op1_exact_dedup(spark, sf_dir):
    out = exact.exact_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query()
def op4_entropy_mix(spark, sf_dir):
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query()
def op8_bin_slack_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


@query()
def op2_toxicity_grammar(spark, sf_dir):
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op5_personal_data(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents")).drop("base")


@query()
def op9_ngram_jaccard(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


@query()
def op3_suffix_dedup(spark, sf_dir):
    return suffix.repeated_strings(table(spark, sf_dir, "documents")).drop("span_edges")


@query("""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
roots AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degrees AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN roots USING (vec_id) LEFT JOIN degrees USING (vec_id)
""")
def op6_cap_filters(spark, sf_dir):
    return caps.near_vectors(table(spark, sf_dir, "embeddings"))


@query()
def op10_quotation_threads(spark, sf_dir):
    return quotes.reply_order(table(spark, sf_dir, "conversations"))


@query(f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM words, (VALUES (1), (2), (3)) AS sizes(k), LATERAL (SELECT unnest(generate_series(1, len(w) - k + 1)) AS i)),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
frequent AS (SELECT *, string_split(phrase, ' ') AS p FROM counts WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.f AS a, j, x.f AS l, y.f AS r,
         CAST(1000000 AS HUGEINT) * c.f * c.f // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM frequent c, LATERAL (SELECT unnest(generate_series(1, c.k - 1)) AS j)
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.p[1:j], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.p[j + 1:c.k], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
within AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, array_to_string(p[1:2], ' ') AS phrase, f FROM frequent WHERE k = 3
    UNION ALL SELECT lang, array_to_string(p[2:3], ' '), f FROM frequent WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT w.* FROM weakest w LEFT JOIN within USING (lang, phrase) WHERE within.f IS NULL OR 100 * within.f < 50 * w.a),
ranks AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranks JOIN totals USING (lang) WHERE rank <= 2000
""")
def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query()
def op12_license_scan(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents"))


@query()
def op13_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
