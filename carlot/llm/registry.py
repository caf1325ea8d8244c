"""Queries of the numbered operators, and comparison SQL where SQL can say it."""

from __future__ import annotations

from carlot.llm.ann_projection import op2_ann_projection
from carlot.llm.chat_format import op7_chat_format
from carlot.llm.exact_dedup import dedup_report
from carlot.llm.hard_negatives import op12_hard_negatives
from carlot.llm.lexical_search import op13_lexical_search
from carlot.llm.ngram_join import op5_ngram_join
from carlot.llm.packing import op6_packing
from carlot.llm.pii_surrogates import op1_pii
from carlot.llm.quality_rules import op4_quality_rules
from carlot.llm.secret_scan import op3_secret_scan
from carlot.llm.sentencepiece_viterbi import op8_sentencepiece
from carlot.llm.sharding import op11_sharding
from carlot.llm.toxicity import op10_toxicity

AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def op9_exact_dedup(spark, sf_dir):
    return dedup_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_ann_projection": op2_ann_projection,
    "op3_secret_scan": op3_secret_scan,
    "op4_quality_rules": op4_quality_rules,
    "op5_ngram_join": op5_ngram_join,
    "op6_packing": op6_packing,
    "op7_chat_format": op7_chat_format,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_sharding": op11_sharding,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_lexical_search": op13_lexical_search,
}

SQL = {
    "op5_ngram_join": rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{AZ}', '{AZ.lower()}'), '{WORD}') AS w FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS held
    FROM worded
), tokens AS (
    SELECT doc_id, len(held) AS n, unnest(held) AS token FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), tied AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reached(doc_id, other) AS (
    SELECT a, b FROM tied UNION SELECT reached.doc_id, tied.b FROM reached JOIN tied ON reached.other = tied.a
)
SELECT sets.doc_id, any_value(len(held)) AS n_shingles, coalesce(min(other), sets.doc_id) AS component_id
FROM sets LEFT JOIN reached USING (doc_id) GROUP BY sets.doc_id
""",
    "op7_chat_format": r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *, length(regexp_replace(regexp_replace(regexp_replace(role || chr(0) || text,
        '&((amp;)*(lt|lsqb);)', '&amp;\1', 'g'), '<(/?s>)', '&lt;\1', 'g'), '\[(/?INST\])', '&lsqb;\1', 'g')) + 19 AS n
    FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op9_exact_dedup": f"""
WITH folded AS (
    SELECT doc_id, translate(coalesce(text, ''), '{AZ}', '{AZ.lower()}') AS body FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       coalesce(doc_id = max(doc_id) OVER w, max(doc_id) OVER w IS NULL) AS kept,
       sha256(body) AS text_sha256
FROM folded WINDOW w AS (PARTITION BY body)
""",
    "op12_hard_negatives": """
WITH valid AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           CAST(list_inner_product(a.vector, c.vector) AS BIGINT) AS score
    FROM valid a JOIN valid c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id,
       positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3
""",
    "op13_lexical_search": rf"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), '{AZ}', '{AZ.lower()}'), '{TERM}') AS terms
    FROM documents
), corpus AS (
    SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs WHERE len(terms) > 0
), asked AS (
    SELECT item, any_value(item_id) AS item_id, term, count(*) AS times FROM (
        SELECT row_number() OVER () AS item, item_id,
               unnest(regexp_extract_all(translate(coalesce(text, ''), '{AZ}', '{AZ.lower()}'), '{TERM}')) AS term
        FROM benchmark
    ) GROUP BY item, term
), held AS (
    SELECT doc, any_value(doc_id) AS doc_id, term, count(*) AS tf, any_value(n) AS n
    FROM (SELECT doc, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM asked) GROUP BY doc, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM held, corpus GROUP BY term, n_docs
), scores AS (
    SELECT item, any_value(item_id) AS item_id, doc, any_value(doc_id) AS doc_id,
           CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN held USING (term), corpus GROUP BY item, doc
)
SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0
WINDOW w AS (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)
QUALIFY row_number() OVER w <= 10
""",
}
