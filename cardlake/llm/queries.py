"""The registered queries of this subpackage, each with its SQL where SQL can express it."""

from __future__ import annotations

from cardlake.llm import (bpe, conversations, decontaminate, html_extract, jaccard_join, katz, language, lexical, secrets,
                          sharding, toxicity, vector_search, warc)

QUERIES = {
    "op1_toxicity": toxicity.op1,
    "op2_katz_backoff": katz.op2,
    "op3_html_extraction": html_extract.op3,
    "op4_decontamination": decontaminate.op4,
    "op5_secret_scan": secrets.op5,
    "op6_exact_top_k": vector_search.op6,
    "op7_warc_revisits": warc.op7,
    "op8_bpe_automaton": bpe.op8,
    "op9_ngram_jaccard_join": jaccard_join.op9,
    "op10_language_id": language.op10,
    "op11_conversation_repair": conversations.op11,
    "op12_histogram_sort": sharding.op12,
    "op13_lexical_search": lexical.op13,
}
ORACLES: dict[str, str] = {
    "op6_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5""",
    "op7_warc_revisits": """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY ALL)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)""",
    "op13_lexical_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS doc_row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (
  SELECT row_number() OVER () AS item_row, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM benchmark),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_terms FROM d WHERE len(words) > 0),
tf AS (SELECT doc_row, doc_id, n, term, count(*) AS tf FROM (SELECT doc_row, doc_id, len(words) AS n, unnest(words) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (
  SELECT item_row, item_id, term, count(*) * CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT item_row, item_id, unnest(words) AS term FROM b) JOIN df USING (term), s GROUP BY item_row, item_id, term, df, n_docs),
scored AS (
  SELECT item_row, item_id, doc_row, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term), s GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_row ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0 AND doc_id IS NOT NULL)
WHERE rank <= 20""",
}
