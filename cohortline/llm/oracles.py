"""DuckDB SQL of the queries that SQL can express."""

_BASE32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"

OP1 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS n, sha1(html) AS x, min(page_id) OVER (PARTITION BY html) AS response FROM p),
parts AS (SELECT page_id, k, ('0x' || substr(x, 5 * k + 1, 5))::BIGINT AS v FROM h, (SELECT unnest(range(8)) AS k)),
codes AS (SELECT page_id, string_agg(
    substr({_BASE32}, ((v >> 15) & 31)::INT + 1, 1) || substr({_BASE32}, ((v >> 10) & 31)::INT + 1, 1) ||
    substr({_BASE32}, ((v >> 5) & 31)::INT + 1, 1) || substr({_BASE32}, (v & 31)::INT + 1, 1), '' ORDER BY k) AS digest
  FROM parts GROUP BY page_id)
SELECT h.page_id, h.n::BIGINT AS payload_bytes, c.digest AS payload_digest,
       CASE WHEN h.response = h.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN h.response <> h.page_id THEN h.response END AS refers_to
FROM h JOIN codes c USING (page_id)
"""


def _reach(nodes: str, links: str) -> str:
    """Smallest id that each node reaches; ``links`` has both directions."""
    return f"""
reach(id, c) AS (
  SELECT id, id FROM ({nodes})
  UNION
  SELECT l.v, r.c FROM reach r JOIN ({links}) l ON l.u = r.id),
classes AS (SELECT id, min(c) AS component FROM reach GROUP BY id)"""


OP4 = f"""
WITH RECURSIVE e AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0
    AND len(list_filter(embedding, lambda y: y <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM e a JOIN e b
          ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.9),
{_reach("SELECT vec_id AS id FROM embeddings", "SELECT * FROM links")},
n AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component AS component_id, vec_id = component AS kept
FROM embeddings JOIN classes ON id = vec_id LEFT JOIN n ON u = vec_id
"""

OP7 = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, k, array_to_string(w[k:k + 12], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d WHERE len(w) >= 13)),
first AS (SELECT s, min(doc_id) AS least FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, k + unnest(range(13)) AS k FROM win JOIN first USING (s) WHERE least < doc_id),
words AS (SELECT doc_id, w[k] AS x, k FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM d)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY k) AS s, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP10 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM both_ JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 75 * (x.n + y.n - c)),
{_reach("SELECT doc_id AS id FROM documents", "SELECT * FROM links")}
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component AS component_id
FROM documents LEFT JOIN n USING (doc_id) JOIN classes ON id = doc_id
"""

OP12 = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda y: floor(256 * y::DOUBLE)) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
      FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank,
             id AS negative_id, positive_score, score AS negative_score
      FROM p JOIN s USING (anchor_id)
      WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

ORACLE_SQL = {"op1_warc": OP1, "op4_embedding_near_dedup": OP4, "op7_substring_dedup": OP7, "op10_ngram_join": OP10, "op12_hard_negatives": OP12}
