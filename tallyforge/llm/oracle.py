"""SQL for DuckDB that gives the same rows as the queries, where SQL can express them."""

from __future__ import annotations

EXACT_DEDUP = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


LM_SCORING = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') AS words
    FROM documents
), tokens AS (
    SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM docs
), grams AS (
    SELECT r, w, lag(w) OVER line AS p, lag(w, 2) OVER line AS q
    FROM tokens
    WINDOW line AS (PARTITION BY r ORDER BY i)
), ones AS (
    SELECT w, count(*) AS n FROM tokens GROUP BY w
), twos AS (
    SELECT p, w, count(*) AS n FROM grams WHERE p IS NOT NULL GROUP BY p, w
), threes AS (
    SELECT q, p, w, count(*) AS n FROM grams WHERE q IS NOT NULL GROUP BY q, p, w
), scored AS (
    SELECT g.r,
           CASE WHEN three.n >= 2 THEN ln(three.n / wide.n)
                WHEN two.n >= 2 THEN ln(two.n / context.n)
                ELSE ln(one.n / total.n) END
           + ln(0.4) * (CASE WHEN three.n < 2 THEN 1 ELSE 0 END)
           + ln(0.4) * (CASE WHEN coalesce(three.n, 1) < 2 AND two.n < 2 THEN 1 ELSE 0 END) AS score,
           CASE WHEN three.n < 2 THEN 1 ELSE 0 END
           + CASE WHEN coalesce(three.n, 1) < 2 AND two.n < 2 THEN 1 ELSE 0 END AS backs
    FROM grams g
    JOIN ones one ON one.w = g.w
    LEFT JOIN ones context ON context.w = g.p
    LEFT JOIN twos two ON two.p = g.p AND two.w = g.w
    LEFT JOIN twos wide ON wide.p = g.q AND wide.w = g.p
    LEFT JOIN threes three ON three.q = g.q AND three.p = g.p AND three.w = g.w
    CROSS JOIN (SELECT count(*) AS n FROM tokens) total
)
SELECT doc_id,
       count(score) AS n_tokens,
       coalesce(sum(backs), 0)::BIGINT AS n_backoffs,
       round(coalesce(sum(score), 0.0), 6) AS log_score,
       round(avg(score), 6) AS mean_log_score
FROM docs LEFT JOIN scored USING (r)
GROUP BY r, doc_id
"""

NEAR_VECTORS = """
WITH RECURSIVE usable AS (
    SELECT vec_id, embedding::DOUBLE[] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
      AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reached AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), parts AS (
    SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a
), counts AS (
    SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN parts USING (vec_id) LEFT JOIN counts USING (vec_id)
"""

CHAT = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
    SELECT *,
           replace(replace(replace(replace(replace(role, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'),
                   '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS safe_role,
           replace(replace(replace(replace(replace(text, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'),
                   '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS safe_text
    FROM said
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
              FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length('<s>[INST] ') + length(safe_role) + length(' [/INST]') + length(safe_text)
           + length('</s>'))::BIGINT AS formatted_chars
FROM sized
GROUP BY conv_id
"""

WARC = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), typed AS (
    SELECT *, max(page_id) OVER (PARTITION BY html) AS keep FROM payloads
)
SELECT page_id,
       payload_bytes,
       sha1(html) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep THEN keep END AS refers_to
FROM typed
"""

RANKED_SEARCH = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), asked AS (
    SELECT item, item_id, term, count(*) AS times
    FROM (
        SELECT row_number() OVER () AS item, item_id,
               unnest(regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    )
    GROUP BY ALL
), corpus AS (
    SELECT count(*)::BIGINT AS n, sum(len(terms))::BIGINT AS l FROM docs WHERE len(terms) > 0
), postings AS (
    SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
    FROM (SELECT r, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM asked)
    GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * corpus.n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM postings, corpus
    GROUP BY term, corpus.n
), scored AS (
    SELECT item, item_id, r, doc_id,
           sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * p.n * corpus.n) // corpus.l))))::BIGINT AS score
    FROM asked JOIN postings p USING (term) JOIN weights USING (term), corpus
    GROUP BY item, item_id, r, doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
    FROM scored
    WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

FILTER_AUDIT = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), low AS (
    SELECT text, min(doc_id) AS low FROM docs GROUP BY text
), words AS (
    SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs
), marks AS (
    SELECT docs.doc_id, docs.part,
           len(words) < 200 AS a,
           100 * len(list_distinct(words)) < 50 * len(words) AS b,
           100 * length(regexp_replace(docs.text, '[^A-Z]', '', 'g')) > 2 * length(docs.text) AS c,
           regexp_matches(docs.text, '[#$%&*|]') AS d,
           coalesce(docs.doc_id > low.low, false) AS e
    FROM docs JOIN words USING (r) JOIN low ON low.text = docs.text
), known AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), cells AS (
    SELECT part, a::INT * 1 + b::INT * 2 + c::INT * 4 + d::INT * 8 + e::INT * 16 AS mask, count(*) AS n,
           sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
    FROM marks LEFT JOIN known USING (doc_id)
    GROUP BY ALL
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter
), orders AS (
    SELECT v.letter || w.letter || x.letter || y.letter || z.letter AS filter_order
    FROM letters v, letters w, letters x, letters y, letters z
    WHERE len(list_distinct([v.letter, w.letter, x.letter, y.letter, z.letter])) = 5
), steps AS (
    SELECT filter_order, step::INT AS step, 1 << (ascii(filter_order[step]) - 65) AS bit,
           coalesce(list_sum([1 << (ascii(l) - 65) FOR l IN string_split(filter_order[1:step - 1], '') IF l <> '']), 0)::INT AS before
    FROM orders, unnest([1, 2, 3, 4, 5]) AS s(step)
)
SELECT part, filter_order, step,
       sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
       sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
       sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
       sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
       sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
       sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
       sum(CASE WHEN mask & bit <> 0 THEN n * (120 // bit_count(mask)) ELSE 0 END)::BIGINT AS shapley
FROM cells, steps
GROUP BY part, filter_order, step
"""


def all_oracles() -> dict[str, str]:
    return {
        "op1_lm_scoring": LM_SCORING,
        "op3_embedding_near_dedup": NEAR_VECTORS,
        "op4_exact_dedup": EXACT_DEDUP,
        "op7_chat_formatting": CHAT,
        "op10_warc": WARC,
        "op11_ranked_search": RANKED_SEARCH,
        "op12_filter_audit": FILTER_AUDIT,
    }
