"""DuckDB SQL of the operators' queries, where SQL can express them over whole tables."""

from __future__ import annotations


OP1 = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), turns AS (
    SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after,
        length(regexp_replace(text, '([\[<])(\\*(?:SYS\]|/SYS\]|INST\]|/INST\]|ANS\]|/s>|ROLE\]|IS\]))', '\1\\\2', 'g')) AS chars,
        CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 9 ELSE 14 + length(role) END AS marks
    FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars + marks) AS BIGINT) AS formatted_chars,
    bool_and(coalesce(before, 'start') || '>' || role
             IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user'))
        AND bool_or(after IS NULL AND role = 'assistant') AS valid
FROM turns GROUP BY conv_id
"""

OP9 = """
WITH payloads AS (
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), keepers AS (
    SELECT payload_digest, max(page_id) AS keeper FROM payloads WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, p.payload_digest AS payload_digest,
    CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM payloads p LEFT JOIN keepers k ON p.payload_digest = k.payload_digest
"""

OP3 = r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), gram AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
        SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)
), hit AS (
    SELECT DISTINCT doc_id, i, d.n, item_id FROM (
        SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
            SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM gram) WHERE len(w) >= n)) d
    JOIN gram USING (n, g)
), words AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hit) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP5 = r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM doc WHERE len(w) >= 50)
), low AS (
    SELECT g, min(doc_id) AS first_id FROM win GROUP BY g
), gone AS (
    SELECT doc_id, list(DISTINCT place) AS places FROM (
        SELECT doc_id, unnest(range(i, i + 50)) AS place FROM win JOIN low USING (g) WHERE first_id < doc_id) GROUP BY doc_id
), word AS (
    SELECT doc_id, generate_subscripts(w, 1) AS place, unnest(w) AS word FROM doc
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text FROM word
    ANTI JOIN (SELECT doc_id, unnest(places) AS place FROM gone) USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM doc LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP10 = r"""
WITH RECURSIVE doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, g FROM (
        SELECT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g FROM (
            SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM doc WHERE len(w) > 0))
), size AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), pair AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), link AS (
    SELECT a, b FROM pair p JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * p.n >= 75 * (x.n + y.n - p.n)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM doc UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), component AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM component LEFT JOIN size USING (doc_id)
"""

OP11 = r"""
WITH RECURSIVE bits AS (
    SELECT i, 0 AS k, i::UBIGINT AS c FROM range(256) t(i)
    UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END FROM bits WHERE k < 8
), steps AS (
    SELECT list(c ORDER BY i) AS step FROM bits WHERE k = 8
), run AS (
    SELECT doc_id, r, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS r
        FROM documents) GROUP BY doc_id, r
), hashed AS (
    SELECT r, n, xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(doc_id::VARCHAR || ':' || r, ''),
            lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::UBIGINT] ELSE [195::UBIGINT, (unicode(c) - 64)::UBIGINT] END))),
        lambda h, b: xor(h // 256, step[(xor(h % 256, b) + 1)::BIGINT])), 4294967295::UBIGINT) AS h FROM run, steps
), word AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT n, CASE WHEN h % 199 = 0 THEN r[:(h % length(r))::BIGINT] || r[(h % length(r))::BIGINT + 2:] ELSE r END AS word FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), shorter AS (
    SELECT word, n, i, word[:i - 1] || word[i + 1:] AS s FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)
), near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.s = b.s AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM shorter a JOIN word b ON a.s = b.word
    UNION SELECT b.word, a.word, a.n FROM shorter a JOIN word b ON a.s = b.word
), best AS (
    SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word
), form AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * n THEN other END AS form, CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
    FROM word LEFT JOIN best USING (word)
), way AS (
    SELECT word, word AS here, 0 AS steps FROM form
    UNION ALL SELECT way.word, form.form, steps + 1 FROM way JOIN form ON form.word = way.here WHERE form.form IS NOT NULL
), root AS (
    SELECT word, arg_max(here, steps) AS root FROM way GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM form JOIN root USING (word)
"""

OP12 = r"""
WITH doc AS (
    SELECT doc_id, len(t) AS n, t FROM (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS t FROM documents) WHERE len(t) > 0
), total AS (
    SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM doc
), item AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark
), posting AS (
    SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM doc) WHERE term IN (SELECT term FROM item) GROUP BY ALL
), weight AS (
    SELECT term, floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM posting, total GROUP BY term, nn
), scored AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * nn) // ll)))))::BIGINT AS score
    FROM item JOIN posting USING (term) JOIN weight USING (term), total GROUP BY item_id, doc_id
)
SELECT item_id, rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0) WHERE rank <= 10
"""

OP13 = r"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pair AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pair) WHERE rank <= 5
"""


def sql() -> dict[str, str]:
    return {
        "op1_chat": OP1, "op3_decontaminate": OP3, "op5_substring_dedup": OP5, "op9_warc": OP9, "op10_near_dedup": OP10,
        "op11_variants": OP11, "op12_ranked": OP12, "op13_topk": OP13,
    }
