"""The queries of this subpackage as DuckDB SQL, where SQL can express them."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Linked pairs of documents with their components, by walking the links.
_NEAR = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words
), sized AS (
  SELECT doc_id, len(s) AS n FROM sets
), items AS (
  SELECT doc_id, unnest(s) AS x FROM sets
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sized p ON p.doc_id = a JOIN sized q ON q.doc_id = b
  WHERE 100 * shared.n >= 80 * (p.n + q.n - shared.n)
), ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reached.a, ways.b FROM reached JOIN ways ON ways.a = reached.b
), found AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT doc_id, n::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sized JOIN found USING (doc_id)
"""

#: A vector that is zero or holds a null or non-finite component has no length.
_VECTORS = """
WITH RECURSIVE sized AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
), usable AS (
  SELECT * FROM sized WHERE label IS NOT NULL AND len(v) > 0
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_max(list_transform(v, lambda x: abs(x))) > 0
), links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM usable p JOIN usable q
  ON p.label = q.label AND p.vec_id < q.vec_id AND len(p.v) = len(q.v)
  WHERE list_cosine_similarity(p.v, q.v) >= 0.93
), ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reached.a, ways.b FROM reached JOIN ways ON ways.a = reached.b
), found AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a
), counted AS (
  SELECT a AS vec_id, count(*) AS n FROM ways GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM found LEFT JOIN counted USING (vec_id)
"""

_EXACT = f"""
WITH keyed AS (SELECT doc_id, {_LOWER} AS t FROM documents),
groups AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM keyed GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM keyed JOIN groups USING (t)
"""

#: The last reply against the one before; turns written as in the operator.
_CHAT = """
WITH given AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM given
), replies AS (
  SELECT conv_id, max(k) AS last FROM numbered WHERE role = 'assistant' GROUP BY conv_id
), stale AS (
  SELECT conv_id, string_agg('<|' || replace(role, '<|', '<||') || '|>' || chr(10) || replace(text, '<|', '<||') || '<|end|>' || chr(10), ''
    ORDER BY k) AS after
  FROM numbered JOIN replies USING (conv_id) WHERE k > last GROUP BY conv_id
), sides AS (
  SELECT n.*, n.k = r.last AS reply FROM numbered n LEFT JOIN replies r USING (conv_id)
  WHERE r.last IS NULL OR n.k <= r.last
), earlier AS (
  SELECT n.conv_id, max_by(n.text, n.k) AS text FROM numbered n JOIN replies r USING (conv_id)
  WHERE n.role = 'assistant' AND n.k < r.last GROUP BY n.conv_id
), paired AS (
  SELECT s.conv_id, s.k, s.role, s.text AS c, CASE WHEN s.reply THEN coalesce(e.text, '') ELSE s.text END AS r
  FROM sides s LEFT JOIN earlier e USING (conv_id)
), turns AS (
  SELECT conv_id, k, role, replace(c, '<|', '<||') AS c, replace(r, '<|', '<||') AS r,
    '<|' || replace(role, '<|', '<||') || '|>' || chr(10) AS head,
    sum(CASE WHEN paired.c <> paired.r THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY k) > 0 AS apart
  FROM paired
), sized AS (
  SELECT *, coalesce(sum(length(head) + length(c) + 8) FILTER (apart) OVER w, 0) AS c_at,
    coalesce(sum(length(head) + length(r) + 8) FILTER (apart) OVER w, 0) AS r_at
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT conv_id, count(*)::INTEGER AS n_turns, count(*) FILTER (NOT apart)::INTEGER AS n_common,
  coalesce(string_agg(head || c || '<|end|>' || chr(10), '' ORDER BY k) FILTER (NOT apart), '') AS prompt,
  coalesce(string_agg(head || c || '<|end|>' || chr(10), '' ORDER BY k) FILTER (apart), '') AS chosen,
  coalesce(string_agg((c_at + length(head))::BIGINT || ':' || (c_at + length(head) + length(c) + 7)::BIGINT, ',' ORDER BY k)
    FILTER (apart AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(head || r || '<|end|>' || chr(10), '' ORDER BY k) FILTER (apart), '') AS rejected,
  coalesce(string_agg((r_at + length(head))::BIGINT || ':' || (r_at + length(head) + length(r) + 7)::BIGINT, ',' ORDER BY k)
    FILTER (apart AND role = 'assistant'), '') AS rejected_mask,
  coalesce(any_value(stale.after), '') AS after
FROM sized LEFT JOIN stale USING (conv_id) GROUP BY conv_id
"""

_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: Windows of all sizes that items have, joined on their words.
_CONTAMINATED = f"""
WITH docs AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), items AS (
  SELECT item_id, {_WORDS} AS w FROM benchmark
), wanted AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
    unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS words
  FROM items WHERE len(w) > 0
), placed AS (
  SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS pos
  FROM docs CROSS JOIN (SELECT DISTINCT size FROM wanted) WHERE len(w) >= size
), hits AS (
  SELECT doc_id, pos, p.size, item_id FROM placed p JOIN wanted q
  ON p.size = q.size AND array_to_string(w[pos:pos + p.size - 1], ' ') = q.words
), covered AS (
  SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS k FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered c USING (doc_id) LEFT JOIN named i USING (doc_id)
"""

#: Every phrase of one to four words counted plainly.
_PHRASES = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\\n\\x0B\\f\\r]')) AS piece FROM documents
), cut AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces
), placed AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS pos FROM cut
), grams AS (
  SELECT lang, m, array_to_string(w[pos:pos + m - 1], ' ') AS phrase
  FROM placed CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS m) WHERE pos + m - 1 <= len(w)
), counted AS (
  SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM cut GROUP BY lang
), candidates AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE m > 1
), cuts AS (
  SELECT *, unnest(range(1, m)) AS k FROM candidates
), scored AS (
  SELECT c.lang, c.phrase, c.m, c.a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:c.m], ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_ AS (
  SELECT lang, a AS f, unnest(flatten(list_transform(range(2, m), lambda s: list_transform(range(1, m - s + 2), lambda i: array_to_string(w[i:i + s - 1], ' '))))) AS phrase
  FROM candidates WHERE m > 2
), inside AS (
  SELECT lang, phrase, max(f) AS f FROM inner_ GROUP BY lang, phrase
), standing AS (
  SELECT s.* FROM lowest s LEFT JOIN inside i USING (lang, phrase) WHERE i.f IS NULL OR 100::HUGEINT * i.f < 80::HUGEINT * s.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM standing
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

STATEMENTS = {
    "op1_minhash_near_dedup": _NEAR,
    "op2_lattice_near_dedup": _VECTORS,
    "op7_preference_format": _CHAT,
    "op6_grace_exact_dedup": _EXACT,
    "op11_winnow_contamination": _CONTAMINATED,
    "op12_phrase_collocations": _PHRASES,
}
