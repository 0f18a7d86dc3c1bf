"""DuckDB SQL for the queries that SQL can express."""

from .license_scan import TEMPLATES

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(column: str) -> str:
    lower = f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lower}, '{_WORD}')"


def _license_sql() -> str:
    """Sums over all windows in place of the filters; templates as values."""
    rows = ", ".join(
        f"({n}, '{t.label}', '{t.text.replace(chr(39), chr(39) * 2)}', {t.percent}, {str(t.ordered).lower()})" for n, t in enumerate(TEMPLATES)
    )
    return f"""
WITH templates AS (
    SELECT t, label, {_words("body")} AS tw, percent, ordered FROM (VALUES {rows}) AS v(t, label, body, percent, ordered)
), needs AS (
    SELECT *, len(tw) AS size, greatest((len(tw) * percent + 99) // 100, 1) AS need FROM templates
), bags AS (
    SELECT t, word, count(*) AS m FROM (SELECT t, unnest(tw) AS word FROM templates) GROUP BY t, word
), docs AS (
    SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents
), words AS (
    SELECT r, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS p FROM docs
), held AS (
    SELECT r, any_value(n) AS n, p, t, 1 AS own FROM words JOIN bags USING (word) GROUP BY r, p, t
), enough AS (
    SELECT h.r, h.n, k.t, k.size, k.need FROM (SELECT r, t, any_value(n) AS n, count(*) AS c FROM held GROUP BY r, t) h
    JOIN needs k USING (t) WHERE h.c >= k.need
), starts AS (
    SELECT e.*, least(e.size, e.n) AS width, s FROM enough e, LATERAL (SELECT unnest(range(greatest(e.n - e.size, 0) + 1)) AS s)
), blocks AS (
    SELECT b.r, b.t, b.s, b.size, b.need, b.width FROM starts b JOIN held h ON h.r = b.r AND h.t = b.t AND h.p >= b.s AND h.p < b.s + b.width
    GROUP BY b.r, b.t, b.s, b.size, b.need, b.width HAVING count(*) >= b.need
), overlap_sums AS (
    SELECT r, t, s, size, need, width, sum(least(c, m)) AS overlap FROM (
        SELECT b.r, b.t, b.s, b.size, b.need, b.width, g.word, g.m, count(*) AS c
        FROM blocks b JOIN words w ON w.r = b.r AND w.p >= b.s AND w.p < b.s + b.width JOIN bags g ON g.t = b.t AND g.word = w.word
        GROUP BY ALL
    ) GROUP BY ALL HAVING sum(least(c, m)) >= need
), found AS (
    SELECT o.r, o.s, k.label, k.ordered, o.overlap / o.size AS containment
    FROM overlap_sums o JOIN needs k USING (t) JOIN docs d ON d.r = o.r
    WHERE NOT k.ordered OR list_slice(d.w, o.s + 1, o.s + o.width) = k.tw
), summed AS (
    SELECT r, count(*) FILTER (ordered) AS n_base, min(s) FILTER (ordered) AS first_word, max(s) FILTER (ordered) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (ordered) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(containment) AS score
    FROM found GROUP BY r
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(x.n_base, 0)::BIGINT AS n_base, x.first_word::BIGINT AS first_word,
    x.last_word::BIGINT AS last_word, coalesce(x.base_labels, '') AS base_labels, coalesce(x.labels, '') AS labels,
    coalesce(x.score, 0.0)::DOUBLE AS score
FROM docs d LEFT JOIN summed x USING (r)
"""


_SEARCH_SQL = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents
), corpus AS (
    SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM docs
), counts AS (
    SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM docs) GROUP BY ALL
), item_terms AS (
    SELECT DISTINCT item_id, unnest({_words("text")}) AS term FROM benchmark
), weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
    FROM counts, corpus WHERE term IN (SELECT term FROM item_terms) GROUP BY term, n_docs
), scores AS (
    SELECT i.item_id, c.r, any_value(c.doc_id) AS doc_id,
        sum(x.weight * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (100 - 90 + (90 * c.n * p.n_docs) // p.n_terms))))::BIGINT AS score
    FROM item_terms i JOIN counts c USING (term) JOIN weights x USING (term), corpus p GROUP BY i.item_id, c.r
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# A plain automaton over (start, after s, after u, after a pair), row by row.
_REPAIR_SQL = r"""
WITH RECURSIVE crc_table AS (
    SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
), keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS letters FROM conversations
), hashed AS (
    SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(letters, lambda x: ascii(x)::BIGINT)),
        lambda acc, x: xor(t[(xor(acc, x) & 255) + 1], acc >> 8))) % 20 AS kind
    FROM keyed, crc_table
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM (SELECT *, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) FROM hashed WHERE kind <> 0)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
        sha256(coalesce('+' || conv_id::VARCHAR, '-') || ':' || length(role) || ':' || role || text)) AS i FROM damaged
), seen AS (
    SELECT *, substr(role, 1, 1) AS initial, rtrim(text, E' 	

') AS stripped,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM placed
), faults AS (
    SELECT *, CASE WHEN stripped = '' THEN 'blank' WHEN again THEN 'duplicate'
        WHEN right(stripped, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), false) AS bad_pair
    FROM seen
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (bad_pair) AS illegal, count(*) AS n
    FROM faults GROUP BY conv_id
), inserts(a, b, cost, edits) AS (
    VALUES (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 1, 0, ''), (1, 2, 3, 'I'), (1, 3, 6, 'II'), (2, 2, 0, ''), (2, 3, 3, 'I'), (3, 3, 0, ''), (3, 2, 3, 'I')
), edits(a, b, initial, cost, edit) AS (
    VALUES (0, 0, '', 4, 'D'), (1, 1, '', 4, 'D'), (2, 2, '', 4, 'D'), (3, 3, '', 4, 'D'),
        (0, 1, 's', 0, 'K'), (0, 2, 'u', 0, 'K'), (1, 2, 'u', 0, 'K'), (3, 2, 'u', 0, 'K'), (2, 3, 'a', 0, 'K'),
        (0, 2, '*', 3, 'R'), (1, 2, '*', 3, 'R'), (3, 2, '*', 3, 'R'), (2, 3, '*', 3, 'R')
), moves AS (
    SELECT i.a, e.b, e.initial, i.cost + e.cost AS cost, i.edits || e.edit AS edits FROM inserts i JOIN edits e ON e.a = i.b
), parse AS (
    SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit FROM counted
    UNION ALL
    SELECT conv_id, i, b, best.cost, best.audit FROM (
        SELECT p.conv_id, f.i, m.b, min({'cost': p.cost + m.cost + CASE WHEN f.fault = 'truncated' AND m.initial <> '' THEN 3 ELSE 0 END,
            'audit': p.audit || m.edits}) AS best
        FROM parse p JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
        JOIN moves m ON m.a = p.state AND (m.initial = '' OR (f.fault NOT IN ('blank', 'duplicate') AND m.initial IN ('*', f.initial)))
        GROUP BY p.conv_id, f.i, m.b
    )
), audits AS (
    SELECT p.conv_id, min({'cost': p.cost + i.cost, 'audit': p.audit || i.edits}) AS best
    FROM parse p JOIN counted c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.i JOIN inserts i ON i.a = p.state AND i.b IN (0, 3)
    GROUP BY p.conv_id
), letters AS (
    SELECT conv_id, k, best.audit[k] AS edit, k - length(replace(substr(best.audit, 1, k), 'I', '')) AS inserted
    FROM audits, LATERAL (SELECT unnest(range(1, length(best.audit) + 1)) AS k)
), lines AS (
    SELECT l.conv_id, l.k, l.edit, f.role, f.text, f.initial = 's' AND l.edit = 'K' AS is_system,
        row_number() OVER (PARTITION BY l.conv_id ORDER BY l.k) - count(*) FILTER (f.initial = 's' AND l.edit = 'K') OVER (PARTITION BY l.conv_id ORDER BY l.k) AS nth
    FROM letters l LEFT JOIN faults f ON l.edit <> 'I' AND f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.k - l.inserted
    WHERE l.edit <> 'D'
), repaired AS (
    SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role ELSE CASE WHEN nth % 2 = 1 THEN 'user' ELSE 'assistant' END END
        || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS body
    FROM lines GROUP BY conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
    coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(a.best.cost, 0)::BIGINT AS cost,
    coalesce(a.best.audit, '') AS audit, sha256(coalesce(r.body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""

ORACLE_SQL: dict[str, str] = {
    "op1_poisson_mixing": """
WITH sizes AS (
    SELECT source, sum(length(coalesce(text, '')))::BIGINT AS chars FROM documents GROUP BY source
), weighted AS (
    SELECT source, chars, sqrt(chars::DOUBLE) AS weight FROM sizes
), total AS (
    SELECT sum(chars)::DOUBLE AS chars, sum(weight ORDER BY source) AS weight FROM weighted
), rates AS (
    SELECT w.source, CASE WHEN w.chars = 0 THEN 1.0 ELSE w.weight / t.weight * t.chars / w.chars END AS rate
    FROM weighted w, total t
), split AS (
    SELECT source, greatest(ceil(rate / 16)::INT, 1) AS parts, rate / greatest(ceil(rate / 16)::INT, 1) AS mean FROM rates
), terms AS (
    SELECT source, parts, k, sum(exp(-mean + CASE WHEN k = 0 THEN 0 ELSE k * ln(mean) END - lgamma(k + 1.0)))
        OVER (PARTITION BY source ORDER BY k) AS c
    FROM split, LATERAL (SELECT unnest(range(ceil(mean + 12 * sqrt(mean) + 16)::INT + 1)) AS k)
), numbered AS (
    SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) || ':0' AS name, row_number() OVER () AS r FROM documents
), draws AS (
    SELECT d.r, d.source, j, ('0x' || substr(md5(d.name || ':17:' || j), 1, 13))::BIGINT / 4503599627370496.0 AS u
    FROM (SELECT d.*, parts FROM numbered d JOIN split s ON d.source IS NOT DISTINCT FROM s.source) d,
        LATERAL (SELECT unnest(range(1, parts + 1)) AS j)
), counts AS (
    SELECT d.r, count(t.k)::INT AS n_copies
    FROM draws d LEFT JOIN terms t ON d.source IS NOT DISTINCT FROM t.source AND t.c <= d.u
    GROUP BY d.r
)
SELECT d.doc_id, d.text, d.source, c.n_copies, copy_no::INT AS copy_no, md5('order:' || d.name || ':17:' || copy_no) AS shuffle_key
FROM counts c JOIN numbered d USING (r), LATERAL (SELECT unnest(range(1, c.n_copies + 1)) AS copy_no)
""",
    "op7_decontaminate": r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), sized AS (
    SELECT item_id, w, least(10, len(w)) AS size FROM item_words WHERE len(w) > 0
), windows AS (
    SELECT DISTINCT item_id, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS gram
    FROM sized, LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i)
), sizes AS (SELECT DISTINCT size FROM windows),
hits AS (
    SELECT d.doc_id, p.i, d.size, x.item_id
    FROM (SELECT doc_id, w, size FROM doc_words, sizes WHERE len(w) >= size) d,
        LATERAL (SELECT unnest(range(1, len(d.w) - d.size + 2)) AS i) p
    JOIN windows x ON x.size = d.size AND x.gram = array_to_string(list_slice(d.w, p.i, p.i + d.size - 1), ' ')
), hit_words AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit
    FROM hits, LATERAL (SELECT unnest(range(i, i + size)) AS j) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
    coalesce(i.n_items, 0)::BIGINT AS n_items, sha256(coalesce(i.items, '')) AS items_sha256,
    coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items i USING (doc_id)
""",
    "op10_exact_dedup": """
WITH docs AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
    FROM documents
), classes AS (
    SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM docs GROUP BY norm
)
SELECT d.doc_id, c.keep_id, c.group_size, d.doc_id IS NOT DISTINCT FROM c.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM docs d JOIN classes c USING (norm)
""",
    "op11_conversation_repair": _REPAIR_SQL,
    "op12_license_scan": _license_sql(),
    "op13_ranked_search": _SEARCH_SQL,
}
