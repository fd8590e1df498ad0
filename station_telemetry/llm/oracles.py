"""The rules of six operators as plain SQL for DuckDB, over whole tables.

The others have models, tokenizers or fingerprints, which SQL can't express, or (200-byte strings of
whole tables) take it minutes: the tests compare them with plain Python.
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

#: CRC-32 of the decimal doc_id, bit by bit.
_CRC = """list_reduce(
        list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
            lambda c: list_transform(range(8), lambda k: CAST((ord(c) >> CAST(k AS INTEGER)) & 1 AS BIGINT))))),
        lambda c, bit: xor(c >> 1, 3988292384 * (xor(c, bit) & 1)))"""


def _part(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_part(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


ORACLES: dict[str, str] = {
    "op3_benchmark_decontamination": f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, {_WORDS}) AS ws FROM benchmark),
doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS ws FROM documents),
item_window AS (
    SELECT DISTINCT item, least(13, len(ws)) AS size, array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') AS k
    FROM item, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS t(i) WHERE len(ws) > 0
),
hit AS (
    SELECT doc_id, i, w.size, item
    FROM (SELECT doc_id, i, s.size, array_to_string(ws[i:i + s.size - 1], ' ') AS k
          FROM doc, (SELECT DISTINCT size FROM item_window) AS s, unnest(range(1, len(ws) - s.size + 2)) AS t(i)) AS w
    JOIN item_window USING (size, k)
),
word AS (
    SELECT doc_id, count(DISTINCT i + j) AS n
    FROM (SELECT DISTINCT doc_id, i, size FROM hit), unnest(range(0, size)) AS t(j) GROUP BY doc_id
),
named AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(word.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(word.n, 0) > 0 AND 20 * coalesce(word.n, 0) >= len(ws) AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op4_warc": """
WITH page AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex,
           max(page_id) OVER (PARTITION BY coalesce(html, '')) AS newest
    FROM pages
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(1 + ((CAST('0x' || substr(hex, CAST(5 * (k // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '')
           AS payload_digest,
       CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM page""",
    "op9_substring_dedup": r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(ws[i:i + 19], ' ') ORDER BY doc_id, i) AS place
    FROM doc, unnest(range(1, len(ws) - 18)) AS t(i)
),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM win, unnest(range(0, 20)) AS t(j) WHERE place > 1),
word AS (SELECT doc_id, p, ws[p] AS w FROM doc, unnest(range(1, len(ws) + 1)) AS t(p)),
kept AS (
    SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS words, count(*) AS n
    FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)""",
    "op11_hard_negative_mining": """
WITH vector AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, x.vec_id, x.label = a.label AS same,
           CAST(list_dot_product(a.q, x.q) AS BIGINT) AS score
    FROM vector AS a JOIN vector AS x ON a.vec_id <> x.vec_id WHERE a.vec_id % 100 = 0
),
positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5""",
    "op12_minhash_near_dedup": f"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
sized AS (
    SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
        range(1, greatest(len(ws) - 3, 1) + 1), lambda i: array_to_string(ws[i:i + 3], ' ')))) END AS shingles
    FROM doc
),
class AS (SELECT shingles, min(doc_id) AS c FROM sized WHERE len(shingles) > 0 GROUP BY shingles),
shingle AS (SELECT c, len(shingles) AS n, unnest(shingles) AS s FROM class),
link AS (
    SELECT a.c AS a, b.c AS b FROM shingle AS a JOIN shingle AS b ON a.s = b.s AND a.c < b.c
    GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
reach AS (
    SELECT c AS a, c AS b FROM class
    UNION
    SELECT reach.a, e.b FROM reach JOIN (SELECT a, b FROM link UNION ALL SELECT b, a FROM link) AS e ON reach.b = e.a
),
root AS (SELECT a AS c, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(sized.shingles) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM sized LEFT JOIN class USING (shingles) LEFT JOIN root USING (c)""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE leaf AS (
    SELECT doc_id, lang, {_leaf("n_chars")} AS h,
           CASE WHEN {_CRC.strip()} IS NOT NULL AND xor({_CRC}, 4294967295) % 7 = 0
                THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS claimed,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n
    FROM documents
),
tree AS (
    SELECT lang, CAST(0 AS BIGINT) AS level, i, h, n FROM leaf
    UNION ALL
    SELECT lang, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2
    FROM tree WHERE n > 1 GROUP BY lang, level, i // 2, n
),
subroot AS (
    SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1
),
top AS (
    SELECT CAST(0 AS BIGINT) AS level, i, h, n FROM subroot
    UNION ALL
    SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2
    FROM top WHERE n > 1 GROUP BY level, i // 2, n
),
inner_fold AS (
    SELECT doc_id, lang, CAST(0 AS BIGINT) AS level, i, n, claimed AS h, '' AS proof FROM leaf
    UNION ALL
    SELECT f.doc_id, f.lang, f.level + 1, f.i // 2, (f.n + 1) // 2,
           sha256(CASE WHEN f.i % 2 = 1 THEN s.h || f.h ELSE f.h || coalesce(s.h, '') END), f.proof || coalesce(s.h, '')
    FROM inner_fold AS f LEFT JOIN tree AS s
         ON f.lang IS NOT DISTINCT FROM s.lang AND f.level = s.level AND s.i = xor(f.i, 1)
    WHERE f.n > 1
),
outer_fold AS (
    SELECT f.doc_id, f.lang, CAST(0 AS BIGINT) AS level, subroot.i, subroot.n, f.h, f.proof
    FROM inner_fold AS f JOIN subroot ON f.lang IS NOT DISTINCT FROM subroot.lang WHERE f.n = 1
    UNION ALL
    SELECT f.doc_id, f.lang, f.level + 1, f.i // 2, (f.n + 1) // 2,
           sha256(CASE WHEN f.i % 2 = 1 THEN s.h || f.h ELSE f.h || coalesce(s.h, '') END), f.proof || coalesce(s.h, '')
    FROM outer_fold AS f LEFT JOIN top AS s ON f.level = s.level AND s.i = xor(f.i, 1)
    WHERE f.n > 1
)
SELECT leaf.doc_id, leaf.h AS leaf, subroot.h AS subroot, top.h AS root, sha256(f.proof) AS proof_sha256,
       f.h AS folded_root, f.h = top.h AS verified
FROM leaf JOIN outer_fold AS f ON f.n = 1 AND leaf.doc_id = f.doc_id JOIN top ON top.n = 1
     JOIN subroot ON leaf.lang IS NOT DISTINCT FROM subroot.lang""",
}
