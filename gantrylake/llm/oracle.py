"""SQL of the queries that SQL can express, over whole tables."""

from __future__ import annotations

SQL: dict[str, str] = {}

_WORDS = r"""coalesce(regexp_extract_all(
    translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"""

SQL["op5_contamination"] = f"""
WITH item_words AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS.format("text")} AS w FROM benchmark),
sized AS (SELECT item, w, least(10, len(w)) AS size FROM item_words WHERE len(w) > 0),
item_windows AS (
    SELECT DISTINCT item, size, array_to_string(w[i : i + size - 1], ' ') AS content
    FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM sized)
),
sizes AS (SELECT DISTINCT size FROM item_windows),
docs AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS.format("text")} AS w FROM documents),
doc_windows AS (
    SELECT row, size, i, array_to_string(w[i : i + size - 1], ' ') AS content
    FROM (SELECT row, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size)
),
matches AS (SELECT row, size, i, item FROM doc_windows JOIN item_windows USING (size, content)),
hit AS (SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(i, i + size)) AS place FROM matches) GROUP BY row),
found AS (SELECT row, list_sort(list(DISTINCT item)) AS items FROM matches GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (row) LEFT JOIN found USING (row)
"""

SQL["op11_filter_audit"] = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
graded AS (
    SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
marked AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
           CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
           + CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY body) THEN 16 ELSE 0 END AS mask
    FROM texts LEFT JOIN graded USING (doc_id)
),
cells AS (SELECT part, good, toxic, mask, count(*) AS n FROM marked GROUP BY ALL),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)),
orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
),
steps AS (
    SELECT filter_order, step::INTEGER AS step, own.letter AS letter, own.bit AS bit,
           (SELECT coalesce(sum(l.bit), 0)::INTEGER FROM letters l WHERE contains(substr(filter_order, 1, step - 1), l.letter)) AS earlier
    FROM orders, range(1, 6) AS r(step), letters own
    WHERE own.letter = substr(filter_order, step, 1)
),
figures AS (
    SELECT part, filter_order, step, letter,
           coalesce(sum(n) FILTER (mask & (earlier | bit) = 0), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & bit > 0), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (mask & earlier > 0 AND mask & bit > 0), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
           coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & bit > 0 AND good), 0)::BIGINT AS good_lost,
           coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & bit > 0 AND toxic), 0)::BIGINT AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM figures
"""


def _framed(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_framed(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: The checksum of the decimal id, bit by bit.
_EVEN = """list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT)),
    lambda crc, code: list_reduce(
        list_concat([xor(crc, code)], range(0, 8)),
        lambda bits, turn: xor(bits >> 1, CASE WHEN bits & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))
) & 1 = 1"""

SQL["op12_manifest"] = f"""
WITH RECURSIVE leaves AS (
    SELECT row_number() OVER () AS row, doc_id, source, {_leaf("text")} AS leaf, {_leaf("changed")} AS tampered
    FROM (SELECT *, CASE WHEN {_EVEN} THEN replace(text, chr(10), '') ELSE text END AS changed FROM documents)
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS place,
           count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
    FROM leaves
),
inner_nodes AS (
    SELECT tree, 0 AS level, place, n, leaf AS digest FROM placed
    UNION ALL
    SELECT tree, level + 1, place // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY place))
    FROM inner_nodes WHERE n > 1 GROUP BY tree, level, place // 3
),
subroots AS (SELECT tree, digest AS subroot FROM inner_nodes WHERE n = 1),
top_nodes AS (
    SELECT -1 AS tree, 0 AS level, tree AS place, count(*) OVER () AS n, subroot AS digest FROM subroots
    UNION ALL
    SELECT tree, level + 1, place // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY place))
    FROM top_nodes WHERE n > 1 GROUP BY tree, level, place // 3
),
runs AS (
    SELECT tree, level, place // 3 AS parent, any_value(n) AS n, list(digest ORDER BY place) AS children
    FROM (SELECT * FROM inner_nodes UNION ALL SELECT * FROM top_nodes) WHERE n > 1 GROUP BY tree, level, place // 3
),
climb AS (
    SELECT row, tree AS home, tree, 0 AS level, place, n, tampered AS folded, '' AS proof, 0 AS step FROM placed
    UNION ALL
    SELECT c.row, c.home,
           CASE WHEN c.n = 1 THEN -1 ELSE c.tree END,
           CASE WHEN c.n = 1 THEN 0 ELSE c.level + 1 END,
           CASE WHEN c.n = 1 THEN c.tree ELSE c.place // 3 END,
           CASE WHEN c.n = 1 THEN (SELECT count(*) FROM subroots) ELSE (c.n + 2) // 3 END,
           CASE WHEN c.n = 1 THEN c.folded ELSE sha256(
               array_to_string(r.children[: (c.place % 3)::INT], '') || c.folded || array_to_string(r.children[(c.place % 3)::INT + 2 :], '')) END,
           c.proof || CASE WHEN c.n = 1 THEN '' ELSE
               array_to_string(r.children[: (c.place % 3)::INT], '') || array_to_string(r.children[(c.place % 3)::INT + 2 :], '') END,
           c.step + 1
    FROM climb c LEFT JOIN runs r ON r.tree = c.tree AND r.level = c.level AND r.parent = c.place // 3
    WHERE c.n > 1 OR c.tree >= 0
),
ended AS (SELECT row, folded, proof FROM climb WHERE n = 1 AND tree = -1),
root AS (SELECT digest AS root FROM top_nodes WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM placed JOIN ended USING (row) JOIN subroots USING (tree), root
"""
