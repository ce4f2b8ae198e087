"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

#: Runs of anything but white space; runs of letters, digits and non-ASCII characters.
SPACED, PLAIN = r"[^\x20\x09-\x0D]+", r"[0-9a-z\x{80}-\x{10FFFF}]+"


def lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def shingles(source: str, key: str, n: int, pattern: str) -> str:
    """Distinct shingles (key, k) of the lower-cased texts; of fewer words the whole sequence, without words none."""
    return f"""SELECT DISTINCT {key}, md5(array_to_string(w[i : i + least({n}, len(w)) - 1], ' ')) AS k FROM (
    SELECT {key}, w, unnest(range(1, greatest(len(w) - {n} + 1, 1) + 1)) AS i
    FROM (SELECT {key}, regexp_extract_all({lower("coalesce(text, '')")}, '{pattern}') AS w FROM {source}) WHERE len(w) > 0)"""


SUBSTRING_DEDUP = f"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{SPACED}') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 19], ' ')) AS k FROM starts),
repeats AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM repeats, range(20) AS r(j)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

DECONTAMINATION = f"""WITH
counted AS (SELECT item_id, len(regexp_extract_all({lower("coalesce(text, '')")}, '{PLAIN}')) AS n FROM benchmark),
items AS ({shingles('benchmark', 'item_id', 5, PLAIN)}),
long_items AS (SELECT * FROM items WHERE item_id IN (SELECT item_id FROM counted WHERE n >= 5)),
doc_shingles AS ({shingles('documents', 'doc_id', 5, PLAIN)}),
sizes AS (SELECT item_id, count(*) AS n_item FROM long_items GROUP BY item_id),
both_hold AS (SELECT doc_id, item_id, count(*) AS n_shared FROM doc_shingles JOIN long_items USING (k) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_item, n_shared / CAST(n_item AS DOUBLE) AS containment
FROM both_hold JOIN sizes USING (item_id) WHERE 10 * n_shared >= 8 * n_item"""

NEAR_DUPLICATES = f"""WITH RECURSIVE s AS ({shingles('documents', 'doc_id', 4, SPACED)}),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS both_hold FROM s AS a JOIN s AS b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM pairs JOIN sizes AS a ON a.doc_id = u JOIN sizes AS b ON b.doc_id = v
  WHERE 100 * both_hold >= 80 * (a.n + b.n - both_hold)),
reached(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.v FROM reached AS r JOIN links AS l ON l.u = r.other),
components AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept FROM components LEFT JOIN sizes USING (doc_id)"""

# sources in code-point order weigh 1, 2, 3 in turn; the level that is right for the sources behind is the largest
SOURCE_MIX = rf"""WITH r AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{SPACED}')) AS BIGINT) AS size,
    -ln((CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '|42'), 1, 12) AS UBIGINT) AS DOUBLE) + 0.5e0) / 281474976710656.0e0)
    / greatest(1.0e0 - len(regexp_extract_all(coalesce(text, ''), '[^\p{{L}}\x20\x09-\x0D]')) / CAST(greatest(length(coalesce(text, '')), 1) AS DOUBLE), 0.05e0) AS place
  FROM documents),
sizes AS (SELECT source, sum(size) AS source_size FROM r GROUP BY source),
weighed AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight, 3.0e0 * CAST(source_size AS DOUBLE) AS cap FROM sizes),
levels AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER earlier, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
  FROM weighed WINDOW earlier AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, greatest(least(cap, weight * max(level) OVER ()), 0.0e0) AS target FROM levels),
summed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r),
parts AS (SELECT s.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
  FROM summed AS s JOIN targets AS t ON s.source IS NOT DISTINCT FROM t.source),
taken AS (SELECT *, CAST(least(epochs + CASE WHEN size > 0 AND target - epochs * source_size > 0
  AND 2 * before + size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END, 3) AS INTEGER) AS copies FROM parts)
SELECT doc_id, source, size, CAST(source_size AS BIGINT) AS source_size, target, copies, CAST(size * copies AS BIGINT) AS taken FROM taken"""

# the CRC of a decimal number, a byte and a bit at a time
CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i: CAST(0 AS UBIGINT))),
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS UBIGINT)) ELSE x // 2 END)), CAST(4294967295 AS UBIGINT))"""

PREFIX_TRIE = f"""WITH RECURSIVE turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(sha256(sha256(coalesce(role, '')) || sha256(coalesce(text, ''))), 1, 32)) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 20 AS base, CASE WHEN conv_id % 20 = 0 THEN 0 ELSE CAST({CRC} % 4 AS BIGINT) END AS head
  FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text FROM convs AS c JOIN turns AS t ON t.conv_id = c.base AND t.pos <= c.head
  UNION ALL SELECT conv_id, 1, pos, role, text FROM turns JOIN convs USING (conv_id) WHERE pos > head),
numbered AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth, role, text,
    len(regexp_extract_all(text, '{SPACED}')) AS words FROM rebuilt),
paths(conv_id, depth, path, up, words) AS (
  SELECT conv_id, CAST(0 AS BIGINT), '', CAST(NULL AS VARCHAR), CAST(0 AS BIGINT) FROM convs
  UNION ALL
  SELECT p.conv_id, n.depth, md5(p.path || '|' || md5(n.role) || md5(n.text)), p.path, n.words
  FROM paths AS p JOIN numbered AS n ON n.conv_id = p.conv_id AND n.depth = p.depth + 1),
lengths AS (SELECT conv_id, max(depth) AS length FROM paths GROUP BY conv_id),
nodes AS (SELECT depth, path, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE length = depth), '') AS ends
  FROM paths JOIN lengths USING (conv_id) GROUP BY depth, path),
children AS (SELECT depth - 1 AS depth, up AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
above(depth, path, node_depth, node_path) AS (
  SELECT depth, path, depth, path FROM nodes
  UNION ALL
  SELECT a.depth - 1, n.up, a.node_depth, a.node_path FROM above AS a JOIN nodes AS n ON n.depth = a.depth AND n.path = a.path WHERE a.depth > 0),
subtrees AS (SELECT a.depth, a.path, sum((n.n_convs - 1) * n.words) AS saved, count(*) FILTER (WHERE c.n IS NULL) AS leaves
  FROM above AS a JOIN nodes AS n ON n.depth = node_depth AND n.path = node_path
  LEFT JOIN children AS c ON c.depth = node_depth AND c.path = node_path GROUP BY a.depth, a.path)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.leaves AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes AS n JOIN subtrees AS s USING (depth, path) LEFT JOIN children AS c USING (depth, path)
LEFT JOIN nodes AS p ON p.depth = n.depth - 1 AND p.path = n.up"""


def llm_oracles() -> dict[str, str]:
    return {
        "op1_substring_dedup": SUBSTRING_DEDUP,
        "op2_decontamination": DECONTAMINATION,
        "op8_near_duplicates": NEAR_DUPLICATES,
        "op10_source_mix": SOURCE_MIX,
        "op13_prefix_trie": PREFIX_TRIE,
    }
