"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from candela.llm.license import LEAST_COVERAGE, LICENCE_WORD, TEMPLATES
from candela.llm.mix import MOST_EPOCHS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def license_scan() -> str:
    """Every template at every word of every text, without an index."""
    def listed(words) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    templates = ", ".join(
        f"({i}, '{t.label}', {t.base}, {t.key_at()}, {listed(t.words())}, {listed(t.key.split())})"
        for i, t in enumerate(TEMPLATES))
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS nr, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{LICENCE_WORD}') AS words
  FROM documents),
templates(tid, label, base, key_at, twords, tkey) AS (VALUES {templates}),
first_words AS (SELECT *, tkey[1] AS opening FROM templates),
places AS (
  SELECT nr, words, unnest(words) AS word, unnest(range(len(words))) AS i FROM texts),
keyed AS (
  SELECT nr, label, base, i, list_sum(list_transform(range(len(twords)), lambda j:
           CASE WHEN i - key_at + j >= 0 AND words[i - key_at + j + 1] = twords[j + 1] THEN 1 ELSE 0 END)) / len(twords) AS coverage
  FROM places JOIN first_words ON word = opening
  WHERE words[i + 1 : i + len(tkey)] = tkey),
found AS (
  SELECT nr, count(*) FILTER (base) AS n_base, min(i) FILTER (base) AS first_word, max(i) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score
  FROM keyed WHERE coverage >= {LEAST_COVERAGE} GROUP BY nr)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM texts LEFT JOIN found USING (nr)"""


def mix_ctes(table: str = "documents") -> str:
    """The mix without bands: one running sum over each source; ends with ``mixed``."""
    return f"""
sized AS (
  SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>!]+', '', 'g')) AS symbols FROM {table}),
keyed5 AS (
  SELECT *, -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':0'), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)
           / greatest(0.25::DOUBLE, 1.0::DOUBLE - symbols::DOUBLE / greatest(size, 1) / 4) AS k FROM sized),
sources AS (SELECT source, sum(size)::BIGINT AS source_size, {MOST_EPOCHS}.0::DOUBLE * sum(size)::DOUBLE AS most,
            (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::DOUBLE AS w FROM sized GROUP BY source),
filling AS (
  SELECT *, sum(source_size) OVER ()::DOUBLE - coalesce(sum(most) OVER upto, 0) AS rest_size,
         sum(w) OVER () - coalesce(sum(w) OVER upto, 0) AS rest_w
  FROM sources WINDOW upto AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
aims AS (
  SELECT source, source_size, coalesce(least(most, w * max(CASE WHEN most * rest_w > rest_size * w THEN rest_size / rest_w END) OVER ()), most) AS target
  FROM filling),
epochs AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM aims),
mixed AS (
  SELECT d.*, e.source_size, e.target, e.epochs,
         e.target - e.epochs * e.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS LAST, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM keyed5 d JOIN epochs e ON d.source IS NOT DISTINCT FROM e.source)"""


TAKEN = "(epochs + CASE WHEN rest > 0 AND earlier + size / 2.0 <= rest THEN 1 ELSE 0 END)"


def source_mix() -> str:
    return f"WITH {mix_ctes()} SELECT doc_id, size, source_size, target, ({TAKEN} * size)::BIGINT AS taken FROM mixed"


TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


JACCARD = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
           FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
sides AS (SELECT a AS x, b AS y FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, sides.y FROM reach JOIN sides ON sides.x = reach.r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)"""


#: CRC-32 of the decimal digits of conv_id, a bit at a time.
CRC32 = """xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
      range(1, length(conv_id::VARCHAR) + 1), lambda i: list_concat([1000 + ascii(substr(conv_id::VARCHAR, i, 1))], [0, 0, 0, 0, 0, 0, 0, 0])))),
    lambda a, x: CASE WHEN x >= 1000 THEN xor(a, x - 1000) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))"""

#: Every node joined to all its ancestors, without bitmaps.
TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {CRC32} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
parts AS (
  SELECT c.conv_id, 0 AS side, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base WHERE t.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t USING (conv_id) WHERE t.pos > c.h),
rebuilt AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY side, pos) AS depth, strlen(text) AS bytes,
         md5(length(role) || ':' || role || text) AS turn FROM parts
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
paths AS (
  SELECT conv_id, depth, bytes, md5(string_agg(turn, ',') OVER (PARTITION BY conv_id ORDER BY depth)) AS node,
         max(depth) OVER (PARTITION BY conv_id) AS n FROM rebuilt),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM paths GROUP BY node, depth),
above AS (
  SELECT u.node, u.conv_id, u.depth, u.n_convs, u.bytes, p.node AS parent
  FROM nodes u LEFT JOIN paths p ON p.conv_id = u.conv_id AND p.depth = u.depth - 1),
children AS (SELECT parent AS node, count(*) AS n_children FROM above WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT p.node, sum((u.n_convs - 1) * u.bytes) AS saved_tokens, count(*) FILTER (c.node IS NULL) AS n_leaves
  FROM above u JOIN paths p ON p.conv_id = u.conv_id AND p.depth <= u.depth LEFT JOIN children c ON c.node = u.node
  GROUP BY p.node)
SELECT n.conv_id, n.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(c.n_children, 0)::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens,
       n.ends_sha256
FROM nodes n JOIN above a ON a.node = n.node LEFT JOIN nodes q ON q.node = a.parent
     JOIN below b ON b.node = n.node LEFT JOIN children c ON c.node = n.node"""


ORACLE: dict[str, str] = {
    "op1_license_scan": license_scan(),
    "op2_top_k": TOP_K,
    "op5_source_mix": source_mix(),
    "op6_jaccard_join": JACCARD,
    "op12_prefix_trie": TRIE,
}
