"""SQL for the queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINE_DEDUP = f"""
WITH lines AS (
    SELECT doc_id, pos, list_extract(parts, pos) AS line,
           translate(trim(list_extract(parts, pos), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     '{UPPER}', '{LOWER}') AS key
    FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS pos
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) AS s) AS p
), frequent AS (
    SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
    SELECT doc_id, pos, line, coalesce(doc_id <> keeper, false) AS dropped
    FROM lines LEFT JOIN frequent USING (key)
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


NEAREST = """
WITH usable AS (
    SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v) AS score
    FROM usable AS q JOIN usable AS c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM scored
)
SELECT * FROM ranked WHERE rank <= 20
"""


HARD_NEGATIVES = """
WITH points AS (
    SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), usable AS (
    SELECT vec_id, label, v FROM points WHERE list_inner_product(v, v) < 36028797018963968
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, v) = 1
), scored AS (
    SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS vec_id,
           CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM usable AS a JOIN usable AS b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


def _draw(n: int) -> str:
    return f"CAST('0x' || substr(h, {8 * n + 1}, 8) AS UBIGINT)"


FILL_IN_MIDDLE = f"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS h,
           regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
    FROM documents
), cuts AS (
    SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n,
           {_draw(0)} % (len(units) + 1) AS a, {_draw(1)} % (len(units) + 1) AS b, {_draw(3)} % 100 AS turn,
           text = '' OR doc_id IS NULL OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
           OR {_draw(2)} % 100 >= 100 AS plain
    FROM docs
), parts AS (
    SELECT doc_id, text, n, CASE WHEN plain THEN 'plain' WHEN turn < 50 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(list_slice(units, 1, CAST(least(a, b) AS BIGINT)), '') AS p,
           array_to_string(list_slice(units, CAST(least(a, b) AS BIGINT) + 1, CAST(greatest(a, b) AS BIGINT)), '') AS m,
           array_to_string(list_slice(units, CAST(greatest(a, b) AS BIGINT) + 1, n), '') AS s
    FROM cuts
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


def build() -> dict[str, str]:
    return {
        "op1_nearest_neighbours": NEAREST,
        "op6_line_dedup": LINE_DEDUP,
        "op11_hard_negatives": HARD_NEGATIVES,
        "op12_fill_in_middle": FILL_IN_MIDDLE,
    }
