"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

#: crc32 of a decimal number ``{0}`` as text: one step for each bit, the lowest first.
_CRC = """xor(4294967295, list_reduce(
    [4294967295] || flatten(list_transform(string_split({0}::VARCHAR, ''), lambda c: list_transform(range(8), lambda k: (ascii(c) >> k) & 1))),
    lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))))"""


def crc32(number: str) -> str:
    """An expression for the crc32 of a number as text; null for null."""
    return _CRC.format(number)


FIM = """
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), u AS (
    SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
            WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM d
), c AS (
    SELECT *, substr(t, 1, least(a, b)) AS pre, substr(t, 1 + least(a, b), greatest(a, b) - least(a, b)) AS mid, substr(t, 1 + greatest(a, b)) AS suf
    FROM u
)
SELECT doc_id, n::BIGINT AS n, form,
    CASE WHEN form <> 'plain' THEN least(a, b)::BIGINT END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN (greatest(a, b) - least(a, b))::BIGINT END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM c
"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


MERKLE = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, {_leaf('text')} AS leaf, CASE WHEN {crc32('doc_id')} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS shown,
        dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, source
    FROM documents
), l AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, row_number() OVER () AS id FROM d
), low(level, g, p, h, n) AS (
    SELECT 0, g, p, leaf, count(*) OVER (PARTITION BY g) FROM l
    UNION ALL
    SELECT level + 1, g, p // 3, sha256(string_agg(h, '' ORDER BY p)), (any_value(n) + 2) // 3 FROM low WHERE n > 1 GROUP BY level, g, p // 3
), sub AS (
    SELECT g, h FROM low WHERE n = 1
), high(level, p, h, n) AS (
    SELECT 0, g, h, count(*) OVER () FROM sub
    UNION ALL
    SELECT level + 1, p // 3, sha256(string_agg(h, '' ORDER BY p)), (any_value(n) + 2) // 3 FROM high WHERE n > 1 GROUP BY level, p // 3
), steps AS (
    SELECT id, level AS k, s.p, s.h, l.p // (3 ** level)::BIGINT AS own FROM l JOIN low s ON s.g = l.g AND s.n > 1 AND s.p // 3 = l.p // (3 ** (level + 1))::BIGINT
    UNION ALL
    SELECT id, 1000 + level, s.p, s.h, l.g // (3 ** level)::BIGINT FROM l JOIN high s ON s.n > 1 AND s.p // 3 = l.g // (3 ** (level + 1))::BIGINT
), sides AS (
    SELECT id, row_number() OVER (PARTITION BY id ORDER BY k) AS k, coalesce(string_agg(h, '' ORDER BY p) FILTER (p < own), '') AS before,
        coalesce(string_agg(h, '' ORDER BY p) FILTER (p > own), '') AS after
    FROM steps GROUP BY id, k
), folds(id, k, h) AS (
    SELECT id, 0, shown FROM l
    UNION ALL
    SELECT f.id, s.k, sha256(s.before || f.h || s.after) FROM folds f JOIN sides s ON s.id = f.id AND s.k = f.k + 1
), ends AS (
    SELECT id, max_by(h, k) AS folded FROM folds GROUP BY id
), proofs AS (
    SELECT id, sha256(string_agg(before || after, '' ORDER BY k)) AS proof FROM sides GROUP BY id
)
SELECT doc_id, leaf, sub.h AS subroot, root.h AS root, coalesce(proof, sha256('')) AS proof_sha256, folded AS folded_root, folded = root.h AS verified
FROM l JOIN sub USING (g) JOIN ends USING (id) LEFT JOIN proofs USING (id), (SELECT h FROM high WHERE n = 1) AS root
"""

COSINE = """
WITH RECURSIVE e AS (
    SELECT row_number() OVER () AS rid, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
), f AS (
    SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM e
    WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.rid AS a, b.rid AS b FROM f AS a JOIN f AS b ON a.label = b.label AND len(a.v) = len(b.v) AND a.rid <> b.rid
    WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.98
), reach(a, b) AS (
    SELECT rid, rid FROM e
    UNION
    SELECT r.a, l.b FROM reach AS r JOIN links AS l ON l.a = r.b
), smallest AS (
    SELECT r.a AS rid, min(e.vec_id) AS component_id FROM reach AS r JOIN e ON e.rid = r.b GROUP BY r.a
)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = e.rid) AS n_links, component_id, vec_id = component_id AS kept
FROM e JOIN smallest USING (rid)
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHINGLES = f"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
    SELECT rid, doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS sh FROM d
), u AS (
    SELECT rid, len(sh) AS n, unnest(sh) AS x FROM s
), met AS (
    SELECT a.rid AS a, b.rid AS b FROM u AS a JOIN u AS b ON a.x = b.x AND a.rid < b.rid AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.rid, b.rid HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), links AS (
    SELECT a, b FROM met UNION ALL SELECT b, a FROM met
), reach(a, b) AS (
    SELECT rid, rid FROM s
    UNION
    SELECT r.a, l.b FROM reach AS r JOIN links AS l ON l.a = r.b
), smallest AS (
    SELECT r.a AS rid, min(s.doc_id) AS component_id FROM reach AS r JOIN s ON s.rid = r.b GROUP BY r.a
)
SELECT doc_id, len(sh)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN smallest USING (rid)
"""

CHECK_SQL: dict[str, str] = {
    "op7_circulant_minhash": SHINGLES,
    "op8_spherical_kmeans": COSINE,
    "op11_merkle_manifest": MERKLE,
    "op13_fill_in_middle": FIM,
}
