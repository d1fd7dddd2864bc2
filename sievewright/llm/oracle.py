"""DuckDB statements of what operators 11 to 13 must return, written without their code."""

from __future__ import annotations


def _crc32(text: str) -> str:
    """The unsigned crc32 of an ASCII text, four bits at a time."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    half = lambda c: f"xor({c} >> 4, {table}[({c} & 15) + 1])"
    step = half(half("xor(c, b)"))
    codes = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295)"


def merkle_sql(levels: int = 4, upper: int = 3) -> str:
    """The manifest for up to ``16 ** levels`` rows a source and ``16 ** upper`` sources."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR END"
    before = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    small = f"translate(text, '{capitals}', '{capitals.lower()}')"
    ctes = [
        f"""rows AS MATERIALIZED (
  SELECT doc_id, source, sha256({before} || {field("text")}) AS leaf, sha256({before} || {field(small)}) AS changed,
    {_crc32("doc_id::VARCHAR")} % 5 = 0 AS hit
  FROM documents)""",
        """p0 AS MATERIALIZED (
  SELECT *, source AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    CASE WHEN hit THEN changed ELSE leaf END AS folded, '' AS proof
  FROM rows)""",
        "n0 AS (SELECT g, pos, leaf AS digest, count(*) OVER (PARTITION BY g) AS n FROM p0)",
    ]

    def climb(nodes: str, paths: str, count: int, mark: str) -> tuple[str, str]:
        for k in range(count):
            ctes.append(
                f"r{mark}{k} AS MATERIALIZED (SELECT g, pos // 16 AS run, list(digest ORDER BY pos) AS ds, any_value(n) AS n "
                f"FROM {nodes} GROUP BY g, pos // 16)"
            )
            ctes.append(
                f"n{mark}{k} AS (SELECT g, run AS pos, (n + 15) // 16 AS n, "
                f"CASE WHEN n = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS digest FROM r{mark}{k})"
            )
            ctes.append(
                f"q{mark}{k} AS (SELECT p.* EXCLUDE (pos, folded, proof), r.run AS pos, p.folded, p.proof, r.n, "
                f"array_to_string(r.ds[1:p.pos % 16], '') AS le, array_to_string(r.ds[p.pos % 16 + 2:], '') AS ri "
                f"FROM {paths} p JOIN r{mark}{k} r ON p.g IS NOT DISTINCT FROM r.g AND p.pos // 16 = r.run)"
            )
            ctes.append(
                f"p{mark}{k} AS MATERIALIZED (SELECT * EXCLUDE (n, le, ri, folded, proof), "
                f"CASE WHEN n = 1 THEN folded ELSE sha256(coalesce(le, '') || folded || coalesce(ri, '')) END AS folded, "
                f"CASE WHEN n = 1 THEN proof ELSE proof || coalesce(le, '') || coalesce(ri, '') END AS proof FROM q{mark}{k})"
            )
            nodes, paths = f"n{mark}{k}", f"p{mark}{k}"
        return nodes, paths

    nodes, paths = climb("n0", "p0", levels, "a")
    ctes.append(
        f"subs AS MATERIALIZED (SELECT g AS src, digest, 0 AS g, row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS pos, "
        f"count(*) OVER () AS n FROM {nodes})"
    )
    ctes.append(
        f"ps AS (SELECT p.* EXCLUDE (g, pos), s.g, s.pos, s.digest AS subroot FROM {paths} p "
        f"JOIN subs s ON p.g IS NOT DISTINCT FROM s.src)"
    )
    top, paths = climb("subs", "ps", upper, "b")
    return (
        "WITH " + ",\n".join(ctes) + f"\nSELECT p.doc_id, p.leaf, p.subroot, t.digest AS root, sha256(p.proof) AS proof_sha256, "
        f"p.folded AS folded_root, p.folded = t.digest AS verified FROM {paths} p, {top} t"
    )


def _found(kind: str, number: int, pattern: str, source: str = "docs", group: int = 0) -> str:
    """Places of all matches: their lengths and those of the texts between, summed up."""
    quoted = "'" + pattern.replace("'", "''") + "'"
    return f"""f_{kind} AS MATERIALIZED (
  SELECT row, {number} AS k, '{kind}' AS kind, m, size,
    sum(length(gap) + length(m)) OVER (PARTITION BY row ORDER BY i) - length(m) AS s,
    sum(length(gap) + length(m)) OVER (PARTITION BY row ORDER BY i) AS e
  FROM (SELECT row, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap, unnest(sizes) AS size, unnest(range(len(ms))) AS i
    FROM (SELECT row, regexp_extract_all(text, {quoted}) AS ms, string_split_regex(text, {quoted}) AS gaps,
      list_transform(regexp_extract_all(text, {quoted}, {group}), lambda x: length(x)) AS sizes FROM {source})))"""


def credentials_sql(reach: int = 300) -> str:
    value = r"[A-Za-z0-9+/_.=-]+"
    assign = rf"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?({value})"""
    named = r"""(?i:user|username|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
    mail = r"[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z]"
    endpoint = r"https?://[A-Za-z0-9._~:/?#@%&=+-]+|\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"
    touches = lambda x, y: f"NOT EXISTS (SELECT 1 FROM {y} o WHERE o.row = {x}.row AND o.s < {x}.e AND o.e > {x}.s)"
    lows = f"greatest(s - {reach}, 0)"
    highs = f"least(e + {reach}, length(text))"
    return f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
{_found("assign", 0, assign, group=1)},
{_found("access", 1, "AKIA[A-Z0-9]+")},
{_found("hex", 2, "[0-9a-f]+")},
strong AS MATERIALIZED (
  SELECT row, k, kind, s, e FROM f_assign WHERE size >= 8
  UNION ALL SELECT row, k, kind, s, e FROM f_access WHERE e - s >= 16
  UNION ALL SELECT row, k, kind, s, e FROM f_hex WHERE e - s >= 32),
{_found("named", 3, named)},
{_found("mail", 3, mail)},
{_found("key", 4, "[A-Za-z0-9+/_-]+")},
{_found("endpoint", 5, endpoint)},
parts AS MATERIALIZED (
  SELECT row, k, 'id' AS kind, s, e FROM f_named n WHERE {touches("n", "strong")}
  UNION ALL SELECT row, k, 'id', s, e FROM f_mail m WHERE {touches("m", "f_named")} AND {touches("m", "strong")}
  UNION ALL SELECT row, k, kind, s, e FROM f_endpoint p WHERE {touches("p", "strong")}),
keys AS MATERIALIZED (
  SELECT row, k, kind, s, e FROM f_key y
  WHERE e - s >= 16 AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')
    AND {touches("y", "strong")} AND {touches("y", "parts")}),
weak AS MATERIALIZED (SELECT * FROM parts UNION ALL SELECT * FROM keys),
every AS MATERIALIZED (SELECT * FROM strong UNION ALL SELECT * FROM weak),
scopes AS MATERIALIZED (
  SELECT row, {lows} + coalesce(length(regexp_extract(substr(text, ({lows} + 1)::BIGINT, (s - {lows})::BIGINT), '(?s)^.*\\n\\n')), 0) AS low,
    CASE WHEN strpos(substr(text, (e + 1)::BIGINT, ({highs} - e)::BIGINT), chr(10) || chr(10)) > 0
      THEN e + strpos(substr(text, (e + 1)::BIGINT, ({highs} - e)::BIGINT), chr(10) || chr(10)) - 1 ELSE {highs} END AS high
  FROM every JOIN docs USING (row) WHERE kind IN ('assign', 'hex', 'key')),
complete AS MATERIALIZED (
  SELECT DISTINCT c.row, c.low, c.high FROM scopes c JOIN every p ON p.row = c.row AND p.s >= c.low AND p.e <= c.high
  WHERE p.kind IN ('access', 'id')),
added AS (SELECT DISTINCT w.row, w.k, w.kind, w.s, w.e FROM weak w JOIN complete c ON w.row = c.row AND w.s >= c.low AND w.e <= c.high),
base AS (SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS t FROM strong GROUP BY row),
whole AS (SELECT row, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS t
  FROM (SELECT row, k, kind, s, e FROM strong UNION ALL SELECT * FROM added) GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base.t, '')) AS base_sha256, coalesce(whole.t, '') AS spans
FROM docs LEFT JOIN base USING (row) LEFT JOIN whole USING (row)
"""


HARD_NEGATIVES_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS MATERIALIZED (
  SELECT a.id AS a, b.id AS b, a.label = b.label AS same, list_inner_product(a.w, b.w)::BIGINT AS score
  FROM v a, v b WHERE a.id % 100 = 0 AND a.id <> b.id
), positive AS MATERIALIZED (
  SELECT * FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5
)
SELECT p.a AS anchor_id, p.b AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b) AS rank,
  n.b AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN pairs n ON p.a = n.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b) <= 5
"""

ORACLE_SQL = {
    "op11_merkle_manifest": merkle_sql(),
    "op12_credentials": credentials_sql(),
    "op13_hard_negatives": HARD_NEGATIVES_SQL,
}
