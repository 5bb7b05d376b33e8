"""DuckDB SQL for the rows of the queries that SQL can express."""

#: crc32 bit by bit: the reflected polynomial 0xEDB88320, eight steps for each byte.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}::VARCHAR) + 1), lambda i: ord(substr({0}::VARCHAR, i, 1))::BIGINT)),
    lambda c, byte: list_reduce(list_prepend(xor(c, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, step: xor(v >> 1, 3988292384 * (v & 1)))))"""

CONVERSATIONS = rf"""
WITH own AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
    SELECT c, count(*) AS n, {_CRC32.format("c")} % 4 AS h FROM own GROUP BY c
), heads AS (
    SELECT s.c, s.h, least(s.h, coalesce(b.n, 0)) AS m FROM sizes s LEFT JOIN sizes b ON b.c = s.c - s.c % 20
), turns AS (
    SELECT h.c, b.pos AS depth, b.role, b.text FROM heads h JOIN own b ON b.c = h.c - h.c % 20 AND b.pos <= h.h
    UNION ALL SELECT h.c, h.m + o.pos - h.h, o.role, o.text FROM heads h JOIN own o ON o.c = h.c AND o.pos > h.h
), paths AS (
    SELECT c, depth, length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
        list({{'role': role, 'text': text}}) OVER (PARTITION BY c ORDER BY depth ROWS UNBOUNDED PRECEDING) AS path FROM turns
    UNION ALL SELECT c, 0, 0, [] FROM sizes
), nodes AS (
    SELECT path, min(c) AS conv_id, min(depth) AS depth, count(*) AS n_convs, min(words) AS words FROM paths GROUP BY path
), children AS (
    SELECT path[:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), counted AS (
    SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN children k USING (path)
), sums AS (
    SELECT p.path, sum((n.n_convs - 1) * n.words) AS saved_tokens, count(*) FILTER (n.n_children = 0) AS n_leaves
    FROM counted n JOIN paths p ON p.c = n.conv_id AND p.depth <= n.depth GROUP BY p.path
), ends AS (
    SELECT path, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256
    FROM (SELECT c, path FROM paths QUALIFY depth = max(depth) OVER (PARTITION BY c)) GROUP BY path
)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
    n.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM counted n JOIN sums s USING (path) LEFT JOIN ends e USING (path) LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[:n.depth - 1]
"""


def _any_case(words: str) -> str:
    """ASCII letters in either case, written out: RE2 without regard to case would also take the long s and the Kelvin sign."""
    return "".join(f"[{c.upper()}{c}]" if c.islower() else c for c in words)


_ASSIGN = rf"""(?:{_any_case("password|passwd|secret|token|api_?key")})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
#: Kind, pattern, group whose length is asked for, least length. Runs are whole runs, so they need no look behind them.
_SPANS = (
    ("assign", _ASSIGN, 1, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16),
    ("entropy_hex", "[0-9a-fA-F]+", 0, 20), ("entropy_base64", "[A-Za-z0-9+/_=-]+", 0, 20),
)
_ALLOWED = (
    "^[A-Za-z+/_=-]*$", "^[0-9+/_=-]*$", "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", "^[0-9]{4}-[0-9]{2}-[0-9]{2}",
    "^/?([A-Za-z_-]+/)+[A-Za-z_-]*[0-9]{0,4}$", _any_case("example|sample|placeholder|changeme|dummy"),
)


def _matches(k: int) -> str:
    """Every match of a kind. What lies between matches and the matches, one after the other, give their places."""
    _, pattern, group, _ = _SPANS[k]
    return f"""SELECT r, {k} AS k, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS m, unnest(g) AS g, unnest(b[:len(m)]) AS b FROM (
        SELECT r, regexp_extract_all(text, '{pattern}') AS m, regexp_extract_all(text, '{pattern}', {group}) AS g, regexp_split_to_array(text, '{pattern}') AS b
        FROM docs)"""


SECRETS = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), matches AS (
    {" UNION ALL ".join(_matches(k) for k in range(len(_SPANS)))}
), placed AS (
    SELECT r, k, m, g, (sum(length(b) + length(m)) OVER (PARTITION BY r, k ORDER BY i))::BIGINT AS e FROM matches
), long_enough AS (
    SELECT r, k, m, e - length(m) AS s, e FROM placed WHERE length(g) >= [{", ".join(str(least) for *_, least in _SPANS)}][k + 1]
), windows AS (
    SELECT r, k, s, unnest(range(0, length(m) - 19)) AS i, m FROM long_enough
    WHERE k >= 3 AND NOT ({" OR ".join(f"regexp_matches(m, '{p}')" for p in _ALLOWED)})
), dense AS (
    SELECT r, k, s + min(i) AS s, s + max(i) + 20 AS e FROM windows
    WHERE list_entropy(string_split(substr(m, i + 1, 20), '')) >= CASE k WHEN 3 THEN 3.0 ELSE 3.7 END GROUP BY r, k, windows.s
), spans AS (
    SELECT r, k, s, e FROM long_enough WHERE k < 3 UNION ALL SELECT r, k, s, e FROM dense
), texts AS (
    SELECT *, [{", ".join(f"'{kind}'" for kind, *_ in _SPANS)}][k + 1] || ':' || s || ':' || e AS span FROM spans
)
SELECT any_value(doc_id) AS doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    sha256(coalesce(string_agg(span, ',' ORDER BY s, k, e) FILTER (k < 3), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY s, k, e), '') AS spans
FROM docs LEFT JOIN texts USING (r) GROUP BY r
"""
