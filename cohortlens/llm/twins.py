"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from cohortlens.llm.decontaminate import MASKS, numbered

_TOKENS = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')"


def _seeds(table: str, key: str, items: bool) -> str:
    """All seeds of a token table, the words themselves in place of a hash; of
    items only under the masks for their length."""
    return "\nUNION ALL\n".join(
        f"SELECT {key}, pos, {k} AS mask, " + " || ' ' || ".join(f"w[pos + {a + 1}]" for a, c in enumerate(mask) if c == "1") + " AS seed "
        f"FROM (SELECT {key}, w, unnest(generate_series(0, len(w) - {len(mask)})) AS pos FROM {table} WHERE len(w) >= {len(mask)}"
        + (f" AND len(w) BETWEEN {lo} AND {hi}" if items else "") + ")"
        for k, mask, lo, hi in numbered(MASKS))


OP10 = f"""
WITH d AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
b AS (SELECT item_id, {_TOKENS} AS w FROM benchmark),
bs AS MATERIALIZED ({_seeds('b', 'item_id', True)}),
ds AS (SELECT * FROM ({_seeds('d', 'doc_id', False)}) WHERE seed IN (SELECT seed FROM bs)),
hits AS (
  SELECT doc_id, item_id, ds.pos - bs.pos AS shift, count_if(ds.mask < {len(MASKS)}) AS seeds
  FROM ds JOIN bs ON ds.mask = bs.mask AND ds.seed = bs.seed GROUP BY ALL),
laid AS (
  SELECT h.doc_id, h.item_id, shift, seeds, len(b.w) AS n, b.w AS want, d.w AS have,
         unnest(generate_series(0, len(b.w) - 1)) AS i
  FROM hits h JOIN d USING (doc_id) JOIN b USING (item_id)),
run AS (
  SELECT doc_id, item_id, shift, seeds, n,
         sum(CASE WHEN i + shift >= 0 AND have[i + shift + 1] = want[i + 1] THEN 1 ELSE 0 END) OVER (
           PARTITION BY doc_id, item_id, shift ORDER BY i ROWS BETWEEN 15 PRECEDING AND CURRENT ROW) AS now
  FROM laid),
judged AS (
  SELECT doc_id, item_id, shift, seeds, n, max(now) AS matched, ceil(least(n, 16) * 0.8::DOUBLE) AS needed
  FROM run GROUP BY ALL)
SELECT doc_id, item_id, CAST(n AS INTEGER) AS item_tokens, CAST(matched AS INTEGER) AS matched,
       CAST(needed AS INTEGER) AS needed, CAST(shift AS INTEGER) AS position, CAST(seeds AS BIGINT) AS seeds
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, seeds DESC, shift) AS rn
      FROM judged WHERE matched >= needed) WHERE rn = 1
"""

_ASSIGN = ("([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
           "|[aA][pP][iI]_?[kK][eE][yY])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)")
_CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"


def _spans(regex: str, rank: int, kind: str, group: int, least: int) -> str:
    """(doc_id, start, rank, kind, end, value) of the matches whose group is long
    enough; the pieces between the matches give the positions."""
    return f"""
SELECT doc_id, CAST(before + used - length(m) AS BIGINT) AS s, {rank} AS rank, '{kind}' AS kind,
       CAST(before + used AS BIGINT) AS e, m AS value
FROM (SELECT doc_id, m, v,
             sum(length(p)) OVER (PARTITION BY doc_id ORDER BY i) AS before,
             sum(length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS used
      FROM (SELECT doc_id, unnest(ms) AS m, unnest(vs) AS v, unnest(ps[1:len(ms)]) AS p, unnest(range(len(ms))) AS i
            FROM (SELECT doc_id, regexp_extract_all(t, '{regex}') AS ms, regexp_extract_all(t, '{regex}', {group}) AS vs,
                         regexp_split_to_array(t, '{regex}') AS ps FROM t)))
WHERE length(v) >= {least}"""


def _cut() -> str:
    """The candidate with every match of the allow-list a space. RE2 has no
    lookahead, so for the paths the end of a part is marked by a character."""
    paths = ("regexp_replace(regexp_replace(regexp_replace({0}, '([ =/])', '\x01\\1', 'g') || '\x01', "
             "'(?i)(\x01?/[a-z]+){{3}}([^ =/\x01]{{0,19}}\x01)?(/[^ =/\x01]{{0,19}}\x01)*', ' ', 'g'), '\x01', '', 'g')")
    steps = ("regexp_replace({0}, '^[=_/+-]*[0-9a-fA-F]{{8}}(-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}$', ' ', 'g')", paths,
             "regexp_replace({0}, '(?i)[^ =/]{{0,20}}(example|sample|placeholder|your[_-]|changeme|x{{6}}|0{{8}}|1234567)[^ =/]{{0,20}}', ' ', 'g')",
             "regexp_replace({0}, '(?i)^(https?|www|ftp)[^ =/]{{0,20}}', ' ', 'g')", "regexp_replace({0}, '[=_/+-]{{5,}}', ' ', 'g')")
    out = "value"
    for step in steps:
        out = step.format(out)
    return out


_CUT = _cut()
_UNLIKE = "regexp_matches(v, '(?i)[bcdfghjklmnpqrstvwxz]{5}')"

OP2 = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS ({_spans(_ASSIGN, 0, 'assign', 2, 8)}
UNION ALL {_spans('AKIA[A-Z0-9]+', 1, 'access', 0, 16)}
UNION ALL {_spans('[0-9a-f]+', 2, 'hex', 0, 32)}),
cand AS ({_spans(_CANDIDATE, 3, 'entropy', 0, 20)}),
free AS (
  SELECT *, row_number() OVER () AS i FROM cand c
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = c.doc_id AND b.s < c.e AND c.s < b.e)),
pieces AS (SELECT i, unnest(string_split({_CUT}, ' ')) AS piece FROM free),
judged AS (SELECT i, piece, regexp_replace(piece, '^[=_/+-]+', '') AS v FROM pieces WHERE length(piece) >= 20),
random AS (
  SELECT DISTINCT i FROM judged
  WHERE list_max(list_transform(range(1, length(piece) - 18), lambda k: list_entropy(string_split(substr(piece, k, 20), '')))) >=
    CASE WHEN regexp_matches(v, '^[0-9]+$') THEN 99 WHEN regexp_matches(v, '^([0-9a-f]+|[0-9A-F]+)$') THEN 3.0
         WHEN regexp_matches(v, '^([a-z_-]+|[A-Z_-]+)$') THEN CASE WHEN {_UNLIKE} THEN 3.5 ELSE 99 END
         WHEN regexp_matches(v, '^[A-Za-z_/-]+$') THEN CASE WHEN {_UNLIKE} THEN 3.8 ELSE 4.1 END ELSE 3.7 END),
added AS (SELECT doc_id, s, rank, kind, e, value FROM free SEMI JOIN random USING (i)),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM added),
per AS (
  SELECT doc_id, count_if(rank = 0) AS a, count_if(rank = 1) AS k, count_if(rank = 2) AS h, count_if(rank = 3) AS n,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (WHERE rank < 3) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(k, 0) AS BIGINT) AS n_access,
       CAST(coalesce(h, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       CAST(coalesce(n, 0) AS BIGINT) AS n_entropy
FROM t LEFT JOIN per USING (doc_id)
"""

ORACLE_SQL = {"op2_secret_scan": OP2, "op10_decontamination": OP10}

_BLANKS = "[\\x20\\x09-\\x0D]+"

OP12 = f"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '{_BLANKS}'), lambda x: x <> '') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             list_filter([CASE WHEN len(w) < 50 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' END,
               CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' END,
               CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
               CASE WHEN coalesce(doc_id > first, first IS NOT NULL) THEN 'E' END], lambda x: x IS NOT NULL) AS fs
      FROM w LEFT JOIN l USING (doc_id)),
m AS (SELECT part, fs, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fs),
k AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
o AS (SELECT a.k || b.k || c.k || d.k || e.k AS filter_order FROM k a, k b, k c, k d, k e
      WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o),
j AS (SELECT part, filter_order, step, n, good, toxic, fs,
             substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before FROM s, m),
b AS (SELECT *, list_contains(fs, f) AS mine, len(list_filter(fs, lambda x: contains(before, x))) > 0 AS earlier FROM j)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       CAST(sum(CASE WHEN mine OR earlier THEN 0 ELSE n END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN mine AND NOT earlier THEN n ELSE 0 END) AS BIGINT) AS removed,
       CAST(sum(CASE WHEN mine AND earlier THEN n ELSE 0 END) AS BIGINT) AS redundant,
       CAST(sum(CASE WHEN mine AND len(fs) = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
       CAST(sum(CASE WHEN mine AND NOT earlier THEN good ELSE 0 END) AS BIGINT) AS good_lost,
       CAST(sum(CASE WHEN mine AND NOT earlier THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
       CAST(sum(CASE WHEN mine THEN n * (120 // len(fs)) ELSE 0 END) AS BIGINT) AS shapley
FROM b GROUP BY part, filter_order, step
"""


def _clusters(k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, seed: int = 3) -> str:
    parts = [f"""x AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda v: CAST(floor({scale} * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = {width})""",
             f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, x FROM (SELECT sha256('{seed}:' || vec_id) AS h, x FROM x ORDER BY h LIMIT {k}))"""]
    for i in range(rounds + 1):  # least distance, then smallest number, as one whole number
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, min(CAST(list_sum(list_transform(list_zip(x.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS HUGEINT) * {k} + c) AS m
  FROM x, c{i} c GROUP BY r)""")
        if i < rounds:
            parts.append(f"""s{i} AS (
  SELECT c, list((s - ((s % n + n) % n)) // n ORDER BY i) AS x
  FROM (SELECT m % {k} AS c, i, CAST(sum(v) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n
        FROM (SELECT m, unnest(x) AS v, unnest(range({width})) AS i FROM x JOIN a{i} USING (r)) GROUP BY ALL) GROUP BY c)""")
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(CAST(s.x AS BIGINT[]), c.x) AS x FROM c{i} c LEFT JOIN s{i} s ON s.c = c.c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(m % {k} AS INTEGER) AS cluster, CAST(m // {k} AS BIGINT) AS distance,
       CAST(sum(m // {k}) OVER (PARTITION BY m % {k}) AS BIGINT) AS cluster_inertia,
       CAST(sum(m // {k}) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM x JOIN a{rounds} USING (r) JOIN c{rounds} c ON c.c = m % {k}
"""


OP13 = _clusters()

ORACLE_SQL = {**ORACLE_SQL, "op12_filter_audit": OP12, "op13_bisector_clusters": OP13}
