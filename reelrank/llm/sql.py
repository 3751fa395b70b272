"""DuckDB SQL for the queries that SQL can state, written independently of the Spark code."""

from __future__ import annotations

from reelrank.llm.queries import MIX_BUDGET_SHARE, MIX_EPOCHS, MIX_WEIGHTS, SHARDS, URL_RULES

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

OP6 = rf"""
WITH rules(rhost, rpath, rverdict) AS (VALUES {_RULES}),
u AS (SELECT row_number() OVER () AS n, page_id,
             CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3)
                  ELSE '' END AS rest FROM pages),
parts AS (SELECT n, page_id,
                 translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
hits AS (SELECT n, rhost || rpath AS rule, rverdict,
                row_number() OVER (PARTITION BY n ORDER BY length(rhost) + length(rpath) DESC,
                                   length(rhost) DESC) AS k
         FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost))
                               AND starts_with(path, rpath))
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       coalesce(rverdict, 'allow') AS verdict
FROM parts LEFT JOIN hits ON parts.n = hits.n AND k = 1
"""

OP8 = r"""
WITH t AS (SELECT row_number() OVER () AS n, doc_id, source, coalesce(text, '') AS text
           FROM documents),
w AS (SELECT n, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'),
                            lambda x: x <> '') AS ws FROM t),
pos AS (SELECT n, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT n, i, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c, word AS a
      FROM pos WINDOW o AS (PARTITION BY n ORDER BY i)),
rep AS (SELECT n, i FROM (SELECT n, i, count(*) OVER (PARTITION BY n, a, b, c) AS k
                          FROM g WHERE c IS NOT NULL) WHERE k > 1),
cov AS (SELECT n, count(DISTINCT i + d) AS n_repeat_words
        FROM rep, (VALUES (0), (1), (2)) AS s(d) GROUP BY n),
counts AS (SELECT t.n, doc_id, source, len(ws) AS n_words,
                  coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
                  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                  coalesce(n_repeat_words, 0) AS n_repeat_words
           FROM t JOIN w ON t.n = w.n LEFT JOIN cov ON t.n = cov.n),
lines AS (SELECT n, doc_id, source, unnest(string_split(text, chr(10))) AS line FROM t),
real AS (SELECT *, trim(lower(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')), ' ') AS norm
         FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT n, count(*) - count(DISTINCT line) AS n_dup_lines FROM real GROUP BY n),
often AS (SELECT coalesce(source, '(null)') AS s, norm FROM real
          GROUP BY 1, 2 HAVING count(DISTINCT doc_id) > 20),
left_ AS (SELECT r.n, sum(length(r.norm)) AS n_line_chars,
                 sum(CASE WHEN o.norm IS NULL THEN length(r.norm) ELSE 0 END) AS n_left_chars
          FROM real r LEFT JOIN often o ON o.s = coalesce(r.source, '(null)') AND o.norm = r.norm
          GROUP BY r.n)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
           AND coalesce(n_left_chars, 0) >= 0.3 * coalesce(n_line_chars, 0) AS kept,
       coalesce(n_line_chars, 0)::BIGINT AS n_line_chars,
       coalesce(n_left_chars, 0)::BIGINT AS n_left_chars
FROM counts LEFT JOIN dup ON counts.n = dup.n LEFT JOIN left_ ON counts.n = left_.n
"""


def _weights(depth: int) -> str:
    rows = [(*p, w) for p, w in MIX_WEIGHTS.items() if len(p) == depth]
    return ", ".join("(" + ", ".join(f"'{x}'" for x in r[:-1]) + f", {r[-1]}::DOUBLE)"
                     for r in rows)


def _level(name: str, keys: list[str], parent: str | None) -> str:
    """Water filling by the level at which each sibling would be full (a self-join)."""
    own, up = ", ".join(keys), keys[:-1]
    same = " AND ".join(f"i.{k} = j.{k}" for k in up) or "TRUE"
    joined = " AND ".join(f"c.{k} IS NOT DISTINCT FROM w.{k}" for k in keys)
    on_parent = " AND ".join(f"c.{k} = p.{k}" for k in up)
    budget = f"JOIN {parent} p ON {on_parent}" if parent else "CROSS JOIN (SELECT b AS given FROM total) p"
    return f"""
{name}_c AS (SELECT {', '.join('c.' + k for k in keys)}, c.cap, coalesce(w.w, 1.0::DOUBLE) AS w,
                    p.given AS budget
             FROM (SELECT {own}, sum(tokens) * {MIX_EPOCHS}::DOUBLE AS cap FROM leaf GROUP BY {own}) c
             LEFT JOIN (SELECT * FROM (VALUES {_weights(len(keys))}) AS v({own}, w)) w ON {joined}
             {budget}),
{name}_f AS (SELECT {', '.join('j.' + k for k in keys)}, any_value(j.cap) AS cap,
                    any_value(j.w) AS w, any_value(j.budget) AS budget,
                    sum(least(i.cap, j.cap / j.w * i.w)) <= any_value(j.budget) AS is_full
             FROM {name}_c j JOIN {name}_c i ON {same} GROUP BY {', '.join('j.' + k for k in keys)}),
{name} AS (SELECT {own}, CASE WHEN is_full THEN cap ELSE
                  (budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER o) * w
                  / sum(CASE WHEN is_full THEN 0 ELSE w END) OVER o END AS given
           FROM {name}_f WINDOW o AS (PARTITION BY {', '.join(up) or '1'}))"""


OP10 = rf"""
WITH d AS (SELECT doc_id, source, lang,
    CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) = '' THEN 'other'
         ELSE 'd' || (regexp_extract(source, '([0-9]{{1,9}})$', 1)::INT % 4) END AS domain,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                    lambda x: x <> '')) AS n_tokens FROM documents),
k AS (SELECT *, domain AS a, coalesce(lang, '(null)') AS b, coalesce(source, '(null)') AS c FROM d),
leaf AS (SELECT a, b, c, sum(n_tokens) AS tokens FROM k GROUP BY a, b, c),
total AS (SELECT least(floor(sum(tokens) * {MIX_BUDGET_SHARE}), sum(tokens) * {MIX_EPOCHS})::DOUBLE
          AS b FROM leaf),
{_level('l1', ['a'], None)},
{_level('l2', ['a', 'b'], 'l1')},
{_level('l3', ['a', 'b', 'c'], 'l2')},
plan AS (SELECT l3.a, l3.b, l3.c, tokens, floor(given)::BIGINT AS budget,
                least(floor(floor(given) / tokens), {MIX_EPOCHS})::BIGINT AS epochs
         FROM l3 JOIN leaf ON l3.a = leaf.a AND l3.b = leaf.b AND l3.c = leaf.c
         WHERE tokens > 0),
e AS (SELECT k.*, epochs, budget - epochs * tokens AS rest,
             md5('17:' || epochs || ':' || coalesce(doc_id::VARCHAR, 'null')) AS place
      FROM k JOIN plan ON k.a = plan.a AND k.b = plan.b AND k.c = plan.c),
run AS (SELECT *, sum(n_tokens) OVER (PARTITION BY a, b, c ORDER BY place) AS cum FROM e),
picked AS (SELECT *, unnest(range(epochs + CASE WHEN rest > 0 AND cum <= rest THEN 1 ELSE 0 END))
                  AS epoch FROM run)
SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens, epoch::BIGINT AS epoch,
       md5('17:' || epoch || ':' || coalesce(doc_id::VARCHAR, 'null')) AS order_key
FROM picked
"""

OP1 = r"""
WITH RECURSIVE t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
lines AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM t),
norm AS (SELECT DISTINCT conv_id, turn,
                trim(lower(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')), ' ') AS x FROM lines),
own AS (SELECT conv_id, x, turn AS src FROM norm WHERE x <> ''),
votes AS (SELECT q.conv_id, q.turn + back AS turn, back, o.src, count(*) AS n
          FROM norm q, (VALUES (1), (2)) AS b(back), own o
          WHERE o.conv_id = q.conv_id AND o.x = q.x AND q.x <> '' AND o.src < q.turn + back
          GROUP BY 1, 2, 3, 4),
size AS (SELECT conv_id, turn, count(*) AS total FROM norm WHERE x <> '' GROUP BY 1, 2),
best AS (SELECT conv_id, turn, back, src, n, row_number() OVER (
                PARTITION BY conv_id, turn, back ORDER BY n DESC, src DESC) AS k FROM votes),
good AS (SELECT b.conv_id, b.turn, b.back, b.src FROM best b JOIN size s
         ON s.conv_id = b.conv_id AND s.turn = b.turn - b.back
         WHERE k = 1 AND b.n >= 0.5 * s.total),
up AS (SELECT g.conv_id, g.turn, arg_min(src, back) AS up FROM good g
       JOIN t ON t.conv_id = g.conv_id AND t.turn = g.turn GROUP BY 1, 2),
tree AS (SELECT t.conv_id, t.turn, t.turn AS root, 0::BIGINT AS depth FROM t
         LEFT JOIN up ON up.conv_id = t.conv_id AND up.turn = t.turn WHERE up.up IS NULL
         UNION ALL
         SELECT up.conv_id, up.turn, tree.root, tree.depth + 1 FROM up
         JOIN tree ON tree.conv_id = up.conv_id AND tree.turn = up.up),
quotes AS (SELECT t.conv_id, t.turn,
                  CASE WHEN a.turn IS NULL THEN 0 WHEN b.turn IS NULL THEN 1 ELSE 2 END AS quote_levels,
                  coalesce(len(string_split(a.text, chr(10))), 0)
                  + CASE WHEN a.turn IS NOT NULL
                         THEN coalesce(len(string_split(b.text, chr(10))) + 0, 0) ELSE 0 END AS n
           FROM t LEFT JOIN t a ON a.conv_id = t.conv_id AND a.turn = t.turn - 1
           LEFT JOIN t b ON b.conv_id = t.conv_id AND b.turn = t.turn - 2 AND a.turn IS NOT NULL),
bodies AS (SELECT conv_id, turn, role, regexp_replace(text, '^\s+|\s+$', '', 'g') AS body FROM t)
SELECT b.conv_id, b.turn, b.role, b.body, sha256(b.body) AS body_sha256,
       (n + CASE WHEN quote_levels = 2 THEN 1 ELSE 0 END)::BIGINT AS n_quoted_lines,
       quote_levels, up.up AS reply_to, root, depth,
       row_number() OVER (PARTITION BY b.conv_id ORDER BY root, depth, b.turn) - 1 AS position
FROM bodies b JOIN quotes q ON q.conv_id = b.conv_id AND q.turn = b.turn
JOIN tree ON tree.conv_id = b.conv_id AND tree.turn = b.turn
LEFT JOIN up ON up.conv_id = b.conv_id AND up.turn = b.turn
"""

# CRC-32 of a string of bytes: the table of its polynomial, one entry a byte.
_CRC_TABLE = """crc AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1
    THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) ORDER BY b) AS t
    FROM range(256) AS v(b))"""


def _crc32(hex_pairs: str) -> str:
    """Unsigned CRC-32 of a list of bytes in hex, with ``crc.t`` at hand."""
    byte = "('0x' || b)::BIGINT"
    return (f"xor(list_reduce(list_transform({hex_pairs}, lambda b: {byte}), lambda c, b: "
            f"xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295::BIGINT), 4294967295)")


def _hex_pairs(text: str) -> str:
    return f"regexp_extract_all(hex(encode({text})), '..')"


MERKLE_LEVELS, MERKLE_TOP_LEVELS = 8, 3


def _field(col: str) -> str:
    return (f"CASE WHEN {col} IS NULL THEN '-' "
            f"ELSE strlen({col}::VARCHAR)::VARCHAR || ':' || {col}::VARCHAR END")


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ["doc_id", "source", "lang", "n_chars", text])) + ")"


def _climb(name: str, start: str, levels: int) -> str:
    """Tables {name}0 … {name}N of (g, pos, digest, n); a part that is down to one node stays."""
    out = [f"{name}0 AS (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {start})"]
    for i in range(levels):
        out.append(f"""{name}{i + 1} AS (
  SELECT g, pos, digest, 1::BIGINT AS n FROM {name}{i} WHERE n = 1 UNION ALL
  SELECT *, count(*) OVER (PARTITION BY g) FROM (
    SELECT g, pos // 8 AS pos, sha256(string_agg(digest, '' ORDER BY pos)) AS digest
    FROM {name}{i} WHERE n > 1 GROUP BY g, pos // 8))""")
    return ",\n".join(out)


def _paths(name: str, rows: str, levels: int) -> str:
    """Siblings left and right of each row of (g, r) at each level, and whether it is climbed."""
    out = []
    for i in range(levels):
        prev = rows if i == 0 else f"{name}_p{i - 1}"
        out.append(f"""{name}_p{i} AS (
  SELECT p.*, x.l AS l{i}, x.r AS r{i}, coalesce(x.up, FALSE) AS up{i} FROM {prev} p LEFT JOIN (
    SELECT a.g, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos)
                                FILTER (WHERE b.pos < a.pos), '') AS l,
           coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r,
           TRUE AS up
    FROM {name}{i} a JOIN {name}{i} b ON a.g = b.g AND a.pos // 8 = b.pos // 8
    WHERE a.n > 1 GROUP BY a.g, a.pos) x ON x.g = p.g AND x.pos = p.rank // {8 ** i})""")
    return ",\n".join(out)


def _fold_ctes(name: str, rows: str, levels: int) -> str:
    out = []
    for i in range(levels):
        prev = rows if i == 0 else f"{name}_f{i - 1}"
        out.append(f"""{name}_f{i} AS (SELECT * REPLACE (
  CASE WHEN up{i} THEN sha256(l{i} || node || r{i}) ELSE node END AS node,
  CASE WHEN up{i} THEN proof || l{i} || r{i} ELSE proof END AS proof) FROM {prev})""")
    return ",\n".join(out)


OP11 = f"""
WITH {_CRC_TABLE},
d AS (SELECT *, {_leaf('text')} AS leaf,
             CASE WHEN {_crc32(_hex_pairs('doc_id::VARCHAR'))} % 3 = 0 THEN {_leaf(
                 "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
             END AS lowered,
             CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g FROM documents, crc),
rows_ AS (SELECT doc_id, leaf, coalesce(lowered, leaf) AS node, '' AS proof, g,
                 row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank
          FROM d),
first_ AS (SELECT g, rank AS pos, leaf AS digest FROM rows_),
{_climb('t', 'first_', MERKLE_LEVELS)},
subs AS (SELECT g AS part, digest AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS place
         FROM t{MERKLE_LEVELS}),
tops AS (SELECT '' AS g, place AS pos, subroot AS digest FROM subs),
{_climb('s', 'tops', MERKLE_TOP_LEVELS)},
{_paths('t', 'rows_', MERKLE_LEVELS)},
{_fold_ctes('t', f't_p{MERKLE_LEVELS - 1}', MERKLE_LEVELS)},
mid AS (SELECT doc_id, leaf, node, proof, subroot, place AS rank, '' AS g
        FROM t_f{MERKLE_LEVELS - 1} f JOIN subs ON subs.part = f.g),
{_paths('s', 'mid', MERKLE_TOP_LEVELS)},
{_fold_ctes('s', f's_p{MERKLE_TOP_LEVELS - 1}', MERKLE_TOP_LEVELS)}
SELECT doc_id, leaf, subroot, (SELECT digest FROM s{MERKLE_TOP_LEVELS}) AS root,
       sha256(proof) AS proof_sha256, node AS folded_root,
       node = (SELECT digest FROM s{MERKLE_TOP_LEVELS}) AS verified
FROM s_f{MERKLE_TOP_LEVELS - 1}
"""


def _jumps(shards: int) -> str:
    return f"""walk{shards} AS (
  SELECT n, seed, 0::BIGINT AS shard, 0::BIGINT AS next FROM k
  UNION ALL
  SELECT n, s, next, floor((next + 1) * (2147483648::DOUBLE / ((s // 8589934592) + 1)::DOUBLE))::BIGINT
  FROM (SELECT n, next, ((seed::HUGEINT * 2862933555777941757 + 1)
                         % 18446744073709551616::HUGEINT)::HUGEINT AS s
        FROM (SELECT n, next, seed % 18446744073709551616::HUGEINT AS seed FROM walk{shards}
              WHERE next < {shards}))),
jump{shards} AS (SELECT n, max(shard) AS shard FROM walk{shards} WHERE shard < {shards} GROUP BY n)"""


OP13 = f"""
WITH RECURSIVE {_CRC_TABLE},
k AS (SELECT row_number() OVER () AS n, doc_id, text,
             CASE WHEN coalesce(doc_id, -1) < 0 THEN 18446744073709551616::HUGEINT
                  + coalesce(doc_id, -1) ELSE doc_id::HUGEINT END AS seed FROM documents),
{_jumps(SHARDS)},
{_jumps(SHARDS + 1)}
SELECT doc_id, (coalesce(strlen(text), 0) + 1)::BIGINT AS size,
       {_crc32(_hex_pairs('text'))}::BIGINT AS text_crc32, 'key' AS law, a.shard::INT AS shard,
       row_number() OVER (PARTITION BY a.shard ORDER BY coalesce(doc_id, -1)) - 1 AS slot,
       b.shard::INT AS grown_shard
FROM k JOIN jump{SHARDS} a ON a.n = k.n JOIN jump{SHARDS + 1} b ON b.n = k.n, crc
"""

ORACLE = {
    "op1_quote_threads": OP1,
    "op6_url_filters": OP6,
    "op8_line_frequency": OP8,
    "op10_mix_to_weights": OP10,
    "op11_merkle_manifest": OP11,
    "op13_jump_shards": OP13,
}
