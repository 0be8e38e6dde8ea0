"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from .curriculum_mix import Mix, _segments
from .hash_tree import TREE, Tree, grown
from .merkle_manifest import FANOUT, FIELDS, LOWER, UPPER
from .quality_rules import MAX_REPEAT_PERCENT, MIN_GROUP, MIN_WORDS, SHARES, SPREADS

#: Measures of each document, straight from the definitions: windows are rows.
MEASURES = r"""
spread AS (
  SELECT rowid AS r, doc_id, lang, source, coalesce(text, '') AS body,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM (SELECT *, row_number() OVER () AS rowid FROM {docs})),
places AS (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM spread WHERE len(ws) >= 5),
windows AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] || ' ' || ws[i + 4] AS w FROM places),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r),
measured AS (
  SELECT s.r, doc_id, lang, source, len(ws) AS n_words,
         CASE WHEN len(ws) = 0 THEN 0 ELSE length(array_to_string(ws, '')) END AS word_chars,
         length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words
  FROM spread s LEFT JOIN covered c ON c.r = s.r),
failing AS (
  SELECT *, n_words < {min_words} OR 100 * n_repeat_words > {max_repeat} * n_words AS base_failed,
         {shares}
  FROM measured)
"""


def _shares() -> str:
    return "\nUNION ALL ".join(
        f"SELECT lang, source, '{k}' AS share, {k} AS v, {x.margin} AS least FROM failing WHERE NOT base_failed"
        for k, x in SHARES.items())


def _fence(level: str, keys: str) -> str:
    """Fences of one level from the sorted values, each rounded up to its bucket's top."""
    part = ", ".join(x for x in (keys, "share") if x)
    return f"""{level} AS (
  SELECT {part}, max(total) AS total,
         min(CASE WHEN 2 * upto >= total THEN top END) + greatest(max(least),
           {SPREADS} * (min(CASE WHEN 2 * upto >= total THEN top END) - min(CASE WHEN 10 * upto >= total THEN top END))) AS fence
  FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY v) AS upto, count(*) OVER (PARTITION BY {part}) AS total FROM tops)
  GROUP BY {part})"""


def quality_ctes(docs: str) -> str:
    """CTEs that end in ``judged``: each document's measures and verdict."""
    parts = ",\n         ".join(f"CASE WHEN {x.per} > 0 THEN {x.scale} * {x.of} // {x.per} ELSE 0 END AS {k}" for k, x in SHARES.items())
    beyond = [f"coalesce({x.scale} * d.{x.of} - w.f_{k} * d.{x.per} >= {x.scale * x.units}, false)" for k, x in SHARES.items()]
    return MEASURES.format(docs=docs, min_words=MIN_WORDS, max_repeat=MAX_REPEAT_PERCENT, shares=parts) + f""",
shares AS ({_shares()}),
bits AS (SELECT *, greatest(length(bin(v)) - 7, 0) AS s FROM shares),
tops AS (SELECT lang, source, share, v, least, CASE WHEN s = 0 THEN v ELSE (v // (1 << s) + 1) * (1 << s) - 1 END AS top FROM bits),
{_fence('own', 'lang, source')},
{_fence('by_lang', 'lang')},
{_fence('overall', '')},
chosen AS (
  SELECT o.lang, o.source, o.share, CASE WHEN o.total >= {MIN_GROUP} THEN o.fence
         WHEN l.total >= {MIN_GROUP} THEN l.fence ELSE a.fence END AS fence
  FROM own o JOIN by_lang l ON l.share = o.share AND l.lang IS NOT DISTINCT FROM o.lang
  JOIN overall a ON a.share = o.share),
wide AS (SELECT lang, source, {', '.join(f"max(CASE WHEN share = '{k}' THEN fence END) AS f_{k}" for k in SHARES)}
  FROM chosen GROUP BY lang, source),
judged AS (
  SELECT d.*, NOT (base_failed OR {' OR '.join(beyond)}) AS kept
  FROM failing d LEFT JOIN wide w ON w.lang IS NOT DISTINCT FROM d.lang AND w.source IS NOT DISTINCT FROM d.source)"""


def _time(share: str, mix: Mix) -> str:
    """Inverse of the cumulative demand, schedule by schedule."""
    out = []
    for k, shape in enumerate(mix.schedules):
        time = ""
        for t, done, w, slope, _ in reversed(_segments(shape)):
            left = f"greatest({share} - {done!r}::DOUBLE, 0::DOUBLE)"
            x = (f"2 * {left} / ({w!r}::DOUBLE + sqrt(greatest({w * w!r}::DOUBLE + "
                 f"{2 * slope!r}::DOUBLE * {left}, 0::DOUBLE)))")
            time += f"WHEN {share} >= {done!r}::DOUBLE THEN {t!r}::DOUBLE + CASE WHEN {left} > 0 THEN {x} ELSE 0 END "
        out.append(f"WHEN rank % {len(mix.schedules)} = {k} THEN least(CASE {time} END, 1::DOUBLE)")
    return f"CASE {' '.join(out)} END"


def mix_sql(mix: Mix = Mix()) -> str:
    weight = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mix.weights))
    taken = " + ".join(f"greatest(0, least(size, goal - (start + {e} * source_size)))" for e in range(mix.max_epochs))
    positions = ", ".join(
        f"CASE WHEN taken > 0 AND start + {e} * source_size < goal THEN "
        + _time(f"((start + {e} * source_size) / greatest(target, 1::DOUBLE))", mix) + f" END AS position_{e + 1}"
        for e in range(mix.max_epochs))
    return rf"""WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k, md5(coalesce(doc_id::VARCHAR, '')) AS h,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size
  FROM documents),
streams AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY k ORDER BY h, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM sized),
sources AS (SELECT k, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY k) - 1 AS rank FROM sized GROUP BY k),
weighted AS (SELECT *, CASE rank % {len(mix.weights)} {weight} END AS w, {mix.max_epochs} * source_size AS cap FROM sources),
levels AS (SELECT *, ((SELECT sum(source_size) FROM sources)::BIGINT * {mix.total_percent} / 100::DOUBLE
      - coalesce(sum(cap) OVER before, 0)::BIGINT)
    / ((SELECT sum(w) FROM weighted)::BIGINT - coalesce(sum(w) OVER before, 0)::BIGINT) AS lv, cap / w::DOUBLE AS fill
  FROM weighted WINDOW before AS (ORDER BY cap / w::DOUBLE, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT lv AS l FROM levels WHERE lv * w <= cap ORDER BY fill, rank LIMIT 1),
goals AS (SELECT k, source_size, rank, least(cap::DOUBLE, coalesce((SELECT l FROM level) * w, cap::DOUBLE)) AS target FROM levels),
placed AS (SELECT *, ({taken})::BIGINT AS taken FROM
  (SELECT s.*, source_size, rank, target, round(target)::BIGINT AS goal FROM streams s JOIN goals g ON g.k = s.k))
SELECT doc_id, size, source_size, target, taken, {positions} FROM placed"""


def _crc_table() -> list[int]:
    """Of the reversed polynomial 0xEDB88320, as the definition of CRC-32 builds it."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    return table


def crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a SQL string that is not null, byte by byte."""
    bytes_ = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), lambda c, b: "
            f"xor(c >> 8, ({_crc_table()}::BIGINT[])[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)")


def _descent(tree: Tree, column: str) -> str:
    """CTEs down a tree level by level; the last, named ``column``, has (r, column)."""
    level, ctes, before, k = [tree.root], [], None, 0
    while children := [(n.name, c) for n in level for c in n.children if c.weight > 0]:
        rows = ", ".join(f"({i}, '{up}', '{c.name}', {c.weight!r}::DOUBLE, {'NULL' if c.shard is None else c.shard}::INT)"
                         for i, (up, c) in enumerate(children))
        at = f"{column}_{k}"
        start = "(SELECT r, key, 'root' AS name FROM sized)" if before is None else before
        ctes.append(f"""{at} AS (SELECT r, key, child AS name, shard FROM (
  SELECT s.r, s.key, v.child, v.shard, row_number() OVER (PARTITION BY s.r ORDER BY
    -ln((('0x' || substr(md5(v.child || ':' || s.key), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / v.weight, v.i) AS best
  FROM {start} s JOIN (VALUES {rows}) v(i, up, child, weight, shard) ON v.up = s.name) WHERE best = 1)""")
        level, before, k = [c for _, c in children], at, k + 1
    # the trees of the query have their shards on one level
    return ",\n".join([*ctes, f"{column} AS (SELECT r, shard AS {column} FROM {before})"])


def shards_sql(tree: Tree = TREE, more: int = 24) -> str:
    return f"""WITH sized AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id::VARCHAR, '') AS key,
  strlen(coalesce(text, ''))::BIGINT + 8 AS size, {crc32("coalesce(text, '')")} AS text_crc32 FROM documents),
{_descent(tree, 'shard')},
{_descent(grown(tree, more), 'grown_shard')}
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard
    ORDER BY md5(key), doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
FROM sized JOIN shard USING (r) JOIN grown_shard USING (r)"""


#: Levels of the trees in SQL: sources of up to FANOUT ** 5 rows, and as many sources.
SQL_LEVELS = 5


def _levels(nodes: str, name: str) -> str:
    """CTEs of the runs of each level above ``nodes`` (tree, pos, digest, n): (tree, run, digests, digest, n)."""
    out, below = [], nodes
    for k in range(SQL_LEVELS):
        out.append(f"""{name}{k} AS (SELECT tree, run AS pos, digests, sha256(array_to_string(digests, '')) AS digest, n
  FROM (SELECT tree, pos // {FANOUT} AS run, list(digest ORDER BY pos) AS digests, (any_value(n) + {FANOUT - 1}) // {FANOUT} AS n
        FROM {below} WHERE n > 1 GROUP BY tree, pos // {FANOUT}))""")
        below = f"{name}{k}"
    return ",\n".join(out)


def _roots(nodes: str, name: str) -> str:
    return " UNION ALL ".join(f"SELECT tree, digest FROM {x} WHERE n = 1" for x in [nodes, *(f"{name}{k}" for k in range(SQL_LEVELS))])


def _climb(start: str, name: str, tree: str, at: str) -> str:
    """CTEs that fold level by level: ``now`` takes its slot's place, ``others`` grows by the siblings."""
    out, below = [], start
    for k in range(SQL_LEVELS):
        out.append(f"""{name}_up{k} AS (SELECT c.* EXCLUDE ({at}, now, others), c.{at} // {FANOUT} AS {at},
  CASE WHEN u.tree IS NULL THEN c.now ELSE sha256(array_to_string(u.digests[:c.{at} % {FANOUT}], '') || c.now
    || array_to_string(u.digests[c.{at} % {FANOUT} + 2:], '')) END AS now,
  CASE WHEN u.tree IS NULL THEN c.others ELSE c.others || array_to_string(u.digests[:c.{at} % {FANOUT}], '')
    || array_to_string(u.digests[c.{at} % {FANOUT} + 2:], '') END AS others
  FROM {below} c LEFT JOIN {name}{k} u ON u.tree = c.{tree} AND u.pos = c.{at} // {FANOUT})""")
        below = f"{name}_up{k}"
    return ",\n".join(out)


def merkle_sql() -> str:
    def leaf(text: str) -> str:
        parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in (*FIELDS[:-1], text)]
        return f"sha256({' || '.join(parts)})"

    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    last = SQL_LEVELS - 1
    return f"""WITH given AS (SELECT doc_id, coalesce('1' || source, '0') AS tree, {leaf('text')} AS digest,
  CASE WHEN doc_id IS NOT NULL AND {crc32("coalesce(doc_id::VARCHAR, '')")} % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS now
  FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
  count(*) OVER (PARTITION BY tree) AS n FROM given),
{_levels('leaves', 's')},
subroots AS ({_roots('leaves', 's')}),
tops AS (SELECT '' AS tree, tree AS source, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM subroots),
{_levels('tops', 't')},
root AS ({_roots('tops', 't')}),
begun AS (SELECT l.doc_id, l.digest AS leaf, l.tree, l.pos, l.now, '' AS others, t.digest AS subroot, t.pos AS top, '' AS whole
  FROM leaves l JOIN tops t ON t.source = l.tree),
{_climb('begun', 's', 'tree', 'pos')},
{_climb(f's_up{last}', 't', 'whole', 'top')}
SELECT doc_id, leaf, subroot, root.digest AS root, sha256(others) AS proof_sha256, now AS folded_root, now = root.digest AS verified
FROM t_up{last} CROSS JOIN root"""


ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": f"""WITH {quality_ctes('documents')}
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, kept FROM judged""",
    "op7_curriculum_mix": mix_sql(),
    "op8_hash_tree": shards_sql(),
    "op12_merkle_manifest": merkle_sql(),
    "op10_mph_dedup": """
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       coalesce(doc_id = max(doc_id) OVER (PARTITION BY h), max(doc_id) OVER (PARTITION BY h) IS NULL) AS kept, h AS text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents)""",
}
