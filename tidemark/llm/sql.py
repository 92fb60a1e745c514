"""SQL counterparts of the numbered operators."""

from __future__ import annotations

EXACT_DEDUP_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY content ORDER BY points DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       row_number() OVER (PARTITION BY content ORDER BY points DESC, doc_id) = 1 AS kept,
       sha256(content) AS text_sha256
FROM d
"""

MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source
), w AS (
  SELECT *, CAST(rank % 3 + 1 AS DOUBLE) AS weight FROM s
), c AS (
  SELECT *, 3.0::DOUBLE * source_size / weight AS ceiling,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weights FROM w
), b AS (
  SELECT *, coalesce(sum(source_size) OVER before, 0) AS sizes_before,
         coalesce(sum(weight) OVER before, 0) AS weights_before
  FROM c WINDOW before AS (ORDER BY ceiling, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT *, (CAST(total AS DOUBLE) - 3.0::DOUBLE * CAST(sizes_before AS DOUBLE)) / (all_weights - weights_before) AS level
  FROM b
), t AS (
  SELECT source, source_size, rank,
         CASE WHEN level > ceiling THEN 3.0::DOUBLE * source_size
              ELSE (SELECT arg_min(m.level, (m.ceiling, m.rank)) FROM l m WHERE m.level <= m.ceiling) * weight
         END AS target
  FROM l
), p AS (
  SELECT d.doc_id, d.size, t.*,
         coalesce(sum(size) OVER (
           PARTITION BY d.source ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
         ), 0) + size / 2.0::DOUBLE AS middle
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), q AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM p
), r AS (
  SELECT *, passes + CASE WHEN middle <= target - passes * source_size THEN 1 ELSE 0 END AS copies,
         CASE WHEN target > 0 THEN least(middle / target, 1.0::DOUBLE) ELSE 0.0::DOUBLE END AS share
  FROM q
), k(class, start_at, end_at, rate, slope, before, after) AS (VALUES {segments}
), m AS (
  SELECT r.*, k.*, row_number() OVER (PARTITION BY r.doc_id ORDER BY k.after) AS piece
  FROM r JOIN k ON k.class = r.rank % 3 AND r.share <= k.after
)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies,
       CASE WHEN copies > 0 THEN
         start_at + 2.0::DOUBLE * (share - before)
           / (rate + sqrt(greatest(rate * rate + 2.0::DOUBLE * slope * (share - before), 0.0::DOUBLE)))
       END AS first_position
FROM m WHERE piece = 1
"""

SUBSTRING_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS (
  SELECT doc_id, place, md5(array_to_string(words[place : place + 49], ' ')) AS window_md5
  FROM (SELECT *, unnest(range(1, len(words) - 48)) AS place FROM d)
), s AS (
  SELECT window_md5, min(doc_id) AS least FROM w GROUP BY window_md5 HAVING min(doc_id) <> max(doc_id)
), r AS (
  SELECT w.doc_id, list(DISTINCT p) AS removed
  FROM w JOIN s USING (window_md5), unnest(range(w.place, w.place + 50)) AS u(p)
  WHERE w.doc_id > s.least GROUP BY w.doc_id
), k AS (
  SELECT d.doc_id, d.words, r.removed, unnest(range(1, len(d.words) + 1)) AS p FROM d JOIN r USING (doc_id)
), t AS (
  SELECT doc_id, string_agg(words[p], ' ' ORDER BY p) FILTER (NOT list_contains(removed, p)) AS kept FROM k GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(len(r.removed), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN r.removed IS NULL THEN array_to_string(d.words, ' ') ELSE coalesce(t.kept, '') END) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN t USING (doc_id)
"""

WARC_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS sha FROM pages
), b AS (
  SELECT *, list_reduce(
              list_prepend('', list_transform(regexp_extract_all(sha, '.'), lambda c:
                right('000' || bin(position(c IN '0123456789abcdef') - 1), 4))),
              lambda a, c: a || c) AS bits
  FROM p
), d AS (
  SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
         array_to_string(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + list_sum(list_transform(range(0, 5), lambda j:
                        CASE WHEN substr(bits, CAST(5 * i + j + 1 AS BIGINT), 1) = '1' THEN 1 << (4 - j) ELSE 0 END))::BIGINT, 1)), '') AS payload_digest
  FROM b
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to,
       true AS digest_holds
FROM f
"""

CHAT_SQL = r"""
WITH m AS (
  SELECT *, conv_id || ':' || turn AS own_id, conv_id || ':' || (turn - 1) AS asked_id FROM conversations
), steps AS (
  SELECT conv_id, turn, 'message' AS kind, NULL AS call_id, 'message' AS status, '' AS errors,
         '{"content":' || to_json(text) || ',"role":' || to_json(role) || '}' AS json,
         turn AS place, 0 AS depth, 0 AS part
  FROM m WHERE role <> 'assistant'
  UNION ALL
  SELECT c.conv_id, c.turn, 'call', c.own_id,
         CASE WHEN r.turn IS NULL THEN 'no result' ELSE 'linked' END, '',
         '{"arguments":{"prompt":' || to_json(c.text)
           || CASE WHEN c.role = 'user' AND c.turn % 2 = 1 THEN ',"system":"$result:' || c.conv_id || ':0"' ELSE '' END
           || ',"turn":' || c.turn || '},"id":' || to_json(c.own_id)
           || ',"name":"' || CASE WHEN c.role = 'user' THEN 'reply' ELSE 'configure' END || '"}',
         c.turn, CASE WHEN c.role = 'user' AND c.turn % 2 = 1 AND s.turn IS NOT NULL THEN 1 ELSE 0 END, 1
  FROM m c
  LEFT JOIN m r ON r.conv_id = c.conv_id AND r.role = 'assistant' AND r.asked_id = c.own_id
  LEFT JOIN m s ON s.conv_id = c.conv_id AND s.turn = 0 AND s.role <> 'assistant'
  WHERE c.role <> 'assistant'
  UNION ALL
  SELECT r.conv_id, r.turn, 'result', r.asked_id, CASE WHEN c.turn IS NULL THEN 'no call' ELSE 'linked' END, '',
         '{"content":' || to_json(r.text) || ',"id":' || to_json(r.asked_id) || ',"role":"assistant"}',
         coalesce(c.turn, r.turn),
         CASE WHEN c.role = 'user' AND c.turn % 2 = 1 AND s.turn IS NOT NULL THEN 1 ELSE 0 END, 1
  FROM m r
  LEFT JOIN m c ON c.conv_id = r.conv_id AND c.role <> 'assistant' AND c.own_id = r.asked_id
  LEFT JOIN m s ON s.conv_id = r.conv_id AND s.turn = 0 AND s.role <> 'assistant'
  WHERE r.role = 'assistant'
)
SELECT *, 0 AS number FROM steps
"""


def _segment_rows() -> str:
    from tidemark.llm.mixing import SCHEDULES, segments

    return ", ".join(
        f"({i}, " + ", ".join(f"{v!r}::DOUBLE" for v in piece) + ")"
        for i, schedule in enumerate(SCHEDULES)
        for piece in segments(schedule)
    )


MIXING_SQL = MIXING_SQL.replace("{segments}", _segment_rows())


def manifest_sql(arity: int = 8, levels: int = 12, top_levels: int = 4) -> str:
    """The Merkle manifest, one CTE per level: enough for ``arity ** levels`` rows a language
    and ``arity ** top_levels`` languages."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    mark = lambda c, v: (
        f"coalesce(CAST(strlen(CAST({v} AS VARCHAR)) AS VARCHAR) || ':' || CAST({v} AS VARCHAR), '-')"
    )
    leaf = lambda text: "sha256(" + " || ".join(
        mark(c, text if c == "text" else c) for c in ("doc_id", "source", "lang", "n_chars", "text")
    ) + ")"
    bit = "lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1))"
    byte = f"lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), {bit})"
    digits = "list_transform(regexp_extract_all(CAST(doc_id AS VARCHAR), '.'), lambda d: CAST(ord(d) AS BIGINT))"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), {byte}), 4294967295::BIGINT)"
    parts = [
        f"""d AS (
  SELECT doc_id, lang, {leaf("text")} AS leaf,
         CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} END AS claimed
  FROM documents
), a0 AS (
  SELECT doc_id, lang, leaf, coalesce(claimed, leaf) AS folded, leaf AS node, '' AS proof,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM d
)"""
    ]

    def climb(k: int, before: str, group: str, carried: str) -> str:
        """A row keeps its own node, siblings and folded value; a level is made of the nodes
        that stand at ``pos``, once each."""
        run = f"r.{group} IS NOT DISTINCT FROM x.{group} AND r.run = x.pos // {arity}"
        return f"""n{k} AS (
  SELECT DISTINCT {group}, pos, node, n FROM {before}
), r{k} AS (
  SELECT {group}, pos // {arity} AS run, list(node ORDER BY pos) AS nodes FROM n{k} GROUP BY ALL
), a{k + 1} AS (
  SELECT {carried},
         CASE WHEN x.n > 1 THEN sha256(array_to_string(list_concat(r.nodes[: x.pos % {arity}], [x.folded], r.nodes[x.pos % {arity} + 2 :]), ''))
              ELSE x.folded END AS folded,
         CASE WHEN x.n > 1 THEN sha256(array_to_string(r.nodes, '')) ELSE x.node END AS node,
         CASE WHEN x.n > 1 THEN x.proof || array_to_string(list_concat(r.nodes[: x.pos % {arity}], r.nodes[x.pos % {arity} + 2 :]), '')
              ELSE x.proof END AS proof,
         CASE WHEN x.n > 1 THEN x.pos // {arity} ELSE x.pos END AS pos,
         CASE WHEN x.n > 1 THEN (x.n + {arity - 1}) // {arity} ELSE x.n END AS n
  FROM {before} x JOIN r{k} r ON {run}
)"""

    for k in range(levels):
        parts.append(climb(k, f"a{k}", "lang", "x.doc_id, x.lang, x.leaf"))
    parts.append(
        f"""b{levels} AS (
  SELECT doc_id, leaf, node AS subroot, folded, node, proof, 0 AS one,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos
  FROM a{levels}
), t{levels} AS (
  SELECT *, max(pos) OVER () + 1 AS n FROM b{levels}
)"""
    )
    before = f"t{levels}"
    for k in range(levels, levels + top_levels):
        parts.append(climb(k, before, "one", "x.doc_id, x.leaf, x.subroot, x.one"))
        before = f"a{k + 1}"
    return "WITH " + ", ".join(parts) + f"""
SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = node AS verified
FROM {before}
"""
