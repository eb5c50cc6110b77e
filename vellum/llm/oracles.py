"""DuckDB SQL for the operators that SQL can express, under the keys of QUERIES."""

from __future__ import annotations

from vellum.llm.quality import RULES, STOP_WORDS, SYMBOLS

_W = r"[^\x20\x09-\x0D]+"


def _quality() -> str:
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    tests = " AND ".join(
        t for r in RULES for t in (
            [f"1000 * {r.part} >= {r.least} * {r.whole}"] if r.least is not None else [])
        + ([f"1000 * {r.part} <= {r.most} * {r.whole}"] if r.most is not None else []))
    return rf"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_W}') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_W}')) AS lines
  FROM documents),
grams AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM base)),
twice AS (SELECT rid, g FROM grams GROUP BY rid, g HAVING count(*) >= 2),
covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM grams JOIN twice USING (rid, g)) GROUP BY rid),
counts AS (
  SELECT doc_id, 1 AS one, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^{SYMBOLS}]', '', 'g'))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(words, lambda w: lower(w) IN ({stops})))::BIGINT AS n_stop_words
  FROM base LEFT JOIN covered USING (rid)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words, base_failed,
       NOT base_failed AND {tests} AS kept
FROM judged"""


_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, row_number() OVER w - 1 AS turn_no,
         concat(coalesce(lag(role) OVER w, '^'), '>', role) IN
           ('^>system', '^>user', 'system>user', 'user>assistant', 'assistant>user') AS ok,
         length(text) + len(regexp_extract_all(text, '[<\[]\\*(<SYS>>|</SYS>>|INST\]|/INST\]|s>|/s>|\|/?[A-Za-z0-9.*_+%-]+\|>)'))
           + 3 + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 END AS chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn_no) AS flat,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn_no), '') AS loss,
         sum(chars) AS formatted_chars, min(CASE WHEN NOT ok THEN turn_no END) AS first_bad_turn,
         arg_max(role, turn_no) AS last_role
  FROM marked GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(flat) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars,
       first_bad_turn IS NULL AND last_role = 'assistant' AS valid, first_bad_turn::INTEGER AS first_bad_turn
FROM joined"""


# The level is the one among the candidates (totals left after filling some
# sources, over the weights left) whose targets add up to all words.  MD5 gives
# both engines the same queue.
_MIX = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS o FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM sized GROUP BY source),
candidate AS (
  SELECT a.source, (SELECT sum(source_size) FROM src)
         - coalesce(sum(3 * b.source_size) FILTER (3.0 * b.source_size / b.w < 3.0 * a.source_size / a.w), 0) AS words,
         coalesce(sum(b.w) FILTER (3.0 * b.source_size / b.w >= 3.0 * a.source_size / a.w), 0) AS weight
  FROM src a, src b GROUP BY a.source, a.source_size, a.w),
level AS (
  SELECT any_value(level) AS level FROM (
    SELECT c.words / c.weight AS level, abs(sum(least(3.0 * source_size, c.words / c.weight * w)) - sum(source_size)) AS off,
           sum(source_size) AS total
    FROM candidate c, src GROUP BY c.source, c.words, c.weight) WHERE off <= 1e-9 * total),
target AS (SELECT source, source_size, w, least(3.0 * source_size, level * w)::DOUBLE AS target FROM src, level),
queue AS (
  SELECT s.*, source_size, target, w,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY o, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target, (size * len(begins))::BIGINT AS taken,
       CASE WHEN f IS NOT NULL THEN round(least(1.0, CASE w WHEN 1 THEN 2 * f / (0.5 + sqrt(0.25 + 2 * f)) WHEN 2 THEN f
                               ELSE CASE WHEN 3 * f > 1.8 THEN 0.5 + (3 * f - 1.8) / 2.4
                                         ELSE 2 * (3 * f) / (4.8 + sqrt(23.04 - 9.6 * (3 * f))) END END), 6) END AS first_position,
       CASE WHEN l IS NOT NULL THEN round(least(1.0, CASE w WHEN 1 THEN 2 * l / (0.5 + sqrt(0.25 + 2 * l)) WHEN 2 THEN l
                               ELSE CASE WHEN 3 * l > 1.8 THEN 0.5 + (3 * l - 1.8) / 2.4
                                         ELSE 2 * (3 * l) / (4.8 + sqrt(23.04 - 9.6 * (3 * l))) END END), 6) END AS last_position
FROM (SELECT *, begins[1] / target AS f, begins[len(begins)] / target AS l FROM (
  SELECT *, list_filter([start, start + source_size, start + 2 * source_size], lambda b: size > 0 AND 2 * b + size <= 2 * target) AS begins
  FROM queue))"""

_TOPK = """
WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT)), "
            "lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], "
            "lambda r, z: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)))")


def _repair() -> str:
    key = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    return rf"""
WITH RECURSIVE kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32(key)} % 20 AS kind FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 0 THEN [] WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kinds),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
marked AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '{_W}') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         left(role, 1) AS ini, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prev
  FROM placed),
inserts(st, mid, eds, said, price) AS (VALUES
  (0, 0, '', '', 0), (0, 2, 'I', 'user:' || chr(10), 3), (0, 3, 'II', 'user:' || chr(10) || 'assistant:' || chr(10), 6),
  (1, 1, '', '', 0), (1, 2, 'I', 'user:' || chr(10), 3), (1, 3, 'II', 'user:' || chr(10) || 'assistant:' || chr(10), 6),
  (2, 2, '', '', 0), (2, 3, 'I', 'assistant:' || chr(10), 3), (3, 3, '', '', 0), (3, 2, 'I', 'user:' || chr(10), 3)),
acts(mid, ed, need, st, role) AS (VALUES
  (0, 'D', '', 0, ''), (1, 'D', '', 1, ''), (2, 'D', '', 2, ''), (3, 'D', '', 3, ''),
  (0, 'K', 's', 1, ''), (0, 'K', 'u', 2, ''), (1, 'K', 'u', 2, ''), (2, 'K', 'a', 3, ''), (3, 'K', 'u', 2, ''),
  (0, 'R', '', 2, 'user'), (1, 'R', '', 2, 'user'), (2, 'R', '', 3, 'assistant'), (3, 'R', '', 2, 'user')),
best AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS st, struct_pack(cost := 0, audit := '', said := '') AS b FROM marked
  UNION ALL
  SELECT m.conv_id, m.i, a.st, min(struct_pack(
      cost := b.cost + n.price + CASE a.ed WHEN 'D' THEN 4 WHEN 'K' THEN 0 ELSE 3 END
              + CASE WHEN a.ed <> 'D' AND m.fault = 'truncated' THEN 3 ELSE 0 END,
      audit := b.audit || n.eds || a.ed,
      said := b.said || n.said || CASE a.ed WHEN 'D' THEN '' WHEN 'K' THEN m.role || ':' || m.text || chr(10)
                                            ELSE a.role || ':' || m.text || chr(10) END))
  FROM best JOIN marked m ON m.conv_id IS NOT DISTINCT FROM best.conv_id AND m.i = best.i + 1
  JOIN inserts n ON n.st = best.st JOIN acts a ON a.mid = n.mid
  WHERE (a.ed <> 'K' OR a.need = m.ini) AND (a.ed = 'D' OR m.fault NOT IN ('blank', 'duplicate'))
  GROUP BY m.conv_id, m.i, a.st),
told AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id),
ended AS (
  SELECT t.conv_id, min(struct_pack(cost := b.cost + n.price, audit := b.audit || n.eds, said := b.said || n.said)) AS e
  FROM told t JOIN best ON best.conv_id IS NOT DISTINCT FROM t.conv_id AND best.i = t.n
  JOIN inserts n ON n.st = best.st AND n.mid IN (0, 3) GROUP BY t.conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.cost, 0)::BIGINT AS cost,
       coalesce(e.audit, '') AS audit, sha256(coalesce(left(e.said, greatest(length(e.said) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM c.conv_id"""


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _secrets() -> str:
    names = "|".join([*map(_either_case, ("password", "passwd", "secret", "token")), _either_case("api") + "_?" + _either_case("key")])
    patterns = {
        "assign": rf"({names})[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)", "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+",
        "github": "gh[pousr]_[A-Za-z0-9]+", "npm": "npm_[A-Za-z0-9]+", "age": "AGE-SECRET-KEY-1[A-Z0-9]+"}
    # texts without a long enough run have none to report
    worth = {"hex": "[0-9a-f]{24}"}
    hits = " UNION ALL ".join(
        f"SELECT rid, '{k}' AS kind, {i} AS rank, regexp_extract_all(text, '{p}') AS m, regexp_split_to_array(text, '{p}') AS s "
        f"FROM d WHERE regexp_matches(text, '{worth.get(k, p)}')" for i, (k, p) in enumerate(patterns.items()))
    crc = _crc32("substr(w, 5, 30)")
    digits = "'0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'"
    base62 = " || ".join(f"substr({digits}, ((c // {62 ** (5 - i)}) % 62 + 1)::INT, 1)" for i in range(6))
    human = "age-secret-key-"
    before = ", ".join(map(str, [1, *(ord(c) >> 5 for c in human), 0, *(ord(c) & 31 for c in human)]))
    step = "xor((a % 33554432) * 32, b)"
    for i, g in enumerate((0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)):
        step = f"xor({step}, CASE WHEN (a // 33554432) // {1 << i} % 2 = 1 THEN {g} ELSE 0 END)"
    bech32 = (f"list_reduce(list_concat([{before}]::BIGINT[], list_transform(string_split(lower(substr(w, 17)), ''), "
              f"lambda ch: (strpos('qpzry9x8gf2tvdw0s3jn54khce6mua7l', ch) - 1)::BIGINT)), lambda a, b: {step})")
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
hits AS ({hits}),
each AS (SELECT rid, kind, rank, m, s, unnest(range(1, len(m) + 1)) AS i FROM hits),
put AS (
  SELECT rid, kind, rank, m[i] AS w,
         list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS a
  FROM each WHERE kind <> 'hex' OR length(m[i]) >= 24),
summed AS (SELECT *, CASE WHEN kind IN ('github', 'npm') AND length(w) = 40 THEN {crc} END AS c FROM put),
good AS (
  SELECT rid, kind, rank, a::BIGINT AS a, (a + length(w))::BIGINT AS z FROM summed
  WHERE CASE kind WHEN 'assign' THEN length(regexp_extract(w, '{patterns["assign"]}', 2)) >= 6 WHEN 'access' THEN length(w) >= 20
             WHEN 'hex' THEN true WHEN 'age' THEN CASE WHEN length(w) = 74 AND regexp_matches(substr(w, 17), '^[QPZRY9X8GF2TVDW0S3JN54KHCE6MUA7L]*$')
                                                       THEN {bech32} = 1 ELSE false END
             ELSE length(w) = 40 AND ({base62}) = substr(w, 35, 6) END),
told AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, rank) FILTER (rank < 3) AS base,
         string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, rank) AS spans
  FROM good GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (rid)"""


_TRIE = f"""
WITH said AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
         md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS id
  FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) - 1 AS place, id, chars FROM said),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS lender, {_crc32("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
rebuilt AS (
  SELECT c.conv_id, place, id, chars FROM c JOIN t ON t.conv_id = c.lender AND place < h
  UNION ALL SELECT conv_id, place + 5, id, chars FROM c JOIN t USING (conv_id) WHERE place >= h),
p AS (
  SELECT c.conv_id, coalesce(ids, []) AS ids, coalesce(chars, []) AS chars FROM c LEFT JOIN (
    SELECT conv_id, list(id ORDER BY place) AS ids, list(chars ORDER BY place) AS chars FROM rebuilt GROUP BY conv_id) USING (conv_id)),
m AS (
  SELECT conv_id, d, array_to_string(ids[1:d], '') AS name, CASE WHEN d = 0 THEN 0 ELSE chars[d] END AS chars, d = len(ids) AS ends
  FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM p)),
node AS (
  SELECT name, any_value(d) AS depth, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY name),
kids AS (SELECT left(name, 32 * (depth - 1)) AS name, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
full_node AS (SELECT node.*, coalesce(n, 0) AS n_children FROM node LEFT JOIN kids USING (name)),
above AS (SELECT *, left(name, 32 * unnest(range(0, depth + 1))) AS top FROM full_node),
sums AS (
  SELECT top, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens FROM above GROUP BY top)
SELECT f.conv_id, f.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM full_node f JOIN sums ON top = f.name
LEFT JOIN node u ON f.depth > 0 AND u.name = left(f.name, 32 * (f.depth - 1))"""

ORACLES: dict[str, str] = {
    "op1_chat_format": _CHAT,
    "op2_exact_topk": _TOPK,
    "op6_mix_sources": _MIX,
    "op9_quality_rules": _quality(),
    "op11_conversation_repair": _repair(),
    "op12_secret_scan": _secrets(),
    "op13_prefix_trie": _TRIE,
}
