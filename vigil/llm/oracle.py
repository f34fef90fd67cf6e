"""SQL on the same tables for the queries that SQL can express.

Written from the definitions: windows and pairs are all made, nothing is
hashed, cut into groups or searched by candidates.
"""

from __future__ import annotations

from vigil.llm.license_scan import BASE_RULE, PHRASES, signature_rules

LLM_ORACLE: dict[str, str] = {}

LLM_ORACLE["op10_exact_dedup"] = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_chars,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
    FROM documents
),
g AS (
    SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

LLM_ORACLE["op7_embedding_dedup"] = r"""
WITH RECURSIVE e AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98
),
reach(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT c.vec_id, (SELECT count(*) FROM link WHERE link.a = c.vec_id) AS n_links, component_id, c.vec_id = component_id AS kept FROM c
"""

LLM_ORACLE["op9_suffix_dedup"] = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT doc_id, h, CAST(length(h) // 2 AS BIGINT) AS n_bytes FROM d),
w AS (SELECT doc_id, i, substring(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(n_bytes - 49)) AS i FROM n) x),
late AS (SELECT doc_id, i FROM w QUALIFY min(doc_id) OVER (PARTITION BY s) < doc_id),
runs AS (SELECT doc_id, i, sum(CAST(coalesce(i > before + 50, true) AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS run
         FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM late) y),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY doc_id, run),
edges AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS last,
          row_number() OVER (PARTITION BY doc_id ORDER BY a DESC) = 1 AS final FROM spans),
cut AS (SELECT e.doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans,
          string_agg(substring(h, 2 * last + 1, 2 * (a - last)) || CASE WHEN final THEN substring(h, 2 * b + 1) ELSE '' END, '' ORDER BY a) AS kept
        FROM edges e JOIN n ON e.doc_id = n.doc_id GROUP BY e.doc_id)
SELECT n.doc_id AS doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM n LEFT JOIN cut ON n.doc_id = cut.doc_id
"""

LLM_ORACLE["op2_near_dedup"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
),
bags AS (
    SELECT doc_id, s, count(*) AS c FROM (
        SELECT doc_id, array_to_string(w[i : i + 4], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0) x
    ) y GROUP BY doc_id, s
),
sizes AS (SELECT doc_id, sum(c) AS n, md5(string_agg(s || ':' || c, '|' ORDER BY s)) AS bag FROM bags GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, a.c AS cx, b.c AS cy, a.c / b.c AS r
    FROM bags a JOIN bags b ON a.s = b.s AND a.doc_id < b.doc_id
),
near AS (
    SELECT x, y, sum(cx) AS tx, sum(cy) AS ty FROM common JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id
    GROUP BY x, y HAVING sum(least(cx / p.n, cy / q.n)) >= 0.79
),
terms AS (
    SELECT c.x, c.y, cx, cy, tx - sum(cx) OVER upto AS above, sum(cy) OVER upto AS below, p.n - tx AS only_x, q.n - ty AS only_y
    FROM common c JOIN near k ON c.x = k.x AND c.y = k.y JOIN sizes p ON c.x = p.doc_id JOIN sizes q ON c.y = q.doc_id
    WINDOW upto AS (PARTITION BY c.x, c.y ORDER BY r RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
link AS (
    SELECT x, y FROM terms GROUP BY x, y HAVING sum(1 / ((above + only_x) / cx + (below + only_y) / cy)) >= 0.8
),
both_ways AS (SELECT x AS a, y AS b FROM link UNION ALL SELECT y, x FROM link),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
component AS (SELECT a AS doc_id, min(b) AS group_id, count(*) AS group_size FROM reach GROUP BY a)
SELECT k.doc_id AS doc_id, min(k.doc_id) OVER (PARTITION BY coalesce(bag, k.doc_id::VARCHAR)) * CASE WHEN bag IS NULL THEN NULL ELSE 1 END AS class_id,
  group_id, group_size, k.doc_id = group_id AS kept
FROM component k LEFT JOIN sizes s ON k.doc_id = s.doc_id
"""


def _license_scan() -> str:
    """Two spaces between words, so that matches next to each other each have their own."""

    def spaced(pattern: str) -> str:
        return pattern.replace("(?<= )", "").replace("(?= )", "").replace(" ?", "~?").replace(" ", "  ").replace("~?", "(?:  )?")

    rules = [(BASE_RULE, label, phrase, 1.0) for phrase, label in PHRASES.items()]
    rules += [(r.priority, r.label, r.pattern, r.sure) for r in signature_rules()]
    values = ",\n  ".join(f"({i}, {priority}, '{label}', ' {spaced(pattern)} ', {sure})" for i, (priority, label, pattern, sure) in enumerate(rules))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH rules(rule, priority, label, pattern, sure) AS (VALUES
  {values}),
words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
lines AS (SELECT doc_id, len(w) AS n_words, ' ' || array_to_string(w, '  ') || ' ' AS line FROM words),
parts AS (
    SELECT doc_id, rule, priority, label, sure, string_split_regex(line, pattern) AS gaps, regexp_extract_all(line, pattern) AS found
    FROM lines JOIN rules ON regexp_matches(line, pattern)),
places AS (
    SELECT doc_id, rule, priority, label, sure, len(found[k]) AS width,
      CAST(list_sum(list_transform(gaps[1:k], lambda g: len(g))) + coalesce(list_sum(list_transform(found[1:k - 1], lambda m: len(m))), 0) AS BIGINT) AS a
    FROM (SELECT *, unnest(range(1, len(found) + 1)) AS k FROM parts) x),
kept AS (
    SELECT * FROM places d WHERE priority = {BASE_RULE} OR NOT EXISTS (
      SELECT 1 FROM places e WHERE e.doc_id = d.doc_id AND e.a <= d.a AND d.a + d.width <= e.a + e.width
        AND (e.width > d.width OR e.priority < d.priority))),
base AS (
    SELECT k.doc_id AS doc_id, label, CAST(len(string_split(substring(line, 1, a), '  ')) - CAST(a = 0 AS INT) AS BIGINT) AS place
    FROM kept k JOIN lines l ON k.doc_id = l.doc_id WHERE priority = {BASE_RULE}),
base_rows AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
all_rows AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(sure) AS score FROM kept GROUP BY doc_id)
SELECT l.doc_id AS doc_id, CAST(n_words AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM lines l LEFT JOIN base_rows b ON l.doc_id = b.doc_id LEFT JOIN all_rows r ON l.doc_id = r.doc_id
"""


LLM_ORACLE["op1_license_scan"] = _license_scan()


def _mix_sources(block: int = 8, ceiling: int = 3, shard_rows: int = 2000, seed: int = 42) -> str:
    """Every seat has its quotient here, and the highest are taken."""

    def drawn(n: int, *parts: str) -> str:
        return f"CAST('0x' || substring(md5(concat_ws(':', '{n}', {', '.join(parts)})), 1, 15) AS BIGINT)"

    return rf"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
      {drawn(seed, 'doc_id')} AS place, {drawn(seed + 1, 'doc_id')} AS deal
    FROM documents),
totals AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(ceil(count(*) / {shard_rows}.0) AS BIGINT) AS n_shards,
      row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth
    FROM sized GROUP BY source),
weighed AS (SELECT *, nth % 3 + 1 AS weight, {ceiling} * source_size AS most, sum(source_size) OVER () AS everything FROM totals),
running AS (
    SELECT *, everything - coalesce(sum(most) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
      sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
    FROM weighed WINDOW w AS (ORDER BY most / weight, nth)),
sources AS (
    SELECT source, source_size, n_shards, nth, everything,
      CASE WHEN most * weights <= weight * rest THEN CAST(most AS DOUBLE)
        ELSE CAST(weight * max(rest) FILTER (WHERE most * weights > weight * rest) OVER () AS DOUBLE)
          / CAST(max(weights) FILTER (WHERE most * weights > weight * rest) OVER () AS DOUBLE) END AS target
    FROM running),
dealt AS (SELECT d.*, deal % n_shards AS shard FROM sized d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source),
shards AS (
    SELECT source, shard, CAST(sum(size) AS BIGINT) AS shard_size, CAST(ceil(sum(size) / {block}.0) AS BIGINT) AS n_blocks
    FROM dealt GROUP BY source, shard),
room AS (SELECT source, sum(n_blocks) AS n_blocks FROM shards GROUP BY source),
source_seats AS (
    SELECT source, count(*) AS blocks FROM (
      SELECT source, row_number() OVER (ORDER BY target / (2 * seat + 1) DESC, nth, seat) AS rank, everything
      FROM (SELECT s.*, unnest(range(CAST({ceiling} * n_blocks AS BIGINT))) AS seat
            FROM sources s JOIN room r ON s.source IS NOT DISTINCT FROM r.source WHERE target > 0) x) y
    WHERE rank <= floor(everything / {block} + 0.5) GROUP BY source),
shard_seats AS (
    SELECT source, shard, count(*) AS quota FROM (
      SELECT source, shard, blocks, row_number() OVER (PARTITION BY source ORDER BY shard_size / (2 * seat + 1) DESC, shard, seat) AS rank
      FROM (SELECT h.*, blocks, unnest(range({ceiling} * n_blocks)) AS seat
            FROM shards h JOIN source_seats q ON h.source IS NOT DISTINCT FROM q.source WHERE shard_size > 0) x) y
    WHERE rank <= blocks GROUP BY source, shard),
laid AS (
    SELECT d.doc_id, d.source, size, n_blocks, coalesce(quota, 0) AS quota,
      sum(size) OVER (PARTITION BY d.source, d.shard ORDER BY place, d.doc_id ROWS UNBOUNDED PRECEDING) AS upto,
      {drawn(seed + 2, 'd.source', 'd.shard')} AS start
    FROM dealt d JOIN shards h ON d.source IS NOT DISTINCT FROM h.source AND d.shard = h.shard
    LEFT JOIN shard_seats q ON d.source IS NOT DISTINCT FROM q.source AND d.shard = q.shard),
turned AS (
    SELECT *, CASE WHEN n_blocks > 0 THEN quota // n_blocks ELSE 0 END AS passes, CASE WHEN n_blocks > 0 THEN start % n_blocks ELSE 0 END AS a FROM laid),
chosen AS (SELECT *, a + quota - passes * n_blocks AS b FROM turned)
SELECT doc_id, size, source_size, target,
  CAST(size * passes + greatest(0, least(upto, b * {block}) - greatest(upto - size, a * {block}))
    + greatest(0, least(upto, (b - n_blocks) * {block}) - (upto - size)) AS BIGINT) AS taken
FROM chosen c JOIN sources s ON c.source IS NOT DISTINCT FROM s.source
"""


LLM_ORACLE["op6_mix_sources"] = _mix_sources()


def _window_dedup(window: int = 35) -> str:
    """Every window as text, each word with the windows that may cover it."""
    return rf"""
WITH docs AS (
    SELECT row_number() OVER () AS nth, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (SELECT nth, words, unnest(range(1, len(words) + 1)) AS k FROM docs),
windows AS (
    SELECT nth, k, words[k] AS word, CASE WHEN k + {window - 1} <= len(words) THEN md5(array_to_string(words[k:k + {window - 1}], ' ')) END AS content
    FROM places),
marked AS (
    SELECT *, content IS NOT NULL AND count(*) OVER (PARTITION BY content) > 1 AS repeated FROM windows),
covered AS (
    SELECT nth, k, word, bool_or(repeated) OVER (PARTITION BY nth ORDER BY k ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW) AS gone FROM marked),
cut AS (
    SELECT nth, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY k) FILTER (WHERE NOT gone) AS kept
    FROM covered GROUP BY nth)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs d LEFT JOIN cut c ON d.nth = c.nth
"""


LLM_ORACLE["op13_window_dedup"] = _window_dedup()
