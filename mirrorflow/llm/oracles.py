"""SQL counterparts of the queries that SQL can express."""

QUALITY = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    length(regexp_replace(t, '[a-z]+', '', 'g')) AS r1,
    length(regexp_replace(t, '[a-z\x20\x09-\x0D]+', '', 'g')) AS r2,
    length(regexp_replace(t, '[a-zA-Z\x20\x09-\x0D]+', '', 'g')) AS r3,
    length(regexp_replace(t, '[a-zA-Z0-9\x20\x09-\x0D]+', '', 'g')) AS r4,
    length(regexp_replace(t, '[a-zA-Z0-9\x20\x09-\x0D.,;:!?''"()\-]+', '', 'g')) AS r5,
    length(regexp_replace(t, '[\x09-\x0D\x20-\x7E]+', '', 'g')) AS r6,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS n_symbols
  FROM d
), f AS (
  SELECT r, doc_id, lang, t, ws, len(ws) AS n, length(t) AS chars, n_symbols,
    [length(t) - r1, r1 - r2, r2 - r3, r3 - r4, r4 - r5, r5 - r6, r6] AS cs
  FROM w
), e AS (
  SELECT r, lang, n, unnest(ws) AS word, unnest(range(n)) AS i FROM f
), g AS (
  SELECT r, i, word, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM e
  WINDOW o AS (PARTITION BY r ORDER BY i)
), p AS (
  SELECT r, i FROM (
    SELECT r, i, count(*) OVER (PARTITION BY r, word, w2, w3) AS times FROM g WHERE w3 IS NOT NULL
  ) WHERE times > 1
), again AS (
  SELECT r, sum(least(3, coalesce(nxt - i, 3))) AS n_repeat
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM p) GROUP BY r
), lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM f)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), ref_n AS (
  SELECT lang, CAST(sum(n) AS BIGINT) AS total, [sum(cs[1]), sum(cs[2]), sum(cs[3]), sum(cs[4]), sum(cs[5]), sum(cs[6]), sum(cs[7])] AS sums
  FROM f WHERE n >= 50 GROUP BY lang HAVING sum(n) >= 1000
), ref_w AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY times DESC, word) AS rank
  FROM (SELECT lang, lower(word) AS word, count(*) AS times FROM e WHERE n >= 50 GROUP BY ALL)
  QUALIFY rank <= 32
), share AS (
  SELECT lang, rank, word, times / total AS q FROM ref_w JOIN ref_n USING (lang)
  UNION ALL
  SELECT lang, 0, NULL, (total - known) / total
  FROM ref_n JOIN (SELECT lang, sum(times) AS known FROM ref_w GROUP BY lang) USING (lang)
), have AS (
  SELECT e.r, e.lang, e.n, coalesce(s.rank, 0) AS rank, count(*) AS c
  FROM e LEFT JOIN share s ON s.lang = e.lang AND s.word = lower(e.word) GROUP BY ALL
), by_word AS (
  SELECT r, sqrt(greatest(0, (sum(v) + 1 - sum(q)) / 2)) AS dist FROM (
    SELECT r, q, c / n AS p, p * log2(p / ((p + q) / 2)) + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END AS v
    FROM have JOIN share USING (lang, rank)
  ) GROUP BY r
), bins AS (
  SELECT r, unnest(cs) / chars AS p, unnest(sums) / list_sum(sums) AS q FROM f JOIN ref_n USING (lang) WHERE chars > 0
), by_class AS (
  SELECT r, sqrt(greatest(0, (sum(v) + 1 - sum(q)) / 2)) AS dist FROM (
    SELECT r, q, p * log2(p / ((p + q) / 2)) + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END AS v
    FROM bins WHERE p > 0
  ) GROUP BY r
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(chars - cs[2] AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
  n < 50 OR 100 * coalesce(n_repeat, 0) > 50 * n AS base_failed,
  NOT (n < 50 OR 100 * coalesce(n_repeat, 0) > 50 * n)
    AND NOT coalesce(by_class.dist > 0.28 OR by_word.dist > 0.55, false) AS kept
FROM f LEFT JOIN again USING (r) LEFT JOIN lines USING (r) LEFT JOIN by_word USING (r) LEFT JOIN by_class USING (r)
"""

_KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
     "list_max(list_transform(string_split(m, '.'), lambda x: CAST(x AS DOUBLE))) <= 255"),
    ("card", r"[0-9]([\x20-]?[0-9])+", "len(ds) BETWEEN 14 AND 19 AND luhn % 10 = 0"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "len(ds) BETWEEN 10 AND 15"),
    ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
     r"""NOT regexp_matches(before, '[0-9A-Za-z-]$') AND NOT regexp_matches(after, '^[0-9A-Za-z-]')
     AND regexp_matches(lower(right(before, 40) || ' ' || left(after, 20)), '(^|[^a-z])(ssn|social security|tax id)')"""),
]

_RANKS = {"email": 0, "ip": 1, "card": 2, "phone": 3, "iban": 4, "ssn": 5}

_MATCHES = "\nUNION ALL\n".join(
    rf"""SELECT r, '{name}' AS kind, {_RANKS[name]} AS rank, start, start + length(m) AS stop FROM (
  SELECT *, sum(length(m) + length(before)) OVER (PARTITION BY r ORDER BY i) - length(m) AS start FROM (
    SELECT r, i, ms[i] AS m, gs[i] AS before, gs[i + 1] AS after,
      list_transform(regexp_extract_all(ms[i], '[0-9]'), lambda x: CAST(x AS INT)) AS ds,
      list_sum(list_transform(list_reverse(ds), lambda x, j:
        CASE WHEN j % 2 = 1 THEN x WHEN x > 4 THEN 2 * x - 9 ELSE 2 * x END)) AS luhn
    FROM (
      SELECT r, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gs,
        unnest(range(1, len(ms) + 1)) AS i FROM d
    )
  )
) WHERE {valid}"""
    for name, pattern, valid in _KINDS
)

# Account numbers: every place of two capitals and two digits is a start (such places never overlap), the
# length of the country gives the end, and of the valid ones that overlap the first is taken.
_LENGTH = """CASE left(rest, 2) WHEN 'NO' THEN 15 WHEN 'BE' THEN 16
  WHEN 'DK' THEN 18 WHEN 'FI' THEN 18 WHEN 'NL' THEN 18 WHEN 'SI' THEN 19
  WHEN 'AT' THEN 20 WHEN 'EE' THEN 20 WHEN 'LT' THEN 20 WHEN 'LU' THEN 20
  WHEN 'CH' THEN 21 WHEN 'HR' THEN 21 WHEN 'LI' THEN 21 WHEN 'LV' THEN 21
  WHEN 'BG' THEN 22 WHEN 'DE' THEN 22 WHEN 'GB' THEN 22 WHEN 'IE' THEN 22
  WHEN 'CZ' THEN 24 WHEN 'ES' THEN 24 WHEN 'RO' THEN 24 WHEN 'SE' THEN 24 WHEN 'SK' THEN 24
  WHEN 'PT' THEN 25 WHEN 'IS' THEN 26 WHEN 'FR' THEN 27 WHEN 'GR' THEN 27 WHEN 'IT' THEN 27 WHEN 'MC' THEN 27
  WHEN 'CY' THEN 28 WHEN 'HU' THEN 28 WHEN 'PL' THEN 28 WHEN 'MT' THEN 31 END"""

_ACCOUNTS = rf"""SELECT r, 'iban' AS kind, 4 AS rank, span[1] AS start, span[2] AS stop FROM (
  SELECT r, unnest(list_reduce(list_prepend([[-1, -1]], list([[start, start + length(m)]] ORDER BY start)),
    lambda a, x: CASE WHEN x[1][1] >= a[len(a)][2] THEN list_concat(a, x) ELSE a END)[2:]) AS span
  FROM (
    SELECT r, start, rest, m, list_prepend(0, list_transform(
      regexp_extract_all(substr(replace(m, ' ', ''), 5) || left(replace(m, ' ', ''), 4), '.'),
      lambda c: CASE WHEN ascii(c) >= 65 THEN ascii(c) - 55 ELSE ascii(c) - 48 END)) AS digits
    FROM (
      SELECT r, start, rest, last,
        regexp_extract(rest, '^[A-Z]{{2}}[0-9]{{2}}( ?[A-Z0-9]){{' || ({_LENGTH} - 4) || '}}') AS m
      FROM (
        SELECT r, substr(t, CAST(sum(length(m) + length(before)) OVER (PARTITION BY r ORDER BY i) - length(m) AS BIGINT), 1) AS last,
          CAST(sum(length(m) + length(before)) OVER (PARTITION BY r ORDER BY i) - length(m) AS BIGINT) AS start,
          substr(t, CAST(sum(length(m) + length(before)) OVER (PARTITION BY r ORDER BY i) - length(m) AS BIGINT) + 1, 80) AS rest
        FROM (
          SELECT r, t, i, ms[i] AS m, gs[i] AS before FROM (
            SELECT r, t, regexp_extract_all(t, '[A-Z]{{2}}[0-9]{{2}}') AS ms,
              string_split_regex(t, '[A-Z]{{2}}[0-9]{{2}}') AS gs, unnest(range(1, len(ms) + 1)) AS i FROM d
          )
        )
      ) WHERE {_LENGTH} IS NOT NULL
    )
    WHERE m <> '' AND NOT regexp_matches(substr(rest, length(m) + 1), '^[0-9A-Za-z-]')
      AND (start = 0 OR NOT regexp_matches(last, '[0-9A-Za-z-]'))
  )
  WHERE list_reduce(digits, lambda a, x: (a * CASE WHEN x >= 10 THEN 100 ELSE 10 END + x) % 97) = 1
  GROUP BY r
)"""

PERSONAL_DATA = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT *, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span FROM ({_MATCHES}
UNION ALL
{_ACCOUNTS})),
a AS (
  SELECT r, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
    count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
    string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 4) AS base,
    string_agg(span, ',' ORDER BY start, rank) AS spans
  FROM s GROUP BY r
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (r)
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r0, text AS t0 FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok', 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok', 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, row_number() OVER o AS idx,
    (length(role || text) - length(replace(role || text, '\', ''))
      + (length(role) - length(replace(role, ':', '')))
      + (length(role) - length(replace(role, '</turn>', ''))) // 7 + (length(text) - length(replace(text, '</turn>', ''))) // 7
      + coalesce(list_sum(list_transform(regexp_extract_all(role, '###+'), lambda x: length(x) - 2)), 0)
      + coalesce(list_sum(list_transform(regexp_extract_all(text, '###+'), lambda x: length(x) - 2)), 0)) AS added
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)
), p AS (
  SELECT *, length(role) + length(text) + added + 14 AS chars, (strlen(role) + strlen(text) + added + 14 + 3) // 4 AS tokens,
    idx = 1 AND role = 'system' AS sys FROM e
), u AS (
  SELECT *, sum(CASE WHEN sys THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id ORDER BY idx) AS used,
    coalesce(max(CASE WHEN sys THEN tokens END) OVER (PARTITION BY conv_id), 0) AS fixed,
    coalesce(max(CASE WHEN sys THEN chars END) OVER (PARTITION BY conv_id), 0) AS lead_chars
  FROM p
), c AS (
  SELECT *, greatest(1, floor((768 - fixed) / 2.0)) AS step, floor((used - 1.0) / step) AS cell, tokens > step AS big FROM u
), f AS (
  SELECT *, CASE WHEN NOT sys AND coalesce(idx = 1 OR lag(sys) OVER o OR cell <> lag(cell) OVER o OR big OR lag(big) OVER o, false)
    THEN 1 ELSE 0 END AS opens FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY idx)
), w AS (
  SELECT *, greatest(0, sum(opens) OVER (PARTITION BY conv_id ORDER BY idx) - 1) AS win FROM f
), h AS (
  SELECT *,
    CASE WHEN opens = 1 AND win > 0 THEN lead_chars ELSE 0 END
    + CASE WHEN NOT sys AND lead(opens, 1) OVER o = 1 AND tokens <= 256 THEN chars ELSE 0 END
    + CASE WHEN NOT sys AND lead(opens, 2) OVER o = 1 AND lead(used, 1) OVER o - used + tokens <= 256 THEN chars ELSE 0 END
    AS repeated
  FROM w WINDOW o AS (PARTITION BY conv_id ORDER BY idx)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY idx)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY idx) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars + repeated) AS BIGINT) AS formatted_chars
FROM h GROUP BY conv_id
"""

MIX = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS source, md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
    CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS n_tokens
  FROM documents
), t AS MATERIALIZED (
  SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) AS DOUBLE) / sum(sum(n_tokens)) OVER () AS s
  FROM d GROUP BY source
), f AS (SELECT * FROM t WHERE tokens > 0),
tries AS (SELECT unnest(range(31)) AS level),
bisect AS (
  SELECT 0 AS level, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT level + 1, CASE WHEN ok THEN lo ELSE mid END, CASE WHEN ok THEN mid ELSE hi END
  FROM (
    SELECT level, lo, hi, (lo + hi) / 2 AS mid,
      (SELECT ln(sum(pow(s, (lo + hi) / 2))) - (lo + hi) / 2 * sum(pow(s, (lo + hi) / 2) * ln(s)) / sum(pow(s, (lo + hi) / 2)) <= 0.95 * ln(count(*))
          AND max(pow(s, (lo + hi) / 2 - 1)) / min(pow(s, (lo + hi) / 2 - 1)) <= 2 FROM f) AS ok
    FROM bisect WHERE level < 30
  )
), a AS (
  SELECT CASE WHEN (SELECT count(*) FROM f) < 2 THEN 1.0
    WHEN (SELECT ln(count(*)) <= 0.95 * ln(count(*)) AND max(1 / s) / min(1 / s) <= 2 FROM f) THEN 0.0
    ELSE hi END AS alpha
  FROM bisect WHERE level = 30
), w AS (
  SELECT source, tokens, CASE WHEN tokens > 0 THEN pow(s, alpha) / (SELECT sum(pow(s, alpha)) FROM f) ELSE 0 END AS weight FROM t, a
), q AS (
  SELECT source, tokens, CASE WHEN tokens > 0 THEN greatest(tokens, CAST(floor(weight * (
    SELECT max(tokens / weight) FROM w WHERE tokens > 0) + 0.5) AS BIGINT)) ELSE 0 END AS quota FROM w
), b AS (SELECT greatest(1, ceil(sum(quota) / 262144.0)) AS blocks FROM q),
p AS (
  SELECT d.*, tokens, quota, sum(n_tokens) OVER (
    PARTITION BY source ORDER BY key, doc_id, n_tokens ROWS UNBOUNDED PRECEDING) - n_tokens AS start
  FROM d JOIN q USING (source)
), c AS (
  SELECT *, unnest(range(CASE WHEN tokens > 0
    THEN quota // tokens + CASE WHEN start < quota % tokens THEN 1 ELSE 0 END ELSE 1 END)) AS copy FROM p
), r AS (
  SELECT doc_id, source, copy, n_tokens, key,
    CAST(least(floor(CASE WHEN tokens > 0 THEN CAST(copy * tokens + start AS DOUBLE) / greatest(quota, 1)
      ELSE CAST('0x' || left(key, 8) AS BIGINT) / 4294967296.0 END * blocks), blocks - 1) AS BIGINT) AS block
  FROM c, b
)
SELECT doc_id, source, copy, n_tokens, block,
  row_number() OVER (PARTITION BY block ORDER BY md5(key || ':' || copy), doc_id, copy, n_tokens) - 1 AS slot
FROM r
"""


def _curve(bits: int, n: int) -> str:
    """The steps of the curve's index as one subquery after the other, on columns x0, x1, ..."""
    sql, xs = "coded", [f"x{d}" for d in range(n)]

    def step(changes: dict[str, str], sql: str) -> str:
        return f"(SELECT * REPLACE ({', '.join(f'{v} AS {k}' for k, v in changes.items())}) FROM {sql})"

    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for x in xs:
            swap = f"CASE WHEN {x} & {bit} <> 0 THEN 0 ELSE xor(x0, {x}) & {low} END"
            first = f"xor(x0, CASE WHEN {x} & {bit} <> 0 THEN {low} ELSE {swap} END)"
            sql = step({"x0": first} if x == "x0" else {"x0": first, x: f"xor({x}, {swap})"}, sql)
    for a, b in zip(xs, xs[1:]):
        sql = step({b: f"xor({b}, {a})"}, sql)
    flip = "0"
    for level in range(bits - 1, 0, -1):
        flip = f"xor({flip}, CASE WHEN ({xs[-1]} >> {level}) & 1 = 1 THEN {(1 << level) - 1} ELSE 0 END)"
    sql = step({x: f"xor({x}, flip)" for x in xs}, f"(SELECT *, {flip} AS flip FROM {sql})")
    parts = [
        f"((({x} >> {level}) & 1) << {level * n + n - 1 - d})" for level in range(bits) for d, x in enumerate(xs)
    ]
    return f"(SELECT *, {' + '.join(parts)} AS curve FROM {sql})"


def _crc_table() -> list[int]:
    table = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def _crc(text: str) -> str:
    return f"""xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))),
  lambda a, b: xor(a >> 8, list_extract({_crc_table()}::BIGINT[], (xor(a, b) & 255) + 1))))"""

SHARDS = f"""
WITH d AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size, coalesce(text, '') AS t, lang, source FROM documents
), l AS (
  SELECT *, 4 * length(bin(size)) + ((size >> (length(bin(size)) - 3)) & 3) AS length_class FROM d
), k AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS k0, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS k1,
    dense_rank() OVER (ORDER BY length_class) - 1 AS k2 FROM l
), coded AS (
  SELECT *, CAST(floor(k0 * 1024.0 / (max(k0) OVER () + 1)) AS BIGINT) AS x0,
    CAST(floor(k1 * 1024.0 / (max(k1) OVER () + 1)) AS BIGINT) AS x1,
    CAST(floor(k2 * 1024.0 / (max(k2) OVER () + 1)) AS BIGINT) AS x2 FROM k
), placed AS (
  SELECT *, row_number() OVER (ORDER BY curve, doc_id NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM {_curve(10, 3)}
)
SELECT doc_id, CAST(size AS BIGINT) AS size, 'rows' AS law, CAST(place * 40 // n AS INT) AS shard,
  place - (place * 40 // n * n + 39) // 40 AS slot, CAST(NULL AS INT) AS grown_shard, CAST(curve AS BIGINT) AS curve,
  {_crc('t')} AS text_crc32
FROM placed
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS w FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN n >= 1000 AND page_id < w THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id < w THEN w END AS refers_to
FROM g
"""

VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    AND list_cosine_similarity(a.e, b.e) >= 0.98
), r AS (
  SELECT vec_id AS id, vec_id AS c FROM v
  UNION
  SELECT l.b, r.c FROM r JOIN l ON l.a = r.id WHERE r.c < l.b
), m AS (
  SELECT id, min(c) AS c FROM r GROUP BY id
), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT t.vec_id, coalesce(n.n, 0) AS n_links, coalesce(m.c, t.vec_id) AS component_id, coalesce(m.c, t.vec_id) = t.vec_id AS kept
FROM embeddings t LEFT JOIN n ON n.a = t.vec_id LEFT JOIN m ON m.id = t.vec_id
"""


def _merkle() -> str:
    """A tree per language, then one over the languages; each level is a step for nodes, folded digests and proofs.

    Where a tree has one node left a step changes nothing. Eight to the power of ``deep`` leaves are enough.
    """

    def leaf(text: str) -> str:
        parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
                 for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(parts)})"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    sql = f"""
WITH h AS (
  SELECT doc_id, lang, {leaf('text')} AS leaf, CASE WHEN doc_id IS NOT NULL AND {_crc("CAST(coalesce(doc_id, 0) AS VARCHAR)")} % 3 = 0
    THEN {leaf(lowered)} ELSE {leaf('text')} END AS claimed FROM documents
), s0 AS MATERIALIZED (
  SELECT *, claimed AS folded, '' AS proof, dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM h
), n0 AS MATERIALIZED (SELECT tree, idx, n, leaf AS hash FROM s0)"""
    deep, wide = 7, 3

    def level(i: int) -> str:
        return f"""
, g{i} AS MATERIALIZED (
  SELECT tree, idx // 8 AS up, n, list(hash ORDER BY idx) AS hs FROM n{i} GROUP BY tree, up, n
), n{i + 1} AS MATERIALIZED (
  SELECT tree, up AS idx, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS hash FROM g{i}
), s{i + 1} AS MATERIALIZED (
  SELECT s.* REPLACE (s.idx // 8 AS idx, (s.n + 7) // 8 AS n,
    CASE WHEN s.n > 1 THEN sha256(array_to_string(hs[:s.idx % 8], '') || folded || array_to_string(hs[s.idx % 8 + 2:], '')) ELSE folded END AS folded,
    CASE WHEN s.n > 1 THEN proof || array_to_string(hs[:s.idx % 8], '') || array_to_string(hs[s.idx % 8 + 2:], '') ELSE proof END AS proof)
  FROM s{i} s JOIN g{i} g ON g.tree = s.tree AND g.up = s.idx // 8
)"""

    for i in range(deep):
        sql += level(i)
    top = deep + 1
    sql += f"""
, n{top} AS MATERIALIZED (SELECT 0 AS tree, tree AS idx, count(*) OVER () AS n, hash FROM n{deep}),
s{top} AS MATERIALIZED (
  SELECT s.* REPLACE (0 AS tree, s.tree AS idx, t.n AS n), t.hash AS subroot FROM s{deep} s JOIN n{top} t ON t.idx = s.tree
)"""
    for i in range(top, top + wide):
        sql += level(i)
    last = top + wide
    return sql + f"""
SELECT doc_id, leaf, subroot, hash AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = hash AS verified
FROM s{last} s JOIN n{last} r ON r.idx = s.idx
"""


MERKLE = _merkle()
