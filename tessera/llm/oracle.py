"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from tessera.llm import phrase_mining as P
from tessera.llm import resampling as R
from tessera.llm import url_reputation as U

CHAT_FORMAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
), n AS (
  SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n_turns,
    length('<turn ' || role || '>') + length(regexp_replace(text, '<(\\*/?turn)', '<\\\1', 'g')) + length('</turn>') + 1 AS shown
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), f AS (
  SELECT *, sum(shown) OVER (PARTITION BY conv_id ORDER BY pos) AS prefix FROM n
)
SELECT conv_id, max(n_turns) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(prefix) FILTER (role = 'assistant' OR pos = n_turns))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""

TOPK_SEARCH = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

SUBSTRING_DEDUP = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), win AS (
  SELECT doc_id, p, array_to_string(words[p:p + 12], ' ') AS seq
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM d)
), firsts AS (
  SELECT seq, min(doc_id) AS first_id FROM win GROUP BY seq
), gone AS (
  SELECT DISTINCT doc_id, pos FROM (
    SELECT win.doc_id, unnest(range(p, p + 13)) AS pos FROM win JOIN firsts USING (seq) WHERE first_id < win.doc_id)
), kept AS (
  SELECT w.doc_id, w.pos, w.word FROM (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM d) w
  ANTI JOIN gone USING (doc_id, pos)
), k AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text FROM kept GROUP BY doc_id
)
SELECT d.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


def _level(name: str, source: str, mean: str) -> str:
    """A level of the shrinkage: its prior weight, then its posterior means."""
    low, high = U.K_RANGE
    return f"""{name}_s AS (
  SELECT sum(m * (1 - m)) AS v, sum(n * m * (1 - m)) AS wv, sum((bad - n * m) ** 2 / n) AS ss FROM {source} WHERE n > 0
), {name}_k AS (
  SELECT coalesce(CASE WHEN (ss - v) / nullif(wv - v, 0) <= 0 THEN {high}
    ELSE least(greatest(1 / ((ss - v) / nullif(wv - v, 0)) - 1, {low}), {high}) END, {high}) AS k FROM {name}_s
), {name} AS (
  SELECT u.*, (SELECT k FROM {name}_k) AS k, (bad + (SELECT k FROM {name}_k) * m) / (n + (SELECT k FROM {name}_k)) AS {mean} FROM {source} u
)"""


def url_reputation() -> str:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    labels = "string_split(regexp_replace(host, ':[0-9]*$', ''), '.')"
    two = f"array_to_string({labels}[-2:], '.')"
    double = f"{two} IN ({', '.join(repr(s) for s in U.TWO_LABEL_SUFFIXES)})"
    ranked = sorted(U.RULES, key=lambda r: (-len(r[1]), -len(r[2])))
    fits = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN" for _, h, p in ranked]
    rule = " ".join(f"{f} '{h}{p}'" for f, (_, h, p) in zip(fits, ranked, strict=True))
    action = " ".join(f"{f} '{a}'" for f, (a, _, _) in zip(fits, ranked, strict=True))
    return f"""
WITH o AS (
  SELECT doc_id AS page_id, count(*) AS n, sum(CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 0 ELSE 1 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1
), p AS (
  SELECT page_id,
    CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '{pattern}', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract(url, '{pattern}', 2) ELSE '' END AS path
  FROM pages
), h AS (
  SELECT host, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad,
    CASE WHEN {double} THEN array_to_string({labels}[-3:], '.') ELSE {two} END AS domain,
    CASE WHEN {double} THEN {two} ELSE {labels}[-1] END AS suffix
  FROM p LEFT JOIN o USING (page_id) GROUP BY host
), whole AS (
  SELECT (sum(bad) + 1) / (sum(n) + 2) AS m, sum(n) > 0 AS known FROM h
), s0 AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT m FROM whole) AS m FROM h GROUP BY suffix
), {_level("s1", "s0", "suffix_mean")}, d0 AS (
  SELECT domain, sum(h.n) AS n, sum(h.bad) AS bad, any_value(suffix_mean) AS m FROM h JOIN s1 USING (suffix) GROUP BY domain
), {_level("d1", "d0", "domain_mean")}, h0 AS (
  SELECT host, h.n, h.bad, domain_mean AS m FROM h JOIN d1 USING (domain)
), {_level("h1", "h0", "mean")}, b AS (
  SELECT host, CASE WHEN (SELECT known FROM whole) THEN mean - {U.Z} * sqrt(mean * (1 - mean) / (n + k + 1)) ELSE 0 END AS bound FROM h1
)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {action} WHEN bound >= {U.BLOCK_SHARE} THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN b USING (host)
"""


def _crc32_of_nibble(value: int) -> int:
    """Remainder of four bits by the crc32 polynomial."""
    for _ in range(4):
        value = (value >> 1) ^ (0xEDB88320 * (value & 1))
    return value


def importance_resampling() -> str:
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    table = [_crc32_of_nibble(i) for i in range(16)]
    # the lower half of each byte comes first
    nibbles = "list_transform(range(2 * strlen(w)), lambda i: instr('0123456789ABCDEF', substr(hex(w), (i + 2 - 2 * (i % 2))::INT, 1))::BIGINT - 1)"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {nibbles}), lambda c, x: xor({table}[(xor(c, x) & 15) + 1], c >> 4)), 4294967295)"
    return f"""
WITH d AS (
  SELECT doc_id, {words} AS words FROM documents
), b AS (
  SELECT {words} AS words FROM benchmark
), dw AS (
  SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(words) AS w FROM d) GROUP BY ALL
), bw AS (
  SELECT w, count(*) AS n FROM (SELECT unnest(words) AS w FROM b) GROUP BY ALL
), u AS (
  SELECT w, {crc} % {R.BUCKETS} AS bucket FROM (SELECT w FROM dw UNION SELECT w FROM bw)
), s AS (
  SELECT bucket, sum(n) AS s FROM dw JOIN u USING (w) GROUP BY bucket
), t AS (
  SELECT bucket, sum(n) AS t FROM bw JOIN u USING (w) GROUP BY bucket
), g AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s) + {R.BUCKETS})::DOUBLE
    / ((s + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM t), 0) + {R.BUCKETS})::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)
), m AS (
  SELECT doc_id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight FROM dw JOIN u USING (w) JOIN g USING (bucket) GROUP BY doc_id
), f AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('{R.SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN m USING (doc_id)
), r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS fit FROM f WHERE n_features >= {R.MIN_WORDS}
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {R.SHARE_PERCENT} * fit // 100 THEN place END AS rank
FROM f LEFT JOIN r USING (doc_id)
"""


def phrase_mining() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({lower}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM pieces
), g AS (
  SELECT lang, m, words[i:i + m - 1] AS p FROM (
    SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM w, (SELECT unnest(range(1, {P.MAX_WORDS} + 1)) AS m) WHERE len(words) >= m)
), f AS (
  SELECT lang, m, p, count(*) AS n FROM g GROUP BY ALL HAVING count(*) >= {P.MIN_COUNT}
), total AS (
  SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang
), cuts AS (
  SELECT lang, m, p, n AS a, unnest(range(1, m)) AS k FROM f WHERE m >= 2
), s AS (
  SELECT c.*, h.n AS l, t.n AS r, ({P.SCALE}::HUGEINT * a // (h.n + t.n))::BIGINT AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.p = c.p[1:k] JOIN f t ON t.lang = c.lang AND t.p = c.p[k + 1:]
), least AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), inner_ AS (
  SELECT lang, p[i:i + j - 1] AS p, n FROM (
    SELECT lang, p, n, j, unnest(range(1, m - j + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS j FROM f WHERE m >= 3))
), around AS (
  SELECT lang, p, max(n) AS most FROM inner_ GROUP BY ALL
), alone AS (
  SELECT least.*, array_to_string(least.p, ' ') AS phrase FROM least LEFT JOIN around USING (lang, p)
  WHERE most IS NULL OR 100::HUGEINT * most < {P.COVERED_PERCENT}::HUGEINT * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM alone
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= {P.TOP}
"""
