"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code: segmentation uses DuckDB's
``string_split_regex`` / ``regexp_extract_all`` and running image indexes use
SQL windows instead of carried ordinals.  RE2's ``\\s`` is ASCII, so the strip
class lists the ASCII whitespace explicitly; the fixtures hold no other kind.
"""

from __future__ import annotations

from ..operators.ingest import OPTIONS_HEADER, QUESTION_PROMPT
from ..sources import fixtures as X


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[\\s\\x0b\\x1c-\\x1f]+|[\\s\\x0b\\x1c-\\x1f]+$', '', 'g')"


NL = "chr(10)"


def _crc32(hexes: str) -> str:
    """SQL: crc32 of bytes given as hex digits, four bits at a time."""
    table = []
    for i in range(16):
        for _ in range(4):
            i = (i >> 1) ^ (0xEDB88320 * (i & 1))
        table.append(i)
    # the lower half of each byte comes first
    halves = f"list_transform(range(length({hexes})), lambda i: instr('0123456789ABCDEF', substr({hexes}, (i + 2 - 2 * (i % 2))::INT, 1))::BIGINT - 1)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {halves}), lambda c, x: xor({table}[(xor(c, x) & 15) + 1], c >> 4)), 4294967295)"


def _low_first(n: str) -> str:
    return f"printf('%02X%02X%02X%02X', ({n}) % 256, ({n}) // 256 % 256, ({n}) // 65536 % 256, ({n}) // 16777216)"


def file_of(path: str) -> str:
    """SQL: the file a path of the fixtures names."""
    return f"replace(replace(regexp_replace({path}, '^[.]/', ''), 'other/../', ''), '//', '/')"


FOLDER = """concat(CASE conv_id % 23 WHEN 6 THEN './' WHEN 8 THEN 'other/../' ELSE '' END, 'task_', conv_id, CASE WHEN conv_id % 23 = 9 THEN '//' ELSE '/' END)"""

FIXTURES = f"""
cot_seg AS (
  SELECT conv_id, turn, concat(
    CASE WHEN turn = 0 AND conv_id % 19 <> 4 THEN concat('<image>', {FOLDER}, 'composite.png</image>', {NL}, {NL}) ELSE '' END,
    text,
    CASE WHEN turn % 2 = 1 AND conv_id % 19 <> 4 THEN concat({NL}, '<image>', {FOLDER}, 'step_', turn, '.png</image>', {NL}) ELSE '' END,
    CASE WHEN conv_id % 13 = 5 AND turn = 1 THEN ' [render_result]' ELSE '' END) AS x
  FROM conversations),
cot_source AS (
  SELECT conv_id AS task_id, chr((65 + conv_id % 4)::INT) AS gt,
    CASE WHEN conv_id % 10 = 7 THEN chr((65 + (conv_id + 1) % 4)::INT) ELSE chr((65 + conv_id % 4)::INT) END AS pred,
    CASE WHEN conv_id % 17 = 3 THEN '' ELSE string_agg(x, {NL} ORDER BY turn) END AS cot_text
  FROM cot_seg GROUP BY conv_id),
image_parts AS (
  SELECT path, kind, body, octet_length(encode(text)) AS n, chunk, crc FROM (
    SELECT *, {_crc32('chunk')} AS crc FROM (
      SELECT concat('task_', conv_id, '/', CASE WHEN turn = 0 THEN 'composite' ELSE concat('step_', turn) END, '.png') AS path,
        text, hex(encode(text)) AS body, '74455874436F6D6D656E7400' || hex(encode(text)) AS chunk, (conv_id * 5 + turn) % 29 AS kind
      FROM conversations WHERE (turn = 0 OR turn % 2 = 1) AND (conv_id * 7 + turn) % 23 <> 0))),
image_files AS (
  SELECT path, kind, body, n,
    '{X.PNG_HEAD_HEX}' || printf('%08X', n + 8) || chunk || printf('%08X', CASE WHEN kind = 7 THEN xor(crc, 1) ELSE crc END) || '{X.PNG_TAIL_HEX}' AS png,
    '{X.JPEG_HEAD_HEX}' || body || '{X.JPEG_TAIL_HEX}' AS jpeg,
    '52494646' || {_low_first('n + n % 2 + 12')} || '5745425056503820' || {_low_first('n')} || body || repeat('00', (n % 2)::INT) AS webp,
    '424D' || {_low_first('(n + 3) // 4 * 4 + 54')} || '000000003600000028000000' || {_low_first('n')} || '0100000001000800' || repeat('00', 24)
      || body || repeat('00', ((n + 3) // 4 * 4 - n)::INT) AS bmp FROM image_parts),
image_blobs AS (
  SELECT path, kind, unhex(CASE kind WHEN 3 THEN body WHEN 11 THEN left(png, -24) WHEN 13 THEN png || '0000FFD93B' WHEN 2 THEN jpeg WHEN 8 THEN left(jpeg, -4)
    WHEN 17 THEN webp WHEN 19 THEN left(webp, -10) WHEN 5 THEN bmp WHEN 23 THEN left(bmp, -8) ELSE png END) AS content FROM image_files),
task_options AS (
  SELECT c.task_id, chr((65 + c.o)::INT) AS k, p.p_name AS v
  FROM (SELECT conv_id AS task_id, unnest(range(0, 4)) AS o
        FROM (SELECT DISTINCT conv_id FROM conversations) WHERE conv_id % 11 <> 0) c
  JOIN part p ON p.p_partkey = (c.task_id * 4 + c.o) % 200 + 1),
image_index AS (
  SELECT *, problem IS NULL AS valid FROM (
    SELECT path, octet_length(content)::BIGINT AS length, md5(content) AS md5,
      CASE WHEN kind IN (2, 8) THEN 'jpeg' WHEN kind IN (17, 19) THEN 'webp' WHEN kind IN (5, 23) THEN 'bmp' WHEN kind <> 3 THEN 'png' END AS format,
      CASE WHEN octet_length(content) = 0 THEN 'empty' WHEN kind = 3 THEN 'unknown_format' WHEN kind = 7 THEN 'bad_crc'
           WHEN kind IN (8, 11, 19, 23) THEN 'truncated' END AS problem
    FROM image_blobs))"""


def _segs(flag: str) -> str:
    """Kept segments ``list<struct(type, content)>`` of cot_source, plus ``n_img``."""
    keep = "lambda s: s.type = 'image' OR s.content <> ''" if flag == "(?s)" else "lambda s: s.content <> ''"
    return f"""
  SELECT task_id, list_filter(flatten(list_transform(generate_series(0, len(paths)), lambda i:
      CASE WHEN i < len(paths)
           THEN [{{'type': 'text', 'content': {strip('parts[i + 1]')}}}, {{'type': 'image', 'content': {strip('paths[i + 1]')}}}]
           ELSE [{{'type': 'text', 'content': {strip('parts[i + 1]')}}}] END)), {keep}) AS segs
  FROM (SELECT task_id, string_split_regex(coalesce(cot_text, ''), '{flag}<image>.*?</image>') AS parts,
               regexp_extract_all(coalesce(cot_text, ''), '{flag}<image>(.*?)</image>', 1) AS paths
        FROM cot_source)"""


SEGMENTS = f"""
seg_dotall AS ({_segs("(?s)")}),
seg_strict AS ({_segs("")}),
seg_dotall_rows AS (
  SELECT task_id, (generate_subscripts(segs, 1) - 1)::BIGINT AS pos, unnest(segs) AS s FROM seg_dotall),
seg_strict_rows AS (
  SELECT task_id, (generate_subscripts(segs, 1) - 1)::BIGINT AS pos, unnest(segs) AS s FROM seg_strict),
a_k AS (
  SELECT task_id, CASE WHEN len(segs) = 0 THEN 0 WHEN segs[1].type = 'image' THEN 1
                       WHEN segs[2].type = 'image' THEN 2 ELSE 1 END AS k FROM seg_strict),
a_rows AS (
  SELECT r.task_id, CASE WHEN r.pos < k.k THEN 'question' ELSE 'solution' END AS section,
         CASE WHEN r.pos < k.k THEN r.pos ELSE r.pos - k.k END AS pos, r.s.type AS type, r.s.content AS content
  FROM seg_strict_rows r JOIN a_k k USING (task_id)),
a_entries AS (
  SELECT task_id, section, pos, type, content,
         CASE WHEN type = 'image' THEN (count(*) FILTER (WHERE type = 'image') OVER (
              PARTITION BY task_id, section ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::BIGINT END AS index
  FROM a_rows),
a_refs AS (
  SELECT task_id, section, index AS pos, content AS path FROM a_entries WHERE type = 'image'),
b_first AS (
  SELECT task_id, min(pos) AS f FROM seg_dotall_rows WHERE s.type = 'image' GROUP BY task_id),
b_entries AS (
  SELECT r.task_id, CASE WHEN r.pos = b.f THEN 'question' ELSE 'solution' END AS section,
         CASE WHEN r.pos = b.f THEN 0 ELSE r.pos - b.f - 1 END AS pos, r.s.type AS type, r.s.content AS content,
         CASE WHEN r.s.type = 'image' THEN (count(*) FILTER (WHERE r.s.type = 'image') OVER (
              PARTITION BY r.task_id ORDER BY r.pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::BIGINT
              - CASE WHEN r.pos = b.f THEN 0 ELSE 1 END END AS index
  FROM seg_dotall_rows r JOIN b_first b USING (task_id) WHERE r.pos >= b.f),
b_refs AS (
  SELECT task_id, section, index AS pos, content AS path FROM b_entries WHERE type = 'image'),
status_a AS (
  SELECT c.task_id, coalesce(
      CASE WHEN c.pred IS DISTINCT FROM c.gt THEN 'mismatch'
           WHEN contains(coalesce(c.cot_text, ''), '[render_result]') THEN 'render_result'
           WHEN coalesce(c.cot_text, '') = '' THEN 'other' END,
      CASE WHEN EXISTS (SELECT 1 FROM a_refs r JOIN image_index i ON i.path = {file_of('r.path')} WHERE r.task_id = c.task_id)
           THEN 'ok' ELSE 'other' END) AS status
  FROM cot_source c),
status_b AS (
  SELECT c.task_id,
      CASE WHEN NOT EXISTS (SELECT 1 FROM b_refs r WHERE r.task_id = c.task_id) THEN 'no_image'
           WHEN EXISTS (SELECT 1 FROM b_refs r LEFT JOIN image_index i ON i.path = {file_of('r.path')}
                        WHERE r.task_id = c.task_id AND coalesce(NOT i.valid, TRUE)) THEN 'image_error'
           ELSE 'ok' END AS status
  FROM cot_source c),
option_text AS (
  SELECT task_id, string_agg(concat(k, ': ', v), {NL} ORDER BY k, v) AS options_text FROM task_options GROUP BY task_id)"""

PREFIX = "WITH " + FIXTURES.strip() + "," + SEGMENTS.rstrip() + "\n"

PROMPT_SQL = (
    f"CASE WHEN coalesce(o.options_text, '') <> '' THEN concat({lit(QUESTION_PROMPT)}, "
    f"{lit(OPTIONS_HEADER).replace(chr(10), chr(39) + ' || chr(10) || ' + chr(39))}, o.options_text) "
    f"ELSE {lit(QUESTION_PROMPT)} END"
)

SQL: dict[str, str] = {}

SQL["cot_normalised"] = """
SELECT task_id, concat('task_', task_id) AS id, coalesce(gt, '') AS gt, coalesce(pred, '') AS pred,
       coalesce(cot_text, '') AS cot_text FROM cot_source"""

SQL["records_roundtrip"] = SQL["cot_normalised"]

SQL["ingest_status_a"] = "SELECT status, count(*) AS n FROM status_a GROUP BY status"
SQL["ingest_status_b"] = "SELECT status, count(*) AS n FROM status_b GROUP BY status"

SQL["segments_dotall"] = "SELECT task_id, pos, s.type AS type, s.content AS content FROM seg_dotall_rows"
SQL["segments_strict"] = "SELECT task_id, pos, s.type AS type, s.content AS content FROM seg_strict_rows"
SQL["layout_a_entries"] = "SELECT task_id, section, pos, type, content, index FROM a_entries"
SQL["layout_b_entries"] = "SELECT task_id, section, pos, type, content, index FROM b_entries"
SQL["image_refs"] = "SELECT task_id, section, pos, path FROM a_refs"

SQL["image_lookup"] = f"""
SELECT r.task_id, r.section, r.pos, r.path, i.length, i.valid, i.md5, i.path IS NOT NULL AS found
FROM a_refs r LEFT JOIN image_index i ON i.path = {file_of('r.path')}"""

SQL["missing_images"] = f"""
SELECT r.task_id, r.section, r.pos, r.path FROM a_refs r
WHERE NOT EXISTS (SELECT 1 FROM image_blobs b WHERE b.path = {file_of('r.path')})"""

SQL["options_text"] = "SELECT task_id, options_text FROM option_text"

SQL["question_prompt"] = f"""
SELECT c.task_id, {PROMPT_SQL} AS question_text
FROM cot_source c LEFT JOIN option_text o ON o.task_id = c.task_id"""

SQL["images_collected"] = f"""
SELECT r.task_id,
  count(b.path) FILTER (WHERE r.section = 'question') AS n_question,
  count(b.path) FILTER (WHERE r.section = 'solution') AS n_solution,
  coalesce(string_agg(md5(b.content), ',' ORDER BY r.pos) FILTER (WHERE r.section = 'question' AND b.path IS NOT NULL), '') AS question_md5,
  coalesce(string_agg(md5(b.content), ',' ORDER BY r.pos) FILTER (WHERE r.section = 'solution' AND b.path IS NOT NULL), '') AS solution_md5
FROM a_refs r LEFT JOIN image_blobs b ON b.path = {file_of('r.path')} GROUP BY r.task_id"""

SQL["on_missing_modes"] = f"""
, ok_img AS (
  SELECT e.task_id, e.section, e.pos AS entry_pos, e.content, e.index,
         EXISTS (SELECT 1 FROM image_blobs b WHERE b.path = {file_of('e.content')}) AS found
  FROM a_entries e JOIN status_a s USING (task_id) WHERE s.status = 'ok' AND e.type = 'image'),
bad AS (SELECT DISTINCT task_id FROM ok_img WHERE NOT found)
SELECT 'skip' AS mode, task_id, section, entry_pos, content, index FROM ok_img
UNION ALL
SELECT 'drop_row', task_id, section, entry_pos, content, index FROM ok_img WHERE task_id NOT IN (SELECT task_id FROM bad)
UNION ALL
SELECT 'compact', task_id, section,
       (entry_pos - count(*) FILTER (WHERE NOT found) OVER (PARTITION BY task_id, section ORDER BY entry_pos
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::BIGINT AS entry_pos,
       content, index - (count(*) FILTER (WHERE NOT found) OVER (PARTITION BY task_id, section ORDER BY entry_pos
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::BIGINT AS index
FROM ok_img QUALIFY found"""

SQL["image_validation"] = "SELECT path, length, format, problem, md5, valid FROM image_index"


SQL["flagship"] = f"""
SELECT e.task_id, e.pos, e.type, e.content, e.index AS image_index,
       CASE WHEN e.type = 'image' THEN i.length END AS image_length
FROM b_entries e JOIN status_b s USING (task_id) LEFT JOIN image_index i ON i.path = {file_of('e.content')}
WHERE s.status = 'ok' AND e.section = 'solution'"""

# ---------------------------------------------------------------- ordering (plain SQL on orders)
SPLIT = """
WITH p AS (
  SELECT o_orderkey, (row_number() OVER (ORDER BY md5(concat('42:', o_orderkey)), o_orderkey) - 1)::BIGINT AS perm_idx,
         count(*) OVER () AS n FROM orders),
s AS (SELECT o_orderkey, perm_idx, floor(n::DOUBLE * 0.9::DOUBLE)::BIGINT AS n_train FROM p),
sp AS (
  SELECT o_orderkey, perm_idx, CASE WHEN perm_idx < n_train THEN 'train' ELSE 'test' END AS split,
         CASE WHEN perm_idx < n_train THEN perm_idx ELSE perm_idx - n_train END AS split_idx FROM s)
"""
MANIFEST = """
WITH g AS (SELECT (row_number() OVER (ORDER BY o_orderkey) - 1)::BIGINT AS gi FROM orders),
m AS (SELECT gi // 100 AS shard_id, concat('shard_id=', gi // 100) AS path, count(*) AS num_samples,
             min(gi) AS start_idx, max(gi) + 1 AS end_idx FROM g GROUP BY gi // 100)
"""
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
PLAIN: dict[str, str] = {
    "global_index": "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1)::BIGINT AS gi FROM orders",
    "global_index_text": """SELECT doc_id, source, length(text)::BIGINT AS chars,
        (row_number() OVER (ORDER BY source, doc_id DESC) - 1)::BIGINT AS gi FROM documents""",
    "shards_roundtrip": """WITH g AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1)::BIGINT AS gi FROM orders)
SELECT o_orderkey, gi, gi // 1000 AS shard_id FROM g""",
    "footer_info": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS num_rows FROM {t}" for t in TABLES),
    "shuffle_epoch": """SELECT o_orderkey, 1::BIGINT AS epoch,
        (row_number() OVER (ORDER BY md5(concat('42:1:', o_orderkey)), o_orderkey) - 1)::BIGINT AS gi FROM orders""",
    "train_test_split": SPLIT + "SELECT o_orderkey, perm_idx, split, split_idx FROM sp",
    "split_counts": SPLIT + "SELECT split, count(*) AS num_samples FROM sp GROUP BY split",
    "split_integrity": SPLIT + """
SELECT 'n_total' AS metric, count(*) AS value FROM orders
UNION ALL SELECT 'n_train', count(*) FROM sp WHERE split = 'train'
UNION ALL SELECT 'n_test', count(*) FROM sp WHERE split = 'test'
UNION ALL SELECT 'n_overlap', count(*) FROM (SELECT o_orderkey FROM sp WHERE split = 'train'
                                            INTERSECT ALL SELECT o_orderkey FROM sp WHERE split = 'test')
UNION ALL SELECT 'n_missing', count(*) FROM (SELECT o_orderkey FROM orders EXCEPT ALL SELECT o_orderkey FROM sp)
UNION ALL SELECT 'n_extra', count(*) FROM (SELECT o_orderkey FROM sp EXCEPT ALL SELECT o_orderkey FROM orders)""",
    "shard_manifest": MANIFEST + "SELECT shard_id, path, num_samples, start_idx, end_idx FROM m",
    "mixture": """SELECT 'orders' AS dataset, 0.5::DOUBLE AS weight, count(*) AS num_rows FROM orders
UNION ALL SELECT 'lineitem', 0.5::DOUBLE, count(*) FROM lineitem""",
    "shard_totals": MANIFEST + "SELECT sum(num_samples)::BIGINT AS total_samples, count(*)::BIGINT AS num_files FROM m",
}

PLAIN["pairs_roundtrip"] = PLAIN["shuffle_epoch"]

# ---------------------------------------------------------------- prepared rows and training input

ROWS = f"""
, a_ok AS (SELECT task_id FROM status_a WHERE status = 'ok'),
a_found AS (
  SELECT r.task_id, r.section, r.pos, i.valid, i.md5,
         row_number() OVER (PARTITION BY r.task_id, r.section ORDER BY r.pos) - 1 AS fpos
  FROM a_refs r JOIN a_ok USING (task_id) JOIN image_index i ON i.path = {file_of('r.path')}),
a_nimg AS (SELECT task_id, section, count(*) AS n FROM a_found GROUP BY task_id, section),
a_ent_ok AS (SELECT e.* FROM a_entries e JOIN a_ok USING (task_id)),
a_prob AS (
  SELECT e.task_id, e.section, e.pos,
         CASE WHEN e.index >= coalesce(n.n, 0) THEN 'index_out_of_bounds'
              WHEN NOT f.valid THEN 'undecodable_image' END AS problem
  FROM a_ent_ok e
  LEFT JOIN a_nimg n ON n.task_id = e.task_id AND n.section = e.section
  LEFT JOIN a_found f ON f.task_id = e.task_id AND f.section = e.section AND f.fpos = e.index
  WHERE e.type = 'image'),
a_first AS (
  SELECT task_id, arg_min(problem, CASE WHEN section = 'question' THEN 0 ELSE 1 END * 1000000000 + pos) AS problem
  FROM a_prob WHERE problem IS NOT NULL GROUP BY task_id),
a_sizes AS (
  SELECT task_id, count(*) FILTER (WHERE section = 'question') AS nq, count(*) FILTER (WHERE section = 'solution') AS ns
  FROM a_ent_ok GROUP BY task_id),
a_isizes AS (
  SELECT task_id, count(*) FILTER (WHERE section = 'question') AS nqi, count(*) FILTER (WHERE section = 'solution') AS nsi
  FROM a_found GROUP BY task_id),
a_reason AS (
  SELECT o.task_id, CASE WHEN coalesce(z.nq, 0) = 0 OR coalesce(z.ns, 0) = 0 THEN 'untrainable'
                         ELSE coalesce(f.problem, 'ok') END AS reason
  FROM a_ok o LEFT JOIN a_sizes z USING (task_id) LEFT JOIN a_first f USING (task_id)),
b_ok AS (SELECT task_id FROM status_b WHERE status = 'ok'),
b_sizes AS (
  SELECT task_id, count(*) AS ns, count(*) FILTER (WHERE type = 'image') AS nsi
  FROM b_entries WHERE section = 'solution' GROUP BY task_id),
b_reason AS (
  SELECT o.task_id, CASE WHEN coalesce(z.ns, 0) > 0 THEN 'ok' ELSE 'untrainable' END AS reason
  FROM b_ok o LEFT JOIN b_sizes z USING (task_id)),
b_qtext AS (
  SELECT b.task_id, {PROMPT_SQL} AS question_text FROM b_ok b LEFT JOIN option_text o ON o.task_id = b.task_id),
b_text AS (
  SELECT q.task_id, concat_ws(' ', q.question_text,
         (SELECT string_agg(e.content, ' ' ORDER BY e.pos) FROM b_entries e
          WHERE e.task_id = q.task_id AND e.section = 'solution' AND e.type = 'text')) AS text
  FROM b_qtext q),
b_tok AS (
  SELECT task_id, list_slice(list_transform(
           list_filter(string_split_regex(text, '[\\s\\x0b\\x1c-\\x1f]+'), lambda w: w <> ''),
           lambda w: (('0x' || substr(md5(w), 1, 8))::BIGINT % 65536)::INT), 1, 4096) AS tokens
  FROM b_text),
b_pairs AS (
  SELECT task_id, tokens,
         CASE WHEN len(tokens) <= 1 THEN []::INT[] ELSE list_slice(tokens, 1, len(tokens) - 1) END AS ids,
         CASE WHEN len(tokens) <= 1 THEN []::INT[] ELSE list_slice(tokens, 2, len(tokens)) END AS labels
  FROM b_tok)"""

ROWS_SQL: dict[str, str] = {}

ROWS_SQL["dataset_info"] = """
SELECT count(*) AS num_samples, 'train.parquet' AS file_path,
       'task_id,answer,question_interleave,solution_interleave,question_images,solution_images' AS columns
FROM b_ok"""

ROWS_SQL["interleave_roundtrip"] = """
SELECT concat('task_', task_id) AS key, section, pos, type, content, index FROM a_ent_ok"""

ROWS_SQL["unified_layouts"] = """
SELECT 'a' AS layout, concat('task_', o.task_id) AS key, c.gt AS answer,
       coalesce(z.nq, 0) AS n_question, coalesce(z.ns, 0) AS n_solution,
       coalesce(zi.nqi, 0) AS n_question_images, coalesce(zi.nsi, 0) AS n_solution_images
FROM a_ok o JOIN cot_source c USING (task_id) LEFT JOIN a_sizes z USING (task_id) LEFT JOIN a_isizes zi USING (task_id)
UNION ALL
SELECT 'b', concat('task_', o.task_id), c.gt, 2, coalesce(z.ns, 0), 1, coalesce(z.nsi, 0)
FROM b_ok o JOIN cot_source c USING (task_id) LEFT JOIN b_sizes z USING (task_id)"""

ROWS_SQL["reject_reasons"] = """
SELECT 'a' AS layout, reason, count(*) AS n FROM a_reason GROUP BY reason
UNION ALL SELECT 'b', reason, count(*) FROM b_reason GROUP BY reason"""

ROWS_SQL["sequence_plan"] = f"""
, items AS (
  SELECT 'a' AS layout, concat('task_', e.task_id) AS key, e.section, e.pos AS epos, e.type,
         CASE WHEN e.type = 'text' THEN e.content END AS content,
         CASE WHEN e.type = 'image' THEN e.index END AS image_index,
         CASE WHEN e.type = 'image' THEN e.index END AS image_ordinal,
         CASE WHEN e.type = 'image' THEN f.md5 END AS image_md5,
         e.section = 'solution' AS need_loss, e.type = 'image' AS need_vae, e.type = 'image' AS need_vit,
         TRUE AS enable_cfg,
         CASE WHEN e.section = 'solution' AND e.type = 'text' THEN
              CASE WHEN lead(e.type) OVER w = 'image' THEN '<|vision_start|>'
                   WHEN lead(e.type) OVER w IS NULL THEN '<|endoftext|>' ELSE '<|im_start|>' END END AS special_token
  FROM a_ent_ok e JOIN a_reason r USING (task_id)
  LEFT JOIN a_found f ON f.task_id = e.task_id AND f.section = e.section AND f.fpos = e.index
  WHERE r.reason = 'ok'
  WINDOW w AS (PARTITION BY e.task_id, e.section ORDER BY e.pos)
  UNION ALL
  SELECT 'b', concat('task_', q.task_id), 'question', 0, 'text', q.question_text, NULL, NULL, NULL,
         FALSE, FALSE, FALSE, TRUE, NULL
  FROM b_qtext q JOIN b_reason r USING (task_id) WHERE r.reason = 'ok'
  UNION ALL
  SELECT 'b', concat('task_', e.task_id), e.section, CASE WHEN e.section = 'question' THEN 1 ELSE e.pos END, e.type,
         CASE WHEN e.type = 'text' THEN e.content END,
         CASE WHEN e.type = 'image' THEN e.index END, CASE WHEN e.type = 'image' THEN e.index END,
         CASE WHEN e.type = 'image' THEN i.md5 END,
         e.section = 'solution', e.type = 'image', e.type = 'image', TRUE,
         CASE WHEN e.section = 'solution' AND e.type = 'text' THEN
              CASE WHEN lead(e.type) OVER w2 = 'image' THEN '<|vision_start|>'
                   WHEN lead(e.type) OVER w2 IS NULL THEN '<|endoftext|>' ELSE '<|im_start|>' END END
  FROM b_entries e JOIN b_reason r USING (task_id)
  LEFT JOIN b_refs br ON br.task_id = e.task_id AND br.section = e.section AND br.pos = e.index AND e.type = 'image'
  LEFT JOIN image_index i ON i.path = {file_of('br.path')}
  WHERE r.reason = 'ok'
  WINDOW w2 AS (PARTITION BY e.task_id, e.section ORDER BY e.pos))
SELECT layout, key,
       (row_number() OVER (PARTITION BY layout, key ORDER BY CASE WHEN section = 'question' THEN 0 ELSE 1 END, epos) - 1)::BIGINT AS pos,
       section, type, content, image_index::BIGINT AS image_index, image_ordinal::BIGINT AS image_ordinal, image_md5,
       need_loss, need_vae, need_vit, enable_cfg, special_token
FROM items"""

ROWS_SQL["training_text"] = "SELECT task_id, text FROM b_text"

ROWS_SQL["token_pairs"] = """
SELECT task_id, len(tokens)::BIGINT AS n_tokens, array_to_string(ids, ',') AS input_ids,
       array_to_string(labels, ',') AS labels FROM b_pairs"""

ROWS_SQL["padded_batches"] = """
, g AS (SELECT *, (row_number() OVER (ORDER BY task_id) - 1)::BIGINT AS gi FROM b_pairs),
m AS (SELECT *, gi // 4 AS batch_id, gi % 4 AS row_in_batch, max(len(ids)) OVER (PARTITION BY gi // 4) AS mx FROM g)
SELECT task_id, batch_id, row_in_batch, mx::BIGINT AS batch_max_len,
       array_to_string(ids || list_transform(range(mx - len(ids)), lambda x: 0), ',') AS input_ids,
       array_to_string(labels || list_transform(range(mx - len(ids)), lambda x: -100), ',') AS labels,
       array_to_string(list_transform(range(len(ids)), lambda x: 1) || list_transform(range(mx - len(ids)), lambda x: 0), ',')
         AS attention_mask
FROM m"""

ROWS_SQL["token_budget"] = """
SELECT task_id, len(tokens)::BIGINT AS n_tokens, len(tokens) <= 512 AS kept FROM b_tok"""

ROWS_SQL["registry_lookup"] = """
SELECT 'interleaved_cot' AS type, 'cot_train' AS name, 'train' AS data_dir,
       'train/_manifest' AS parquet_info_path, count(*) AS num_total_samples, ceil(count(*) / 100)::BIGINT AS num_files
FROM a_ok"""

ROWS_SQL["preview"] = """
, first AS (SELECT min(task_id) AS task_id FROM b_ok)
SELECT f.task_id, c.gt AS answer, 2::BIGINT AS n_question, coalesce(z.ns, 0) AS n_solution,
       1::BIGINT AS n_question_images, coalesce(z.nsi, 0) AS n_solution_images,
       concat(left(q.question_text, 50), '...', ' | index=0') AS question_preview
FROM first f JOIN cot_source c USING (task_id) JOIN b_qtext q USING (task_id) LEFT JOIN b_sizes z USING (task_id)"""

LENGTHS = """
, lens AS (SELECT o.task_id, 2::BIGINT AS n_question, coalesce(z.ns, 0) AS n_solution, 1::BIGINT AS n_question_images,
                  coalesce(z.nsi, 0) AS n_solution_images FROM b_ok o LEFT JOIN b_sizes z USING (task_id))
"""
ROWS_SQL["length_profile"] = LENGTHS + "SELECT * FROM lens"
ROWS_SQL["length_summary"] = LENGTHS + """
SELECT count(*) AS rows, min(n_solution) AS min_solution, max(n_solution) AS max_solution,
       sum(n_solution)::BIGINT AS sum_solution, sum(n_solution_images)::BIGINT AS sum_solution_images FROM lens"""


# ---------------------------------------------------------------- written and read back, by other ways
PLAIN["shard_groups"] = """
SELECT gi // 1000 AS shard_id, count(*)::BIGINT AS num_samples, min(gi) AS start_idx, max(gi) + 1 AS end_idx, TRUE AS agree
FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS gi FROM orders) GROUP BY 1"""

PLAIN["split_by_cut"] = """
SELECT o_orderkey, CASE WHEN place < floor(n * 0.9::DOUBLE) THEN 'train' ELSE 'test' END AS split
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY md5(concat('42:', o_orderkey)), o_orderkey) - 1 AS place, count(*) OVER () AS n FROM orders)"""

PLAIN["mixture_files"] = """
SELECT 'firsts' AS dataset, 2.0::DOUBLE AS weight, count(*) AS num_rows, min(gi)::BIGINT AS first_gi, max(gi)::BIGINT AS last_gi
FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS gi FROM orders) WHERE gi < 200
UNION ALL SELECT 'whole', 2.0, count(*), NULL, NULL FROM customer"""

SQL["array_roundtrip"] = SQL["cot_normalised"]

SQL["options_files"] = SQL["options_text"]

PLAIN["malformed_interleave"] = f"""
SELECT concat('task_', conv_id) AS key, CASE conv_id % 10 {" ".join(f"WHEN {k} THEN '{v}'" for k, v in X.STORED.items())} END AS reason,
  CASE WHEN conv_id % 10 BETWEEN 1 AND 5 THEN -1 WHEN conv_id % 10 = 6 THEN 0 WHEN conv_id % 10 = 7 THEN 1 ELSE 2 END::BIGINT AS n_question
FROM conversations WHERE turn = 0"""

SQL["images_by_path"] = f"""
SELECT p AS path, b.path IS NOT NULL AS found, octet_length(content)::BIGINT AS length, md5(content) AS md5
FROM (SELECT DISTINCT {file_of('path')} AS p FROM a_refs) LEFT JOIN image_blobs b ON b.path = p"""

_ITEMS, _LAST = ROWS_SQL["sequence_plan"].rsplit("SELECT layout, key,", 1)
ROWS_SQL["sequence_rows"] = _ITEMS.rstrip() + ", told AS (SELECT layout, key," + _LAST + """)
SELECT layout, key, count(*) AS n_items, string_agg(concat(section, ':', type, ':', coalesce(special_token, '')), ',' ORDER BY pos) AS items
FROM told GROUP BY layout, key"""


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, body in SQL.items():
        body = body.strip()
        out[name] = (PREFIX.rstrip() + body if body.startswith(",") else PREFIX + body) + "\n"
    for name, body in ROWS_SQL.items():
        body = body.strip()
        base = PREFIX.rstrip() + ROWS.rstrip()
        out[name] = (base + body if body.startswith(",") else base + "\n" + body) + "\n"
    for name, body in PLAIN.items():
        out[name] = body.strip() + "\n"
    return out
