"""The operators in DuckDB SQL, where it can express them."""

from __future__ import annotations

NGRAM_JOIN = r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_have >= 75 * (x.n + y.n - both_have)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, u.b FROM r JOIN u ON u.a = r.seen)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(seen) AS component_id FROM r GROUP BY 1) c ON c.node = d.doc_id"""

DECONTAMINATION = r"""WITH dw AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents),
bw AS (SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(len(words), 13) AS k, array_to_string(words[i:i + 12], ' ') AS g FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM bw WHERE len(words) > 0)),
lens AS (SELECT DISTINCT k FROM win),
pos AS (SELECT doc_id, i, k, array_to_string(words[i:i + k - 1], ' ') AS g FROM (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM dw, lens WHERE len(words) >= k)),
hits AS (SELECT doc_id, i, pos.k AS k, item_id FROM pos JOIN win ON pos.g = win.g AND pos.k = win.k),
marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits WHERE item_id IS NOT NULL GROUP BY 1)
SELECT dw.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated FROM dw LEFT JOIN marked USING (doc_id) LEFT JOIN items USING (doc_id)"""

EXACT_DEDUP = r"""WITH b AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM b GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM b JOIN g USING (body)"""

#: A SHA-1 has eight groups of twenty bits, each four letters of base 32.
WARC_REVISITS = """WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(hex, (i // 4) * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest FROM p),
m AS (SELECT payload_digest, min(page_id) AS first_id FROM d GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d JOIN m USING (payload_digest)"""

CHAT_FORMAT = r"""WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations UNION ALL
  SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(role) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars,
  bool_and(CASE WHEN turn = 0 THEN role IN ('system', 'user') ELSE (before, role) IN (('system', 'user'), ('user', 'assistant'), ('assistant', 'user')) END) AS valid,
  min(CASE WHEN NOT CASE WHEN turn = 0 THEN role IN ('system', 'user') ELSE (before, role) IN (('system', 'user'), ('user', 'assistant'), ('assistant', 'user')) END THEN turn + 1 END) AS broke_at
FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM c) GROUP BY conv_id"""

FILL_IN_MIDDLE = """WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t, sha256('1:' || doc_id) AS hex FROM documents),
h AS (SELECT doc_id, text, t, len(t) AS n, CAST('0x' || hex[1:8] AS BIGINT) AS h1, CAST('0x' || hex[9:16] AS BIGINT) AS h2, CAST('0x' || hex[17:24] AS BIGINT) AS h3, CAST('0x' || hex[25:32] AS BIGINT) AS h4 FROM d),
f AS (SELECT doc_id, text, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT doc_id, text, n, form, array_to_string(t[1:a], '') AS pre, array_to_string(t[a + 1:b], '') AS mid, array_to_string(t[b + 1:n], '') AS suf FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""

SQL = {
    "op1_ngram_jaccard_join": NGRAM_JOIN,
    "op2_decontamination": DECONTAMINATION,
    "op3_exact_dedup": EXACT_DEDUP,
    "op6_warc_revisits": WARC_REVISITS,
    "op11_chat_format": CHAT_FORMAT,
    "op12_fill_in_middle": FILL_IN_MIDDLE,
}
