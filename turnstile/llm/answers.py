"""SQL answers to the queries of this folder (DuckDB dialect), where SQL can express them.

Language ID by random vectors, suffix-tree scores, MinHash fingerprints and the Hilbert order
are left to the tests.
"""

from __future__ import annotations

WORDS = r"coalesce(regexp_extract_all({0}, '[^\x20\x09-\x0D]+'), [])"
LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
FOLDED = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  CAST(((CAST('0x' || substr(sha1(html), CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1 AS INTEGER), 1)), '')"""

WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {BASE32} AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to,
       CASE WHEN page_id = last THEN TRUE END AS payload_intact
FROM d"""

MIX = f"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS.format("text")}) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][rank % 3 + 1] AS weight FROM s),
f AS (SELECT *, coalesce(sum(source_size) OVER earlier, 0) AS size_before, coalesce(sum(weight) OVER earlier, 0) AS weight_before FROM w
      WINDOW earlier AS (ORDER BY 2 * source_size / CAST(weight AS DOUBLE), rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT CAST(3 * (SELECT sum(source_size) FROM w) - 4 * size_before AS BIGINT) AS spare,
             CAST((SELECT sum(weight) FROM w) - weight_before AS BIGINT) AS rest FROM f),
b AS (SELECT spare, rest FROM l ORDER BY CAST(spare AS DOUBLE) / rest DESC, spare DESC LIMIT 1),
t AS (SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), CAST(spare * weight AS DOUBLE) / CAST(2 * rest AS DOUBLE)) AS target FROM w, b),
r AS (SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT)
             - coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, least(greatest(room, 0), size) AS once, least(greatest(room - source_size, 0), size) AS twice FROM r)
SELECT doc_id, size, source_size, target, CAST(once + twice AS BIGINT) AS taken, CAST(once > 0 AS INTEGER) + CAST(twice > 0 AS INTEGER) AS copies FROM k"""

JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(LOWER.format("text"))} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(1, len(ws) - 4) + 1), lambda i: array_to_string(ws[i:i + 4], ' '))) AS g FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
r(id, root) AS (SELECT doc_id, doc_id FROM w UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, (SELECT min(root) FROM r WHERE id = w.doc_id) AS component_id FROM w LEFT JOIN n USING (doc_id)"""

MINHASH = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(LOWER.format("text"))} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(ws[i:i + 3], ' ')) AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 3) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
r(id, root) AS (SELECT doc_id, doc_id FROM w UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id),
m AS (SELECT id AS doc_id, min(root) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)"""

CONTAMINATION = f"""
WITH d AS (SELECT doc_id, {FOLDED.format("text")} AS ws FROM documents),
i AS (SELECT item_id, {FOLDED.format("text")} AS ws FROM benchmark),
w AS (SELECT DISTINCT item_id, least(len(ws), 10) AS size, unnest(list_transform(range(1, greatest(1, len(ws) - 9) + 1), lambda k: array_to_string(ws[k:k + 9], ' '))) AS win FROM i WHERE len(ws) > 0),
p AS (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS k FROM d, (SELECT DISTINCT size FROM w)),
h AS (SELECT doc_id, k, size, item_id FROM (SELECT doc_id, k, size, array_to_string(ws[k:k + size - 1], ' ') AS win FROM p) JOIN w USING (size, win)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS pos FROM h) GROUP BY 1),
own AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN own USING (doc_id)"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
f AS (SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
        sum(length('<|im_start|>') + length(role) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + length('<|im_end|>') + 1) AS chars
      FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM f"""

REPEATS = f"""
WITH d AS (SELECT doc_id, {WORDS.format("text")} AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS k, ws FROM d WHERE len(ws) >= 50),
h AS (SELECT doc_id, k, md5(array_to_string(ws[k:k + 49], ' ')) AS win FROM p),
f AS (SELECT win, min(doc_id) AS first FROM h GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 50)) AS pos FROM h JOIN f USING (win) WHERE first < doc_id),
u AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM d),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n FROM u ANTI JOIN gone USING (doc_id, pos) GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""

AUDIT = f"""
WITH RECURSIVE orders(filter_order) AS (
  SELECT '' UNION SELECT filter_order || letter FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter) WHERE NOT contains(filter_order, letter)),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders WHERE len(filter_order) = 5),
d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {WORDS.format("coalesce(text, '')")} AS ws FROM documents),
f AS (SELECT part, quality = 1 AS good, toxic = 1 AS toxic,
        concat(CASE WHEN len(ws) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' END,
               CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) THEN 'C' END,
               CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
               CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' END) AS fails
      FROM d LEFT JOIN labels USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY ALL),
s AS (SELECT *, contains(fails, filter_order[step]) AS failing, fails = translate(fails, filter_order[1:step - 1], '') AS reached FROM c, steps),
r AS (SELECT part, filter_order, step, filter_order[step] AS letter, sum(CASE WHEN NOT failing AND reached THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN failing AND reached THEN n ELSE 0 END) AS removed, sum(CASE WHEN failing AND NOT reached THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN fails = filter_order[step] THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN failing AND reached THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN failing AND reached THEN toxic ELSE 0 END) AS toxic_lost
      FROM s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM r"""


def answers() -> dict[str, str]:
    return {
        "op2_warc": WARC,
        "op3_curriculum_mix": MIX,
        "op4_ngram_jaccard": JACCARD,
        "op5_decontaminate": CONTAMINATION,
        "op6_chat": CHAT,
        "op7_substring_dedup": REPEATS,
        "op11_filter_audit": AUDIT,
        "op12_minhash_bands": MINHASH,
    }
