"""SQL that gives the results of training-data queries, where SQL can."""

from quern.plans.sql import gpt2_pieces

_WORDS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"

P2_FOUND = f"""
WITH c AS (SELECT DISTINCT conv_id, {_WORDS.format("coalesce(prompt, '') || ' ' || coalesce(response, '')")} AS w FROM sft_conversations),
  s AS (SELECT conv_id, list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS g FROM c WHERE len(w) >= 20),
  e AS (SELECT conv_id, unnest(g) AS g FROM s), n AS (SELECT conv_id, len(g) AS n FROM s),
  p AS (SELECT a.conv_id AS conv_a, b.conv_id AS conv_b, count(*) AS shared FROM e a JOIN e b ON a.g = b.g AND a.conv_id < b.conv_id GROUP BY 1, 2)
SELECT conv_a, conv_b FROM p JOIN n x ON x.conv_id = conv_a JOIN n y ON y.conv_id = conv_b WHERE shared * 10 >= 7 * (x.n + y.n - shared)
"""

_CONVERSATION = _WORDS.format("coalesce(prompt, '') || ' ' || coalesce(response, '')")
_FIVE = "list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))"

P2_GROUPS = f"""
WITH c AS (SELECT DISTINCT conv_id, {_CONVERSATION} AS w FROM sft_conversations),
  s AS (SELECT conv_id, list_sort(list_distinct({_FIVE})) AS g FROM c WHERE len(w) >= 5),
  k AS (SELECT g, min(conv_id) AS rep, count(DISTINCT conv_id) AS copies, len(g) AS n FROM s GROUP BY g),
  e AS (SELECT rep, n, unnest(g) AS g FROM k),
  p AS (SELECT a.rep FROM e a JOIN e b ON a.g = b.g AND a.rep <> b.rep GROUP BY a.rep, b.rep, a.n, b.n HAVING count(*) * 10 >= 8 * (a.n + b.n - count(*))),
  l AS (SELECT rep, count(*) AS links FROM p GROUP BY rep)
SELECT s.conv_id, k.rep, k.copies, coalesce(l.links, 0)::BIGINT AS links FROM (SELECT DISTINCT * FROM s) s JOIN k USING (g) LEFT JOIN l ON l.rep = k.rep
"""

P2_WEIGHTED = f"""
WITH c AS (SELECT DISTINCT conv_id, {_CONVERSATION} AS w FROM sft_conversations),
  s AS (SELECT conv_id, list_sort({_FIVE}) AS g FROM c WHERE len(w) >= 5),
  k AS (SELECT g, min(conv_id) AS rep FROM s GROUP BY g),
  e AS (SELECT rep, g, count(*)::DOUBLE AS x FROM (SELECT rep, unnest(g) AS g FROM k) GROUP BY 1, 2),
  p AS (SELECT a.rep AS rep_a, b.rep AS rep_b FROM e a JOIN e b ON a.g = b.g AND a.rep < b.rep GROUP BY 1, 2),
  u AS (SELECT rep_a, rep_b, g, sum(x) AS x, sum(y) AS y FROM (SELECT rep_a, rep_b, g, x, 0.0::DOUBLE AS y FROM p JOIN e ON e.rep = rep_a UNION ALL SELECT rep_a, rep_b, g, 0.0::DOUBLE, x FROM p JOIN e ON e.rep = rep_b) GROUP BY 1, 2, 3),
  r AS (SELECT *, CASE WHEN x > 0 THEN y / x ELSE 'inf'::DOUBLE END AS r FROM u),
  t AS (SELECT *, sum(x) OVER w AS first, sum(y) OVER (PARTITION BY rep_a, rep_b) - sum(y) OVER w AS rest FROM r WINDOW w AS (PARTITION BY rep_a, rep_b ORDER BY r RANGE UNBOUNDED PRECEDING)),
  m AS (SELECT rep_a, rep_b, sum(1.0::DOUBLE / (first / x + rest / y)) AS similarity FROM t WHERE x > 0 AND y > 0 GROUP BY 1, 2)
SELECT rep_a, rep_b, round(similarity, 6) AS similarity FROM m WHERE similarity >= 0.8 - 1e-12
"""

P3_FOUND = """
WITH r AS (SELECT DISTINCT p.example_id, p.run_id, p.seq_no, p.input_ids, bos_id, eos_id, pad_id, sequence_length FROM packed_examples p JOIN pack_runs USING (run_id)),
  l AS (SELECT *, list_max(list_transform(range(1, len(input_ids) + 1), lambda i: CASE WHEN input_ids[i] <> pad_id THEN i ELSE 0 END)) AS n FROM r),
  t AS (SELECT *, unnest(input_ids[1:n]) AS t, generate_subscripts(input_ids[1:n], 1) AS i FROM l),
  k AS (SELECT *, sum((t = bos_id)::INT) OVER w AS item FROM t WINDOW w AS (PARTITION BY run_id ORDER BY seq_no, i)),
  f AS (SELECT *, sum((t = eos_id)::INT) OVER (PARTITION BY run_id, item ORDER BY seq_no, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ended, max((t = eos_id)::INT) OVER (PARTITION BY run_id, item) AS ends FROM k WHERE item > 0),
  m AS (SELECT run_id, item FROM f WHERE ends = 1 AND coalesce(ended, 0) = 0 GROUP BY run_id, item
    HAVING count(*) <= max(sequence_length) AND count(DISTINCT seq_no) > 1 AND max(seq_no) - min(seq_no) + 1 = count(DISTINCT seq_no))
SELECT DISTINCT example_id FROM f JOIN m USING (run_id, item) WHERE coalesce(ended, 0) = 0
"""

P3_TOTALS = f"""
WITH c AS (SELECT DISTINCT sequence_length AS row_length FROM pack_runs WHERE sequence_length > 0),
  d AS (SELECT conv_id, max(CASE WHEN token_count > 0 THEN token_count ELSE len({gpt2_pieces("text")}) END) + 2 AS n FROM sft_conversations GROUP BY 1)
SELECT row_length, count(*) AS items, count(CASE WHEN n > row_length THEN 1 END) AS items_cut, sum(n)::BIGINT AS places_used, ceil(sum(n) / row_length)::BIGINT AS least_bins, true AS within_bound FROM c, d GROUP BY 1
"""

P5_FOUND = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents WHERE text IS NOT NULL),
  g AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' '))) AS g FROM d WHERE len(w) >= 10),
  e AS (SELECT item_id, {_WORDS.format("passage")} AS w, array_to_string({_WORDS.format("question")}, ' ') AS q FROM eval_items),
  p AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' '))) AS g FROM e WHERE len(w) >= 10)
SELECT DISTINCT doc_id, item_id FROM g JOIN p USING (g)
UNION SELECT doc_id, item_id FROM d JOIN e ON e.q <> '' AND contains(' ' || array_to_string(d.w, ' ') || ' ', ' ' || e.q || ' ')
"""
