"""DuckDB SQL for the corpus queries that SQL can express; nothing is shared with the Spark code but column names."""

from __future__ import annotations

OP7 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d),
grams AS (
  SELECT doc_id, pos, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c
  FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
twice AS (
  SELECT doc_id, pos FROM grams WHERE c IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT pos + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
split AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(t) - length(regexp_replace(t, '!', '', 'g')) AS BIGINT) AS n_bang,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN split ON d.doc_id = split.doc_id LEFT JOIN covered ON d.doc_id = covered.doc_id),
f AS (
  SELECT *, CAST(
    CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 60 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_bang > 50 * n_words THEN 32 ELSE 0 END AS BIGINT) AS failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, failed = 0 AS kept
FROM f
"""

OP8 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS words
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
spans AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM starts, (SELECT DISTINCT n FROM windows) WHERE i + n - 1 <= len(w)),
found AS (SELECT doc_id, i, spans.n, item FROM spans JOIN windows ON spans.n = windows.n AND spans.words = windows.words),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM found)
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""

OP5 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
edges AS (
  SELECT u, v FROM (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY 1, 2) p
  JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT reach.a, edges.v FROM reach JOIN edges ON edges.u = reach.b),
least_of AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN least_of ON d.doc_id = a LEFT JOIN sizes ON d.doc_id = sizes.doc_id
"""

OP11 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
    sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex
  FROM documents),
h AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n,
    CAST('0x' || hex[1:8] AS BIGINT) AS h1, CAST('0x' || hex[9:16] AS BIGINT) AS h2,
    CAST('0x' || hex[17:24] AS BIGINT) AS h3, CAST('0x' || hex[25:32] AS BIGINT) AS h4
  FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
         WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
p AS (
  SELECT *, array_to_string(u[1:low], '') AS a, array_to_string(u[low + 1:high], '') AS b,
    array_to_string(u[high + 1:n], '') AS z
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(a) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(b) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || b
              ELSE '<S>' || z || '<P>' || a || '<M>' || b END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""

OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
runs AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k)
        WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM runs GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10),
inner_ AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a AS longer
  FROM cand WHERE k = 3),
covered AS (
  SELECT DISTINCT cand.lang, cand.phrase FROM cand JOIN inner_ ON cand.lang = inner_.lang AND cand.phrase = inner_.phrase
  WHERE 100 * longer >= 50 * a),
kept AS (SELECT cand.* FROM cand ANTI JOIN covered ON cand.lang = covered.lang AND cand.phrase = covered.phrase),
cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS lp, array_to_string(w[cut + 1:k], ' ') AS rp
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept)),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, cut, x.a AS l, y.a AS r,
    CAST((CAST(1000000 AS HUGEINT) * cuts.a * cuts.a) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lp JOIN f y ON y.lang = cuts.lang AND y.phrase = rp),
least_ AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM least_)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
"""

OP13 = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, CASE WHEN embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN CAST(embedding AS DOUBLE[]) END AS e
  FROM embeddings),
edges AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT reach.a, edges.v FROM reach JOIN edges ON edges.u = reach.b),
least_of AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT u, count(*) AS n FROM edges GROUP BY u)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least_of ON vec_id = a LEFT JOIN degree ON vec_id = u
"""

ORACLES: dict[str, str] = {
    "op5_minhash": OP5, "op7_rule_ledger": OP7, "op8_decontaminate": OP8, "op11_fenwick_infill": OP11,
    "op12_phrase_automata": OP12, "op13_int8_vectors": OP13,
}
