"""DuckDB twins of the queries that SQL can express."""

LINE_QUALITY = r"""
WITH d AS (
  SELECT row_number() OVER () rid, doc_id, source host, coalesce(text, '') t FROM documents),
w AS (SELECT rid, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') words FROM d),
win AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] g
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) i FROM w WHERE len(words) > 2)),
rep AS (
  SELECT rid, count(DISTINCT p) n FROM (
    SELECT rid, unnest([i, i + 1, i + 2]) p FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) c FROM win) WHERE c > 1)
  GROUP BY rid),
ln AS (
  SELECT rid, line, pos FROM (SELECT rid, unnest(string_split(t, chr(10))) line, unnest(range(len(string_split(t, chr(10))))) pos FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT rid, count(*) - count(DISTINCT line) n FROM ln GROUP BY rid),
nl AS (
  SELECT d.host, d.t, min(doc_id) id, k, any_value(wds) wds FROM (
    SELECT rid, k, sum(c) wds FROM (
      SELECT rid, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) c,
        regexp_replace(regexp_replace(lower(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))),
          '[\x20\x09-\x0D]+', ' ', 'g'), '[0-9]+', '0', 'g') k FROM ln) GROUP BY rid, k) x
  JOIN d USING (rid) GROUP BY d.host, d.t, k),
hosts AS (SELECT host, count(DISTINCT t) n FROM d GROUP BY host),
held AS (SELECT host, k, count(*) n, arg_min(t, id) keeper FROM nl GROUP BY host, k),
often AS (
  SELECT h.host, k, keeper FROM held h JOIN hosts o ON h.host IS NOT DISTINCT FROM o.host
  WHERE h.n > greatest(10, o.n * 0.005::DOUBLE)),
gone AS (
  SELECT nl.host, nl.t, sum(wds) n FROM nl JOIN often o ON nl.host IS NOT DISTINCT FROM o.host AND nl.k = o.k AND nl.t <> o.keeper
  GROUP BY nl.host, nl.t),
m AS (
  SELECT d.doc_id, len(w.words)::BIGINT n_words, length(regexp_replace(d.t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT word_chars,
    length(regexp_replace(d.t, '[^#*$%&|<>]', '', 'g'))::BIGINT n_symbols, coalesce(dup.n, 0)::BIGINT n_dup_lines,
    coalesce(rep.n, 0)::BIGINT n_repeat_words, coalesce(gone.n, 0)::BIGINT boilerplate_words
  FROM d JOIN w USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid)
  LEFT JOIN gone ON gone.host IS NOT DISTINCT FROM d.host AND gone.t = d.t)
SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - boilerplate_words >= 0.2::DOUBLE * n_words kept
FROM m
"""

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT size,
    (('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE u
  FROM documents),
r AS (SELECT *, CASE WHEN size > 0 THEN u / (1.0::DOUBLE - u) / pow(size::DOUBLE, 0.5) END rk FROM d),
s AS (
  SELECT source, sum(size)::BIGINT source_size,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] w
  FROM d GROUP BY source),
c AS (SELECT *, 3 * source_size cap, row_number() OVER (ORDER BY 3 * source_size / w::DOUBLE, source NULLS LAST) k FROM s),
l AS (
  SELECT *, ((sum(source_size) OVER ()) - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM c),
t AS (
  SELECT source, source_size, least((SELECT arg_min(level, k) FROM l WHERE level * w <= cap) * w, cap::DOUBLE) target FROM l),
n AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END whole FROM t),
x AS (
  SELECT r.doc_id, r.size, n.source_size, n.target, n.whole,
    size > 0 AND (sum(size) OVER (PARTITION BY r.source ORDER BY rk, doc_id ROWS UNBOUNDED PRECEDING)) - size / 2.0::DOUBLE
      <= n.target - n.whole * n.source_size AS extra
  FROM r JOIN n ON r.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN whole + extra::INT ELSE 0 END::BIGINT copies,
  (size * (whole + extra::INT))::BIGINT taken
FROM x
"""

LINE_CHUNKS = r"""
WITH d AS (SELECT row_number() OVER () rid, doc_id, string_split(coalesce(text, ''), chr(10)) lines FROM documents),
l AS (
  SELECT rid, i, w, sum(w) OVER (PARTITION BY rid ORDER BY i)::BIGINT c
  FROM (SELECT rid, i, len(regexp_extract_all(lines[i + 1], '[^\x20\x09-\x0D]+')) w FROM (SELECT rid, lines, unnest(range(len(lines))) i FROM d))
  WHERE w > 0),
f AS (
  SELECT a.rid, a.i first_line, greatest(b.i, a.i + 1) last_line FROM (SELECT *, c - w + 20 need FROM l) a ASOF JOIN l b ON a.rid = b.rid AND a.need <= b.c),
k AS (
  SELECT a.rid, least(b.i, a.i - 1) first_line, a.i last_line
  FROM (SELECT *, c - 20 need FROM l) a ASOF JOIN (SELECT *, c - w c0 FROM l) b ON a.rid = b.rid AND a.need >= b.c0),
r AS (FROM f UNION FROM k UNION SELECT rid, i, i FROM l WHERE w >= 50),
g AS (
  SELECT rid, doc_id, first_line, last_line, array_to_string(lines[first_line + 1:last_line + 1], chr(10)) body
  FROM r JOIN d USING (rid) WHERE first_line >= 0 AND last_line < len(lines)),
o AS (
  SELECT rid, doc_id, first_line, last_line, count(*) OVER (PARTITION BY body, last_line - first_line) occurrences,
    first_value(rid) OVER p first_rid, first_value(doc_id) OVER p first_id, first_value(first_line) OVER p first_start
  FROM g WINDOW p AS (PARTITION BY body, last_line - first_line ORDER BY doc_id NULLS FIRST, rid, first_line)),
gone AS (
  SELECT *, max(last_line) OVER (PARTITION BY rid ORDER BY first_line, last_line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) reach
  FROM o WHERE occurrences > 1 AND (rid <> first_rid OR first_line > first_start + last_line - first_line)),
run AS (SELECT *, sum(coalesce(first_line > reach + 1, true)::INT) OVER (PARTITION BY rid ORDER BY first_line, last_line ROWS UNBOUNDED PRECEDING) run FROM gone)
SELECT doc_id, min(first_line)::BIGINT start_line, max(last_line)::BIGINT end_line, min(first_id) first_doc_id, max(occurrences)::BIGINT occurrences
FROM run GROUP BY rid, doc_id, run
"""

HARD_NEGATIVES = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id anchor_id, a.label alabel, b.vec_id other, b.label, list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i]))::BIGINT score
  FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, alabel, other positive_id, score positive_score FROM s WHERE label = alabel
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, s.other negative_id, positive_score, s.score negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other)::INT AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND s.label <> s.alabel
    AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

PHRASES = r"""
WITH d AS (
  SELECT row_number() OVER () rid, coalesce(lang, 'und') lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t FROM documents),
p AS (SELECT rid, lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') w FROM p),
g AS (
  SELECT lang, w[i:i + k - 1] g FROM (
    SELECT lang, w, i, unnest(range(1, 1 + least(5, len(w) - i + 1))) k FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) i FROM w))),
c AS (SELECT lang, g, count(*)::HUGEINT f FROM g GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w))::HUGEINT n FROM w GROUP BY lang),
cand AS (SELECT * FROM c WHERE len(g) > 1),
held AS (
  SELECT DISTINCT lang, sub, f FROM (
    SELECT lang, f, unnest(list_filter([g[1:len(g) - 1], g[2:], g[2:len(g) - 1], g[1:len(g) - 2], g[3:], g[1:len(g) - 3], g[4:], g[3:len(g) - 1], g[2:len(g) - 2]],
      lambda x: len(x) > 1)) sub FROM cand WHERE len(g) > 2)),
free AS (SELECT * FROM cand WHERE NOT EXISTS (FROM held WHERE held.lang = cand.lang AND sub = g AND 100 * held.f >= 100 * cand.f)),
cut AS (
  SELECT x.lang, x.g, x.f a, k, l.f l, r.f r, n.n, (1000 * x.f * n.n) // (l.f * r.f) score
  FROM (SELECT *, unnest(range(1, len(g))) k FROM free) x
  JOIN c l ON l.lang = x.lang AND l.g = x.g[1:k] JOIN c r ON r.lang = x.lang AND r.g = x.g[k + 1:] JOIN n ON n.lang = x.lang),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
o AS (SELECT *, array_to_string(g, ' ') phrase FROM best)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT a, l::BIGINT l, r::BIGINT r,
  n::BIGINT n, score::BIGINT score
FROM o QUALIFY rank <= 2000
"""
