"""The registered corpus queries and their SQL."""

from __future__ import annotations

from eventide.llm.decontaminate import op4_decontamination
from eventide.llm.filteraudit import op13_filter_audit
from eventide.llm.htmltext import op9_html_extraction
from eventide.llm.linecrf import op11_quality_classifier
from eventide.llm.linededup import op6_line_dedup
from eventide.llm.mixing import op7_mixing
from eventide.llm.pii import op3_pii
from eventide.llm.quality import op10_quality_rules
from eventide.llm.runs import op12_periodic_runs
from eventide.llm.sharding import op8_sharding
from eventide.llm.simhash import op2_simhash
from eventide.llm.substrings import op5_suffix_dedup
from eventide.llm.tokens import op1_token_counts

QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_simhash, op3_pii, op4_decontamination, op5_suffix_dedup, op6_line_dedup, op7_mixing,
    op8_sharding, op9_html_extraction, op10_quality_rules, op11_quality_classifier, op12_periodic_runs,
    op13_filter_audit)}

# Not SQL: tokenizer, xxHash fingerprints, learned rules and models, HTML events; op3, op5,
# op7, op8 and op12 need parsers, suffixes or hashes that DuckDB lacks.
SQL = {
    "op6_line_dedup": r"""
WITH parts AS (
  SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, r, generate_subscripts(lines, 1) AS i, unnest(lines) AS line FROM parts),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
often AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE o.k IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE o.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN often o ON keyed.k = o.k GROUP BY r""",
    # every order is followed filter by filter, document class by document class
    "op13_filter_audit": r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
worded AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY t) AS least FROM texts),
marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
classes AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > least, false) AS e, count(*) AS n
  FROM worded LEFT JOIN marks USING (doc_id) GROUP BY ALL),
failing AS (
  SELECT part, good, toxic, n, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
                CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS f FROM classes),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT concat(p.x, q.x, r.x, s.x, u.x) AS o FROM letters p, letters q, letters r, letters s, letters u
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
steps AS (SELECT o, k::INT AS step, substr(o, k, 1) AS x, substr(o, 1, k - 1) AS before FROM orders, range(1, 6) AS g(k)),
counted AS (
  SELECT part, o AS filter_order, step, x,
         sum(n) FILTER (WHERE strpos(f, x) = 0 AND translate(f, before, '') = f) AS kept,
         sum(n) FILTER (WHERE strpos(f, x) > 0 AND translate(f, before, '') = f) AS removed,
         sum(n) FILTER (WHERE strpos(f, x) > 0 AND translate(f, before, '') <> f) AS redundant,
         sum(n) FILTER (WHERE f = x) AS unique_fails,
         sum(n) FILTER (WHERE strpos(f, x) > 0 AND translate(f, before, '') = f AND good = 1) AS good_lost,
         sum(n) FILTER (WHERE strpos(f, x) > 0 AND translate(f, before, '') = f AND toxic = 1) AS toxic_lost
  FROM failing, steps GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       sum(coalesce(removed, 0)) OVER (PARTITION BY part, x)::BIGINT AS shapley
FROM counted""",
}
