"""SQL for the queries of this package that SQL can express (DuckDB, over the whole tables)."""

from __future__ import annotations

from starmart.llm.collocations import Phrases
from starmart.llm.quality_rules import BASE_RULES, RULES, HostPolicy
from starmart.llm.ranked_search import Ranking

_FAILS = ", ".join(f"({rule}) AS fails_{name}" for name, rule in RULES.items())


def quality_rules(policy: HostPolicy = HostPolicy()) -> str:
    return rf"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
placed AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM texts),
windows AS (
  SELECT doc_id, i, w AS a, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c
  FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
repeated AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows WHERE c IS NOT NULL) x
  WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, i AS p FROM repeated UNION ALL SELECT doc_id, i + 1 FROM repeated
    UNION ALL SELECT doc_id, i + 2 FROM repeated) y
  GROUP BY doc_id),
counts AS (
  SELECT doc_id, host, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars,
         len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM texts LEFT JOIN covered USING (doc_id)),
failing AS (SELECT *, {_FAILS} FROM counts),
judged AS (SELECT *, ({" OR ".join(f"fails_{r}" for r in RULES)}) AS fails_any,
                  ({" OR ".join(f"fails_{r}" for r in BASE_RULES)}) AS base_failed FROM failing),
hosts AS (SELECT host, count(*) AS n, count(*) FILTER (fails_any) AS f FROM judged GROUP BY host),
sums AS (SELECT sum(n) AS docs, count(*) AS hosts, sum(f) / sum(n) AS m,
                sum(f * f / n) / sum(n) - (sum(f) / sum(n)) * (sum(f) / sum(n)) AS spread FROM hosts),
prior AS (SELECT m, CASE WHEN spread > m * (1 - m) * hosts / docs
                    THEN greatest(1.0, least(1e6, m * (1 - m) / (spread - m * (1 - m) * hosts / docs) - 1)) ELSE 1e6 END AS k FROM sums),
verdicts AS (SELECT host, n >= {policy.min_documents} AND (f + m * k) / (n + k) > {policy.max_rate} AS host_rejected FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT host_rejected AS kept, host, host_rejected
FROM judged JOIN verdicts USING (host)"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def collocations(policy: Phrases = Phrases()) -> str:
    sizes = range(1, policy.longest + 1)
    ahead = ", ".join(f"lead(w, {k - 1}) OVER o AS w{k}" for k in sizes)
    counted = " UNION ALL ".join(
        f"SELECT lang, {k} AS size, {" || ' ' || ".join(f'w{j}' for j in range(1, k + 1))} AS phrase, count(*) AS f "
        f"FROM windows WHERE w{k} IS NOT NULL GROUP BY ALL HAVING count(*) >= {policy.least}"
        for k in sizes
    )
    return rf"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, t FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS t FROM documents) x),
placed AS (
  SELECT piece, lang, unnest(w) AS w, generate_subscripts(w, 1) AS i
  FROM (SELECT piece, lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM pieces) x),
totals AS (SELECT lang, count(*) AS n FROM placed GROUP BY lang),
windows AS (SELECT lang, {ahead} FROM placed WINDOW o AS (PARTITION BY piece ORDER BY i)),
counts AS ({counted}),
candidates AS (SELECT *, string_split(phrase, ' ') AS p FROM counts WHERE size > 1),
inside AS (
  SELECT lang, array_to_string(p[i:i + s - 1], ' ') AS phrase, max(f) AS f
  FROM candidates, range(2, {policy.longest}) t(s), range(1, {policy.longest + 1}) u(i)
  WHERE s < size AND i + s - 1 <= size GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, n, (1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f) AS score
  FROM candidates c JOIN range(1, {policy.longest}) t(k) ON k < c.size
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.p[1:k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.p[k + 1:], ' ')
  JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranks AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.f IS NULL OR 100 * i.f < 100 * a)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranks WHERE rank <= {policy.most}"""


def ranked(ranking: Ranking = Ranking()) -> str:
    term = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, unnest(regexp_extract_all({_LOWER}, {term})) AS term FROM documents),
q AS (SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all({_LOWER}, {term})) AS term FROM benchmark),
tf AS (SELECT row, doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
sizes AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY row),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, totals GROUP BY term, docs),
asked AS (SELECT item, item_id, term, count(*) AS times FROM q GROUP BY ALL),
scores AS (
  SELECT item, item_id, tf.row, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN sizes ON sizes.row = tf.row, totals GROUP BY ALL),
placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= {ranking.most}"""


SQL = {"op5_quality_rules": quality_rules(), "op11_phrase_collocations": collocations(), "op13_ranked_search": ranked()}
