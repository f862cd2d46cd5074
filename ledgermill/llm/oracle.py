"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from ledgermill.llm import licenses, queries, rules

_RULES = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, list_filter(regexp_split_to_array(text, '{blank}'), lambda x: x <> '') AS words FROM docs
),
base AS (
  SELECT r, doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(text, '{symbol}')) AS n_symbols
  FROM split
),
tokens AS (SELECT r, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM split),
windows AS (
  SELECT r, i, a, lead(a, 1) OVER w AS b, lead(a, 2) OVER w AS c FROM tokens WINDOW w AS (PARTITION BY r ORDER BY i)
),
twice AS (
  SELECT r, i FROM windows WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1
),
repeated AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
),
parts AS (SELECT r, string_split(text, chr(10)) AS lines FROM docs),
lines AS (
  SELECT r, i, line, row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 AS again,
         len(list_filter(regexp_split_to_array(line, '{blank}'), lambda x: x <> '')) AS n,
         regexp_matches(after, '{lower}') OR length(line) >= {wrapped_chars} AND regexp_matches(after, '{word}') AS wrapped
  FROM (
    SELECT r, i, line, coalesce(lead(line) OVER (PARTITION BY r ORDER BY i), '') AS after
    FROM (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM parts)
  )
  WHERE regexp_matches(line, '{word}')
),
judged AS (
  SELECT r, n, again,
         again
         OR (n <= {open_words} AND NOT wrapped AND NOT regexp_matches(line, '{closed}'))
         OR (len(regexp_extract_all(line, '{punctuation}')) - 1) * 100 > length(regexp_replace(line, '{blank}', '', 'g')) * 15
         OR len(regexp_extract_all(line, '{symbol}')) * 10 > n
         OR (n <= {menu_words} AND regexp_matches(line, '{menu}'))
         OR (n <= {boilerplate_words} AND regexp_matches(line, '{boilerplate}')) AS bad
  FROM lines
),
by_doc AS (
  SELECT r, count(*) AS n_lines, count_if(bad)::BIGINT AS n_bad_lines, count_if(again)::BIGINT AS n_dup_lines,
         coalesce(sum(n) FILTER (bad), 0)::BIGINT AS lost_words
  FROM judged GROUP BY r
),
measured AS (
  SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
         coalesce(n_bad_lines, 0) AS n_bad_lines, coalesce(lost_words, 0) AS lost_words
  FROM base LEFT JOIN repeated USING (r) LEFT JOIN by_doc USING (r)
)
SELECT *, n_words < {min_words} OR n_repeat_words * 100 > n_words * {max_repeated} AS base_failed,
       NOT (n_words < {min_words} OR n_repeat_words * 100 > n_words * {max_repeated})
       AND lost_words * 100 <= n_words * {max_lost} AS kept
FROM measured
"""


def _quoted(text: str) -> str:
    return text.replace("'", "''")


def quality_rules() -> str:
    texts = {
        "blank": rules.BLANK, "word": rules.WORD, "symbol": rules.SYMBOL, "punctuation": rules.PUNCTUATION,
        "closed": rules.CLOSED, "lower": rules.LOWER, "menu": rules.MENU_LINE, "boilerplate": rules.BOILERPLATE_LINE,
    }
    return _RULES.format(
        **{k: _quoted(v) for k, v in texts.items()},
        open_words=rules.OPEN_WORDS, wrapped_chars=rules.WRAPPED_CHARS, menu_words=rules.MENU_WORDS, boilerplate_words=rules.BOILERPLATE_WORDS,
        min_words=rules.MIN_WORDS, max_repeated=rules.MAX_REPEATED, max_lost=rules.MAX_LOST,
    )


_MIX = """
WITH shares(name, share) AS (VALUES {shares}),
sized AS (
  SELECT CASE WHEN source IN ({names}) THEN source END AS name, sum(length(text))::DOUBLE AS size
  FROM documents GROUP BY 1
),
rates AS (
  SELECT shares.name, CASE WHEN coalesce(size, 0) > 0
         THEN share / {total} * (SELECT sum(length(text))::DOUBLE FROM documents) / size ELSE 0.0 END AS rate
  FROM shares LEFT JOIN sized ON shares.name IS NOT DISTINCT FROM sized.name
),
steps AS (
  SELECT name, rate, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY name ORDER BY k) AS below
  FROM rates, range(0, 60) AS t(k) WHERE rate > 0
),
drawn AS (
  SELECT *, ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u,
         CASE WHEN source IN ({names}) THEN source END AS name
  FROM documents
),
counted AS (
  SELECT doc_id, text, lang, source, n_chars, r.rate,
         (SELECT count(*) FROM steps s WHERE s.name IS NOT DISTINCT FROM d.name AND least(s.below, 1.0) <= d.u)::INTEGER AS n_copies
  FROM drawn d JOIN rates r ON r.name IS NOT DISTINCT FROM d.name
)
SELECT *, ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS place
FROM (SELECT *, unnest(range(1, n_copies + 1))::INTEGER AS copy FROM counted)
"""


def poisson_mixture() -> str:
    share = queries.WEIGHTS | {None: queries.REST}
    rows = ", ".join(f"({'NULL' if s is None else repr(s)}, {w!r}::DOUBLE)" for s, w in share.items())
    return _MIX.format(shares=rows, names=", ".join(map(repr, queries.WEIGHTS)), total=f"{sum(queries.WEIGHTS.values()) + queries.REST!r}::DOUBLE")


_LICENSES = """
WITH templates(t, name, bigrams) AS (VALUES {templates}),
pairs AS (SELECT t, name, len(bigrams) AS size, unnest(bigrams) AS bigram FROM templates),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
parts AS (SELECT r, string_split(regexp_replace(text, '([.;:!?])[ \\t]+', '\\1' || chr(10), 'g'), chr(10)) AS parts FROM docs),
split AS (
  SELECT r, i, list_filter(regexp_split_to_array(part, '[^a-z0-9]+'), lambda x: x <> '') AS words
  FROM (SELECT r, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM parts)
),
segments AS (
  SELECT r, row_number() OVER (PARTITION BY r ORDER BY i) - 1 AS place,
         list_transform(range(1, len(words)), lambda j: words[j] || ' ' || words[j + 1]) AS bigrams
  FROM split WHERE len(words) > 1 AND words[1] <> 'copyright'
),
own AS (
  SELECT r, place, t, any_value(name) AS name, any_value(size) AS size
  FROM (SELECT r, place, len(bigrams) AS n, unnest(bigrams) AS bigram FROM segments) JOIN pairs USING (bigram)
  GROUP BY r, place, t, n HAVING count(*) * 2 >= n
),
runs AS (SELECT *, place - row_number() OVER (PARTITION BY r, t ORDER BY place) AS run FROM own),
passages AS (
  SELECT r, t, name, size, run, min(place)::INTEGER AS first, max(place)::INTEGER AS last, list_distinct(flatten(list(bigrams))) AS bigrams
  FROM runs JOIN segments USING (r, place) GROUP BY r, t, name, size, run
),
scored AS (
  SELECT DISTINCT r, first, last, name, size, len(list_intersect(p.bigrams, q.bigrams)) * 2.0::DOUBLE / (len(p.bigrams) + size) AS dice
  FROM passages p JOIN templates q USING (t, name)
  WHERE len(p.bigrams) BETWEEN {low} * size AND {high} * size
),
matches AS (SELECT * FROM scored WHERE dice >= {threshold}),
best AS (
  SELECT * FROM matches m WHERE NOT EXISTS (
    SELECT 1 FROM matches o WHERE o.r = m.r AND o.first <= m.last AND m.first <= o.last
      AND (o.dice > m.dice OR (o.dice = m.dice AND (o.size > m.size OR (o.size = m.size AND o.name < m.name)))))
),
found AS (
  SELECT r, count(*) AS n_matches, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses, max(dice) AS best_dice,
         string_agg(first || ':' || last || ':' || name, ',' ORDER BY first, last, name, dice, size) AS spans
  FROM best GROUP BY r
),
counts AS (SELECT r, count(*) AS n_segments FROM segments GROUP BY r)
SELECT doc_id, coalesce(n_segments, 0) AS n_segments, coalesce(n_matches, 0) AS n_matches,
       coalesce(licenses, '') AS licenses, best_dice, coalesce(spans, '') AS spans
FROM docs LEFT JOIN counts USING (r) LEFT JOIN found USING (r)
"""


def license_scan() -> str:
    t = licenses.THRESHOLD
    rows = ", ".join(f"({i}, '{name}', [{', '.join(map(repr, bigrams))}])" for i, (name, bigrams) in enumerate(licenses.templates()))
    return _LICENSES.format(templates=rows, low=repr(t / (2 - t)), high=repr((2 - t) / t), threshold=t)


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": license_scan(),
        "op5_poisson_mixture": poisson_mixture(),
        "op9_quality_rules": quality_rules(),
    }
