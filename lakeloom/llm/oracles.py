"""DuckDB statements for the contract queries that SQL can express, written apart from the operators."""

from __future__ import annotations

from collections.abc import Sequence

from . import licenses, link_trust, quality

TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS vec FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.vec, b.vec)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM r WHERE n <= 10
"""


def _strings(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def license_scan(threshold: float = 0.9) -> str:
    """Places of the phrases by list filters; every line, and every stretch of words of a template's window
    in the documents that hold enough of its words at all, compared with every template."""
    word = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
    phrases = " ".join(
        f"""|| list_transform(list_filter(range(1, len(w) - {len(p) - 2}), lambda i: {' AND '.join(
            f"w[i + {j}] = '{x}'" for j, x in enumerate(p))}), lambda i: {{'at': i - 1, 'label': '{label}'}})"""
        for p, label in ((k.split(), v) for k, v in licenses.PHRASES.items()))
    templates = ",\n".join(f"('{t.label}', {_strings(t.words)}, {t.window})" for t in licenses.TEMPLATES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, list_transform(regexp_extract_all(t, {word}), lambda x: lower(x)) AS w FROM d),
p AS (SELECT rid, doc_id, t, len(w) AS n_words, []::STRUCT("at" BIGINT, "label" VARCHAR)[] {phrases} AS places FROM w),
templates(label, words, win) AS (VALUES {templates}),
lines AS (SELECT rid, list_distinct(list_transform(regexp_extract_all(unnest(string_split(t, chr(10))), {word}),
                                                   lambda x: lower(x))) AS words FROM d),
stretches AS (
    SELECT rid, label, t.words AS own, list_distinct(d.w[i:i + win - 1]) AS words
    FROM (SELECT rid, w, label, t.words, win, unnest(range(1, len(w) + 1)) AS i FROM w
          JOIN templates t ON len(list_intersect(w, t.words)) >= ceil({threshold} * len(t.words) - 1e-9)) d
    JOIN templates t USING (label, words, win)),
met AS (
    SELECT rid, label, len(list_intersect(l.words, t.words)) / len(t.words) AS containment
    FROM lines l JOIN templates t ON len(list_intersect(l.words, t.words)) >= ceil({threshold} * len(t.words) - 1e-9)
    UNION ALL
    SELECT rid, label, len(list_intersect(words, own)) / len(own) FROM stretches
    WHERE len(list_intersect(words, own)) >= ceil({threshold} * len(own) - 1e-9)),
best AS (SELECT rid, list(DISTINCT label) AS labels, max(containment) AS score FROM met GROUP BY rid)
SELECT doc_id, n_words::BIGINT AS n_words, len(places)::BIGINT AS n_base,
       list_min(list_transform(places, lambda x: x.at))::BIGINT AS first_word,
       list_max(list_transform(places, lambda x: x.at))::BIGINT AS last_word,
       array_to_string(list_sort(list_distinct(list_transform(places, lambda x: x.label))), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_transform(places, lambda x: x.label) || coalesce(labels, []))), ',') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM p LEFT JOIN best USING (rid)
"""


def quality_rules(risk: quality.Risk = quality.Risk()) -> str:
    """Window counts by grouping, binomial tails by the sum of their terms."""
    space = r"'[^\x20\x09-\x0D]+'"
    shares = {"symbol_share": "n_symbols / word_chars", "dup_line_share": "n_dup_lines / n_lines",
              "repeat_share": "n_repeat_words / n_words", "mean_word_chars": "word_chars / n_words"}
    columns = ", ".join(f"coalesce({e}, 0.0)::DOUBLE AS {r}" for r, e in shares.items())
    grid = ", ".join(f"('{r}', {c}::DOUBLE)" for r, v in quality.GRIDS.items() for c in v)
    value = "CASE g.rule " + " ".join(f"WHEN '{r}' THEN h.{r}" for r in shares) + " END"
    own = "CASE b.rule " + " ".join(f"WHEN '{r}' THEN m.{r}" for r in shares) + " END"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, text, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, {space}) AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {space})) AS lines FROM d),
grams AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS gram
          FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM grams) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + j) AS n FROM again, (SELECT unnest(range(5)) AS j) GROUP BY rid),
m0 AS (SELECT w.rid, doc_id, lang, text, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
              length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
              len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
       FROM w LEFT JOIN covered c USING (rid)),
m AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {columns} FROM m0),
held AS (SELECT DISTINCT lang, text, l.quality = 1 AS good, {', '.join(shares)}
         FROM m JOIN (SELECT doc_id, quality FROM labels WHERE quality IS NOT NULL) l USING (doc_id) WHERE NOT base_failed),
grid(rule, cutoff) AS (VALUES {grid}),
tested AS (
    SELECT h.lang, g.rule, g.cutoff, count(*) FILTER (good) AS n, count(*) FILTER (good AND {value} > g.cutoff) AS k,
           count(*) FILTER (NOT good AND {value} > g.cutoff) AS caught
    FROM held h, grid g GROUP BY ALL),
tests AS (SELECT count(DISTINCT coalesce('s' || lang, 'n')) * (SELECT count(*) FROM grid) AS m FROM held),
sure AS (
    SELECT lang, rule, cutoff, caught - {risk.clean_weight} * k AS gain FROM tested, tests
    WHERE caught - {risk.clean_weight} * k > 0 AND k < n * {risk.alpha}
      AND list_sum(list_transform(range(0, k + 1), lambda j: exp(
            lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({risk.alpha}) + (n - j) * ln(1 - {risk.alpha}))))
          <= {risk.delta} / m),
best AS (SELECT lang, rule, cutoff FROM sure
         QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY gain DESC, cutoff DESC) = 1),
failed AS (SELECT m.rid, list(b.rule) AS rules FROM m JOIN best b ON b.lang IS NOT DISTINCT FROM m.lang AND {own} > b.cutoff
           GROUP BY m.rid)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_lines::BIGINT AS n_lines, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       array_to_string(list_filter({_strings(shares)}, lambda r: list_contains(coalesce(rules, []), r)), ',') AS failed_rules,
       NOT base_failed AND rules IS NULL AS kept
FROM m LEFT JOIN failed USING (rid)
"""


def link_trust_verdicts(rules: Sequence[link_trust.Rule], threshold: float = 0.5, alpha: float = link_trust.ALPHA,
                        rounds: int = link_trust.ROUNDS, kin: int = link_trust.KIN) -> str:
    """Rules by a join with their table; one common table expression a round of propagation."""
    lower = lambda x: f"translate({x}, '{link_trust.UPPER}', '{link_trust.LOWER}')"
    table = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in rules)
    link = link_trust.LINK.replace("'", "''")
    steps = "".join(f""",
x{i + 1} AS MATERIALIZED (
    SELECT kind, host, sum(x)::BIGINT AS x FROM (
        SELECT kind, host, x FROM base UNION ALL
        SELECT r.kind, r.dst, floor(x * rate)::BIGINT FROM x{i} x JOIN rates r ON r.kind = x.kind AND r.src = x.host)
    GROUP BY ALL)""" for i in range(rounds))
    return f"""
WITH p AS (SELECT row_number() OVER () AS rid, page_id, coalesce(html, '') AS html,
                  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT rid, page_id, html, {lower("regexp_extract(rest, '^[^/?#]*')")} AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
rules(verdict, host, path) AS (VALUES {table}),
fit AS (SELECT u.rid, r.host || r.path AS rule, r.verdict
        FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
        QUALIFY row_number() OVER (PARTITION BY u.rid ORDER BY length(r.host || r.path) DESC, length(r.host) DESC,
                                   r.host || r.path DESC, r.verdict DESC) = 1),
j AS (SELECT u.*, f.rule, f.verdict AS ruled FROM u LEFT JOIN fit f USING (rid)),
found AS (SELECT DISTINCT rid, host, {lower('dst')} AS dst FROM (
            SELECT rid, host, unnest(regexp_extract_all(html, '{link}', 1)) AS dst FROM u) WHERE host <> ''),
links AS (SELECT host AS src, dst, count(*) AS w FROM found WHERE dst <> host AND dst <> '' GROUP BY ALL),
hosts AS (SELECT host FROM u WHERE host <> '' UNION SELECT dst FROM links),
chain AS (SELECT host, array_to_string(string_split(host, '.')[i:], '.') AS domain FROM (
            SELECT host, unnest(range(2, len(string_split(host, '.')))) AS i FROM hosts
            WHERE length(host) <= {link_trust.LONGEST_HOST})),
near AS (SELECT c.host, max_by(c.domain, length(c.domain)) AS domain FROM chain c JOIN hosts h ON h.host = c.domain GROUP BY c.host),
edges AS (SELECT src, dst, sum(w) AS w FROM (
            SELECT src, dst, w FROM links UNION ALL SELECT host, domain, {kin} FROM near
            UNION ALL SELECT domain, host, {kin} FROM near) WHERE {kin} > 0 OR w > 0 GROUP BY ALL),
ways AS (SELECT 'trust' AS kind, src, dst, w FROM edges UNION ALL SELECT 'distrust', dst, src, w FROM edges),
shares AS (SELECT host, floor(('{float(link_trust.UNIT)!r}'::DOUBLE * count(*) FILTER (ruled = 'allow')) / count(*)::DOUBLE)::BIGINT AS allow,
                  floor(('{float(link_trust.UNIT)!r}'::DOUBLE * count(*) FILTER (ruled = 'block')) / count(*)::DOUBLE)::BIGINT AS block
           FROM j WHERE host <> '' GROUP BY host),
x0 AS MATERIALIZED (
    SELECT kind, host, x FROM (SELECT 'trust' AS kind, host, allow AS x FROM shares
                               UNION ALL SELECT 'distrust', host, block FROM shares) WHERE x > 0),
rates AS MATERIALIZED (
    SELECT kind, src, dst, ('{alpha!r}'::DOUBLE * w::DOUBLE) / (sum(w) OVER (PARTITION BY kind, src))::DOUBLE AS rate FROM ways
    UNION ALL
    SELECT kind, host, host, '{alpha!r}'::DOUBLE FROM (SELECT kind, host FROM x0 UNION SELECT kind, dst FROM ways)
    WHERE (kind, host) NOT IN (SELECT (kind, src) FROM ways)),
base AS MATERIALIZED (SELECT kind, host, floor(x * '{1.0 - alpha!r}'::DOUBLE)::BIGINT AS x FROM x0){steps},
scores AS (SELECT host, coalesce(sum(x) FILTER (kind = 'trust'), 0)::BIGINT AS trust,
                  coalesce(sum(x) FILTER (kind = 'distrust'), 0)::BIGINT AS distrust FROM x{rounds} GROUP BY host)
SELECT page_id, j.host, path, rule,
       coalesce(ruled, CASE WHEN coalesce(distrust, 0) - coalesce(trust, 0) >= {int(threshold * link_trust.UNIT)}
                            THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(trust, 0)::BIGINT AS trust, coalesce(distrust, 0)::BIGINT AS distrust
FROM j LEFT JOIN scores s ON s.host = j.host
"""
