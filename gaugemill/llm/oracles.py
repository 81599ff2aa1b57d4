"""The queries as DuckDB SQL over the given tables, where SQL can express them."""

from __future__ import annotations

from gaugemill.llm.license_scan import GRAM, SHARE, TEMPLATES

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w
    FROM documents
),
b AS (
    SELECT coalesce(cast(item_id AS VARCHAR), 'null') AS item,
        regexp_extract_all({_LOWER}, '{_WORD}') AS w
    FROM benchmark
),
windows AS (
    SELECT DISTINCT item, least(len(w), 10) AS size, w[i : i + least(len(w), 10) - 1] AS win
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
places AS (
    SELECT d.r, s.size, i, d.w[i : i + s.size - 1] AS win
    FROM d, (SELECT DISTINCT size FROM windows) s, unnest(range(1, len(d.w) - s.size + 2)) t(i)
),
found AS (SELECT r, i, size, item FROM places JOIN windows USING (size, win)),
hit AS (
    SELECT r, count(DISTINCT word) AS n
    FROM (SELECT r, unnest(range(i, i + size)) AS word FROM found) GROUP BY r
),
items AS (
    SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT
    doc_id,
    cast(len(w) AS BIGINT) AS n_words,
    cast(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
    cast(coalesce(items.n, 0) AS BIGINT) AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256,
    coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

# A host is compared with the rule's host and with its subdomains; the longest rule wins.
URL_FILTER = r"""
WITH parts AS (
    SELECT
        page_id,
        translate(
            coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
        ) AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
        row_number() OVER () AS r
    FROM pages
),
rules(rule_host, rule_path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
fits AS (
    SELECT r, rule_host || rule_path AS rule, verdict, row_number() OVER (
        PARTITION BY r ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC
    ) AS place
    FROM parts JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (r)
"""

_TEMPLATES = ", ".join(
    f"({number}, '{x.label}', {x.is_phrase}, {x.drift}, '{' '.join(x.words)}')"
    for number, x in enumerate(TEMPLATES)
)

# Phrases are looked for word by word; of texts, words covered by common runs are counted in a
# list of all words of each span.
LICENSE_SCAN = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w
    FROM documents
),
t AS (
    SELECT t, label, is_phrase, drift, string_split(words, ' ') AS tw
    FROM (VALUES {_TEMPLATES}) x(t, label, is_phrase, drift, words)
),
base AS (
    SELECT r, label, i - 1 AS place
    FROM d, (SELECT * FROM t WHERE is_phrase), unnest(range(1, len(w) - len(tw) + 2)) u(i)
    WHERE w[i] = tw[1] AND w[i : i + len(tw) - 1] = tw
),
grams AS (
    SELECT r, i AS pos, w[i : i + {GRAM - 1}] AS gram
    FROM d, unnest(range(1, len(w) - {GRAM - 2})) u(i)
),
known AS (
    SELECT t, label, drift, len(tw) AS size, q, tw[q : q + {GRAM - 1}] AS gram
    FROM t, unnest(range(1, len(tw) - {GRAM - 2})) u(q) WHERE NOT is_phrase
),
votes AS (SELECT *, pos - q AS diagonal FROM grams JOIN known USING (gram)),
steps AS (
    SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY r, t ORDER BY diagonal) > drift AS far
    FROM (SELECT DISTINCT r, t, drift, diagonal FROM votes)
),
spans AS (
    SELECT r, t, diagonal,
        count(*) FILTER (WHERE far) OVER (PARTITION BY r, t ORDER BY diagonal) AS span
    FROM steps
),
scored AS (
    SELECT r, t, label,
        len(list_distinct(flatten(list(range(q, q + {GRAM})))))
            / greatest(any_value(size), max(pos) + {GRAM} - min(pos)) AS score
    FROM votes JOIN spans USING (r, t, diagonal) GROUP BY r, t, label, span
),
found AS (
    SELECT r, label, true AS is_base, 1.0::DOUBLE AS score FROM base
    UNION ALL SELECT r, label, false, score FROM scored WHERE score >= {SHARE}
),
labels AS (
    SELECT r, max(score) AS score,
        list_sort(list(DISTINCT label)) AS labels,
        list_sort(list(DISTINCT label) FILTER (WHERE is_base)) AS base_labels
    FROM found GROUP BY r
),
places AS (
    SELECT r, count(*) AS n, min(place) AS first_word, max(place) AS last_word
    FROM base GROUP BY r
)
SELECT
    doc_id,
    cast(len(w) AS BIGINT) AS n_words,
    cast(coalesce(n, 0) AS BIGINT) AS n_base,
    cast(first_word AS BIGINT) AS first_word,
    cast(last_word AS BIGINT) AS last_word,
    coalesce(array_to_string(base_labels, ','), '') AS base_labels,
    coalesce(array_to_string(labels, ','), '') AS labels,
    coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN labels USING (r) LEFT JOIN places USING (r)
"""

ORACLES: dict[str, str] = {
    "op1_url_filter": URL_FILTER,
    "op4_decontamination": DECONTAMINATION,
    "op11_license_scan": LICENSE_SCAN,
}
