"""SQL of the corpus queries that SQL can express, for another engine.

None for op2, op3, op4, op7, op8, op10, op11 and op13: winnowed runs, a trained model, a
segmentation by dynamic programming, expectation-maximisation, packing, BPE, and planted runs
and slips that depend on a CRC-32.
"""

from __future__ import annotations

from .licenses import TEMPLATES, THRESHOLD
from .urls import HOST_RULES, PATTERNS

GAP = "[\\x20\\x09-\\x0D]+"
LOW = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def op1() -> str:
    rules = ", ".join(
        f"({_quoted(r.name)}, {_quoted(r.action)}, {r.level}, {_quoted(r.regex())})" for r in HOST_RULES + PATTERNS
    )
    host = LOW.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")
    return f"""
    WITH p AS (
      SELECT page_id, {host} AS host,
             coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
             coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*([^#]*)', 1), '') AS query
      FROM pages),
    r(name, action, level, regex) AS (VALUES {rules}),
    hits AS (
      SELECT p.page_id, r.name, r.action, r.level,
             row_number() OVER (PARTITION BY p.page_id ORDER BY r.level DESC, length(r.name) DESC,
                                r.action = 'allow' DESC, r.name DESC) AS k
      FROM p JOIN r ON regexp_matches(p.host || p.path || p.query, r.regex))
    SELECT p.page_id, p.host, p.path,
           CASE WHEN h.level >= 1 THEN h.name END AS rule,
           coalesce(h.action, 'allow') AS verdict,
           CASE WHEN h.level = 0 THEN h.name END AS pattern
    FROM p LEFT JOIN hits h ON h.page_id = p.page_id AND h.k = 1
    """


def _classes(num: int, kept: str = "") -> str:
    """Components of links of at least ``num`` hundredths, and further columns."""
    return f"""
    WITH RECURSIVE w AS (
      SELECT doc_id, list_filter(string_split_regex({LOW.format("coalesce(text, '')")}, '{GAP}'),
                                 lambda x: x <> '') AS words FROM documents),
    s AS (
      SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(words) = 0 THEN []
        WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i : i + 4], ' ')) END) AS shingle
      FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    shared AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
      FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
    link AS (
      SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * k >= {num} * (x.n + y.n - k)),
    both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
    reach(doc_id, other) AS (
      SELECT doc_id, doc_id FROM documents
      UNION SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON e.a = r.other)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id{kept}
    FROM documents d LEFT JOIN n USING (doc_id)
    JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
    """


def op5() -> str:
    return _classes(80)


def op12() -> str:
    return _classes(85, ", d.doc_id = c.component_id AS kept")


def op6() -> str:
    return f"""
    WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{GAP}', ' ', 'g') AS norm FROM documents)
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
    FROM t WINDOW same AS (PARTITION BY norm)
    """


def op9() -> str:
    templates = ", ".join(f"({i}, {_quoted(name)}, {_quoted(text)})" for i, (name, text) in enumerate(TEMPLATES))
    words = "string_split(trim(regexp_replace(" + LOW.format("{0}") + ", '[^a-z0-9]+', ' ', 'g')), ' ')"
    grams = "list_distinct(list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]))"
    return f"""
    WITH t(template_id, license, t) AS (VALUES {templates}),
    tg AS (SELECT template_id, license, {grams.format("words")} AS g FROM (SELECT *, {words.format("t")} AS words FROM t)),
    u AS (
      SELECT DISTINCT doc_id, unnest(list_concat(list_concat(string_split(text, chr(10)),
             string_split_regex(text, '\\n[ \\t\\r]*\\n')), [text])) AS unit
      FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
    ug AS (SELECT doc_id, unit, {grams.format("words")} AS g FROM (SELECT *, {words.format("unit")} AS words FROM u)),
    d AS (
      SELECT doc_id, unit, license, 2.0::DOUBLE * len(list_intersect(ug.g, tg.g)) / (len(ug.g) + len(tg.g)) AS dice
      FROM ug JOIN tg ON len(ug.g) > 0 AND len(ug.g) BETWEEN len(tg.g) / 3 AND len(tg.g) * 3),
    best AS (SELECT doc_id, license, unit, max(dice) AS dice FROM d WHERE dice >= {THRESHOLD} GROUP BY 1, 2, 3)
    SELECT doc_id, license, max(dice) AS dice, count(*) AS n_units FROM best GROUP BY 1, 2
    """


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filters": op1(),
        "op5_ngram_jaccard_join": op5(),
        "op6_exact_dedup": op6(),
        "op9_license_scans": op9(),
        "op12_minhash_hamming": op12(),
    }
