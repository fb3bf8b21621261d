"""SQL that gives the same rows as a query, where SQL can express it and runs over whole tables."""

_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"

_LINES = rf"""
l AS (SELECT DISTINCT paragraph_id, coalesce(nullif(lower(regexp_replace(regexp_replace(source_type, '^{_WS}', ''), '{_WS}$', '')), ''), 'knowledge') AS source,
             unnest(string_split(paragraph, chr(10))) AS line, generate_subscripts(string_split(paragraph, chr(10)), 1) AS line_no FROM paragraphs),
k AS (SELECT *, regexp_replace(lower(trim(regexp_replace(line, '{_WS}', ' ', 'g'))), '[0-9]+', '0', 'g') AS norm FROM l
      WHERE length(regexp_replace(line, '[^\p{{L}}]', '', 'g')) >= 20),
g AS (SELECT source, norm, count(DISTINCT paragraph_id) AS docs FROM k GROUP BY ALL HAVING count(DISTINCT paragraph_id) >= 10)"""

_KEPT = """
kept AS (SELECT DISTINCT paragraph_id, source, line_no, norm FROM k JOIN g USING (source, norm)),
pairs AS (SELECT paragraph_id, source, norm, lead(norm) OVER w AS nx, lead(line_no) OVER w - line_no AS gap FROM kept WINDOW w AS (PARTITION BY paragraph_id ORDER BY line_no)),
e AS (SELECT source, least(norm, nx) AS a, greatest(norm, nx) AS b FROM pairs WHERE nx IS NOT NULL AND gap <= 2 AND nx <> norm GROUP BY ALL HAVING count(DISTINCT paragraph_id) >= 10),
links AS (SELECT source, a, b FROM e UNION ALL SELECT source, b, a FROM e),
reach AS (SELECT source, norm AS x, norm AS y FROM g UNION SELECT r.source, r.x, links.b FROM reach r JOIN links ON links.source = r.source AND links.a = r.y)"""

ORACLE_SQL = {
    "p4_blocks": f"WITH RECURSIVE {_LINES}, {_KEPT} SELECT g.source, min(y) AS block, g.norm AS line, any_value(g.docs) AS docs FROM g JOIN reach r ON r.source = g.source AND r.x = g.norm GROUP BY g.source, g.norm",
    "p4_found": f"WITH {_LINES} SELECT DISTINCT paragraph_id, CAST(line_no AS INTEGER) AS line_no FROM k JOIN g USING (source, norm)",
    "p4_clean": f"""WITH {_LINES},
f AS (SELECT DISTINCT paragraph_id, line_no FROM k JOIN g USING (source, norm)),
a AS (SELECT DISTINCT paragraph_id, line, line_no FROM l)
SELECT p.paragraph_id, coalesce(string_agg(a.line, chr(10) ORDER BY a.line_no) FILTER (f.line_no IS NULL), CASE WHEN p.paragraph IS NULL THEN NULL ELSE '' END) AS paragraph,
       CAST(count(f.line_no) AS INTEGER) AS removed
FROM (SELECT paragraph_id, max(paragraph) AS paragraph FROM paragraphs GROUP BY 1) p LEFT JOIN a USING (paragraph_id) LEFT JOIN f ON f.paragraph_id = a.paragraph_id AND f.line_no = a.line_no
GROUP BY p.paragraph_id, p.paragraph""",
}
