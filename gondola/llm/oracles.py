"""DuckDB SQL for the registered queries of this package that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         coalesce(doc_id::VARCHAR, '') AS k
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM per),
filled AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / weight AS fill,
         sum(source_size) OVER () * 1.5::DOUBLE AS everything, sum(weight) OVER () AS heavy FROM weighed),
walked AS (
  SELECT *, fill * (heavy - coalesce(sum(weight) OVER w, 0)) <= everything - coalesce(sum(cap) OVER w, 0) AS is_full
  FROM filled WINDOW w AS (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
plan AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN cap ELSE weight * (everything - coalesce(sum(cap) FILTER (is_full) OVER (), 0))
              / sum(weight) FILTER (NOT is_full) OVER () END::DOUBLE AS target FROM walked),
drawn AS (
  SELECT s.*, p.source_size, p.target,
         CASE WHEN p.source_size > 0 THEN floor(p.target / p.source_size) ELSE 0 END::BIGINT AS copies,
         ((('0x' || substr(md5(s.k), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
ranked AS (
  SELECT *, target - copies * source_size AS rest,
         CASE WHEN target - copies * source_size > 0 THEN
           u / (1 - u) / (((target - copies * source_size) / source_size) / (1 - (target - copies * source_size) / source_size)
           * CASE WHEN size > 0 THEN sqrt(size::DOUBLE) ELSE 1 END) END AS x
  FROM drawn),
units AS (
  SELECT source, x / (1 + x) AS q, k, size, sum(size) AS words, any_value(rest) AS rest FROM ranked WHERE rest > 0 GROUP BY ALL),
taken AS (
  SELECT source, k, size, coalesce(sum(words) OVER w, 0) + words / 2 <= rest AS fits FROM units
  WINDOW w AS (PARTITION BY source ORDER BY q, k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT r.doc_id, r.size, r.source_size, r.target,
       (r.size * (r.copies + CASE WHEN t.fits THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ranked r LEFT JOIN taken t ON r.source IS NOT DISTINCT FROM t.source AND r.k = t.k AND r.size = t.size
"""

OP4 = r"""
WITH doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item, least(len(w), 10) AS width, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2)::BIGINT)) AS i FROM item_words WHERE len(w) > 0)),
widths AS (SELECT DISTINCT width FROM grams),
seen AS (
  SELECT r, i, width, array_to_string(w[i : i + width - 1], ' ') AS gram
  FROM (SELECT r, w, width, unnest(range(1, (len(w) - width + 2)::BIGINT)) AS i FROM doc_words, widths WHERE len(w) >= width)),
found AS (SELECT r, i, s.width, item FROM seen s JOIN grams g ON s.width = g.width AND s.gram = g.gram),
words_hit AS (
  SELECT r, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT r, unnest(range(i, i + width)) AS p FROM found) GROUP BY r),
items_hit AS (
  SELECT r, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS named
  FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(named, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN words_hit USING (r) LEFT JOIN items_hit USING (r)
"""

def _op2() -> str:
    from gondola.llm.licences import TEMPLATES

    quote = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"({quote(name)}, {quote(text)})" for name in sorted(TEMPLATES) for text in TEMPLATES[name])
    words = lambda x: (
        f"regexp_extract_all(translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )
    return rf"""
WITH known AS (SELECT row_number() OVER () AS t, name, {words("txt")} AS w FROM (VALUES {known}) AS v(name, txt)),
t_grams AS (SELECT DISTINCT t, name, w[i] || ' ' || w[i + 1] AS g FROM (SELECT t, name, w, unnest(range(1, len(w))) AS i FROM known)),
t_size AS (SELECT t, count(*) AS nt FROM t_grams GROUP BY t),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS txt FROM documents),
lines AS (SELECT r, unnest(string_split(txt, chr(10))) AS txt, unnest(range(0, len(string_split(txt, chr(10))))) AS line FROM docs),
units AS (SELECT r, line, {words("txt")} AS w FROM lines UNION ALL SELECT r, -1, {words("txt")} FROM docs),
grams AS (SELECT DISTINCT r, line, w[i] || ' ' || w[i + 1] AS g FROM (SELECT r, line, w, unnest(range(1, len(w))) AS i FROM units WHERE len(w) > 1)),
size AS (SELECT r, line, count(*) AS n FROM grams GROUP BY r, line),
common AS (SELECT r, line, t, name, count(*) AS k FROM grams JOIN t_grams USING (g) GROUP BY r, line, t, name),
scored AS (
  SELECT r, line, name, 2 * k::DOUBLE / (n + nt) AS dice FROM common JOIN size USING (r, line) JOIN t_size USING (t) WHERE 2 * k::DOUBLE / (n + nt) >= 0.9),
best AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY dice DESC, name, line < 0, line) AS nth FROM scored),
counted AS (SELECT r, count(DISTINCT line) AS n_lines FROM scored WHERE line >= 0 GROUP BY r)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, name AS license, dice, line::BIGINT AS line
FROM docs LEFT JOIN (SELECT * FROM best WHERE nth = 1) USING (r) LEFT JOIN counted USING (r)
"""


ORACLES: dict[str, str] = {"op1_pareto_mix": OP1, "op2_licence_scan": _op2(), "op4_decontaminate": OP4}
